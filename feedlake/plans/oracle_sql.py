"""DuckDB SQL oracles, one per registered query.

Each oracle is computed straight from the ``events`` view without touching
JSON (FIXTURES.md section 2), so it is an independent check of the Spark
decode. ``WITH`` prefixes are shared text, composed per query.
"""

from __future__ import annotations

# Silver rows expected from events (FIXTURES.md "duckdb: messages").
_MESSAGES = r"""
msg_base AS (
  SELECT *, CAST(round(value * 100) AS BIGINT) + 1000 AS c, ['btc','eth','sol'][user_id % 3 + 1] AS symbol,
         date_trunc('millisecond', ts) AS ms FROM events),
messages AS (
SELECT event_id, symbol, ms AS ts,
  CASE event_type WHEN 'view' THEN 't' WHEN 'purchase' THEN 'd' WHEN 'click' THEN 'dp' ELSE 'dl' END AS mt,
  CASE event_type
    WHEN 'view' THEN c || '.5|' || (c + 1) || '.5|' || (c - 1) || '.25|' || (event_id + 100000) || '|' ||
      CASE WHEN event_id % 4 = 0 THEN '0.00000000' ELSE '0.000' || CAST(event_id % 89 + 11 AS VARCHAR) || '000' END
    WHEN 'purchase' THEN c || '.5|' || (event_id % 50 + 1) || '|' ||
      CASE WHEN event_id % 11 <> 0 AND user_id % 2 = 0 THEN 1 ELSE 2 END
    WHEN 'click' THEN
      array_to_string(['[' || (c - i) || '.5,' || (i + 1) || ']' FOR i IN range(0, least(event_id % 25, 19) + 1)], ',') || '|' ||
      array_to_string(['[' || (c + 1 + i) || '.5,' || (i + 2) || ']' FOR i IN range(0, least(event_id % 23, 19) + 1)], ',')
    ELSE '{"channel":"push.funding.rate","data":{"r":' || event_id || '}' ||
      CASE WHEN event_id % 7 = 0 THEN '' ELSE ',"ts":' || epoch_us(ms) // 1000 END || '}' END AS m
FROM msg_base WHERE event_type <> 'error')"""

_OUTCOMES = r"""
outcomes AS (
SELECT event_id, ['btc','eth','sol'][user_id % 3 + 1] AS symbol, CASE WHEN event_type <> 'error' THEN 'stored'
  ELSE ['control','malformed','ack','not_envelope','error','error','error','error','not_envelope','not_push'][event_id % 10 + 1]
  END AS outcome FROM events)"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


def messages_cte() -> str:
    return _MESSAGES


def outcomes_cte() -> str:
    return _OUTCOMES


ORACLES: dict[str, str] = {}


def oracle(name: str, *ctes: str):
    """Register ``sql`` (body after the WITH list) under ``name``."""
    def deco(fn):
        body = fn()
        ORACLES[name] = (with_ctes(*ctes) + "\n" + body) if ctes else body
        return fn
    return deco


@oracle("decode_messages", _MESSAGES)
def _():
    return "SELECT event_id, symbol, ts, mt, m FROM messages"


@oracle("feed_outcomes", _OUTCOMES)
def _():
    return "SELECT outcome, CAST(count(*) AS BIGINT) AS n FROM outcomes GROUP BY outcome"


@oracle("count_by_type", _MESSAGES)
def _():
    return """
SELECT symbol, mt, CAST(list_position(['t','d','dp','dl'], mt) AS INTEGER) AS mt_ordinal,
       CAST(count(*) AS BIGINT) AS n,
       CAST(sum(count(*)) OVER (PARTITION BY symbol) AS BIGINT) AS symbol_total
FROM messages GROUP BY symbol, mt"""


_REPAIR = r"""
rep AS (
SELECT event_id, symbol, ts, m, CASE event_id % 10 WHEN 0 THEN CAST(list_position(['t','d','dp','dl'], mt) AS VARCHAR)
  WHEN 1 THEN NULL WHEN 2 THEN 'zz' ELSE mt END AS mt FROM messages)"""

_BAD = r"""
bad AS (
SELECT event_id, symbol, ts, CASE WHEN event_id % 1000 = 2 THEN NULL ELSE mt END AS mt, m
FROM messages WHERE event_id % 1000 <> 1)"""

_LOG = r"""
log_base AS (
SELECT symbol, date_trunc('hour', ts) AS hour, CAST(count(*) AS BIGINT) AS row_count FROM messages GROUP BY ALL),
export_log AS (
SELECT hour + INTERVAL 61 MINUTE AS export_time, symbol,
       make_timestamp((epoch_us(hour + INTERVAL 61 MINUTE) // 300000000) * 300000000) - INTERVAL 5 MINUTE AS period_start,
       row_count, row_count * 100 AS size_bytes FROM log_base),
export_log_named AS (
SELECT *, symbol || '_' || strftime(period_start, '%Y%m%d_%H') || '00.parquet' AS file_name FROM export_log)"""

_ASOF = r"""
now_t AS (SELECT max(ts) AS t FROM messages),
syms AS (SELECT unnest(['btc','eth','sol']) AS symbol)"""

_IDENT = r"""
ident AS (
SELECT event_id, ts, 'client-' || ['btc','eth','sol'][user_id % 3 + 1] AS source,
  CASE WHEN user_id % 50 = 0 THEN concat_ws('.', user_id % 223 + 1, user_id % 7, user_id % 251)
       WHEN user_id % 50 = 1 THEN concat_ws('.', user_id % 223 + 1, user_id % 7, user_id % 251, 'x')
       WHEN user_id % 50 = 2 THEN ''
       ELSE concat_ws('.', user_id % 223 + 1, user_id % 7, '0', user_id % 251) END AS ip
FROM events)"""


@oracle("subscribed_feed", _MESSAGES)
def _():
    return "SELECT event_id, symbol, ts, mt, m FROM messages WHERE mt IN ('t', 'd', 'dp')"


@oracle("quarantine_split", _OUTCOMES)
def _():
    return """
SELECT symbol, CAST(count_if(outcome = 'stored') AS BIGINT) AS stored,
       CAST(count_if(outcome IN ('malformed', 'error')) AS BIGINT) AS quarantined, CAST(count(*) AS BIGINT) AS frames
FROM outcomes GROUP BY symbol"""


for _k, _mt in (("encode_ticker", "t"), ("encode_deal", "d"), ("encode_depth", "dp"), ("encode_deadletter", "dl")):
    ORACLES[_k] = with_ctes(_MESSAGES) + f"\nSELECT event_id, symbol, m FROM messages WHERE mt = '{_mt}'"


@oracle("depth_split", _MESSAGES)
def _():
    return "SELECT event_id, symbol, split_part(m, '|', 1) AS bids, split_part(m, '|', 2) AS asks FROM messages WHERE mt = 'dp'"


@oracle("parse_ticker", _MESSAGES)
def _():
    cols = ", ".join(f"CAST(split_part(m, '|', {i + 1}) AS DECIMAL(38,12)) AS {n}" for i, n in enumerate(
        ("last_price", "fair_price", "index_price", "hold_vol", "funding_rate")))
    return f"SELECT event_id, symbol, ts, {cols} FROM messages WHERE mt = 't'"


@oracle("parse_deal", _MESSAGES)
def _():
    return """
SELECT event_id, symbol, ts, CAST(split_part(m, '|', 1) AS DECIMAL(38,12)) AS price,
       CAST(split_part(m, '|', 2) AS DECIMAL(38,12)) AS volume, CAST(split_part(m, '|', 3) AS INTEGER) AS direction
FROM messages WHERE mt = 'd'"""


@oracle("parse_depth_levels", _MESSAGES)
def _():
    return """
, lv AS (
  SELECT event_id, symbol, ms AS ts, c, 'bid' AS side, unnest(range(0, least(event_id % 25, 19) + 1)) AS i
  FROM msg_base WHERE event_type = 'click'
  UNION ALL
  SELECT event_id, symbol, ms AS ts, c, 'ask' AS side, unnest(range(0, least(event_id % 23, 19) + 1)) AS i
  FROM msg_base WHERE event_type = 'click')
SELECT event_id, symbol, ts, side, CAST(i + 1 AS INTEGER) AS level,
  CASE side WHEN 'bid' THEN CAST(c - i AS DOUBLE) + 0.5 ELSE CAST(c + 1 + i AS DOUBLE) + 0.5 END AS price,
  CASE side WHEN 'bid' THEN CAST(i + 1 AS DOUBLE) ELSE CAST(i + 2 AS DOUBLE) END AS amount
FROM lv"""


@oracle("union_symbols", _MESSAGES)
def _():
    return "SELECT event_id, symbol, ts, mt, m FROM messages"


@oracle("count_per_symbol", _MESSAGES)
def _():
    return "SELECT symbol, CAST(count(*) AS BIGINT) AS n FROM messages GROUP BY symbol"


@oracle("count_rollup", _MESSAGES)
def _():
    return "SELECT symbol, CAST(count(*) AS BIGINT) AS n FROM messages GROUP BY ROLLUP (symbol)"


@oracle("recent_activity", _MESSAGES, _ASOF)
def _():
    return """
, r AS (
  SELECT symbol, count(*) AS n, min(ts) AS e, max(ts) AS l, count(DISTINCT mt) AS k
  FROM messages, now_t WHERE ts >= now_t.t - INTERVAL 10 MINUTE GROUP BY symbol),
d AS (SELECT s.symbol, n, e, l, k, coalesce((epoch_us(l) - epoch_us(e)) / 1000000.0, 0.0) AS dur
      FROM syms s LEFT JOIN r USING (symbol))
SELECT symbol, CAST(coalesce(n, 0) AS BIGINT) AS total_messages, e AS earliest, l AS latest,
  CAST(coalesce(k, 0) AS BIGINT) AS message_types, dur AS duration_s,
  CASE WHEN dur > 0 THEN round(coalesce(n, 0) / dur, 6) ELSE 0.0 END AS rate,
  CASE WHEN coalesce(n, 0) > 0 THEN 'active' ELSE 'inactive' END AS status
FROM d"""


@oracle("symbol_liveness", _MESSAGES, _ASOF)
def _():
    return """
, r AS (SELECT symbol, count_if(ts >= now_t.t - INTERVAL 5 MINUTE) AS n FROM messages, now_t GROUP BY symbol)
SELECT s.symbol, CAST(coalesce(n, 0) AS BIGINT) AS recent, coalesce(n, 0) > 0 AS active FROM syms s LEFT JOIN r USING (symbol)"""


@oracle("flush_check", _MESSAGES, _ASOF)
def _():
    return """
SELECT symbol, CAST(count_if(ts >= now_t.t - INTERVAL 10 SECOND) AS BIGINT) AS recent, CAST(1 AS BIGINT) AS expected,
       count_if(ts >= now_t.t - INTERVAL 10 SECOND) >= 1 AS passed
FROM messages, now_t GROUP BY symbol"""


@oracle("type_breakdown", _MESSAGES)
def _():
    return """
, per AS (SELECT symbol, mt, count(*) AS n FROM messages GROUP BY ALL),
t AS (SELECT *, sum(n) OVER (PARTITION BY symbol) AS total FROM per)
SELECT symbol, mt, CASE mt WHEN 't' THEN 'ticker' WHEN 'd' THEN 'deal' WHEN 'dp' THEN 'depth' WHEN 'dl' THEN 'deadletter' ELSE mt END AS mt_name,
  CAST(n AS BIGINT) AS n, CAST((2000 * n + total) // (2 * total) AS DOUBLE) / 10.0 AS pct
FROM t"""


@oracle("collection_rate", _MESSAGES)
def _():
    return """
, a AS (SELECT symbol, count(*) AS total, min(ts) AS first_ts, max(ts) AS last_ts FROM messages GROUP BY symbol)
SELECT symbol, CAST(total AS BIGINT) AS total, first_ts, last_ts, (epoch_us(last_ts) - epoch_us(first_ts)) / 1000000.0 AS span_s,
  CASE WHEN epoch_us(last_ts) > epoch_us(first_ts) THEN round(total / ((epoch_us(last_ts) - epoch_us(first_ts)) / 1000000.0), 6) ELSE 0.0 END AS rate
FROM a"""


@oracle("median_split", _MESSAGES)
def _():
    return """
, med AS (SELECT symbol, quantile_cont(epoch_us(ts), 0.5) AS mu FROM messages GROUP BY symbol)
SELECT m.symbol, CAST(count(*) AS BIGINT) AS n, make_timestamp(CAST(floor(any_value(mu)) AS BIGINT)) AS median_ts,
  CAST(count_if(epoch_us(ts) < mu) AS BIGINT) AS older, CAST(count_if(epoch_us(ts) >= mu) AS BIGINT) AS recent
FROM messages m JOIN med USING (symbol) GROUP BY m.symbol"""


@oracle("integrity_audit", _MESSAGES)
def _():
    return """
, d AS (SELECT symbol, date_trunc('hour', ts) AS ts, mt FROM messages),
a AS (SELECT symbol, count(*) AS total, count(DISTINCT ts) AS distinct_ts, min(ts) AS lo, max(ts) AS hi,
        count_if(mt = 't') AS n_t, count_if(mt = 'd') AS n_d, count_if(mt = 'dp') AS n_dp, count_if(mt = 'dl') AS n_dl
      FROM d GROUP BY symbol)
SELECT symbol, CAST(total AS BIGINT) AS total, CAST(distinct_ts AS BIGINT) AS distinct_ts,
  CAST(total - distinct_ts AS BIGINT) AS duplicate_ts, round(distinct_ts / total, 6) AS individuality,
  CAST(n_t AS BIGINT) AS n_t, CAST(n_d AS BIGINT) AS n_d, CAST(n_dp AS BIGINT) AS n_dp, CAST(n_dl AS BIGINT) AS n_dl,
  CASE WHEN total > 1 THEN (epoch_us(hi) - epoch_us(lo)) / 1000000.0 END AS span_s
FROM a"""


@oracle("stats_15s", _MESSAGES)
def _():
    return """
, per AS (SELECT symbol, mt, make_timestamp((epoch_us(ts) // 15000000) * 15000000) AS window_start, count(*) AS n
          FROM messages GROUP BY ALL)
SELECT symbol, mt, window_start, window_start + INTERVAL 15 SECOND AS window_end, CAST(n AS BIGINT) AS n,
  CAST(sum(n) OVER (PARTITION BY symbol, mt ORDER BY window_start ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cum_n
FROM per"""


@oracle("table_scan_ordered", _MESSAGES)
def _():
    return """
SELECT symbol, CAST(row_number() OVER (PARTITION BY symbol ORDER BY ts, event_id) - 1 AS BIGINT) AS pos, ts, mt, m FROM messages"""


def _latest_sql(mt: str, depth: bool) -> str:
    cut = lambda e: f"CASE WHEN length({e}) > 50 THEN left({e}, 50) || '...' ELSE {e} END"
    bids, asks = "split_part(m, '|', 1)", "split_part(m, '|', 2)"
    cols = f"{cut(bids)} AS bids, {cut(asks)} AS asks" if depth else "m"
    return with_ctes(_MESSAGES) + f"""
SELECT symbol, rn, ts, {cols} FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY symbol ORDER BY ts DESC, event_id DESC) AS BIGINT) AS rn
  FROM messages WHERE mt = '{mt}') WHERE rn <= 3"""


ORACLES["latest_ticker"] = _latest_sql("t", False)
ORACLES["latest_deal"] = _latest_sql("d", False)
ORACLES["latest_depth"] = _latest_sql("dp", True)


@oracle("latest_overall", _MESSAGES)
def _():
    return """
SELECT symbol, rn, ts, mt, m FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY symbol ORDER BY ts DESC, event_id DESC) AS BIGINT) AS rn FROM messages) WHERE rn <= 3"""


@oracle("head_sample", _MESSAGES)
def _():
    return """
SELECT symbol, rn, ts, mt, m FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY symbol ORDER BY ts, event_id) AS BIGINT) AS rn FROM messages) WHERE rn <= 3"""


@oracle("latest_per_type", _MESSAGES)
def _():
    return """
, u AS (SELECT *, symbol || '_' || strftime(date_trunc('hour', ts), '%Y%m%d_%H') || '00.parquet' AS file_name FROM messages),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY file_name, mt ORDER BY ts DESC, event_id DESC) AS BIGINT) AS rn FROM u)
SELECT file_name, upper(split_part(file_name, '_', 1)) AS asset, mt, rn, strftime(ts, '%Y-%m-%d %H:%M:%S.%g') AS ts_text,
  CASE WHEN length(m) > 80 THEN left(m, 77) || '...' ELSE m END AS message
FROM r WHERE rn <= 3"""


@oracle("time_gaps", _MESSAGES)
def _():
    return """
SELECT event_id, symbol, ts,
  (epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY symbol ORDER BY ts, event_id)) / 1000000.0 AS gap_s
FROM messages"""


@oracle("gap_summary", _MESSAGES)
def _():
    return """
, g AS (SELECT symbol, (epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY symbol ORDER BY ts, event_id)) / 1000000.0 AS gap_s
        FROM messages)
SELECT symbol, CAST(count_if(gap_s > 5.0) AS BIGINT) AS large_gaps, max(CASE WHEN gap_s > 5.0 THEN gap_s END) AS largest_gap_s
FROM g GROUP BY symbol"""


@oracle("mt_repair", _MESSAGES, _REPAIR)
def _():
    return """
SELECT event_id, symbol, mt AS mt_in,
  CASE WHEN mt IN ('t', 'd', 'dp', 'dl') THEN mt WHEN mt = '1' THEN 't' WHEN mt = '2' THEN 'd' WHEN mt = '3' THEN 'dp'
       WHEN mt = '4' THEN 'dl' ELSE 'dl' END AS mt
FROM rep"""


@oracle("mt_null_rows", _MESSAGES, _REPAIR)
def _():
    return """
SELECT symbol, event_id, ts, pos FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY symbol ORDER BY ts, event_id) - 1 AS BIGINT) AS pos FROM rep)
WHERE mt IS NULL"""


@oracle("null_profile", _MESSAGES, _REPAIR)
def _():
    return """
SELECT symbol, CAST(count(*) AS BIGINT) AS rows, CAST(count_if(ts IS NULL) AS BIGINT) AS null_ts,
  CAST(count_if(mt IS NULL) AS BIGINT) AS null_mt, CAST(count_if(m IS NULL) AS BIGINT) AS null_m
FROM rep GROUP BY symbol"""


_BAD_FILES = r"""
bad_files AS (
SELECT *, symbol || '_' || strftime(date_trunc('hour', ts), '%Y%m%d_%H') || '00.parquet' AS file_name FROM bad),
health AS (
SELECT file_name, CAST(count(*) AS BIGINT) AS rows, CAST(count_if(mt IS NULL) AS BIGINT) AS null_mt,
  array_to_string(list_sort(list_distinct(list(mt))), ',') AS types, CAST(count(DISTINCT mt) AS BIGINT) AS n_types,
  coalesce(bool_or(mt = 'dl'), false) AS has_dl
FROM bad_files GROUP BY file_name),
health_status AS (
SELECT file_name, rows, null_mt, types, n_types,
  CASE WHEN null_mt = 0 AND n_types > 0 AND NOT has_dl THEN 'healthy' WHEN has_dl THEN 'deadletter' ELSE 'nulls' END AS status
FROM health)"""


@oracle("file_mt_health", _MESSAGES, _BAD, _BAD_FILES)
def _():
    return "SELECT * FROM health_status"


@oracle("file_summary", _MESSAGES, _BAD, _BAD_FILES)
def _():
    return """
SELECT CAST(count(*) AS BIGINT) AS files_found, CAST(count_if(status = 'healthy') AS BIGINT) AS files_passed,
  CAST(count_if(status = 'healthy' AND rows > 0) AS BIGINT) AS files_sampled,
  count(*) > 0 AND count_if(status = 'healthy') = count(*) AND count_if(status = 'healthy' AND rows > 0) > 0 AS success
FROM health_status"""


_TYPE_CMP = r"""
tf AS (SELECT symbol, mt, count(*) AS n FROM bad GROUP BY ALL),
tt AS (SELECT symbol, mt, count(*) AS n FROM messages GROUP BY ALL),
tcmp AS (
SELECT coalesce(tf.symbol, tt.symbol) AS symbol, coalesce(tf.mt, tt.mt) AS mt,
  CAST(coalesce(tf.n, 0) AS BIGINT) AS file_n, CAST(coalesce(tt.n, 0) AS BIGINT) AS table_n,
  coalesce(tf.n, 0) = coalesce(tt.n, 0) AS same
FROM tf FULL OUTER JOIN tt ON tf.symbol = tt.symbol AND tf.mt IS NOT DISTINCT FROM tt.mt)"""


@oracle("type_count_compare", _MESSAGES, _BAD, _TYPE_CMP)
def _():
    return "SELECT * FROM tcmp"


@oracle("verify_export", _MESSAGES, _BAD)
def _():
    return """
, s AS (SELECT symbol, date_trunc('hour', ts) AS hour, count(*) AS n FROM messages GROUP BY ALL),
e AS (SELECT symbol, date_trunc('hour', ts) AS hour, count(*) AS n FROM bad GROUP BY ALL)
SELECT coalesce(s.symbol, e.symbol) AS symbol, coalesce(s.hour, e.hour) AS hour,
  CAST(coalesce(s.n, 0) AS BIGINT) AS source_rows, CAST(coalesce(e.n, 0) AS BIGINT) AS exported_rows,
  coalesce(s.n, 0) = coalesce(e.n, 0) AS passed
FROM s FULL OUTER JOIN e ON s.symbol = e.symbol AND s.hour = e.hour"""


@oracle("reconcile_report", _MESSAGES, _BAD, _TYPE_CMP)
def _():
    return """
, s AS (SELECT symbol, count(*) AS rows, count_if(ts IS NULL OR mt IS NULL OR m IS NULL) AS nulls, min(ts) AS lo, max(ts) AS hi
        FROM messages GROUP BY symbol),
f AS (SELECT symbol, count(*) AS rows, count_if(ts IS NULL OR mt IS NULL OR m IS NULL) AS nulls, min(ts) AS lo, max(ts) AS hi
        FROM bad GROUP BY symbol),
tm AS (SELECT symbol, count_if(NOT same) AS type_mismatches FROM tcmp GROUP BY symbol),
ms AS (SELECT symbol, sum(abs(d)) AS multiset_diff FROM (
         SELECT symbol, ts, mt, m, sum(w) AS d FROM (
           SELECT symbol, ts, mt, m, 1 AS w FROM messages UNION ALL SELECT symbol, ts, mt, m, -1 AS w FROM bad)
         GROUP BY ALL) GROUP BY symbol),
j AS (
SELECT coalesce(s.symbol, f.symbol) AS symbol, coalesce(s.rows, 0) AS src_rows, coalesce(f.rows, 0) AS file_rows,
  coalesce(s.nulls, 0) AS src_null_rows, coalesce(f.nulls, 0) AS file_null_rows,
  coalesce(tm.type_mismatches, 0) AS type_mismatches,
  (epoch_us(s.hi) - epoch_us(s.lo)) / 1000000.0 AS src_range_s, (epoch_us(f.hi) - epoch_us(f.lo)) / 1000000.0 AS file_range_s,
  coalesce(ms.multiset_diff, 0) AS multiset_diff, coalesce(s.lo = f.lo AND s.hi = f.hi, false) AS range_match
FROM s FULL OUTER JOIN f ON s.symbol = f.symbol
LEFT JOIN tm ON tm.symbol = coalesce(s.symbol, f.symbol) LEFT JOIN ms ON ms.symbol = coalesce(s.symbol, f.symbol))
SELECT symbol, CAST(src_rows AS BIGINT) AS src_rows, CAST(file_rows AS BIGINT) AS file_rows, src_rows = file_rows AS count_match,
  CAST(src_null_rows AS BIGINT) AS src_null_rows, CAST(file_null_rows AS BIGINT) AS file_null_rows,
  CAST(type_mismatches AS BIGINT) AS type_mismatches, src_range_s, file_range_s,
  range_match, CAST(multiset_diff AS BIGINT) AS multiset_diff,
  src_rows = file_rows AND src_null_rows = 0 AND file_null_rows = 0 AS ref_pass,
  src_rows = file_rows AND src_null_rows = 0 AND file_null_rows = 0 AND type_mismatches = 0
    AND range_match AND multiset_diff = 0 AS strict_pass
FROM j"""


@oracle("identity_valid", _IDENT)
def _():
    return r"SELECT event_id, source, ip, coalesce(regexp_full_match(ip, '^[0-9]+(\.[0-9]+){3}$'), false) AS valid FROM ident"


@oracle("identity_distinct", _IDENT)
def _():
    return r"""
, v AS (SELECT date_trunc('day', ts) AS period, source, arg_max(ip, ts) AS ip FROM ident
        WHERE regexp_full_match(ip, '^[0-9]+(\.[0-9]+){3}$') GROUP BY ALL),
a AS (SELECT period, count(*) AS sources, count(DISTINCT ip) AS unique_ips FROM v GROUP BY period)
SELECT period, CAST(sources AS BIGINT) AS sources, CAST(unique_ips AS BIGINT) AS unique_ips,
  CASE WHEN unique_ips = sources AND sources >= 2 THEN 'separated' WHEN unique_ips < sources THEN 'shared' ELSE 'single' END AS verdict
FROM a"""


@oracle("period_bounds", _MESSAGES)
def _():
    return """
, p AS (SELECT event_id, symbol, ts, date_trunc('hour', ts) AS hour_start,
          make_timestamp((epoch_us(ts) // 300000000) * 300000000) AS floor5 FROM messages)
SELECT event_id, symbol, ts, hour_start, hour_start + INTERVAL 1 HOUR AS next_hour,
  hour_start + INTERVAL 61 MINUTE AS hourly_run_at, floor5, floor5 + INTERVAL 5 MINUTE AS next5,
  floor5 + INTERVAL 5 MINUTE + INTERVAL 30 SECOND AS debug_run_at,
  floor5 - INTERVAL 5 MINUTE AS period_start, floor5 AS period_end,
  strftime(floor5 - INTERVAL 5 MINUTE, '%Y%m%d_%H') AS label_hour
FROM p"""


@oracle("export_file_label", _MESSAGES)
def _():
    return """
, p AS (SELECT DISTINCT symbol, make_timestamp((epoch_us(ts) // 300000000) * 300000000) AS period_start FROM messages)
SELECT symbol, period_start, symbol || '_' || strftime(period_start, '%Y%m%d_%H') || '00.parquet' AS hourly_file,
  symbol || '_' || strftime(period_start, '%Y%m%d_%H%M') || '_debug.parquet' AS debug_file
FROM p"""


@oracle("file_asset", _MESSAGES)
def _():
    return """
, u AS (SELECT DISTINCT symbol, symbol || '_' || strftime(date_trunc('hour', ts), '%Y%m%d_%H') || '00.parquet' AS file_name FROM messages)
SELECT file_name, upper(split_part(file_name, '_', 1)) AS asset, symbol || '_current' AS table_name,
  upper(replace(symbol || '_current', '_current', '')) AS table_symbol
FROM u"""


@oracle("export_roundtrip", _MESSAGES)
def _():
    return """
SELECT symbol, mt, CAST(count(*) AS BIGINT) AS rows, CAST(0 AS BIGINT) AS null_ts, CAST(0 AS BIGINT) AS null_m
FROM messages GROUP BY ALL"""


@oracle("export_log_lines", _MESSAGES, _LOG)
def _():
    return """
SELECT symbol, period_start,
  strftime(export_time, '%Y-%m-%d %H:%M:%S') || ' | ' || upper(symbol) || ' | ' || strftime(period_start, '%Y-%m-%d %H:%M:%S')
  || ' | ' || file_name || ' | ' || row_count || ' rows | ' || format('{:,}', size_bytes) || ' bytes' AS line
FROM export_log_named"""


@oracle("export_log_parse", _MESSAGES, _LOG)
def _():
    return """
SELECT export_time, upper(symbol) AS symbol, period_start, file_name, CAST(row_count AS BIGINT) AS row_count,
  CAST(size_bytes AS BIGINT) AS size_bytes
FROM export_log_named"""


@oracle("export_log_rollup", _MESSAGES, _LOG)
def _():
    return """
SELECT symbol, CAST(count(*) AS BIGINT) AS exported_hours, min(period_start) AS first_export, max(period_start) AS last_export
FROM export_log_named GROUP BY symbol"""


# ---------------------------------------------------------------- tables, files, streams

_TABLE_ROWS = "tables AS (SELECT symbol || '_current' AS table_name, count(*) AS rows FROM messages GROUP BY symbol)"
# FIXTURES.md: every 97th message arrives three hours late, every 101st is dated 2100.
_ARRIVALS = """
arrivals AS (
  SELECT m.event_id, m.symbol, m.mt, m.m, CASE WHEN m.event_id % 101 = 0 THEN TIMESTAMP '2100-01-01' ELSE m.ts END AS ts,
         CASE WHEN m.event_id % 97 = 0 THEN e.ts + INTERVAL 3 HOUR ELSE e.ts END AS arrival_ts
  FROM messages m JOIN events e USING (event_id)),
clock AS (SELECT max(ts) AS t FROM messages),
units AS (
  SELECT symbol, strftime(ts, '%Y%m%d_%H') AS period, strftime(arrival_ts, '%Y%m%d_%H') AS segment,
         date_trunc('hour', arrival_ts) + INTERVAL 61 MINUTE <= t AS closed, count(*) AS n
  FROM arrivals, clock GROUP BY ALL)"""


@oracle("lifecycle_setup", _MESSAGES, _TABLE_ROWS)
def _():
    return "SELECT table_name, rows FROM tables"


@oracle("tables_exist", _MESSAGES, _TABLE_ROWS)
def _():
    return 'SELECT table_name, true AS "exists", true AS all_exist, rows FROM tables'


@oracle("table_listing", _MESSAGES, _TABLE_ROWS)
def _():
    return "SELECT table_name, 'MANAGED' AS table_type, 'current' AS role, rows FROM tables"


@oracle("batch_append", _MESSAGES)
def _():
    return "SELECT symbol, ts, mt, m FROM messages"


@oracle("rotate_segment", _MESSAGES)
def _():
    return """
SELECT symbol, count(*) AS segment_rows, CAST(0 AS BIGINT) AS current_rows, false AS previous_exists FROM messages GROUP BY symbol"""


@oracle("hourly_export_cycle", _MESSAGES, _ARRIVALS)
def _():
    return """
SELECT symbol, period, segment, symbol || '_' || period || '00.parquet' AS file_name, n AS row_count FROM units WHERE closed"""


@oracle("export_cycle_drop", _MESSAGES, _ARRIVALS)
def _():
    return "SELECT symbol, period, segment, closed AS exported, n AS rows FROM units"


@oracle("required_columns", _MESSAGES)
def _():
    return """
SELECT 'whole' AS export, '' AS missing, true AS ok, count(*) AS rows FROM messages
UNION ALL SELECT 'damaged', 'mt', false, count(*) FROM messages"""


@oracle("export_unit_figures", _MESSAGES)
def _():
    return """
SELECT symbol, strftime(ts, '%Y%m%d_%H') AS period, count(*) AS rows, 0 AS null_ts, count(*) FILTER (event_id % 5 = 0) AS null_mt, 0 AS null_m,
       3 AS columns FROM messages GROUP BY ALL"""


@oracle("file_inventory", _MESSAGES)
def _():
    return """
SELECT CASE WHEN symbol = 'sol' THEN 'second' ELSE 'first' END AS location, symbol, strftime(ts, '%Y%m%d_%H') AS period,
       count(*) AS rows, 3 AS columns, true AS described FROM messages GROUP BY ALL"""


for _key in ("stream_ingest", "stream_restart", "stream_dedup"):
    ORACLES[_key] = with_ctes(_MESSAGES) + "\nSELECT event_id, symbol, ts, mt, m FROM messages"


@oracle("stream_outcomes", _OUTCOMES)
def _():
    return """
SELECT outcome, count(*) AS n, CASE WHEN outcome IN ('malformed', 'error') THEN count(*) ELSE 0 END AS quarantined
FROM outcomes GROUP BY outcome"""


@oracle("stream_stats", _MESSAGES)
def _():
    return """
SELECT make_timestamp((epoch_us(ts) // 15000000) * 15000000) AS window_start,
       make_timestamp((epoch_us(ts) // 15000000) * 15000000) + INTERVAL 15 SECOND AS window_end, symbol, mt, count(*) AS n
FROM messages GROUP BY ALL"""


@oracle("stream_rates", _MESSAGES, _OUTCOMES)
def _():
    return """
, span AS (SELECT symbol, (epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6 AS s FROM messages GROUP BY symbol)
SELECT symbol, count(*) FILTER (outcome = 'stored') AS n, count(*) FILTER (outcome = 'error') AS errors,
       count(*) FILTER (outcome NOT IN ('stored', 'error')) AS skipped,
       CASE WHEN any_value(s) > 0 THEN round(count(*) FILTER (outcome = 'stored') / any_value(s), 6) ELSE 0.0 END AS rate
FROM outcomes JOIN span USING (symbol) GROUP BY symbol"""


@oracle("stream_hourly_close", _MESSAGES)
def _():
    return """
SELECT date_trunc('hour', ts) AS period_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS period_end, symbol, count(*) AS rows,
       min(ts) AS first_ts, max(ts) AS last_ts
FROM messages WHERE date_trunc('hour', ts) + INTERVAL 61 MINUTE <= (SELECT max(ts) FROM messages) GROUP BY ALL"""


@oracle("stream_debug_close", _MESSAGES)
def _():
    return """
, five AS (SELECT *, make_timestamp((epoch_us(ts) // 300000000) * 300000000) AS period_start FROM messages)
SELECT period_start, symbol, count(*) AS rows FROM five
WHERE period_start + INTERVAL 330 SECOND <= (SELECT max(ts) FROM messages) GROUP BY ALL"""


@oracle("stream_counts", _MESSAGES)
def _():
    return "SELECT symbol, count(*) AS rows FROM messages GROUP BY symbol"


@oracle("stream_error_budget", _OUTCOMES)
def _():
    return """
SELECT outcome, count(*) AS n, (SELECT count(*) FROM outcomes WHERE outcome = 'error') > 100 AS stopped FROM outcomes GROUP BY outcome"""


@oracle("stream_compact", _MESSAGES)
def _():
    return """
SELECT symbol, strftime(ts, '%Y%m%d') AS day, count(*) AS rows, count(*) AS live_rows, 1 AS files FROM messages GROUP BY ALL"""


@oracle("stream_budget_left", _OUTCOMES)
def _():
    return """
, landed AS (SELECT event_id % 4 AS landing, outcome FROM outcomes),
errors AS (SELECT landing, count(*) FILTER (outcome = 'error') AS e FROM landed GROUP BY landing),
before AS (SELECT landing, coalesce(sum(e) OVER (ORDER BY landing ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS e FROM errors)
SELECT CAST(landing AS INTEGER) AS landing, outcome, count(*) FILTER (e <= 100) AS counted, count(*) FILTER (e > 100) AS unread
FROM landed JOIN before USING (landing) GROUP BY ALL"""


# A frame without a time of its own gets the time of its arrival, the late one included.
@oracle("stream_late", _MESSAGES)
def _():
    return """
, delivered AS (
  SELECT event_id, symbol, mt, m, e.ts + CASE WHEN event_id % 97 = 0 THEN INTERVAL 3 HOUR ELSE INTERVAL 0 HOUR END AS arrival,
         m.ts + CASE WHEN event_id % 97 = 0 AND event_type = 'signup' AND event_id % 7 = 0 THEN INTERVAL 3 HOUR ELSE INTERVAL 0 HOUR END AS ts
  FROM messages m JOIN (SELECT event_id, ts, event_type FROM events) e USING (event_id))
SELECT event_id, symbol, ts, mt, m, date_trunc('hour', ts) + INTERVAL 61 MINUTE <= arrival AS late FROM delivered"""
