"""Decode push frames into the message table, with one outcome per frame.

``decode(raw)`` keeps every input row and labels it; ``messages(decoded)``
keeps the stored ones. It is a map-only plan: no shuffle, so it scales with
the number of input splits, and it runs unchanged in a streaming query.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlake.functions import json_frame as jf
from feedlake.schema import ERROR_BUDGET

MESSAGE_COLS = ("event_id", "symbol", "ts", "mt", "m")


def _side_error(frame, side: str):
    fast = F.col(f"_{side}_fast")
    return (F.when(fast.isNotNull(), jf.depth_fast_short(fast))
            .otherwise(jf.depth_side_error(frame, side, F.col(f"_{side}"))))


def _side_text(side: str):
    fast = F.col(f"_{side}_fast")
    return (F.when(fast.isNotNull(), jf.depth_fast_text(fast, F.col("_frame"), side))
            .otherwise(jf.depth_side_text(F.col(f"_{side}"))))


def _classify(raw: DataFrame) -> tuple[DataFrame, Column]:
    """Parse each frame once: internal ``_*`` columns, and the outcome as an expression over them.

    ``_frame`` is a list with the frame as its element. An ordinary frame is one object and is parsed
    as that element alone; any other (no JSON, no object, text after it) is parsed by itself as well.
    """
    value = F.col("value")
    # Parse once; keep the variant as a column so later expressions reuse it.
    listed = raw.withColumn("_list", jf.in_list(value)).withColumn("_one", jf.is_one_object(F.col("_list")))
    one = F.col("_one")
    parsed = listed.withColumn("_alone", F.when(~one, F.try_parse_json(value)))
    alone = F.col("_alone")
    frame = F.col("_frame")
    step1 = parsed.withColumns({
        "_control": jf.is_control(value),
        "_trailing": jf.has_trailing_text(value, F.col("_list"), one),
        "_frame": F.when(one, F.col("_list")).when(alone.isNotNull(), F.array(alone).cast("variant")),
    }).withColumns({
        "_ch": jf.vget(frame, f"{jf.FRAME}.channel"),
        # Object test without walking the value (a depth object is large);
        # other data is taken out, and the full type name is only needed for it.
        "_data_obj": F.coalesce(jf.vget(frame, jf.DATA, "struct<>").isNotNull(), F.lit(False)),
        "_ts_v": jf.event_time_source(frame),
    })
    ch_type = jf.vtype(F.col("_ch"))
    data_is_object = F.col("_data_obj")
    step2 = step1.withColumns({
        "_ch_type": ch_type,
        "_channel": F.when(ch_type == "STRING", jf.vget(F.col("_ch"), "$", "string")),
        "_data": F.when(~data_is_object, jf.vget(frame, jf.DATA)),
        "_ms": jf.event_millis(F.col("_ts_v")),
    })
    channel = F.col("_channel")
    data = F.col("_data")
    kind = (F.when(channel.contains("ticker"), "t")
            .when(channel.contains("deal"), "d")
            .when(channel.contains("depth"), "dp")
            .otherwise("dl"))
    step3 = step2.withColumn("_kind", kind)
    is_depth = (F.col("_kind") == "dp") & data_is_object
    sides = ("bids", "asks")
    step3 = step3.withColumns({f"_{s}_json": F.when(is_depth, jf.vget(frame, f"{jf.DATA}.{s}", "string")) for s in sides})
    step3 = step3.withColumns({f"_{s}_fast": jf.depth_side_first_levels(F.col(f"_{s}_json")) for s in sides})
    # General path only for depth sides the fast path does not cover.
    step3 = step3.withColumns({f"_{s}": F.when(is_depth & F.col(f"_{s}_fast").isNull(), jf.depth_side_json(frame, s)) for s in sides})
    kind = F.col("_kind")
    data_type = jf.vtype(data)
    # 'ts' in data: TypeError when data is null/number/bool; for a list or a
    # string that contains "ts" the following lookup fails too.
    data_lookup_error = data.isNotNull() & F.coalesce(
        data_type.isin("VOID", "BOOLEAN") | jf.is_numeric_type(data_type)
        | jf.text_contains_ts_key(data, data_type), F.lit(False))
    payload_shape_error = (kind != "dl") & data.isNotNull()
    error = (data_lookup_error | jf.event_time_error(F.col("_ts_v"), F.col("_ms")) | payload_shape_error
             | ((kind == "dp") & data_is_object & (_side_error(frame, "bids") | _side_error(frame, "asks"))))
    outcome = (F.when(F.col("_control"), "control")
               .when(frame.isNull() | F.col("_trailing"), "malformed")
               .when(F.col("_ch").isNull(), "not_envelope")
               .when(channel == "pong", "ack")
               .when(F.col("_ch_type") != "STRING", "error")
               .when(channel.startswith("rs."), "ack")
               .when(~channel.startswith("push."), "not_push")
               .when(error, "error")
               .otherwise("stored"))
    return step3, outcome


def _stored_cols() -> dict:
    """``ts, mt, m`` of a stored frame (meaningful only when outcome is 'stored')."""
    kind = F.col("_kind")
    frame = F.col("_frame")
    payload = (F.when(kind == "t", jf.ticker_text(frame))
               .when(kind == "d", jf.deal_text(frame))
               .when(kind == "dp", F.concat(_side_text("bids"), F.lit("|"), _side_text("asks")))
               .otherwise(jf.deadletter_text(F.col("value"))))
    return {"ts": jf.event_time(F.col("_ts_v"), F.col("_ms"), F.col("arrival_ts")), "mt": kind, "m": payload}


def decode(raw: DataFrame) -> DataFrame:
    """Label each frame with ``outcome`` and, when stored, ``ts, mt, m``.

    Input: ``symbol, arrival_ts, value`` (plus any id columns, kept).
    Outcomes: control, malformed, not_envelope, ack, not_push, error, stored.
    Unused output columns are pruned by Catalyst, so outcome counts never
    build payload text. The outcome comes out of a generator (``explode`` of
    one element): a filter on it stays above, where it would otherwise be
    pushed down with the whole classification and parse the frame again.
    """
    stored = F.col("outcome") == "stored"
    parsed, outcome = _classify(raw)
    return parsed.select("*", F.explode(F.array(outcome)).alias("outcome")).select(
        *raw.columns, "outcome",
        *[F.when(stored, c).alias(name) for name, c in _stored_cols().items()])


def decode_messages(raw: DataFrame, with_channel: bool = False, with_arrival: bool = False) -> DataFrame:
    """Stored rows straight from frames: classify, keep stored, then build payloads.

    The "keep stored rows" step is a generator (``explode`` of a 0- or
    1-element array) rather than a filter: a filter on ``outcome`` would be
    pushed below the projections and re-evaluate the parse inside the
    predicate. The generator emits only a marker; ``ts, mt, m`` are built in
    the projection above it, so the parse runs once per frame, payload text
    is built only for stored rows and only when a consumer reads ``m``
    (column pruning), and filters on ``symbol`` or ``arrival_ts`` still reach
    the scan.
    """
    keep = [c for c in ("event_id", "symbol", *(["arrival_ts"] if with_arrival else [])) if c in raw.columns]
    cols = _stored_cols()
    if with_channel:
        cols["channel"] = F.col("_channel")
    parsed, outcome = _classify(raw)
    kept = parsed.select("*", F.explode(F.when(outcome == "stored", F.array(F.lit(True)))).alias("_stored"))
    return kept.select(*keep, *[c.alias(name) for name, c in cols.items()])


def messages(decoded: DataFrame) -> DataFrame:
    """Stored rows only: ``event_id?, symbol, ts, mt, m``."""
    cols = [c for c in MESSAGE_COLS if c in decoded.columns]
    return decoded.where(F.col("outcome") == "stored").select(*cols)


def outcome_counts(decoded: DataFrame) -> DataFrame:
    """Frames per outcome (sums to the input count)."""
    return decoded.groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


def error_budget(decoded: DataFrame, budget: int = ERROR_BUDGET) -> DataFrame:
    """Rule 10: error count and whether it exceeds the budget (one row)."""
    errors = F.count_if(F.col("outcome") == "error")
    return decoded.agg(errors.alias("errors"), (errors > budget).alias("over_budget"))


def quarantine_split(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows for the table (stored) and rows for quarantine (malformed or error).

    Ignored frames (control, acknowledgements, non-envelopes, non-push) go to
    neither; they are accounted for by their outcome.
    """
    good = messages(decoded)
    bad = decoded.where(F.col("outcome").isin("malformed", "error"))
    return good, bad
