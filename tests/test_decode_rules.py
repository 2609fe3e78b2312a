"""One frame in, one labelled row out: the decode rules and the Spark traps they avoid."""

import datetime as dt

from given import ARRIVAL


def test_control_frames_trimmed(decode_one):
    out = decode_one(" pong\n", "ping", "\tping \r\n", "pongs")
    assert [o[0] for o in out] == ["control", "control", "control", "malformed"]


def test_malformed_and_trailing_text(decode_one):
    out = decode_one("not json{", '{"channel":"push.deal","data":{}} x', "{'channel': 'push.deal'}", "")
    assert [o[0] for o in out] == ["malformed"] * 4


def test_not_envelope(decode_one):
    out = decode_one('{"data":{}}', "[1,2]", '"text"', "null", "12")
    assert [o[0] for o in out] == ["not_envelope"] * 5


def test_acks_and_non_push(decode_one):
    out = decode_one('{"channel":"rs.sub.ticker","data":"success"}', '{"channel":"pong","data":1}',
                     '{"channel":"other.x"}', '{"channel":"sub.deal"}')
    assert [o[0] for o in out] == ["ack", "ack", "not_push", "not_push"]


def test_channel_not_text_is_error(decode_one):
    out = decode_one('{"channel":null}', '{"channel":5}', '{"channel":["push.deal"]}')
    assert [o[0] for o in out] == ["error"] * 3


def test_classification_order_and_case(decode_one):
    out = decode_one('{"channel":"push.tickerdeal","data":{},"ts":1000}',
                     '{"channel":"push.deal.depth","data":{},"ts":1000}',
                     '{"channel":"push.Ticker","data":{},"ts":1000}')
    assert [o[2] for o in out] == ["t", "d", "dl"]


def test_event_time_precedence(decode_one):
    out = decode_one('{"channel":"push.deal","data":{"ts":1704067200123},"ts":1704067200999}',
                     '{"channel":"push.deal","data":{},"ts":1704067200999}',
                     '{"channel":"push.deal","data":{}}',
                     '{"channel":"push.deal","data":{"ts":1704067200123.9}}')
    ts = [o[1].replace(tzinfo=None) for o in out]
    assert ts[0] == dt.datetime(2024, 1, 1, 0, 0, 0, 123000)
    assert ts[1] == dt.datetime(2024, 1, 1, 0, 0, 0, 999000)
    assert ts[2] == ARRIVAL.replace(microsecond=123000)     # arrival, truncated to ms
    assert ts[3] == dt.datetime(2024, 1, 1, 0, 0, 0, 123000)


def test_bad_event_time_is_error(decode_one):
    out = decode_one('{"channel":"push.ticker","data":{"lastPrice":1,"ts":"x"}}',
                     '{"channel":"push.deal","data":{},"ts":null}',
                     '{"channel":"push.deal","data":{},"ts":1e30}')
    assert [o[0] for o in out] == ["error"] * 3


def test_ticker_fields_defaults_and_number_text(decode_one):
    out = decode_one(
        '{"channel":"push.ticker","data":{"lastPrice":12345678.9,"fairPrice":122126.0,"indexPrice":"12.30",'
        '"holdVol":102648627,"fundingRate":0.00010000},"ts":1000}',
        '{"channel":"push.ticker","ts":1000}',
        '{"channel":"push.ticker","data":{"lastPrice":null,"fairPrice":1e-8},"ts":1000}')
    assert out[0][3] == "12345678.9|122126|12.30|102648627|0.00010000"
    assert out[1][3] == "0|0|0|0|0.00000000"              # data absent: defaults
    assert out[2][3] == "0|0.00000001|0|0|0.00000000"     # null counts as absent; no exponent


def test_funding_rate_rules(decode_one):
    frames = ['{"channel":"push.ticker","data":{"fundingRate":%s},"ts":1000}' % v
              for v in ('"0"', '""', "0", "false", "[]", '"abc"', '"0.000125"', "-0.0", "true", "[1]")]
    rates = [o[3].split("|")[4] for o in decode_one(*frames)]
    assert rates == ["0.00000000"] * 6 + ["0.00012500", "0.00000000", "1.00000000", "0.00000000"]


def test_deal_direction_numeric_only(decode_one):
    frames = ['{"channel":"push.deal","data":{"p":1.5,"v":2,"T":%s},"ts":1000}' % t
              for t in ("1", "1.0", '"1"', "2", "0", "true")]
    frames.append('{"channel":"push.deal","data":{"p":1.5,"v":2},"ts":1000}')
    dirs = [o[3].split("|")[2] for o in decode_one(*frames)]
    assert dirs == ["1", "1", "2", "2", "2", "1", "2"]


def test_depth_levels_capped_and_trimmed(decode_one):
    bids = ",".join(f"[{100 - i}.5,{i + 1},1]" for i in range(25))
    out = decode_one('{"channel":"push.depth.full","data":{"bids":[%s],"asks":[["7.5","3"]]},"ts":1000}' % bids,
                     '{"channel":"push.depth","data":{"asks":[[1,2]]},"ts":1000}',
                     '{"channel":"push.depth","data":{},"ts":1000}')
    b, a = out[0][3].split("|")
    assert b.count("[") == 20 and b.startswith("[100.5,1],[99.5,2]") and b.endswith("[81.5,20]")
    assert a == "[7.5,3]"
    assert out[1][3] == "|[1,2]"
    assert out[2][3] == "|"


def test_depth_errors(decode_one):
    out = decode_one('{"channel":"push.depth","data":{"bids":[[1]],"asks":[]},"ts":1}',
                     '{"channel":"push.depth","data":{"bids":null},"ts":1}',
                     '{"channel":"push.depth","data":{"bids":5},"ts":1}',
                     '{"channel":"push.depth","data":{"bids":[[1,2],3]},"ts":1}')
    assert [o[0] for o in out] == ["error"] * 4


def test_depth_odd_level_past_cap_is_ignored(decode_one):
    levels = ",".join(["[1,2]"] * 20 + ["7"])
    out = decode_one('{"channel":"push.depth","data":{"bids":[%s]},"ts":1}' % levels)
    assert out[0][0] == "stored" and out[0][3].split("|")[0].count("[1,2]") == 20


def test_data_shape_errors_and_deadletter_lists(decode_one):
    out = decode_one('{"channel":"push.deal","data":[1]}', '{"channel":"push.deal","data":null}',
                     '{"channel":"push.deal","data":"abc"}', '{"channel":"push.deal","data":3}',
                     '{"channel":"push.other","data":[1,2]}', '{"channel":"push.other","data":["ts"]}',
                     '{"channel":"push.other","data":"has ts inside"}')
    assert [o[0] for o in out] == ["error", "error", "error", "error", "stored", "error", "error"]
    assert out[4][2] == "dl"


def test_deadletter_is_first_500_chars(decode_one):
    frame = '{"channel":"push.funding.rate","data":{"r":"%s"},"ts":1000}' % ("x" * 600)
    out = decode_one(frame)
    assert out[0][2] == "dl" and out[0][3] == frame[:500]


def test_outcomes_sum_to_frames(spark):
    from feedlake.operators.decode import decode, outcome_counts
    from feedlake.sources.feed import raw_feed
    raw = raw_feed(spark, "/root/testdata/sf0.001")
    total = sum(r["n"] for r in outcome_counts(decode(raw)).collect())
    assert total == raw.count()


def test_error_budget_flag(spark):
    from feedlake.operators.decode import decode, error_budget
    from feedlake.sources.feed import raw_feed
    row = error_budget(decode(raw_feed(spark, "/root/testdata/sf0.001")), budget=10).first()
    assert row["errors"] > 10 and row["over_budget"]


def test_depth_exponent_numbers_print_as_plain_decimals(decode_one):
    out = decode_one('{"channel":"push.depth","data":{"bids":[[1e-8,2.5E3,1],[120.50,7]],"asks":[[3,4]]},"ts":1}')
    assert out[0][0] == "stored" and out[0][3] == "[0.00000001,2500],[120.5,7]|[3,4]"


def test_an_ordinary_frame_is_parsed_once_and_its_data_not_copied(spark):
    from feedlake.functions import json_frame as jf
    from feedlake.operators.decode import decode_messages
    from feedlake.schema import RAW_FEED_SCHEMA
    depth = '{"channel":"push.depth","data":{"bids":[[1,2,1],[3,4,1]],"asks":[[5,6,1],[7,8,1]]},"ts":1}'
    frames = spark.createDataFrame([(0, "btc", ARRIVAL, depth), (1, "btc", ARRIVAL, depth + "{}"), (2, "btc", ARRIVAL, "[1]"), (3, "btc", ARRIVAL, None)],
                                   RAW_FEED_SCHEMA)
    one = frames.select("event_id", jf.is_one_object(jf.in_list(frames.value)).alias("one"))
    assert [r.one for r in one.orderBy("event_id").collect()] == [True, False, False, False]
    plan = decode_messages(frames)._jdf.queryExecution().optimizedPlan().toString()
    # a payload comes out as a VARIANT of its own only where it is no object
    copies = plan.count("$[0].data, VariantType") + plan.count("$.data, VariantType")
    guarded = plan.count("THEN try_variant_get(_frame#") if copies else 0
    assert copies == plan.count("CASE WHEN NOT _data_obj#") == 1 and guarded >= 1


def test_what_follows_a_document_decides_as_it_did(decode_one):
    f = '{"channel":"push.deal","data":{"p":1,"v":2,"T":1}}'
    lists = '{"channel":"push.depth","data":{"bids":[[1,2],[3,4]],"asks":[]}}'
    tails = {"": "stored", " \n": "stored", "{}": "malformed", ",{}": "malformed", " [1]": "malformed", ",5}": "malformed", "x": "malformed"}
    assert [o for o, *_ in decode_one(*[lists + t for t in tails])] == list(tails.values())
    assert [o for o, *_ in decode_one(f + "abc}", f + "]", f + "[1],}")] == ["stored", "malformed", "malformed"]
