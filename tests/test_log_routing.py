"""Golden records for log parsing and routing."""

import json

from martflow.operators import parse

COMMON = {"ar": "110000", "uid": "9", "os": "iOS 13", "ch": "Appstore", "is_new": "0", "md": "X",
          "mid": "mid_1", "vc": "v2", "ba": "B"}
PAGE = {"page_id": "good_detail", "item": "7", "during_time": 1500, "item_type": "sku_id",
        "last_page_id": "home", "source_type": "query"}
DISPLAY = {"display_type": "query", "item": "3", "item_type": "sku_id", "pos_id": "2", "order": "1"}
ACTION = {"item": "7", "action_id": "cart_add", "item_type": "sku_id", "ts": 1653998724000}
START = {"entry": "icon", "open_ad_skip_ms": 0, "open_ad_ms": 2000, "loading_time": 900, "open_ad_id": "4"}
TS = 1653998723000


def rec(**parts):
    d = {"common": COMMON, "ts": TS}
    d.update(parts)
    return json.dumps(d)


def parsed_of(spark, *values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "offset long, value string")
    return parse.parse_log(df)


def topics(spark, *values):
    routed = parse.route_log(parsed_of(spark, *values))
    out = {}
    for r in routed.collect():
        out[r["topic"]] = out.get(r["topic"], 0) + 1
    return out


def test_error_object_or_empty_is_error(spark):
    v1, v2 = rec(err={"error_code": 1}, page=PAGE), rec(err={}, page=PAGE)
    p = parsed_of(spark, v1, v2)
    assert sorted(r["value"] for r in parse.error_records(p).collect()) == sorted([v1, v2])
    assert parse.page_rows(p).count() == 0
    assert topics(spark, v1, v2) == {parse.ERROR_TOPIC: 2}


def test_null_err_routes_normally(spark):
    v = json.dumps({"common": COMMON, "page": PAGE, "err": None, "ts": TS})
    assert topics(spark, v) == {parse.PAGE_TOPIC: 1}


def test_page_with_displays_and_actions(spark):
    v = rec(page=PAGE, displays=[DISPLAY, dict(DISPLAY, pos_id="3")], actions=[ACTION, ACTION, ACTION])
    assert topics(spark, v) == {parse.PAGE_TOPIC: 1, parse.DISPLAY_TOPIC: 2, parse.ACTION_TOPIC: 3}
    p = parsed_of(spark, v)
    page = parse.page_rows(p).first()
    assert page["mid"] == "mid_1" and page["user_id"] == "9" and page["province_id"] == "110000"
    assert page["operate_system"] == "iOS 13" and page["brand"] == "B"
    assert page["during_time"] == 1500 and page["sourceType"] == "query" and page["ts"] == TS


def test_start_only_and_start_with_page(spark):
    assert topics(spark, rec(start=START)) == {parse.START_TOPIC: 1}
    assert topics(spark, rec(start=START, page=PAGE)) == {parse.START_TOPIC: 1, parse.PAGE_TOPIC: 1}
    s = parse.start_rows(parsed_of(spark, rec(start=START))).first()
    assert (s["entry"], s["open_ad_id"], s["loading_time_ms"], s["open_ad_ms"], s["open_ad_skip_ms"]) == \
        ("icon", "4", 900, 2000, 0)


def test_nothing_routed(spark):
    assert topics(spark, rec(), rec(actions=[ACTION])) == {}


def test_empty_or_absent_displays(spark):
    assert topics(spark, rec(page=PAGE, displays=[])) == {parse.PAGE_TOPIC: 1}
    assert topics(spark, rec(page=PAGE)) == {parse.PAGE_TOPIC: 1}


def test_display_item_shadowing(spark):
    p = parsed_of(spark, rec(page=PAGE, displays=[DISPLAY]))
    d = parse.display_rows(p).first()
    assert d["page_item"] == "7" and d["display_item"] == "3" and d["ts"] == TS
    strict = parse.display_rows(p, strict_reference=True).first()
    assert strict["page_item"] == "3"


def test_action_ts_is_the_actions(spark):
    a = parse.action_rows(parsed_of(spark, rec(page=PAGE, actions=[ACTION]))).first()
    assert a["ts"] == ACTION["ts"] and a["action_id"] == "cart_add" and a["action_item"] == "7"


def test_malformed_and_missing_number(spark):
    p = parsed_of(spark, "{not json", rec(page={k: v for k, v in PAGE.items() if k != "during_time"}))
    assert [r["value"] for r in parse.bad_records(p).collect()] == ["{not json"]
    assert parse.page_rows(p).first()["during_time"] is None


def test_route_roundtrip_and_nulls_left_out(spark):
    v = rec(page=dict(PAGE, last_page_id=None))
    routed = parse.route_log(parsed_of(spark, v))
    msg = routed.first()["value"]
    assert "last_page_id" not in msg
    back = parse.read_topic_rows(routed, parse.PAGE_TOPIC).first()
    assert back["last_page_id"] is None and back["page_item"] == "7"
