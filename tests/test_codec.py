"""Reading and writing events as JSON."""

from __future__ import annotations

import json

import pytest
from builders import D

from sparkbourse.sources import codec, events
from sparkbourse.sources.events import LOG

ORDER = {"id": "o-17", "baseAssetId": "CHF", "quoteAssetId": "XAU", "walletId": "anna", "orderType": "LIMIT_BUY"}
COMMAND = {"id": "k-3", "orderId": "o-17", "command": "FILL", "causeId": "why"}


def decoded(spark, *values):
    raw = spark.createDataFrame([("k", v if isinstance(v, str) else json.dumps(v), i) for i, v in enumerate(values)], LOG)
    return codec.decode_events(raw)


def test_defaults(spark):
    value = {"id": "e", "orderCommand": COMMAND | {"order": ORDER}, "order": ORDER | {"price": 31.25, "qty": 6.0, "status": "CONFIRMED"}}
    event = decoded(spark, value).first().event
    inner, outer = event.orderCommand.order, event.order
    assert (inner.price, inner.qty, inner.qtyFilled, inner.status, inner.message) == (1, 0, 0, "NEW", "")
    assert (outer.price, outer.qty, outer.status) == (D("31.25"), 6, "CONFIRMED")
    assert (event.orderCommand.fillQty, event.orderCommand.fillPrice) == (0, 0)
    assert event.walletCommand is None and event.wallet is None and event.ordersMatchCommand is None


def test_every_record_type_round_trips(spark):
    wallet = {"walletId": "ben", "assets": {"XAU": {"assetId": "XAU", "amount": 8.75, "blocked": 4.5}}, "txCount": 12}
    match = {"matchId": "m-5", "qtyFilled": 6.0, "price": 30.5, "leftOrder": ORDER, "rightOrder": ORDER | {"id": "o-18"}}
    credit = {"id": "k-9", "causeId": "salary", "walletId": "anna", "assetId": "CHF", "operation": "CREDIT", "amount": 250.0}
    values = [{"id": "a", "wallet": wallet}, {"id": "b", "ordersMatchCommand": match}, {"id": "c", "walletCommand": credit}]
    good, dead = codec.split_corrupt(decoded(spark, *values))
    assert dead.count() == 0
    text = codec.encode_events(good)
    again = codec.split_corrupt(codec.decode_events(text))[0]
    assert sorted(map(str, again.select("event").collect())) == sorted(map(str, good.select("event").collect()))
    assert all("null" not in r.value and "orderCommand" not in r.value for r in text.collect())


@pytest.mark.parametrize(
    ("value", "reason"),
    [
        ('{"id": "x", ', "unreadable JSON or number"),
        ("", "unreadable JSON or number"),
        ("[1, 2]", "unreadable JSON or number"),
        ({"id": "x", "order": ORDER | {"price": 1e30}}, "unreadable JSON or number"),
        ({"id": "x", "order": ORDER | {"price": "dear"}}, "unreadable JSON or number"),
        ({"id": "x", "order": ORDER | {"orderType": "MARKET"}}, "unknown orderType in order"),
        ({"id": "x", "orderCommand": COMMAND | {"command": "UNDO"}}, "unknown command in orderCommand"),
        ({"id": "x", "order": {k: v for k, v in ORDER.items() if k != "walletId"}}, "missing field in order"),
        ({"id": "x", "walletCommand": {"id": "c"}}, "missing field in walletCommand"),
    ],
)
def test_bad_records_are_set_aside(spark, value, reason):
    good, dead = codec.split_corrupt(decoded(spark, value, {"id": "fine", "order": ORDER}))
    assert [(r.seq, r.reason) for r in dead.collect()] == [(0, reason)]
    assert [r.event.id for r in good.collect()] == ["fine"]


def test_event_without_id_gets_a_stable_one(spark):
    first, second = (decoded(spark, {"order": ORDER}, {"order": ORDER}).select("event.id").collect() for _ in range(2))
    assert first == second and len({r.id for r in first}) == 2


def test_replace_parts(spark):
    from pyspark.sql import functions as F

    frame = decoded(spark, {"id": "x", "order": ORDER, "orderCommand": COMMAND})
    changed = codec.replace_parts(F.col("event"), order=F.col("event.order").withField("status", F.lit("FILLED")), orderCommand=None)
    event = frame.select(changed.alias("event")).first().event
    assert event.order.status == "FILLED" and event.orderCommand is None and event.id == "x"


def test_json_files_and_logs(spark, tmp_path):
    for name in ("b", "a"):
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / "in" / f"{name}.json").write_text(json.dumps({"id": name, "order": ORDER}, indent=2))
    raw = events.read_json_files(spark, str(tmp_path / "in"))
    good = codec.split_corrupt(codec.decode_events(raw))[0]
    assert [r.event.id for r in good.orderBy("seq").collect()] == ["a", "b"]
    log = str(tmp_path / "log")
    events.write_events(good, log)
    printed = events.print_log(events.read_events(spark, log)).collect()
    assert [json.loads(r.value)["id"] for r in printed] == ["a", "b"]
