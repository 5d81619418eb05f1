"""Batches end to end: the reference scenario, every kind of command, retries and invariants."""

from __future__ import annotations

import json
import random

import pytest
from builders import D

from sparkbourse.plans.settle import commit_batch, output_events, replay, settle_batch
from sparkbourse.sources.codec import decode_events, encode_events, split_corrupt
from sparkbourse.sources.events import LOG
from sparkbourse.sources.state import StateStore, seed_wallets

BALANCES = "walletId string, assetId string, amount decimal(36,16), blocked decimal(36,16)"


def submit(event_id, wallet, side, price, qty, market=("BTC", "ETH"), order_id="order_1"):
    return {
        "id": event_id,
        "orderCommand": {
            "id": "order_command_1",
            "orderId": order_id,
            "command": "SUBMIT",
            "causeId": order_id,
            "message": "",
            "order": {
                "id": order_id,
                "baseAssetId": market[0],
                "quoteAssetId": market[1],
                "walletId": wallet,
                "orderType": side,
                "price": price,
                "qty": qty,
            },
        },
    }


def cancel(event_id, order_id):
    return {"id": event_id, "orderCommand": {"id": f"c-{event_id}", "orderId": order_id, "causeId": order_id, "command": "CANCEL"}}


def deposit(event_id, wallet, asset, operation, amount):
    command = {"id": f"d-{event_id}", "causeId": "x", "walletId": wallet, "assetId": asset, "operation": operation, "amount": amount}
    return {"id": event_id, "walletCommand": command}


def log(spark, events, start=0):
    rows = [("k", e if isinstance(e, str) else json.dumps(e), start + i) for i, e in enumerate(events)]
    return spark.createDataFrame(rows, LOG)


def store(spark, tmp_path, balances=(), compact_every=10):
    s = StateStore(spark, str(tmp_path / "state"), compact_every)
    s.seed(wallets=seed_wallets(spark.createDataFrame([(w, a, D(x), D(0)) for w, a, x in balances], BALANCES)))
    return s


def wallets_of(s):
    return {(r.walletId, r.assetId): (r.amount, r.blocked) for r in s.load("wallets").collect() if r.held}


def orders_of(s):
    return {(r.walletId, r.seq): r for r in s.load("orders").collect()}


FUNDED = [("wallet_1", "ETH", 100), ("wallet_2", "BTC", 100)]


def test_two_orders_match(spark, tmp_path):
    s = store(spark, tmp_path, FUNDED)
    events = [submit("event_02", "wallet_1", "LIMIT_SELL", 0.05, 10.0), submit("event_01", "wallet_2", "LIMIT_BUY", 0.05, 10.0)]
    commit_batch(s, log(spark, events), 1)
    assert wallets_of(s) == {
        ("wallet_1", "BTC"): (D("0.5"), 0),
        ("wallet_1", "ETH"): (90, 0),
        ("wallet_2", "BTC"): (D("99.5"), 0),
        ("wallet_2", "ETH"): (10, 0),
    }
    orders = s.load("orders").collect()
    assert [(o.status, o.qty, o.qtyFilled) for o in orders] == [("FILLED", 0, 10)] * 2
    assert len({o.id for o in orders}) == 2
    tx = {r.walletId: r.n for r in s.load("wallets").groupBy("walletId").agg({"txCount": "sum"}).toDF("walletId", "n").collect()}
    assert tx == {"wallet_1": 3, "wallet_2": 3}


def test_commands_of_every_kind(spark, tmp_path):
    s = store(spark, tmp_path, [("a", "ETH", 100), ("b", "BTC", 100), ("c", "BTC", 1)])
    first = [
        submit("e0", "a", "LIMIT_SELL", 2, 10),
        submit("e1", "c", "LIMIT_BUY", 2, 10),  # needs 20 BTC, has 1
        deposit("e2", "c", "ETH", "CREDIT", 7),
        deposit("e3", "c", "ETH", "DEBIT", 8),  # more than there is
        '{"id": "e4", "orderCommand": ',
        {"id": "e5"},
        cancel("e6", "no-such-order"),
    ]
    commit_batch(s, log(spark, first), 1)
    orders = orders_of(s)
    assert set(orders) == {("a", 0)} and orders["a", 0].status == "PROCESSED"
    assert wallets_of(s) == {("a", "ETH"): (100, 10), ("b", "BTC"): (100, 0), ("c", "BTC"): (1, 0), ("c", "ETH"): (7, 0)}
    rejected = {(r.seq, r.reason, r.required, r.available) for r in s.feed("rejections").collect()}
    assert rejected == {
        (1, "not enough funds", 20, 1),
        (3, "not enough funds", 8, 7),
        (5, "no partition key", None, None),
        (6, "unknown order", None, None),
    }
    dead = s.feed("dead_letters").collect()
    assert [(r.seq, r.reason) for r in dead] == [(4, "unreadable JSON or number")]

    # A buyer above the asking price takes part of it: the price difference becomes available again.
    commit_batch(s, log(spark, [submit("e7", "b", "LIMIT_BUY", 3, 4)], 7), 2)
    assert wallets_of(s)["b", "BTC"] == (92, 0) and wallets_of(s)["b", "ETH"] == (4, 0)
    assert wallets_of(s)["a", "ETH"] == (96, 6) and wallets_of(s)["a", "BTC"] == (8, 0)
    rest = orders_of(s)["a", 0]
    assert (rest.status, rest.qty, rest.qtyFilled) == ("PROCESSED", 6, 4)

    # The partly filled order is cancelled: what is still blocked is released, the order leaves the store.
    commit_batch(s, log(spark, [cancel("e8", rest.id), cancel("e9", rest.id)], 8), 3)
    assert wallets_of(s)["a", "ETH"] == (96, 0)
    assert ("a", 0) not in orders_of(s)
    again = {(r.seq, r.reason) for r in s.feed("rejections", after=2).collect()}
    assert again == {(9, "already cancelled")}

    statuses = [(r.version, r.status) for r in s.feed("order_changes").filter(f"id = '{rest.id}'").orderBy("version", "phase").collect()]
    assert statuses == [(1, "CONFIRMED"), (1, "PROCESSED"), (2, "PROCESSED"), (3, "CANCELLED")]


def test_fill_command_from_outside(spark, tmp_path):
    s = store(spark, tmp_path, FUNDED)
    commit_batch(s, log(spark, [submit("e0", "wallet_2", "LIMIT_BUY", 0.2, 10)]), 1)
    (o,) = s.load("orders").collect()
    snapshot = {c: getattr(o, c) for c in ("id", "baseAssetId", "quoteAssetId", "walletId", "orderType", "status")}
    snapshot |= {"price": 0.2, "qty": 10.0}

    def fill(event_id, qty):
        command = {"id": f"f-{event_id}", "orderId": o.id, "causeId": "m", "command": "FILL", "fillQty": qty, "fillPrice": 0.15}
        return {"id": event_id, "orderCommand": command, "order": snapshot}

    commit_batch(s, log(spark, [fill("e1", 3.5), fill("e2", 11)], 1), 2)
    (o,) = s.load("orders").collect()
    assert (o.status, o.qty, o.qtyFilled) == ("PROCESSED", D("6.5"), D("3.5"))
    assert wallets_of(s)["wallet_2", "ETH"] == (D("3.5"), 0)
    assert wallets_of(s)["wallet_2", "BTC"] == (D("99.475"), D("1.3"))


def test_retry_changes_nothing(spark, tmp_path):
    s = store(spark, tmp_path, FUNDED)
    batch = log(spark, [submit("e0", "wallet_1", "LIMIT_SELL", 0.05, 10), submit("e1", "wallet_2", "LIMIT_BUY", 0.06, 4)])
    commit_batch(s, batch, 1)
    before = sorted(map(str, s.load("orders").collect())), sorted(map(str, s.load("wallets").collect()))
    commit_batch(s, batch, 1)
    assert before == (sorted(map(str, s.load("orders").collect())), sorted(map(str, s.load("wallets").collect())))
    assert s.latest() == 1


def random_log(seed, n):
    rng = random.Random(seed)
    events = []
    for i in range(n):
        wallet = f"w{rng.randrange(4)}"
        side = rng.choice(["LIMIT_BUY", "LIMIT_SELL"])
        events.append(submit(f"e{i}", wallet, side, rng.randint(1, 5), rng.randint(1, 9), ("B", f"Q{rng.randrange(2)}"), f"o{i}"))
    return events


@pytest.mark.parametrize("batch", [100, 12])
def test_invariants(spark, tmp_path, batch):
    balances = [(f"w{w}", a, 40) for w in range(4) for a in ("B", "Q0", "Q1")]
    s = store(spark, tmp_path, balances, compact_every=2)
    assert replay(s, log(spark, random_log(7, 30)), batch) == -(-30 // batch)
    held = s.load("wallets").collect()
    totals = {}
    for r in held:
        assert r.blocked >= 0 and r.amount - r.blocked >= 0
        totals[r.assetId] = totals.get(r.assetId, 0) + r.amount
    assert totals == {"B": 160, "Q0": 160, "Q1": 160}
    # What is blocked is exactly what the resting orders need.
    blocked = {}
    for o in s.load("orders").collect():
        asset, amount = (o.baseAssetId, o.qty * o.price) if o.orderType == "LIMIT_BUY" else (o.quoteAssetId, o.qty)
        blocked[o.walletId, asset] = blocked.get((o.walletId, asset), 0) + amount
        assert (o.status == "FILLED") == (o.qty == 0)
    assert {k: v for k, v in blocked.items() if v} == {(r.walletId, r.assetId): r.blocked for r in held if r.blocked}


def test_output_events_can_be_read_back(spark, tmp_path):
    s = store(spark, tmp_path, FUNDED)
    raw = log(spark, [submit("e0", "wallet_1", "LIMIT_SELL", 0.05, 10), submit("e1", "wallet_2", "LIMIT_BUY", 0.05, 4)])
    settled = settle_batch(split_corrupt(decode_events(raw))[0], s.load("orders"), s.load("wallets"))
    good, dead = split_corrupt(decode_events(encode_events(output_events(settled))))
    rows = good.select("key", "event.id", "event.order.status", "event.wallet.walletId", "event.ordersMatchCommand.qtyFilled").collect()
    assert dead.count() == 0
    assert sorted(r.status for r in rows if r.status) == ["CONFIRMED"] * 2 + ["FILLED"] + ["PROCESSED"] * 3
    assert {r.key for r in rows if r.status} == {"BTC-ETH"}
    assert sum(r.walletId is not None for r in rows) == 6
    assert [r.qtyFilled for r in rows if r.qtyFilled is not None] == [4]


def test_fills_beyond_what_is_open_are_turned_down(spark, tmp_path):
    s = store(spark, tmp_path, FUNDED)
    commit_batch(s, log(spark, [submit("e0", "wallet_2", "LIMIT_BUY", 0.2, 10)]), 1)
    (o,) = s.load("orders").collect()
    snapshot = {c: getattr(o, c) for c in ("id", "baseAssetId", "quoteAssetId", "walletId", "orderType", "status")}
    snapshot |= {"price": 0.2, "qty": 10.0}

    def fill(event_id, qty, order_id):
        command = {"id": f"f-{event_id}", "orderId": order_id, "causeId": "m", "command": "FILL", "fillQty": qty, "fillPrice": 0.2}
        return {"id": event_id, "orderCommand": command, "order": snapshot | {"id": order_id}}

    events = [fill("e1", 3, o.id), fill("e2", 5, o.id), fill("e3", 8, o.id), fill("e4", 1, "no-such-order")]
    commit_batch(s, log(spark, events, 1), 2)
    (left,) = s.load("orders").collect()
    assert (left.status, left.qty, left.qtyFilled) == ("PROCESSED", 2, 8)
    assert wallets_of(s)["wallet_2", "BTC"] == (D("98.4"), D("0.4"))
    changes = s.feed("order_changes", after=1).orderBy("seq").collect()
    assert [(r.seq, r.qty, r.qtyFilled) for r in changes] == [(1, 7, 3), (2, 2, 8)]
    turned_down = {(r.seq, r.reason) for r in s.feed("rejections", after=1).collect()}
    assert turned_down == {(3, "more than the open quantity"), (4, "unknown order")}

    commit_batch(s, log(spark, [fill("e5", 2, o.id)], 5), 3)
    (left,) = s.load("orders").collect()
    assert (left.status, left.qty, left.qtyFilled) == ("FILLED", 0, 10)


def test_an_event_sent_twice_makes_two_orders(spark, tmp_path):
    s = store(spark, tmp_path, FUNDED)
    twice = submit("e0", "wallet_1", "LIMIT_SELL", 2, 10)
    commit_batch(s, log(spark, [twice, twice]), 1)
    assert len({r.id for r in s.load("orders").collect()}) == 2
    assert wallets_of(s)["wallet_1", "ETH"] == (100, 20)


def test_other_events_pass_through_once(spark, tmp_path):
    s = store(spark, tmp_path, FUNDED)
    order = submit("x", "wallet_1", "LIMIT_SELL", 2, 10)["orderCommand"]["order"]
    match = {"matchId": "m", "leftOrder": order, "rightOrder": order, "qtyFilled": 1.0, "price": 2.0}
    commit_batch(s, log(spark, [{"id": "e0", "order": order}, {"id": "e1", "ordersMatchCommand": match}, {"id": "e2"}]), 1)
    published = s.feed("output").select("key", "seq", "event.id").collect()
    assert sorted(tuple(r) for r in published) == [("BTC-ETH", 0, "e0"), ("BTC-ETH", 1, "e1")]
    assert s.load("orders").count() == 0


def test_records_of_a_match_and_counts_of_a_wallet(spark, tmp_path):
    s = store(spark, tmp_path, [*FUNDED, ("w3", "BTC", 100)])
    commit_batch(s, log(spark, [submit("e0", "wallet_1", "LIMIT_SELL", 2, 10), submit("e1", "wallet_2", "LIMIT_BUY", 2, 4)]), 1)
    commit_batch(s, log(spark, [submit("e2", "w3", "LIMIT_BUY", 3, 2)], 2), 2)
    events = s.feed("output").filter("event.ordersMatchCommand is not null").select("seq", "event.ordersMatchCommand.*").collect()
    makers = {r.seq: (r.rightOrder.qty, r.rightOrder.qtyFilled) for r in events}
    assert makers == {1: (10, 0), 2: (6, 4)}
    counts = s.feed("output").filter("event.wallet.walletId = 'wallet_1'").select("event.wallet.txCount").collect()
    assert sorted(r.txCount for r in counts) == [1, 2, 3, 4, 5]
