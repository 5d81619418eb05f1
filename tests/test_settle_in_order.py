"""Settlement against one event after the other, however the log is cut into batches."""

from __future__ import annotations

import random
from decimal import Decimal

import pytest
from builders import D
from in_turn import Exchange
from test_settle import cancel, deposit, log, orders_of, store, submit, wallets_of

from sparkbourse.plans.settle import commit_batch, replay
from sparkbourse.sources.codec import decode_events
from sparkbourse.operators import lifecycle


def made_ids(spark, events):
    """The id that each submit's order gets, by position."""
    rows = lifecycle.check_submits(lifecycle.commands_of(decode_events(log(spark, events)).filter("reason is null")))
    return {r.seq: r.orderId for r in rows.select("seq", "orderId").collect()}


def random_events(spark, seed, n, wallets=5, markets=2, poor=True):
    """Submits, then cancels and fills that name them, and wallet commands, in a mixed order."""
    rng = random.Random(seed)
    plan = [rng.choices(["submit", "cancel", "fill", "wallet"], [8, 2, 2, 2])[0] for _ in range(n)]
    events, shape = [None] * n, {}
    for i, kind in enumerate(plan):
        if kind == "submit":
            side, price, qty, market = rng.choice(["LIMIT_BUY", "LIMIT_SELL"]), rng.randint(1, 5), rng.randint(1, 9), ("B", f"Q{rng.randrange(markets)}")
            shape[i] = (f"w{rng.randrange(wallets)}", side, price, qty, market)
            events[i] = submit(f"e{i}", *shape[i], f"o{i}")
        elif kind == "wallet":
            operation = rng.choice(["CREDIT", "CREDIT", "DEBIT", "BLOCK"])
            events[i] = deposit(f"e{i}", f"w{rng.randrange(wallets)}", rng.choice(["B", "Q0", "Q1"]), operation, rng.randint(1, 12))
        else:
            events[i] = cancel(f"e{i}", "none")
    ids, steps = made_ids(spark, events), []
    positions = sorted(ids)
    for i, kind in enumerate(plan):
        if kind == "submit":
            steps.append(("submit", i, ids[i], *shape[i]))
        elif kind == "wallet":
            c = events[i]["walletCommand"]
            steps.append(("wallet", i, c["walletId"], c["assetId"], c["operation"], c["amount"]))
        else:
            # Mostly an earlier order, now and then one that comes later or never.
            target = rng.choice(positions[: max(1, sum(p < i for p in positions))] if rng.random() < 0.9 else positions)
            if kind == "cancel":
                events[i] = cancel(f"e{i}", ids[target])
                steps.append(("cancel", i, ids[target]))
            else:
                wallet, side, price, qty, market = shape[target]
                ask = rng.randint(1, qty + 1)
                command = {"id": f"f-e{i}", "orderId": ids[target], "causeId": "m", "command": "FILL", "fillQty": ask, "fillPrice": price}
                order = dict(id=ids[target], baseAssetId=market[0], quoteAssetId=market[1], walletId=wallet, orderType=side, price=price, qty=qty, status="PROCESSED")
                events[i] = {"id": f"e{i}", "orderCommand": command, "order": order}
                copy = dict(wallet=wallet, buys=side == "LIMIT_BUY", price=Decimal(price), qty=Decimal(qty), base=market[0], quote=market[1])
                steps.append(("fill", i, ids[target], ask, price, copy))
    return events, steps


def balances(wallets=5, amount=12):
    return [(f"w{w}", a, amount) for w in range(wallets) for a in ("B", "Q0", "Q1")]


def state(s):
    held = {(r.walletId, r.assetId): (r.amount, r.blocked) for r in s.load("wallets").collect() if r.held}
    return held, {r.id: (r.qty, r.qtyFilled, r.status, r.seq) for r in s.load("orders").collect()}


def wanted(exchange):
    orders = {o["id"]: (o["qty"], o["filled"], "PROCESSED" if o["qty"] else "FILLED", o["seq"]) for o in exchange.orders.values()}
    return {k: tuple(v) for k, v in exchange.funds.items()}, orders


@pytest.mark.parametrize("seed,n,batches,by_age", [(4, 160, [160], False), (2, 40, [17], True)])
def test_equal_to_one_event_at_a_time(spark, tmp_path, seed, n, batches, by_age):
    events, steps = random_events(spark, seed, n)
    exchange = Exchange(balances(), by_age)
    for kind, seq, *rest in steps:
        getattr(exchange, kind)(seq, *rest)
    for size in batches:
        s = store(spark, tmp_path / str(size), balances())
        replay(s, log(spark, events), size, by_age)
        assert state(s) == wanted(exchange)
        got = {r.seq: (r.reason, r.available) for r in s.feed("rejections").collect()}
        if size < n:  # an order cancelled in an earlier batch is not known any more
            for rejections in (got, exchange.refused):
                for seq, (reason, available) in rejections.items():
                    rejections[seq] = ("gone" if reason in ("already cancelled", "unknown order", "order is not open") else reason, available)
        assert got == exchange.refused
    assert any(r[0] == "not enough funds" for r in exchange.refused.values())


def test_equal_with_hot_markets_and_wallets(spark, tmp_path, small_groups):
    events, steps = random_events(spark, 5, 16, wallets=3, markets=1)
    exchange = Exchange(balances(3))
    for kind, seq, *rest in steps:
        getattr(exchange, kind)(seq, *rest)
    small_groups(6)
    s = store(spark, tmp_path, balances(3))
    commit_batch(s, log(spark, events), 1)
    assert state(s) == wanted(exchange)
    assert {r.seq: (r.reason, r.available) for r in s.feed("rejections").collect()} == exchange.refused


def test_proceeds_pay_for_a_later_order(spark, tmp_path):
    s = store(spark, tmp_path, [("a", "ETH", 10), ("b", "BTC", 20)])
    events = [
        submit("e0", "a", "LIMIT_SELL", 2, 10),
        submit("e1", "a", "LIMIT_BUY", 1, 5),  # nothing earned yet
        submit("e2", "b", "LIMIT_BUY", 2, 10),
        submit("e3", "a", "LIMIT_BUY", 1, 5),
        submit("e4", "b", "LIMIT_SELL", 1, 5),  # what it just bought
    ]
    commit_batch(s, log(spark, events), 1)
    assert wallets_of(s) == {("a", "BTC"): (15, 0), ("a", "ETH"): (5, 0), ("b", "BTC"): (5, 0), ("b", "ETH"): (5, 0)}
    assert {(r.seq, r.reason) for r in s.feed("rejections").collect()} == {(1, "not enough funds")}


def test_a_long_chain_of_earnings(spark, tmp_path):
    # Each wallet can only buy from the one before with what it got from the one after: a turn for every link.
    n, events = 3, []
    for i in range(n):
        events.append(submit(f"s{i}", f"w{i}", "LIMIT_SELL", 1, 1, (f"A{i + 1}", f"A{i}")))
    for i in reversed(range(n)):
        events.append(submit(f"b{i}", f"w{i + 1}", "LIMIT_BUY", 1, 1, (f"A{i + 1}", f"A{i}")))
    start = [(f"w{i}", f"A{i}", 1) for i in range(n)] + [(f"w{n}", f"A{n}", 1)]
    s = store(spark, tmp_path, start)
    commit_batch(s, log(spark, events), 1)
    held = {k: v for k, v in wallets_of(s).items() if any(v)}
    # w0 sold A0 for A1 only if w1 could pay with A1, which it sold to w2 ...; w1's A1 is blocked in its own sale until then.
    assert all(blocked >= 0 for _, blocked in held.values())
    exchange = Exchange(start)
    ids = made_ids(spark, events)
    for i, e in enumerate(events):
        o = e["orderCommand"]["order"]
        exchange.submit(i, ids[i], o["walletId"], o["orderType"], o["price"], o["qty"], (o["baseAssetId"], o["quoteAssetId"]))
    assert state(s) == wanted(exchange)


def test_a_cancel_after_a_trade_releases_the_rest(spark, tmp_path):
    s = store(spark, tmp_path, [("a", "ETH", 10), ("b", "BTC", 20)])
    first = [submit("e0", "a", "LIMIT_SELL", 2, 10), submit("e1", "b", "LIMIT_BUY", 2, 4)]
    ids = made_ids(spark, first)
    later = [cancel("e2", ids[0]), submit("e3", "b", "LIMIT_BUY", 2, 4), cancel("e4", ids[0]), cancel("e5", ids[1])]
    commit_batch(s, log(spark, first + later), 1)
    assert wallets_of(s) == {("a", "ETH"): (6, 0), ("a", "BTC"): (8, 0), ("b", "BTC"): (12, 8), ("b", "ETH"): (4, 0)}
    assert {(r.seq, r.reason) for r in s.feed("rejections").collect()} == {(4, "already cancelled"), (5, "order is not open")}
    changes = s.feed("order_changes").filter(f"id = '{ids[0]}'").orderBy("seq", "phase").collect()
    assert [(r.seq, r.status, r.qty, r.qtyFilled) for r in changes] == [(0, "CONFIRMED", 10, 0), (0, "PROCESSED", 10, 0), (1, "PROCESSED", 6, 4), (2, "CANCELLED", 6, 4)]
    assert {k[0] for k in orders_of(s)} == {"b"}


@pytest.mark.parametrize("size", [2])
def test_fills_that_fit_are_taken(spark, tmp_path, size):
    s = store(spark, tmp_path, [("b", "BTC", 100)])
    commit_batch(s, log(spark, [submit("e0", "b", "LIMIT_BUY", 1, 10)]), 1)
    (o,) = s.load("orders").collect()
    order = {c: getattr(o, c) for c in ("id", "baseAssetId", "quoteAssetId", "walletId", "orderType", "status")} | {"price": 1, "qty": 10}
    events = [{"id": f"f{i}", "orderCommand": {"id": f"f{i}", "orderId": o.id, "causeId": "m", "command": "FILL", "fillQty": q, "fillPrice": 1}, "order": order} for i, q in enumerate((8, 8, 2))]
    for version, start in enumerate(range(0, 3, size), 2):
        commit_batch(s, log(spark, events[start : start + size], 1 + start), version)
    (left,) = s.load("orders").collect()
    assert (left.status, left.qty, left.qtyFilled) == ("FILLED", 0, 10)
    assert {(r.seq, r.reason) for r in s.feed("rejections").collect()} == {(2, "more than the open quantity")}
    assert wallets_of(s)["b", "ETH"] == (D(10), 0)


def test_scratch_is_freed_after_a_commit(spark, tmp_path):
    from pathlib import Path

    from sparkbourse.session import scratch_dir

    folder = Path(scratch_dir(spark).removeprefix("file:")) / "staged" / spark.sparkContext.applicationId
    s = store(spark, tmp_path, [("a", "ETH", 10)])
    before = set(folder.glob("*")) if folder.exists() else set()
    commit_batch(s, log(spark, [submit("e0", "a", "LIMIT_SELL", 2, 10)]), 1)
    assert set(folder.glob("*")) <= before


def test_a_wallet_event_has_the_whole_wallet(spark, tmp_path):
    s = store(spark, tmp_path, [("a", "ETH", 10), ("a", "DOGE", 7), ("b", "BTC", 20)])
    commit_batch(s, log(spark, [submit("e0", "a", "LIMIT_SELL", 2, 4), submit("e1", "b", "LIMIT_BUY", 2, 3), deposit("e2", "b", "BTC", "CREDIT", 1)]), 1)
    rows = s.feed("output").filter("event.wallet is not null").select("seq", "event.wallet.*").collect()
    seen = {}
    for r in sorted(rows, key=lambda r: (r.seq, r.txCount)):
        seen.setdefault(r.walletId, []).append({k: (v.amount, v.blocked) for k, v in r.assets.items()})
    assert seen["a"][0] == {"ETH": (10, 4), "DOGE": (7, 0)} and seen["a"][-1] == {"ETH": (7, 1), "DOGE": (7, 0), "BTC": (6, 0)}
    assert seen["b"][0] == {"BTC": (20, 6)} and seen["b"][-1] == {"BTC": (15, 0), "ETH": (3, 0)}


def test_earnings_within_a_market_need_no_further_turn(spark, monkeypatch):
    from sparkbourse.plans import settle
    from sparkbourse.schemas import ORDER_STATE
    from sparkbourse.sources.codec import split_corrupt
    from sparkbourse.sources.state import seed_wallets
    from test_settle import BALANCES

    passes = []
    through = settle.settle_through
    monkeypatch.setattr(settle, "settle_through", lambda *args: passes.append(1) or through(*args))
    # "a" and "b" hand the same five units to and fro: each order is paid for with what the one before it earned.
    events = []
    for i in range(3):
        events += [submit(f"s{i}", "ab"[i % 2], "LIMIT_SELL", 1, 5), submit(f"b{i}", "ba"[i % 2], "LIMIT_BUY", 1, 5)]
    start = spark.createDataFrame([("a", "ETH", D(5), D(0)), ("b", "BTC", D(5), D(0))], BALANCES)
    good = split_corrupt(decode_events(log(spark, events)))[0]
    settled = settle.settle_batch(good, spark.createDataFrame([], ORDER_STATE), seed_wallets(start))
    assert len(passes) == 1
    assert sorted(r.seq for r in settled.matches.collect()) == [1, 3, 5]


def settled_of(spark, events, start):
    from sparkbourse.plans import settle
    from sparkbourse.schemas import ORDER_STATE
    from sparkbourse.sources.codec import split_corrupt
    from sparkbourse.sources.state import seed_wallets
    from test_settle import BALANCES

    good = split_corrupt(decode_events(log(spark, events)))[0]
    return settle.settle_batch(good, spark.createDataFrame([], ORDER_STATE), seed_wallets(spark.createDataFrame(start, BALANCES)))


def test_markets_that_share_funds_are_worked_through_together(spark, monkeypatch):
    from sparkbourse.operators import ledger
    from sparkbourse.plans import settle

    passes, decisions = [], []
    through, decide = settle.settle_through, ledger.decide
    monkeypatch.setattr(settle, "settle_through", lambda *args: passes.append(1) or through(*args))
    monkeypatch.setattr(ledger, "decide", lambda *args: decisions.append(1) or decide(*args))
    # "a" earns in one market what it pays with in the other, and the other way round.
    first, second = ("BTC", "ETH"), ("BTC", "LTC")
    events = []
    for i in range(2):
        events += [submit(f"s{i}", "a", "LIMIT_SELL", 1, 5, first), submit(f"b{i}", "b", "LIMIT_BUY", 1, 5, first)]
        events += [submit(f"t{i}", "c", "LIMIT_SELL", 1, 5, second), submit(f"u{i}", "a", "LIMIT_BUY", 1, 5, second)]
    start = [("a", "ETH", D(10), D(0)), ("b", "BTC", D(10), D(0)), ("c", "LTC", D(10), D(0))]
    settled = settled_of(spark, events, start)
    assert sorted(r.seq for r in settled.matches.collect()) == [1, 3, 5, 7]
    assert len(passes) == 1
    # Orders need no decision on wallets; those who ask for wallets get it.
    assert {r.status for r in settled.order_delta.collect()} == {"FILLED"} and not decisions
    held = {(r.walletId, r.assetId): (r.amount, r.blocked) for r in settled.wallet_delta.collect() if r.amount}
    assert held == {("a", "LTC"): (10, 0), ("b", "ETH"): (10, 0), ("c", "BTC"): (10, 0)} and len(decisions) == 1


def test_equal_where_teams_share_funds(spark, tmp_path, small_groups):
    events, steps = random_events(spark, 6, 60, wallets=3)
    exchange = Exchange(balances(3))
    for kind, seq, *rest in steps:
        getattr(exchange, kind)(seq, *rest)
    small_groups(50)  # no market is hot, both together are more than a core's share
    s = store(spark, tmp_path, balances(3))
    commit_batch(s, log(spark, events), 1)
    assert state(s) == wanted(exchange)
    assert {r.seq: (r.reason, r.available) for r in s.feed("rejections").collect()} == exchange.refused


def test_wallet_changes_are_the_same_for_hot_wallets(spark, small_groups):
    from pyspark.sql import functions as F

    from sparkbourse.plans.settle import whole_wallets

    events = random_events(spark, 7, 30, wallets=2, markets=1)[0]
    settled = settled_of(spark, events, [(w, a, D(v), D(0)) for w, a, v in balances(2)])
    seen = []
    for limit in (1_000_000, 3):
        small_groups(limit)
        settled.__dict__.pop("wallet_changes", None)
        changes = whole_wallets(settled.wallet_changes, settled.wallets_before)
        seen.append(sorted(map(str, changes.withColumn("assets", F.map_entries("assets")).collect())))
    assert len(seen[0]) == 20 and seen[0] == seen[1]


def test_the_text_of_usable_records_is_not_kept(spark):
    from sparkbourse.sources.codec import only_needed

    broken = log(spark, [submit("e0", "a", "LIMIT_SELL", 2, 10)]).unionByName(spark.createDataFrame([("k", "{", 9)], "key string, value string, seq long"))
    rows = {r.seq: (r.value, r.event.id) for r in only_needed(decode_events(broken)).collect() if r.seq in (0, 9)}
    assert rows[0] == (None, "e0") and rows[9][0] == "{"


def test_no_key_is_counted_where_none_can_be_hot(spark, small_groups):
    from sparkbourse.operators.running import has_hot_key

    rows = spark.range(40).selectExpr("cast(id % 20 as string) as k")
    for limit, hot in ((1000, False), (2, False), (1, True)):
        small_groups(limit)
        assert has_hot_key(rows, ["k"]) is hot
