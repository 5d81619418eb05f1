"""Matching: the order-book cases, random books against plain loops, and both against each other."""

from __future__ import annotations

import brute
import pytest
from builders import D, order, orders_frame, random_orders

from sparkbourse.operators.matching import match_snapshot, to_fills
from sparkbourse.operators.sequential import match_sequential

OPERATORS = [match_snapshot, match_sequential]
SELL, BUY = "LIMIT_SELL", "LIMIT_BUY"

# name, taker (side, price, qty), makers (price, qty) on the other side, expected matches (qty, price)
CASES = [
    ("best price for a seller", (SELL, "0.2", 10), [("0.19", 54), ("0.2", 27), ("0.25", 2), ("0.3", 8)], [(8, "0.3"), (2, "0.25")]),
    ("best price for a buyer", (BUY, "0.2", 10), [("0.21", 54), ("0.2", 27), ("0.15", 2), ("0.1", 8)], [(8, "0.1"), (2, "0.15")]),
    ("several makers", (BUY, "0.2", 10), [("0.1", 3), ("0.15", 15), ("0.2", 27)], [(3, "0.1"), (7, "0.15")]),
    ("only overlapping prices", (BUY, "0.2", 10), [("0.1", 1), ("0.15", 4), ("0.25", 3)], [(1, "0.1"), (4, "0.15")]),
    ("book used up", (BUY, "0.2", 10), [("0.1", 1), ("0.15", 4), ("0.2", 3)], [(1, "0.1"), (4, "0.15"), (3, "0.2")]),
    ("smaller quantity decides", (BUY, "0.1", 10), [("0.1", "3.5")], [("3.5", "0.1")]),
    ("equal, seller", (SELL, "0.1", 10), [("0.1", 10)], [(10, "0.1")]),
    ("equal, buyer", (BUY, "0.1", 10), [("0.1", 10)], [(10, "0.1")]),
    ("no overlap, seller", (SELL, "0.11", 10), [("0.1", 10)], []),
    ("no overlap, buyer", (BUY, "0.1", 10), [("0.11", 10)], []),
    ("maker's price, seller", (SELL, "0.1", 10), [("0.2", 10)], [(10, "0.2")]),
    ("maker's price, buyer", (BUY, "0.3", 10), [("0.1", 10)], [(10, "0.1")]),
    ("zero demand", (BUY, "0.3", 0), [("0.1", 10)], []),
]


def found(df):
    return sorted((r.takerId, r.makerId, r.qtyFilled, r.price) for r in df.collect())


@pytest.mark.parametrize("operator", OPERATORS)
def test_order_book_cases(spark, operator):
    takers, book, expected = [], [], []
    for name, (side, price, qty), makers, matches in CASES:
        market = ("BTC", name)
        takers.append(order(name, side, price, qty, status="CONFIRMED", market=market))
        book += [
            order(f"{name}/{p}", brute.COUNTER[side], p, q, market=market) for p, q in makers
        ]
        expected += [(name, f"{name}/{p}", D(q), D(p)) for q, p in matches]
    assert found(operator(orders_frame(spark, takers), orders_frame(spark, book))) == sorted(expected)


@pytest.mark.parametrize("operator", OPERATORS)
def test_own_and_closed_orders_do_not_trade(spark, operator):
    taker = order("t", BUY, "5", 10, "me", "CONFIRMED", 9)
    book = [
        order("own", SELL, "1", 4, "me"),
        order("filled", SELL, "1", 4, status="FILLED"),
        order("other", SELL, "2", 4),
        order("own-2", SELL, "3", 4, "me"),
        order("last", SELL, "4", 9),
    ]
    matches = found(operator(orders_frame(spark, [taker]), orders_frame(spark, book)))
    assert matches == [("t", "last", D(6), D(4)), ("t", "other", D(4), D(2))]


@pytest.mark.parametrize(("limit", "seed"), [(1_000_000, 0), (1_000_000, 1), (12, 2)])
def test_snapshot_equals_loop(spark, small_groups, seed, limit):
    small_groups(limit)
    takers, book = random_orders(seed, 60, 150, wallets=3, markets=2)
    got = found(match_snapshot(orders_frame(spark, takers), orders_frame(spark, book)))
    assert got == sorted(brute.match_each(takers, book))


@pytest.mark.parametrize(
    ("limit", "seed", "count"), [(1_000_000, 0, 60), (1_000_000, 1, 60), (20, 2, 12), (3, 3, 4)]
)
def test_sequential_equals_loop(spark, small_groups, limit, seed, count):
    small_groups(limit)
    takers, book = random_orders(seed, count, 3 * count, wallets=3, markets=2)
    got = found(match_sequential(orders_frame(spark, takers), orders_frame(spark, book)))
    assert got == sorted(brute.match_in_turn(takers, book))


def test_both_agree_on_one_taker_per_market(spark):
    takers, book = random_orders(5, 40, 200, wallets=5, markets=20)
    single = list({t["quoteAssetId"]: t for t in takers}.values())
    frames = orders_frame(spark, single), orders_frame(spark, book)
    assert found(match_snapshot(*frames)) == found(match_sequential(*frames))


def test_time_priority(spark):
    taker = order("t", BUY, "1", 3, status="CONFIRMED", seq=9)
    book = [order("a", SELL, "1", 5, seq=2), order("b", SELL, "1", 5, seq=1)]
    frames = orders_frame(spark, [taker]), orders_frame(spark, book)
    for operator in OPERATORS:
        assert [m[1] for m in found(operator(*frames))] == ["a"]
        assert [m[1] for m in found(operator(*frames, time_priority=True))] == ["b"]


@pytest.mark.parametrize("limit", [3, 1_000_000])
def test_oldest_of_three_makers_trades_first(spark, small_groups, limit):
    small_groups(limit)
    taker = order("t", BUY, "1", 5, status="CONFIRMED", seq=9)
    book = [order(name, SELL, "1", 10, wallet=f"w-{name}", seq=age) for name, age in (("a", 3), ("b", 2), ("c", 1))]
    frames = orders_frame(spark, [taker]), orders_frame(spark, book)
    for operator in OPERATORS:
        assert [m[1] for m in found(operator(*frames, time_priority=True))] == ["c"]


@pytest.mark.parametrize("limit", [20, 1_000_000])
@pytest.mark.parametrize("seed", [3, 4])
def test_sequential_by_age_equals_loop(spark, small_groups, limit, seed):
    small_groups(limit)
    takers, book = random_orders(seed, 40, 160, wallets=4, markets=2)
    got = found(match_sequential(orders_frame(spark, takers), orders_frame(spark, book), time_priority=True))
    assert got == sorted(brute.match_in_turn(takers, book, by_age=True))


def test_no_crossed_book_after_sequential_match(spark):
    takers, book = random_orders(11, 60, 0, wallets=50, markets=1)
    matches = found(match_sequential(orders_frame(spark, takers), orders_frame(spark, book)))
    left = {t["id"]: t["qty"] for t in takers}
    for taker, maker, filled, _ in matches:
        left[taker] -= filled
        left[maker] -= filled
    assert min(left.values()) >= 0
    resting = [t for t in takers if left[t["id"]] > 0]
    crossed = [
        (b["id"], s["id"])
        for b in resting
        for s in resting
        if b["orderType"] == BUY and s["orderType"] == SELL and b["price"] >= s["price"] and b["walletId"] != s["walletId"]
    ]
    assert not crossed


def test_fills_of_a_match(spark):
    frames = orders_frame(spark, [order("t", BUY, "2", 3, status="CONFIRMED")]), orders_frame(spark, [order("m", SELL, "1", 5)])
    fills = {r.orderId: r for r in to_fills(match_snapshot(*frames)).collect()}
    assert set(fills) == {"t", "m"}
    assert {r.command for r in fills.values()} == {"FILL"}
    assert {(r.fillQty, r.fillPrice) for r in fills.values()} == {(D(3), D(1))}
    assert len({r.commandId for r in fills.values()}) == 2 and len({r.causeId for r in fills.values()}) == 1
