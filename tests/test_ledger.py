"""Wallet ledger against plain loops, with ordinary and with hot keys."""

from __future__ import annotations

import brute
import pytest
from builders import D, commands_frame, random_commands

from sparkbourse.functions import wallets
from sparkbourse.operators import ledger
from sparkbourse.sources.state import seed_wallets

BALANCES = "walletId string, assetId string, amount decimal(36,16), blocked decimal(36,16)"


def seeds(spark, rows):
    return seed_wallets(spark.createDataFrame([(w, a, D(x), D(b)) for w, a, x, b in rows], BALANCES))


def balances(frame):
    return {(r.walletId, r.assetId): (r.amount, r.blocked, r.txCount) for r in frame.collect()}


@pytest.mark.parametrize(("limit", "seed"), [(1_000_000, 0), (40, 1), (9, 2)])
def test_fold_equals_loop(spark, small_groups, limit, seed):
    small_groups(limit)
    commands = random_commands(seed, 160)
    expected, turned_down = brute.fold(commands, {("w0", "a0"): (D(30), D(5), 0)})
    start = seeds(spark, [("w0", "a0", 30, 5)])
    decided = ledger.decide(commands_frame(spark, commands), start)
    assert sorted(r.seq for r in ledger.rejections(decided).collect()) == turned_down and turned_down
    assert balances(ledger.apply_effects(start, ledger.effects(decided))) == expected


@pytest.mark.parametrize("limit", [1_000_000, 10])
def test_running_balances_and_available_funds(spark, small_groups, limit):
    small_groups(limit)
    commands = random_commands(4, 60, wallets=1, assets=1)
    decided = ledger.decide(commands_frame(spark, commands))
    running = {r.seq: (r.balance, r.blockedBalance, r.txCount) for r in ledger.running_balances(decided).collect()}
    short = {r.seq: (r.required, r.available) for r in ledger.rejections(decided).collect()}
    for n in range(len(commands)):
        after, turned_down = brute.fold(commands[: n + 1])
        amount, blocked, tx = after["w0", "a0"]
        if n in turned_down:
            assert short[n] == (commands[n]["amount"], amount - blocked)
        else:
            assert running[n] == (amount, blocked, tx)
    assert len(running) + len(short) == len(commands)


def test_negative_amounts_on_a_hot_key(spark, small_groups):
    """A rejected command with a negative amount lowers what later ones are measured against."""
    small_groups(4)
    commands = random_commands(6, 60, wallets=1, assets=1)
    for c in commands[::3]:
        c["amount"] = -c["amount"]
    expected, turned_down = brute.fold(commands)
    decided = ledger.decide(commands_frame(spark, commands))
    assert sorted(r.seq for r in ledger.rejections(decided).collect()) == turned_down
    assert balances(ledger.fold(commands_frame(spark, commands))) == expected


def test_wallet_records(spark):
    commands = [
        {"walletId": "w", "assetId": "BTC", "seq": 1, "operation": "CREDIT", "amount": D(5), "amountRelease": D(0)},
        {"walletId": "w", "assetId": "ETH", "seq": 2, "operation": "CREDIT", "amount": D(2), "amountRelease": D(0)},
        {"walletId": "w", "assetId": "BTC", "seq": 3, "operation": "BLOCK", "amount": D(4), "amountRelease": D(0)},
        {"walletId": "poor", "assetId": "BTC", "seq": 4, "operation": "DEBIT", "amount": D(1), "amountRelease": D(0)},
    ]
    frame = commands_frame(spark, commands)
    records = wallets.as_map(ledger.fold(frame))
    by_id = {r.walletId: r for r in records.collect()}
    assert {k: (v.amount, v.blocked) for k, v in by_id["w"].assets.items()} == {"BTC": (5, 4), "ETH": (2, 0)}
    assert by_id["w"].txCount == 3
    assert by_id["poor"].assets == {} and by_id["poor"].txCount == 0
    assert {r.walletId for r in ledger.touch_wallets(frame).collect()} == {"w", "poor"}
    available = {(r.walletId, r.assetId): r.available for r in wallets.balances(records).collect()}
    assert available == {("w", "BTC"): 1, ("w", "ETH"): 2}
    again = wallets.as_map(wallets.to_ledger(records)).collect()
    assert {r.walletId: (r.assets, r.txCount) for r in again} == {k: (r.assets, r.txCount) for k, r in by_id.items()}


def test_asset_map_functions(spark):
    from pyspark.sql import functions as F

    wallet = wallets.with_asset(F.lit("w"), F.lit("BTC"), F.lit(3), F.lit(1))
    entry = wallets.asset(F.lit("ETH"), F.lit(7), F.lit(0))
    frame = spark.range(1).select(wallet.alias("w"))
    assets = F.col("w.assets")
    row = frame.select(
        wallets.put_asset(assets, entry).alias("added"),
        wallets.put_asset(assets, wallets.asset(F.lit("BTC"), F.lit(9), F.lit(2))).alias("replaced"),
        wallets.asset_or_zero(assets, F.lit("XRP")).alias("absent"),
        F.col("w.txCount"),
    ).first()
    assert {k: v.amount for k, v in row.added.items()} == {"BTC": 3, "ETH": 7}
    assert {k: (v.amount, v.blocked) for k, v in row.replaced.items()} == {"BTC": (9, 2)}
    assert (row.absent.assetId, row.absent.amount, row.absent.blocked, row.txCount) == ("XRP", 0, 0, 0)
