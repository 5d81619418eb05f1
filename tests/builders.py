"""Small frames for tests."""

from __future__ import annotations

import random
from decimal import Decimal

from sparkbourse.schemas import LEDGER, ORDER_STATE
from pyspark.sql import types as T

D = Decimal

COMMANDS = T.StructType(
    [
        T.StructField("walletId", T.StringType()),
        T.StructField("assetId", T.StringType()),
        T.StructField("seq", T.LongType()),
        T.StructField("operation", T.StringType()),
        T.StructField("amount", LEDGER),
        T.StructField("amountRelease", LEDGER),
    ]
)


def order(order_id, side="LIMIT_BUY", price="0.1", qty="10", wallet=None, status="PROCESSED", seq=0, market=("BTC", "ETH")):
    return {
        "id": order_id,
        "baseAssetId": market[0],
        "quoteAssetId": market[1],
        "walletId": wallet or f"wallet-{order_id}",
        "orderType": side,
        "price": D(price),
        "qty": D(qty),
        "qtyFilled": D(0),
        "status": status,
        "message": "",
        "seq": seq,
    }


def orders_frame(spark, rows):
    return spark.createDataFrame([tuple(r[f.name] for f in ORDER_STATE.fields) for r in rows], ORDER_STATE)


def random_orders(seed, takers, makers, wallets=4, markets=1, prices=8):
    rng = random.Random(seed)

    def one(i, status):
        return order(
            f"{status[0]}{i:04d}",
            rng.choice(["LIMIT_BUY", "LIMIT_SELL"]),
            rng.randint(1, prices),
            rng.randint(1, 9),
            f"w{rng.randrange(wallets)}",
            status,
            i,
            ("B", f"Q{rng.randrange(markets)}"),
        )

    return [one(i, "CONFIRMED") for i in range(takers)], [one(i, "PROCESSED") for i in range(makers)]


def commands_frame(spark, rows):
    return spark.createDataFrame([tuple(r[f.name] for f in COMMANDS.fields) for r in rows], COMMANDS)


def random_commands(seed, n, wallets=2, assets=2):
    rng = random.Random(seed)
    ops = ["CREDIT", "CREDIT", "DEBIT", "BLOCK", "BLOCK", "RELEASE", "RELEASE_AND_DEBIT"]
    return [
        {
            "walletId": f"w{rng.randrange(wallets)}",
            "assetId": f"a{rng.randrange(assets)}",
            "seq": i,
            "operation": rng.choice(ops),
            "amount": D(rng.randint(0, 40)) / 4,
            "amountRelease": D(rng.randint(0, 8)) / 4,
        }
        for i in range(n)
    ]
