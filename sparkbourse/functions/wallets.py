"""Wallet records built from, and taken apart into, rows of the (wallet, asset) ledger."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkbourse.functions.orders import available
from sparkbourse.schemas import LEDGER, WALLET


def asset(asset_id: Column, amount: Column, blocked: Column) -> Column:
    return F.struct(
        asset_id.alias("assetId"), amount.cast(LEDGER).alias("amount"), blocked.cast(LEDGER).alias("blocked")
    )


def with_asset(wallet_id: Column, asset_id: Column, amount: Column, blocked: Column) -> Column:
    """A wallet that holds a single asset."""
    return F.struct(
        wallet_id.alias("walletId"),
        F.create_map(asset_id, asset(asset_id, amount, blocked)).alias("assets"),
        F.lit(0).cast("long").alias("txCount"),
    ).cast(WALLET)


def asset_or_zero(assets: Column, asset_id: Column) -> Column:
    """Entry of an asset map; an absent asset counts as nothing held and nothing blocked."""
    zero = F.lit(0).cast(LEDGER)
    return F.coalesce(F.try_element_at(assets, asset_id), asset(asset_id, zero, zero))


def put_asset(assets: Column, entry: Column) -> Column:
    """Asset map with one entry added or replaced."""
    others = F.map_filter(assets, lambda key, _: key != entry["assetId"])
    return F.map_concat(others, F.create_map(entry["assetId"], entry))


def as_map(ledger: DataFrame) -> DataFrame:
    """One wallet record per wallet. A wallet whose commands were all rejected exists with no assets."""
    entry = F.struct(F.col("assetId"), asset(F.col("assetId"), F.col("amount"), F.col("blocked")))
    return ledger.groupBy("walletId").agg(
        F.map_from_entries(F.collect_list(F.when(F.col("held"), entry))).alias("assets"),
        F.sum("txCount").alias("txCount"),
    )


def balances(wallets: DataFrame) -> DataFrame:
    """Amount, blocked and available per wallet and asset, from wallet records."""
    return wallets.select("walletId", F.explode("assets").alias("key", "asset")).select(
        "walletId",
        F.col("asset.assetId").alias("assetId"),
        F.col("asset.amount").alias("amount"),
        F.col("asset.blocked").alias("blocked"),
        available(F.col("asset.amount"), F.col("asset.blocked")).alias("available"),
    )


def to_ledger(wallets: DataFrame) -> DataFrame:
    """Ledger rows of wallet records; the transaction count stays with the wallet's first asset."""
    return wallets.select("walletId", "txCount", F.posexplode_outer("assets").alias("pos", "key", "asset")).select(
        "walletId",
        F.coalesce("asset.assetId", F.lit("")).alias("assetId"),
        F.coalesce("asset.amount", F.lit(0).cast(LEDGER)).alias("amount"),
        F.coalesce("asset.blocked", F.lit(0).cast(LEDGER)).alias("blocked"),
        F.when(F.coalesce("pos", F.lit(0)) == 0, F.col("txCount")).otherwise(F.lit(0)).cast("long").alias("txCount"),
        F.col("asset").isNotNull().alias("held"),
    )
