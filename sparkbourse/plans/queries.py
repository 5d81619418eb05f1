"""Pull queries over the order and wallet tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkbourse.functions.orders import feed_id, market
from sparkbourse.operators.running import running_before
from sparkbourse.schemas import LEDGER, LIMIT_BUY, LIMIT_SELL, MONEY, PROCESSED
from sparkbourse.sources.tables import ORDER_COLUMNS

MARKET = ["baseAssetId", "quoteAssetId"]


def order_status(orders: DataFrame, order_id: str) -> DataFrame:
    """The row of an order; the table has one for each id."""
    return orders.filter(F.col("id") == order_id).select(*ORDER_COLUMNS)


def orders_for_market(orders: DataFrame, base: str, quote: str) -> DataFrame:
    return orders.filter((F.col("baseAssetId") == base) & (F.col("quoteAssetId") == quote)).select(*ORDER_COLUMNS)


def order_book_l3(orders: DataFrame) -> DataFrame:
    """Every order in the store, whatever its status."""
    return orders.select(*ORDER_COLUMNS)


def order_book_l2(orders: DataFrame) -> DataFrame:
    """Open quantity and number of orders at each price of a market."""
    return (
        orders.filter(F.col("status") == PROCESSED)
        .groupBy(*MARKET, "orderType", "price")
        .agg(F.sum("qty").alias("qty"), F.count(F.lit(1)).alias("orders"))
    )


def markets(orders: DataFrame) -> DataFrame:
    return orders.select(*MARKET).distinct().withColumn("market", market())


def trade_totals(matches: DataFrame) -> DataFrame:
    """Matches, quantity and notional value per taker."""
    notional = F.col("qtyFilled").cast(MONEY) * F.col("price").cast(MONEY)
    return matches.groupBy("takerId").agg(
        F.count(F.lit(1)).alias("matches"),
        F.sum("qtyFilled").alias("qty"),
        F.sum(notional.cast(LEDGER)).alias("notional"),
    )


def ticker(orders: DataFrame, trades: DataFrame, position: Column | None = None) -> DataFrame:
    """Last price, volume and number of trades per market, with the best bid and ask of the book.

    ``position`` orders the trades; by default their ``seq``.
    """
    position = F.col("seq") if position is None else position
    traded = trades.groupBy(*MARKET).agg(
        F.max_by("price", position).alias("last"),
        F.sum("qtyFilled").alias("volume"),
        F.count(F.lit(1)).alias("trades"),
    )
    side = F.col("orderType")
    quoted = (
        orders.filter(F.col("status") == PROCESSED)
        .groupBy(*MARKET)
        .agg(
            F.max(F.when(side == LIMIT_BUY, F.col("price"))).alias("bestBid"),
            F.min(F.when(side == LIMIT_SELL, F.col("price"))).alias("bestAsk"),
        )
    )
    return (
        markets(orders)
        .join(quoted, MARKET, "left")
        .join(traded, MARKET, "left")
        .select(
            "market",
            "bestBid",
            "bestAsk",
            "last",
            F.coalesce("volume", F.lit(0).cast(MONEY)).alias("volume"),
            F.coalesce("trades", F.lit(0)).alias("trades"),
        )
    )


def order_history(changes: DataFrame) -> DataFrame:
    """Status transitions of each order, in order."""
    rows = changes.select("id", "seq", "status", "qty", "qtyFilled")
    with_previous = running_before(
        rows, ["id"], ["seq"], maxima={"previous": F.struct("seq", "status")}, label="history"
    )
    return with_previous.select(
        "id", "seq", F.col("previous.status").alias("previousStatus"), "status", "qty", "qtyFilled"
    )


def subscribe(requests: DataFrame, order_id: str = "orderId", request_id: str = "requestId") -> DataFrame:
    """Subscriptions: a handle per request for the updates of an order."""
    return requests.select(F.col(request_id).cast("string").alias("handle"), F.col(order_id).alias("orderId"))


def unsubscribe(subscriptions: DataFrame, handles: DataFrame) -> DataFrame:
    return subscriptions.join(handles.select("handle"), "handle", "left_anti")


def order_updates(changes: DataFrame, subscriptions: DataFrame) -> DataFrame:
    """Changes of the orders someone subscribed to, each with its feed id."""
    wanted = subscriptions.select(F.col("orderId").alias("id")).distinct()
    return changes.join(wanted, "id", "left_semi").withColumn("feedId", feed_id(F.col("id"), F.col("seq")))


def snapshot_then_updates(snapshot: DataFrame, changes: DataFrame, snapshot_seq: int) -> DataFrame:
    """Current rows followed by the changes after them."""
    columns = [c for c in snapshot.columns if c in changes.columns]
    newer = changes.filter(F.col("seq") > snapshot_seq)
    return (
        snapshot.select(*columns)
        .withColumn("kind", F.lit("snapshot"))
        .unionByName(newer.select(*columns).withColumn("kind", F.lit("update")))
    )
