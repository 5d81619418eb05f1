"""Keys that decide where an event is processed."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sparkbourse.functions.orders import market


def _market_or_null(order: str) -> Column:
    return F.when(F.col(order).isNotNull(), market(order))


def order_key(event: str = "event") -> Column:
    """Market of the event's order, else of its match; NULL if it has neither."""
    return F.coalesce(_market_or_null(f"{event}.order"), _market_or_null(f"{event}.ordersMatchCommand.leftOrder"))


def wallet_key(event: str = "event") -> Column:
    """Wallet of the event's wallet command, else of its order, else of the order in its command."""
    return F.coalesce(
        F.col(f"{event}.walletCommand.walletId"),
        F.col(f"{event}.order.walletId"),
        F.col(f"{event}.orderCommand.order.walletId"),
    )
