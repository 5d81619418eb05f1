"""Scalar rules of orders and wallet commands as Column expressions.

Quantities are in the quote asset; a price is the number of base units paid per quote unit. A buyer therefore pays
in the base asset and a seller in the quote asset.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sparkbourse.schemas import LEDGER, LIMIT_BUY, LIMIT_SELL, MONEY, RELEASE_AND_DEBIT

Order = Column | str | None


def field(order: Order, name: str) -> Column:
    """Field of an order held in a struct column, a named struct column, or flat columns (``None``)."""
    if order is None:
        return F.col(name)
    return F.col(f"{order}.{name}") if isinstance(order, str) else order[name]


def _by_side(order: Order, buy: Column, sell: Column) -> Column:
    side = field(order, "orderType")
    return F.when(side == LIMIT_BUY, buy).when(side == LIMIT_SELL, sell)


def _amount(*factors: Column) -> Column:
    """Product in the ledger type; factors are narrowed first so that the product keeps all its decimals."""
    product = factors[0].cast(MONEY)
    for factor in factors[1:]:
        product = product * factor.cast(MONEY)
    return product.cast(LEDGER)


def market(order: Order = None) -> Column:
    return F.concat_ws("-", field(order, "baseAssetId"), field(order, "quoteAssetId"))


def counter_side(side: Column) -> Column:
    return F.when(side == LIMIT_BUY, LIMIT_SELL).when(side == LIMIT_SELL, LIMIT_BUY)


def asset_to_block(order: Order = None) -> Column:
    return _by_side(order, field(order, "baseAssetId"), field(order, "quoteAssetId"))


def amount_to_block(order: Order = None) -> Column:
    qty = field(order, "qty")
    return _by_side(order, _amount(qty, field(order, "price")), _amount(qty))


def amount_release_on_fill(fill_qty: Column, order: Order = None) -> Column:
    """What was blocked for the filled part: a buyer blocked at the limit price, not at the fill price."""
    return _by_side(order, _amount(fill_qty, field(order, "price")), _amount(fill_qty))


def asset_to_debit(order: Order = None) -> Column:
    return asset_to_block(order)


def amount_to_debit(fill_price: Column, fill_qty: Column, order: Order = None) -> Column:
    return _by_side(order, _amount(fill_qty, fill_price), _amount(fill_qty))


def asset_to_credit(order: Order = None) -> Column:
    return _by_side(order, field(order, "quoteAssetId"), field(order, "baseAssetId"))


def amount_to_credit(fill_price: Column, fill_qty: Column, order: Order = None) -> Column:
    return _by_side(order, _amount(fill_qty), _amount(fill_qty, fill_price))


def available(amount: Column, blocked: Column) -> Column:
    return (amount - blocked).cast(LEDGER)


def modifies_order(operation: Column) -> Column:
    """True for the one wallet operation of a fill after which the order itself changes."""
    return operation == RELEASE_AND_DEBIT


def wallet_command_id(command_id: Column, operation: Column) -> Column:
    return F.concat_ws("-", command_id, operation)


def stable_id(*parents: Column) -> Column:
    """Id derived from what it stems from, so that a retried batch produces the same one.

    Each part goes in with its length, so that no two lists of parts look alike; a missing one has no length.
    """
    text = [F.coalesce(p.cast("string"), F.lit("")) for p in parents]
    size = [F.coalesce(F.length(p.cast("string")).cast("string"), F.lit("-")) for p in parents]
    return F.sha2(F.concat(*[F.concat(n, F.lit(":"), t) for n, t in zip(size, text, strict=True)]), 256)


def stable_id_sql(*parents: str) -> str:
    """``stable_id`` of text columns, as SQL text."""
    parts = [f"coalesce(cast(length({p}) as string), '-'), ':', coalesce({p}, '')" for p in parents]
    return f"sha2(concat({', '.join(parts)}), 256)"


def processed_at() -> Column:
    return F.current_timestamp()


def feed_id(order_id: Column, position: Column) -> Column:
    """Id of an entry in an order's update feed."""
    return F.concat_ws("/", F.lit("order"), order_id, position.cast("string"))
