"""Order commands: validation, the wallet commands they cause, and the changes they make to orders.

A frame of commands has one row per command: ``seq, eventId, commandId, orderId, causeId, command, fillQty,
fillPrice, commandOrder`` (the order inside the command) and ``order`` (the order inside the event).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkbourse.functions import orders as fn
from sparkbourse.schemas import (
    BLOCK,
    CANCEL,
    CANCELLED,
    CONFIRMED,
    CREDIT,
    FILL,
    FILLED,
    LEDGER,
    MONEY,
    ORDER,
    ORDER_COMMAND,
    PROCESSED,
    RELEASE,
    RELEASE_AND_DEBIT,
    SUBMIT,
)
from sparkbourse.sources.codec import order_struct

ORDER_FIELDS = [f.name for f in ORDER.fields]


def commands_of(events: DataFrame) -> DataFrame:
    """Order commands carried by events."""
    c = "event.orderCommand"
    return events.filter(F.col(c).isNotNull()).select(
        "seq",
        F.col("event.id").alias("eventId"),
        F.col(f"{c}.id").alias("commandId"),
        F.col(f"{c}.orderId").alias("orderId"),
        F.col(f"{c}.causeId").alias("causeId"),
        F.col(f"{c}.command").alias("command"),
        F.col(f"{c}.fillQty").alias("fillQty"),
        F.col(f"{c}.fillPrice").alias("fillPrice"),
        F.col(f"{c}.order").alias("commandOrder"),
        F.col("event.order").alias("order"),
    )


def stamp_submit(commands: DataFrame, request_id: str = "requestId") -> DataFrame:
    """Requests to submit, given their order and command ids; both derive from the request's id."""
    order_id = fn.stable_id(F.lit("order"), F.col(request_id))
    return (
        commands.withColumn("orderId", order_id)
        .withColumn("commandId", fn.stable_id(F.lit("command"), F.col(request_id)))
        .withColumn("causeId", F.col("orderId"))
        .withColumn("commandOrder", F.col("commandOrder").withField("id", F.col("orderId")))
    )


def build_cancel(requests: DataFrame, order_id: str = "orderId", request_id: str = "requestId") -> DataFrame:
    """Cancel commands from order ids."""
    return requests.select(
        fn.stable_id(F.lit("command"), F.col(request_id)).alias("commandId"),
        F.col(order_id).alias("orderId"),
        F.col(order_id).alias("causeId"),
        F.lit(CANCEL).alias("command"),
        F.lit(0).cast(MONEY).alias("fillQty"),
        F.lit(0).cast(MONEY).alias("fillPrice"),
        F.lit(None).cast(ORDER).alias("commandOrder"),
    )


def command_struct() -> Column:
    """An order command record from a frame of commands."""
    return F.struct(
        F.col("commandId").alias("id"),
        F.col("orderId"),
        F.col("causeId"),
        F.col("command"),
        F.col("fillQty"),
        F.col("fillPrice"),
        F.lit("").alias("message"),
        F.col("commandOrder").alias("order"),
    ).cast(ORDER_COMMAND)


def check_submits(commands: DataFrame) -> DataFrame:
    """A submit is valid if it carries an order; the order gets an id of its own whatever the sender put in.

    The id stems from the position too: a command that was sent twice makes two orders.
    """
    submits = commands.filter(F.col("command") == SUBMIT)
    order_id = fn.stable_id(F.col("seq"), F.col("eventId"), F.col("commandId"), F.col("orderId"))
    reason = F.when(F.col("commandOrder").isNull(), "submit without order")
    return (
        submits.withColumn("reason", reason)
        .withColumn("orderId", F.when(F.col("reason").isNull(), order_id).otherwise(F.col("orderId")))
        .withColumn("commandOrder", F.col("commandOrder").withField("id", F.col("orderId")))
        .withColumn("order", F.col("commandOrder"))
    )


def check_cancels(commands: DataFrame, orders: DataFrame) -> DataFrame:
    """A cancel is valid if the order rests in the book; the first one of a batch wins."""
    cancels = commands.filter(F.col("command") == CANCEL).drop("order")
    targets = (
        cancels.groupBy("orderId")
        .agg(F.min("seq").alias("first_seq"))
        .join(
            orders.select(F.col("id").alias("orderId"), order_struct().alias("order")),
            "orderId",
            "left",
        )
    )
    reason = (
        F.when(F.col("order").isNull(), "unknown order")
        .when(F.col("order.status") != PROCESSED, "order is not open")
        .when(F.col("seq") > F.col("first_seq"), "already cancelled")
    )
    return cancels.join(targets, "orderId").withColumn("reason", reason).select(*commands.columns, "reason")


def check_fills(commands: DataFrame) -> DataFrame:
    """A fill is checked against the copy of the order that travels with it."""
    reason = (
        F.when(F.col("order").isNull(), "fill without order")
        .when(F.col("order.status") != PROCESSED, "order is not open")
        .when(F.col("fillQty") > F.col("order.qty"), "more than the open quantity")
    )
    return commands.filter(F.col("command") == FILL).withColumn("reason", reason)


def check(commands: DataFrame, orders: DataFrame) -> DataFrame:
    """All commands, with the reason where one is not valid."""
    return (
        check_submits(commands)
        .unionByName(check_cancels(commands, orders))
        .unionByName(check_fills(commands))
    )


def valid(checked: DataFrame) -> DataFrame:
    return checked.filter("reason is null").drop("reason")


def rejected(checked: DataFrame) -> DataFrame:
    return checked.filter("reason is not null")


def validate_submit(commands: DataFrame) -> DataFrame:
    return valid(check_submits(commands))


def validate_cancel(commands: DataFrame, orders: DataFrame) -> DataFrame:
    return valid(check_cancels(commands, orders))


def validate_fill(commands: DataFrame) -> DataFrame:
    return valid(check_fills(commands))


def to_wallet_commands(commands: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Wallet commands of valid order commands: a submit blocks, a cancel releases, a fill credits and debits.

    ``part`` orders the commands of one order command; ``carry`` are further columns to keep.
    """
    nothing = F.lit(0).cast(LEDGER)

    def command(part: int, operation: str, asset: Column, amount: Column, release: Column) -> Column:
        return F.struct(
            F.lit(part).alias("part"),
            F.lit(operation).alias("operation"),
            asset.alias("assetId"),
            amount.alias("amount"),
            release.alias("amountRelease"),
        )

    price, qty = F.col("fillPrice"), F.col("fillQty")
    to_block = fn.amount_to_block("order")
    caused = (
        F.when(F.col("command") == SUBMIT, F.array(command(0, BLOCK, fn.asset_to_block("order"), to_block, nothing)))
        .when(F.col("command") == CANCEL, F.array(command(0, RELEASE, fn.asset_to_block("order"), nothing, to_block)))
        .when(
            F.col("command") == FILL,
            F.array(
                command(0, CREDIT, fn.asset_to_credit("order"), fn.amount_to_credit(price, qty, "order"), nothing),
                command(
                    1,
                    RELEASE_AND_DEBIT,
                    fn.asset_to_debit("order"),
                    fn.amount_to_debit(price, qty, "order"),
                    fn.amount_release_on_fill(qty, "order"),
                ),
            ),
        )
    )
    return commands.select(
        "seq",
        "eventId",
        "commandId",
        "orderId",
        "command",
        *carry,
        F.col("order.walletId").alias("walletId"),
        F.inline(caused),
    ).withColumns({"id": fn.wallet_command_id(F.col("commandId"), F.col("operation")), "causeId": F.col("orderId")})


def apply_submit(commands: DataFrame) -> DataFrame:
    """Confirmed orders of submits whose funds were blocked."""
    return commands.select("seq", "eventId", "order.*").withColumn("status", F.lit(CONFIRMED))


def apply_cancel(orders: DataFrame, cancels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Cancelled orders, and the orders that remain."""
    ids = cancels.select(F.col("orderId").alias("id"), F.col("seq").alias("cancelSeq"))
    cancelled = orders.join(ids, "id").withColumns({"status": F.lit(CANCELLED), "seq": F.col("cancelSeq")})
    return cancelled.drop("cancelSeq"), orders.join(ids, "id", "left_anti")


def apply_fills(orders: DataFrame, fills: DataFrame) -> DataFrame:
    """Orders with the quantities of all their fills taken off; one whose quantity is used up is filled."""
    filled = fills.groupBy(F.col("orderId").alias("id")).agg(F.sum("fillQty").cast(MONEY).alias("fill"))
    status = F.when(F.col("fill") == F.col("qty"), FILLED).otherwise(F.col("status"))
    return (
        orders.join(filled, "id")
        .withColumn("status", status)
        .withColumns(
            {
                "qty": (F.col("qty") - F.col("fill")).cast(MONEY),
                "qtyFilled": (F.col("qtyFilled") + F.col("fill")).cast(MONEY),
            }
        )
        .drop("fill")
    )


def confirm_fills(wallet_commands: DataFrame) -> DataFrame:
    """Fills both of whose wallet commands are done: the two joined back into one confirmation."""
    done = wallet_commands.filter(F.col("operation").isin(CREDIT, RELEASE_AND_DEBIT))
    both = F.max(F.col("operation") == CREDIT) & F.max(F.col("operation") == RELEASE_AND_DEBIT)
    return done.groupBy("commandId", "orderId").agg(both.alias("confirmed")).filter("confirmed").drop("confirmed")


