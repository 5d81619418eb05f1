"""Routing of event envelopes by what they contain."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkbourse.functions.keys import order_key, wallet_key
from sparkbourse.functions.orders import modifies_order
from sparkbourse.schemas import FILL, SUBMIT

SUB_RECORDS = ("ordersMatchCommand", "orderCommand", "order", "walletCommand", "wallet")


def split(events: DataFrame, sub_record: str) -> tuple[DataFrame, DataFrame]:
    """Events that carry the sub-record, and those that pass through."""
    carries = F.col(f"event.{sub_record}").isNotNull()
    return events.filter(carries), events.filter(~carries)


def requires_order_processing(event: str = "event") -> Column:
    """Whether the order still has to be changed after the wallet command was done."""
    command = F.col(f"{event}.orderCommand.command")
    fill_done = F.coalesce(modifies_order(F.col(f"{event}.walletCommand.operation")), F.lit(False))
    return F.when(command == FILL, fill_done).when(command == SUBMIT, True).otherwise(False)


def content(event: str = "event") -> Column:
    """Name of the sub-record that decides an event's way: the first one it carries."""
    return F.coalesce(*[F.when(F.col(f"{event}.{name}").isNotNull(), name) for name in SUB_RECORDS], F.lit("empty"))


def with_keys(events: DataFrame) -> DataFrame:
    return events.withColumns({"orderKey": order_key(), "walletKey": wallet_key()})


def split_unkeyed(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Events that some processor can be found for, and those without any partition key."""
    keyed = with_keys(events)
    has_key = F.coalesce("orderKey", "walletKey", "event.orderCommand.orderId").isNotNull()
    return keyed.filter(has_key), keyed.filter(~has_key).withColumn("reason", F.lit("no partition key"))
