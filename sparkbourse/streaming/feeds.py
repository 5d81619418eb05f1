"""Push queries: changes handed on as they are committed."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sparkbourse.plans.queries import order_updates
from sparkbourse.sources.state import VERSION, StateStore

Handler = Callable[[DataFrame, int], None]


def committed_changes(
    store: StateStore, feed: str, handler: Handler, checkpoint: str, available_now: bool = True
) -> StreamingQuery:
    """Pass every committed row of a feed to ``handler``, each version once and never a part of one.

    The stream follows the commit markers, not the feed's files: files of a batch that failed half-way are not seen.
    """
    markers = store.spark.readStream.option("recursiveFileLookup", "true").text(f"{store.root}/commits")
    committed = F.get_json_object("value", "$.version").cast("long").alias(VERSION)

    def process(batch: DataFrame, batch_id: int) -> None:
        versions = batch.select(committed).filter(F.col(VERSION) > 0).distinct()
        first = versions.agg(F.min(VERSION)).first()[0]
        if first is not None:
            handler(store.feed(feed, after=first - 1).join(versions, VERSION, "left_semi"), batch_id)

    writer = markers.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def followed_orders(
    store: StateStore,
    subscriptions: Callable[[SparkSession], DataFrame],
    handler: Handler,
    checkpoint: str,
    available_now: bool = True,
) -> StreamingQuery:
    """Committed changes of subscribed orders; ``queries.snapshot_then_updates`` gives what was there before."""

    def follow(changes: DataFrame, batch_id: int) -> None:
        handler(order_updates(changes, subscriptions(changes.sparkSession)), batch_id)

    return committed_changes(store, "order_changes", follow, checkpoint, available_now)


def subscribed_changes(
    changes: DataFrame, subscriptions: Callable[[SparkSession], DataFrame], path: str, checkpoint: str
) -> StreamingQuery:
    """Append the changes of subscribed orders to a parquet feed; subscriptions are read anew for each micro-batch."""

    def process(batch: DataFrame, batch_id: int) -> None:
        wanted = order_updates(batch, subscriptions(batch.sparkSession))
        wanted.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    writer = changes.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()
