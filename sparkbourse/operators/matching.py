"""Price-priority matching of incoming orders (takers) against one snapshot of the order book (makers).

Every taker is matched on its own, from the best price on, against makers of the same market and the opposite side
that belong to other wallets and whose price overlaps, until its quantity is used up. Trades happen at the maker's
price.

Joining takers to makers on the market and filtering afterwards would look at all pairs of a market. Instead the
makers of a (market, side) are laid out as one ladder, best price first, on which each maker has a position: the
quantity ahead of it. A taker then buys one stretch of the ladder, found from running sums, and is joined only to the
blocks of the ladder this stretch covers. Work and shuffled rows follow the number of matches.

A wallet never trades with itself, so a wallet's own makers cut its stretch into segments. Neighbouring own makers
count as one cut: between two cuts lies at least one trade.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkbourse.functions.orders import counter_side, stable_id
from sparkbourse.operators.running import has_hot_key, running_before, spread_join
from sparkbourse.schemas import CONFIRMED, FILL, LIMIT_SELL, MATCH, MONEY, ORDER, PROCESSED
from sparkbourse.session import stage

LADDER = ["baseAssetId", "quoteAssetId", "side"]
BLOCK_ROWS = 16
MATCH_COLUMNS = [
    "takerId",
    "makerId",
    "takerWalletId",
    "makerWalletId",
    "baseAssetId",
    "quoteAssetId",
    "takerType",
    "takerPrice",
    "takerQty",
    "makerQty",
    "qtyFilled",
    "price",
    "qtyBefore",
]


def takers(orders: DataFrame) -> DataFrame:
    """Orders that go to matching: those just confirmed."""
    return orders.filter(F.col("status") == CONFIRMED)


def enter_book(orders: DataFrame) -> DataFrame:
    """A confirmed order becomes a resting one before it is matched."""
    return orders.withColumn("status", F.lit(PROCESSED))


def favour(side: Column, price: Column) -> Column:
    """Grows from the best price of a ladder to the worst: sellers' prices from below, buyers' from above."""
    return F.when(side == LIMIT_SELL, price).otherwise(-price).cast(MONEY)


def tie_break(time_priority: bool) -> list[str]:
    return ["seq", "id"] if time_priority else ["id"]


def _ladder_rows(takers: DataFrame, book: DataFrame, tie: list[str]) -> DataFrame:
    """Makers and takers on one axis per (market, maker side); a taker sorts behind every maker its limit reaches."""
    columns = [
        "baseAssetId",
        "quoteAssetId",
        F.col("side"),
        favour(F.col("side"), F.col("price")).alias("fav"),
        F.col("is_taker"),
        *tie,
        "walletId",
        F.col("qty").cast(MONEY).alias("qty"),
        F.col("price").cast(MONEY).alias("price"),
    ]
    makers = book.filter(F.col("status") == PROCESSED)
    return (
        makers.withColumns({"side": F.col("orderType"), "is_taker": F.lit(False)})
        .select(columns)
        .unionByName(
            takers.filter("qty > 0")
            .withColumns({"side": counter_side(F.col("orderType")), "is_taker": F.lit(True)})
            .select(columns)
        )
    )


def match_snapshot(takers: DataFrame, book: DataFrame, time_priority: bool = False) -> DataFrame:
    """One row per match; ``qtyBefore`` is what the taker bought from better makers.

    Makers at the same price are taken by id, or by age with ``time_priority``.
    """
    is_maker = ~F.col("is_taker")
    tie = tie_break(time_priority)
    rows = _ladder_rows(takers, book, tie)
    # Every later grouping is a part of a ladder, so one check of the ladders' sizes covers them all.
    hot = has_hot_key(rows, LADDER)
    placed = stage(
        running_before(
            rows,
            LADDER,
            ["fav", "is_taker", *tie],
            sums={
                "start": F.when(is_maker, F.col("qty")).otherwise(F.lit(0).cast(MONEY)),
                "rank": is_maker.cast("long"),
            },
            hot=hot,
            label="ladder",
        ),
        "placed",
    )
    makers = placed.filter(is_maker).drop("is_taker", "fav")
    # For a taker, `rank` counts the makers its limit price reaches.
    reaching = placed.filter("is_taker and rank > 0").drop("is_taker", "fav", "start")
    return _fill(_with_last_block(_segments(reaching, makers, hot), makers, hot), makers, hot)


def _block(rank: str) -> Column:
    return F.expr(f"{rank} div {BLOCK_ROWS}")


def _blocks(first: Column, last: Column) -> Column:
    return F.explode(F.sequence(first, last))


def _segments(reaching: DataFrame, makers: DataFrame, hot: bool) -> DataFrame:
    """Stretches of the ladder each taker may buy: makers ranked ``lo`` to ``hi``, with the own quantity before them.

    Most takers meet no maker of their own wallet and have a single stretch. ``open_end`` marks a taker's last
    stretch, which ends where its quantity is used up.
    """
    own_key = [*LADDER, "walletId"]
    base = [*LADDER, "walletId", "id", "price", "qty"]
    axis = makers.schema["start"].dataType
    first_own = makers.groupBy(*own_key).agg(F.min("start").alias("own_start"), F.min("rank").alias("own_rank"))
    beside_own = (
        spread_join(reaching, first_own, own_key, "id", "left", "reaching")
        if hot
        else reaching.join(first_own, own_key, "left")
    )
    checked = beside_own.withColumn(
        "meets_own", F.expr("coalesce(own_start < qty and own_rank < rank, false)")
    )
    clear = checked.filter("not meets_own").select(
        *base,
        F.lit(0).cast("long").alias("lo"),
        F.col("rank").alias("hi"),
        F.lit(0).cast(axis).alias("skipped"),
        F.lit(True).alias("open_end"),
    )
    meeting = stage(checked.filter("meets_own").select(*base, "rank"), "meets-own")
    if meeting.isEmpty():
        return clear

    cuts = _cuts(makers.join(meeting.select(*own_key).distinct(), own_key, "left_semi"), own_key, hot)
    reached = meeting.join(_reached_cuts(meeting, cuts, own_key, hot), [*own_key, "id"]).withColumn(
        "block", _blocks(F.lit(0).cast("long"), _block("(reached - 1)"))
    )
    cut_blocks, cut_key = cuts.withColumn("block", _block("cut_no")), [*own_key, "block"]
    taker_cuts = (
        spread_join(reached, cut_blocks, cut_key, "id", label="reached") if hot else reached.join(cut_blocks, cut_key)
    ).filter("cut_no < reached")
    ends_before_cut = F.struct(
        F.coalesce(F.col("previous_end"), F.lit(0).cast("long")).alias("lo"),
        F.col("cut_rank").alias("hi"),
        F.col("own_before").cast(axis).alias("skipped"),
        F.lit(False).alias("open_end"),
    )
    after_last_cut = F.struct(
        F.col("cut_end").alias("lo"),
        F.col("rank").alias("hi"),
        (F.col("own_before") + F.col("cut_qty")).cast(axis).alias("skipped"),
        F.lit(True).alias("open_end"),
    )
    stretches = F.when(F.expr("cut_no = reached - 1"), F.array(ends_before_cut, after_last_cut)).otherwise(
        F.array(ends_before_cut)
    )
    return clear.unionByName(taker_cuts.select(*base, F.inline(stretches)).filter("lo < hi"))


def _cuts(own: DataFrame, own_key: list[str], hot: bool) -> DataFrame:
    """Own makers merged into cuts, runs without a foreign maker in between, numbered from the best price.

    ``foreign_at`` is where a cut lies once the wallet's makers are taken out of the ladder: a taker that wants more
    than that reaches it.
    """
    axis = own.schema["start"].dataType
    numbered = running_before(
        own.select(*own_key, "start", "rank", "qty"),
        own_key,
        ["rank"],
        sums={"own_before": F.col("qty"), "own_rank": F.lit(1).cast("long")},
        hot=hot,
        label="own",
    )
    runs = numbered.groupBy(*own_key, (F.col("rank") - F.col("own_rank")).alias("foreign_rank")).agg(
        F.min("rank").alias("cut_rank"),
        (F.max("rank") + 1).alias("cut_end"),
        F.min("own_before").alias("own_before"),
        F.sum("qty").cast(axis).alias("cut_qty"),
        F.min(F.col("start") - F.col("own_before")).cast(axis).alias("foreign_at"),
    )
    return stage(
        running_before(
            runs,
            own_key,
            ["cut_rank"],
            sums={"cut_no": F.lit(1).cast("long")},
            maxima={"previous_end": F.col("cut_end")},
            hot=hot,
            label="runs",
        ),
        "cuts",
    )


def _reached_cuts(meeting: DataFrame, cuts: DataFrame, own_key: list[str], hot: bool) -> DataFrame:
    """Number of cuts each taker reaches by quantity and by price; either is a prefix of the wallet's cuts."""

    def reached(cut_at: str, taker_limit: str, name: str) -> DataFrame:
        at_type = cuts.schema[cut_at].dataType
        axis = cuts.select(
            *own_key, F.lit("").alias("id"), F.col(cut_at).alias("at"), F.lit(1).cast("long").alias("is_cut")
        ).unionByName(
            meeting.select(
                *own_key, "id", F.col(taker_limit).cast(at_type).alias("at"), F.lit(0).cast("long").alias("is_cut")
            )
        )
        counted = running_before(axis, own_key, ["at", "is_cut"], sums={name: F.col("is_cut")}, hot=hot, label=name)
        return counted.filter("is_cut = 0").select(*own_key, "id", name)

    by_qty = reached("foreign_at", "qty", "by_qty")
    by_price = reached("cut_rank", "rank", "by_price")
    return by_qty.join(by_price, [*own_key, "id"]).select(
        *own_key, "id", F.least("by_qty", "by_price").alias("reached")
    )


def _with_last_block(segments: DataFrame, makers: DataFrame, hot: bool) -> DataFrame:
    """Last ladder block a segment can reach: by rank, and for an open end by where the quantity is used up."""
    axis = makers.schema["start"].dataType
    heads = makers.filter(F.col("rank") % BLOCK_ROWS == 0).select(
        *LADDER, F.col("start").alias("at"), _block("rank").alias("head")
    )
    absent = {c: F.lit(None).cast(segments.schema[c].dataType) for c in segments.columns if c not in LADDER}
    axis_rows = segments.withColumns(
        {
            "at": F.when(F.col("open_end"), F.col("qty") + F.col("skipped")).cast(axis),
            "head": F.lit(None).cast("long"),
        }
    ).unionByName(heads.withColumns(absent))
    # A head at exactly the position where the quantity ends is not reached, so takers sort first: NULLs do.
    located = running_before(
        axis_rows, LADDER, ["at", "head"], maxima={"last_head": F.col("head")}, hot=hot, label="ends"
    )
    return located.filter("head is null").withColumn("last_block", F.least(_block("(hi - 1)"), F.col("last_head")))


def _fill(segments: DataFrame, makers: DataFrame, hot: bool) -> DataFrame:
    """Join segments to the makers in their blocks and give each maker its share."""
    spans = segments.withColumnsRenamed(
        {"id": "takerId", "walletId": "takerWalletId", "price": "takerPrice", "qty": "takerQty"}
    ).withColumn("block", _blocks(_block("lo"), F.col("last_block")))
    blocks = makers.withColumnsRenamed({"id": "makerId", "walletId": "makerWalletId", "qty": "makerQty"}).withColumn(
        "block", _block("rank")
    )
    key = [*LADDER, "block"]
    # Every taker of a market starts at the first block of a ladder: the likeliest hot key of all.
    met = spread_join(spans, blocks, key, "takerId", label="spans") if hot else spans.join(blocks, key)
    return (
        met.filter("rank >= lo and rank < hi and start - skipped < takerQty")
        .withColumns(
            {
                "takerType": counter_side(F.col("side")),
                "qtyBefore": (F.col("start") - F.col("skipped")).cast(MONEY),
            }
        )
        .withColumn("qtyFilled", F.least(F.col("makerQty"), F.col("takerQty") - F.col("qtyBefore")).cast(MONEY))
        .select(*MATCH_COLUMNS)
    )


def _order_of(role: str, order_type: Column, price: Column, columns: list[str]) -> Column:
    """Order record of one side of a match as it was when it was matched: open quantity, filled quantity, message.

    The last two are in columns that settlement adds; a snapshot's orders had nothing filled.
    """
    filled, message = f"{role}Filled", f"{role}Message"
    return F.struct(
        F.col(f"{role}Id").alias("id"),
        F.col("baseAssetId"),
        F.col("quoteAssetId"),
        F.col(f"{role}WalletId").alias("walletId"),
        order_type.alias("orderType"),
        price.alias("price"),
        F.col(f"{role}Qty").alias("qty"),
        (F.col(filled) if filled in columns else F.lit(0)).cast(MONEY).alias("qtyFilled"),
        F.lit(PROCESSED).alias("status"),
        (F.col(message) if message in columns else F.lit("")).alias("message"),
    ).cast(ORDER)


def to_match_commands(matches: DataFrame) -> DataFrame:
    """Matches as records: the taker on the left, the maker on the right, at the maker's price."""
    return matches.withColumn("matchId", stable_id(F.col("takerId"), F.col("makerId"))).withColumn(
        "ordersMatchCommand",
        F.struct(
            F.col("matchId"),
            _order_of("taker", F.col("takerType"), F.col("takerPrice"), matches.columns).alias("leftOrder"),
            _order_of("maker", counter_side(F.col("takerType")), F.col("price"), matches.columns).alias("rightOrder"),
            F.col("qtyFilled"),
            F.col("price"),
        ).cast(MATCH),
    )


def to_fills(matches: DataFrame) -> DataFrame:
    """Two FILL commands per match, one for either order."""
    carried = [c for c in ("seq", "eventId", "qtyBefore") if c in matches.columns]

    def fill(role: str, order_field: str) -> Column:
        order = F.col(f"ordersMatchCommand.{order_field}")
        return F.struct(
            stable_id(F.col("matchId"), F.lit(role)).alias("commandId"),
            order["id"].alias("orderId"),
            F.col("matchId").alias("causeId"),
            F.lit(FILL).alias("command"),
            F.col("qtyFilled").cast(MONEY).alias("fillQty"),
            F.col("price").cast(MONEY).alias("fillPrice"),
            order.alias("commandOrder"),
            order.alias("order"),
        )

    commands = to_match_commands(matches)
    return commands.select(*carried, F.inline(F.array(fill("left", "leftOrder"), fill("right", "rightOrder"))))
