"""Matching that settles: takers of a market act in ``seq`` order, each on the book the ones before it left.

What a taker does not trade rests in the book and can be hit by later takers. The order of takers matters inside a
market, so a market is worked through by one task, but only with the orders that can trade at all: takers whose price
is reached by some order of the other side, and of the resting orders those whose price is reached and that lie within
the quantity all takers together ask for.

Cancels and fills that come as commands act between the takers, at their own ``seq``, on the order as it is then: what
they take off is gone for later takers, what was traded before they cannot take. The orders they name always take part.

A market that is still too large for one task is worked through in slices of events. Each slice gets its own, much
smaller, part of the book; the book is written out between slices. A slice whose part of the book is still too large
is halved, down to a single taker, for which matching against the book as it stands is a parallel job.
"""

from __future__ import annotations

import decimal
import heapq
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkbourse.operators.matching import LADDER, MATCH_COLUMNS, favour, match_snapshot, tie_break
from sparkbourse.operators.running import has_hot_key, max_group_rows, running_before
from sparkbourse.schemas import CANCEL, FILL, LEDGER, LIMIT_BUY, LIMIT_SELL, MONEY, PROCESSED, SUBMIT
from sparkbourse.session import stage

MARKET = ["baseAssetId", "quoteAssetId"]
_RESTS, MATCHED, FUNDED, _FUNDS = "RESTS", "MATCH", "FUNDED", "FUNDS"
RESTING = [*MARKET, "id", "walletId", "orderType", "price", "qty", "seq"]
# Prices and quantities go through the matching loop as whole numbers of the smallest unit.
UNIT = "0.00000001"
_EXACT = decimal.Context(prec=76)
_UNIT_COLUMNS = ("takerPrice", "takerQty", "makerQty", "qtyFilled", "price", "qtyBefore")


def match_sequential(takers: DataFrame, book: DataFrame, time_priority: bool = False) -> DataFrame:
    """One row per match with the taker's ``seq``; ``makerQty`` is what the maker still had open."""
    return work_through(takers, book, None, time_priority).select("seq", *MATCH_COLUMNS)


def work_through(takers: DataFrame, book: DataFrame, commands: DataFrame | None, time_priority: bool = False) -> DataFrame:
    """Matches, and what became of ``commands`` that cancel or fill an order, in ``seq`` order within each market.

    ``commands`` has ``kind`` (CANCEL or FILL), ``seq``, the market, the order's ``id``, and ``qty``, what a fill asks for;
    ``seq`` is unique over takers and commands. The result has ``seq``, ``kind`` (MATCH for matches) and the columns of a
    match; for a command ``makerId`` is the order, ``makerQty`` what it had open just before, null if it was not open, and
    ``qtyFilled`` what the command took off, nothing if a fill asked for more than that.
    """
    resting = book.filter(F.col("status") == PROCESSED).select(*RESTING)
    acting = takers.filter("qty > 0").select(F.lit(SUBMIT).alias("kind"), *RESTING)
    if commands is not None:
        acting = _with_commands(acting, commands)
    active = stage(_active(_able(acting, resting, commands is not None), resting, time_priority, commands is not None), "active")
    if not has_hot_key(active, MARKET):
        return _in_order(active, time_priority)
    hot = stage(active.groupBy(*MARKET).count().filter(F.col("count") > max_group_rows(active)).select(*MARKET), "hot-markets")
    ordinary = _in_order(active.join(hot, MARKET, "left_anti"), time_priority)
    return ordinary.unionByName(_in_slices(active.join(hot, MARKET, "left_semi"), time_priority, commands is not None))


def reachable(takers: DataFrame, book: DataFrame, commands: DataFrame, time_priority: bool = False) -> DataFrame:
    """The resting orders that the takers, whichever of them come to act, or the commands can reach."""
    acting = _with_commands(takers.filter("qty > 0").select(F.lit(SUBMIT).alias("kind"), *RESTING), commands)
    resting = book.filter(F.col("status") == PROCESSED).select(*RESTING)
    return _active(acting, resting, time_priority, True).filter(F.col("kind") == _RESTS).select(*RESTING)


def settle_through(
    takers: DataFrame, resting: DataFrame, commands: DataFrame, funds: DataFrame, time_priority: bool = False
) -> DataFrame:
    """Like ``work_through``, and each taker acts only if its wallet has the funds for it at that moment.

    All rows have the number of the ``team`` of markets that are worked through together, with the funds they share.
    ``funds`` has ``walletId, assetId, seq, asks, effect`` for each team that has to know: balances to start from, without
    ``seq``, and changes from outside the team; one with ``asks`` takes effect only if as much is available. What the
    team itself does to funds is kept account of here. The result also has a row of kind FUNDED for each taker that acted.
    ``commands`` bring what they do to funds along: ``walletId, orderType, price`` of the order, for fills ``copyBase``,
    ``copyQuote`` and ``fillPrice`` too. One task works through a team; its memory holds open orders and funds.
    """
    parts = [
        takers.select("team", F.lit(SUBMIT).alias("kind"), *RESTING),
        resting.select("team", F.lit(_RESTS).alias("kind"), *RESTING),
        commands.select("team", "kind", *RESTING, "copyBase", "copyQuote", "fillPrice"),
        funds.select("team", F.lit(_FUNDS).alias("kind"), "walletId", F.col("assetId").alias("copyBase"), "seq", "asks", "effect"),
    ]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    acts = (F.col("kind") != _RESTS) & F.col("seq").isNotNull()
    units = [_units(c) for c in ("price", "qty", "fillPrice")]
    columns = ["team", *MARKET, "seq", "kind", "id", "walletId", "orderType", "price", "qty", "fillPrice", "copyBase", "copyQuote", "asks", "effect"]
    rows = rows.withColumn("acts", acts).select("acts", *[c for c in columns if c not in ("price", "qty", "fillPrice")], *units)
    (schema, ddl), books_type = _outcome_schema(), _books()
    # Funds are whole numbers of the ledger's last digit, which is that of a price times a quantity.
    one, ledger_scale = 10**MONEY.scale, LEDGER.scale

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        team, markets, held = None, {}, {}

        def whole(amount: decimal.Decimal) -> int:
            return int(amount.scaleb(ledger_scale, _EXACT))

        def add(wallet: str, asset: str, effect: int) -> None:
            held[wallet, asset] = held.get((wallet, asset), 0) + effect

        for batch in batches:
            found = []
            for of_team, base, quote, seq, kind, order, wallet, side, price, qty, fill_price, copy_base, copy_quote, asks, effect in zip(
                *(column.to_pylist() for column in batch.columns), strict=True
            ):
                if of_team != team:
                    team, markets, held = of_team, {}, {}
                if kind == _FUNDS:
                    if asks is None or held.get((wallet, copy_base), 0) >= whole(asks):
                        add(wallet, copy_base, whole(effect))
                    continue
                books = markets.get((base, quote))
                if books is None:
                    books = markets[base, quote] = books_type(time_priority)
                buys = side == LIMIT_BUY
                if kind == SUBMIT:
                    key, ask = ((wallet, base), price * qty) if buys else ((wallet, quote), qty * one)
                    there = held.get(key, 0)
                    if there < ask:
                        continue
                    held[key] = there - ask
                    found.append((seq, FUNDED, order, None, wallet, None, base, quote, side, price, qty) + (None,) * 4)
                    if qty <= 0:
                        continue
                    for trade in books.trade(seq, order, wallet, side, price, qty):
                        found.append(books.match_row(seq, order, wallet, base, quote, side, price, qty, trade))
                        _, maker_wallet, at, _, filled, _ = trade
                        buyer, seller = (wallet, maker_wallet) if buys else (maker_wallet, wallet)
                        add(buyer, quote, filled * one)
                        add(seller, base, filled * at)
                        if buys:  # blocked at its own price
                            add(buyer, base, filled * (price - at))
                elif kind == _RESTS:
                    books.rest(seq, order, wallet, side, price, qty)
                else:
                    there, taken = books.take_off(kind, order, qty)
                    found.append(books.ended_row(seq, kind, order, base, quote, (there, taken)))
                    if there is None or (kind == FILL and qty > there):
                        continue
                    if kind == CANCEL:
                        add(wallet, base if buys else quote, taken * (price if buys else one))
                    elif buys:
                        add(wallet, copy_quote, qty * one)
                        add(wallet, copy_base, qty * (price - fill_price))
                    else:
                        add(wallet, copy_base, qty * fill_price)
            yield books_type.batch(found, schema)

    ordered = rows.repartition("team").sortWithinPartitions("team", "acts", "seq").select(*columns)
    return _in_money(ordered.mapInArrow(work, ddl))


def _with_commands(acting: DataFrame, commands: DataFrame) -> DataFrame:
    nothing = {"walletId": "string", "orderType": "string", "price": MONEY}
    rows = commands.select("kind", "seq", *MARKET, "id", F.col("qty").cast(MONEY).alias("qty"))
    return acting.unionByName(rows.select("*", *[F.lit(None).cast(t).alias(c) for c, t in nothing.items()]))


def _is_taker() -> Column:
    return F.col("kind") == SUBMIT


def _side(name: str) -> Column:
    return F.col("orderType") == name


def _able(acting: DataFrame, resting: DataFrame, with_commands: bool) -> DataFrame:
    """Takers for which some order of the other side, resting or incoming, has an overlapping price; all commands and the
    takers they name."""
    takers = acting.filter(_is_taker())
    both = takers.select(*MARKET, "orderType", "price").unionByName(resting.select(*MARKET, "orderType", "price"))
    best = both.groupBy(*MARKET).agg(
        F.min(F.when(_side(LIMIT_SELL), F.col("price"))).alias("best_ask"),
        F.max(F.when(_side(LIMIT_BUY), F.col("price"))).alias("best_bid"),
    )
    overlaps = F.when(_side(LIMIT_BUY), F.col("price") >= F.col("best_ask")).otherwise(
        F.col("price") <= F.col("best_bid")
    )
    placed = takers.join(best, MARKET)
    if not with_commands:
        return placed.filter(overlaps).select(*acting.columns)
    named = _named(acting).withColumn("named", F.lit(True))
    able = placed.join(named, "id", "left").filter(F.coalesce(overlaps, F.lit(False)) | F.coalesce("named", F.lit(False)))
    return able.select(*acting.columns).unionByName(acting.filter(~_is_taker()))


def _named(acting: DataFrame) -> DataFrame:
    """Orders that commands name."""
    return acting.filter(~_is_taker()).select("id").distinct()


def _active(acting: DataFrame, resting: DataFrame, time_priority: bool, with_commands: bool) -> DataFrame:
    """What acts, and the resting orders takers can reach by price and, in the order in which makers trade, by quantity."""
    wanted = acting.filter(_is_taker()).groupBy(
        *MARKET, F.when(_side(LIMIT_BUY), LIMIT_SELL).otherwise(LIMIT_BUY).alias("side")
    ).agg(
        F.max(favour(F.when(_side(LIMIT_BUY), LIMIT_SELL).otherwise(LIMIT_BUY), F.col("price"))).alias("limit"),
        F.sum("qty").alias("demand"),
    )
    sided = resting.withColumns({"side": F.col("orderType"), "fav": favour(F.col("orderType"), F.col("price"))})
    ladder = sided.join(wanted, LADDER).filter(F.col("fav") <= F.col("limit"))
    # A wallet passes over its own orders, so it can get deeper than the demand by what one wallet holds at most.
    passed_over = (
        ladder.groupBy(*LADDER, "walletId").agg(F.sum("qty").alias("own")).groupBy(*LADDER).agg(F.max("own").alias("own"))
    )
    placed = running_before(ladder, LADDER, ["fav", *tie_break(time_priority)], sums={"before": F.col("qty")}, label="reach")
    placed = placed.join(passed_over, LADDER)
    if not with_commands:
        reached = placed.filter("before - own < demand").select(*RESTING)
    else:
        # What commands may take off the ladder lets takers get deeper by as much; the orders they name act themselves.
        named = sided.join(_named(acting), "id", "left_semi")
        taken_off = named.groupBy(*LADDER).agg(F.sum("qty").alias("off"))
        placed = placed.join(taken_off, LADDER, "left").filter(F.expr("before - own - coalesce(off, 0) < demand"))
        reached = placed.select(*RESTING).unionByName(named.select(*RESTING)).dropDuplicates(["id"])
    return acting.unionByName(reached.withColumn("kind", F.lit(_RESTS)))


def _units(name: str) -> Column:
    return (F.col(name).cast("decimal(28,8)") / F.lit(UNIT).cast("decimal(8,8)")).cast("long").alias(name)


def _books() -> type:
    """Made inside a function, so that executors, which do not have this package, get it with the task."""

    class Books:
        """Both sides of one market, quantities and prices in units.

        Heaps hold an order's place only; what it has open is looked up, so that an order is taken out without a search.
        """

        def __init__(self, time_priority: bool):
            self._by_age, self._sides, self._open = time_priority, {LIMIT_SELL: [], LIMIT_BUY: []}, {}

        def rest(self, seq: int, order: str, wallet: str, side: str, price: int, qty: int) -> None:
            if qty > 0:
                fav = price if side == LIMIT_SELL else -price
                heapq.heappush(self._sides[side], (fav, seq if self._by_age else 0, order, wallet, price))
                self._open[order] = qty

        def trade(self, seq: int, order: str, wallet: str, side: str, price: int, qty: int) -> list[tuple]:
            """What a taker trades, ``(maker, its wallet, price, what it had open, filled, bought before)``; the rest rests."""
            other, is_open = self._sides[LIMIT_SELL if side == LIMIT_BUY else LIMIT_BUY], self._open
            left, limit, own, trades = qty, price if side == LIMIT_BUY else -price, [], []
            while left > 0 and other and other[0][0] <= limit:
                _, _, maker, maker_wallet, maker_price = other[0]
                there = is_open.get(maker)
                if there is None:
                    heapq.heappop(other)
                elif maker_wallet == wallet:
                    own.append(heapq.heappop(other))
                else:
                    filled = min(there, left)
                    trades.append((maker, maker_wallet, maker_price, there, filled, qty - left))
                    left -= filled
                    if there > filled:
                        is_open[maker] = there - filled
                    else:
                        del is_open[maker]
            for entry in own:
                heapq.heappush(other, entry)
            self.rest(seq, order, wallet, side, price, left)
            return trades

        def take_off(self, kind: str, order: str, qty: int) -> tuple[int | None, int]:
            """What a cancel or fill found open, and what it took: all or ``qty``, nothing if that is more than there is."""
            there = self._open.get(order)
            if there is None or (kind == FILL and qty > there):
                return there, 0
            taken = there if kind == CANCEL else qty
            if there > taken:
                self._open[order] = there - taken
            else:
                del self._open[order]
            return there, taken

        @staticmethod
        def match_row(seq, order, wallet, base, quote, side, price, qty, trade) -> tuple:
            maker, maker_wallet, maker_price, there, filled, before = trade
            return (seq, MATCHED, order, maker, wallet, maker_wallet, base, quote, side, price, qty, there, filled, maker_price, before)

        @staticmethod
        def ended_row(seq, kind, order, base, quote, ended) -> tuple:
            return (seq, kind, None, order, None, None, base, quote, None, None, None, *ended, None, None)

        @staticmethod
        def batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
            columns = zip(*rows, strict=True) if rows else [[] for _ in schema]
            return pa.RecordBatch.from_arrays([pa.array(values, f.type) for values, f in zip(columns, schema, strict=True)], schema=schema)

    return Books


def _outcome_schema() -> tuple[pa.Schema, str]:
    names = ["seq", "kind", *[c for c in MATCH_COLUMNS if c not in _UNIT_COLUMNS], *_UNIT_COLUMNS]
    types = {"seq": pa.int64()} | {c: pa.int64() for c in _UNIT_COLUMNS}
    ddl = ", ".join(f"{c} {'bigint' if c in types else 'string'}" for c in names)
    return pa.schema([(c, types.get(c, pa.string())) for c in names]), ddl


def _in_money(worked: DataFrame) -> DataFrame:
    return worked.select(
        "seq",
        "kind",
        *[
            (F.col(c).cast("decimal(20,0)") * F.lit(UNIT).cast("decimal(8,8)")).cast(MONEY).alias(c)
            if c in _UNIT_COLUMNS
            else F.col(c)
            for c in MATCH_COLUMNS
        ],
    )


def _in_order(active: DataFrame, time_priority: bool) -> DataFrame:
    """Work through each market: its resting orders first, then what acts by ``seq``."""
    first = (F.col("kind") != _RESTS).alias("acts")
    rows = active.select(*MARKET, first, "seq", "kind", "id", "walletId", "orderType", _units("price"), _units("qty"))
    (schema, ddl), books_type = _outcome_schema(), _books()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        market, books = None, None
        for batch in batches:
            found = []
            for base, quote, _, seq, kind, order, wallet, side, price, qty in zip(
                *(column.to_pylist() for column in batch.columns), strict=True
            ):
                if (base, quote) != market:
                    market, books = (base, quote), books_type(time_priority)
                if kind in (CANCEL, FILL):
                    found.append(books.ended_row(seq, kind, order, base, quote, books.take_off(kind, order, qty)))
                elif kind == SUBMIT:
                    for trade in books.trade(seq, order, wallet, side, price, qty):
                        found.append(books.match_row(seq, order, wallet, base, quote, side, price, qty, trade))
                else:
                    books.rest(seq, order, wallet, side, price, qty)
            yield books_type.batch(found, schema)

    ordered = rows.repartition(*MARKET).sortWithinPartitions(*MARKET, "acts", "seq")
    return _in_money(ordered.mapInArrow(work, ddl))


def _in_slices(active: DataFrame, time_priority: bool, with_commands: bool) -> DataFrame:
    """Work through hot markets slice by slice; see the module's description."""
    limit = max_group_rows(active)
    columns = ["kind", *RESTING]
    resting = stage(active.filter(F.col("kind") == _RESTS).select(*RESTING), "resting")
    numbered = stage(
        running_before(
            active.filter(F.col("kind") != _RESTS).select(*columns), MARKET, ["seq"], sums={"no": F.lit(1).cast("long")}, label="turns"
        ),
        "numbered",
    )
    turns = numbered.agg(F.max("no")).first()[0] + 1
    todo = [(start, min(start + limit, turns)) for start in range(0, turns, limit)]
    done = None
    while todo:
        start, end = todo.pop(0)
        acting = numbered.filter(F.col("no").between(start, end - 1)).select(*columns)
        part = stage(_active(acting, resting, time_priority, with_commands), "slice")
        too_large = has_hot_key(part, MARKET)
        if too_large and end - start > 1:
            middle = (start + end) // 2
            todo = [(start, middle), (middle, end), *todo]
            continue
        if too_large:
            # One event in each market. A command needs its own order only, a taker may need very many.
            takers, alone = acting.filter(_is_taker()), part.join(_named(acting), "id", "left_semi")
            book = part.filter(F.col("kind") == _RESTS).withColumn("status", F.lit(PROCESSED))
            matches = match_snapshot(takers, book, time_priority).join(
                takers.select(F.col("id").alias("takerId"), "seq"), "takerId"
            )
            outcome = matches.select("seq", F.lit(MATCHED).alias("kind"), *MATCH_COLUMNS)
            if with_commands:
                outcome = outcome.unionByName(_in_order(alone.filter(~_is_taker()), time_priority))
        else:
            outcome = _in_order(part, time_priority)
        outcome = stage(outcome, "slice-outcome")
        arrived = acting.filter(_is_taker()).select(*RESTING)
        resting = stage(_book_after(resting.unionByName(arrived), outcome), "resting")
        done = outcome if done is None else done.unionByName(outcome)
    return done


def _book_after(orders: DataFrame, outcome: DataFrame) -> DataFrame:
    """Orders with what they traded, or had taken off, gone from them; those used up leave the book."""
    traded = (
        outcome.select(F.explode(F.array("takerId", "makerId")).alias("id"), "qtyFilled")
        .filter("id is not null")
        .groupBy("id")
        .agg(F.sum("qtyFilled").alias("traded"))
    )
    open_qty = (F.col("qty") - F.coalesce("traded", F.lit(0).cast(MONEY))).cast(MONEY)
    return orders.join(traded, "id", "left").withColumn("qty", open_qty).filter("qty > 0").select(*RESTING)
