"""Positions of several sources, and the ledger in the state store."""

from __future__ import annotations

import pandas as pd
import pytest
from builders import D
from test_settle import deposit, log

from sparkbourse.operators import ledger
from sparkbourse.plans import catalog
from sparkbourse.plans.settle import deposits
from sparkbourse.sources import events, testviews
from sparkbourse.sources.codec import decode_commands, decode_events, decode_orders, encode_events, split_corrupt
from sparkbourse.streaming import run, stateful


def write(spark, path, amount, at):
    log(spark, [deposit(f"e{path[-1]}{at}", "w", "BTC", "CREDIT", amount)], at).coalesce(1).write.mode("append").parquet(path)


def test_equal_positions_of_two_logs_both_count(spark, tmp_path):
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    store = run.fresh_start(spark, str(tmp_path / "state"))
    write(spark, a, 5, 1)
    write(spark, b, 1, 100)
    for attempt in range(2):
        records = events.read_events(spark, [a, b], streaming=True)
        run.run_ledger(records, store, str(tmp_path / f"checkpoint{attempt}")).awaitTermination()
        (w,) = store.load("wallets").collect()
        assert (w.amount, w.txCount) == ((6, 2), (13, 3))[attempt]
        if not attempt:
            write(spark, b, 7, 1)  # the same place that log a has filled


def test_positions_of_topics_stay_when_partitions_come(spark):
    rows = [("t1", 0, 5), ("t1", 1, 5), ("t2", 0, 5), ("t1", 7, 5), ("t1", 0, 6)]
    frame = spark.createDataFrame([(t, p, o, b"k", b"v") for t, p, o in rows], "topic string, partition int, offset long, key binary, value binary")
    few = events.kafka_log(frame.filter("partition < 2 and topic = 't1'"), ["t1"]).collect()
    many = events.kafka_log(frame, ["t1", "t2"])
    assert {r.seq for r in few} <= {r.seq for r in many.collect()} and many.select("seq").distinct().count() == len(rows)
    parts = many.select(events.place_in_source(many.seq).alias("place"), events.source_number(many.seq).alias("source")).collect()
    assert sorted(tuple(r) for r in parts) == sorted((o, (t == "t2") * events.PARTITIONS + p) for t, p, o in rows)
    with pytest.raises(Exception, match="more than 1024 partitions"):
        events.kafka_log(spark.createDataFrame([("t1", 5000, 1, b"", b"")], frame.schema), ["t1"]).collect()


def test_records_without_a_position_are_an_error(spark, tmp_path):
    store = run.fresh_start(spark, str(tmp_path / "state"))
    with pytest.raises(ValueError, match="without a position"):
        store.uncovered(spark.createDataFrame([("k", "v", None), ("k", "v", 1)], events.LOG))


def test_state_survives_a_restart_and_equals_the_fold(spark, tmp_path):
    moves = [("CREDIT", 9), ("BLOCK", 5), ("DEBIT", 5), ("DEBIT", 4), ("CREDIT", 1), ("BLOCK", 2), ("DEBIT", 1)]
    sent = [deposit(f"e{i}", f"w{i % 2}", "BTC", op, amount) for i, (op, amount) in enumerate(m for m in moves for _ in range(2))]
    source, out, checkpoint = (str(tmp_path / n) for n in ("log", "changes", "checkpoint"))
    for start in (0, 6, 11):
        end = {0: 6, 6: 11, 11: len(sent)}[start]
        log(spark, sent[start:end], start).repartition(2).write.mode("append").parquet(source)
        records = events.read_events(spark, source, streaming=True)
        stateful.run_stateful_ledger(records, out, checkpoint).awaitTermination()
    changes = spark.read.schema(stateful.CHANGES).parquet(out)
    want = ledger.decide(deposits(decode_events(log(spark, sent)))).select("seq", "accepted", "availableFunds")
    assert sorted(map(tuple, changes.select("seq", "accepted", "availableFunds").collect())) == sorted(map(tuple, want.collect()))
    held = {r.walletId: (r.amount, r.blocked, r.txCount) for r in stateful.balances(changes).collect()}
    assert held["w0"] == held["w1"] and held["w0"] == (D(5), D(5), 5)


def test_numbers_go_out_as_they_came_in(spark):
    text = '{"id": "e", "walletCommand": {"id": "c", "causeId": "x", "walletId": "w", "assetId": "a", "operation": "CREDIT", "amount": 1234567890123456.12345678}}'
    good = split_corrupt(decode_events(spark.createDataFrame([("k", text, 1)], events.LOG)))[0]
    again = split_corrupt(decode_events(encode_events(good)))[0]
    for df in (good, again):
        assert df.select("event.walletCommand.amount").first()[0] == D("1234567890123456.12345678")


def test_bare_records(spark):
    order = '{"id": "o", "baseAssetId": "B", "quoteAssetId": "Q", "walletId": "w", "orderType": "LIMIT_BUY", "price": 2}'
    command = '{"id": "c", "orderId": "o", "causeId": "o", "command": "SUBMIT", "order": %s}' % order
    other = '{"walletId": "w", "assets": {}}'
    texts = [command, order, f"{command}, \"wallet\": {other}", None, "", "7", "{}"]
    raw = spark.createDataFrame([("k", t, i) for i, t in enumerate(texts)], events.LOG)
    rows = {r.seq: r for r in decode_commands(raw).collect()}
    assert [i for i in rows if rows[i].reason is None] == [0] and rows[0].event.orderCommand.order.qty == 0
    assert rows[0].value == command and rows[0].event.id == decode_commands(raw).first().event.id
    good, dead = split_corrupt(decode_orders(raw))
    assert [(r.seq, r.event.order.status) for r in good.collect()] == [(1, "NEW")]
    assert {r.seq: r.value for r in dead.collect()} == {i: t for i, t in enumerate(texts) if i != 1}


class _Entries:
    """A map state that counts its calls."""

    def __init__(self):
        self.kept, self.reads, self.writes = {}, 0, 0

    def getMapState(self, name, key, value):
        return self

    def getValue(self, key):
        self.reads += 1
        return self.kept.get(key)

    def updateValue(self, key, value):
        self.writes += 1
        self.kept[key] = value


def test_one_call_takes_many_balances_and_touches_each_once():
    state, balances = _Entries(), stateful.Balances()
    balances.init(state)
    rows = [(f"w{i % 40}", "a", i, D(2) if i % 3 == 0 else None, D(-2) if i % 3 == 0 else D(1), D(0)) for i in range(400)]
    got, want = [], {}
    for part in (rows[:200], rows[200:]):
        frames = [pd.DataFrame(half, columns=["walletId", "assetId", "seq", "asks", "more", "block"]) for half in (part[1::2], part[::2])]
        got += [tuple(r) for f in balances.handleInputRows((0,), iter(frames), None) for r in f.itertuples(index=False)]
    assert (state.reads, state.writes) == (80, 80)
    for wallet, _, seq, asks, more, _ in rows:
        held, count = want.get(wallet, (D(0), 0))
        accepted = asks is None or asks <= held
        want[wallet] = (held + more, count + 1) if accepted else (held, count)
        (row,) = [r for r in got if r[2] == seq]
        assert (row[0], row[3], row[5], row[7]) == (wallet, accepted, *want[wallet])


def test_keys_share_calls(spark):
    commands = spark.readStream.format("rate").load().selectExpr(
        "cast(value as string) walletId", "'a' assetId", "value seq", "'CREDIT' operation", "1.0 amount", "0.0 amountRelease"
    )
    before = spark.conf.get(stateful.PROVIDER_CONF)
    spark.conf.set(stateful.PROVIDER_CONF, stateful.ROCKSDB)
    try:
        plan = stateful.stateful_changes(commands)._jdf.queryExecution().analyzed().toString()
    finally:
        spark.conf.set(stateful.PROVIDER_CONF, before)
    assert "pmod(xxhash64(walletId" in plan and str(stateful.BUCKETS) in plan


def test_a_log_is_made_and_written_by_more_tasks_as_it_grows(spark, tmp_path, monkeypatch):
    folder = "/root/testdata/sf0.001"
    cores = spark.sparkContext.defaultParallelism
    assert testviews.wallet_log(spark, folder).rdd.getNumPartitions() >= cores
    assert testviews.raw_log(spark, folder).rdd.getNumPartitions() >= 2 * cores
    monkeypatch.setattr(catalog, "FILE_ROWS", 20)
    log_rows = spark.range(303).selectExpr("'k' key", "'v' value", "id seq")
    path = str(tmp_path / "parts")
    files = catalog._write_parts(log_rows, path, 3)
    assert files == 6 and len(list((tmp_path / "parts").glob("*.parquet"))) == 18
    read, firsts = events.read_events(spark, path, streaming=True, max_files=files), []
    take = lambda batch, n: firsts.append(tuple(batch.selectExpr("min(seq)", "max(seq)", "count(*)").first()))
    read.writeStream.foreachBatch(take).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
    assert firsts == [(0, 100, 101), (101, 201, 101), (202, 302, 101)]
