"""Streams give what batches give, each event counts once, and feeds show committed changes only."""

from __future__ import annotations

import json

from builders import D

from sparkbourse.plans.queries import subscribe, unsubscribe
from sparkbourse.plans.settle import replay
from sparkbourse.sources.events import LOG, read_events
from sparkbourse.sources.state import StateStore, seed_wallets
from sparkbourse.streaming import feeds, run
from test_settle import deposit, log, random_log, store


def write_part(spark, path, events, start):
    log(spark, events, start).coalesce(1).write.mode("append").parquet(path)


def rows(frame):
    return sorted(map(str, frame.collect()))


def test_stream_equals_replay_and_restarts(spark, tmp_path):
    balances = [(f"w{w}", a, 40) for w in range(4) for a in ("B", "Q0", "Q1")]
    events, source = random_log(3, 16), str(tmp_path / "source")
    (tmp_path / "x").mkdir()
    streamed, replayed = store(spark, tmp_path, balances), store(spark, tmp_path / "x", balances)
    checkpoint = str(tmp_path / "checkpoint")
    for part in range(2):
        write_part(spark, source, events[part * 8 : part * 8 + 8], part * 8)
        records = read_events(spark, source, streaming=True, max_files=1)
        run.run_orders(records, streamed, checkpoint).awaitTermination()
        assert streamed.latest() == part + 1
    replay(replayed, log(spark, events), 8)
    for table in ("orders", "wallets"):
        assert rows(streamed.load(table)) == rows(replayed.load(table))

    # Files of a version that was never committed are invisible, to tables and to feeds.
    streamed.load("orders").limit(1).write.parquet(streamed._path("order_changes", 9))
    seen = []
    query = feeds.committed_changes(
        streamed, "order_changes", lambda df, _: seen.extend(df.select("version", "id", "status").collect()), str(tmp_path / "push")
    )
    query.awaitTermination()
    assert sorted(map(str, seen)) == rows(streamed.feed("order_changes").select("version", "id", "status"))
    assert {r.version for r in seen} == {1, 2}

    # Two clients follow an order each; one of them leaves again.
    wanted = streamed.load("orders").filter("seq in (0, 1)").selectExpr("id as orderId", "seq as requestId")
    subscriptions = subscribe(wanted)
    left = unsubscribe(subscriptions, spark.createDataFrame([("1",)], "handle string"))
    followed = []
    query = feeds.followed_orders(
        streamed, lambda _: left, lambda df, _: followed.extend(df.select("id", "feedId").collect()), str(tmp_path / "follow")
    )
    query.awaitTermination()
    (only,) = {r.id for r in followed}
    assert only == wanted.filter("requestId = 0").first().orderId
    assert all(r.feedId.startswith(f"order/{only}/") for r in followed)


def test_ledger_stream_skips_committed_batches(spark, tmp_path):
    source = str(tmp_path / "source")
    write_part(spark, source, [deposit(f"e{i}", "w", "BTC", op, 5) for i, op in enumerate(["CREDIT", "DEBIT", "DEBIT"])], 0)
    ledger_store = run.fresh_start(spark, str(tmp_path / "state"))
    for attempt in ("first", "again"):
        # A lost checkpoint delivers the batch again; its version is committed already.
        records = read_events(spark, source, streaming=True)
        run.run_ledger(records, ledger_store, str(tmp_path / attempt)).awaitTermination()
    (w,) = ledger_store.load("wallets").collect()
    assert (w.amount, w.txCount) == (0, 2)
    assert [(r.seq, r.available) for r in ledger_store.feed("rejections").collect()] == [(2, 0)]


def test_a_lost_checkpoint_loses_no_input(spark, tmp_path):
    source = str(tmp_path / "source")
    ledger_store = run.fresh_start(spark, str(tmp_path / "state"))
    for attempt, (amount, start) in enumerate([(5, 0), (7, 1), (9, 2)]):
        # Each run has a new checkpoint, so that everything is delivered again together with what is new.
        write_part(spark, source, [deposit(f"e{start}", "w", "BTC", "CREDIT", amount)], start)
        records = read_events(spark, source, streaming=True)
        run.run_ledger(records, ledger_store, str(tmp_path / f"checkpoint{attempt}")).awaitTermination()
    (w,) = ledger_store.load("wallets").collect()
    assert (w.amount, w.txCount) == (21, 3) and ledger_store.latest() == 3


def test_a_broken_off_compaction_hides_nothing(spark, tmp_path):
    s = store(spark, tmp_path, [("w", "BTC", 5)], compact_every=100)
    s.commit(1, {t: s.load(t).selectExpr("*", "false as is_delete") for t in ("orders", "wallets")}, {})
    folder = tmp_path / "state" / "wallets" / "snapshot" / "version=1"
    (folder / "_temporary").mkdir(parents=True)
    assert [r.amount for r in s.load("wallets").collect()] == [5]
    s.compact(1)
    assert s._snapshots("wallets") == [0, 1] and [r.amount for r in s.load("wallets").collect()] == [5]


def test_a_commit_is_one_file(spark, tmp_path):
    s = store(spark, tmp_path, [("w", "BTC", 5)])
    commits = tmp_path / "state" / "commits"
    assert [f.name for f in commits.iterdir() if not f.name.startswith(".")] == ["version=0"] and (commits / "version=0").is_file()
    (commits / ".half-written").write_text("{")
    assert s.committed() == [0]


def test_state_versions_and_compaction(spark, tmp_path):
    s = StateStore(spark, str(tmp_path / "state"), compact_every=2)
    s.seed(wallets=seed_wallets(spark.createDataFrame([("w", "BTC", D(1), D(0))], "walletId string, assetId string, amount decimal(36,16), blocked decimal(36,16)")))
    for version in range(1, 4):
        delta = spark.createDataFrame(
            [("w", "BTC", D(version * 10), D(0), version, True, False), ("gone", "BTC", D(1), D(0), 1, True, version == 3)],
            "walletId string, assetId string, amount decimal(36,16), blocked decimal(36,16), txCount long, held boolean, is_delete boolean",
        )
        s.commit(version, {"wallets": delta, "orders": s.load("orders").selectExpr("*", "false as is_delete")}, {})

    def held(version=None):
        return {r.walletId: r.amount for r in s.load("wallets", version).collect()}

    assert held(0) == {"w": 1}
    assert held(1) == {"w": 10, "gone": 1}
    assert held(2) == {"w": 20, "gone": 1}
    assert held() == {"w": 30}
    assert s._snapshots("wallets") == [0, 2]


def test_log_schema_is_stable():
    assert json.loads(LOG.json())["fields"][2]["name"] == "seq"
