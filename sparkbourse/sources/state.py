"""Versioned state: orders and wallet balances after each batch, in plain parquet folders.

``<root>/<table>/snapshot/version=N`` holds a whole table, ``<root>/<table>/delta/version=N`` the rows batch N changed,
``<root>/<feed>/version=N`` what batch N appended to a feed, ``<root>/inputs/version=N`` the log positions it covers. A
version exists once the file ``<root>/commits/version=N`` does, which is written aside and renamed last: readers never see
part of a batch, and a retried batch writes over its own folders only. A snapshot counts once it has a mark of its own.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkbourse.schemas import LEDGER, ORDER_STATE, WALLET_STATE
from sparkbourse.session import COMPRESSION
from sparkbourse.sources.tables import last_changes

VERSION = "version"
_DELETED = T.StructField("is_delete", T.BooleanType())
_VERSION = T.StructField(VERSION, T.LongType())
TABLES: dict[str, tuple[T.StructType, list[str]]] = {
    "orders": (ORDER_STATE, ["id"]),
    "wallets": (WALLET_STATE, ["walletId", "assetId"]),
}


class StateStore:
    def __init__(self, spark: SparkSession, root: str, compact_every: int = 10):
        self.spark, self.root, self.compact_every = spark, root.rstrip("/"), compact_every
        self._known: dict[int, list[int] | None] = {}

    def _at(self, path: str):
        """File system and path under the root."""
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{path}")
        return hadoop.getFileSystem(self.spark._jsc.hadoopConfiguration()), hadoop

    def _versions(self, folder: str) -> list[int]:
        """Versions present in a folder; a listing of names, its length bounded by the number of batches."""
        fs, hadoop = self._at(folder)
        if not fs.exists(hadoop):
            return []
        names = [status.getPath().getName() for status in fs.listStatus(hadoop)]
        return sorted(int(n.split("=")[1]) for n in names if n.startswith(f"{VERSION}="))

    def _write_file(self, path: str, text: str) -> None:
        """A small file that is there as a whole or not at all."""
        aside = f"{path.rpartition('/')[0]}/.{uuid.uuid4().hex}"
        fs, temporary = self._at(aside)
        stream = fs.create(temporary, True)
        stream.write(bytearray(text.encode()))
        stream.close()
        target = self._at(path)[1]
        if not fs.rename(temporary, target):
            fs.delete(temporary, False)
            if not fs.exists(target):
                raise OSError(f"could not write {target}")

    def _snapshots(self, table: str) -> list[int]:
        """Snapshots that were written to their end."""
        found = self._versions(f"{table}/snapshot")
        return [v for v in found if self._complete(table, v)]

    def _complete(self, table: str, version: int) -> bool:
        fs, mark = self._at(f"{table}/snapshot/{VERSION}={version}/_complete")
        return fs.exists(mark)

    def committed(self) -> list[int]:
        return self._versions("commits")

    def latest(self) -> int | None:
        versions = self.committed()
        return versions[-1] if versions else None

    def _path(self, folder: str, version: int) -> str:
        return f"{self.root}/{folder}/{VERSION}={version}"

    def _read(self, folder: str, versions: Sequence[int], schema: T.StructType) -> DataFrame:
        if not versions:
            return self.spark.createDataFrame([], T.StructType([*schema.fields, _VERSION]))
        with_version = T.StructType([*schema.fields, _VERSION])
        paths = [self._path(folder, v) for v in versions]
        return self.spark.read.option("basePath", f"{self.root}/{folder}").schema(with_version).parquet(*paths)

    def load(self, table: str, version: int | None = None) -> DataFrame:
        """A table as of a committed version: the last snapshot and the deltas since."""
        schema, keys = TABLES[table]
        committed = [v for v in self.committed() if version is None or v <= version]
        bases = [v for v in self._snapshots(table) if v in committed]
        base = bases[-1:]
        newer = [v for v in committed if not base or v > base[0]]
        rows = self._read(f"{table}/snapshot", base, schema).select(*schema.fieldNames())
        if not newer:
            return rows
        # Only the changed rows are grouped; the snapshot, which is far larger, is just filtered by their keys.
        deltas = self._read(f"{table}/delta", newer, T.StructType([*schema.fields, _DELETED]))
        changed = last_changes(deltas, keys, [VERSION])
        return upsert(rows, changed, keys)

    def feed(self, name: str, after: int = 0) -> DataFrame:
        """Committed rows of a feed written by versions later than ``after``, with the version."""
        paths = [self._path(name, v) for v in self.committed() if v > after]
        return self.spark.read.option("basePath", f"{self.root}/{name}").parquet(*paths)

    def seed(self, orders: DataFrame | None = None, wallets: DataFrame | None = None) -> None:
        """State to start from, as version 0."""
        for table, rows in (("orders", orders), ("wallets", wallets)):
            schema, _ = TABLES[table]
            rows = self.spark.createDataFrame([], schema) if rows is None else rows.select(*schema.fieldNames())
            self._snapshot(table, rows, 0)
        self._mark(0, None)

    def _snapshot(self, table: str, rows: DataFrame, version: int) -> None:
        rows.write.mode("overwrite").parquet(self._path(f"{table}/snapshot", version), compression=COMPRESSION)
        self._write_file(f"{table}/snapshot/{VERSION}={version}/_complete", "")

    def append(self, name: str, version: int, rows: DataFrame) -> DataFrame:
        """Write what a version adds to a feed, seen by nobody until it is committed, and read it back."""
        path = self._path(name, version)
        rows.write.mode("overwrite").parquet(path, compression=COMPRESSION)
        return self.spark.read.schema(rows.schema).parquet(path)

    def commit(
        self, version: int, deltas: Mapping[str, DataFrame], feeds: Mapping[str, DataFrame], inputs: DataFrame | None = None
    ) -> None:
        """Make a batch's changes visible, all of them or none, with the positions ``inputs(seq)`` that it covers."""
        for table, rows in deltas.items():
            columns = [*TABLES[table][0].fieldNames(), "is_delete"]
            rows.select(*columns).write.mode("overwrite").parquet(self._path(f"{table}/delta", version), compression=COMPRESSION)
        for name, rows in feeds.items():
            self.append(name, version, rows)
        covered = None
        if inputs is not None:
            inputs.select("seq").write.mode("overwrite").parquet(self._path("inputs", version), compression=COMPRESSION)
            written = self.spark.read.schema("seq long").parquet(self._path("inputs", version))
            covered = list(written.agg(F.min("seq"), F.max("seq")).first())
        self._mark(version, covered)
        if version % self.compact_every == 0:
            self.compact(version)

    def uncovered(self, batch: DataFrame) -> DataFrame | None:
        """Records of ``batch`` whose position no committed version covers; None if there are none.

        Positions tell sources apart (``events.position``); a record without one could not be told from others and is an error.

        The first and last position of each version tell where to look, so a batch that follows all others is not
        compared with any.
        """
        low, high, without = batch.agg(F.min("seq"), F.max("seq"), F.count_if(F.col("seq").isNull())).first()
        if without:
            raise ValueError(f"{without} records without a position")
        if low is None:
            return None
        near = [v for v, covered in self._covered().items() if covered and covered[0] <= high and covered[1] >= low]
        if not near:
            return batch
        done = self.spark.read.schema("seq long").parquet(*[self._path("inputs", v) for v in near])
        fresh = batch.join(done, "seq", "left_anti").select(*batch.columns)
        return None if fresh.isEmpty() else fresh

    def _covered(self) -> dict[int, list[int] | None]:
        """First and last position of each committed version; one small file each, read once."""
        for version in self.committed():
            if version not in self._known:
                fs, path = self._at(f"commits/{VERSION}={version}")
                stream = fs.open(path)
                text = bytes(stream.readAllBytes()).decode()
                stream.close()
                self._known[version] = json.loads(text)["covered"]
        return self._known

    def compact(self, version: int) -> None:
        """Write a snapshot so that readers need no older delta; nothing depends on it being there."""
        for table in TABLES:
            if not self._complete(table, version):
                self._snapshot(table, self.load(table, version), version)

    def _mark(self, version: int, covered: list[int] | None) -> None:
        self._write_file(f"commits/{VERSION}={version}", json.dumps({"version": version, "covered": covered}))


def upsert(state: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A table after a set of changes: at most one per key, deletions marked by ``is_delete``."""
    kept = state.join(changes.select(*keys), [*keys], "left_anti")
    return kept.unionByName(changes.filter("not is_delete").select(*state.columns))


def seed_wallets(balances: DataFrame) -> DataFrame:
    """Wallet state from ``(walletId, assetId, amount, blocked)`` rows."""
    return balances.select(
        "walletId",
        "assetId",
        F.col("amount").cast(LEDGER).alias("amount"),
        F.col("blocked").cast(LEDGER).alias("blocked"),
        F.lit(0).cast("long").alias("txCount"),
        F.lit(True).alias("held"),
    )
