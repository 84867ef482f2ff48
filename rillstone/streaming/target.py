"""The target of a replication: a log-structured table of rows, and all state in one versioned row.

A row belongs to a collection's number, not to its name, so creating, dropping and renaming change the
catalog and no row. A commit writes one run: the rows that it changes and marks of those that are gone, sorted by a
hash of their keys, so that what it writes is in proportion to what it changes. Reading merges runs, the newest row of
a key counts. Runs stand in levels, each RATIO times as large as the one above: once FAN young runs have gathered they are
merged with as many levels as they fill, so that a row is rewritten a few times a level, whatever the
target's size. A merged run lies in folders of a range of hashes each, as many as keep one below BUCKET_BYTES;
reading some keys reads their folders only.

A commit swaps the state's version for the next one, and fails where another writer has done so since it was read
or where a later lease has begun; its run is then deleted. Folders have names of their own, so that no writer
touches another's. Runs that a state no longer names are deleted one state later.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterable
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.catalog import Catalog
from ..session import written
from ..sources.logs import Stale, StateTable

TARGET = "db string, coll string, key string, doc string"
PLACE = "struct<t:bigint,i:bigint,seq:bigint>"
STORED = f"cid long, key string, doc string, born {PLACE}"
RUN = f"h long, {STORED}, gone boolean"
#: Bytes of files that a folder of a merged run holds, about; of the first level; how many times as large the next one is;
#: young runs that are merged at once.
BUCKET_BYTES, FIRST_LEVEL, RATIO, FAN = 512 << 20, 64 << 20, 8, 8
#: Rows of the driver, and bytes of files, up to which a side of a join is broadcast.
SMALL, SMALL_BYTES = 50_000, 8 << 20
#: Bytes of the least document.
LEAST_DOCUMENT = 5


def small_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """Rows of the driver as a table, marked for broadcast unless they are many."""
    out = spark.createDataFrame(rows, schema)
    return F.broadcast(out) if len(rows) <= SMALL else out


def identity(key: Column) -> Column:
    """The document's own key: a key of several fields counts by its _id."""
    return F.coalesce(F.get_json_object(key, "$._id"), key)


def slot(cid: Column, key: Column) -> Column:
    """The hash by which rows are sorted: rows of one _id have one."""
    return F.xxhash64(cid, identity(key))


class Target:
    def __init__(self, spark: SparkSession, path: str, bucket_bytes: int = BUCKET_BYTES, first_level: int = FIRST_LEVEL, ratio: int = RATIO, fan: int = FAN):
        self.spark, self.path = spark, path
        self.bucket_bytes, self.first_level, self.ratio, self.fan = bucket_bytes, first_level, ratio, fan
        self.table = StateTable(spark, f"{path}/state")
        self.epoch = 0  # that of the lease under which this one writes
        self.refresh()

    def refresh(self) -> None:
        """Reads the latest state anew."""
        version, state = self.table.latest()
        self.state: dict[str, Any] = (state or {"runs": [], "retired": []}) | {"version": version}

    @property
    def catalog(self) -> Catalog:
        return Catalog.from_json(self.state.get("catalog"))

    # Runs: {path, bits, bytes, level}, the newest first.

    def _run(self, run: dict[str, Any], slots: set[int] | None, bits: int) -> DataFrame:
        """A run's rows; slots: the first bits of the hashes that count, others may be left out."""
        if not run["bits"]:
            return self.spark.read.schema(RUN).parquet(f"{self.path}/{run['path']}")
        rows = self.spark.read.schema(f"{RUN}, bucket int").parquet(f"{self.path}/{run['path']}")
        if slots is not None:
            rows = rows.filter(F.col("bucket").isin(sorted({s >> (bits - run["bits"]) for s in slots})))
        return rows.drop("bucket")

    def _bucket(self, bits: int) -> Column:
        return F.shiftrightunsigned("h", 64 - bits).cast("int")

    def _merged(self, runs: list[dict[str, Any]], only: DataFrame | None = None, gone: bool = False) -> DataFrame:
        """The newest row of every key of runs (RUN); only: a table of the hashes h that count; gone: with marks of keys that are gone."""
        slots, bits = None, max((r["bits"] for r in runs), default=0)
        if only is not None and bits:
            slots = {r.b for r in only.select(self._bucket(bits).alias("b")).distinct().collect()}  # a number a folder at most
        parts = [self._run(r, slots, bits) for r in runs]
        if only is not None:
            parts = [p.join(only, "h", "left_semi") for p in parts]
        if len(parts) <= 1:
            top = parts[0] if parts else self.spark.createDataFrame([], RUN)
            return top if gone else top.filter("NOT gone")
        young = None
        for n, p in enumerate(parts[:-1]):
            p = p.withColumn("n", F.lit(-n))
            young = p if young is None else young.unionByName(p)
        if len(parts) > 2:
            last = F.max_by(F.struct("doc", "born", "gone"), "n").alias("last")
            young = young.groupBy("h", "cid", "key").agg(last).select("h", "cid", "key", "last.*")
        keys = young.select("h", "cid", "key")
        if sum(r["bytes"] for r in runs[:-1]) <= SMALL_BYTES:
            keys = F.broadcast(keys)
        old = parts[-1].join(keys, ["h", "cid", "key"], "left_anti")
        out = old.unionByName(young.select(*old.columns))
        return out if gone else out.filter("NOT gone")

    def rows(self, only: DataFrame | None = None) -> DataFrame:
        """Stored rows; only of hashes h that a table names, if it is given."""
        return self._merged(self.state["runs"], only).select("cid", "key", "doc", "born")

    def named(self, rows: DataFrame, catalog: Catalog | None = None) -> DataFrame:
        """rows with the names of their collections; those of dropped ones go."""
        names = [(c.cid, db, coll) for (db, coll), c in (catalog or self.catalog).collections.items()]
        return rows.join(small_table(self.spark, names, "cid long, db string, coll string"), "cid")

    def read(self) -> DataFrame:
        return self.named(self.rows()).select("db", "coll", "key", "doc")

    def collection(self, db: str, coll: str) -> DataFrame:
        """key, doc, born of one collection."""
        found = self.catalog.collections.get((db, coll))
        return self.rows().filter(F.col("cid") == (found.cid if found else -1)).drop("cid")

    def natural(self, db: str, coll: str) -> DataFrame:
        """key and doc of a collection in the order of insertion; of a capped one the last that it may hold, by number and by bytes."""
        found = self.catalog.collections.get((db, coll))
        rows = self.collection(db, coll)
        order = [F.col("born").desc_nulls_last(), F.col("key").desc()]
        most, size = (int(found.options.get(o) or 0) if found and found.capped else 0 for o in ("max", "size"))
        if most or size:
            rows = rows.orderBy(*order).limit(min(x for x in (most, size // LEAST_DOCUMENT + 1 if size else 0) if x))
        if size:  # the rows that a cap's bytes can hold
            upto = F.sum(F.octet_length("doc")).over(Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
            rows = rows.withColumn("_upto", upto).filter(F.col("_upto") <= size)
        return rows.orderBy(F.col("born").asc_nulls_first(), "key").select("key", "doc")

    # Writing.

    def _written(self, rows: DataFrame, bits: int, level: int | None) -> dict[str, Any] | None:
        """rows (RUN) as a new run; None if there is none."""
        path = f"data/{uuid.uuid4().hex}"
        if bits:
            rows = rows.withColumn("bucket", self._bucket(bits)).repartition(1 << bits, "bucket").sortWithinPartitions("bucket", "h", "cid", "key")
            rows.write.partitionBy("bucket").parquet(f"{self.path}/{path}")
        else:
            rows.repartitionByRange("h").sortWithinPartitions("h", "cid", "key").write.parquet(f"{self.path}/{path}")
        if not bits and self.spark.read.schema(RUN).parquet(f"{self.path}/{path}").isEmpty():
            self.table.delete(f"{self.path}/{path}")
            return None
        size = self.table.size(f"{self.path}/{path}")
        return {"path": path, "bits": bits, "bytes": size, "level": self._level(size) if level is None else level}

    def _cap(self, level: int) -> int:
        return self.first_level * self.ratio ** (level - 1)

    def _level(self, size: int) -> int:
        """The least level that holds so many bytes."""
        return next(k for k in range(1, 100) if size <= self._cap(k))

    def _due(self, runs: list[dict[str, Any]]) -> int:
        """How many of the youngest runs to merge: all young ones once there are FAN, and the levels that they fill, so that every level is one run."""
        n = sum(r["level"] == 0 for r in runs)
        if n < self.fan:  # what was merged or loaded may have come to be as large as the level below
            full = [k for k in range(n, len(runs) - 1) if runs[k]["level"] >= runs[k + 1]["level"]]
            if not full:
                return 0
            n = full[0] + 2
        size = sum(r["bytes"] for r in runs[:n])
        while n < len(runs) and (size > self._cap(runs[n]["level"]) or runs[n]["level"] <= self._level(size)):
            size += runs[n]["bytes"]
            n += 1
        return n

    def compact(self, runs: list[dict[str, Any]], n: int, alive: Iterable[int]) -> list[dict[str, Any]]:
        """runs with the n youngest merged into one; rows of collections that are not alive go, and marks of what is gone, once nothing older is left."""
        whole = n == len(runs)
        rows = self._merged(runs[:n], gone=not whole)
        rows = rows.join(small_table(self.spark, [(c,) for c in alive], "cid long"), "cid", "left_semi").select(*[c.split()[0] for c in ("h", "cid", "key", "doc", "born", "gone")])
        bits = max(0, math.ceil(math.log2(max(1, sum(r["bytes"] for r in runs[:n]) / self.bucket_bytes))))
        made = self._written(rows, bits, None)
        return ([made] if made else []) + runs[n:]

    def commit(self, changed: DataFrame | None = None, **state: Any) -> None:
        """Adds a run of changed rows (STORED and gone) and swaps the state; Stale if another writer was faster."""
        latest = self.table.latest()[1] or {}
        if latest.get("epoch", 0) > self.epoch:
            raise Stale(f"epoch {latest['epoch']} has begun, this writer is of {self.epoch}")
        before = self.state["runs"]
        runs, made = list(before), []
        try:
            if changed is not None:
                run = self._written(changed.withColumn("h", slot(F.col("cid"), F.col("key"))).select("h", "cid", "key", "doc", "born", "gone"), 0, 0)
                runs = ([run] if run else []) + runs
                made = [run["path"]] if run else []
            while n := self._due(runs):
                alive = [c.cid for c in Catalog.from_json(state.get("catalog", self.state.get("catalog"))).collections.values()]
                runs = self.compact(runs, n, alive)
                made += [r["path"] for r in runs[:1] if r not in before and r["path"] not in made]
            kept = {r["path"] for r in runs}
            retired = [p for p in [*(r["path"] for r in before), *made] if p not in kept]
            new = self.state | state | {"runs": runs, "retired": retired, "epoch": self.epoch}
            version = self.table.write({k: v for k, v in new.items() if k != "version"}, after=self.state["version"])
        except BaseException:
            for path in made:
                self.table.delete(f"{self.path}/{path}")
            raise
        gone = self.state["retired"]
        self.state = new | {"version": version}
        for path in gone:
            self.table.delete(f"{self.path}/{path}")

    def load(self, rows: DataFrame, **state: Any) -> None:
        """Adds rows (STORED) of keys that are not there, as a run of the level of its size, without touching others."""
        run = self._written(rows.withColumns({"h": slot(F.col("cid"), F.col("key")), "gone": F.lit(False)}).select("h", "cid", "key", "doc", "born", "gone"), 0, None)
        if run is None:
            return self.commit(None, **state)
        younger = [r for r in self.state["runs"] if r["level"] <= run["level"]]
        older = [r for r in self.state["runs"] if r["level"] > run["level"]]
        held, self.state = self.state, self.state | {"runs": [*younger, run, *older]}  # keys are new: order does not count
        try:
            self.commit(None, **state)
        except BaseException:
            self.state = held
            self.table.delete(f"{self.path}/{run['path']}")
            raise

    def change(self, had: DataFrame, new: DataFrame) -> DataFrame:
        """The rows that turn had into new (STORED both), and marks (gone) of keys that only had has."""
        new = written(new, "changed")
        lost = had.select("cid", "key").join(new.select("cid", "key"), ["cid", "key"], "left_anti")
        lost = lost.select("cid", "key", F.lit(None).cast("string").alias("doc"), F.lit(None).cast(PLACE).alias("born"), F.lit(True).alias("gone"))
        return new.select("cid", "key", "doc", "born", F.lit(False).alias("gone")).unionByName(lost)

    def orphans(self) -> list[str]:
        """Folders of runs that no state names: what a writer that died has left."""
        named = {p for _, s in self.table.all() for p in [*(r["path"] for r in s["runs"]), *s["retired"]]}
        return [p for p in (f"data/{n}" for n in self.table.names(f"{self.path}/data")) if p not in named]
