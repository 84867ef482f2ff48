"""Reading and writing logs, snapshots and state tables; options of connections."""

from __future__ import annotations

import json
import threading
import time
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The change log: one row an event, ordered by t, i, seq.
EVENT_SCHEMA = (
    "seq long, t long, i long, op string, db string, coll string, collection_uuid string, txn_number long, lsid string, "
    "document_key string, full_document string, updated_fields array<struct<path:string,value:string>>, removed_fields array<string>, "
    "truncated_arrays array<struct<field:string,new_size:int>>, op_desc string, disambiguated_paths map<string,array<string>>"
)
DML, TICK = ("insert", "update", "replace", "delete"), "@tick"
#: Options that a source's address may carry.
ALLOWED_OPTIONS = frozenset({"compressors", "readPreference", "replicaSet", "tls", "tlsCAFile", "authSource", "authMechanism", "connectTimeoutMS", "socketTimeoutMS", "appName", "directConnection"})
COMPRESSORS = {"snappy": "snappy", "zlib": "gzip", "zstd": "zstd"}


class HistoryLost(RuntimeError):
    """The log no longer reaches back to where reading should resume."""


def source_options(options: dict[str, str]) -> dict[str, str]:
    """The options that are allowed; others are refused by name."""
    unknown = sorted(set(options) - ALLOWED_OPTIONS)
    if unknown:
        raise ValueError(f"options not allowed: {', '.join(unknown)}")
    return options


def compressors(names: str) -> list[str]:
    """Known compressors of a comma-separated list, in order, once each."""
    return list(dict.fromkeys(COMPRESSORS[n.strip()] for n in names.split(",") if n.strip() in COMPRESSORS))


def read_log(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.schema(EVENT_SCHEMA).format(fmt).load(path)


def stream_log(spark: SparkSession, path: str, fmt: str = "parquet", files: int = 16) -> DataFrame:
    """The log as a stream of its files, a bounded number in each batch."""
    return spark.readStream.schema(EVENT_SCHEMA).format(fmt).option("maxFilesPerTrigger", files).load(path)


def from_start(log: DataFrame, t: int, i: int, begins: tuple[int, int] | None = None) -> DataFrame:
    """Events from a logical time on; an error if the log begins after it (begins: since when it is complete)."""
    if begins is None:
        first = log.agg(F.min(F.struct("t", "i"))).first()[0]
        begins = (first.t, first.i) if first is not None else None
    if begins is not None and tuple(begins) > (t, i):
        raise HistoryLost(f"the log begins at {begins[0]}.{begins[1]}, after {t}.{i}")
    return log.filter((F.col("t") > t) | ((F.col("t") == t) & (F.col("i") >= i)))


def cluster_time(log: DataFrame) -> DataFrame:
    return log.agg(F.max(F.struct("t", "i")).alias("cluster_time"))


def heartbeats(log: DataFrame) -> DataFrame:
    """A tick at the log's end, for polls that bring no event."""
    return cluster_time(log).filter("cluster_time IS NOT NULL").select("cluster_time.t", "cluster_time.i", F.lit(TICK).alias("op"))


def ticking(spark: SparkSession) -> DataFrame:
    """A stream of ticks without a time, a row a second, that lets batches run while the log is idle."""
    empty = spark.createDataFrame([], EVENT_SCHEMA).schema
    rows = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    return rows.select(*[F.lit(TICK if f.name == "op" else None).cast(f.dataType).alias(f.name) for f in empty])


def watch(log: DataFrame, noise: tuple[str, ...] = ()) -> DataFrame:
    """The log for reading by people: time, operation, namespace and key, without databases that are noise."""
    at = F.concat_ws(".", F.col("t").cast("string"), F.col("i").cast("string")).alias("at")
    kept = log.filter(~F.coalesce(F.col("db").isin(*noise), F.lit(False)) & (F.col("op") != TICK))
    return kept.select(at, "op", F.concat_ws(".", "db", "coll").alias("ns"), F.col("document_key").alias("key"))


def key_of(doc_key: dict[str, Any], shard_key: tuple[str, ...] = ()) -> str:
    """Canonical text of a document key; shard-key fields that it lacks are null."""
    full = dict(doc_key) | {k: doc_key.get(k) for k in shard_key}
    return json.dumps(full, ensure_ascii=False, separators=(",", ":"))


class Stale(RuntimeError):
    """Another writer has written the version that this one was to write."""


class StateTable:
    """One value of state in a folder, as a file a version, of which the latest counts.

    A version is written once: a file is made under a name of its own and then renamed, which fails where the version is
    there already. The folder's file system has to rename in one step, as those of clusters do.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._Path, self._jvm = jvm.org.apache.hadoop.fs.Path, jvm
        self._folder = self._Path(path)
        self._fs = self._folder.getFileSystem(self._conf)

    def _versions(self) -> list[int]:
        return sorted(int(n.removesuffix(".json")) for n in self.names(self.path) if n.removesuffix(".json").isdigit())

    def _value(self, version: int) -> dict[str, Any]:
        stream = self._fs.open(self._Path(f"{self.path}/{version}.json"))
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def latest(self) -> tuple[int, dict[str, Any] | None]:
        """The latest version (-1: none) and its value."""
        versions = self._versions()
        return (versions[-1], self._value(versions[-1])) if versions else (-1, None)

    def all(self) -> list[tuple[int, dict[str, Any]]]:
        """The versions that are kept, and their values."""
        return [(v, self._value(v)) for v in self._versions()]

    def read(self) -> dict[str, Any] | None:
        return self.latest()[1]

    def write(self, state: dict[str, Any], after: int | None = None) -> int:
        """The version written: the one after the version that state was made from (None: the latest)."""
        versions = self._versions()
        after = (versions[-1] if versions else -1) if after is None else after
        if versions and versions[-1] > after:
            raise Stale(f"version {versions[-1]} has been written after {after}")
        temporary = self._Path(f"{self.path}/.{uuid.uuid4().hex}")
        out = self._fs.create(temporary, False)
        out.write(bytearray(json.dumps(state).encode()))
        out.close()
        files = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.makeQualified(self._folder).toUri(), self._conf)
        options = self.spark.sparkContext._gateway.new_array(getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            files.rename(self._fs.makeQualified(temporary), self._fs.makeQualified(self._Path(f"{self.path}/{after + 1}.json")), options)
        except Exception as e:
            self._fs.delete(temporary, False)
            raise Stale(f"version {after + 1} has been written by another") from e
        for v in versions[:-1]:
            self._fs.delete(self._Path(f"{self.path}/{v}.json"), False)
        return after + 1

    def reset(self) -> None:
        self._fs.delete(self._folder, True)

    def names(self, path: str) -> list[str]:
        """Names of what a folder holds; none if there is no such folder."""
        at = self._Path(path)
        return [s.getPath().getName() for s in self._fs.listStatus(at)] if self._fs.exists(at) else []

    def size(self, path: str) -> int:
        """Bytes of the files of a folder."""
        return self._fs.getContentSummary(self._Path(path)).getLength()

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._Path(path))

    def delete(self, path: str) -> None:
        self._fs.delete(self._Path(path), True)


class Lease:
    """One writer at a time: a beat in a state table, which another may take over when it is stale.

    Every taking begins an epoch, one more than the last; commits carry it, so that a writer that has lost the lease
    without noticing cannot commit.
    """

    BEAT, STALE = 30, 35

    def __init__(self, table: StateTable, owner: str, clock: Callable[[], float] = time.time):
        self.table, self.owner, self.clock, self.epoch = table, owner, clock, 0
        self.lost: Exception | None = None

    def _held(self, now: dict[str, Any] | None) -> bool:
        return bool(now) and now["owner"] not in (None, self.owner) and self.clock() - now["beat"] < self.STALE

    def acquire(self) -> None:
        version, now = self.table.latest()
        if self._held(now):
            raise RuntimeError(f"{now['owner']} holds the lease")
        self.epoch = (now["epoch"] if now else 0) + 1
        self.table.write({"owner": self.owner, "beat": self.clock(), "epoch": self.epoch}, after=version)
        self.lost = None

    def beat(self) -> None:
        version, now = self.table.latest()
        if now and now["owner"] != self.owner and (self._held(now) or now["epoch"] > self.epoch):
            raise RuntimeError(f"{now['owner']} has taken the lease")
        self.table.write({"owner": self.owner, "beat": self.clock(), "epoch": max(self.epoch, now["epoch"] if now else 0)}, after=version)

    @contextmanager
    def beating(self) -> Iterator[None]:
        """Beats beside what runs within, however long that takes; an error at the end if the lease was lost."""
        self.beat()
        done = threading.Event()

        def run() -> None:
            while not done.wait(self.BEAT):
                try:
                    self.beat()
                except Exception as e:  # kept for the one that works
                    self.lost = e
                    return

        thread = threading.Thread(target=run, daemon=True)
        thread.start()
        try:
            yield
        finally:
            done.set()
            thread.join()
        if self.lost:
            raise RuntimeError("the lease was lost") from self.lost

    def release(self) -> None:
        """Leaves the lease to the next, if it is still this one's."""
        version, now = self.table.latest()
        if now and now["owner"] == self.owner:
            self.table.write({"owner": None, "beat": 0.0, "epoch": now["epoch"]}, after=version)
