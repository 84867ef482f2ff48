"""Session construction and table loading."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def local_session(cpus: int | None = None, memory: str = "8g", **conf: str) -> SparkSession:
    """A session for tests and benchmarks on one machine; clusters bring their own."""
    n = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    builder = (
        SparkSession.builder.master(f"local[{n}]")
        .appName("rillstone")
        .config("spark.sql.shuffle.partitions", str(n))
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the Parquet tables under sf_dir; any path that Spark can read will do."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or on one machine a new one.

    A cluster has to name it: a path that only the driver sees would lose tables.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if not found:
        found = context._jsc.sc().getCheckpointDir()
        found = found.get() if found.isDefined() else None
    if not found:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        found = tempfile.mkdtemp(prefix="rillstone-")
        context.setCheckpointDir(found)
    return found


_scratch = threading.local()


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Deletes at its end the tables that are written within it, in this thread: a stream would gather them for ever."""
    paths: list[str] = []
    outer = getattr(_scratch, "paths", None)
    _scratch.paths = paths
    try:
        yield
    finally:
        _scratch.paths = outer
        context = spark.sparkContext
        for path in paths:
            at = context._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(context._jsc.hadoopConfiguration()).delete(at, True)


def written(df: DataFrame, name: str) -> DataFrame:
    """df, written as a table in the shared folder and read again: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/rillstone/{name}-{uuid.uuid4().hex}"
    if getattr(_scratch, "paths", None) is not None:
        _scratch.paths.append(path)
    df.write.parquet(path)
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(at)
    return spark.read.schema(df.schema).parquet(path)


def ship(spark: SparkSession | None = None) -> None:
    """Sends this package to the session's Python workers, once."""
    context = (spark or SparkSession.active()).sparkContext
    if getattr(context, "_rillstone_sent", False):
        return
    package = Path(__file__).resolve().parent
    path = Path(tempfile.mkdtemp(prefix="rillstone-")) / "rillstone.zip"
    with zipfile.ZipFile(path, "w") as out:
        for p in sorted(package.rglob("*.py")):
            out.write(p, p.relative_to(package.parent))
    context.addPyFile(str(path))
    context._rillstone_sent = True
