"""Progress of replication: checkpoints, idleness, lag, initial sync, rates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import predecessor


def floor_of(routed: Column, committed: Column) -> Column:
    """Up to where a worker is safe: what it committed, else before what it was first sent."""
    return F.when(committed.isNotNull(), committed).otherwise(predecessor(routed))


def checkpoint(workers: DataFrame) -> DataFrame:
    """The least floor of workers (worker, routed, committed) that were sent anything."""
    return workers.filter("routed IS NOT NULL").agg(F.min(floor_of(F.col("routed"), F.col("committed"))).alias("checkpoint"))


def idle(workers: DataFrame) -> DataFrame:
    """Whether every worker has committed all that it was sent."""
    done = F.coalesce(F.col("committed") >= F.col("routed"), F.lit(False))
    return workers.filter("routed IS NOT NULL").agg(F.coalesce(F.bool_and(done), F.lit(True)).alias("idle"))


def lag(source: Column, applied: Column, increment: Column | None = None) -> Column:
    """Seconds behind, not below 0; one second is forgiven where it is the source's own note."""
    behind = F.greatest(source - applied, F.lit(0))
    return behind if increment is None else F.when((behind == 1) & (increment == 1), 0).otherwise(behind)


def initial_sync_done(applied: Column, finished: Column) -> Column:
    return applied > finished


def commits(rows: DataFrame, worker: str, order: str, ops: int) -> DataFrame:
    """worker, n, committed: events of each worker and the last one of its sealed bulks of ops events (null: none is sealed)."""
    place = F.row_number().over(Window.partitionBy(worker).orderBy(order))
    numbered = rows.select(worker, order, place.alias("_n"))
    return numbered.groupBy(worker).agg(F.max("_n").cast("bigint").alias("n"), F.max(F.when(F.col("_n") % ops == 0, F.col(order))).alias("committed"))


def throughput(rows: DataFrame, at: Column, seconds: int) -> DataFrame:
    """Rows and rows a second of each interval of so many seconds of the clock at (whole seconds)."""
    start = (F.floor(at / seconds) * seconds).cast("bigint")
    return rows.groupBy(start.alias("start")).agg(F.count("*").alias("n")).withColumn("per_second", F.col("n") / F.lit(seconds))


def rates(rows: DataFrame, window: str, count: str) -> DataFrame:
    """Adds delta: the change of a counter since the window before (a row a window)."""
    return rows.withColumn("delta", F.col(count) - F.lag(count).over(Window.orderBy(window)))
