"""Snapshot planning: statistics, key ranges, segments, order of work, batches."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import written
from .asof import as_of

#: Bytes of the least and the largest segment; bytes and documents of a batch.
LEAST_SEGMENT, LARGEST_SEGMENT = 479_994_880, 64 << 30
BATCH_BYTES, BATCH_DOCS = 47_999_488, 10_000


def collection_stats(docs: DataFrame, by: tuple[str, ...], size: Column) -> DataFrame:
    """count, size and average (whole) size of each group."""
    out = docs.groupBy(*by).agg(F.count("*").alias("n_docs"), F.sum(size).cast("bigint").alias("size_bytes"))
    return out.withColumn("avg_size", F.expr("size_bytes div n_docs"))


def with_fallback(stats: DataFrame, recomputed: DataFrame, *names: str) -> DataFrame:
    """stats with count, size and average from recomputed where the stored average is 0 or missing."""
    fresh = recomputed.select(*names, *[F.col(c).alias(f"_{c}") for c in ("n_docs", "size_bytes", "avg_size")])
    bad = F.coalesce(F.col("avg_size"), F.lit(0)) == 0
    both = stats.join(fresh, list(names), "left")
    return both.select(*names, *[F.when(bad & F.col(f"_{c}").isNotNull(), F.col(f"_{c}")).otherwise(F.col(c)).alias(c) for c in ("n_docs", "size_bytes", "avg_size")])


def total_progress(planned: DataFrame, done: DataFrame, *names: str) -> DataFrame:
    """One row: total bytes, estimates replaced by what was copied, dropped collections left out.

    planned has the names and estimate; done has the names, copied (bytes, null until done) and dropped.
    """
    both = planned.join(done, list(names), "left").filter(~F.coalesce("dropped", F.lit(False)))
    return both.agg(F.sum(F.coalesce("copied", "estimate")).alias("total_bytes"), F.sum(F.coalesce("copied", F.lit(0))).alias("copied_bytes"))


def key_range(rows: DataFrame, key: str) -> DataFrame:
    """min_key and max_key; NaN keys have no place in ranges."""
    kept = rows.filter(~F.isnan(key)) if dict(rows.dtypes)[key] in ("double", "float") else rows
    return kept.agg(F.min(key).alias("min_key"), F.max(key).alias("max_key"))


def segment_docs(size: int, avg: int, readers: int, explicit: int = 0) -> int:
    """Documents of a segment: the size split among readers, not below the least, or the explicit size."""
    size = explicit or max(size // max(readers, 1), LEAST_SEGMENT)
    return max(min(size, LARGEST_SEGMENT) // max(avg, 1), 1)


def segments(rows: DataFrame, key: str, docs: int, kind: str | None = None, slices: int | None = None, label: str | None = None) -> DataFrame:
    """kind, segment, n, lo, hi: ranges of docs consecutive keys, disjoint and without gaps, for keys of any type.

    With label, a column, also lo_label and hi_label: what rows at either end have there.

    Keys are dealt out by range, counted by slice and ranked within their slices; no task sorts them
    all. With a column kind (the type of keys of several types) every kind has ranges of its own. NaN is
    an ordinary key, the greatest; null is the least.
    """
    by = [kind] if kind else []
    slices = slices or max(8, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    more = [F.col(label).alias("_label")] if label else []
    dealt = rows.select(*by, F.col(key).alias("_key"), *more).repartitionByRange(slices, *by, "_key")
    sliced = written(dealt.withColumn("_slice", F.spark_partition_id()), "slices")
    counts = sliced.groupBy(*by, "_slice").agg(F.count("*").alias("_n"))
    order = Window.partitionBy(*by).orderBy("_slice")
    before = counts.select(*by, "_slice", (F.sum("_n").over(order) - F.col("_n")).alias("_before"))  # a row a slice and kind
    rank = F.col("_before") + F.row_number().over(Window.partitionBy(*by, "_slice").orderBy("_key")) - 1
    ranked = sliced.join(before, [*by, "_slice"]).withColumn("segment", F.floor(rank / docs).cast("bigint"))
    ends = [F.min_by("_label", "_key").alias("lo_label"), F.max_by("_label", "_key").alias("hi_label")] if label else []
    return ranked.groupBy(*by, "segment").agg(F.count("*").alias("n"), F.min("_key").alias("lo"), F.max("_key").alias("hi"), *ends)


def scan(rows: DataFrame, key: str, lo: object = None, hi: object = None) -> DataFrame:
    """The rows of one range, both ends included, in the order of their keys; the range reaches the files."""
    kept = rows if lo is None else rows.filter(F.col(key) >= F.lit(lo))
    kept = kept if hi is None else kept.filter(F.col(key) <= F.lit(hi))
    return kept.orderBy(key)


def segment_of(rows: DataFrame, found: DataFrame, key: str, kind: str | None = None) -> DataFrame:
    """rows with the segment of their keys, rows outside all segments left out.

    The segments' least keys are the splitters: a row belongs to the last one at or below its key, if that
    segment reaches so far. It is an as-of join, whatever the number of segments.
    """
    by = [kind] if kind else []
    ends = found.select(*by, F.col("lo").alias(key), F.struct("segment", "hi").alias("_end"))
    placed = as_of(rows, ends, by, key, "_end", inclusive=True)
    return placed.filter(F.col(key) <= F.col("_end.hi")).withColumn("segment", F.col("_end.segment")).drop("_end")


def database_stats(docs: DataFrame, db: str, coll: str, size: Column) -> DataFrame:
    """Of each database: its collections, documents, bytes and average size (whole)."""
    per = collection_stats(docs, (db, coll), size)
    out = per.groupBy(db).agg(F.count("*").alias("n_collections"), F.sum("n_docs").alias("n_docs"), F.sum("size_bytes").alias("size_bytes"))
    return out.withColumn("avg_size", F.expr("size_bytes div n_docs"))


def type_ranges(rows: DataFrame, kind: str, key: str) -> DataFrame:
    """min and max key of each kind of key."""
    return rows.groupBy(kind).agg(F.count("*").alias("n"), F.min(key).alias("min_key"), F.max(key).alias("max_key"))


def largest_first(stats: DataFrame, size: str, *names: str) -> DataFrame:
    """Adds place: collections in the order in which they are copied (a row a collection)."""
    return stats.withColumn("place", F.row_number().over(Window.orderBy(F.col(size).desc(), *names)).cast("bigint"))


def batches_by_sum(rows: DataFrame, order: str, size: Column, cap: int, group: str | None = None) -> DataFrame:
    """Adds batch: the running sum before each row over the cap."""
    window = Window.partitionBy(*([group] if group else [])).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("batch", F.floor(F.coalesce(F.sum(size).over(window), F.lit(0)) / cap).cast("bigint"))


def greedy_batches(rows: DataFrame, group: str, order: str, size: str, cap: int, most: int = BATCH_DOCS) -> DataFrame:
    """Adds batch within each group: a row opens a new one if it would exceed the cap or the number of rows.

    An empty batch takes any row. Rows stream through a task in order, whatever their number.
    """
    schema = T.StructType([*rows.schema.fields, T.StructField("batch", T.LongType())])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, total, count, batch = object(), 0, 0, 0
        for frame in frames:
            out = []
            for g, s in zip(frame[group], frame[size], strict=True):
                if g != now:
                    now, total, count, batch = g, 0, 0, 0
                elif count and (total + s > cap or count >= most):
                    total, count, batch = 0, 0, batch + 1
                total, count = total + s, count + 1
                out.append(batch)
            yield frame.assign(batch=out)

    return rows.repartition(group).sortWithinPartitions(group, order).mapInPandas(run, schema)


def chunks_by_count(rows: DataFrame, group: str, order: str, n: int) -> DataFrame:
    """Adds chunk: each n rows of a group."""
    return rows.withColumn("chunk", F.floor((F.row_number().over(Window.partitionBy(group).orderBy(order)) - 1) / n).cast("bigint"))
