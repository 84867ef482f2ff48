"""Applying an ordered log of changes to a keyed table.

Insert creates or replaces, replace and update change only what exists, delete removes. So a key is
alive if its last insert or delete is an insert; its document is its last insert or replace; and the
updates after that one apply. All of it is aggregates that combine before the shuffle, so a key with
very many events is no hot spot.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written

#: Kinds of the test log's events.
OPERATIONS = {"signup": "insert", "purchase": "replace", "error": "delete"}


def operation(event_type: Column) -> Column:
    op = F.lit("update")
    for kind, name in OPERATIONS.items():
        op = F.when(event_type == kind, name).otherwise(op)
    return op


def log_of(events: DataFrame) -> DataFrame:
    """The events table as a change log: key, order (ts, event_id), op, value, field."""
    return events.select(F.col("user_id").alias("key"), F.struct("ts", "event_id").alias("order"), operation(F.col("event_type")).alias("op"), "value", F.col("event_type").alias("field"))


def with_snapshot(log: DataFrame, snapshot: DataFrame) -> DataFrame:
    """The log preceded by a snapshot's rows as inserts (a null order comes first)."""
    first = snapshot.select(*[F.lit(None).cast(log.schema["order"].dataType).alias("order") if c == "order" else F.lit("insert").alias("op") if c == "op" else F.col(c) for c in log.columns])
    return first.unionByName(log)


def state(log: DataFrame) -> DataFrame:
    """Live keys: key, base_order, base_value, n_deltas, last_value (of the last delta, else the base's)."""
    at = F.struct(F.col("order").isNotNull().alias("logged"), F.col("order").alias("order"))
    log = log.withColumn("_at", at)
    life = F.max(F.when(F.col("op").isin("insert", "delete"), F.struct("_at", "op")))
    base = F.max(F.when(F.col("op").isin("insert", "replace"), F.struct("_at", "value")))
    alive = log.groupBy("key").agg(life.alias("life"), base.alias("base")).filter("life.op = 'insert'").select("key", "base")
    deltas = log.filter("op = 'update'").join(alive, "key").filter("_at > base._at")
    deltas = deltas.groupBy("key").agg(F.count("*").alias("n_deltas"), F.max(F.struct("_at", "value")).alias("last"))
    out = alive.join(deltas, "key", "left")
    return out.select("key", F.col("base._at.order").alias("base_order"), F.col("base.value").alias("base_value"), F.coalesce("n_deltas", F.lit(0)).alias("n_deltas"), F.when(F.col("last").isNotNull(), F.col("last.value")).otherwise(F.col("base.value")).alias("last_value"))


def latest(log: DataFrame) -> DataFrame:
    """The last event of each key, if it is no delete (enough where events hold whole documents)."""
    rank = F.row_number().over(Window.partitionBy("key").orderBy(F.col("order").desc()))
    return log.withColumn("_rank", rank).filter("_rank = 1 AND op != 'delete'").drop("_rank")


def last_writes(log: DataFrame) -> DataFrame:
    """key, field, value, order of the last write of each field after the key's last base event."""
    base = log.filter(F.col("op").isin("insert", "replace", "delete")).groupBy("key").agg(F.max("order").alias("base"))
    writes = log.filter("op = 'update'").join(base, "key", "left").filter(F.col("base").isNull() | (F.col("order") > F.col("base")))
    return writes.groupBy("key", "field").agg(F.max(F.struct("order", "value")).alias("w")).select("key", "field", "w.order", "w.value")


def resolve_conflicts(rows: DataFrame, identity: str, order: str) -> DataFrame:
    """Of rows that compete for one identity the newest."""
    rank = F.row_number().over(Window.partitionBy(identity).orderBy(F.col(order).desc()))
    return rows.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def refetched(failed: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Keys whose delta failed: the source's row, and action upsert, or delete where it has none."""
    found = source.withColumn("_found", F.lit(True))
    return failed.join(found, key, "left").withColumn("action", F.when(F.col("_found"), "upsert").otherwise("delete")).drop("_found")


def insert_absent(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """target and, of source, one row of each key that target lacks."""
    return target.unionByName(source.dropDuplicates([key]).join(target.select(key), key, "left_anti").select(*target.columns))


def epochs(log: DataFrame, is_barrier: Column, order: Sequence[str], slices: int | None = None) -> DataFrame:
    """Adds epoch: the number of barriers up to and with each row in total order.

    Rows are dealt out by ranges of the order and counted by slice first, so that no task gets more than a slice,
    however the log is spread over time.
    """
    slices = slices or max(8, int(log.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = log.withColumn("_b", is_barrier.cast("bigint")).repartitionByRange(slices, *order).withColumn("_slice", F.spark_partition_id())
    dealt = written(dealt, "epochs")
    sums = dealt.groupBy("_slice").agg(F.sum("_b").alias("_n"))
    before = sums.select("_slice", (F.sum("_n").over(Window.orderBy("_slice")) - F.col("_n")).alias("_before"))  # a row a slice
    within = F.sum("_b").over(Window.partitionBy("_slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    return dealt.join(F.broadcast(before), "_slice").withColumn("epoch", F.col("_before") + within).drop("_b", "_before", "_slice")


def tail(rows: DataFrame, group: str, order: Sequence[str], n: int) -> DataFrame:
    """The last n rows of each capped collection in insertion order, with place (1 is the last)."""
    rank = F.row_number().over(Window.partitionBy(group).orderBy(*[F.col(c).desc() for c in order]))
    return rows.withColumn("place", rank).filter(F.col("place") <= n)


def transactions(rows: DataFrame, key: str, order: str, item: str) -> DataFrame:
    """Each transaction's statements in order."""
    items = F.transform(F.sort_array(F.collect_list(F.struct(order, item))), lambda x: x[item])
    return rows.groupBy(key).agg(F.count("*").alias("n"), F.array_join(items, ",").alias("items"))
