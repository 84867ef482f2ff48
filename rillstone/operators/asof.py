"""As-of joins: each row with the last change of its kind before it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written

#: Rows up to which the carried values are broadcast.
SMALL = 100_000


def as_of(rows: DataFrame, changes: DataFrame, by: list[str], at: str, value: str, slices: int | None = None, inclusive: bool = False) -> DataFrame:
    """rows with value: that of the last of changes (by, at, value) of equal by and lesser at (inclusive: or equal); null if there is none.

    Rows and changes are dealt out together by ranges of (by, at), so that a group of any size lies in
    slices; each slice is merged in order, and what was last in earlier slices is carried into it. Of changes of one place any
    one counts. Rows whose by holds a null have no change before them.
    """
    kind = changes.schema[value].dataType
    left = rows.select(*by, at, F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("_row"), F.lit(None).cast(kind).alias("_value"))
    right = changes.dropna(subset=by).select(*by, at, F.lit(None).cast(left.schema["_row"].dataType).alias("_row"), F.col(value).alias("_value"))
    order = [*by, at]
    slices = slices or max(8, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = written(left.unionByName(right).repartitionByRange(slices, *order).withColumn("_slice", F.spark_partition_id()), "as-of")
    is_change = F.col("_row").isNull()
    lasts = dealt.groupBy(*by, "_slice").agg(F.max(F.when(is_change, F.struct(at, F.struct("_value").alias("v")))).alias("last"))
    earlier = Window.partitionBy(*by).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)  # a row a slice of the group
    carried = lasts.select(*by, "_slice", F.last("last.v", ignorenulls=True).over(earlier).alias("_carried")).filter("_carried IS NOT NULL")
    before = Window.partitionBy(*by, "_slice").orderBy(F.col(at), ~is_change if inclusive else is_change).rowsBetween(Window.unboundedPreceding, -1)
    within = F.last(F.when(is_change, F.struct("_value")), ignorenulls=True).over(before)
    merged = dealt.withColumn("_within", within).filter(~is_change)
    few = carried.limit(SMALL + 1).count() <= SMALL
    both = merged.join(F.broadcast(carried) if few else carried, [*by, "_slice"], "left")
    return both.select("_row.*", F.coalesce("_within", "_carried")["_value"].alias(value))


def in_force(valid_from: Column, at: Column, before: Column, after: Column) -> Column:
    """after from valid_from on, before until then; before always where valid_from is null."""
    return F.when(valid_from.isNotNull() & (at >= valid_from), after).otherwise(before)
