"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Each document draws the key -ln(u) / weight, u from a hash of its id, weight from its quality. Within
a source the documents stand in the order of their keys and are taken while the prefix sum of their
sizes stays within the source's budget. Budgets above the source's size first take complete epochs
and select only the rest.

No source is sorted as a whole: keys fall in 256 slices of 256 slices each, sums by slice show in
which of them a source's budget ends, and only that one is sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import attach, words, written

#: Weights of the sources in order of their names, repeating; the budget as a share of all sizes; most uses of a source.
WEIGHTS, SHARE, MOST = (5, 2, 1), 1.5, 2
SEED = "mix-1"
SYMBOLS = r"[#*$%&|<>]"
SLICES = 256


def quality_weight(text: Column) -> Column:
    """Within 0.1 and 1: less for texts with many symbols; 1 for empty ones and null."""
    text = F.coalesce(text, F.lit(""))
    symbols = F.length(text) - F.length(F.regexp_replace(text, SYMBOLS, ""))
    return F.greatest(F.lit(0.1), 1 - 4.0 * symbols / F.greatest(F.length(text), F.lit(1)))


def uniform(name: Column, seed: str = SEED) -> Column:
    """Within (0, 1), from 48 bits of a hash of a name."""
    digits = F.substring(F.md5(F.concat_ws("|", F.lit(seed), name)), 1, 12)
    return (F.conv(digits, 16, 10).cast("bigint") + 0.5) / float(1 << 48)


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """source, source_size, target from source, source_size (one row a source).

    The budget is split by weight; what exceeds a source's cap is split anew among the others. In
    the order of cap / weight the capped sources come first: with the first k capped, the level is
    the rest of the budget over the rest of the weights, and the smallest k fits whose next source
    stays within its cap. Further capping only lowers the level, so it is the greatest that fits.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sizes.withColumn("w", F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int")))
    ranked = ranked.withColumn("cap", most * F.col("source_size").cast("double")).withColumn("ratio", F.col("cap") / F.col("w"))
    by_ratio = Window.orderBy("ratio", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranked = ranked.withColumn("level", (share * F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(by_ratio), F.lit(0.0))) / (F.sum("w").over(everything) - F.coalesce(F.sum("w").over(by_ratio), F.lit(0.0))))
    ranked = ranked.withColumn("level", F.max(F.when(F.col("level") <= F.col("ratio"), F.col("level"))).over(everything))
    return ranked.select("source", "source_size", F.when(F.col("ratio") <= F.coalesce("level", F.col("ratio")), F.col("cap")).otherwise(F.col("level") * F.col("w")).alias("target"))


def mix(items: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """doc_id, size, source_size, target, taken of every row of items (doc_id, source, size, weight).

    taken: the document's size times its uses. A null source is one of its own, last in order; rows
    of a null id draw by their name, if items has one; repeated rows are rows of their own; an empty
    table gives an empty result.
    The document at which a budget ends is taken if that brings the sum nearer to it.
    """
    name = F.coalesce(F.col("doc_id").cast("string"), F.col("name") if "name" in items.columns else F.lit(""))
    key = -F.log(uniform(name)) / F.col("weight")
    at = (1 - F.exp(-F.col("key"))) * (SLICES * SLICES - 1)
    drawn = items.select("doc_id", F.coalesce(F.concat(F.lit("+"), F.col("source")), F.lit("-")).alias("s"), "size", key.alias("key"))
    drawn = written(drawn.withColumn("slice", F.floor(at).cast("int")).withColumn("slice1", F.floor(F.col("slice") / SLICES).cast("int")), "draws")
    first = written(drawn.groupBy("s", "slice1").agg(F.sum("size").alias("part")), "slices")
    source = F.when(F.startswith("s", F.lit("+")), F.expr("substr(s, 2)")).alias("source")
    sizes = first.groupBy("s").agg(F.sum("part").alias("source_size")).select(source, "source_size")
    goal = targets(sizes, weights, share, most)
    goal = goal.withColumn("s", F.coalesce(F.concat(F.lit("+"), F.col("source")), F.lit("-")))
    goal = goal.withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("bigint"))
    goal = written(goal.withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size")).drop("source"), "targets")

    def ends(parts: DataFrame, slice_: str, to: str, before: Column) -> DataFrame:
        """Adds slice `to`, where the prefix sum passes the rest, and the sum before it."""
        order = Window.partitionBy("s").orderBy(slice_)
        cum = parts.withColumn("cum", before + F.sum("part").over(order))
        return cum.filter("cum > rest").groupBy("s").agg(F.min(slice_).alias(to), F.min(F.struct(slice_, (F.col("cum") - F.col("part")).alias("sum")))["sum"].alias(f"{to}_before"))

    end1 = ends(attach(first, goal, ["s"], "inner"), "slice1", "end1", F.lit(0))
    goal = written(goal.join(end1, "s", "left"), "ends")
    drawn = attach(drawn, goal, ["s"], "inner")
    in_end = drawn.filter("slice1 = end1").groupBy("s", "slice").agg(F.sum("size").alias("part"), F.first("rest").alias("rest"), F.first("end1_before").alias("b"))
    end2 = written(ends(in_end, "slice", "end2", F.col("b")), "ends2")
    last = attach(drawn.filter("slice1 = end1"), end2, ["s"], "inner").filter("slice = end2")
    order = Window.partitionBy("s").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    last = last.withColumn("cum", F.col("end2_before") + F.sum("size").over(order))
    inside = (F.col("cum") <= F.col("rest")) | ((F.col("cum") - F.col("size") < F.col("rest")) & (F.col("cum") - F.col("rest") < F.col("rest") - F.col("cum") + F.col("size")))
    out = ("doc_id", "size", "source_size", "target")
    last = last.select(*out, (F.col("size") * (F.col("epochs") + inside.cast("bigint"))).alias("taken"))
    rest = attach(drawn, end2.select("s", "end2"), ["s"]).filter("end2 IS NULL OR slice != end2")
    rest = rest.select(*out, (F.col("size") * (F.col("epochs") + F.coalesce(F.col("slice") < F.col("end2"), F.col("rest") > 0).cast("bigint"))).alias("taken"))
    return rest.unionByName(last)


def measured(documents: DataFrame) -> DataFrame:
    """doc_id, source, size, weight, name: what mix() needs of documents (doc_id, text, source)."""
    name = F.when(F.col("doc_id").isNull(), F.concat(F.lit("text "), F.md5(F.coalesce(F.col("text"), F.lit("")))))
    return documents.select("doc_id", "source", F.size(words(F.col("text"))).cast("bigint").alias("size"), quality_weight(F.col("text")).alias("weight"), name.alias("name"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(measured(spark.read.parquet(f"{sf_dir}/documents.parquet")))


#: The order of keys is that of the query; slices are only its way to find where a budget ends.
ORACLE = rf"""
WITH d AS (
  SELECT doc_id, source, len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> ''))::BIGINT AS size,
    -ln((('0x' || substr(md5('{SEED}|' || coalesce(doc_id::VARCHAR, 'text ' || md5(coalesce(text, '')))), 1, 12))::BIGINT + 0.5::DOUBLE) / {float(1 << 48)}::DOUBLE)
      / greatest(0.1::DOUBLE, 1 - 4.0::DOUBLE * (length(coalesce(text, '')) - length(regexp_replace(coalesce(text, ''), '{SYMBOLS}', '', 'g'))) / greatest(length(coalesce(text, '')), 1)) AS key
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w, 2 * source_size::DOUBLE AS cap FROM s),
l AS (SELECT *, cap / w AS ratio, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER o, 0)) / (sum(w) OVER () - coalesce(sum(w) OVER o, 0)) AS level
      FROM w WINDOW o AS (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
m AS (SELECT *, max(CASE WHEN level <= ratio THEN level END) OVER () AS lv FROM l),
t AS (SELECT source, source_size, CASE WHEN ratio <= coalesce(lv, ratio) THEN cap ELSE lv * w END AS target FROM m),
e AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS epochs FROM t),
r AS (SELECT *, target - epochs * source_size AS rest FROM e),
c AS (SELECT doc_id, size, source_size, target, epochs, rest, sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id, size ROWS UNBOUNDED PRECEDING) AS cum
      FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source)
SELECT doc_id, size, source_size, target, (size * (epochs + CASE WHEN cum <= rest OR (cum - size < rest AND cum - rest < rest - cum + size) THEN 1 ELSE 0 END))::BIGINT AS taken FROM c
"""
