"""Comparing a source with a target."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import written

#: Leaves up to which they are broadcast.
FEW_LEAVES = 100_000


def content_hash(rows: DataFrame, by: tuple[str, ...], key: str, doc: Column) -> DataFrame:
    """n and md5 of each group's documents in the order of their keys (groups that fit a task)."""
    items = F.transform(F.sort_array(F.collect_list(F.struct(F.col(key).alias("k"), doc.alias("d")))), lambda x: x["d"])
    return rows.groupBy(*by).agg(F.count("*").alias("n"), F.md5(F.array_join(items, "\n")).alias("hash"))


def range_hash(rows: DataFrame, by: tuple[str, ...], key: str, doc: Column, keys_in_range: int) -> DataFrame:
    """The same for groups of any size: a hash of the hashes of ranges of whole keys."""
    ranged = rows.withColumn("_range", F.floor(F.col(key) / keys_in_range))
    parts = content_hash(ranged, (*by, "_range"), key, doc)
    items = F.transform(F.sort_array(F.collect_list(F.struct("_range", "hash"))), lambda x: x["hash"])
    return parts.groupBy(*by).agg(F.sum("n").alias("n"), F.md5(F.array_join(items, "\n")).alias("hash"))


def differences(source: DataFrame, target: DataFrame, key: str | list[str], value: str) -> DataFrame:
    """key and kind: missing (from the target), extra (in it), changed."""
    key = [key] if isinstance(key, str) else key
    s = source.select(*key, F.col(value).alias("_s"), F.lit(True).alias("_in_s"))
    t = target.select(*key, F.col(value).alias("_t"), F.lit(True).alias("_in_t"))
    kind = F.when(F.col("_in_t").isNull(), "missing").when(F.col("_in_s").isNull(), "extra").when(~F.col("_s").eqNullSafe(F.col("_t")), "changed")
    return s.join(t, key, "full_outer").select(*key, kind.alias("kind")).filter("kind IS NOT NULL")


def leaf_sums(rows: DataFrame, key: list[str], value: str, bits: int) -> DataFrame:
    """leaf, n, a, b: sums of two hashes of the rows of each of 2^bits ranges of hashed keys; the order of rows does not count."""
    leaf = F.shiftrightunsigned(F.xxhash64(*key), 64 - bits).alias("leaf")
    sums = [F.sum(F.xxhash64(F.lit(seed), *key, value).cast("decimal(20,0)")).cast("decimal(38,0)").alias(name) for name, seed in (("a", 1), ("b", 2))]
    return rows.select(*key, value, leaf).groupBy("leaf").agg(F.count("*").alias("n"), *sums)


def differing_leaves(source: DataFrame, target: DataFrame, bits: int, fan: int = 8) -> DataFrame | None:
    """The leaves in which two tables of leaf_sums differ; None if there is none.

    Sums of neighbouring leaves are the nodes of a tree. From the root down only nodes whose parents differ
    are compared: equal sides exchange one row, and few differences a path of rows each.
    """
    nodes, above = None, 0
    for level in (*range(0, bits, fan), bits):
        node = F.shiftrightunsigned("leaf", bits - level).alias("node")
        sides = [leaves.groupBy(node).agg(*[F.sum(c).alias(c) for c in ("n", "a", "b")]) for leaves in (source, target)]
        if nodes is not None:
            sides = [side.withColumn("parent", F.shiftright("node", level - above)).join(nodes.withColumnRenamed("node", "parent"), "parent", "left_semi").drop("parent") for side in sides]
        s, t = (side.select("node", F.struct("n", "a", "b").alias(name)) for side, name in zip(sides, "st", strict=True))
        nodes = written(s.join(t, "node", "full_outer").filter(~F.col("s").eqNullSafe(F.col("t"))).select("node"), "nodes")
        if nodes.isEmpty():
            return None
        above = level
    return nodes.withColumnRenamed("node", "leaf")


def tree_differences(source: DataFrame, target: DataFrame, key: str | list[str], value: str, bits: int = 16, fan: int = 8) -> DataFrame:
    """As differences, but only rows of ranges whose sums differ are joined, and no range's rows are gathered."""
    key = [key] if isinstance(key, str) else key
    leaves = differing_leaves(*[written(leaf_sums(side, key, value, bits), "leaves") for side in (source, target)], bits, fan)
    if leaves is None:
        return differences(source.limit(0), target.limit(0), key, value)
    few = leaves.limit(FEW_LEAVES + 1).count() <= FEW_LEAVES
    leaf = F.shiftrightunsigned(F.xxhash64(*key), 64 - bits)
    sides = [side.select(*key, value, leaf.alias("leaf")).join(F.broadcast(leaves) if few else leaves, "leaf", "left_semi").drop("leaf") for side in (source, target)]
    return differences(*sides, key, value)


def outside(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """n_outside: the target's rows whose key the source lacks; none if it is a subset."""
    return target.join(source.select(key), key, "left_anti").agg(F.count("*").alias("n_outside"))


def compared(source: dict[str, tuple[DataFrame, list[str]]], target: dict[str, DataFrame]) -> DataFrame:
    """what, name, kind of all differences of two sides: listings and documents by what they are, each with its keys.

    Columns that are no key are compared as one value; names are the keys' texts.
    """
    out = None
    for what, (rows, keys) in source.items():
        rest = [c for c in rows.columns if c not in keys]
        value = lambda df: df.select(*keys, F.struct(*rest).alias("_value"))  # noqa: B023, E731
        found = differences(value(rows), value(target[what]), keys, "_value")
        part = found.select(F.lit(what).alias("what"), F.concat_ws(".", *[F.col(k).cast("string") for k in keys]).alias("name"), "kind")
        out = part if out is None else out.unionByName(part)
    return out
