"""Queries of listings, statistics, versions and sizes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import catalog, delta, namespaces, segments, verify
from ..session import table
from .registry import registered


@registered("SELECT source, count(*) AS n_collections, sum(n)::BIGINT AS n_docs, sum(s)::BIGINT AS size_bytes, (sum(s) // sum(n))::BIGINT AS avg_size FROM (SELECT source, lang, count(*) AS n, sum(n_chars) AS s FROM documents GROUP BY source, lang) GROUP BY source")
def database_stats(spark: SparkSession, sf: str) -> DataFrame:
    return segments.database_stats(table(spark, sf, "documents"), "source", "lang", F.col("n_chars"))


@registered("SELECT n_name, n_nationkey::BIGINT AS n_nationkey, n_regionkey::BIGINT AS n_regionkey FROM nation WHERE n_nationkey = 7 LIMIT 1")
def spec_lookup(spark: SparkSession, sf: str) -> DataFrame:
    found = catalog.looked_up(table(spark, sf, "nation"), n_nationkey=7)
    return spark.createDataFrame([(found.n_name, found.n_nationkey, found.n_regionkey)], "n_name string, n_nationkey long, n_regionkey long")


@registered("SELECT p_partkey::VARCHAR AS uuid, 'db.' || p_name AS ns, CASE WHEN p_size % 5 = 0 THEN NULL WHEN p_size % 3 = 0 THEN 'db.moved' || p_partkey ELSE 'db.' || p_name END AS now, CASE WHEN p_size % 5 = 0 THEN 'dropped' WHEN p_size % 3 = 0 THEN 'renamed' ELSE 'same' END AS status FROM part")
def moved_collections(spark: SparkSession, sf: str) -> DataFrame:
    """Collections that were renamed or dropped while they were copied, by uuid."""
    part = table(spark, sf, "part").withColumn("uuid", F.col("p_partkey").cast("string"))
    planned = part.select("uuid", F.concat(F.lit("db."), "p_name").alias("ns"))
    now = F.when(F.col("p_size") % 3 == 0, F.concat(F.lit("db.moved"), "uuid")).otherwise(F.concat(F.lit("db."), "p_name"))
    return catalog.moved(planned, part.filter("p_size % 5 != 0").select("uuid", now.alias("ns")))


@registered("SELECT p_partkey::VARCHAR AS name, p_brand AS keys FROM part WHERE p_size % 2 = 0")
def index_builds(spark: SparkSession, sf: str) -> DataFrame:
    """Operations that build indexes, one row an index."""
    item = F.struct(F.col("p_partkey").cast("string").alias("name"), F.col("p_brand").alias("keys"))
    op = F.when(F.col("p_size") % 2 == 0, "createIndexes").otherwise("find")
    return catalog.builds_of(table(spark, sf, "part").groupBy(op.alias("op"), "p_size").agg(F.collect_list(item).alias("indexes")))


@registered("SELECT page_id, regexp_extract(url, '://([^./]*)', 1) LIKE 'm%' AS series FROM pages")
def timeseries_prefix(spark: SparkSession, sf: str) -> DataFrame:
    name = F.regexp_extract("url", "://([^./]*)", 1)
    on = F.when(F.startswith(name, F.lit("m")), F.concat(F.lit("system.buckets."), name)).otherwise(name)
    return table(spark, sf, "pages").select("page_id", namespaces.is_timeseries(on).alias("series"))


@registered("""WITH s AS (SELECT source, lang, count(*) AS n FROM documents GROUP BY source, lang), t AS (SELECT source, lang, n + CASE WHEN lang = 'de' THEN 1 ELSE 0 END AS n FROM s WHERE lang <> 'fr'),
x AS (SELECT c_custkey, c_name, c_acctbal FROM customer), y AS (SELECT c_custkey, c_name, CASE WHEN c_custkey % 10 = 0 THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal FROM customer WHERE c_custkey % 7 <> 0 UNION ALL SELECT -c_custkey, c_name, c_acctbal FROM customer WHERE c_custkey % 100 = 0)
SELECT 'collections' AS what, source || '.' || lang AS name, CASE WHEN t.n IS NULL THEN 'missing' ELSE 'changed' END AS kind FROM s LEFT JOIN t USING (source, lang) WHERE t.n IS DISTINCT FROM s.n
UNION ALL SELECT 'documents', coalesce(x.c_custkey, y.c_custkey)::VARCHAR, CASE WHEN y.c_custkey IS NULL THEN 'missing' WHEN x.c_custkey IS NULL THEN 'extra' ELSE 'changed' END
FROM x FULL JOIN y ON x.c_custkey = y.c_custkey WHERE x.c_custkey IS NULL OR y.c_custkey IS NULL OR x.c_acctbal IS DISTINCT FROM y.c_acctbal""")
def full_comparison(spark: SparkSession, sf: str) -> DataFrame:
    """Two sides compared as wholes: their collections with counts, and their documents."""
    listed = table(spark, sf, "documents").groupBy("source", "lang").agg(F.count("*").alias("n"))
    other = listed.filter("lang != 'fr'").withColumn("n", F.col("n") + F.when(F.col("lang") == "de", 1).otherwise(0))
    rows = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    mine = rows.filter("c_custkey % 7 != 0").withColumn("c_acctbal", F.when(F.col("c_custkey") % 10 == 0, F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal")))
    mine = mine.unionByName(rows.filter("c_custkey % 100 = 0").withColumn("c_custkey", -F.col("c_custkey")))
    return verify.compared({"collections": (listed, ["source", "lang"]), "documents": (rows, ["c_custkey"])}, {"collections": other, "documents": mine})


_VERSION = "(o_orderkey % 9) || '.' || (o_orderkey % 4) || '.' || (o_orderkey % 11) || CASE WHEN o_orderkey % 2 = 0 THEN '-' || (o_orderkey % 30) ELSE '' END"


@registered("SELECT o_orderkey, (o_orderkey % 9)::INT AS major, (o_orderkey % 4)::INT AS minor, (o_orderkey % 11)::INT AS patch, CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey % 30 ELSE 0 END::INT AS build, o_orderkey % 9 >= 6 AS accepts FROM orders")
def version_parts(spark: SparkSession, sf: str) -> DataFrame:
    """Parts of versions, and whether a source of version 6 may be replicated to them."""
    rows = table(spark, sf, "orders").select("o_orderkey", F.expr(_VERSION).alias("v"))
    v = S.version_parts(F.col("v"))
    return rows.select("o_orderkey", v["major"].alias("major"), v["minor"].alias("minor"), v["patch"].alias("patch"), v["build"].alias("build"), (v["major"] >= S.parse_version("6.0.1")[0]).alias("accepts"))


@registered("SELECT p_partkey, (p_size::BIGINT * CASE p_partkey % 4 WHEN 0 THEN 1 WHEN 1 THEN 1000 WHEN 2 THEN 1048576 ELSE 1000000000 END)::BIGINT AS bytes FROM part")
def byte_sizes(spark: SparkSession, sf: str) -> DataFrame:
    unit = F.get(F.array(*map(F.lit, ("", "KB", " MiB", "g"))), (F.col("p_partkey") % 4).cast("int"))
    return table(spark, sf, "part").select("p_partkey", S.byte_size(F.concat(F.col("p_size").cast("string"), unit)).alias("bytes"))


@registered("SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN NULL ELSE 'd' || p_size END AS db, CASE WHEN p_size % 3 = 0 THEN NULL ELSE p_name || '.x' END AS coll FROM part")
def namespace_parts(spark: SparkSession, sf: str) -> DataFrame:
    ns = F.when(F.col("p_size") % 3 == 0, "nodot").otherwise(S.namespace(F.concat(F.lit("d"), F.col("p_size").cast("string")), F.concat("p_name", F.lit(".x"))))
    rows = table(spark, sf, "part").select("p_partkey", S.split_namespace(ns).alias("ns"))
    return rows.select("p_partkey", "ns.db", "ns.coll")


@registered("SELECT doc_id, lower(hex(encode(source))) AS hexed FROM documents")
def hex_names(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", S.hexed(F.col("source")).alias("hexed"))


@registered("""SELECT o_orderkey, '{"_id":' || o_orderkey || ',"region":' || CASE WHEN o_orderkey % 3 = 0 THEN 'null' ELSE (o_custkey % 5)::VARCHAR END || '}' AS key FROM orders""")
def shard_key_nulls(spark: SparkSession, sf: str) -> DataFrame:
    """Document keys in which a missing field of the shard key is null."""
    region = F.when(F.col("o_orderkey") % 3 != 0, F.col("o_custkey") % 5)
    return table(spark, sf, "orders").select("o_orderkey", S.key_json(F.col("o_orderkey").alias("_id"), region.alias("region")).alias("key"))


@registered("SELECT doc_id, (octet_length(encode(doc_id::VARCHAR)) + octet_length(encode(coalesce(text, ''))))::BIGINT AS bytes FROM documents")
def operation_sizes(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", delta.estimated_bytes(F.col("doc_id").cast("string"), F.col("text")).cast("bigint").alias("bytes"))
