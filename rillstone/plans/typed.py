"""Queries over documents of values of any type: order, brackets, arrays, index keys, sizes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ordering import bracket, encoded
from ..operators import documents, segments, verify, views
from ..operators.catalog import Catalog, Index
from ..session import table
from .registry import registered

#: Keys of many types as JSON text, with the rank of the type and, for the SQL, what sorts within it.
_KEYS = """SELECT 1 AS r, c_custkey::DOUBLE AS n, '' AS s, c_custkey::VARCHAR AS k FROM customer
UNION ALL SELECT 1, o_orderkey + 0.5, '', (o_orderkey + 0.5)::DECIMAL(18, 1)::VARCHAR FROM orders WHERE o_orderkey % 3 = 0
UNION ALL SELECT 1, -p_partkey - 1, '', '{"$numberLong":"-' || (p_partkey + 1) || '"}' FROM part
UNION ALL SELECT 2, 0, p_name || p_partkey, '"' || p_name || p_partkey || '"' FROM part
UNION ALL SELECT 3, 0, md5(o_orderkey::VARCHAR)[1:24], '{"$oid":"' || md5(o_orderkey::VARCHAR)[1:24] || '"}' FROM orders
UNION ALL SELECT 4, 0, b, b FROM (VALUES ('false'), ('true')) v(b) UNION ALL SELECT 0, 0, '', 'null'
UNION ALL SELECT 5, event_id, '', '{"$date":{"$numberLong":"' || event_id || '"}}' FROM events"""


def _keys(spark: SparkSession, sf: str) -> DataFrame:
    def of(name: str, key: Column, where: str = "true") -> DataFrame:
        return table(spark, sf, name).filter(where).select(key.alias("k"))

    text = lambda c: F.col(c).cast("string")
    oid = F.substring(F.md5(text("o_orderkey")), 1, 24)
    parts = [
        of("customer", text("c_custkey")), of("orders", (F.col("o_orderkey") + F.lit(0.5)).cast("decimal(18,1)").cast("string"), "o_orderkey % 3 = 0"), of("part", F.concat(F.lit('{"$numberLong":"-'), (F.col("p_partkey") + 1).cast("string"), F.lit('"}'))),
        of("part", F.concat(F.lit('"'), "p_name", text("p_partkey"), F.lit('"'))), of("orders", F.concat(F.lit('{"$oid":"'), oid, F.lit('"}'))), spark.createDataFrame([("false",), ("true",), ("null",)], "k string"),
        of("events", F.concat(F.lit('{"$date":{"$numberLong":"'), text("event_id"), F.lit('"}}'))),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out


@registered(f"SELECT (rn // 400)::BIGINT AS segment, count(*) AS n, arg_min(k, rn) AS lo, arg_max(k, rn) AS hi FROM (SELECT k, row_number() OVER (ORDER BY r, n, s) - 1 AS rn FROM ({_KEYS})) GROUP BY 1")
def segments_encoded(spark: SparkSession, sf: str) -> DataFrame:
    """Segments over keys of several types in one order."""
    rows = _keys(spark, sf).withColumn("e", encoded(F.parse_json("k")))
    return segments.segments(rows, "e", 400, label="k").select("segment", "n", F.col("lo_label").alias("lo"), F.col("hi_label").alias("hi"))


@registered(f"""SELECT kind, count(*) FILTER (r = 1 AND n > 100.5) AS above_number, count(*) FILTER (r = 2 AND s > 'm') AS above_text, count(*) FILTER (r = 5 AND n <= 50) AS to_date, count(*) AS n
FROM (SELECT *, CASE r WHEN 0 THEN '10' WHEN 1 THEN '20' WHEN 2 THEN '30' WHEN 3 THEN '60' WHEN 4 THEN '70' ELSE '80' END AS kind FROM ({_KEYS})) GROUP BY kind""")
def match_brackets(spark: SparkSession, sf: str) -> DataFrame:
    """Comparisons with values of one type, which hold for values of that type only."""
    doc = F.parse_json(F.concat(F.lit('{"k":'), "k", F.lit("}")))
    rows = _keys(spark, sf).select(bracket(F.parse_json("k")).alias("kind"), doc.alias("d"))
    tests = {"above_number": {"$gt": 100.5}, "above_text": {"$gt": "m"}, "to_date": {"$lte": {"$date": {"$numberLong": "50"}}}}
    return rows.groupBy("kind").agg(*[F.count_if(documents.matches(F.col("d"), {"k": t})).alias(n) for n, t in tests.items()], F.count("*").alias("n"))


def _orders(spark: SparkSession, sf: str) -> DataFrame:
    """key, doc, status: orders as documents with an array of their lines and one of what the lines' parts are called."""
    line = F.struct(F.col("l_partkey").alias("p"), F.col("l_quantity").cast("int").alias("q"))
    lines = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.sort_array(F.collect_list(line)).alias("lines"), F.sort_array(F.collect_set(F.col("l_partkey") % 10)).alias("tags"))
    o = table(spark, sf, "orders").join(lines, F.col("l_orderkey") == F.col("o_orderkey"))
    doc = F.to_json(F.struct(F.col("o_orderkey").alias("_id"), F.col("o_custkey").alias("c"), F.col("o_totalprice").cast("double").alias("t"), "tags", "lines"))
    return o.select(F.col("o_orderkey").alias("key"), doc.alias("doc"), F.col("o_orderstatus").alias("status"))


@registered("""WITH l AS (SELECT l_orderkey AS k, max((l_partkey % 10 = 3)::INT) AS tag, max((l_quantity::INT > 45)::INT) AS big, max((l_quantity::INT >= 40 AND l_partkey % 2 = 0)::INT) AS x, max((l_partkey = 7)::INT) AS seven, max(CASE WHEN l_partkey BETWEEN 5 AND 20 AND l_quantity::INT < 10 THEN 1 ELSE 0 END) AS em, count(*) AS n, max((l_partkey % 10 > 8)::INT) AS nine FROM lineitem GROUP BY 1)
SELECT status, count(*) FILTER (tag = 1) AS equals, count(*) FILTER (big = 1) AS greater, count(*) FILTER (em = 1) AS element, count(*) FILTER (n = 3) AS three, count(*) FILTER (tag = 0) AS unequal, count(*) FILTER (seven = 1 OR nine = 1) AS either
FROM l JOIN (SELECT o_orderkey AS k, o_orderstatus AS status FROM orders) USING (k) GROUP BY status""")
def match_arrays(spark: SparkSession, sf: str) -> DataFrame:
    """Filters through arrays: any element, one element for all conditions, sizes."""
    tests = {
        "equals": {"tags": 3}, "greater": {"lines.q": {"$gt": 45}}, "element": {"lines": {"$elemMatch": {"p": {"$gte": 5, "$lte": 20}, "q": {"$lt": 10}}}},
        "three": {"lines": {"$size": 3}}, "unequal": {"tags": {"$ne": 3}}, "either": {"$or": [{"lines.p": {"$in": [7]}}, {"tags": {"$gt": 8}}]},
    }
    rows = _orders(spark, sf).select("status", F.parse_json("doc").alias("d"))
    return rows.groupBy("status").agg(*[F.count_if(documents.matches(F.col("d"), t)).alias(n) for n, t in tests.items()])


@registered("""SELECT l_partkey AS p, l_quantity::INT AS q, count(DISTINCT l_orderkey) AS n FROM lineitem JOIN orders ON o_orderkey = l_orderkey
WHERE l_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity::INT > 30) AND o_totalprice > 50000 GROUP BY 1, 2 HAVING count(DISTINCT l_orderkey) > 1""")
def index_violations(spark: SparkSession, sf: str) -> DataFrame:
    """What a unique, partial index over two fields of an array's objects meets more than once."""
    partial = {"lines.q": {"$gt": 30}, "t": {"$gt": 50000}}
    found = documents.index_violations(_orders(spark, sf), "key", "doc", ["lines.p", "lines.q"], partial=partial)
    number = lambda i: F.concat(F.lit("0"), F.substring(F.col("keys")[i], 5, 20)).cast("bigint")  # noqa: E731  the digits of whole numbers, none for zero
    return found.select(number(0).alias("p"), number(1).cast("int").alias("q"), "n")


@registered("""WITH dup AS (SELECT o_orderstatus AS s, o_custkey AS c, count(*) AS n, count(*) FILTER (o_totalprice > 400000) AS big FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem) GROUP BY 1, 2)
SELECT 'shop.orders_' || s AS namespace, 'by_customer' AS name, 'failed' AS type FROM dup GROUP BY s HAVING max(n) > 1
UNION ALL SELECT 'shop.orders_' || s, 'large', 'failed' FROM dup GROUP BY s HAVING max(big) > 1""")
def finalize_report(spark: SparkSession, sf: str) -> DataFrame:
    """Finalizing a catalog whose unique indexes were relaxed: those that the documents do not allow."""
    orders = _orders(spark, sf).persist()
    c = Catalog()
    for r in orders.select("status").distinct().collect():  # three
        c.create("shop", f"orders_{r.status}")
        large = (("partialFilterExpression", {"t": {"$gt": 400000}}),)
        c.create_indexes("shop", f"orders_{r.status}", [Index("by_key", (("_id", 1),), unique=True), Index("by_customer", (("c", 1),), unique=True), Index("large", (("c", 1),), unique=True, options=large)])
    report = c.finalize(lambda ns, index: documents.why_violated(orders.filter(F.col("status") == ns[1].removeprefix("orders_")), "key", "doc", index))
    orders.unpersist()
    return spark.createDataFrame([(r["namespace"], r["name"], r["type"]) for r in report], "namespace string, name string, type string")


@registered("""SELECT o_orderkey AS key, (5 + (1 + 4 + 4) + (1 + 2 + 4) + (1 + 2 + 8) + (1 + 5 + 5 + nt * (1 + 2 + 4)) + (1 + 6 + 5 + greatest(n - 10, 0) + n * (1 + 2 + 5 + (1 + 2 + 4) + (1 + 2 + 4))))::BIGINT AS size
FROM orders JOIN (SELECT l_orderkey, count(*) AS n, count(DISTINCT l_partkey % 10) AS nt FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey""")
def document_sizes(spark: SparkSession, sf: str) -> DataFrame:
    return _orders(spark, sf).select("key", documents.document_size(F.col("doc")).alias("size"))


@registered("""WITH s AS (SELECT o_orderkey AS k, o_totalprice AS v FROM orders), t AS (SELECT k, CASE WHEN k % 89 = 0 THEN v + 1 ELSE v END AS v FROM s WHERE k % 97 <> 0 UNION ALL SELECT -k - 1, v FROM s WHERE k % 101 = 0)
SELECT coalesce(s.k, t.k) AS k, CASE WHEN t.k IS NULL THEN 'missing' WHEN s.k IS NULL THEN 'extra' ELSE 'changed' END AS kind FROM s FULL JOIN t ON s.k = t.k WHERE s.v IS DISTINCT FROM t.v""")
def hash_tree_diff(spark: SparkSession, sf: str) -> DataFrame:
    """Differences of two sides, found down a tree of order-free sums of ranges."""
    source = table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("v"))
    target = source.filter("k % 97 != 0").withColumn("v", F.when(F.col("k") % 89 == 0, F.col("v") + 1).otherwise(F.col("v")))
    target = target.unionByName(source.filter("k % 101 = 0").withColumn("k", -F.col("k") - 1))
    return verify.tree_differences(source, target, "k", "v")


@registered("SELECT c_nationkey AS _id, count(*)::BIGINT AS n, max(c_acctbal) AS top FROM customer WHERE c_acctbal > 0 AND c_mktsegment IN ('BUILDING', 'MACHINERY') GROUP BY 1 HAVING count(*) > 2")
def views_of_views(spark: SparkSession, sf: str) -> DataFrame:
    """A view on a view on a collection, made by changes of a log; the collection's documents are JSON."""
    c = Catalog()
    for name, body in (
        ("customers", {}), ("rich", {"viewOn": "customers", "pipeline": [{"$match": {"c_acctbal": {"$gt": 0}}}]}),
        ("some", {"viewOn": "rich", "pipeline": [{"$match": {"c_mktsegment": {"$in": ["BUILDING", "MACHINERY"]}}}, {"$project": {"c_nationkey": 1, "c_acctbal": 1}}]}),
        ("nations", {"viewOn": "some", "pipeline": [{"$group": {"_id": "$c_nationkey", "n": {"$sum": 1}, "top": {"$max": "$c_acctbal"}}}, {"$match": {"n": {"$gt": 2}}}]}),
    ):
        c.apply("create", "shop", name, body)
    docs = table(spark, sf, "customer").select(F.to_json(F.struct("c_custkey", "c_nationkey", F.col("c_acctbal").cast("double").alias("c_acctbal"), "c_mktsegment")).alias("doc"))
    rows = views.ViewGraph(c).read(("shop", "nations"), lambda ns: views.as_columns(docs))
    return rows.select(F.col("_id").cast("int").alias("_id"), F.col("n").cast("bigint").alias("n"), F.col("top").cast("double").alias("top"))
