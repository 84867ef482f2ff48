"""The queries of the engine's own operators over the test tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import catalog, fold, namespaces, progress, segments, verify, views
from ..session import table
from ..streaming import replicate
from .registry import ORACLES, QUERIES, Query, registered

#: The events table as a log, in SQL.
_LOG = """log AS (SELECT user_id, event_id, ts, value, event_type, CASE event_type WHEN 'signup' THEN 'insert' WHEN 'purchase' THEN 'replace' WHEN 'error' THEN 'delete' ELSE 'update' END AS op,
  row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events)"""


@registered(f"""WITH {_LOG},
life AS (SELECT user_id, max(CASE WHEN op IN ('insert', 'delete') THEN n END) AS ln FROM log GROUP BY user_id),
base AS (SELECT l.user_id, max(b.n) AS bn FROM life l JOIN log e ON e.user_id = l.user_id AND e.n = l.ln AND e.op = 'insert' JOIN log b ON b.user_id = l.user_id AND b.n >= l.ln AND b.op IN ('insert', 'replace') GROUP BY l.user_id),
d AS (SELECT b.user_id, count(*) AS k, max(e.n) AS last FROM base b JOIN log e ON e.user_id = b.user_id AND e.n > b.bn AND e.op = 'update' GROUP BY b.user_id)
SELECT b.user_id, e.event_id AS base_event, e.value AS base_value, coalesce(d.k, 0)::BIGINT AS n_deltas, coalesce(x.value, e.value) AS last_value
FROM base b JOIN log e ON e.user_id = b.user_id AND e.n = b.bn LEFT JOIN d ON d.user_id = b.user_id LEFT JOIN log x ON x.user_id = b.user_id AND x.n = d.last""")
def cdc_fold_live(spark: SparkSession, sf: str) -> DataFrame:
    s = fold.state(fold.log_of(table(spark, sf, "events")))
    return s.select(F.col("key").alias("user_id"), F.col("base_order.event_id").alias("base_event"), "base_value", F.col("n_deltas").cast("bigint").alias("n_deltas"), "last_value")


@registered(f"WITH {_LOG} SELECT user_id, event_id, value FROM log WHERE op <> 'delete' QUALIFY n = max(n) OVER (PARTITION BY user_id)".replace("WHERE op <> 'delete' QUALIFY n = max(n) OVER (PARTITION BY user_id)", "JOIN (SELECT user_id, max(n) AS n FROM log GROUP BY user_id) USING (user_id, n) WHERE op <> 'delete'"))
def cdc_latest_per_key(spark: SparkSession, sf: str) -> DataFrame:
    return fold.latest(fold.log_of(table(spark, sf, "events"))).select(F.col("key").alias("user_id"), F.col("order.event_id").alias("event_id"), "value")


@registered(f"""WITH {_LOG}, b AS (SELECT user_id, max(n) AS bn FROM log WHERE op <> 'update' GROUP BY user_id),
w AS (SELECT log.*, row_number() OVER (PARTITION BY user_id, event_type ORDER BY n DESC) AS r FROM log LEFT JOIN b USING (user_id) WHERE op = 'update' AND (bn IS NULL OR n > bn))
SELECT user_id, event_type AS field, event_id, value FROM w WHERE r = 1""")
def cdc_field_lww(spark: SparkSession, sf: str) -> DataFrame:
    return fold.last_writes(fold.log_of(table(spark, sf, "events"))).select(F.col("key").alias("user_id"), "field", F.col("order.event_id").alias("event_id"), "value")


@registered(f"WITH {_LOG} SELECT op, count(*) AS n FROM log GROUP BY op")
def cdc_op_counts(spark: SparkSession, sf: str) -> DataFrame:
    return fold.log_of(table(spark, sf, "events")).groupBy("op").agg(F.count("*").alias("n"))


@registered("""WITH f AS (SELECT event_id, sum(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END) OVER (ORDER BY ts, event_id)::BIGINT AS epoch FROM events)
SELECT epoch, count(*) AS n, min(event_id) AS first_event FROM f GROUP BY epoch""")
def ddl_epochs(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").select("event_id", "ts", "event_type")
    return fold.epochs(e, F.col("event_type") == "signup", ["ts", "event_id"]).groupBy("epoch").agg(F.count("*").alias("n"), F.min("event_id").alias("first_event"))


_INCLUDE, _EXCLUDE = ("src0.*", "src1.en", "src2.en", "src2.fr"), ("src0.de", "src1.*", "src3.en")


def _ns_query(include: tuple[str, ...], exclude: tuple[str, ...]) -> Query:
    return lambda spark, sf: table(spark, sf, "documents").filter(namespaces.selected(F.col("source"), F.col("lang"), include, exclude)).select("doc_id", "source", "lang")


_IN = "(source = 'src0' OR (source = 'src1' AND lang = 'en') OR (source = 'src2' AND lang IN ('en', 'fr')))"
_OUT = "((source = 'src0' AND lang = 'de') OR source = 'src1' OR (source = 'src3' AND lang = 'en'))"
for _name, _args, _where in (("ns_filter_include", (_INCLUDE, ()), _IN), ("ns_filter_exclude", ((), _EXCLUDE), f"NOT {_OUT}"), ("ns_filter_both", (_INCLUDE, _EXCLUDE), f"{_IN} AND NOT {_OUT}")):
    QUERIES[_name] = _ns_query(*_args)
    ORACLES[_name] = f"SELECT doc_id, source, lang FROM documents WHERE {_where}"


@registered(f"SELECT doc_id, source AS db, lang AS coll FROM documents WHERE {_IN} AND NOT {_OUT}")
def ns_filter_join(spark: SparkSession, sf: str) -> DataFrame:
    lists = spark.createDataFrame([(k, *e.split(".")) for k, es in (("include", _INCLUDE), ("exclude", _EXCLUDE)) for e in es], "kind string, db string, coll string")
    rows = table(spark, sf, "documents").select("doc_id", F.col("source").alias("db"), F.col("lang").alias("coll"))
    return namespaces.selected_by_join(rows, lists)


@registered("SELECT page_id, regexp_extract(url, '://([^./]*)', 1) AS name FROM pages WHERE NOT regexp_matches(regexp_extract(url, '://([^./]*)', 1), '^(blog|m)$') AND regexp_extract(url, '://([^./]*)', 1) NOT IN ('admin', 'config', 'local', 'rillstone_state') AND NOT regexp_matches(regexp_extract(url, '://([^./]*)', 1), '^system\\.')")
def system_name_filter(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "pages").select("page_id", F.regexp_extract("url", "://([^./]*)", 1).alias("name"))
    return rows.filter(namespaces.user_databases(F.col("name")) & namespaces.user_collections(F.col("name")) & ~F.col("name").rlike("^(blog|m)$"))


@registered("SELECT source, lang, count(*) AS n_docs, sum(octet_length(encode(text)))::BIGINT AS size_bytes, (sum(octet_length(encode(text))) // count(*))::BIGINT AS avg_size FROM documents GROUP BY source, lang")
def collstats_group(spark: SparkSession, sf: str) -> DataFrame:
    return segments.collection_stats(table(spark, sf, "documents"), ("source", "lang"), F.octet_length("text"))


@registered("SELECT source, lang, count(*) AS n_docs, sum(n_chars)::BIGINT AS chars FROM documents GROUP BY ROLLUP (source, lang)")
def collstats_rollup(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").rollup("source", "lang").agg(F.count("*").alias("n_docs"), F.sum("n_chars").alias("chars"))


@registered("SELECT min(o_orderkey) AS min_key, max(o_orderkey) AS max_key FROM orders")
def key_min_max(spark: SparkSession, sf: str) -> DataFrame:
    return segments.key_range(table(spark, sf, "orders"), "o_orderkey")


_TYPED = "SELECT 'int' AS kind, lpad(c_custkey::VARCHAR, 12, '0') AS k FROM customer UNION ALL SELECT 'string', p_name FROM part UNION ALL SELECT 'date', strftime(o_orderdate, '%Y-%m-%d') FROM orders"


@registered(f"SELECT kind, count(*) AS n, min(k) AS min_key, max(k) AS max_key FROM ({_TYPED}) GROUP BY kind")
def type_range_groups(spark: SparkSession, sf: str) -> DataFrame:
    ints = table(spark, sf, "customer").select(F.lit("int").alias("kind"), F.lpad(F.col("c_custkey").cast("string"), 12, "0").alias("k"))
    names = table(spark, sf, "part").select(F.lit("string").alias("kind"), F.col("p_name").alias("k"))
    dates = table(spark, sf, "orders").select(F.lit("date").alias("kind"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("k"))
    return segments.type_ranges(ints.union(names).union(dates), "kind", "k")


@registered("SELECT (rn // 1000)::BIGINT AS segment, count(*) AS n, min(o_orderkey) AS lo, max(o_orderkey) AS hi FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS rn FROM orders) GROUP BY 1")
def segments_skip(spark: SparkSession, sf: str) -> DataFrame:
    return segments.segments(table(spark, sf, "orders"), "o_orderkey", 1000)


@registered("SELECT tile::BIGINT AS tile, count(*) AS n, min(c_custkey) AS lo, max(c_custkey) AS hi FROM (SELECT c_custkey, ntile(8) OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS tile FROM customer) GROUP BY tile")
def segments_ntile(spark: SparkSession, sf: str) -> DataFrame:
    tile = F.ntile(8).over(Window.partitionBy("c_nationkey").orderBy("c_custkey"))
    return table(spark, sf, "customer").withColumn("tile", tile.cast("bigint")).groupBy("tile").agg(F.count("*").alias("n"), F.min("c_custkey").alias("lo"), F.max("c_custkey").alias("hi"))


@registered("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey BETWEEN 1000 AND 5000")
def segment_scan(spark: SparkSession, sf: str) -> DataFrame:
    return segments.scan(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), "o_orderkey", 1000, 5000)


@registered("SELECT source, lang, size_bytes, row_number() OVER (ORDER BY size_bytes DESC, source, lang) AS place FROM (SELECT source, lang, sum(octet_length(encode(text)))::BIGINT AS size_bytes FROM documents GROUP BY source, lang)")
def largest_first(spark: SparkSession, sf: str) -> DataFrame:
    stats = segments.collection_stats(table(spark, sf, "documents"), ("source", "lang"), F.octet_length("text")).select("source", "lang", "size_bytes")
    return segments.largest_first(stats, "size_bytes", "source", "lang")


@registered("SELECT user_id, h, h % 8 AS worker FROM (SELECT DISTINCT user_id, list_reduce(list_prepend(2166136261::BIGINT, list_transform(string_split(user_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)), lambda h, x: ((xor(h, x) * 16777619::BIGINT) & 4294967295::BIGINT)) AS h FROM events)")
def route_fnv1a(spark: SparkSession, sf: str) -> DataFrame:
    keys = table(spark, sf, "events").select("user_id").distinct()
    return keys.select("user_id", S.fnv1a(F.col("user_id").cast("string")).alias("h"), S.route(F.col("user_id").cast("string"), 8).alias("worker"))


@registered("SELECT source, batch, count(*) AS n, sum(n_chars)::BIGINT AS chars FROM (SELECT source, n_chars, (coalesce(sum(n_chars) OVER (PARTITION BY source ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) // 100000)::BIGINT AS batch FROM documents) GROUP BY source, batch")
def pack_running(spark: SparkSession, sf: str) -> DataFrame:
    rows = segments.batches_by_sum(table(spark, sf, "documents").select("source", "doc_id", "n_chars"), "doc_id", F.col("n_chars"), 100_000, "source")
    return rows.groupBy("source", "batch").agg(F.count("*").alias("n"), F.sum("n_chars").alias("chars"))


@registered("""WITH RECURSIVE o AS (SELECT c_nationkey AS g, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS i, c_custkey AS s FROM customer),
r AS (SELECT g, i, s AS total, 1 AS cnt, 0::BIGINT AS batch, s FROM o WHERE i = 1
  UNION ALL SELECT o.g, o.i, CASE WHEN r.total + o.s > 5000 OR r.cnt >= 20 THEN o.s ELSE r.total + o.s END, CASE WHEN r.total + o.s > 5000 OR r.cnt >= 20 THEN 1 ELSE r.cnt + 1 END,
    CASE WHEN r.total + o.s > 5000 OR r.cnt >= 20 THEN r.batch + 1 ELSE r.batch END, o.s FROM r JOIN o ON o.g = r.g AND o.i = r.i + 1)
SELECT g::BIGINT AS nation, batch, count(*) AS n, sum(s)::BIGINT AS total FROM r GROUP BY g, batch""")
def pack_greedy(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "customer").select(F.col("c_nationkey").cast("bigint").alias("nation"), "c_custkey")
    out = segments.greedy_batches(rows, "nation", "c_custkey", "c_custkey", 5000, 20)
    return out.groupBy("nation", "batch").agg(F.count("*").alias("n"), F.sum("c_custkey").alias("total"))


@registered("SELECT l_suppkey, chunk, count(*) AS n FROM (SELECT l_suppkey, ((row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey) - 1) // 100)::BIGINT AS chunk FROM lineitem) GROUP BY l_suppkey, chunk")
def chunk_by_count(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "lineitem").select("l_suppkey", F.struct("l_orderkey", "l_linenumber", "l_partkey").alias("o"))
    return segments.chunks_by_count(rows, "l_suppkey", "o", 100).groupBy("l_suppkey", "chunk").agg(F.count("*").alias("n"))


@registered("SELECT n_regionkey::BIGINT AS region, count(*) AS n, md5(string_agg(n_nationkey || '|' || n_name, chr(10) ORDER BY n_nationkey)) AS hash FROM nation GROUP BY n_regionkey")
def content_hash(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "nation").withColumn("region", F.col("n_regionkey").cast("bigint"))
    return verify.content_hash(rows, ("region",), "n_nationkey", F.concat_ws("|", F.col("n_nationkey").cast("string"), "n_name"))


@registered("""WITH p AS (SELECT o_orderstatus AS status, o_orderkey // 1000 AS r, count(*) AS n, md5(string_agg(o_orderkey || '|' || o_custkey, chr(10) ORDER BY o_orderkey)) AS hash FROM orders GROUP BY 1, 2)
SELECT status, sum(n)::BIGINT AS n, md5(string_agg(hash, chr(10) ORDER BY r)) AS hash FROM p GROUP BY status""")
def content_hash_ranges(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "orders").withColumnRenamed("o_orderstatus", "status")
    return verify.range_hash(rows, ("status",), "o_orderkey", F.concat_ws("|", F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string")), 1000)


def _mutated(orders: DataFrame) -> DataFrame:
    """A target that lacks every 97th order, has others changed and some of its own."""
    kept = orders.filter("o_orderkey % 97 != 0").withColumn("o_totalprice", F.when(F.col("o_orderkey") % 89 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
    return kept.unionByName(orders.filter("o_orderkey % 1009 = 0").withColumn("o_orderkey", -F.col("o_orderkey")))


_MUTATED = "t AS (SELECT o_orderkey, CASE WHEN o_orderkey % 89 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS p FROM orders WHERE o_orderkey % 97 <> 0 UNION ALL SELECT -o_orderkey, o_totalprice FROM orders WHERE o_orderkey % 1009 = 0)"


@registered(f"WITH {_MUTATED} SELECT coalesce(s.o_orderkey, t.o_orderkey) AS o_orderkey, CASE WHEN t.o_orderkey IS NULL THEN 'missing' WHEN s.o_orderkey IS NULL THEN 'extra' ELSE 'changed' END AS kind FROM orders s FULL JOIN t ON s.o_orderkey = t.o_orderkey WHERE t.o_orderkey IS NULL OR s.o_orderkey IS NULL OR s.o_totalprice IS DISTINCT FROM t.p")
def diff_source_target(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return verify.differences(orders, _mutated(orders), "o_orderkey", "o_totalprice")


@registered(f"WITH {_MUTATED} SELECT count(*) AS n_outside FROM t WHERE NOT EXISTS (SELECT 1 FROM orders s WHERE s.o_orderkey = t.o_orderkey)")
def subset_check(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return verify.outside(_mutated(orders), orders, "o_orderkey")


@registered("SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'target' ELSE 'source' END AS side FROM orders")
def insert_if_absent(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey")
    return fold.insert_absent(orders.filter("o_orderkey % 3 = 0").withColumn("side", F.lit("target")), orders.withColumn("side", F.lit("source")), "o_orderkey")


@registered("SELECT o_orderkey, s.o_totalprice AS price, CASE WHEN s.o_orderkey IS NULL THEN 'delete' ELSE 'upsert' END AS action FROM (SELECT o_orderkey FROM orders WHERE o_orderkey % 50 = 0) f LEFT JOIN (SELECT * FROM orders WHERE o_orderkey % 4 <> 0) s USING (o_orderkey)")
def refetch_resolution(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    source = orders.filter("o_orderkey % 4 != 0").select("o_orderkey", F.col("o_totalprice").alias("price"))
    return fold.refetched(orders.filter("o_orderkey % 50 = 0").select("o_orderkey"), source, "o_orderkey")


@registered("SELECT c_nationkey::BIGINT AS nation, c_custkey, c_acctbal FROM customer QUALIFY row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey DESC) = 1")
def conflict_resolution(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "customer").select(F.col("c_nationkey").cast("bigint").alias("nation"), "c_custkey", "c_acctbal")
    return fold.resolve_conflicts(rows, "nation", "c_custkey")


def _workers(spark: SparkSession, sf: str, lost: int | None = None) -> DataFrame:
    e = table(spark, sf, "events").select((F.col("user_id") % 8).alias("worker"), S.logical_time(S.seconds(F.col("ts")), F.col("event_id")).alias("at"), "event_type")
    done = F.when((F.col("event_type") != "error") & (F.lit(True) if lost is None else F.col("worker") != lost), F.col("at"))
    return e.groupBy("worker").agg(F.max("at").alias("routed"), F.max(done).alias("committed"))


_AT = "SELECT user_id % 8 AS worker, floor(epoch(ts))::BIGINT AS t, event_id AS i, event_type FROM events"
_LAST = "row_number() OVER (PARTITION BY worker ORDER BY t DESC, i DESC)"


@registered(f"WITH e AS ({_AT}), c AS (SELECT worker, t, i FROM e WHERE event_type <> 'error' QUALIFY {_LAST} = 1) SELECT t, i FROM c ORDER BY t, i LIMIT 1")
def checkpoint_min(spark: SparkSession, sf: str) -> DataFrame:
    return progress.checkpoint(_workers(spark, sf)).select("checkpoint.t", "checkpoint.i")


@registered(f"""WITH e AS ({_AT}), r AS (SELECT worker, t, i FROM e QUALIFY {_LAST} = 1), c AS (SELECT worker, t, i FROM e WHERE event_type <> 'error' AND worker <> 3 QUALIFY {_LAST} = 1),
f AS (SELECT coalesce(c.t, CASE WHEN r.i > 0 THEN r.t WHEN r.t > 0 THEN r.t - 1 ELSE 0 END) AS t, coalesce(c.i, CASE WHEN r.i > 0 THEN r.i - 1 WHEN r.t > 0 THEN 4294967295 ELSE 0 END) AS i FROM r LEFT JOIN c USING (worker))
SELECT t, i FROM f ORDER BY t, i LIMIT 1""")
def checkpoint_min_pred(spark: SparkSession, sf: str) -> DataFrame:
    return progress.checkpoint(_workers(spark, sf, 3)).select("checkpoint.t", "checkpoint.i")


@registered(f"WITH e AS ({_AT}), r AS (SELECT worker, event_type FROM e QUALIFY {_LAST} = 1) SELECT bool_and(event_type <> 'error') AS idle FROM r")
def pool_idle(spark: SparkSession, sf: str) -> DataFrame:
    return progress.idle(_workers(spark, sf))


@registered("WITH m AS (SELECT max(floor(epoch(ts))::BIGINT) AS s FROM events) SELECT user_id, greatest(s - max(floor(epoch(ts))::BIGINT), 0)::BIGINT AS lag_seconds FROM events, m GROUP BY user_id, s")
def lag_seconds(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").select("user_id", S.seconds(F.col("ts")).alias("t"))
    source = e.agg(F.max("t")).first()[0]  # the source's clock
    return e.groupBy("user_id").agg(F.max("t").alias("applied")).select("user_id", progress.lag(F.lit(source), F.col("applied")).alias("lag_seconds"))


@registered("SELECT user_id, max(event_id) > 5000 AS done FROM events GROUP BY user_id")
def initial_sync_flag(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").groupBy("user_id").agg(progress.initial_sync_done(F.max("event_id"), F.lit(5000)).alias("done"))


@registered("""WITH s AS (SELECT DISTINCT CASE WHEN l_linenumber = 1 THEN '_id_' ELSE 'ix_' || l_returnflag || l_linestatus || l_linenumber END AS name, CASE WHEN l_linenumber = 1 THEN l_suppkey % 10 ELSE l_suppkey % (l_linenumber + 4) END AS shard FROM lineitem),
c AS (SELECT name, count(*) AS n_shards, min(name) AS spec FROM s GROUP BY name) SELECT name, n_shards, spec FROM c WHERE n_shards < (SELECT n_shards FROM c WHERE name = '_id_')""")
def index_inconsistent(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "lineitem")
    shard = F.when(F.col("l_linenumber") == 1, F.col("l_suppkey") % 10).otherwise(F.col("l_suppkey") % (F.col("l_linenumber") + 4))
    name = F.when(F.col("l_linenumber") == 1, "_id_").otherwise(F.concat(F.lit("ix_"), "l_returnflag", "l_linestatus", F.col("l_linenumber").cast("string")))
    stats = rows.select(name.alias("name"), shard.alias("shard")).distinct().withColumn("spec", F.col("name"))
    return catalog.inconsistent(stats)


@registered("SELECT p_partkey::VARCHAR AS name, CASE WHEN p_size % 7 = 0 THEN 'inconsistent' WHEN p_size % 5 = 0 THEN 'incomplete' ELSE 'ready' END AS status FROM part")
def index_partition(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part").select(F.col("p_partkey").cast("string").alias("name"), "p_size")
    return catalog.index_sets(part.select("name"), part.filter("p_size % 5 = 0"), part.filter("p_size % 7 = 0"))


@registered("SELECT label, count(*) AS n, max(item)::DOUBLE AS largest FROM (SELECT label, unnest(embedding) AS item FROM embeddings) GROUP BY label")
def index_builds_unwind(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.builds_in_progress(table(spark, sf, "embeddings"), "embedding").groupBy("label").agg(F.count("*").alias("n"), F.max(F.col("item").cast("double")).alias("largest"))


@registered("SELECT c_nationkey::BIGINT AS nation, c_mktsegment AS segment, count(*) AS n FROM customer GROUP BY c_nationkey, c_mktsegment HAVING count(*) > 1")
def unique_violations(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "customer").select(F.col("c_nationkey").cast("bigint").alias("nation"), F.col("c_mktsegment").alias("segment"))
    return catalog.violations(rows, ["nation", "segment"])


@registered("SELECT o_orderkey, ((o_totalprice::BIGINT + 255) // 256 * 256)::BIGINT AS aligned FROM orders".replace("o_totalprice::BIGINT", "floor(o_totalprice)::BIGINT"))
def capped_align(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select("o_orderkey", S.aligned(F.floor("o_totalprice").cast("bigint")).alias("aligned"))


@registered("SELECT event_type, event_id, place FROM (SELECT event_type, event_id, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS place FROM events) WHERE place <= 100")
def capped_order_tail(spark: SparkSession, sf: str) -> DataFrame:
    return fold.tail(table(spark, sf, "events"), "event_type", ["ts", "event_id"], 100).select("event_type", "event_id", F.col("place").cast("bigint").alias("place"))


@registered("SELECT event_id, coalesce(m.ns, 'own.' || event_type) AS ns FROM events e LEFT JOIN (SELECT DISTINCT user_id, 'db' || (user_id % 4) || '.c' || user_id AS ns FROM events WHERE user_id % 2 = 0) m USING (user_id)")
def uuid_resolve(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").select("event_id", F.col("user_id").alias("uuid"), S.namespace(F.lit("own"), F.col("event_type")).alias("own"))
    known = e.filter("uuid % 2 = 0").select("uuid").distinct().withColumn("ns", F.concat(F.lit("db"), (F.col("uuid") % 4).cast("string"), F.lit(".c"), F.col("uuid").cast("string")))
    return catalog.resolved(e, known, "own").select("event_id", "ns")


@registered("SELECT l_orderkey, l_linenumber, path, (path = 'a.1' OR starts_with(path, 'a.1.') OR path = 'b' OR starts_with(path, 'b.')) AS conflicts FROM (SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber % 2 = 0 THEN 'a.' ELSE 'b' END || (l_partkey % 12)::VARCHAR || CASE WHEN l_suppkey % 2 = 0 THEN '.x' ELSE '' END AS path FROM lineitem)")
def path_conflict(spark: SparkSession, sf: str) -> DataFrame:
    path = F.concat(F.when(F.col("l_linenumber") % 2 == 0, "a.").otherwise("b"), (F.col("l_partkey") % 12).cast("string"), F.when(F.col("l_suppkey") % 2 == 0, ".x").otherwise(""))
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", path.alias("path"))
    return rows.withColumn("conflicts", S.path_conflicts(F.col("path"), F.array(F.lit("a.1"), F.lit("b"))))


@registered("SELECT vec_id, len(embedding[1:5])::INT AS n, embedding[5]::DOUBLE AS last_value, len(embedding[-7:])::INT AS n_tail FROM embeddings")
def array_truncate(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "embeddings").select("vec_id", S.truncated(F.col("embedding"), 5).alias("head"), S.sliced(F.col("embedding"), -7).alias("tail"))
    return rows.select("vec_id", F.size("head").alias("n"), F.get("head", F.lit(4)).cast("double").alias("last_value"), F.size("tail").alias("n_tail"))


@registered("SELECT event_id, value FROM events WHERE value >= 50 AND event_type IN ('click', 'view') AND NOT (user_id < 20)")
def view_match(spark: SparkSession, sf: str) -> DataFrame:
    stages = [{"$match": {"value": {"$gte": 50}, "event_type": {"$in": ["click", "view"]}, "user_id": {"$not": {"$lt": 20}}}}, {"$project": {"event_id": 1, "value": 1}}]
    return views.run_pipeline(table(spark, sf, "events"), stages)


@registered("SELECT event_type AS _id, count(*) AS n, max(value) AS top FROM events WHERE user_id >= 10 GROUP BY event_type")
def view_group(spark: SparkSession, sf: str) -> DataFrame:
    stages = [{"$match": {"user_id": {"$gte": 10}}}, {"$group": {"_id": "$event_type", "n": {"$sum": 1}, "top": {"$max": "$value"}}}]
    return views.run_pipeline(table(spark, sf, "events"), stages).withColumn("n", F.col("n").cast("bigint"))


@registered("SELECT c_custkey, (c_custkey IS NOT NULL AND c_acctbal >= 0 AND c_name IS NOT NULL) AS valid FROM customer")
def validator_check(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "customer")
    schema = {"$jsonSchema": {"bsonType": "object", "required": ["c_custkey", "c_name"], "properties": {"c_acctbal": {"bsonType": "double", "minimum": 0}}}}
    return rows.select("c_custkey", views.match(schema, dict(rows.dtypes)).alias("valid"))


@registered("SELECT * FROM (SELECT day, n, n - lag(n) OVER (ORDER BY day) AS delta FROM (SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS n FROM events GROUP BY 1)) WHERE delta IS NOT NULL")
def write_rate(spark: SparkSession, sf: str) -> DataFrame:
    per_day = table(spark, sf, "events").groupBy(F.date_format("ts", "yyyy-MM-dd").alias("day")).agg(F.count("*").alias("n"))
    return progress.rates(per_day, "day", "n").filter("delta IS NOT NULL")


@registered("SELECT conv_id, count(*) AS n, string_agg(role, ',' ORDER BY turn) AS items FROM conversations GROUP BY conv_id")
def txn_groups(spark: SparkSession, sf: str) -> DataFrame:
    return fold.transactions(table(spark, sf, "conversations"), "conv_id", "turn", "role")


@registered("SELECT event_type, count_if(value <= 10)::BIGINT AS le_10, count_if(value <= 50)::BIGINT AS le_50, count_if(value <= 100)::BIGINT AS le_100, count(value) AS n FROM events GROUP BY event_type")
def metrics_histogram(spark: SparkSession, sf: str) -> DataFrame:
    out = replicate.histogram(table(spark, sf, "events"), "value", (10.0, 50.0, 100.0), "event_type")
    return out.withColumnRenamed("count", "n").drop("sum")


@registered("SELECT event_id, strftime(date_trunc('second', ts), '%Y-%m-%dT%H:%M:%SZ') AS at FROM events")
def optime_dates(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select("event_id", S.rfc3339(S.seconds(F.col("ts"))).alias("at"))


@registered("SELECT i AS idx, 'group ' || (i * 7) % 40 AS category, ['open', 'held', 'closed', 'lost'][i % 4 + 1] AS status, (i * 31) % 997 AS score, (i * 11) % 6 AS priority FROM (SELECT unnest(range(5000)) AS i)")
def generated_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Documents for fixtures: all fields are rules of their number."""
    i = F.col("id")
    states = F.array(*map(F.lit, ("open", "held", "closed", "lost")))
    return spark.range(5000).select(i.alias("idx"), F.concat(F.lit("group "), ((i * 7) % 40).cast("string")).alias("category"), F.get(states, (i % 4).cast("int")).alias("status"), ((i * 31) % 997).alias("score"), ((i * 11) % 6).alias("priority"))


@registered("""WITH f AS (SELECT source, lang, count(*) AS n_docs, sum(n_chars)::BIGINT AS size_bytes, (sum(n_chars) // count(*))::BIGINT AS avg_size FROM documents GROUP BY source, lang)
SELECT source, lang, CASE WHEN lang = 'en' THEN n_docs ELSE n_docs + 1 END AS n_docs, CASE WHEN lang = 'en' THEN size_bytes ELSE 7 END AS size_bytes, CASE WHEN lang = 'en' THEN avg_size ELSE 7 END AS avg_size FROM f""")
def stats_fallback(spark: SparkSession, sf: str) -> DataFrame:
    fresh = segments.collection_stats(table(spark, sf, "documents"), ("source", "lang"), F.col("n_chars"))
    stored = fresh.select("source", "lang", (F.col("n_docs") + 1).alias("n_docs"), F.lit(7).cast("bigint").alias("size_bytes"), F.when(F.col("lang") == "en", 0).otherwise(7).cast("bigint").alias("avg_size"))
    return segments.with_fallback(stored, fresh, "source", "lang")


@registered("SELECT sum(CASE WHEN lang = 'de' THEN NULL WHEN lang = 'en' THEN size_bytes ELSE size_bytes // 2 END)::BIGINT AS total_bytes, sum(CASE WHEN lang = 'en' THEN size_bytes ELSE 0 END)::BIGINT AS copied_bytes FROM (SELECT source, lang, sum(n_chars)::BIGINT AS size_bytes FROM documents GROUP BY source, lang) WHERE lang <> 'de'")
def clone_totals(spark: SparkSession, sf: str) -> DataFrame:
    stats = segments.collection_stats(table(spark, sf, "documents"), ("source", "lang"), F.col("n_chars"))
    planned = stats.select("source", "lang", F.expr("size_bytes div 2").alias("estimate"))
    done = stats.select("source", "lang", F.when(F.col("lang") == "en", F.col("size_bytes")).alias("copied"), (F.col("lang") == "de").alias("dropped"))
    return segments.total_progress(planned, done, "source", "lang")


@registered("SELECT 'db.' || o_orderstatus AS ns, count(*) AS n_chunks, count(DISTINCT chunk % 3) AS n_shards, min(lo) AS first_key FROM (SELECT o_orderstatus, o_orderkey // 500 AS chunk, min(o_orderkey) AS lo FROM orders GROUP BY 1, 2) GROUP BY o_orderstatus")
def shard_chunks(spark: SparkSession, sf: str) -> DataFrame:
    chunks = table(spark, sf, "orders").groupBy(F.concat(F.lit("db."), "o_orderstatus").alias("ns"), F.expr("o_orderkey div 500").alias("chunk")).agg(F.min("o_orderkey").alias("lo"), F.max("o_orderkey").alias("hi"))
    out = catalog.sharding(chunks.withColumn("shard", F.col("chunk") % 3))
    return out.select("ns", "n_chunks", "n_shards", F.get("chunks", F.lit(0))["lo"].alias("first_key"))


@registered("SELECT t, i FROM (SELECT floor(epoch(ts))::BIGINT AS t, event_id AS i FROM events) ORDER BY t DESC, i DESC LIMIT 1")
def cluster_time(spark: SparkSession, sf: str) -> DataFrame:
    from ..sources.logs import cluster_time as latest_time

    log = table(spark, sf, "events").select(S.seconds(F.col("ts")).alias("t"), F.col("event_id").alias("i"))
    return latest_time(log).select("cluster_time.t", "cluster_time.i")


@registered("SELECT event_type, count(*) AS applied, max(event_id) AS last_event, '{\"event_type\":\"' || event_type || '\",\"applied\":' || count(*) || ',\"last_event\":' || max(event_id) || '}' AS status FROM events GROUP BY event_type")
def status_json(spark: SparkSession, sf: str) -> DataFrame:
    return replicate.status_rows(table(spark, sf, "events").groupBy("event_type").agg(F.count("*").alias("applied"), F.max("event_id").alias("last_event")))


from . import documents, metadata, replication, typed  # noqa: E402, F401
