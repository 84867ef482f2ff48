"""Queries of replication: the events table as a log of nested changes, applied by the stream's own functions."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import fold, progress, segments
from ..operators.asof import as_of
from ..session import shared_folder, table
from ..sources import logs
from ..streaming.replicate import Replicator, _newest, apply_changes
from ..streaming.stateful import Folded, stateful
from .registry import registered

#: Events as changes of documents: an insert or replace has {"n": id}, a view sets v, a click writes below c (or n).
_LOG = """log AS (SELECT user_id, event_id, event_type AS e, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events),
life AS (SELECT user_id, max(n) AS ln FROM log WHERE e IN ('signup', 'error') GROUP BY user_id),
base AS (SELECT l.user_id, max(b.n) AS bn FROM life l JOIN log a ON a.user_id = l.user_id AND a.n = l.ln AND a.e = 'signup' JOIN log b ON b.user_id = l.user_id AND b.n >= l.ln AND b.e IN ('signup', 'purchase') GROUP BY l.user_id)"""


def _changes(spark: SparkSession, sf: str, clicks: str, events: DataFrame | None = None) -> DataFrame:
    e = table(spark, sf, "events") if events is None else events
    op = fold.operation(F.col("event_type"))
    path = F.when(F.col("event_type") == "view", "v").otherwise(clicks)
    written = F.array(F.struct(path.alias("path"), F.col("event_id").cast("string").alias("value")))
    return e.select(
        F.lit("d").alias("db"), F.lit("c").alias("coll"), F.col("user_id").cast("string").alias("key"), S.seconds(F.col("ts")).alias("t"), F.lit(0).cast("bigint").alias("i"), F.col("event_id").alias("seq"), op.alias("op"),
        F.when(op.isin("insert", "replace"), F.concat(F.lit('{"n":'), F.col("event_id").cast("string"), F.lit("}"))).alias("full_document"), F.when(op == "update", written).alias("updated_fields"),
        F.lit(None).cast("array<string>").alias("removed_fields"), F.lit(None).cast("array<struct<field:string,new_size:int>>").alias("truncated_arrays"),
        "user_id", "event_type", "ts", F.lit(None).cast("string").alias("collection_uuid"), F.lit(None).cast("string").alias("op_desc"),
    )


def _fields(rows: DataFrame, **paths: str) -> DataFrame:
    return rows.select(F.col("key").cast("bigint").alias("user_id"), *[F.get_json_object("doc", p).cast("bigint").alias(c) for c, p in paths.items()])


def _empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "db string, coll string, key string, doc string")


_FOLDED = f"""WITH {_LOG}
SELECT b.user_id, (SELECT event_id FROM log WHERE log.user_id = b.user_id AND log.n = b.bn) AS n, max(CASE WHEN log.e = 'view' THEN log.event_id END) AS v, max(CASE WHEN log.e = 'click' THEN log.event_id END) AS k
FROM base b LEFT JOIN (SELECT user_id, e, last(event_id ORDER BY n) AS event_id, max(n) AS n FROM (SELECT log.* FROM log JOIN base ON base.user_id = log.user_id AND log.n > base.bn) GROUP BY user_id, e) log ON log.user_id = b.user_id AND log.e IN ('view', 'click')
GROUP BY b.user_id, b.bn"""


@registered(_FOLDED)
def stream_fold(spark: SparkSession, sf: str) -> DataFrame:
    """Inserts, replaces, deletes, writes of fields and below fields, as a stream applies them."""
    return _fields(apply_changes(_empty(spark), _changes(spark, sf, "c.k")), n="$.n", v="$.v", k="$.c.k")


@registered(_FOLDED)
def stateful_fold(spark: SparkSession, sf: str) -> DataFrame:
    """The same of a stream of the events table, by a stateful operator. A stream of a table that is one file needs a pattern."""
    schema = table(spark, sf, "events").schema
    folded = Folded(spark, f"{shared_folder(spark)}/rillstone/folded-{uuid.uuid4().hex}", ["key"])
    folded.start(stateful(_changes(spark, sf, "c.k", spark.readStream.schema(schema).parquet(f"{sf}/events.parque[t]")), ["key"])).awaitTermination()
    return _fields(folded.read(), n="$.n", v="$.v", k="$.c.k")


@registered(f"""WITH {_LOG},
f AS (SELECT b.user_id, b.bn, min(log.n) AS fn FROM base b LEFT JOIN log ON log.user_id = b.user_id AND log.n > b.bn AND log.e = 'click' GROUP BY b.user_id, b.bn),
w AS (SELECT f.user_id, log.e, last(log.event_id ORDER BY log.n) AS event_id FROM f JOIN log ON log.user_id = f.user_id AND log.n > coalesce(f.fn, f.bn) AND log.e IN ('view', 'click') GROUP BY f.user_id, log.e)
SELECT f.user_id, CASE WHEN fn IS NULL THEN (SELECT event_id FROM log WHERE log.user_id = f.user_id AND log.n = f.bn) END AS n, CASE WHEN fn IS NOT NULL THEN coalesce(c.event_id, 0) END AS x, v.event_id AS v
FROM f LEFT JOIN w c ON c.user_id = f.user_id AND c.e = 'click' LEFT JOIN w v ON v.user_id = f.user_id AND v.e = 'view' WHERE fn IS NULL OR f.user_id % 3 <> 0""")
def refetch_stream(spark: SparkSession, sf: str) -> DataFrame:
    """A click writes below a number and fails: its document is fetched from a source that lacks every third."""
    keys = table(spark, sf, "events").select("user_id").distinct().filter("user_id % 3 != 0")
    source = keys.select(F.lit("d").alias("db"), F.lit("c").alias("coll"), F.col("user_id").cast("string").alias("key"), F.lit('{"n":{"x":0}}').alias("doc"))
    rows = apply_changes(_empty(spark), _changes(spark, sf, "n.x"), source)
    number = F.get_json_object("doc", "$.n").try_cast("bigint")
    return rows.select(F.col("key").cast("bigint").alias("user_id"), number.alias("n"), *[F.get_json_object("doc", p).cast("bigint").alias(c) for c, p in (("x", "$.n.x"), ("v", "$.v"))])


@registered("""WITH o AS (SELECT user_id, user_id % 3 AS c, event_id, CASE WHEN event_type = 'error' AND user_id % 25 = 0 THEN 'drop' ELSE event_type END AS e, row_number() OVER (ORDER BY epoch(ts)::BIGINT, event_id) AS n FROM (SELECT *, date_trunc('second', ts) AS s FROM events)),
d AS (SELECT c, max(n) AS dn FROM o WHERE e = 'drop' GROUP BY c),
log AS (SELECT o.* FROM o LEFT JOIN d USING (c) WHERE o.n > coalesce(dn, 0)),
life AS (SELECT user_id, max(n) AS ln FROM log WHERE e IN ('signup', 'error') GROUP BY user_id),
base AS (SELECT l.user_id, max(b.n) AS bn FROM life l JOIN log a ON a.user_id = l.user_id AND a.n = l.ln AND a.e = 'signup' JOIN log b ON b.user_id = l.user_id AND b.n >= l.ln AND b.e IN ('signup', 'purchase') GROUP BY l.user_id)
SELECT b.user_id, 'c' || b.user_id % 3 AS coll, (SELECT event_id FROM log WHERE log.n = b.bn) AS n, (SELECT last(event_id ORDER BY n) FROM log WHERE log.user_id = b.user_id AND log.n > b.bn AND log.e = 'view') AS v FROM base b""".replace("epoch(ts)::BIGINT", "epoch(s)::BIGINT"))
def stream_replicated(spark: SparkSession, sf: str) -> DataFrame:
    """One micro-batch of a replication: errors of some users drop their collection, of others delete."""
    drops = (F.col("event_type") == "error") & (F.col("user_id") % 25 == 0)
    log = _changes(spark, sf, "c.k").withColumns({"coll": F.concat(F.lit("c"), (F.col("user_id") % 3).cast("string")), "op": F.when(drops, "drop").otherwise(F.col("op")), "document_key": F.col("key")})
    r = Replicator(spark, "", f"{shared_folder(spark)}/rillstone/target-{uuid.uuid4().hex}")
    r.batch(log, 0)
    rows = r.target.read()
    return rows.select(F.col("key").cast("bigint").alias("user_id"), "coll", *[F.get_json_object("doc", p).cast("bigint").alias(c) for c, p in (("n", "$.n"), ("v", "$.v"))])


@registered(f"""WITH {_LOG}
SELECT b.user_id, (SELECT event_id FROM log WHERE log.user_id = b.user_id AND log.n = b.bn) AS n, (SELECT last(event_id ORDER BY log.n) FROM log WHERE log.user_id = b.user_id AND log.n > b.bn AND log.e IN ('view', 'click')) AS v
FROM base b""")
def target_merge(spark: SparkSession, sf: str) -> DataFrame:
    """Micro-batches of a log, by time, whose runs are merged on the way; then what the merged target holds."""
    log = _changes(spark, sf, "v").withColumn("document_key", F.col("key"))
    log = log.withColumns({"t": S.seconds(F.col("ts")), "i": F.expr("cast(unix_micros(cast(ts AS timestamp)) % 1000000 AS bigint)")}).drop("ts")
    ends = log.agg(F.min("t").alias("a"), F.max("t").alias("z")).first()
    r = Replicator(spark, "", f"{shared_folder(spark)}/rillstone/target-{uuid.uuid4().hex}", fan=2, first_level=1 << 16, bucket_bytes=1 << 15)
    third = (ends.z - ends.a) // 3 + 1
    for n in range(3):
        r.batch(log.filter((F.col("t") >= ends.a + n * third) & (F.col("t") < ends.a + (n + 1) * third)), n)
    return _fields(r.target.read(), n="$.n", v="$.v")


@registered("SELECT v.user_id, v.event_id, p.event_id AS purchase FROM (SELECT * FROM events WHERE event_type = 'view') v ASOF LEFT JOIN (SELECT user_id, max(event_id) AS event_id, ts FROM events WHERE event_type = 'purchase' GROUP BY user_id, ts) p ON v.user_id = p.user_id AND v.ts > p.ts")
def as_of_purchase(spark: SparkSession, sf: str) -> DataFrame:
    """Each view with its user's last purchase before it."""
    e = table(spark, sf, "events").select("user_id", "ts", "event_id", "event_type")
    purchases = e.filter("event_type = 'purchase'").groupBy("user_id", "ts").agg(F.max("event_id").alias("purchase"))
    return as_of(e.filter("event_type = 'view'"), purchases, ["user_id"], "ts", "purchase").select("user_id", "event_id", "purchase")


@registered("""WITH log AS (SELECT user_id, event_id, event_type AS e, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events UNION ALL SELECT DISTINCT user_id, NULL, 'signup', -1, 0 FROM events WHERE user_id % 2 = 0),
life AS (SELECT user_id, max(n) AS ln FROM log WHERE e IN ('signup', 'error') GROUP BY user_id)
SELECT l.user_id, max_by(b.value, b.n) AS base_value FROM life l JOIN log a ON a.user_id = l.user_id AND a.n = l.ln AND a.e = 'signup' JOIN log b ON b.user_id = l.user_id AND b.n >= l.ln AND b.e IN ('signup', 'purchase') GROUP BY l.user_id""")
def snapshot_handoff(spark: SparkSession, sf: str) -> DataFrame:
    """A snapshot of every second key, then the log."""
    events = table(spark, sf, "events")
    log = fold.log_of(events)
    snapshot = events.filter("user_id % 2 = 0").select(F.col("user_id").alias("key"), F.lit(-1.0).alias("value"), F.lit("signup").alias("field")).distinct()
    return fold.state(fold.with_snapshot(log, snapshot.withColumn("order", F.lit(None)).withColumn("op", F.lit("insert")))).select(F.col("key").alias("user_id"), "base_value")


@registered("SELECT worker, max(n) AS n, max(CASE WHEN n % 100 = 0 THEN event_id END) AS committed FROM (SELECT user_id % 8 AS worker, event_id, row_number() OVER (PARTITION BY user_id % 8 ORDER BY event_id) AS n FROM events) GROUP BY worker")
def worker_commits(spark: SparkSession, sf: str) -> DataFrame:
    return progress.commits(table(spark, sf, "events").select((F.col("user_id") % 8).alias("worker"), "event_id"), "worker", "event_id", 100)


@registered("SELECT (floor(epoch(ts))::BIGINT // 3600) * 3600 AS start, count(*) AS n, count(*) / 3600 AS per_second FROM events GROUP BY 1")
def load_throughput(spark: SparkSession, sf: str) -> DataFrame:
    return progress.throughput(table(spark, sf, "events"), S.seconds(F.col("ts")), 3600)


@registered("SELECT max(t) AS t, arg_max(i, (t, i)) AS i, '@tick' AS op FROM (SELECT floor(epoch(ts))::BIGINT AS t, event_id AS i FROM events)")
def heartbeat_tick(spark: SparkSession, sf: str) -> DataFrame:
    return logs.heartbeats(table(spark, sf, "events").select(S.seconds(F.col("ts")).alias("t"), F.col("event_id").alias("i")))


@registered("WITH e AS (SELECT floor(epoch(ts))::BIGINT AS t, event_id AS i FROM events), m AS (SELECT ((min(t) + max(t)) // 2)::BIGINT AS mid FROM e) SELECT t, i FROM e, m WHERE t > mid OR (t = mid AND i >= 5)")
def resume_from_time(spark: SparkSession, sf: str) -> DataFrame:
    """The log from a logical time on; the log reaches back to it."""
    e = table(spark, sf, "events").select(S.seconds(F.col("ts")).alias("t"), F.col("event_id").alias("i"))
    ends = e.agg(F.min("t").alias("a"), F.max("t").alias("z")).first()
    return logs.from_start(e, (ends.a + ends.z) // 2, 5)


@registered("SELECT floor(epoch(ts))::BIGINT || '.' || event_id AS at, event_type AS op, 'db' || (user_id % 4) || '.' || 'c' AS ns, user_id::VARCHAR AS key FROM events WHERE user_id % 4 <> 2")
def watch_log(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    log = e.select(S.seconds(F.col("ts")).alias("t"), F.col("event_id").alias("i"), F.col("event_type").alias("op"), F.concat(F.lit("db"), (F.col("user_id") % 4).cast("string")).alias("db"), F.lit("c").alias("coll"), F.col("user_id").cast("string").alias("document_key"))
    return logs.watch(log, ("db2",))


@registered("""SELECT user_id, key, event_id FROM (SELECT user_id, '{"k":' || (event_id % 3) || ',"_id":' || user_id || '}' AS key, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1""")
def newest_of_identity(spark: SparkSession, sf: str) -> DataFrame:
    """Keys of one _id under several shard keys: the one touched last stays."""
    key = F.concat(F.lit('{"k":'), (F.col("event_id") % 3).cast("string"), F.lit(',"_id":'), F.col("user_id").cast("string"), F.lit("}"))
    at = {"t": F.unix_micros(F.col("ts").cast("timestamp")), "i": F.lit(0).cast("bigint"), "seq": F.col("event_id")}
    log = table(spark, sf, "events").withColumns({"cid": F.lit(1).cast("bigint"), "key": key, **at})
    last = log.groupBy("cid", "key").agg(F.max_by("event_id", F.struct("t", "i", "seq")).alias("event_id"), F.first("user_id").alias("user_id"))
    return _newest(last.withColumn("born", F.lit(None).cast("struct<t:bigint,i:bigint,seq:bigint>")), log).select("user_id", "key", "event_id")


@registered("""WITH RECURSIVE o AS (SELECT source AS g, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS i, n_chars AS s FROM documents),
r AS (SELECT g, i, s AS total, 1 AS cnt, 0::BIGINT AS batch, s FROM o WHERE i = 1
  UNION ALL SELECT o.g, o.i, CASE WHEN r.total + o.s > 60000 OR r.cnt >= 25 THEN o.s ELSE r.total + o.s END, CASE WHEN r.total + o.s > 60000 OR r.cnt >= 25 THEN 1 ELSE r.cnt + 1 END,
    CASE WHEN r.total + o.s > 60000 OR r.cnt >= 25 THEN r.batch + 1 ELSE r.batch END, o.s FROM r JOIN o ON o.g = r.g AND o.i = r.i + 1)
SELECT g AS source, batch, count(*) AS n, sum(s)::BIGINT AS size FROM r GROUP BY g, batch""")
def read_batches(spark: SparkSession, sf: str) -> DataFrame:
    """A collection's documents in the batches that a reader cuts: by bytes or number, one document at least."""
    rows = table(spark, sf, "documents").select("source", "doc_id", "n_chars")
    return segments.greedy_batches(rows, "source", "doc_id", "n_chars", 60_000, 25).groupBy("source", "batch").agg(F.count("*").alias("n"), F.sum("n_chars").alias("size"))


@registered("SELECT (rn // 300)::BIGINT AS segment, count(*) AS n, min(k) AS lo, max(k) AS hi FROM (SELECT p_name || ' ' || p_partkey AS k, row_number() OVER (ORDER BY p_name || ' ' || p_partkey) - 1 AS rn FROM part) GROUP BY 1")
def segments_string(spark: SparkSession, sf: str) -> DataFrame:
    return segments.segments(table(spark, sf, "part").select(F.concat_ws(" ", "p_name", F.col("p_partkey").cast("string")).alias("k")), "k", 300)


_MIXED = "SELECT 'int' AS kind, lpad(c_custkey::VARCHAR, 12, '0') AS k FROM customer UNION ALL SELECT DISTINCT 'string', p_name FROM part UNION ALL SELECT DISTINCT 'date', strftime(o_orderdate, '%Y-%m-%d') FROM orders"


def _mixed(spark: SparkSession, sf: str) -> DataFrame:
    def keys(kind: str, name: str, key: Column) -> DataFrame:
        return table(spark, sf, name).select(F.lit(kind).alias("kind"), key.alias("k")).distinct()

    ints = keys("int", "customer", F.lpad(F.col("c_custkey").cast("string"), 12, "0"))
    return ints.union(keys("string", "part", F.col("p_name"))).union(keys("date", "orders", F.date_format("o_orderdate", "yyyy-MM-dd")))


@registered(f"SELECT kind, (rn // 300)::BIGINT AS segment, count(*) AS n, min(k) AS lo, max(k) AS hi FROM (SELECT kind, k, row_number() OVER (PARTITION BY kind ORDER BY k) - 1 AS rn FROM ({_MIXED})) GROUP BY 1, 2")
def segments_mixed(spark: SparkSession, sf: str) -> DataFrame:
    """Keys of several types: every type has segments of its own."""
    return segments.segments(_mixed(spark, sf), "k", 300, "kind")


@registered(f"SELECT kind, k, (row_number() OVER (PARTITION BY kind ORDER BY k) - 1) // 300 AS segment FROM ({_MIXED})")
def segment_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Every key in the segment that reads it, once."""
    rows = _mixed(spark, sf)
    return segments.segment_of(rows, segments.segments(rows, "k", 300, "kind"), "k", "kind")


@registered("SELECT (rn // 2000)::BIGINT AS segment, count(*) AS n, min(k) AS lo, max(k) AS hi FROM (SELECT k, row_number() OVER (ORDER BY k) - 1 AS rn FROM (SELECT CASE WHEN o_orderkey % 7 = 0 THEN 'NaN'::DOUBLE ELSE o_orderkey + 0.5 END AS k FROM orders)) GROUP BY 1")
def segments_nan(spark: SparkSession, sf: str) -> DataFrame:
    """NaN keys are read like others, in the last segments."""
    key = F.when(F.col("o_orderkey") % 7 == 0, F.lit(float("nan"))).otherwise(F.col("o_orderkey") + F.lit(0.5))
    return segments.segments(table(spark, sf, "orders").select(key.cast("double").alias("k")), "k", 2000)
