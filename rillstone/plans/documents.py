"""Queries of nested documents: compiled and applied deltas, filters, expressions, updates, pipelines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import delta, views
from ..session import table
from ..streaming.replicate import apply_changes
from .registry import registered


@registered("""WITH e AS (SELECT event_id, list_transform(range(user_id % 5), lambda k: 'a.' || k) AS inner_paths, event_id % 2 = 0 AS cut FROM events)
SELECT event_id, array_to_string(CASE WHEN cut AND len(inner_paths) > 0 THEN ['0:truncate:a', '0:unset:z', '0:set:m'] || list_transform(inner_paths, lambda p: '1:set:' || p)
  ELSE list_transform(inner_paths, lambda p: '0:set:' || p) || ['0:set:m', '0:unset:z'] || CASE WHEN cut THEN ['0:truncate:a'] ELSE [] END END, ',') AS steps FROM e""")
def delta_compile(spark: SparkSession, sf: str) -> DataFrame:
    """Changes compiled to steps: writes into arrays that the same change cuts come in a later update."""
    e = table(spark, sf, "events").select("event_id", "user_id")
    inner = F.transform(F.filter(F.sequence(F.lit(0).cast("bigint"), F.col("user_id") % 5), lambda k: k < F.col("user_id") % 5), lambda k: F.struct(F.concat(F.lit("a."), k.cast("string")).alias("path"), F.lit("1").alias("value")))
    sets = F.concat(inner, F.array(F.struct(F.lit("m").alias("path"), F.lit("2").alias("value"))))
    cuts = F.when(F.col("event_id") % 2 == 0, F.array(F.struct(F.lit("a").alias("field"), F.lit(3).alias("new_size")))).otherwise(F.array().cast("array<struct<field:string,new_size:int>>"))
    rows = e.select("event_id", sets.alias("u"), F.array(F.lit("z")).alias("r"), cuts.alias("t"))
    out = delta.with_delta(rows, "u", "r", "t")
    return out.select("event_id", F.array_join(F.transform("steps", lambda s: F.concat_ws(":", s["step"].cast("string"), s["op"], s["path"])), ",").alias("steps"))


@registered("""WITH last AS (SELECT user_id, event_type AS e, CASE WHEN event_type = 'click' THEN event_id % 4 ELSE 0 END AS slot, arg_max(event_id, (ts, event_id)) AS id, max((ts, event_id)) AS moment FROM events GROUP BY 1, 2, 3),
u AS (SELECT DISTINCT user_id FROM events), c AS (SELECT user_id, slot, id FROM last WHERE e = 'click'),
n AS (SELECT user_id, arg_max(CASE WHEN e = 'view' THEN id END, moment) AS n, arg_max(e, moment) AS e FROM last WHERE e IN ('view', 'error') GROUP BY user_id)
SELECT u.user_id, coalesce(c0.id, 1) AS a0, coalesce(c1.id, 2) AS a1, coalesce(c2.id, 3) AS a2, coalesce(c3.id, 4) AS a3, CASE WHEN p.id IS NULL THEN 6 ELSE 4 END::INT AS n_items, CASE WHEN n.e = 'view' THEN n.n WHEN n.e IS NULL THEN 0 END AS n, s.id AS b
FROM u LEFT JOIN c c0 ON c0.user_id = u.user_id AND c0.slot = 0 LEFT JOIN c c1 ON c1.user_id = u.user_id AND c1.slot = 1 LEFT JOIN c c2 ON c2.user_id = u.user_id AND c2.slot = 2 LEFT JOIN c c3 ON c3.user_id = u.user_id AND c3.slot = 3
LEFT JOIN last p ON p.user_id = u.user_id AND p.e = 'purchase' LEFT JOIN last s ON s.user_id = u.user_id AND s.e = 'signup' LEFT JOIN n ON n.user_id = u.user_id""")
def delta_apply(spark: SparkSession, sf: str) -> DataFrame:
    """All of a key's ordered deltas: elements set, arrays cut, fields set and unset, a field of a missing object set."""
    e = table(spark, sf, "events")
    kind, value = F.col("event_type"), F.col("event_id").cast("string")
    path = F.when(kind == "view", "n").when(kind == "click", F.concat(F.lit("a."), (F.col("event_id") % 4).cast("string"))).when(kind == "signup", "b.c")
    log = e.select(
        F.lit("d").alias("db"), F.lit("c").alias("coll"), F.col("user_id").cast("string").alias("key"), F.unix_micros(F.col("ts").cast("timestamp")).alias("t"), F.lit(0).cast("bigint").alias("i"), F.col("event_id").alias("seq"), F.lit("update").alias("op"),
        F.lit(None).cast("string").alias("full_document"), F.when(path.isNotNull(), F.array(F.struct(path.alias("path"), value.alias("value")))).alias("updated_fields"), F.when(kind == "error", F.array(F.lit("n"))).alias("removed_fields"),
        F.when(kind == "purchase", F.array(F.struct(F.lit("a").alias("field"), F.lit(4).alias("new_size")))).alias("truncated_arrays"),
    )
    target = e.select(F.lit("d").alias("db"), F.lit("c").alias("coll"), F.col("user_id").cast("string").alias("key"), F.lit('{"a":[1,2,3,4,5,6],"n":0}').alias("doc")).distinct()
    doc = F.from_json("doc", "a array<bigint>, n bigint, b struct<c:bigint>")
    out = apply_changes(target, log).select(F.col("key").cast("bigint").alias("user_id"), doc.alias("d"))
    return out.select("user_id", *[F.get("d.a", F.lit(i)).alias(f"a{i}") for i in range(4)], F.size("d.a").alias("n_items"), F.col("d.n").alias("n"), F.col("d.b.c").alias("b"))


@registered("""SELECT vec_id, len(list_filter(embedding, lambda x: x <> embedding[1]))::INT AS n_other, (embedding[3]::DOUBLE + 1)::DOUBLE AS third, embedding[len(embedding)]::DOUBLE AS last_item, list_reverse(embedding)[2]::DOUBLE AS second_last, (len(embedding[1:2] || embedding[4:6]))::INT AS n_parts, list_max(embedding)::DOUBLE AS largest, embedding[1] = list_max(embedding) AS first_is_largest FROM embeddings""")
def expression_arrays(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "embeddings")
    made = {
        "n_other": {"$size": {"$filter": {"input": "$embedding", "as": "x", "cond": {"$ne": ["$$x", {"$arrayElemAt": ["$embedding", 0]}]}}}},
        "third": {"$arrayElemAt": [{"$map": {"input": "$embedding", "as": "x", "in": {"$add": ["$$x", 1.0]}}}, 2]},
        "last_item": {"$arrayElemAt": ["$embedding", -1]}, "second_last": {"$arrayElemAt": [{"$reverseArray": "$embedding"}, 1]},
        "n_parts": {"$size": {"$concatArrays": [{"$slice": ["$embedding", 2]}, {"$slice": ["$embedding", 3, 3]}]}}, "largest": {"$max": "$embedding"},
        "first_is_largest": {"$let": {"vars": {"top": {"$max": "$embedding"}}, "in": {"$eq": [{"$arrayElemAt": ["$embedding", 0]}, "$$top"]}}},
    }
    types = {"n_other": "int", "n_parts": "int", "first_is_largest": "boolean"}
    return rows.select("vec_id", *[views.expression(e).cast(types.get(c, "double")).alias(c) for c, e in made.items()])


@registered("""SELECT o_orderkey, coalesce(CASE WHEN o_orderkey % 3 <> 0 THEN o_custkey END, -1) AS owner, CASE WHEN o_totalprice >= 100000 THEN 'large' ELSE 'small' END AS class, greatest(o_orderkey, o_custkey) - 5 AS more, o_orderstatus AS field,
  CASE WHEN o_orderkey % 2 = 0 THEN 'new' ELSE 'old' END AS merged, 2 AS n_merged FROM orders""")
def expression_fields(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "orders").withColumn("owner", F.when(F.col("o_orderkey") % 3 != 0, F.col("o_custkey"))).withColumn("sub", F.struct("o_orderstatus"))
    state = F.when(F.col("o_orderkey") % 2 == 0, F.create_map(F.lit("state"), F.lit("new"))).otherwise(F.create_map(F.lit("other"), F.lit("x")))
    rows = rows.withColumn("base", F.create_map(F.lit("state"), F.lit("old"), F.lit("other"), F.lit("y"))).withColumn("change", state)
    both = views.expression({"$mergeObjects": ["$base", "$change"]})
    made = {"owner": {"$ifNull": ["$owner", {"$literal": -1}]}, "class": {"$cond": [{"$gte": ["$o_totalprice", 100000.0]}, "large", "small"]}, "more": {"$subtract": [{"$max": ["$o_orderkey", "$o_custkey"]}, 5]}, "field": {"$getField": {"input": "$sub", "field": "o_orderstatus"}}}
    return rows.select("o_orderkey", *[views.expression(e).alias(c) for c, e in made.items()], F.try_element_at(both, F.lit("state")).alias("merged"), F.size(both).alias("n_merged"))


@registered("SELECT event_id FROM events WHERE user_id <> 7 AND event_type NOT IN ('view', 'error') AND regexp_matches(props, '[13]}') AND NOT regexp_matches(event_type, '^p') AND value <= 80 AND (user_id > 10 OR value > 5) AND user_id <> event_id")
def match_predicates(spark: SparkSession, sf: str) -> DataFrame:
    query = {"user_id": {"$ne": 7}, "event_type": {"$nin": ["view", "error"], "$not": {"$regex": "^p"}}, "props": {"$regex": "[13]}"}, "value": {"$lte": 80.0}, "$or": [{"user_id": {"$gt": 10}}, {"value": {"$gt": 5.0}}], "$expr": {"$ne": ["$user_id", "$event_id"]}}
    return table(spark, sf, "events").filter(views.match(query)).select("event_id")


@registered("SELECT vec_id, label + 10 AS label, 1 AS version, len(list_filter(embedding, lambda x: x <> embedding[2] OR x IS NULL))::INT AS n_left, 'x' AS tag FROM (SELECT vec_id, label, list_transform(embedding, lambda x: round(x::DOUBLE)) AS embedding FROM embeddings) WHERE len(embedding) > 1".replace("len(list_filter(embedding, lambda x: x <> embedding[2] OR x IS NULL))", "len(list_filter(embedding, lambda x: x NOT IN (0, 1)))"))
def update_operators(spark: SparkSession, sf: str) -> DataFrame:
    """$inc of a present and a missing field, $pull of values, $set of a field of a struct, $unset."""
    rows = table(spark, sf, "embeddings").withColumn("embedding", F.transform("embedding", lambda x: F.round(x.cast("double"))))
    rows = rows.withColumn("version", F.lit(None).cast("int")).withColumn("meta", F.struct(F.lit("old").alias("tag"), F.lit(1).alias("more")))
    out = views.update(rows, {"$inc": {"label": 10, "version": 1}, "$pull": {"embedding": {"$in": [0.0, 1.0]}}, "$set": {"meta.tag": "x"}})
    out = views.update(out, {"$unset": ["meta.more"]})
    return out.select("vec_id", "label", "version", F.size("embedding").alias("n_left"), F.col("meta.*"))


@registered("SELECT role, count(*) AS n, max(words) AS longest FROM (SELECT role, len(string_split(text, ' ')) AS words FROM conversations) GROUP BY role")
def pipeline_unwind(spark: SparkSession, sf: str) -> DataFrame:
    """Conversations as documents of an array of turns, unwound, promoted and grouped again."""
    turn = F.struct("turn", "role", F.size(F.split("text", " ")).cast("bigint").alias("words"))
    rows = table(spark, sf, "conversations").groupBy("conv_id").agg(F.collect_list(turn).alias("turns"))
    stages = [{"$unwind": "$turns"}, {"$replaceRoot": {"newRoot": "$turns"}}, {"$group": {"_id": "$role", "n": {"$sum": 1}, "longest": {"$max": "$words"}}}]
    return views.run_pipeline(rows, stages).select(F.col("_id").alias("role"), F.col("n").cast("bigint").alias("n"), "longest")


@registered("SELECT event_id, 'long' AS user_type, 'date' AS ts_type, CASE WHEN event_id % 4 = 0 THEN 'null' ELSE 'double' END AS value_type FROM events")
def type_names(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "events").withColumn("v", F.when(F.col("event_id") % 4 != 0, F.col("value")))
    return rows.select("event_id", *[views.expression({"$type": f"${c}"}).alias(n) for c, n in (("user_id", "user_type"), ("ts", "ts_type"), ("v", "value_type"))])


@registered("SELECT vec_id, embedding[1:3][1]::DOUBLE AS first_item, len(embedding[1:3])::INT AS n FROM embeddings")
def array_cut_slice(spark: SparkSession, sf: str) -> DataFrame:
    cut = table(spark, sf, "embeddings").select("vec_id", S.truncated(F.col("embedding"), 3).alias("a"))
    return cut.select("vec_id", F.get("a", F.lit(0)).cast("double").alias("first_item"), F.size("a").alias("n"))
