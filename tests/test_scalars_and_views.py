import pytest
from pyspark.sql import functions as F

from rillstone.functions import scalars as S
from rillstone.functions.errors import CommandError
from rillstone.operators import progress, segments, verify, views
from rillstone.operators.catalog import Catalog
from rillstone.sources import logs


def _one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_hash_and_route(spark):
    assert _one(spark, S.fnv1a(F.lit("a"))) == 3826002220
    assert _one(spark, S.fnv1a(F.lit(""))) == 2166136261


@pytest.mark.parametrize("ts, want", [((5, 3), (5, 2)), ((5, 0), (4, 2**32 - 1)), ((0, 0), (0, 0))])
def test_predecessor(spark, ts, want):
    assert tuple(_one(spark, S.predecessor(S.logical_time(*map(F.lit, ts))))) == want


def test_checkpoint_stays_before_a_worker_that_failed(spark):
    w = spark.createDataFrame([(7, (58, 0), None), (8, (61, 3), (61, 3)), (9, None, None)], "worker int, routed struct<t:long,i:long>, committed struct<t:long,i:long>")
    assert tuple(progress.checkpoint(w).first().checkpoint) == (57, 2**32 - 1)
    assert progress.idle(w).first().idle is False
    assert progress.idle(w.filter("worker > 7")).first().idle is True


def test_slices(spark):
    a = F.array(*map(F.lit, (11, 22, 33, 44)))
    assert _one(spark, S.sliced(a, -9)) == [11, 22, 33, 44]
    assert _one(spark, S.sliced(a, -3)) == [22, 33, 44]
    assert _one(spark, S.sliced(a, 2, 1)) == [33]
    assert _one(spark, S.truncated(a, 0)) == []
    assert _one(spark, S.pulled(a, [11, 33])) == [22, 44]


def test_names_versions_sizes(spark):
    assert tuple(_one(spark, S.split_namespace(F.lit("db.c.d")))) == ("db", "c.d")
    assert _one(spark, S.split_namespace(F.lit("db"))) is None
    assert S.parse_version("6.1.9-3") == (6, 1, 9, 3) and S.compatible("7.0.0", "8.0.1") and not S.compatible("8.0.0", "7.0.1")
    assert S.parse_bytes("730MB") == 730_000_000 and S.parse_bytes("1GiB") == 1 << 30
    with pytest.raises(ValueError):
        S.bounded_size("1KB", 10_000, 20_000)
    with pytest.raises(ValueError):
        logs.source_options({"nope": "1"})
    assert logs.compressors("zstd, none,snappy,zstd") == ["zstd", "snappy"]
    assert _one(spark, S.aligned(F.lit(5001).cast("bigint"))) == 5120 and _one(spark, S.aligned(F.lit(512).cast("bigint"))) == 512


def test_expressions(spark):
    rows = spark.createDataFrame([(1, ["A", "B", "C"], 5.0), (2, ["C"], None)], "id long, a array<string>, v double")
    out = views.update(rows, [{"$set": {"a": {"$filter": {"input": "$a", "as": "x", "cond": {"$ne": ["$$x", "B"]}}}}}, {"$set": {"n": {"$size": "$a"}, "v": {"$ifNull": ["$v", 0.0]}}}])
    assert [(r.id, r.a, r.n, r.v) for r in out.orderBy("id").collect()] == [(1, ["A", "C"], 2, 5.0), (2, ["C"], 1, 0.0)]
    assert [r.id for r in rows.filter(views.match({"$or": [{"v": {"$gte": 5}}, {"id": 7}]})).collect()] == [1]
    assert [r.id for r in rows.filter(views.match({"v": {"$exists": False}})).collect()] == [2]
    assert [r.id for r in rows.filter(views.match({"a": "A"}, dict(rows.dtypes))).collect()] == [1]  # any element
    assert [r.id for r in rows.filter(views.match({"a": {"$gt": "B"}}, dict(rows.dtypes))).collect()] == [1, 2]
    assert [r.id for r in rows.filter(views.match({"a": {"$ne": "B"}}, dict(rows.dtypes))).collect()] == [2]
    got = views.run_pipeline(rows, [{"$unwind": "$a"}, {"$group": {"_id": "$a", "n": {"$sum": 1}}}, {"$match": {"n": {"$gt": 1}}}]).collect()
    assert [(r._id, r.n) for r in got] == [("C", 2)]
    maps = spark.range(1).select(F.create_map(F.lit("k"), F.lit(1), F.lit("l"), F.lit(2)).alias("a"), F.create_map(F.lit("k"), F.lit(3)).alias("b"))
    assert maps.select(views.expression({"$mergeObjects": ["$a", "$b"]}).alias("m")).first().m == {"k": 3, "l": 2}
    assert rows.select(views.expression({"$max": "$a"}).alias("m")).first().m == "C"
    set_ = views.update(rows, [{"$set": {"s.t.u": {"$literal": 4}}}, {"$set": {"s.w": "$id"}}, {"$unset": "s.t"}])
    assert [tuple(r.s) for r in set_.orderBy("id").collect()] == [(1,), (2,)]


def test_versions_and_sizes_of_columns(spark):
    texts = ["8.0.4-12", "6.0.21", "7.0.1-rc0", "x", "1.2"]
    got = [r.v and tuple(r.v) for r in spark.createDataFrame([(t,) for t in texts], "t string").select(S.version_parts(F.col("t")).alias("v")).collect()]
    assert got == [S.parse_version(t) if t[0] in "867" else None for t in texts]
    sizes = ["500MB", "1GiB", "12", " 1.5 kb ", "2t", "MB"]
    got = [r.b for r in spark.createDataFrame([(t,) for t in sizes], "t string").select(S.byte_size(F.col("t")).alias("b")).collect()]
    assert got == [*map(S.parse_bytes, sizes[:-1]), None]


@pytest.mark.parametrize("make", [lambda k: k, lambda k: f"k{k:04d}", lambda k: k + 0.5 if k < 990 else float("nan")])
def test_segments_have_no_gaps(spark, make):
    rows = spark.createDataFrame([(make(i * 7 % 1000),) for i in range(1000)], ["k"])
    found = segments.segments(rows, "k", 128)
    got = found.orderBy("segment").collect()
    assert [r.n for r in got] == [128] * 7 + [104]
    assert all(a.hi < b.lo or b.lo != b.lo for a, b in zip(got, got[1:]))
    assert segments.segment_of(rows, found, "k").groupBy("segment").count().agg(F.max("count"), F.sum("count")).first() == (128, 1000)
    assert segments.segments(rows.limit(0), "k", 128).count() == 0


def test_segments_of_keys_of_several_types(spark):
    rows = spark.createDataFrame([("int", f"{i:03d}") for i in range(10)] + [("string", c) for c in "abcde"], "kind string, k string")
    got = segments.segments(rows, "k", 4, "kind").orderBy("kind", "segment").collect()
    assert [(r.kind, r.segment, r.n, r.lo, r.hi) for r in got] == [("int", 0, 4, "000", "003"), ("int", 1, 4, "004", "007"), ("int", 2, 2, "008", "009"), ("string", 0, 4, "a", "d"), ("string", 1, 1, "e", "e")]


def test_greedy_batches(spark):
    rows = spark.createDataFrame([(1, i, s) for i, s in enumerate([5, 5, 1, 20, 3, 3, 3, 3])], "g long, i long, s long")
    got = [r.batch for r in segments.greedy_batches(rows, "g", "i", "s", 10, 3).orderBy("i").collect()]
    assert got == [0, 0, 1, 2, 3, 3, 3, 4]


def test_differences(spark):
    s = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "k long, v string")
    t = spark.createDataFrame([(1, "a"), (2, "x"), (4, "d")], "k long, v string")
    assert sorted((r.k, r.kind) for r in verify.differences(s, t, "k", "v").collect()) == [(2, "changed"), (3, "missing"), (4, "extra")]
    assert verify.outside(t, s, "k").first().n_outside == 1


def test_views_follow_the_log(spark):
    c = Catalog()
    for name, body in (("top", {"viewOn": "middle", "pipeline": []}), ("middle", {"viewOn": "base", "pipeline": [{"$match": {"x": {"$gt": 1}}}]}), ("base", {})):
        c.apply("create", "d", name, body)
    g = views.ViewGraph(c)
    assert g.order() == [("d", "middle"), ("d", "top")] and g.dependents(("d", "base")) == [("d", "top"), ("d", "middle")] and not g.broken()
    docs = spark.createDataFrame([('{"x":1}',), ('{"x":2,"y":["a"]}',)], "doc string")
    assert [tuple(r) for r in g.read(("d", "top"), lambda ns: views.as_columns(docs)).collect()] == [(2, ["a"])]
    c.apply("modify", "d", "middle", {"viewOn": "base", "pipeline": [{"$match": {"y": "a"}}]})
    assert [r.x for r in g.read(("d", "top"), lambda ns: views.as_columns(docs)).collect()] == [2]
    c.apply("rename", "d", "base", {"db": "d", "coll": "other"})
    assert set(g.broken()) == {("d", "top"), ("d", "middle")} and g.order() == []
    c.apply("modify", "d", "middle", {"viewOn": "top", "pipeline": []})
    with pytest.raises(CommandError, match="circle"):
        g.chain(("d", "top"))
    assert Catalog.from_json(c.to_json()).collections == c.collections


def test_tree_finds_all_differences(spark):
    rows = [(i, f"v{i}") for i in range(3000)]
    other = [(i, v + "x" if i in (5, 77) else v) for i, v in rows if i != 1234] + [(-1, "new")]
    s, t = (spark.createDataFrame(r, "k long, v string") for r in (rows, other))
    got = {(r.k, r.kind) for r in verify.tree_differences(s, t, "k", "v", bits=10, fan=3).collect()}
    assert got == {(5, "changed"), (77, "changed"), (1234, "missing"), (-1, "extra")}
    leaves = verify.differing_leaves(*[verify.leaf_sums(x, ["k"], "v", 10) for x in (s, t)], 10, 3)
    assert 0 < leaves.count() <= 4 and verify.differing_leaves(*[verify.leaf_sums(s, ["k"], "v", 10)] * 2, 10) is None
    assert verify.tree_differences(s, s, "k", "v").count() == 0
