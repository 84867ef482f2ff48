"""Documents of values of any type: order, filters through arrays, index keys, sizes."""

import json

from pyspark.sql import functions as F

from rillstone.functions.ordering import compared, encoded, encoded_constant
from rillstone.operators import documents
from rillstone.operators.catalog import Index

#: In ascending order; those of one row are equal.
ORDER = [
    [None], [{"$numberDouble": "NaN"}], [{"$numberDouble": "-Infinity"}], [-1e300], [-3, -3.0], [-0.5], [0, 0.0, {"$numberLong": "0"}], [1.5e-30], [1, 1.0], [2.5], [9007199254740992], [9007199254740993], [1e22], [""], ["A"], ["a"], ["é"],
    [{"a": 1}], [[1]], [{"$oid": "5F0000000000000000000000"}], [False], [True], [{"$date": {"$numberLong": "-5"}}], [{"$date": "2020-01-01T00:00:00Z"}, {"$date": {"$numberLong": "1577836800000"}}],
]


def test_order_of_values(spark):
    values = [(n, json.dumps(v)) for n, same in enumerate(ORDER) for v in same]
    got = spark.createDataFrame(values, "n int, d string").select("n", "d", encoded(F.parse_json("d")).alias("e")).collect()
    texts = {}
    for r in got:
        assert r.e == encoded_constant(json.loads(r.d))
        texts.setdefault(r.n, set()).add(r.e)
    assert all(len(t) == 1 for t in texts.values())
    ordered = [min(texts[n]).encode() for n in range(len(ORDER))]
    assert ordered == sorted(ordered) and len(set(ordered)) == len(ordered)


DOCS = ['{"a":[1,2]}', '{"a":[2,3]}', '{"p":[{"r":1,"q":5},{"r":2}]}', '{"a":"A"}', '{"a":["A","B"]}', '{"a":null,"x":5}', '{"x":2.0}', '{"a":[]}']
FILTERS = [
    ({"a": "A"}, {3, 4}), ({"a": 2}, {0, 1}), ({"a": [1, 2]}, {0}), ({"a": {"$gt": 1}}, {0, 1}), ({"a": None}, {2, 5, 6}), ({"a": {"$exists": True}}, {0, 1, 3, 4, 5, 7}), ({"p.r": {"$gte": 2}}, {2}),
    ({"p": {"$elemMatch": {"r": 1, "q": 5}}}, {2}), ({"p": {"$elemMatch": {"r": 2, "q": 5}}}, set()), ({"x": {"$in": [2, 7]}}, {6}), ({"a": {"$ne": 2}}, {2, 3, 4, 5, 6, 7}), ({"a": {"$size": 2}}, {0, 1, 4}),
    ({"a": {"$elemMatch": {"$gt": 2}}}, {1}), ({"a.0": 1}, {0}), ({"$or": [{"x": {"$lt": 3}}, {"a": {"$regex": "^B"}}]}, {4, 6}), ({"a": {"$not": {"$gt": 0}}}, {2, 3, 4, 5, 6, 7}), ({"a": {"$all": [2, 3]}}, {1}), ({"a": {"$type": "string"}}, {3, 4}),
]


def test_filters_through_arrays(spark):
    rows = spark.createDataFrame(list(enumerate(DOCS)), "k int, d string").select("k", F.parse_json("d").alias("v"))
    got = rows.select("k", *[documents.matches(F.col("v"), q).alias(f"q{n}") for n, (q, _) in enumerate(FILTERS)]).collect()
    for n, (q, want) in enumerate(FILTERS):
        assert {r.k for r in got if r[f"q{n}"]} == want, q


def test_unique_indexes_see_every_element(spark):
    rows = lambda *docs: spark.createDataFrame([(str(n), json.dumps(d)) for n, d in enumerate(docs)], "key string, doc string")
    why = lambda docs, *paths, **options: documents.why_violated(rows(*docs), "key", "doc", Index("u", tuple((p, 1) for p in paths), unique=True, options=tuple(options.items())))
    assert why([{"a": [1, 2]}, {"a": [2, 3]}], "a") and not why([{"a": [1, 1]}, {"a": [2, 3]}], "a")
    assert why([{"p": [{"r": 1}, {"r": 2}]}, {"p": [{"r": 2.0}]}], "p.r") and not why([{"p": [{"r": 1}]}, {"p": [{"r": 2}]}], "p.r")
    assert not why([{"p": [{"r": 1, "q": 2}, {"r": 2, "q": 1}]}, {"p": [{"r": 1, "q": 1}]}], "p.r", "p.q")  # of one element
    assert why([{"b": 1}, {"c": 1}], "a") and not why([{"b": 1}, {"c": 1}], "a", sparse=True) and not why([{"a": []}, {"c": 1}], "a")
    few = {"partialFilterExpression": {"x": {"$gt": 3}}}
    assert not why([{"a": 1, "x": 1}, {"a": 1, "x": 5}], "a", **few) and why([{"a": 1, "x": 4}, {"a": 1, "x": 5}], "a", **few)


def test_document_sizes(spark):
    docs = {'{"a":1,"b":"xy","c":[1,{"d":null}],"e":{"f":true}}': 60, "{}": 5, '{"k\\n":"\\u00e9","n":12345678901,"o":{"$oid":"5f0000000000000000000000"}}': 42, '{ "t" : {"$date":"2020-01-01T00:00:00Z"}, "v":1.5 }': 5 + 3 + 8 + 3 + 8}
    docs['{"a":[' + ",".join(["0"] * 12) + "]}"] = 5 + 3 + 5 + 12 * (1 + 2 + 4) + 2
    got = spark.createDataFrame([(d,) for d in docs], "d string").select("d", documents.document_size(F.col("d")).alias("n")).collect()
    assert {r.d: r.n for r in got} == docs


def test_comparisons_are_those_of_the_encoded_texts(spark):
    values = [json.dumps(v) for same in ORDER for v in same] + ["123.45", "-7.25", '{"$numberDecimal":"2.5"}', "1e-19", "12345678901234567890123"]
    wants = [1, 2.5, 0, float("nan"), 1e22, "A", True, {"$oid": "5F0000000000000000000000"}, {"$date": {"$numberLong": "-5"}}, {"a": 1}]
    tests = [(w, op) for w in wants for op in ("$gt", "$lte")] + [(w, "$eq") for w in (2.5, 1)]
    rows = spark.createDataFrame([(v,) for v in values], "d string").select("d", F.parse_json("d").alias("v"))
    got = rows.select("d", *[compared(F.col("v"), op, w).alias(f"t{n}") for n, (w, op) in enumerate(tests)]).collect()
    for r in got:
        e = encoded_constant(json.loads(r.d)).encode()
        for n, (w, op) in enumerate(tests):
            bound = encoded_constant(w).encode()
            want = e[:2] == bound[:2] and {"$gt": e > bound, "$lte": e <= bound, "$eq": e == bound}[op]
            assert r[f"t{n}"] is want, (r.d, op, w)


def test_document_sizes_of_deep_and_extended_values(spark):
    docs = {'{"a":{"$date":{"$numberLong":"5"}},"b":{"$numberLong":"7"},"c":{"$oid":"x"}}': 5 + 11 + 11 + 3 + 5 + 6 + 6, '{"a":1,"a":true,"b":[[],{"k":-2147483649}]}': 5 + 7 + 4 + 3 + 5 + 3 + 5 + 3 + 5 + 3 + 8}
    docs["[" * 300 + "]" * 300] = 5 + 299 * 8
    rows = spark.createDataFrame([*[(d,) for d in docs], (None,)], "d string").select("d", documents.document_size(F.col("d")).alias("n"))
    assert {r.d: r.n for r in rows.collect()} == docs | {None: None}
    # One pass of the parser in a Python worker, not a fold of tokens that is interpreted expression by expression.
    assert "lambdafunction" not in rows._jdf.queryExecution().optimizedPlan().toString()


def test_index_keys_are_computed_once(spark):
    docs = ['{"a":[3,-3,0,"x",[],null]}', '{"a":[]}', "{}", '{"a":{"$numberLong":"3"}}']
    rows = spark.createDataFrame(list(enumerate(docs)), "k int, d string").select("k", F.parse_json("d").alias("v"))
    keys = rows.select("k", documents.index_keys(F.col("v"), ["a"]).alias("keys"))
    want = [[encoded_constant(x) for x in (3, -3, 0, "x", [], None)], [documents.EMPTY], [encoded_constant(None)], [encoded_constant(3)]]
    assert {r.k: [x for (x,) in r["keys"]] for r in keys.collect()} == dict(enumerate(want))
    assert keys._jdf.queryExecution().analyzed().toString().count("array_distinct") == 1


def test_index_violations_of_plain_and_odd_documents(spark):
    odd = ["x", 'q"\\\n', "", 3, 3.0, -3, 0, -0.0, 123456789012345678, 1234567890123456789, 12345678901234567890123, 1e22, True, False, None, {}, {"$numberLong": "3"}, {"$oid": "5F0000000000000000000000"}, [], [3, "x"], [[1]], {"b": 1}]
    docs = [{"a": x} for x in odd] + [{"p": [{"r": x, "q": 1}, {"q": "x"}]} for x in odd] + [{"p": x} for x in odd] + [{"p": [{"r": 3, "q": 1}, 7, [{"r": 5}]]}, {}, {"a": {"b": "x"}}, {"a": [{"b": 1}, {"b": "x"}]}]
    rows = spark.createDataFrame([(n % 70, json.dumps(d)) for n, d in enumerate(docs * 2)], "k int, d string")
    for paths, sparse, partial in ((["a"], False, None), (["a"], True, {"a": {"$exists": True}}), (["p.r", "p.q"], False, {"a": None}), (["p.r", "p.q"], True, None), (["a.b", "p"], False, None), (["p.r", "p.q", "a"], False, None)):
        got = documents.index_violations(rows, "k", "d", paths, sparse, partial)
        v = F.col("v")
        keys = F.when(F.lit(True) if partial is None else documents.matches(v, partial), documents.index_keys(v, paths, sparse))
        want = rows.select("k", F.parse_json("d").alias("v")).select("k", F.explode_outer(keys).alias("keys")).filter("keys IS NOT NULL").groupBy("keys").agg(F.countDistinct("k").alias("n")).filter("n > 1")
        assert {(tuple(r["keys"]), r.n) for r in got.collect()} == {(tuple(r["keys"]), r.n) for r in want.collect()} != set(), paths
        # What the generator works on is computed before it, where it can be compiled.
        assert not [line for line in got._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Generate" in line and "lambdafunction" in line]
