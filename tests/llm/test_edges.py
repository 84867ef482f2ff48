"""Nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns."""

import pytest
from pyspark.sql import functions as F

from rillstone.llm import embedding_dedup, jaccard_join, line_dedup, lm_scoring, mixing, packing, pii_surrogates, quality_rules, substring_dedup, url_reputation

LONG = "\n".join(" ".join(f"w{i}x{j}" for j in range(60)) for i in range(200))
TEXT = "one two three four five six seven eight nine ten eleven"
ROWS = [
    (1, TEXT, "en", "a"), (1, TEXT, "en", "a"), (2, TEXT, "en", None), (3, None, None, None), (4, "", "en", "a"), (5, " \n\t ", "fr", "b"),
    (6, LONG, "en", "a"), (None, TEXT + " twelve", "en", "a"), (None, None, None, None), (7, "word", "en", "b"),
]
SCHEMA = "doc_id long, text string, lang string, source string"
EXTRA = ("row_key", "__row_key", "__gone", "__row", "size", "n_words", "n_lines", "bucket", "row", "rest", "copy", "key", "spans", "gone", "name", "notes", "marked", "id", "held_out", "chunk", "host", "g", "x0", "a.b")


def _tokenizer():
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


def _pack(docs):
    from rillstone.llm.common import for_python

    for_python(docs.sparkSession)
    return packing.pack_documents(docs, _tokenizer())


OPERATORS = {
    "lm_scoring": lm_scoring.score_documents, "quality_rules": quality_rules.judge, "mixing": lambda d: mixing.mix(mixing.measured(d)), "packing": _pack,
    "pii": pii_surrogates.replace, "substrings": substring_dedup.remove_repeated, "jaccard": jaccard_join.near_duplicates, "lines": line_dedup.remove_near_lines,
}


@pytest.mark.parametrize("name", OPERATORS)
def test_every_row_has_a_result(spark, name):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    clash = docs.select("*", *[F.lit("clash").alias(c) for c in EXTRA])
    got = OPERATORS[name](clash).toPandas()
    assert len(got) == len(ROWS) or name == "packing" and set(got.doc_id.dropna()) == {1, 2, 3, 4, 5, 6, 7}
    assert OPERATORS[name](spark.createDataFrame([], SCHEMA)).count() == 0


def test_defined_results(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    lines = {(r.doc_id, r.text): (r.n_lines, r.n_removed) for r in line_dedup.remove_near_lines(docs).select("doc_id", "text", "n_lines", "n_removed").collect()}
    assert lines[3, None] == (0, 0) and lines[None, TEXT + " twelve"] == (1, 0)  # the null id comes first
    assert lines[1, ""] == (1, 1) and lines[5, " \n\t "] == (0, 0)
    near = {(r.doc_id, r.n_shingles): r.component_id for r in jaccard_join.near_duplicates(docs).collect()}
    assert near[2, 8] == 1 and near[3, 0] == 3 and near[4, 0] == 4 and near[7, 1] == 7
    kept = {r.doc_id: r.kept for r in quality_rules.judge(docs).filter("doc_id IS NOT NULL").collect()}
    assert not (kept[3] or kept[4] or kept[5] or kept[7]) and kept[1]
    cut = {r.doc_id: (r.n_words, r.n_removed) for r in substring_dedup.remove_repeated(docs).filter("doc_id IN (3, 7)").collect()}
    assert cut == {3: (0, 0), 7: (1, 0)}
    scores = {r.doc_id: r for r in lm_scoring.score_documents(docs).filter("doc_id IS NOT NULL").collect()}
    assert scores[3].n_tokens == scores[4].n_tokens == scores[5].n_tokens == 1 and scores[3].base_score < 0
    mixed = mixing.mix(mixing.measured(docs)).collect()
    assert all(r.taken <= 2 * r.size for r in mixed)


def test_mixture_meets_its_targets(spark):
    rows = [(i, f"s{i % 3}", 10 + i % 7, 1.0) for i in range(3000)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, source string, size long, weight double"))
    again = got.collect()
    per = {}
    for r in again:
        size, target, taken = per.get(r.source_size, (r.source_size, r.target, 0))
        per[r.source_size] = (size, target, taken + r.taken)
    assert all(abs(taken - target) <= 8 for _, target, taken in per.values())
    assert sorted(again) == sorted(got.collect())


def test_targets_are_split_anew(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 1000), (None, 50)], "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(sizes).collect()}
    budget = 1.5 * 2060
    # a is capped at 20 and the null source at 100; b stays below its cap of 2000.
    assert got["a"] == 20 and got[None] == 100 and got["b"] == pytest.approx((budget - 120) * 2 / 3) and got["c"] == pytest.approx((budget - 120) / 3)
    assert sum(got.values()) == pytest.approx(budget)


def test_urls(spark):
    urls = [None, "no scheme", "http://EXAMPLE.net/en/x?y#z", "http://example.net/fr", "http://x.org/fr/", "http://x.org", "https://a.example.com/de/1", "http://net/", "http://net", "http://u:p@bad.test:80/x"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumns({"host": F.lit(1), "path": F.lit(1)})
    outcomes = spark.createDataFrame([(9, 1)] * 60 + [(5, 0)] * 60 + [(None, 1), (3, None)], "page_id long, bad int")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_reputation.judge(pages, outcomes).collect()}
    assert got[0] == got[1] == ("", "", None, "allow")
    assert got[2] == ("example.net", "/en/x", "example.net/en/", "allow")
    assert got[3] == ("example.net", "/fr", "net/", "block")
    assert got[4] == ("x.org", "/fr/", "org/fr/", "allow") and got[5] == ("x.org", "", None, "allow")
    assert got[6][2:] == ("example.com/de/", "block") and got[7][2:] == ("net/", "block") and got[8] == ("net", "", None, "allow")
    assert got[9] == ("u:p@bad.test:80", "/x", None, "block")
    assert len(url_reputation.judge(pages.union(pages), outcomes).filter("page_id = 9").collect()) == 2
    empty = url_reputation.judge(pages.limit(0), outcomes)
    assert empty.count() == 0 and url_reputation.judge(pages, outcomes.limit(0)).filter("verdict = 'block'").count() == 3


def test_parents_of_hosts(spark):
    hosts = ["a.b.example.com", "shop.co.uk", "www.shop.co.uk", "co.uk", "10.0.0.1", "u@x.org:80", "com"]
    got = [tuple(r) for r in spark.createDataFrame([(h,) for h in hosts], "h string").select(*url_reputation.parents(F.col("h"))).collect()]
    assert got == [("example.com", "com"), ("shop.co.uk", "co.uk"), ("shop.co.uk", "co.uk"), ("co.uk", "uk"), ("10.0.0.1", ""), ("x.org", "org"), ("com", "com")]


def test_ties_of_lines(spark):
    line = "one two three four five six seven eight"
    docs = [(1, f"{line}\nmore of the first"), (1, f"{line}\nmore of the second"), (2, "same row\n"), (2, "same row\n"), (None, line + " nine"), (None, "x\n" + line)]
    got = line_dedup.remove_near_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    kept = [x for r in got for x in r.text.split("\n")]
    assert sum(x.startswith("one two") for x in kept) == 1 and kept.count("same row") == 1 and "more of the first" in kept and "more of the second" in kept
    assert sum(r.n_removed for r in got) == 4


def test_vectors_edges(spark):
    clash = [F.lit(1).alias(c) for c in ("rid", "h1", "dim", "list", "n", "component")]
    rows = [(None, [1.0, 0.0]), (None, [1.0, 0.0]), (5, [1.0, 0.01]), (6, [0.0, 1.0])]
    got = embedding_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>").select("*", *clash)).collect()
    assert sorted((r.vec_id or -1, r.n_links, r.component_id, r.kept) for r in got) == [(-1, 2, 5, False), (-1, 2, 5, False), (5, 2, 5, True), (6, 0, 6, True)]


def test_no_vectors(spark):
    schema = "vec_id long, embedding array<float>"
    assert embedding_dedup.near_duplicates(spark.createDataFrame([], schema)).count() == 0
    rows = [(1, None), (2, []), (None, None)]
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embedding_dedup.near_duplicates(spark.createDataFrame(rows, schema)).collect()}
    assert got == {1: (0, 1, True), 2: (0, 2, True), None: (0, None, False)}


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    own = " ".join(f"own{i}" for i in range(40))
    docs = spark.createDataFrame([*ROWS, (8, own, "en", "a")], SCHEMA).withColumn("n_chars", F.length("text").cast("long"))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    assert len(corpus_pipeline.STAGES) == 5
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    # The null id is the first of the near lines.
    assert {r.doc_id for r in rows} == {6, 8, None}
    stage = dict(corpus_pipeline.STAGES)
    kept = stage["n-gram Jaccard join"](spark, docs, "")
    assert kept.columns == docs.columns and sorted((r.doc_id or 0) for r in kept.collect()) == [0, 1, 3, 4, 5, 6, 7, 8]
    clash = docs.select("*", *[F.lit(1).alias(c) for c in ("key", "row", "use", "uses", "__row", "__uses", "group", "n_lines", "n_removed")])
    empty = docs.limit(0)
    for name, f in corpus_pipeline.STAGES:
        assert f(spark, empty, "").count() == 0
        assert name == "packing" or f(spark, clash, "").columns == clash.columns
