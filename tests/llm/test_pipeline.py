"""Every stage of the pipeline against SQL or brute force on its own input, the smallest table."""

import collections
import os
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from rillstone.llm import line_dedup, mixing, quality_rules

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
WORD = re.compile("[^\x20\x09-\x0d]+")


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Name, input and output of each stage."""
    import corpus_pipeline

    folder = tmp_path_factory.mktemp("stages")
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), {}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(f"{folder}/{i}")
        out[name] = (docs, spark.read.parquet(f"{folder}/{i}"))
        docs = out[name][1]
    return out


def _sql(docs, query):
    db = duckdb.connect()
    db.register("documents", docs.toPandas())
    return db.sql(query).df()


def test_quality(stages):
    docs, out = stages["quality rules"]
    want = _sql(docs, quality_rules.ORACLE)
    assert sorted(r.doc_id for r in out.collect()) == sorted(want[want.kept].doc_id) and out.columns == docs.columns
    assert 0 < out.count() < docs.count()


def test_lines(stages):
    docs, out = stages["line dedup"]
    want = _sql(docs, line_dedup.ORACLE)
    want = want[(want.n_removed == 0) | (want.n_removed < want.n_lines)]
    assert sorted((r.doc_id, r.text) for r in out.collect()) == sorted(zip(want.doc_id, want.text)) and out.columns == docs.columns
    assert all(r.n_chars == len(r.text) for r in out.collect())


def test_near(stages):
    docs, out = stages["n-gram Jaccard join"]
    sets = {}
    for r in docs.collect():
        w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in r.text))
        sets[r.doc_id] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or {tuple(w)}
    label = {i: i for i in sets}
    for _ in range(5):
        for a in sets:
            for b in sets:
                if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    label[a] = label[b] = min(label[a], label[b])
    assert sorted(r.doc_id for r in out.collect()) == sorted(set(label.values())) and out.columns == docs.columns


def test_mixture(stages):
    docs, out = stages["source mixing"]
    uses = collections.Counter(r.doc_id for r in out.collect())
    size = {r.doc_id: (r.source, len(WORD.findall(r.text))) for r in docs.collect()}
    goal = {r.source: r.target for r in mixing.targets(docs.groupBy("source").agg(F.sum(F.size(mixing.words(F.col("text")))).cast("long").alias("source_size"))).collect()}
    taken, most = collections.Counter(), collections.Counter()
    for i, (source, n) in size.items():
        taken[source] += uses[i] * n
        most[source] = max(most[source], n)
    assert out.columns == docs.columns and set(uses.values()) <= {1, 2} and set(uses) <= set(size)
    assert all(abs(taken[s] - t) <= most[s] / 2 + 1 for s, t in goal.items())


def test_packing(stages):
    import public_tokenizers
    from tokenizers import Tokenizer

    docs, out = stages["packing"]
    t = Tokenizer.from_file(str(public_tokenizers.path("word_bpe_49k.json")))
    want = collections.Counter()
    for r in docs.collect():
        want[r.doc_id, len(t.encode(r.text, add_special_tokens=False).ids) + 1] += 1
    got, pieces = collections.Counter(), collections.defaultdict(list)
    for r in out.collect():
        got[r.doc_id, r.doc_tokens] += r.length
        pieces[r.sequence_id].append((r.offset, r.length))
    assert got == {k: n * k[1] for k, n in want.items()}
    assert all(sum(n for _, n in p) <= 4096 and [o for o, _ in sorted(p)] == np.append(0, np.cumsum([n for _, n in sorted(p)]))[:-1].tolist() for p in pieces.values())
    first = docs.first()
    ids = [*t.encode(first.text, add_special_tokens=False).ids, 2]
    own = out.filter(F.col("doc_id") == first.doc_id).collect()
    assert all(r.ids_crc32 == zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes()) for r in own)
