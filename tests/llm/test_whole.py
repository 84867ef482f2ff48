"""Cases in which a part of the job was once left out."""

import numpy as np

from rillstone.llm import quality_rules


def test_copies_of_junk_below_half_of_a_group(spark):
    rng = np.random.default_rng(11)
    words = lambda n: " ".join("".join(rng.choice(list("abcdefghij"), rng.integers(2, 9))) for _ in range(n))
    clean = [(i, words(int(rng.integers(40, 200))), "en", "a") for i in range(600)]
    junk = " ".join(f"a{chr(98 + i // 10)}{chr(98 + i % 10)}c##" for i in range(40))
    spread = [" ".join(w + "##" for w in words(60).split()) for _ in range(170)]
    docs = clean + [(1000 + i, junk, "en", "a") for i in range(400)]
    docs += [(i + 5000, t, "en", "b") for i, t, _, _ in clean[:330]] + [(9000 + i, t, "en", "b") for i, t in enumerate(spread)]
    got = {r.doc_id: (r.base_failed, r.kept) for r in quality_rules.judge(spark.createDataFrame(docs, "doc_id long, text string, lang string, source string")).collect()}
    assert all(got[i] == (False, i % 5000 < 1000 and i < 9000) for i in got)


def test_pipeline_links_near_copies_of_five_words(spark):
    import corpus_pipeline

    base = [f"w{i}" for i in range(100)]
    edited = [*base[:40], *[f"x{i}" for i in range(7)], *base[47:]]  # 5-word Jaccard 85 of 107, below 80%
    nearer = [*base[:40], *[f"y{i}" for i in range(6)], *base[46:]]  # 86 of 106: above 80%, and below 85% for 4 words
    docs = spark.createDataFrame([(1, " ".join(base)), (2, " ".join(nearer)), (3, " ".join(edited))], "doc_id long, text string")
    kept = dict(corpus_pipeline.STAGES)["n-gram Jaccard join"](spark, docs, "")
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3]


def test_every_token_is_learnt_once():
    from rillstone.llm import recurrent_lm

    rng = np.random.default_rng(12)
    for lens in ([3], [1, 700, 2, 90, 33], rng.integers(1, 60, 400).tolist()):
        ids = np.concatenate([np.append(rng.integers(1, 40, n - 1), recurrent_lm.END) for n in lens]).astype(np.int32)
        trainer = recurrent_lm.Trainer(recurrent_lm.Model(np.arange(40, 0, -1), np.full(recurrent_lm.SHAPES, 9), hidden=4))
        seen = []
        window = trainer.model.window
        trainer.model.window = lambda laid, h, real=None: (seen.append(laid[real] if real is not None else laid.ravel()), window(laid, h, real))[1]
        trainer.feed(ids, np.append(0, np.cumsum(lens)))
        assert trainer.tokens == len(ids) and sorted(np.concatenate(seen).tolist()) == sorted(ids.tolist())


def test_a_small_group_of_junk_is_judged_by_its_language(spark):
    rng = np.random.default_rng(13)
    words = lambda n: " ".join("".join(rng.choice(list("abcdefghij"), rng.integers(2, 9))) for _ in range(n))
    docs = [(i, words(80), "en", "a") for i in range(400)] + [(1000 + i, " ".join(w + "###" for w in words(60).split()), "en", "b") for i in range(4)] + [(2000 + i, words(80), "en", "c") for i in range(3)]
    got = {r.doc_id: r.kept for r in quality_rules.judge(spark.createDataFrame(docs, "doc_id long, text string, lang string, source string")).collect()}
    assert all(got[i] == (i < 1000 or i >= 2000) for i in got)
