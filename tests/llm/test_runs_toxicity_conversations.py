"""The operators of periodic runs, toxicity and conversation structure: brute force, SQL, held-out accuracy, edges."""

import hashlib
import itertools
import os
import random
import re
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from rillstone.llm import conversation_repair, periodic_runs, toxicity

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
WORD = re.compile("[^\x20\x09-\x0d]+")


def _rows(frame):
    return sorted(map(repr, frame[sorted(frame.columns)].astype(object).where(frame[sorted(frame.columns)].notna(), None).itertuples(index=False, name=None)))


@pytest.mark.parametrize("module", [periodic_runs, conversation_repair], ids=["periodic_runs", "conversation_repair"])
def test_query_equals_its_sql(spark, module):
    db = duckdb.connect()
    for name in ("documents", "conversations"):
        path = f"{SF}/{name}.parquet"
        db.sql(f"CREATE VIEW {name} AS SELECT * FROM '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    norm = lambda f: f.astype({c: "float64" for c in ("start", "length", "period", "exponent_milli") if c in f})
    assert _rows(norm(module.query(spark, SF).toPandas())) == _rows(norm(db.sql(module.ORACLE).df()))


# Periodic runs.


def _brute_runs(words):
    n, runs = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(6, 4 * q):
                runs.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted(((s, length, q) for (s, length), q in runs.items()), key=lambda r: (r[0], r[2]))


def _texts():
    made = random.Random(4)
    out = [None, "", " \t\n", "a", "a a a a a", "a a a a a a", "a b a b a b a b", "x " + "a b c " * 5 + "a b y", "a " * 30 + "b " * 7, " a  a " * 5]
    for _ in range(60):
        out.append(" ".join(made.choice("ab") for _ in range(made.randrange(1, 60))))
        block = [made.choice("abcd") for _ in range(made.randrange(1, 30))]
        out.append("\n".join([made.choice("xyz")] * made.randrange(3) + block * made.randrange(1, 9) + block[: made.randrange(len(block))] + ["end"] * made.randrange(9)))
    out.append(" ".join(["p q r"] * 1000 + ["s"] * 50))
    return out


@pytest.mark.parametrize("lags", [periodic_runs.LAGS, 3])  # the second deals almost every text out
def test_runs_by_brute_force(spark, lags):
    texts = _texts()
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(7, texts[-1]), (None, texts[7])], "doc_id long, text string")
    docs = docs.select("*", *[F.lit("clash").alias(c) for c in ("runs", "collapsed", "row", "key", "known", "low", "n", "a.b")])
    got = periodic_runs.collapse_runs(docs, lags).select("doc_id", "text", "runs", "collapsed", "`a.b`").collect()
    assert len(got) == len(texts) + 2
    for r in got:
        words = WORD.findall(r.text or "")
        runs = _brute_runs(words)
        gone = {i for s, length, q in runs for i in range(s + q, s + length)}
        assert [tuple(x) for x in r.runs] == runs and r.collapsed == " ".join(w for i, w in enumerate(words) if i not in gone) and r["a.b"] == "clash"
    assert periodic_runs.collapse_runs(docs.limit(0), lags).count() == 0


def test_best_run(spark):
    runs = [[(5, 8, 2), (0, 12, 3), (20, 6, 1)], [(9, 8, 2), (0, 16, 4), (0, 12, 3)], []]
    rows = spark.createDataFrame([(r,) for r in runs], f"runs {periodic_runs.RUNS}").select(periodic_runs.best(F.col("runs")).alias("b"), periodic_runs.listed(F.col("runs")).alias("t")).collect()
    assert [r.b and tuple(r.b) for r in rows] == [(20, 6, 1), (0, 12, 3), None] and rows[0].t == "5,8,2\n0,12,3\n20,6,1\n"


# Toxicity.


def test_windows_cover_every_word_once():
    texts = ["one two  three\tfour " * 30, "", "   ", "x" * 300 + " end", "Ünï códe " * 20]
    w = toxicity.cut_texts(texts)
    raw = w.buf.tobytes()
    for i, t in enumerate(texts):
        parts = [raw[s : s + n] for s, n, u in zip(w.starts, w.lens, w.unit, strict=True) if u == i]
        want = [bytes(b + 32 if 65 <= b <= 90 else b for b in x.encode()) for x in WORD.findall(t)]
        assert [x for p in parts for x in p.split()] == want and all(p[:1] == p[-1:] == b" " for p in parts)


def test_held_out_accuracy(spark):
    """Documents of two kinds that differ by a few words in each hundred."""
    made = random.Random(8)
    common = ["".join(made.choice("abcdefgh") for _ in range(made.randrange(2, 9))) for _ in range(400)]
    bad = ["grumblewort", "snarkle", "vexfiend", "blightspit"]
    docs, marks = [], []
    for i in range(1200):
        toxic = i % 4 == 0
        words = [made.choice(bad) if toxic and made.random() < 0.04 else made.choice(common) for _ in range(made.randrange(60, 300))]
        docs.append((i, " ".join(words)))
        marks.append((i, int(toxic)))
    docs += [(None, "x"), (5000, None), (5001, ""), (3, docs[3][1])]
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumn("score", F.lit("mine"))
    labels = spark.createDataFrame([*marks, (None, 1), (7, None), (6000, 1)], "doc_id long, toxic int")
    model = toxicity.learn(frame, labels, F.col("doc_id") % 3 != 0)
    got = {}
    for r in toxicity.score_documents(frame, model).collect():
        assert 0 <= r.score <= 1 and got.setdefault(r.doc_id, r.score) == r.score
    held = [(got[i], y) for i, y in marks if i % 3 == 0]
    caught = [s >= toxicity.LIMIT for s, y in held if y]
    clean = [s >= toxicity.LIMIT for s, y in held if not y]
    assert sum(caught) > 0.9 * len(caught) and sum(clean) < 0.03 * len(clean)
    assert got[5000] == got[5001] < toxicity.LIMIT
    assert toxicity.score_documents(frame.limit(0), model).count() == 0


def test_few_labels_give_a_score(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "c d")], "doc_id long, text string")
    for labels in ([], [(1, 0)], [(1, 1)]):
        model = toxicity.learn(docs, spark.createDataFrame(labels, "doc_id long, toxic int"), F.lit(True))
        assert all(0 <= r.score <= 1 for r in toxicity.score_documents(docs, model).collect())


def test_query_on_the_test_table(spark):
    got = {r.doc_id: r for r in toxicity.query(spark, SF).collect()}
    ids = [r.doc_id for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect()]
    assert sorted(got) == sorted(ids) and all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) and r.predicted == (r.score >= 0.3) for i, r in got.items())


# Conversations.


def _brute_repair(rows):
    """All edit strings of a short conversation, by cost and then by text."""
    seen, faults = set(), []
    for _, role, text in rows:
        shown = text.rstrip(" \t\n\x0b\f\r")
        faults.append(1 if not shown else 2 if (role, text) in seen else 3 if shown[-1] not in ".!?" else 0)
        seen.add((role, text))
    best = (0, "", []) if not rows else None
    gaps = ["", "I", "II"]
    for kept in itertools.product("DKR", repeat=len(rows)):
        if any(f in (1, 2) and k != "D" for f, k in zip(faults, kept, strict=True)):
            continue
        for inserts in itertools.product(gaps, repeat=len(rows) + 1):
            audit = "".join(g + k for g, k in zip(inserts, [*kept, ""], strict=True))
            cost = sum({"D": 2, "K": 0, "R": 1, "I": 5}[c] for c in audit) + sum(5 for f, k in zip(faults, kept, strict=True) if f == 3 and k != "D")
            if best is not None and (cost, audit) >= best[:2]:
                continue
            n = sum(c != "D" for c in audit)
            roles = ("s" if n % 2 else "") + "ua" * (n // 2)
            if n == 1:
                continue
            out, row, fits = [], iter(rows), True
            for c in audit:
                r = next(row) if c != "I" else None
                if c == "D":
                    continue
                want = roles[len(out)]
                fits &= (r[1][:1] == want) if c == "K" else want in "ua"
                out.append((r[1] if c == "K" else {"u": "user", "a": "assistant", "s": "system"}[want], r[2] if c != "I" else ""))
            if fits:
                best = (cost, audit, out)
    return best


@pytest.mark.parametrize("bits", [conversation_repair.BLOCK_BITS, 0, 1])  # the last two cut conversations into blocks of one and two rows
def test_repair_by_brute_force(spark, monkeypatch, bits):
    monkeypatch.setattr(conversation_repair, "BLOCK_BITS", bits)
    made = random.Random(6)
    rows = []
    for conv in range(40):
        for turn in range(made.randrange(1, 6)):
            rows.append((conv, turn if conv % 7 else None, made.choice(["user", "user", "assistant", "system", "tool", ""]), made.choice(["Yes.", "No!", "cut", " \n", "", f"{conv} {turn}."])))
    rows += [(None, 0, "user", "Hi."), (None, 1, "assistant", "Ho."), (99, None, None, None)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("at", F.lit("clash"))
    done, counts = conversation_repair.repair(frame)
    got = {}
    for r in done.orderBy("at", "part").collect():
        got.setdefault(r.conv_id, []).append((r.edit, r.role, r.text))
    total = {r.key: r for r in counts.collect()}
    assert len(total) == 42
    for conv in {r[0] for r in rows}:
        own = sorted(((-1 if t is None else t, role if role is not None else " ", text if text is not None else " ") for c, t, role, text in rows if c == conv), key=lambda r: (r[0], r[1], hashlib.md5(r[2].encode()).hexdigest()))
        cost, audit, out = _brute_repair(own)
        key = "{}" if conv is None else f'{{"conv_id":{conv}}}'
        assert "".join(e for e, _, _ in got[conv]) == audit and total[key].cost == cost
        assert [(role, text) for e, role, text in got[conv] if e != "D"] == out
        initials = [r[1][:1] for r in own]
        assert total[key].illegal == sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))


def test_a_long_conversation_is_cut(spark, monkeypatch):
    rows = [(1, n, "user" if n % 2 == 0 else "assistant", f"{n}.") for n in range(200)]
    rows[100] = (1, 100, "assistant", "100.")
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    whole = conversation_repair.repair(frame)[0].orderBy("at", "part").collect()
    monkeypatch.setattr(conversation_repair, "BLOCK_BITS", 3)
    parts = conversation_repair.repair(frame)[0].orderBy("at", "part").collect()
    text = lambda found: "".join(r.edit for r in found)
    assert text(whole) == text(parts) == "K" * 100 + "R" + "K" * 99
    assert conversation_repair.repair(frame.limit(0))[0].count() == 0
