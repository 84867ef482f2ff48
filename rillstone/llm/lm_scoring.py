"""LM scoring: a gated recurrent language model scores whole documents.

Counts of all words of the training documents are exact: documents are gathered in chunks by a hash of
the row, every chunk sends its distinct words with their training counts to the words' buckets, where
they are summed, and gets back the sums. The commonest words are the model's vocabulary, which grows
with the root of the number of distinct words; every other word has the probability of the class of its
shape (see recurrent_lm) times its smoothed share of it.

The model learns all training documents once, in rounds: in each, every task goes on from the last
round's parameters through its part of the round's documents, and the results are averaged by tokens.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import for_python, written
from .recurrent_lm import END, SHAPES, Model, Trainer, document_scores
from .textkernel import Tokens, by_bucket, keep_memory, portions, shapes, spread, squeeze, tokens_of

FOLDS, HELD_OUT = 7, 2
#: The vocabulary's words, beside the end, as a multiple of the root of all distinct words; bytes of text of a chunk; chunks to a bucket of words.
VOCABULARY, CHUNK, CHUNKS = 2.0, 8 << 20, 8
#: Tokens that a task gathers before it learns them.
FEED = 4_000_000
#: Shares of the training documents, in eighths, that the rounds read.
ROUNDS = ((0,), (1, 2), (3, 4, 5, 6, 7))
#: Hash that stands for the end of a text.
END_HASH = np.uint64(0x2545F4914F6CDD1D)

#: Bits of a word's shape by its bytes: beyond ASCII, punctuation, digits and symbols.
KINDS = np.zeros(256, np.uint8)
KINDS[128:] = 1
KINDS[[ord(c) for c in ".,;:!?"]] = 2
KINDS[[i for i in range(33, 127) if not chr(i).isalpha() and chr(i) not in ".,;:!?"]] = 4


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % FOLDS == HELD_OUT


def _words(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes and shapes of the texts' tokens, each text's end among them, and where each text begins."""
    t: Tokens = tokens_of(buf, offsets, lower=True)
    ends = t.first[1:]
    return np.insert(t.hashes, ends, END_HASH), np.insert(shapes(t, KINDS), ends, 0), t.first + np.arange(len(t.first))


def _ask(key: tuple, table: pa.Table, buckets: int) -> pa.Table:
    """Distinct words of a chunk by bucket: hashes, shapes, counts in its training documents."""
    hashes, kinds, train = [], [], []
    flags = table.column("held_out").to_numpy()
    row = 0
    for text in table.column("text").chunks:
        for a, b, buf, offsets in portions(text):
            h, k, first = _words(buf, offsets)
            hashes.append(h)
            kinds.append(k)
            train.append(np.repeat(~flags[row + a : row + b].astype(bool), np.diff(first)))
        row += len(text)
    names, first, inverse = np.unique(np.concatenate(hashes), return_index=True, return_inverse=True)
    counts = np.bincount(inverse, np.concatenate(train), len(names)).astype(np.int32)
    kinds = np.concatenate(kinds)[first]
    out = [(b, squeeze(names[i], kinds[i], counts[i])) for b, i in by_bucket((names % np.uint64(buckets)).astype(np.int64))]
    return pa.table({"chunk": pa.array([key[0].as_py()] * len(out), pa.int64()), "bucket": pa.array([b for b, _ in out], pa.int64()), "packed": pa.array([p for _, p in out], pa.binary())})


def _answer(key: tuple, table: pa.Table, share: float, buckets: int) -> pa.Table:
    """To each chunk the sums of its words' counts; tokens and words by shape (chunk null, n and v); the commonest words (v null)."""
    asked = [[np.frombuffer(x, d) for x, d in zip(spread(p), (np.uint64, np.uint8, np.int32), strict=True)] for p in table.column("packed").to_pylist()]
    names, first, inverse = np.unique(np.concatenate([a[0] for a in asked]), return_index=True, return_inverse=True)
    counts = np.bincount(inverse, np.concatenate([a[2] for a in asked]), len(names)).astype(np.int64)
    kinds = np.concatenate([a[1] for a in asked])[first]
    cuts = np.cumsum([len(a[0]) for a in asked])[:-1]
    packed = [squeeze(c.astype(np.int64)) for c in np.split(counts[inverse], cuts)]
    seen = counts > 0
    n, v = np.bincount(kinds[seen], counts[seen], SHAPES).astype(np.int64), np.bincount(kinds[seen], minlength=SHAPES)
    # Words are dealt out evenly by hash: of the vocabulary a bucket has about one part in buckets.
    most = int(4 * share * np.sqrt(float(seen.sum()) * buckets) / buckets) + 64
    top = np.lexsort((names, -counts))[:most]
    top = top[counts[top] > 0]
    asks = table.column("chunk").to_pylist()
    bucket = key[0].as_py()
    return pa.table({
        "chunk": pa.array([*asks, *[None] * (SHAPES + len(top))], pa.int64()),
        "bucket": pa.array([bucket] * (len(asks) + SHAPES + len(top)), pa.int64()),
        "packed": pa.array([*packed, *[None] * (SHAPES + len(top))], pa.binary()),
        "word": pa.array([*[None] * len(asks), *range(SHAPES), *names[top].view(np.int64).tolist()], pa.int64()),
        "shape": pa.array([*[None] * (len(asks) + SHAPES), *kinds[top].tolist()], pa.int64()),
        "n": pa.array([*[None] * len(asks), *n.tolist(), *counts[top].tolist()], pa.int64()),
        "v": pa.array([*[None] * len(asks), *v.tolist(), *[None] * len(top)], pa.int64()),
    })


class Lexicon:
    """Ids of the vocabulary's words (the end is 0) and the counts that the model and the base score need."""

    def __init__(self, words: np.ndarray, counts: np.ndarray, kinds: np.ndarray, n: np.ndarray, v: np.ndarray):
        self.sorted = np.argsort(words)
        self.words, self.counts = words, counts
        self.total, self.distinct = int(n.sum()), int(v.sum())
        # What is left of each shape beyond the vocabulary, and one for a word never seen.
        own = np.bincount(kinds, counts, SHAPES), np.bincount(kinds[counts > 0], minlength=SHAPES)
        self.rest = n - own[0]
        self.outcomes = self.rest + (v - own[1]) + 1

    def ids(self, hashes: np.ndarray, kinds: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.words, hashes, sorter=self.sorted), len(self.words) - 1)
        own = self.sorted[at]
        return np.where(self.words[own] == hashes, own, len(self.words) + kinds.astype(np.int64))

    def model(self) -> Model:
        return Model(self.counts, self.rest)


def _learn(batches: Iterator[pa.RecordBatch], lexicon: Lexicon, parameters: np.ndarray | None) -> Iterator[pa.RecordBatch]:
    """Parameters after this task's documents, times its tokens."""
    keep_memory()
    model = lexicon.model()
    if parameters is not None:
        model.load(parameters)
    trainer = Trainer(model)
    held: list[np.ndarray] = []
    lens: list[np.ndarray] = []

    def learn() -> None:
        trainer.feed(np.concatenate(held), np.append(0, np.cumsum(np.concatenate(lens))))
        held.clear()
        lens.clear()

    for batch in batches:
        for _, _, buf, offsets in portions(batch.column("text")):
            h, k, first = _words(buf, offsets)
            held.append(lexicon.ids(h, k).astype(np.int32))
            lens.append(np.diff(first))
            if sum(map(len, held)) > FEED:
                learn()
    if held:
        learn()
    if trainer.tokens:
        yield pa.RecordBatch.from_arrays([pa.array([trainer.tokens], pa.int64()), pa.array([(model.vector() * np.float64(trainer.tokens)).tobytes()], pa.binary()), pa.array([trainer.loss])], names=["n", "sums", "loss"])


def _added(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(p, np.float64) for p in table.column("sums").to_pylist())
    return pa.table({"n": [sum(table.column("n").to_pylist())], "sums": pa.array([total.tobytes()], pa.binary()), "loss": [float(sum(table.column("loss").to_pylist()))]})


def train(texts: DataFrame, lexicon: Lexicon) -> Model:
    """The model after all rounds over texts (text, eighth)."""
    parameters = None
    for eighths in ROUNDS:
        learnt = texts.filter(F.col("eighth").isin(*eighths)).select("text").mapInArrow(lambda it, p=parameters: _learn(it, lexicon, p), "n long, sums binary, loss double")
        for groups in (256, 16, 1):  # sums of tasks, then of those: one row comes to the driver
            learnt = learnt.groupBy((F.pmod(F.xxhash64("n", "loss"), F.lit(groups))).alias("g")).applyInArrow(lambda t: _added(t), "n long, sums binary, loss double")
        for r in learnt.collect():
            parameters = np.frombuffer(r.sums, np.float64) / r.n
    model = lexicon.model()
    if parameters is not None:
        model.load(parameters)
    return model


SCHEMA = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _score(key: tuple, docs: pa.Table, answers: pa.Table, lexicon: Lexicon, model: Model) -> pa.Table:
    """Scores of a chunk's documents."""
    keep_memory()
    hashes, kinds, lens = [], [], []
    for text in docs.column("text").chunks:
        for _, _, buf, offsets in portions(text):
            h, k, first = _words(buf, offsets)
            hashes.append(h)
            kinds.append(k)
            lens.append(np.diff(first))
    lens = np.concatenate(lens) if lens else np.zeros(0, np.int64)
    hashes, kinds = (np.concatenate(x) if x else np.zeros(0, np.uint64) for x in (hashes, kinds))
    first = np.append(0, np.cumsum(lens))
    names, inverse = np.unique(hashes, return_inverse=True)
    counts = np.empty(len(names), np.int64)
    found = {b: np.frombuffer(spread(p)[0], np.int64) for b, p in zip(answers.column("bucket").to_pylist(), answers.column("packed").to_pylist(), strict=True)}
    buckets = len_of = answers.column("buckets")[0].as_py() if answers.num_rows else 1
    for b, i in by_bucket((names % np.uint64(len_of)).astype(np.int64)):
        counts[i] = found[b]
    c = counts[inverse]
    base = np.log10(c + 1.0) - np.log10(lexicon.total + (lexicon.distinct + 1))
    own = lexicon.ids(names, np.zeros(len(names), np.uint8))[inverse]
    ids = own + np.where(own == len(lexicon.words), kinds, 0)  # other words have their shapes' ids
    rest = np.where(ids >= len(lexicon.words), np.log(c + 1.0) - np.log(lexicon.outcomes)[kinds.astype(np.int64)], 0.0)
    doc = np.repeat(np.arange(len(lens)), lens)
    per = lambda x: np.bincount(doc, x, len(lens))
    score = (document_scores(model, ids, first) + per(rest)) / np.log(10)
    return pa.table({
        "doc_id": docs.column("doc_id"), "held_out": docs.column("held_out"), "n_tokens": pa.array(lens.astype(np.int64)), "n_known": pa.array(per(c > 0).astype(np.int64)),
        "train_tokens": pa.array(np.full(len(lens), lexicon.total)), "base_score": pa.array(per(base)), "score": pa.array(score),
    })


def score_documents(documents: DataFrame, vocabulary: float = VOCABULARY) -> DataFrame:
    """The columns of SCHEMA for every row of documents (doc_id, text).

    A null text is empty: its end is its only token. A null doc_id counts as the empty text in the
    fold. Repeated rows all count and are all returned; an empty table gives an empty result. Without
    training documents all words are unknown. Chunks are cut by bytes; a very long text is learnt and
    scored whole, with its state carried. Other columns are ignored, whatever their names.
    """
    spark = documents.sparkSession
    for_python(spark)
    size = documents.agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes")).first()
    if not size.n:
        return spark.createDataFrame([], SCHEMA)
    chunks = 1 + (size.bytes or 0) // CHUNK
    buckets = -(-chunks // CHUNKS)
    docs = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), held_out(F.col("doc_id")).alias("held_out"), F.xxhash64("doc_id", "text").alias("row_key"))
    chunked = docs.withColumn("chunk", F.pmod("row_key", F.lit(chunks)))
    asked = chunked.select("chunk", "text", "held_out").groupBy("chunk").applyInArrow(lambda k, t: _ask(k, t, buckets), "chunk long, bucket long, packed binary")
    schema = "chunk long, bucket long, packed binary, word long, shape long, n long, v long"
    answers = written(asked.groupBy("bucket").applyInArrow(lambda k, t: _answer(k, t, vocabulary, buckets), schema), "answers")
    by_shape = {r.word: (r.n, r.v) for r in answers.filter("v IS NOT NULL").groupBy("word").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).collect()}
    end = int(END_HASH.view(np.int64))
    most = max(1, round(vocabulary * sum(v for _, v in by_shape.values()) ** 0.5))
    top = answers.filter("shape IS NOT NULL").orderBy(F.col("word") != end, F.col("n").desc(), "word").limit(most + 1).select("word", "n", "shape").toArrow()  # grows with the root of the distinct words
    w, c, k = (top.column(i).to_numpy().astype(np.int64) for i in range(3))
    if not len(w) or w[0] != end:
        w, c, k = (np.append(x, y[:most]) for x, y in zip((end, 0, 0), (w, c, k), strict=True))
    shape = np.array([by_shape.get(i, (0, 0)) for i in range(SHAPES)], np.int64)
    lexicon = Lexicon(w.view(np.uint64), c, k, shape[:, 0], shape[:, 1])
    model = train(docs.filter("NOT held_out").select("text", F.pmod(F.xxhash64("row_key"), F.lit(8)).alias("eighth")), lexicon)
    shared = spark.sparkContext.broadcast((lexicon, model))
    got = answers.filter("packed IS NOT NULL").select("chunk", "bucket", "packed", F.lit(buckets).alias("buckets"))
    return chunked.select("chunk", "doc_id", "text", "held_out").groupBy("chunk").cogroup(got.groupBy("chunk")).applyInArrow(lambda k, a, b: _score(k, a, b, *shared.value), SCHEMA)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
