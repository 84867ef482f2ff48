"""Toxicity by compression distance: what does a dictionary of toxic text save over one of ordinary text?

Texts are cut at words into windows of some WINDOW bytes, and each window is compressed twice by zstandard, once
with a dictionary trained on ordinary documents and once with one trained on toxic documents. The second holds the
first's content too, so that what both kinds of text share costs the same in both and the difference of the two
lengths stands for toxic passages. Windows whose difference passes thresholds, which are set by the
differences of ordinary documents' windows, are counted by document, and a logistic curve fitted to labelled
documents turns counts and length into a score.

The models are fitted to a bounded sample of labelled documents (SAMPLE bytes of whole texts of either
kind, chosen by a hash of their ids), two thirds for the dictionaries and one third for thresholds and curve.
Every document is scored over its whole text; a text of any length is worked on window by window.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import for_python, written
from .textkernel import portions, ranges

#: Bytes of a window, at least, where the text has them.
WINDOW = 64
#: Bytes of labelled texts of either kind that the models are fitted to.
SAMPLE = 12 << 20
#: Bytes of the dictionaries' contents; the level of compression and the bytes that a match has at least.
ORDINARY_BYTES, TOXIC_BYTES, LEVEL, MATCH = 16384, 4096, 6, 6
#: Bytes of pieces of text; how many times as frequent in toxic as in ordinary documents one has to be to count as
#: toxic, by how many deviations it has to be above chance, and in how many toxic documents, and what share of them, it stands
#: at least: passages of a few documents that are near copies are not what makes a document toxic.
PIECES, TIMES, SURE, LEAST, LEAST_SHARE = (6, 7, 8), 5.0, 5.0, 5, 0.02
#: The share of the most frequent piece's documents, of those within so many bytes, that a piece needs.
TOP, REACH = 0.6, 8
#: Shares of ordinary windows above each threshold.
SHARES = (0.1, 0.03, 0.01, 0.003, 0.001)
#: Score from which a document counts as toxic.
LIMIT = 0.3
#: The score of every document where none is labelled.
UNKNOWN = 0.1
SPACE = 32


@dataclass
class Windows:
    """Windows of texts: bytes in lower case with one kind of space, starts, lengths, the text each stands in."""

    buf: np.ndarray
    starts: np.ndarray
    lens: np.ndarray
    unit: np.ndarray


def windows(buf: np.ndarray, offsets: np.ndarray, size: int = WINDOW) -> Windows:
    """Windows of the texts that start at offsets of buf; each has the space on either side of its words."""
    n, lens = len(offsets) - 1, np.diff(offsets)
    out = np.full(len(buf) + 2 * n, SPACE, np.uint8)
    first = offsets[:-1] + 2 * np.arange(n)
    out[ranges(first + 1, lens)] = buf
    out[(out >= 65) & (out <= 90)] += np.uint8(32)
    white = (out == SPACE) | ((out - np.uint8(9)) <= 4)
    out[white] = SPACE
    words = np.flatnonzero(white[:-1] & ~white[1:])  # the space before each word
    unit = np.searchsorted(first, words, "right") - 1
    place = (words - first[unit]) // size if n else words
    begins = np.append(True, (np.diff(place) != 0) | (np.diff(unit) != 0)) if len(words) else np.zeros(0, bool)
    starts, unit = words[begins], unit[begins]
    last = np.append(first[1:], len(out))  # where each text ends
    ends = np.minimum(np.append(starts[1:], len(out)), last[unit] - 1) + 1 if len(starts) else starts
    return Windows(out, starts, ends - starts, unit)


@lru_cache(4)
def _compressor(content: bytes, level: int) -> zstandard.ZstdCompressor:
    params = zstandard.ZstdCompressionParameters.from_level(level, min_match=MATCH, write_content_size=False, write_dict_id=False, write_checksum=False, format=zstandard.FORMAT_ZSTD1_MAGICLESS)
    words = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    words.precompute_compress(compression_params=params)
    return zstandard.ZstdCompressor(compression_params=params, dict_data=words)


def lengths(content: bytes, w: Windows, level: int = LEVEL) -> np.ndarray:
    """Compressed length of each window by the dictionary of that content."""
    if not len(w.starts):
        return np.zeros(0, np.int64)
    parts = np.stack([w.starts, w.lens], 1).astype(np.uint64)
    out = _compressor(content, level).multi_compress_to_buffer(zstandard.BufferWithSegments(w.buf.tobytes(), parts.tobytes()), threads=1)
    return np.fromiter(map(len, out), np.int64, len(w.starts))


@dataclass
class Model:
    ordinary: bytes
    toxic: bytes  # ordinary, and then what is trained on toxic text
    thresholds: np.ndarray
    weights: np.ndarray
    lengths: np.ndarray  # the least and the greatest that the curve was fitted to
    level: int = LEVEL

    def differences(self, w: Windows) -> np.ndarray:
        return lengths(self.ordinary, w, self.level) - lengths(self.toxic, w, self.level)

    def scores(self, w: Windows, n: int) -> np.ndarray:
        """Probability that each of n texts is toxic."""
        return 1 / (1 + np.exp(-np.clip(features(self.differences(w), w.unit, n, self.thresholds, self.lengths) @ self.weights, -30, 30)))


def features(saved: np.ndarray, unit: np.ndarray, n: int, thresholds: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """One, length within bounds, and counts of windows above the thresholds, as they are and by length."""
    total = np.bincount(unit, minlength=n).astype(float)
    counts = [np.bincount(unit, saved >= t, n) for t in thresholds]
    return np.stack([np.ones(n), np.clip(np.log1p(total), *lengths), *[np.log1p(c) for c in counts], *[np.sqrt(c / (total + 4)) for c in counts]], 1)


def _codes(b: np.ndarray, size: int) -> np.ndarray:
    """Each stretch of size bytes, eight at most, as a number."""
    n = max(0, len(b) - size + 1)
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out = (out << np.uint64(8)) | b[k : k + n].astype(np.uint64)
    return out


def _pieces(texts: list[np.ndarray], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pieces of texts and the number of texts that have each."""
    return np.unique(np.concatenate([np.zeros(0, np.uint64), *[np.unique(_codes(t, size)) for t in texts]]), return_counts=True)


def _found(values: np.ndarray, keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The count of each value among sorted keys, 0 for others."""
    if not len(keys):
        return np.zeros(len(values))
    at = np.minimum(np.searchsorted(keys, values), len(keys) - 1)
    return np.where(keys[at] == values, counts[at], 0.0)


def toxic_stretches(toxic: list[bytes], ordinary: list[bytes]) -> Counter[bytes]:
    """Of each toxic text its stretches of pieces that are TIMES as frequent there as in ordinary texts, end to end.

    A piece counts only if it is nearly as frequent as the most frequent one that it overlaps: the rest of
    such a piece is what happens to stand next to it.
    """
    bad, good = ([np.frombuffer(t, np.uint8) for t in texts] for texts in (toxic, ordinary))
    counts: list[list[np.ndarray]] = [[] for _ in bad]
    for size in PIECES:
        here, n_here = _pieces(bad, size)
        other = _found(here, *_pieces(good, size))
        share = (n_here + other) / max(len(bad) + len(good), 1)
        expected = share * len(bad)
        sure = n_here - expected >= SURE * np.sqrt(expected * (1 - share) + 0.25)
        own = sure & (n_here >= max(LEAST, LEAST_SHARE * len(bad))) & (n_here / max(len(bad), 1) >= TIMES * (other + 0.5) / max(len(good), 1))
        for t, found in zip(bad, counts, strict=True):
            n = _found(_codes(t, size), here[own], n_here[own])
            found.append(np.pad(n, (0, len(t) - len(n))))
    marks = [np.zeros(len(t) + 1, np.int64) for t in bad]
    for found, mark in zip(counts, marks, strict=True):
        most = np.max(found, 0)
        if most.any():
            top = np.lib.stride_tricks.sliding_window_view(np.pad(most, REACH), 2 * REACH + 1).max(1)
            for size, n in zip(PIECES, found, strict=True):
                at = np.flatnonzero((n > 0) & (n >= TOP * top))
                np.add.at(mark, at, 1)
                np.add.at(mark, at + size, -1)
    out: Counter[bytes] = Counter()
    for t, mark in zip(bad, marks, strict=True):
        edges = np.flatnonzero(np.diff(np.cumsum(np.append(0, mark)) > 0))
        out.update({t[s:e].tobytes() for s, e in zip(edges[::2], edges[1::2], strict=True)})
    return out


def _trained(samples: list[bytes]) -> bytes:
    """Content of a dictionary that zstandard trains on samples; the samples themselves if they are too few."""
    try:
        return zstandard.train_dictionary(ORDINARY_BYTES, samples, k=64, d=8, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"".join(dict.fromkeys(samples))[:ORDINARY_BYTES]


def _content(stretches: Counter[bytes], size: int) -> bytes:
    """The stretches that most texts have, none inside another, the most frequent last, where they cost least."""
    chosen: list[bytes] = []
    for x, n in sorted(stretches.items(), key=lambda p: (-p[1], p[0])):
        if n >= LEAST and not any(x in c for c in chosen):
            if sum(map(len, chosen)) + len(x) > size:
                break
            chosen.append(x)
    return b"".join(reversed(chosen))


def _logistic(x: np.ndarray, y: np.ndarray, each: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weights of a logistic curve, by Newton's steps, each row counting as much as each says; the first feature is constant and free."""
    w, penalty = np.zeros(x.shape[1]), np.full(x.shape[1], ridge)
    penalty[0] = 1e-3
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (each * p * (1 - p))[:, None]).T @ x + np.diag(penalty), x.T @ (each * (y - p)) - penalty * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def cut_texts(texts: list[str], size: int = WINDOW) -> Windows:
    """Windows of a few texts."""
    raw = [t.encode() for t in texts]
    return windows(np.frombuffer(b"".join(raw), np.uint8), np.append(0, np.cumsum([len(r) for r in raw], dtype=np.int64)).astype(np.int64), size)


def fit(texts: list[str], toxic: list[int], fold: list[int], share: float | None = None) -> Model:
    """A model of labelled texts; those of fold 2 set the thresholds and the curve, the others the dictionaries.

    share: that of toxic documents among all, where the texts have another one. Without texts of both kinds
    every score is near the share of toxic ones.
    """
    texts, toxic, fold = list(texts), np.asarray(toxic, int), np.asarray(fold, int)
    w = cut_texts(texts)
    raw = w.buf.tobytes()
    learn = fold != 2
    bounds = np.append(0, np.cumsum([len(t.encode()) + 2 for t in texts], dtype=np.int64))
    whole = lambda which: list(dict.fromkeys(raw[bounds[i] : bounds[i + 1]] for i in np.flatnonzero(which)))  # noqa: E731  equal texts once
    bad, good = whole(learn & (toxic == 1)), whole(learn & (toxic == 0))
    plain = np.flatnonzero((learn & (toxic == 0))[w.unit])
    ordinary = _trained([raw[w.starts[j] : w.starts[j] + w.lens[j]] for j in plain]) or b" "
    stretches = toxic_stretches(bad, good)
    model = Model(ordinary, ordinary + _content(stretches, TOXIC_BYTES), np.zeros(0), np.zeros(2), np.array([0.0, np.inf]))
    saved = model.differences(w)
    rest = saved[(~learn & (toxic == 0))[w.unit]]
    levels = np.quantile(rest, [1 - s for s in SHARES], method="higher") + 1 if len(rest) else np.arange(len(SHARES)) + 1.0
    model.thresholds = np.maximum.accumulate(np.maximum(levels, 1) + np.arange(len(SHARES)) * 1e-9)
    x = features(saved, w.unit, len(texts), model.thresholds, model.lengths)
    use = ~learn if len(set(toxic[~learn])) == 2 else np.ones(len(texts), bool)
    mean = toxic[use].mean() if use.any() else 0.5
    share = mean if share is None else share
    each = np.where(toxic == 1, share / max(mean, 1e-9), (1 - share) / max(1 - mean, 1e-9))
    model.weights = _logistic(x[use], toxic[use], each[use]) if use.any() else np.append(np.log(UNKNOWN / (1 - UNKNOWN)), np.zeros(x.shape[1] - 1))
    model.lengths = np.array([x[use, 1].min(), x[use, 1].max()]) if use.any() else np.zeros(2)
    return model


FITTED = "ordinary binary, toxic binary, thresholds array<double>, weights array<double>, lengths array<double>"


def _fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The model of all rows (text, toxic, share), as one row; the order of rows does not count."""
    rows = sorted((r["h"], r["text"], r["toxic"], r["share"]) for batch in batches for r in batch.to_pylist())
    model = fit([r[1] for r in rows], [r[2] for r in rows], [r[0] % 3 for r in rows], rows[0][3] if rows else None)
    numbers = [pa.array([x.tolist()], pa.list_(pa.float64())) for x in (model.thresholds, model.weights, model.lengths)]
    yield pa.RecordBatch.from_arrays([pa.array([model.ordinary]), pa.array([model.toxic]), *numbers], names=["ordinary", "toxic", "thresholds", "weights", "lengths"])


def chosen(labelled: DataFrame, size: int = SAMPLE) -> DataFrame:
    """id, h and toxic of labelled documents (id, toxic, size), of either kind up to size bytes, in the order of a hash.

    At most size / 64 ids and sizes of either kind come to the driver: texts of fewer bytes than that are rare.
    """
    out = []
    for kind in (0, 1):
        rows = labelled.filter(F.col("toxic") == kind).select(F.pmod(F.xxhash64("id"), F.lit(1 << 40)).alias("h"), "id", "size").orderBy("h", "id").limit(size >> 6)
        running = F.sum("size").over(Window.orderBy("h", "id").rowsBetween(Window.unboundedPreceding, 0))
        out.append(rows.withColumn("upto", running).filter(F.col("upto") <= size).select("id", "h", F.lit(kind).alias("toxic")))
    return out[0].unionByName(out[1])


def learn(docs: DataFrame, labels: DataFrame, train: Column, size: int = SAMPLE) -> Model:
    """The model of docs (doc_id, text) for which train holds and that labels (doc_id, toxic) marks.

    A document of several labels is toxic if one says so; null ids and null labels are left out.
    """
    spark = docs.sparkSession
    for_python(spark)
    marks = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy(F.col("doc_id").alias("id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    rows = docs.filter(train).select(F.col("doc_id").alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    sizes = written(rows.select("id", F.octet_length("text").cast("long").alias("size")).join(marks, "id"), "labelled-sizes")  # no texts
    share = sizes.agg(F.avg("toxic")).first()[0]
    picks = F.broadcast(chosen(sizes, size))  # at most size / 32 ids, size / 1000 and fewer where texts are of usual length
    sample = rows.join(picks, "id").dropDuplicates(["id"]).select("h", "text", "toxic", F.lit(share).cast("double").alias("share")).repartition(1)
    found = sample.mapInArrow(_fitted, FITTED).first()
    if found is None:  # no labelled document
        return fit([], [], [])
    return Model(bytes(found.ordinary), bytes(found.toxic), np.array(found.thresholds), np.array(found.weights), np.array(found.lengths))


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """docs and score, the probability that its text is toxic; a column of that name is replaced.

    A null text is an empty one, which has a score too; repeated rows are scored alike; no row is left out.
    """
    for_python(docs.sparkSession)
    kept = [F.col(f"`{c}`") for c in docs.columns if c != "score"]
    schema = docs.select(*kept).schema.add("score", "double")

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column(batch.num_columns - 1)
            parts = [model.scores(windows(buf, at), len(at) - 1) for _, _, buf, at in portions(text)]
            score = pa.array(np.concatenate([np.zeros(0), *parts]))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], score], names=schema.names)

    return docs.select(*kept, F.coalesce("text", F.lit("")).alias("score")).mapInArrow(scored, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's score by a model of the labelled documents that are not held out."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    model = learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), ~out)
    rows = score_documents(docs.select("doc_id", out.alias("held_out"), "text"), model).drop("text")
    return rows.select("doc_id", "held_out", "score", (F.col("score") >= LIMIT).cast("int").alias("predicted"))
