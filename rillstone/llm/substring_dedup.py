"""Substring dedup by super-k-mer partitioning.

A window is K consecutive words of a document; its minimiser is the least hash of the M-word runs in
it. Consecutive windows that share a minimiser travel as one packed string, their words once, to the
minimiser's bucket. Equal windows share a minimiser and so meet there, where sorting counts them.

Minimisers that are frequent (those of passages in many documents) would fill their buckets. Those
that tasks find TOLD times or more, and all tasks together LEAST_HOT times, the HOT most frequent at
most, are treated apart: of their windows each task sends one of each kind with its count, and a last pass over
the documents looks up those that were found twice. Which minimisers are so treated changes no result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import for_python, written
from .textkernel import by_bucket, join_hashes, portions, ranges, spread, squeeze, tokens_of, window_hash, window_min

K, M = 35, 4
TOLD, LEAST_HOT, HOT = 16, 500, 500_000
#: Super-k-mers a bucket holds, of which slices are worked on at once; rows of a task's minimisers and windows before they are sent on.
BUCKET, SLICES, FLUSH = 60_000, 4, 200_000
#: Frequent repeated windows (16 bytes each) up to which they are broadcast.
LOOKED_UP = 1_000_000


class _Windows:
    """The windows of some texts: hash, minimiser, document and place of each."""

    def __init__(self, buf: np.ndarray, offsets: np.ndarray, k: int, m: int):
        self.t = t = tokens_of(buf, offsets)
        count = np.maximum(np.diff(t.first) - k + 1, 0)
        self.at = ranges(t.first[:-1], count)  # the word at which each starts
        self.doc = np.repeat(np.arange(len(count)), count)
        least = window_min(window_hash(t.hashes, m), k - m + 1)
        self.minimiser = least[self.at]
        self.k = k

    def hashes(self) -> np.ndarray:
        return join_hashes(window_hash(self.t.hashes, self.k)[self.at], self.minimiser)

    def runs(self) -> tuple[np.ndarray, np.ndarray]:
        """First and last windows of the super-k-mers, as indices of windows."""
        if not len(self.at):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        cut = np.flatnonzero((self.minimiser[1:] != self.minimiser[:-1]) | (self.doc[1:] != self.doc[:-1])) + 1
        return np.append(0, cut), np.append(cut, len(self.at)) - 1


def _frequent(batches: Iterator[pa.RecordBatch], k: int, m: int) -> Iterator[pa.RecordBatch]:
    """Minimisers that are frequent among the super-k-mers of this task, and how many those are (a null key)."""
    held: list[np.ndarray] = []

    def flush() -> pa.RecordBatch:
        keys, counts = np.unique(np.concatenate(held), return_counts=True)
        n = int(counts.sum())
        some = counts >= TOLD
        held.clear()
        return pa.RecordBatch.from_arrays([pa.array([None, *keys[some].view(np.int64).tolist()], pa.int64()), pa.array([n, *counts[some].tolist()], pa.int64())], names=["key", "n"])

    for batch in batches:
        for _, _, buf, offsets in portions(batch.column("text")):
            w = _Windows(buf, offsets, k, m)
            held.append(w.minimiser[w.runs()[0]])
            if sum(map(len, held)) > 4_000_000:
                yield flush()
    if sum(map(len, held)):
        yield flush()


def _send(batches: Iterator[pa.RecordBatch], k: int, m: int, buckets: int, hot: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Packed super-k-mers by the minimiser's bucket, and of frequent minimisers distinct windows with counts."""
    cold: list[list] = [[], [], [], []]
    warm: list[list] = [[], [], []]

    def flush() -> Iterator[pa.RecordBatch]:
        out = []
        if warm[0]:
            keys, first, inverse = np.unique(np.concatenate(warm[0]), return_index=True, return_inverse=True)
            counts = np.bincount(inverse, np.concatenate(warm[2]), len(keys)).astype(np.int64)
            mins = np.concatenate(warm[1])[first]
            warm[0][:], warm[1][:], warm[2][:] = [keys], [mins], [counts]
        if cold[0]:
            mins, docs, at = (np.concatenate(c) for c in cold[:3])
            texts = cold[3]
            for b, idx in by_bucket((mins % np.uint64(buckets)).astype(np.int64)):
                parts = [texts[i] for i in idx]
                out.append((b, squeeze(b"\0", mins[idx], docs[idx], at[idx], np.fromiter(map(len, parts), np.int32, len(parts)), b"".join(parts))))
            for c in cold:
                c.clear()
        for i in range(0, len(out), 200):
            part = out[i : i + 200]
            yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in part], pa.int64()), pa.array([p[1] for p in part], pa.binary())], names=["bucket", "packed"])

    for batch in batches:
        keys = np.asarray(batch.column("row_key").to_numpy(zero_copy_only=False), np.int64)
        for row, _, buf, offsets in portions(batch.column("text")):
            w = _Windows(buf, offsets, k, m)
            start, last = w.runs()
            if len(hot) and len(start):
                is_hot = np.isin(w.minimiser[start], hot, kind="sort")
                pick = ranges(start[is_hot], (last - start + 1)[is_hot])
                if len(pick):
                    found, first, n = np.unique(w.hashes()[pick], return_index=True, return_counts=True)
                    for held, new in zip(warm, (found, w.minimiser[pick][first], n), strict=True):
                        held.append(new)
                start, last = start[~is_hot], last[~is_hot]
            a, b = w.t.starts[w.at[start]].tolist(), w.t.ends[w.at[last] + k - 1].tolist()
            raw = buf.tobytes()
            cold[0].append(w.minimiser[start])
            cold[1].append(keys[row + w.doc[start]])
            cold[2].append((w.at[start] - w.t.first[w.doc[start]]).astype(np.int64))
            cold[3] += [raw[i:j] for i, j in zip(a, b, strict=True)]
        if len(cold[3]) > FLUSH or sum(map(len, warm[0])) > 8 * FLUSH:
            yield from flush()
    yield from flush()
    if warm[0]:
        found, mins, counts = (np.concatenate(x) for x in warm)
        out = [(b, squeeze(b"\1", found[idx], mins[idx], counts[idx].astype(np.int64))) for b, idx in by_bucket((found % np.uint64(buckets)).astype(np.int64))]
        yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in out], pa.int64()), pa.array([p[1] for p in out], pa.binary())], names=["bucket", "packed"])


def _repeated(mins: np.ndarray, docs: np.ndarray, at: np.ndarray, lens: np.ndarray, text: np.ndarray, k: int) -> list[np.ndarray]:
    """row_key, start and stop in words of the spans whose windows stand twice or more in these super-k-mers."""
    t = tokens_of(text, np.append(0, np.cumsum(lens)))
    count = np.diff(t.first) - k + 1
    where, rec = ranges(t.first[:-1], count), np.repeat(np.arange(len(count)), count)
    h = join_hashes(window_hash(t.hashes, k)[where], mins[rec])
    order = np.argsort(h)
    same = h[order[1:]] == h[order[:-1]]
    twice = np.zeros(len(h), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    found = np.flatnonzero(twice)
    if not len(found):
        return [np.zeros(0, np.int64)] * 3
    cut = np.flatnonzero((np.diff(found) != 1) | (np.diff(rec[found]) != 0)) + 1
    first, last = found[np.append(0, cut)], found[np.append(cut, len(found)) - 1]
    base = at[rec[first]] - t.first[rec[first]]
    return [docs[rec[first]], base + where[first], base + where[last] + k]


def _count(key: tuple, table: pa.Table, k: int) -> pa.Table:
    """Spans (row_key, start, stop) of a bucket's repeated windows; of frequent minimisers (window, minimiser, -1)."""
    cold, warm = [], []
    for packed in table.column("packed").to_pylist():
        kind, *parts = spread(packed)
        (warm if kind == b"\1" else cold).append(parts)
    out = []
    if warm:
        found, mins, counts = (np.concatenate([np.frombuffer(p[i], t) for p in warm]) for i, t in enumerate((np.uint64, np.uint64, np.int64)))
        keys, first, inverse = np.unique(found, return_index=True, return_inverse=True)
        some = np.bincount(inverse, counts) >= 2
        out.append([keys[some].view(np.int64), mins[first][some].view(np.int64), np.full(int(some.sum()), -1)])
    for i in range(SLICES if cold else 0):
        held: list[list[np.ndarray]] = [[], [], [], [], []]
        for p in cold:
            mins, docs, at, lens, text = (np.frombuffer(x, t) for x, t in zip(p, (np.uint64, np.int64, np.int64, np.int32, np.uint8), strict=True))
            lens = lens.astype(np.int64)
            mine = np.flatnonzero((mins >> np.uint64(40)) % np.uint64(SLICES) == i)
            begin = np.cumsum(lens) - lens
            for h, x in zip(held, (mins[mine], docs[mine], at[mine], lens[mine], text[ranges(begin[mine], lens[mine])]), strict=True):
                h.append(x)
        if sum(map(len, held[0])):
            out.append(_repeated(*(np.concatenate(h) for h in held), k))
    columns = [np.concatenate([o[i] for o in out]) if out else np.zeros(0, np.int64) for i in range(3)]
    return pa.table({n: pa.array(c.astype(np.int64)) for n, c in zip(("a", "b", "c"), columns, strict=True)})


def _looked_up(batches: Iterator[pa.RecordBatch], k: int, m: int, hot: np.ndarray, known: np.ndarray | None) -> Iterator[pa.RecordBatch]:
    """Windows of frequent minimisers: (row_key, start, window), of those known only if known is given."""
    for batch in batches:
        keys = np.asarray(batch.column("row_key").to_numpy(zero_copy_only=False), np.int64)
        for row, _, buf, offsets in portions(batch.column("text")):
            w = _Windows(buf, offsets, k, m)
            some = np.flatnonzero(np.isin(w.minimiser, hot, kind="sort"))
            h = w.hashes()[some]
            if known is not None:
                keep = np.isin(h, known, kind="sort")
                some, h = some[keep], h[keep]
            at = w.at[some] - w.t.first[w.doc[some]]
            yield pa.RecordBatch.from_arrays([pa.array(keys[row + w.doc[some]]), pa.array(at), pa.array(h.view(np.int64))], names=["row_key", "start", "window"])


def _cut(batches: Iterator[pa.RecordBatch], k: int, m: int, hot: np.ndarray, known: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The words that are left of each document."""
    names = ("doc_id", "n_words", "n_removed", "kept_sha256", "text")
    for batch in batches:
        spans = [[(s["start"], s["stop"]) for s in x or ()] for x in batch.column("spans").to_pylist()]
        if len(known):
            for row, _, buf, offsets in portions(batch.column("text")):
                w = _Windows(buf, offsets, k, m)
                some = np.flatnonzero(np.isin(w.minimiser, hot, kind="sort"))
                some = some[np.isin(w.hashes()[some], known, kind="sort")]
                for d, at in zip(w.doc[some].tolist(), (w.at[some] - w.t.first[w.doc[some]]).tolist(), strict=True):
                    spans[row + d].append((at, at + k))
        rows = []
        for doc_id, text, own in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), spans, strict=True):
            found = (text or "").encode().split()
            left, upto = [], 0
            for a, b in sorted(own):
                if a > upto:
                    left += found[upto:a]
                upto = max(upto, b)
            left += found[upto:]
            body = b" ".join(left)
            rows.append((doc_id, len(found), len(found) - len(left), hashlib.sha256(body).hexdigest(), body.decode()))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()), strict=True)] if rows else [pa.array([], t) for t in (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())], names=list(names))


def remove_repeated(documents: DataFrame, k: int = K, m: int = M, texts: bool = True) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and text (words left, joined by spaces) of every row.

    documents: doc_id, text. Each word in a window of k words whose words also stand together
    anywhere else, here or in another row, is removed. A null text has no words; repeated rows repeat
    each other; texts of fewer than k words stay whole; an empty table gives an empty result; a very long text is
    worked on by itself. Other columns of documents are ignored, whatever their names.
    """
    spark = documents.sparkSession
    for_python(spark)
    docs = documents.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("row_key"))
    told = docs.select("text").mapInArrow(lambda it: _frequent(it, k, m), "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).filter(f"key IS NULL OR n >= {LEAST_HOT}")
    top = told.orderBy(F.col("key").isNotNull(), F.col("n").desc(), "key").limit(HOT + 1).toArrow()  # of bounded size
    valid = top.column("key").is_valid().to_numpy()
    total = int(top.column("n").to_numpy()[~valid].sum())
    hot = top.column("key").fill_null(0).to_numpy()[valid].view(np.uint64)
    buckets = max(12, -(-total // BUCKET))
    sent = docs.select("row_key", "text").mapInArrow(lambda it: _send(it, k, m, buckets, hot), "bucket long, packed binary")
    found = written(sent.groupBy("bucket").applyInArrow(lambda key, t: _count(key, t, k), "a long, b long, c long"), "spans")
    spans = found.filter("c >= 0").select(F.col("a").alias("row_key"), F.struct(F.col("b").alias("start"), F.col("c").alias("stop")).alias("span"))
    windows = found.filter("c < 0").select(F.col("a").alias("window"))
    known = np.zeros(0, np.uint64)
    if len(hot):
        some = windows.limit(LOOKED_UP + 1).count()
        if some <= LOOKED_UP:
            known = windows.toArrow().column("window").to_numpy().view(np.uint64)
        else:
            each = docs.select("row_key", "text").mapInArrow(lambda it: _looked_up(it, k, m, hot, None), "row_key long, start long, window long")
            spans = spans.unionByName(each.join(windows, "window", "left_semi").select("row_key", F.struct("start", (F.col("start") + k).alias("stop")).alias("span")))
    spans = spans.groupBy("row_key").agg(F.collect_list("span").alias("spans"))
    out = "doc_id long, n_words long, n_removed long, kept_sha256 string, text string"
    shared = spark.sparkContext.broadcast((hot, known))
    result = docs.join(spans, "row_key", "left").select("doc_id", "text", "spans").mapInArrow(lambda it: _cut(it, k, m, *shared.value), out)
    return result if texts else result.drop("text")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated(spark.read.parquet(f"{sf_dir}/documents.parquet"), texts=False)


ORACLE = rf"""
WITH w AS (SELECT row_number() OVER () AS rid, doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
win AS (SELECT rid, i, md5(array_to_string(ws[i:i + {K - 1}], ' ')) AS h FROM (SELECT rid, ws, unnest(range(1, len(ws) - {K - 2})) AS i FROM w WHERE len(ws) >= {K})),
dup AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY h) AS c FROM win) WHERE c > 1),
cov AS (SELECT DISTINCT rid, unnest(range(i, i + {K})) AS i FROM dup),
kept AS (SELECT rid, doc_id, len(ws) AS n, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM w),
joined AS (SELECT rid, count(*) AS k, string_agg(word, ' ' ORDER BY i) AS body FROM kept ANTI JOIN cov USING (rid, i) GROUP BY rid)
SELECT doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(k, 0))::BIGINT AS n_removed, sha256(coalesce(body, '')) AS kept_sha256 FROM w LEFT JOIN joined USING (rid)
"""
