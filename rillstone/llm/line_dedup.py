"""Line dedup by a deletion-neighbourhood join.

A line is its words. Two lines are near when they are equal, or when both have LEAST words or more
and one word inserted, deleted or replaced makes them equal. A line with an earlier near line (by
document id, then place) is removed; the earliest stays.

One edit leaves one half of a line as it is. So each line travels to the buckets of its halves, as a
packed string with the other half's words; lines of odd length are halved on both sides of the middle
word, so that lines which differ by a word have a half in common. There all variants of the other half
within the edit bound, itself and each deletion of a word, are emitted as hashed keys; equal variants
are joined by sorting and the edit is verified: the same place deleted in both (a replacement), or the
whole of one and a deletion in the other (an insertion). Of equal variants only the earliest matters,
so no pairs arise.

A task sends each kind of line once, the earliest: those after it in the task are removed at once.
Halves of very many lines are sent on by variant instead of by half, again one of each kind; they are
found in SAMPLE of the documents, and which they are changes no result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import for_python
from .textkernel import Tokens, by_bucket, join_hashes, mix, portions, powers, ranges, spread, squeeze, tokens_of

#: Words from which a line may have one edit.
LEAST = 8
#: Share of documents in which frequent halves are sought; counts there, in a task and of all, from which one is frequent: so many
#: rows of one half a bucket may hold; most of them.
SAMPLE, TOLD, LEAST_HOT, HOT = 8, 4, 64, 500_000
#: Half-lines a bucket holds; lines a task gathers before it sends them on.
BUCKET, FLUSH = 100_000, 100_000
LEFT, RIGHT = np.uint64(0x1F83D9ABFB41BD6B), np.uint64(0x5BE0CD19137E2179)


def _sums(t: Tokens, cuts: np.ndarray) -> np.ndarray:
    """Hash of the words between each two of cuts, of which none are equal; the last runs to the end."""
    lens = np.diff(np.append(cuts, len(t.hashes)))
    within = ranges(np.zeros(len(cuts), np.int64), lens)
    terms = t.hashes[cuts[0] :] * powers(int(lens.max()) + 1)[within]
    return mix(np.add.reduceat(terms, cuts - cuts[0]) + lens.astype(np.uint64))


class _Lines:
    """The lines with words of some texts: document, place, hash, words, and halves of long ones."""

    def __init__(self, buf: np.ndarray, offsets: np.ndarray):
        breaks = np.flatnonzero(buf == 10) + 1
        starts = np.union1d(offsets[:-1], breaks[breaks < len(buf)]).astype(np.int64)
        self.buf = buf
        self.t = t = tokens_of(buf, np.append(starts, len(buf)))
        doc = np.searchsorted(offsets, starts, "right") - 1
        place = np.arange(len(starts)) - np.searchsorted(starts, offsets[doc], "left")
        self.n = np.diff(t.first)
        some = np.flatnonzero(self.n)
        self.doc, self.place, self.first, self.n = doc[some], place[some], t.first[some], self.n[some]
        self.whole = _sums(t, self.first) if len(some) else np.zeros(0, np.uint64)

    def halves(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Line, cut (words in the left half) and hashes of the left and right halves; two cuts for odd lengths."""
        long = np.flatnonzero(self.n >= LEAST)
        odd = long[self.n[long] % 2 == 1]
        line, cut = np.append(long, odd), np.append(self.n[long] // 2, self.n[odd] // 2 + 1)
        keys = []
        for part in (slice(0, len(long)), slice(len(long), None)):
            at, c = self.first[line[part]], cut[part]
            if not len(at):
                keys.append(np.zeros((0, 2), np.uint64))
                continue
            edges = np.stack([at, at + c, at + self.n[line[part]]], 1)
            flat, place = np.unique(edges.ravel(), return_inverse=True)
            inside = flat[flat < len(self.t.hashes)]
            keys.append(_sums(self.t, inside)[place.reshape(-1, 3)[:, :2]])
        both = np.concatenate(keys)
        return line, cut, join_hashes(both[:, 0], np.full(len(both), LEFT)), join_hashes(both[:, 1], np.full(len(both), RIGHT))


def _variants(hashes: np.ndarray, first: np.ndarray, n: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, deleted place (-1: none) and unit of every variant of the units hashes[first:first + n], under their keys."""
    at = ranges(first, n)
    unit = np.repeat(np.arange(len(n)), n)
    begin = np.cumsum(n) - n
    place = np.arange(len(at)) - begin[unit]
    h, p = hashes[at], powers(int(n.max()) + 1 if len(n) else 1)
    kept, moved = np.append(np.uint64(0), np.cumsum(h * p[place])), np.append(np.uint64(0), np.cumsum(h * p[np.maximum(place - 1, 0)]))
    end = begin + n
    whole = kept[end] - kept[begin]
    short = kept[:-1] - kept[begin[unit]] + moved[end[unit]] - moved[1:]
    size = n.astype(np.uint64)
    return (
        np.append(join_hashes(mix(whole + size), key), join_hashes(mix(short + size[unit] - np.uint64(1)), key[unit])),
        np.append(np.full(len(n), -1), place),
        np.append(np.arange(len(n)), unit),
    )


def _later(v: np.ndarray, place: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Of variants: whether an earlier line near theirs has an equal one."""
    if not len(v):
        return np.zeros(0, bool)
    order = np.lexsort((rank, place, v))
    v, place, rank = v[order], place[order], rank[order]
    new = np.append(True, v[1:] != v[:-1])
    new_place = new | np.append(True, place[1:] != place[:-1])
    group, group_place = np.cumsum(new) - 1, np.cumsum(new_place) - 1
    never = np.iinfo(np.int64).max
    starts = np.flatnonzero(new)
    whole = np.where(place[starts] < 0, rank[starts], never)
    deleted = np.minimum.reduceat(np.where(place < 0, never, rank), starts)
    same = rank[new_place]
    least = np.minimum(whole[group], np.where(place < 0, deleted[group], same[group_place]))
    out = np.empty(len(v), bool)
    out[order] = least < rank
    return out


def _ranks(doc: np.ndarray, row: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Place of each (doc, row, place) in their order; equal ones have equal ranks."""
    order = np.lexsort((place, row, doc))
    d, r, p = doc[order], row[order], place[order]
    out = np.empty(len(doc), np.int64)
    out[order] = np.cumsum(np.append(True, (d[1:] != d[:-1]) | (r[1:] != r[:-1]) | (p[1:] != p[:-1]))[: len(d)])
    return out


def _ids(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).fill_null(-(2**63)).to_numpy(zero_copy_only=False).astype(np.int64)


def _frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Halves that are frequent among those of this task, and how many those are (a null key)."""
    held: list[np.ndarray] = []

    def flush() -> pa.RecordBatch:
        keys, counts = np.unique(np.concatenate(held), return_counts=True)
        n = int(counts.sum())
        some = counts >= TOLD
        held.clear()
        return pa.RecordBatch.from_arrays([pa.array([None, *keys[some].view(np.int64).tolist()], pa.int64()), pa.array([n, *counts[some].tolist()], pa.int64())], names=["key", "n"])

    for batch in batches:
        for _, _, buf, offsets in portions(batch.column("text")):
            held += _Lines(buf, offsets).halves()[2:]
            if sum(map(len, held)) > 4_000_000:
                yield flush()
    if sum(map(len, held)):
        yield flush()


def _rows(out: list[tuple[int, bytes]]) -> Iterator[pa.RecordBatch]:
    for i in range(0, len(out), 200):
        yield pa.RecordBatch.from_arrays([pa.array([b for b, _ in out[i : i + 200]], pa.int64()), pa.array([p for _, p in out[i : i + 200]], pa.binary())], names=["bucket", "packed"])


class _Sender:
    def __init__(self, buckets: int, hot: np.ndarray):
        self.buckets, self.hot = np.uint64(buckets), hot
        self.clear()

    def clear(self) -> None:
        self.lines: list[tuple] = []
        self.texts: list[bytes] = []
        self.halves: list[tuple] = []
        self.count = 0

    def add(self, docs: np.ndarray, keys: np.ndarray, buf: np.ndarray, offsets: np.ndarray) -> None:
        x = _Lines(buf, offsets)
        line, cut, left, right = x.halves()
        raw, t = buf.tobytes(), x.t
        a = t.starts[x.first]
        self.texts += [raw[i:j] for i, j in zip(a.tolist(), t.ends[x.first + x.n - 1].tolist(), strict=True)]
        at = x.first[line] + cut
        hot = np.isin(left, self.hot, kind="sort"), np.isin(right, self.hot, kind="sort")
        warm = []
        for some, key, begin, n in ((hot[0], left, at, x.n[line] - cut), (hot[1], right, x.first[line], cut)):
            v, place, unit = _variants(t.hashes, begin[some], n[some], key[some])
            warm.append((v, place, line[some][unit] + self.count))
        self.halves.append((line + self.count, t.ends[at - 1] - a[line], t.starts[at] - a[line], left, right, *hot, warm))
        self.lines.append((docs[x.doc], x.place, keys[x.doc], x.whole, x.n))
        self.count += len(x.n)

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.count:
            return
        docs, place, keys, whole, n = (np.concatenate(c) for c in zip(*self.lines, strict=True))
        rank = _ranks(docs, keys, place)
        order = np.argsort(rank, kind="stable")
        _, first, inverse = np.unique(whole[order], return_index=True, return_inverse=True)
        gone = np.zeros(self.count, bool)
        gone[order] = rank[order] > rank[order][first][inverse]
        sent = np.zeros(self.count, bool)
        sent[order[first]] = True
        out: list[tuple[int, bytes]] = []
        line, left_end, right_start, left, right, hot_l, hot_r = (np.concatenate([h[i] for h in self.halves]) for i in range(7))
        v, at, who = (np.concatenate([w[i] for h in self.halves for w in h[7]]) for i in range(3))
        mine = sent[who]
        v, at, who = v[mine], at[mine], who[mine]
        if len(v):
            late = _later(v, at, rank[who])
            gone[who[late]] = True
            pick = np.lexsort((rank[who], at, v))
            pick = pick[np.append(True, (v[pick][1:] != v[pick][:-1]) | (at[pick][1:] != at[pick][:-1]))]
            v, at, who = v[pick], at[pick].astype(np.int32), who[pick]
            out += [(b, squeeze(b"\1", v[i], at[i], docs[who[i]], place[who[i]], keys[who[i]])) for b, i in by_bucket((v % self.buckets).astype(np.int64))]
        short = np.flatnonzero(sent & (n < LEAST))
        out += [(b, squeeze(b"\2", whole[i], docs[i], place[i], keys[i])) for b, i in ((b, short[k]) for b, k in by_bucket((whole[short] % self.buckets).astype(np.int64)))]
        l_idx, r_idx = np.flatnonzero(sent[line] & ~hot_l), np.flatnonzero(sent[line] & ~hot_r)
        key = np.append(left[l_idx], right[r_idx])
        owner = np.append(line[l_idx], line[r_idx])
        texts = self.texts
        parts = [texts[i][j:] for i, j in zip(line[l_idx].tolist(), right_start[l_idx].tolist(), strict=True)]
        parts += [texts[i][:j] for i, j in zip(line[r_idx].tolist(), left_end[r_idx].tolist(), strict=True)]
        sizes = np.fromiter(map(len, parts), np.int32, len(parts))
        for b, i in by_bucket((key % self.buckets).astype(np.int64)):
            w = owner[i]
            out.append((b, squeeze(b"\0", key[i], docs[w], place[w].astype(np.int32), keys[w], sizes[i], b"".join([parts[k] for k in i]))))
        found = np.flatnonzero(gone)
        out += [(b, squeeze(b"\3", keys[i], place[i])) for b, i in ((b, found[k]) for b, k in by_bucket((keys[found].view(np.uint64) % self.buckets).astype(np.int64)))]
        self.clear()
        yield from _rows(out)


def _send(batches: Iterator[pa.RecordBatch], buckets: int, hot: np.ndarray) -> Iterator[pa.RecordBatch]:
    sender = _Sender(buckets, hot)
    for batch in batches:
        docs, keys = _ids(batch, "doc_id"), _ids(batch, "row_key")
        for a, b, buf, offsets in portions(batch.column("text")):
            if len(buf):
                sender.add(docs[a:b], keys[a:b], buf, offsets)
            if sender.count > FLUSH:
                yield from sender.flush()
    yield from sender.flush()


def _join(table: pa.Table) -> pa.Table:
    """row_key and place of the lines of a bucket that have an earlier near line."""
    kinds: dict[bytes, list] = {b"\0": [], b"\1": [], b"\2": [], b"\3": []}
    for packed in table.column("packed").to_pylist():
        kind, *parts = spread(packed)
        kinds[bytes(kind)].append(parts)

    def columns(kind: bytes, *types: type) -> list[np.ndarray]:
        return [np.concatenate([np.frombuffer(p[i], t) for p in kinds[kind]]) for i, t in enumerate(types)]

    out = []
    if kinds[b"\3"]:
        out.append(columns(b"\3", np.int64, np.int64))
    if kinds[b"\2"]:
        whole, doc, place, row = columns(b"\2", np.uint64, np.int64, np.int64, np.int64)
        late = _later(whole, np.full(len(whole), -1), _ranks(doc, row, place))
        out.append([row[late], place[late]])
    if kinds[b"\1"]:
        v, at, doc, place, row = columns(b"\1", np.uint64, np.int32, np.int64, np.int64, np.int64)
        late = _later(v, at, _ranks(doc, row, place))
        out.append([row[late], place[late]])
    if kinds[b"\0"]:
        key, doc, place, row, size, text = columns(b"\0", np.uint64, np.int64, np.int32, np.int64, np.int32, np.uint8)
        size = size.astype(np.int64)
        _, inverse, counts = np.unique(key, return_inverse=True, return_counts=True)
        some = np.flatnonzero(counts[inverse] > 1)
        if len(some):
            begin = np.cumsum(size) - size
            t = tokens_of(text[ranges(begin[some], size[some])], np.append(0, np.cumsum(size[some])))
            v, at, unit = _variants(t.hashes, t.first[:-1], np.diff(t.first), key[some])
            late = np.unique(some[unit[_later(v, at, _ranks(doc[some], row[some], place[some])[unit])]])
            out.append([row[late], place[late].astype(np.int64)])
    merged = [np.concatenate([o[i] for o in out]) for i in range(2)] if out else [np.zeros(0, np.int64)] * 2
    return pa.table({"row_key": pa.array(merged[0]), "place": pa.array(merged[1].astype(np.int64))})


def _drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The text left, its lines and those removed, beside what else rows (rest, text, gone, copy) have."""
    for batch in batches:
        texts, counts, removed = [], [], []
        for text, gone, copy in zip(batch.column("text").to_pylist(), batch.column("gone").to_pylist(), batch.column("copy").to_pylist(), strict=True):
            lines = (text or "").split("\n")
            worded = [bool(x.encode().split()) for x in lines]
            gone = set(gone or ()) if copy == 1 else {i for i, w in enumerate(worded) if w}
            texts.append(text if not gone else "\n".join(x for i, x in enumerate(lines) if i not in gone))
            counts.append(sum(worded))
            removed.append(len(gone))
        yield pa.RecordBatch.from_arrays([batch.column("rest"), pa.array(texts, pa.string()), pa.array(counts, pa.int64()), pa.array(removed, pa.int64())], names=["rest", "text", "n_lines", "n_removed"])


def remove_near_lines(documents: DataFrame) -> DataFrame:
    """documents (doc_id, text and any other columns) with text without later near lines, n_lines, n_removed.

    Lines without words stay and do not count in n_lines. Order is that of doc_id (null first), then
    of a hash of the row, then of lines; of rows of one id and text the first keeps what it has first and
    the others lose all lines with words. A null text stays null and has no lines; an empty table gives an
    empty result; a very long text is worked on by itself. Columns of documents named n_lines or n_removed
    are replaced; other columns may have any name.
    """
    spark = documents.sparkSession
    for_python(spark)
    documents = documents.drop("n_lines", "n_removed")
    docs = documents.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("row_key"))
    told = docs.filter(F.pmod("row_key", F.lit(SAMPLE)) == 0).select("text").mapInArrow(_frequent, "key long, n long")
    told = told.groupBy("key").agg(F.sum("n").alias("n")).filter(f"key IS NULL OR n >= {LEAST_HOT}")
    top = told.orderBy(F.col("key").isNotNull(), F.col("n").desc(), "key").limit(HOT + 1).toArrow()  # of bounded size
    known = top.column("key").is_valid().to_numpy()
    buckets = max(12, -(-int(top.column("n").to_numpy()[~known].sum()) * SAMPLE // BUCKET))
    hot = top.column("key").fill_null(0).to_numpy()[known].view(np.uint64)
    shared = spark.sparkContext.broadcast(hot)
    sent = docs.mapInArrow(lambda it: _send(it, buckets, shared.value), "bucket long, packed binary")
    found = sent.groupBy("bucket").applyInArrow(lambda t: _join(t), "row_key long, place long")
    gone = found.groupBy("row_key").agg(F.collect_set("place").alias("gone"))
    rest = [c for c in documents.columns if c != "text"]
    whole = documents.select(F.struct(*[F.col(f"`{c}`") for c in rest]).alias("rest"), "text", F.xxhash64("doc_id", "text").alias("row_key"))
    copy = F.row_number().over(Window.partitionBy("row_key").orderBy("row_key"))
    whole = whole.withColumn("copy", copy).join(gone, "row_key", "left")
    schema = whole.select("rest", "text").withColumns({"n_lines": F.lit(0).cast("long"), "n_removed": F.lit(0).cast("long")}).schema
    left = whole.select("rest", "text", "gone", "copy").mapInArrow(_drop, schema)
    return left.select("rest.*", "text", "n_lines", "n_removed").select(*[F.col(f"`{c}`") for c in documents.columns], "n_lines", "n_removed")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_lines, n_removed and the text that is left."""
    return remove_near_lines(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


ORACLE = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, text, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT rid, doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS i FROM d),
w AS (SELECT *, list_filter(regexp_split_to_array(line, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM l),
o AS (SELECT rid, i, ws, len(ws) AS n, row_number() OVER (ORDER BY doc_id NULLS FIRST, rid, i) AS ord FROM w WHERE len(ws) > 0),
v AS (SELECT ord, 0 AS place, md5(array_to_string(ws, ' ')) AS v FROM o
      UNION ALL SELECT ord, p, md5(array_to_string(ws[:p - 1] || ws[p + 1:], ' ')) FROM (SELECT ord, ws, unnest(range(1, n + 1)) AS p FROM o WHERE n >= {LEAST})),
lens AS (SELECT ord, n FROM o),
m AS (SELECT v.*, min(CASE WHEN place = 0 THEN ord END) OVER g AS whole, min(CASE WHEN place = 0 AND n >= {LEAST} THEN ord END) OVER g AS long_whole, min(CASE WHEN place > 0 THEN ord END) OVER g AS deleted, min(ord) OVER (PARTITION BY v, place) AS same, n
      FROM v JOIN lens USING (ord) WINDOW g AS (PARTITION BY v)),
gone AS (SELECT DISTINCT ord FROM m WHERE (place = 0 AND (whole < ord OR (n >= {LEAST} AND deleted < ord))) OR (place > 0 AND (long_whole < ord OR same < ord))),
per AS (SELECT rid, count(*) AS n_lines, count(gone.ord) AS n_removed FROM o LEFT JOIN gone USING (ord) GROUP BY rid),
txt AS (SELECT rid, string_agg(line, chr(10) ORDER BY i) AS body FROM l LEFT JOIN o USING (rid, i) WHERE o.ord IS NULL OR o.ord NOT IN (SELECT ord FROM gone) GROUP BY rid)
SELECT doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_removed, 0)::BIGINT AS n_removed, CASE WHEN text IS NULL THEN NULL ELSE coalesce(body, '') END AS text
FROM d LEFT JOIN per USING (rid) LEFT JOIN txt USING (rid)
"""
