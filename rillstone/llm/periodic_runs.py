"""Periodic runs of words, found by comparing a text with itself at every shift.

A run is a stretch of words with smallest period q, at least EXPONENT periods and LEAST words long, that
neither neighbour extends. A text of n words is compared as an array of word hashes with itself shifted by each lag up
to n / EXPONENT; stretches of equal places give the runs of that lag, and the least lag of equal stretches is the
period. Many texts are compared at once, end to end, as hashes hold the text too and so differ between texts.

Texts of up to EXPONENT * LAGS words are worked on whole where they are read. A longer one is dealt
out as ranges of LAGS lags each, over all machines, and the runs of its ranges are put together again; equal texts are
worked on once. What a task does is then at most LAGS comparisons of a text with itself, whatever its length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import attach, for_python, words, written
from .textkernel import Tokens, mix, portions, ranges, tokens_of

#: Periods and words that a run has at least.
EXPONENT, LEAST = 4, 6
#: Lags that one task compares a text with.
LAGS = 4096
#: Words that are compared at once: as many as a processor's cache holds.
TOGETHER = 1 << 15
RUNS = "array<struct<start:int,length:int,period:int>>"
RUN_TYPE = pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32()), ("period", pa.int32())]))


def _stretches(same: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the stretches of true values of a length of at least least."""
    step = max(1, least // 4)  # a stretch holds four neighbouring places of every step-th
    some = same[::step]
    if len(some) < 4:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    two = some[:-1] & some[1:]
    if not (two[:-2] & two[2:]).any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    edges = np.flatnonzero(np.diff(np.concatenate([[False], same, [False]])))
    starts, ends = edges[::2], edges[1::2]
    long = ends - starts >= least
    return starts[long], ends[long]


def scan(h: np.ndarray, first: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of texts whose word hashes stand end to end in h, text k from first[k] on, at lags low[k] to high[k].

    Returns the text of each run and a row (start, length, period) for each, by text, start and period.
    """
    sizes = np.diff(first)
    tops = np.minimum(high, sizes // EXPONENT)
    busy = np.flatnonzero((sizes >= LEAST) & (tops >= low))
    busy = busy[np.lexsort((-sizes[busy], -tops[busy]))]
    found: list[tuple[np.ndarray, ...]] = []
    at = 0
    while at < len(busy):
        total = np.cumsum(sizes[busy[at : at + TOGETHER // LEAST]])
        part = busy[at : at + max(1, int(np.searchsorted(total, TOGETHER, "right")))]
        at += len(part)
        n = sizes[part]
        begins = np.cumsum(n) - n
        own = np.repeat(mix(np.arange(1, len(part) + 1, dtype=np.uint64)), n)
        x = h[ranges(first[part], n)] ^ own
        tail = np.cumsum(n)
        for q in range(int(low[part].min()), int(tops[part[0]]) + 1):
            end = int(tail[int(np.searchsorted(-tops[part], -q, "right")) - 1])  # those that have this lag stand first
            if end <= q:
                continue
            starts, ends = _stretches(x[: end - q] == x[q:end], max(LEAST - q, (EXPONENT - 1) * q))
            if len(starts):
                text = np.searchsorted(begins, starts, "right") - 1
                use = low[part[text]] <= q
                found.append((part[text][use], (starts - begins[text])[use], (ends - starts + q)[use], np.full(int(use.sum()), q)))
    if not found:
        return np.zeros(0, np.int64), np.zeros((0, 3), np.int64)
    text, start, length, period = (np.concatenate(c) for c in zip(*found, strict=True))
    order = np.lexsort((period, length, start, text))
    text, rows = text[order], np.stack([start, length, period], 1)[order]
    new = np.ones(len(text), bool)  # of equal stretches the least period
    new[1:] = (text[1:] != text[:-1]) | (rows[1:, :2] != rows[:-1, :2]).any(1)
    text, rows = text[new], rows[new]
    order = np.lexsort((rows[:, 2], rows[:, 0], text))
    return text[order], rows[order]


def dropped(n: int, runs: np.ndarray) -> np.ndarray:
    """Which of n words stand in a run after its first period."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(change[:-1]) > 0


def _joined(t: Tokens, kept: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The kept words of each text joined by a space: all bytes, and where each text starts and the last ends."""
    starts, lens, unit = t.starts[kept], (t.ends - t.starts)[kept], t.unit()[kept]
    last = np.append(unit[1:] != unit[:-1], True) if len(unit) else np.zeros(0, bool)
    room = lens + ~last
    out = np.full(int(room.sum()), 32, np.uint8)
    out[ranges(np.cumsum(room) - room, lens)] = t.buf[ranges(starts, lens)]
    ends = np.bincount(unit, room, len(t.first) - 1).astype(np.int64) if len(unit) else np.zeros(len(t.first) - 1, np.int64)
    return out, np.append(0, np.cumsum(ends))


def _lists(n: int, text: np.ndarray, rows: np.ndarray) -> pa.Array:
    at = np.searchsorted(text, np.arange(n + 1)).astype(np.int32)
    parts = pa.StructArray.from_arrays([pa.array(rows[:, k].astype(np.int32)) for k in range(3)], names=["start", "length", "period"])
    return pa.ListArray.from_arrays(pa.array(at), parts)


def _lag_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """key, runs of the lags low to high of each text."""
    for batch in batches:
        low, high = (batch.column(c).to_numpy() for c in ("low", "high"))
        for a, b, buf, at in portions(batch.column("text")):
            t = tokens_of(buf, at)
            yield pa.RecordBatch.from_arrays([batch.column("key")[a:b], _lists(b - a, *scan(t.hashes, t.first, low[a:b], high[a:b]))], names=["key", "runs"])


def _collapsed(names: list[str]):
    """A function of batches whose last columns are the text, whether its runs are known, and those."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            *rest, texts, known = batch.columns
            for a, b, buf, at in portions(texts):
                t = tokens_of(buf, at)
                n = b - a
                told = known[a:b]
                low = np.ones(n, np.int64)
                high = np.where(told.is_valid().to_numpy(zero_copy_only=False), 0, np.int64(1) << 40)
                text, rows = scan(t.hashes, t.first, low, high)
                if told.null_count < n:
                    flat = told.flatten()
                    more = np.stack([flat.field(k).to_numpy() for k in range(3)], 1).astype(np.int64) if len(flat) else np.zeros((0, 3), np.int64)
                    text = np.concatenate([text, np.repeat(np.arange(n), told.value_lengths().fill_null(0).to_numpy())])
                    rows = np.concatenate([rows, more])
                    order = np.lexsort((rows[:, 2], rows[:, 0], text))
                    text, rows = text[order], rows[order]
                gone = dropped(len(t.starts), rows + np.stack([t.first[text], 0 * text, 0 * text], 1))
                out, ends = _joined(t, ~gone)
                kept = pa.LargeStringArray.from_buffers(n, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(out)).cast(pa.string())
                yield pa.RecordBatch.from_arrays([*[c[a:b] for c in rest], _lists(n, text, rows), kept], names=names)

    return run


def collapse_runs(docs: DataFrame, lags: int = LAGS) -> DataFrame:
    """docs with runs, those of its text by start and then period, and collapsed: its words joined by a space, each
    run but for its first period left out.

    A null text has no words: no runs, an empty collapsed text. Rows are judged one by one; repeated ones
    come out alike and none is lost. Columns named runs or collapsed are replaced. Words are compared by hashes of 64 bits.
    """
    spark = docs.sparkSession
    for_python(spark)
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in ("runs", "collapsed")]
    text = F.coalesce("text", F.lit(""))
    # A text of fewer bytes than this has too few words for a second range.
    n = F.when(F.octet_length(text) < 2 * EXPONENT * lags, 0).otherwise(F.size(words(text)))
    long = n > EXPONENT * lags
    parts = docs.filter(long).select(F.md5(text).alias("key"), text.alias("text"), n.alias("n"))
    parts = written(parts.dropDuplicates(["key"]), "long-texts")
    row = F.struct(*kept).alias("row")
    if parts.isEmpty():
        rows = docs.select(row, text.alias("text"), F.lit(None).cast(RUNS).alias("known"))
    else:
        low = F.explode(F.sequence(F.lit(1), (F.col("n") / EXPONENT).cast("int"), F.lit(lags))).alias("low")
        dealt = parts.select("key", "text", low).withColumn("high", F.col("low") + (lags - 1)).selectExpr("key", "text", "cast(low AS long) AS low", "cast(high AS long) AS high")
        found = dealt.repartition(F.col("key"), F.col("low")).mapInArrow(_lag_ranges, f"key string, runs {RUNS}")
        # Of equal stretches the least period: struct(start, length) by key, then all runs of a text, fewer than its words.
        one = found.select("key", F.explode("runs").alias("r")).groupBy("key", "r.start", "r.length").agg(F.min("r.period").alias("period"))
        all_ = one.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("start", "length", "period"))).cast(RUNS).alias("known"))
        all_ = written(parts.select("key").join(all_, "key", "left").select("key", F.coalesce("known", F.array().cast(RUNS)).alias("known")), "long-runs")
        both = docs.select(row, text.alias("text"), F.when(long, F.md5(text)).alias("key"))
        rows = attach(both, all_, ["key"], rows=1000).select("row", "text", "known")
    schema = rows.select("row", F.lit(None).cast(RUNS).alias("runs"), F.lit("").alias("collapsed")).schema
    out = rows.mapInArrow(_collapsed(schema.names), schema)
    return out.select("row.*", "runs", "collapsed")


def best(runs: Column) -> Column:
    """The run of the greatest length / period, of those the first, of those the one of least period; null if there is none.

    Quotients of ints below a hundred million are told apart by doubles exactly.
    """
    ranked = F.transform(runs, lambda r: F.struct((r["length"] / r["period"]).alias("exponent"), (-r["start"]).alias("a"), (-r["period"]).alias("b"), r.alias("run")))
    return F.array_max(ranked)["run"]


def listed(runs: Column) -> Column:
    """Every run as start,length,period and a line feed."""
    return F.array_join(F.transform(runs, lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))), "")


def repeating(doc_id: Column, text: Column) -> Column:
    """A text whose words repeat, for every tenth id by a hash of it; other texts as they are.

    Of n words those from a = g % n on become the p = 1 + (n - a) / (3 + g % 8) ones from a on, again and again.
    """
    h = F.crc32(doc_id.cast("string"))
    g = F.floor(h / 10)
    each = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")

    def again(w: Column) -> Column:
        n = F.size(w)
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        return F.array_join(F.transform(w, lambda _, i: F.get(w, F.when(i < a, i).otherwise(a + (i - a) % p).cast("int"))), " ")

    chosen = F.coalesce(h % 10 == 0, F.lit(False)) & text.rlike(r"[^\x20\x09-\x0D]")
    return F.when(chosen, F.element_at(F.transform(F.array(each), again), 1)).otherwise(text)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The runs of every document, some made to repeat, as digests."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", repeating(F.col("doc_id"), F.col("text")).alias("text"))
    found = collapse_runs(docs).select("doc_id", "runs", "collapsed", best(F.col("runs")).alias("best"))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), *[F.col(f"best.{c}").cast("long").alias(c) for c in ("start", "length", "period")],
        F.expr("1000L * best.length div best.period").alias("exponent_milli"), F.sha2(listed(F.col("runs")), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


#: The same by joining equal words of a text at each distance, numbered into stretches; crc32 is computed by its table.
ORACLE = r"""
WITH crc AS (SELECT list_transform(range(256), lambda x: list_reduce([x::BIGINT, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
told AS (
  SELECT row_number() OVER () AS rid, doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
    xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(doc_id::VARCHAR) + 1), lambda i: ord((doc_id::VARCHAR)[i])::BIGINT)), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS h
  FROM documents, crc),
places AS (SELECT *, len(w) AS n, (h // 10) % greatest(len(w), 1) AS a FROM told),
made AS (
  SELECT rid, doc_id, n, CASE WHEN h % 10 = 0 AND n > 0 THEN list_transform(range(n), lambda i: w[CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + (h // 10) % 8)) END + 1]) ELSE w END AS w
  FROM places),
each AS (SELECT rid, n, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS i FROM made),
pairs AS (SELECT x.rid, x.i, y.i - x.i AS q FROM each x JOIN each y ON x.rid = y.rid AND x.word = y.word AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
stretches AS (SELECT rid, q, i, i - row_number() OVER (PARTITION BY rid, q ORDER BY i) AS g FROM pairs),
runs AS (
  SELECT rid, s, l, min(q) AS q FROM (SELECT rid, q, min(i) AS s, count(*) + q AS l FROM stretches GROUP BY rid, q, g HAVING count(*) + q >= greatest(6, 4 * q))
  GROUP BY rid, s, l),
ranked AS (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY l / q DESC, s, q) AS rank FROM runs),
lists AS (
  SELECT rid, count(*) AS n_runs, string_agg(concat(s, ',', l, ',', q, chr(10)), '' ORDER BY s, q) AS listed,
    max(CASE WHEN rank = 1 THEN s END) AS start, max(CASE WHEN rank = 1 THEN l END) AS length, max(CASE WHEN rank = 1 THEN q END) AS period
  FROM ranked GROUP BY rid),
left_over AS (
  SELECT rid, string_agg(word, ' ' ORDER BY i) AS kept FROM each e
  WHERE NOT EXISTS (SELECT 1 FROM runs r WHERE r.rid = e.rid AND e.i >= r.s + r.q AND e.i < r.s + r.l) GROUP BY rid)
SELECT m.doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, 1000 * length // period AS exponent_milli,
  sha256(coalesce(listed, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
FROM made m LEFT JOIN lists USING (rid) LEFT JOIN left_over USING (rid)
"""
