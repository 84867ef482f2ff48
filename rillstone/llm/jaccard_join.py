"""N-gram Jaccard join by a token-group matrix.

A document's set is the distinct hashes of its SHINGLE-word runs. Sets of equal tokens are one class.
In one order of all tokens, rare ones first, two sets that link share one of the first n - ceil(t n) + 1
tokens of each, and so many of them that with all later ones they can reach the overlap. Pairs that do
are joined to groups of similar sets. A token that LONG sets or more share makes no pairs. It joins
those of its sets in which it stands so early that, as the first token that two share, it leaves enough
after it for the overlap; one in which it stands late is joined only to smaller sets of the first kind
that its rest could still reach. Pairs found by other tokens count all such tokens as shared.

In a group of more than BLOCK sets, all are first compared with PIVOTS of them; those linked to the
pivots of the largest component need no comparison with each other. What is left is dealt out by pairs
of blocks. In a block, sets stand in rows of ROW, and the token union of each row is kept: a set's
overlap with the union bounds its overlap with each of the row's sets, and only rows that the bound
lets through are opened and compared token by token.

The order of tokens is that of counters that all tasks' tokens are added to, COUNTERS of them at every size, each
for the tokens whose hashes begin alike. A token that stands in many sets has a large counter, so that it comes
first in a set only where all of the set's tokens have. Any order gives the same links, but one that takes
tokens of some dozen sets for rare ones joins unlike sets to groups that grow faster than the table. Of links
only enough to connect a component are returned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import attach, for_python, written
from .components import components
from .textkernel import by_bucket, join_hashes, mix, portions, powers, ranges, spread, squeeze, tokens_of, window_hash

SHINGLE, PERCENT = 4, 85
#: Counters of tokens by the hash's first bits, and the parts in which tasks send them.
COUNTERS, PARTS = 1 << 22, 64
#: Tokens a task holds before they are counted, and the least count that is rounded.
HELD, ROUNDED = 4_000_000, 1 << 15
#: Sets of a token from which they are joined as they are, not by pairs.
LONG = 64
#: Tokens a bucket holds and a task gathers; sets in a block and in a row of the matrix.
BUCKET, FLUSH, BLOCK, ROW = 200_000, 1_000_000, 400, 32
#: Sets of a large group that all of it are compared with.
PIVOTS = 16
NO_ID = -(2**63)


def _shingles(buf: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of the texts, with repetitions, and the text of each."""
    t = tokens_of(buf, offsets, lower=True)
    n = np.diff(t.first)
    count = np.where(n >= k, n - k + 1, 0)
    tokens, owner = window_hash(t.hashes, k)[ranges(t.first[:-1], count)], np.repeat(np.arange(len(n)), count)
    short = np.flatnonzero((n > 0) & (n < k))
    if len(short):
        whole = np.array([_sequence(t.hashes[t.first[i] : t.first[i + 1]]) for i in short.tolist()], np.uint64)
        tokens, owner = np.append(tokens, whole), np.append(owner, short)
    return tokens, owner


class _Sets:
    """The shingle sets of some texts: tokens (ascending in each set), their set, set hashes and sizes."""

    def __init__(self, buf: np.ndarray, offsets: np.ndarray, k: int):
        tokens, owner = _shingles(buf, offsets, k)
        n = len(offsets) - 1
        order = np.lexsort((tokens, owner))
        tokens, owner = tokens[order], owner[order]
        new = np.append(True, (tokens[1:] != tokens[:-1]) | (owner[1:] != owner[:-1]))[: len(tokens)]
        self.tokens, self.owner = tokens[new], owner[new]
        self.size = np.bincount(self.owner, minlength=n)
        self.first = np.append(0, np.cumsum(self.size))
        self.hash = np.zeros(n, np.uint64)
        some = np.flatnonzero(self.size)
        if len(some):
            place = ranges(np.zeros(len(some), np.int64), self.size[some])
            terms = self.tokens * powers(int(self.size.max()) + 1)[place]
            self.hash[some] = mix(np.add.reduceat(terms, self.first[some]) + self.size[some].astype(np.uint64))


def _sequence(h: np.ndarray) -> int:
    """Hash of fewer words than a shingle has; not that of any shingle."""
    out = np.array([len(h)], np.uint64)
    for x in h:
        out = join_hashes(out, np.array([x]))
    return int(out[0])


def _slot(tokens: np.ndarray) -> np.ndarray:
    return (tokens >> np.uint64(65 - COUNTERS.bit_length())).astype(np.int64)


def _counted(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """What the tokens of this task add to the counters of each part, packed; repetitions in a text count."""
    counts = np.zeros(COUNTERS, np.int64)
    held: list[np.ndarray] = []
    for batch in batches:
        for _, _, buf, offsets in portions(batch.column("text")):
            held.append(_slot(_shingles(buf, offsets, k)[0]))
            if sum(map(len, held)) > HELD:
                counts += np.bincount(np.concatenate(held), minlength=COUNTERS)
                held.clear()
    if held:
        counts += np.bincount(np.concatenate(held), minlength=COUNTERS)
    packed = [squeeze(x) if x.any() else None for x in counts.reshape(PARTS, -1)]
    some = [i for i, p in enumerate(packed) if p]
    yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array([packed[i] for i in some], pa.binary())], names=["part", "packed"])


def _added(table: pa.Table) -> pa.Table:
    """The counters of a part as the order has them, 16 bits each, large ones rounded, and their sum."""
    counts = np.zeros(COUNTERS // PARTS, np.int64)
    for packed in table.column("packed").to_pylist():
        counts += np.frombuffer(spread(packed)[0], np.int64)
    large = 2048 * np.log2(np.maximum(counts, ROUNDED) / ROUNDED)
    ranks = np.minimum(np.minimum(counts, ROUNDED) + large.astype(np.int64), (1 << 16) - 1).astype(np.uint16)
    return pa.table({"part": table.column("part")[:1], "packed": pa.array([squeeze(ranks)], pa.binary()), "n": pa.array([int(counts.sum())], pa.int64())})


def _prefixes(x: _Sets, ranks: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens, their sets and places in them, that stand first in the order of all tokens: by counters (ranks), then by hash.

    None of sets so small that they link with equal ones only, which are one class.
    """
    # A set's tokens ascend, and equal keys keep their order.
    order = np.argsort((x.owner << 16) | ranks[_slot(x.tokens)], kind="stable")
    length = np.where(100 * x.size >= percent * (x.size + 1), x.size - -(-percent * x.size // 100) + 1, 0)
    pick = ranges(x.first[:-1], length)
    return x.tokens[order[pick]], x.owner[pick], ranges(np.zeros(len(length), np.int64), length)


def _send(batches: Iterator[pa.RecordBatch], k: int, percent: int, buckets: int, packed: list[bytes]) -> Iterator[pa.RecordBatch]:
    """Packed prefix tokens with their sets by the token's bucket, and what is known of each document."""
    held: list[list[np.ndarray]] = [[], [], [], []]
    docs: list[list[np.ndarray]] = [[], [], [], []]
    m = np.uint64(buckets)
    ranks = np.concatenate([np.frombuffer(spread(p)[0], np.uint16) if p else np.zeros(COUNTERS // PARTS, np.uint16) for p in packed])

    def flush() -> Iterator[pa.RecordBatch]:
        tokens, sets, sizes, places = (np.concatenate(h) for h in held)
        order = np.lexsort((sets, tokens))
        tokens, sets, sizes, places = tokens[order], sets[order], sizes[order].astype(np.int32), places[order].astype(np.int32)
        new = np.append(True, (tokens[1:] != tokens[:-1]) | (sets[1:] != sets[:-1]))[: len(tokens)]
        tokens, sets, sizes, places = tokens[new], sets[new], sizes[new], places[new]
        out = [(b, squeeze(b"\0", tokens[i], sets[i], sizes[i], places[i])) for b, i in by_bucket((tokens % m).astype(np.int64))]
        ids, rows, sizes, hashes = (np.concatenate(d) for d in docs)
        out += [(b, squeeze(b"\1", ids[i], rows[i], sizes[i], hashes[i])) for b, i in by_bucket((rows.view(np.uint64) % m).astype(np.int64))]
        for h in (*held, *docs):
            h.clear()
        for i in range(0, len(out), 200):
            yield pa.RecordBatch.from_arrays([pa.array([b for b, _ in out[i : i + 200]], pa.int64()), pa.array([p for _, p in out[i : i + 200]], pa.binary())], names=["bucket", "packed"])

    for batch in batches:
        ids = batch.column("doc_id").fill_null(NO_ID).to_numpy(zero_copy_only=False).astype(np.int64)
        rows = batch.column("row_key").to_numpy(zero_copy_only=False).astype(np.int64)
        for a, b, buf, offsets in portions(batch.column("text")):
            x = _Sets(buf, offsets, k)
            _, first = np.unique(x.hash, return_index=True)
            tokens, owner, place = _prefixes(x, ranks, percent)
            lead = np.zeros(len(x.hash), bool)
            lead[first] = True
            mine = lead[owner]
            for h, new in zip(held, (tokens[mine], x.hash[owner[mine]], x.size[owner[mine]], place[mine]), strict=True):
                h.append(new)
            for d, new in zip(docs, (ids[a:b], rows[a:b], x.size.astype(np.int64), x.hash), strict=True):
                d.append(new)
        if sum(map(len, held[0])) > FLUSH:
            yield from flush()
    if docs[0]:
        yield from flush()


def _meet(table: pa.Table, percent: int) -> pa.Table:
    """What a bucket's tokens and documents tell.

    Kind 0: sets a, b that a token of many sets joins; kind 3: a set a and its number c of such tokens;
    kind 1: id, row, size and set of documents;
    kind 2: sets a, b of like size that share c of the tokens, and their sizes, in one number.
    """
    tokens, docs = [], []
    for packed in table.column("packed").to_pylist():
        kind, *parts = spread(packed)
        (docs if kind == b"\1" else tokens).append(parts)
    out = [np.zeros((0, 5), np.int64)]
    if tokens:
        t, s, n, i = (np.concatenate([np.frombuffer(p[i], d) for p in tokens]) for i, d in enumerate((np.uint64, np.int64, np.int32, np.int32)))
        order = np.lexsort((s, t))
        t, s, n, place = t[order], s[order], n[order].astype(np.int64), i[order].astype(np.int64)
        new = np.append(True, (t[1:] != t[:-1]) | (s[1:] != s[:-1]))[: len(t)]
        t, s, n, place = t[new], s[new], n[new], place[new]
        start = np.flatnonzero(np.append(True, t[1:] != t[:-1])[: len(t)])
        length = np.diff(np.append(start, len(t)))
        long = np.flatnonzero(length >= LONG)
        joined = [_joined(s[i:j], n[i:j], place[i:j], percent) for i, j in zip(start[long].tolist(), (start + length)[long].tolist(), strict=True)]
        if joined:
            pairs = np.unique(np.concatenate(joined), axis=0)
            out.append(np.column_stack([np.zeros(len(pairs), np.int64), pairs, np.zeros((len(pairs), 2), np.int64)]))
            having, k = np.unique(s[ranges(start[long], length[long])], return_counts=True)
            out.append(np.column_stack([np.full(len(k), 3), having, np.zeros(len(k), np.int64), k, np.zeros(len(k), np.int64)]))
        some = (length > 1) & (length < LONG)
        left = ranges(start[some], length[some])
        after = np.repeat(start[some] + length[some], length[some]) - left - 1
        i, j = np.repeat(left, after), ranges(left + 1, after)
        like = 100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j])
        i, j = i[like], j[like]
        pairs, counts = np.unique(np.stack([s[i], s[j], (n[i] << 32) | n[j]], 1), axis=0, return_counts=True)
        out.append(np.column_stack([np.full(len(pairs), 2), pairs[:, :2], counts, pairs[:, 2]]))
    if docs:
        columns = [np.concatenate([np.frombuffer(p[i], np.int64) for p in docs]) for i in range(4)]
        out.append(np.column_stack([np.ones(len(columns[0]), np.int64), *columns]))
    rows = np.concatenate(out)
    return pa.table({n: pa.array(np.ascontiguousarray(rows[:, i])) for i, n in enumerate(("kind", "a", "b", "c", "d"))})


def _joined(s: np.ndarray, n: np.ndarray, place: np.ndarray, percent: int) -> np.ndarray:
    """Pairs that chain the sets s, of n tokens, in which one token stands at place, where it may be the first that two share.

    Sharing nothing before it, two sets share at most what begins with it in either. So in the smaller
    of two that link it leaves the overlap of two sets of that size, and in the larger that of both.
    """
    left = n - place
    early = left * (100 + percent) >= 2 * percent * n
    if not early.any():
        return np.zeros((0, 2), np.int64)
    sizes = np.sort(n[early])
    low, high = -(-percent * n // 100), np.minimum(n, left * (100 + percent) // percent - n)
    reached = np.searchsorted(sizes, high, "right") > np.searchsorted(sizes, low, "left")
    some = s[early | reached]
    return np.stack([np.full(len(some), s[early][0]), some], 1)


def _fetch(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Adds the packed tokens of each text."""
    for batch in batches:
        packed: list[bytes] = []
        for _, _, buf, offsets in portions(batch.column("text")):
            x = _Sets(buf, offsets, k)
            packed += [x.tokens[i:j].tobytes() for i, j in zip(x.first[:-1].tolist(), x.first[1:].tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("group"), batch.column("sets"), batch.column("set"), pa.array(packed, pa.binary())], names=["group", "sets", "set", "tokens"])


def _star_links(table: pa.Table, percent: int) -> pa.Table:
    """Links of the pivots (pivot true) of a group with its other sets of this task: a the pivot."""
    packed, ids = table.column("tokens").to_pylist(), table.column("set").to_pylist()
    pivot = table.column("pivot").to_numpy(zero_copy_only=False)
    size = np.array([len(p) // 8 for p in packed], np.int64)
    first = np.append(0, np.cumsum(size))
    tokens = np.frombuffer(b"".join(packed), np.uint64)
    a, b = [], []
    for q in np.flatnonzero(pivot).tolist():
        found = np.isin(tokens, tokens[first[q] : first[q + 1]], kind="sort")
        inter = np.add.reduceat(found.astype(np.int64), first[:-1])
        hit = np.flatnonzero(100 * inter >= percent * (size + size[q] - inter))
        a += [ids[q]] * len(hit)
        b += [ids[i] for i in hit.tolist()]
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _block_links(table: pa.Table, percent: int) -> pa.Table:
    """Links that connect the sets of two blocks (or of one): a, b."""
    ids = table.column("set").to_numpy()
    packed = table.column("tokens").to_pylist()
    size = np.array([len(p) // 8 for p in packed], np.int64)
    tokens = np.frombuffer(b"".join(packed), np.uint64)
    first = np.append(0, np.cumsum(size))
    # Rows hold sets of like size whose least tokens are near each other: copies stand together.
    least = np.array([tokens[i:j].min() for i, j in zip(first[:-1], first[1:], strict=True)], np.uint64)
    order = np.lexsort((size, least))
    tokens = tokens[ranges(first[:-1][order], size[order])]
    ids, size = ids[order], size[order]
    first = np.append(0, np.cumsum(size))
    names, code, df = np.unique(tokens, return_inverse=True, return_counts=True)
    shared = np.add.reduceat((df[code] > 1).astype(np.int64), first[:-1])
    parent = list(range(len(ids)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    links: list[tuple[int, int]] = []
    mark = np.zeros(len(names), bool)
    alive = np.flatnonzero(100 * shared >= percent * size)
    for row in range(0, len(ids), ROW):
        end = min(row + ROW, len(ids))
        union = np.zeros(len(names), bool)
        union[code[first[row] : first[end]]] = True
        bound = np.add.reduceat(union[code].astype(np.int64), first[:-1])
        for q in alive[(alive < end) & (100 * bound[alive] >= percent * size[alive])].tolist():
            own = root(q)
            some = [i for i in range(max(row, q + 1), end) if root(i) != own and 100 * min(size[i], size[q]) >= percent * max(size[i], size[q])]
            if not some:
                continue
            mine = code[first[q] : first[q + 1]]
            mark[mine] = True
            for i in some:
                inter = int(np.count_nonzero(mark[code[first[i] : first[i + 1]]]))
                if 100 * inter >= percent * (size[i] + size[q] - inter):
                    a, b = root(i), root(q)
                    if a != b:
                        parent[a] = b
                        links.append((int(ids[q]), int(ids[i])))
            mark[mine] = False
    return pa.table({"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())})


def _stars(sets: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Links of each group's pivots with its sets, and the sets of its core: linked to pivots of one component, the largest."""
    place = F.row_number().over(Window.partitionBy("group").orderBy("order"))
    # The pivots are the sets of the least hashes: few of each task's sets are sorted.
    some = sets.select("group", "set", F.xxhash64("set").alias("order")).filter(F.pmod("order", F.ceil(F.col("sets") / (8 * PIVOTS))) == 0)
    chosen = written(some.withColumn("place", place).filter(F.col("place") <= PIVOTS).select("group", "set"), "pivots")
    pivots = sets.join(chosen, ["group", "set"], "left_semi")
    parts = F.ceil(F.col("sets") / BLOCK).cast("int")
    own = sets.select("group", F.pmod(F.xxhash64("set"), parts).cast("int").alias("part"), "set", "tokens", F.lit(False).alias("pivot"))
    sent = pivots.select("group", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"), "set", "tokens", F.lit(True).alias("pivot"))
    links = own.unionByName(sent).groupBy("group", "part").applyInArrow(lambda t: _star_links(t, percent), "a long, b long")
    links = written(links.filter("a != b").distinct(), "stars")
    label = components(links).select(F.col("node").alias("set"), F.col("component").alias("label"))
    label = written(sets.select("group", "set").join(label, "set"), "star-labels")
    largest = label.groupBy("group", "label").agg(F.count("*").alias("n")).groupBy("group").agg(F.max_by("label", F.struct("n", "label")).alias("label"))
    return links, written(label.join(largest, ["group", "label"], "left_semi").select("set"), "core")


def _blocked(sets: DataFrame, core: DataFrame | None) -> DataFrame:
    """Sets with the pairs of blocks (i, j) that compare them; blocks of core sets meet only the others."""
    blocks = F.ceil(F.col("sets") / BLOCK).cast("int")
    if core is None:
        sets = sets.withColumn("core", F.lit(False)).withColumn("rest", blocks)
    else:
        sets = sets.join(core.withColumn("core", F.lit(True)), "set", "left").withColumn("core", F.coalesce("core", F.lit(False)))
        outside = sets.filter("NOT core").groupBy("group").agg(F.count("*").alias("outside"))
        sets = attach(sets, written(outside, "outside"), ["group"]).withColumn("rest", F.ceil(F.coalesce("outside", F.lit(0)) / BLOCK).cast("int"))
    # Blocks 0 .. rest - 1 hold what is not core; those of the core follow and meet only these.
    own = F.when(F.col("core"), F.col("rest") + F.pmod(F.xxhash64("set"), blocks).cast("int")).otherwise(F.pmod(F.xxhash64("set"), F.greatest("rest", F.lit(1))).cast("int"))
    others = F.sequence(F.lit(0), F.col("rest") - 1)
    meets = others if core is None else F.when(F.col("core"), others).otherwise(F.sequence(F.lit(0), F.col("rest") + blocks - 1))
    sets = sets.filter("rest > 0").withColumn("own", own).withColumn("other", F.explode(meets))
    return sets.select("group", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "set", "tokens")


def near_duplicates(documents: DataFrame, k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, row_key, group, n_shingles, component_id of every row of documents (doc_id, text).

    component_id: the least doc_id that links reach; sets of equal tokens link. group: the same for rows
    that links join, even where ids repeat. row_key: a hash of the row. Null and wordless
    texts have no shingle and link with nothing. A null doc_id is no component_id unless there is no
    other. Repeated rows link; an empty table gives an empty result; a very long text is worked on by
    itself. Other columns are ignored, whatever their names.
    """
    spark = documents.sparkSession
    for_python(spark)
    docs = documents.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("row_key"))
    told = docs.select("text").mapInArrow(lambda it: _counted(it, k), "part long, packed binary").groupBy("part").applyInArrow(_added, "part long, packed binary, n long").toArrow()  # of bounded size
    by_part = dict(zip(told.column("part").to_pylist(), told.column("packed").to_pylist(), strict=True))
    buckets = max(12, -(-sum(told.column("n").to_pylist()) * (100 - percent) // 100 // BUCKET))
    shared = spark.sparkContext.broadcast([by_part.get(i) for i in range(PARTS)])
    sent = docs.mapInArrow(lambda it: _send(it, k, percent, buckets, shared.value), "bucket long, packed binary")
    met = written(sent.groupBy("bucket").applyInArrow(lambda t: _meet(t, percent), "kind long, a long, b long, c long, d long"), "met")
    known_docs = met.filter("kind = 1").select(F.when(F.col("a") != NO_ID, F.col("a")).alias("doc_id"), F.col("b").alias("row_key"), F.col("c").alias("n_shingles"), F.col("d").alias("set"))
    classes = written(known_docs.filter("n_shingles > 0").groupBy("set").agg(F.min("doc_id").alias("least"), F.min("row_key").alias("row_key")), "classes")
    n, m = F.shiftright("d", 32), F.col("d").bitwiseAND((1 << 32) - 1)
    later = F.greatest(*[F.ceil(percent * x / 100) - 1 for x in (n, m)])  # tokens that follow the first ones
    need = F.ceil(percent * (n + m) / (100 + percent)) - later
    long = written(met.filter("kind = 3").groupBy("a").agg(F.sum("c").alias("k")), "long")
    pairs = met.filter("kind = 2").groupBy("a", "b", "d").agg(F.sum("c").alias("c"))
    for side in ("a", "b"):
        pairs = attach(pairs, long.select(F.col("a").alias(side), F.col("k").alias(f"k{side}")), [side])
    pairs = pairs.filter(F.col("c") + F.least(F.coalesce("ka", F.lit(0)), F.coalesce("kb", F.lit(0))) >= need).select("a", "b")
    groups = components(met.filter("kind = 0").select("a", "b").unionByName(pairs)).select(F.col("node").alias("set"), F.col("component").alias("group"))
    groups = groups.join(groups.groupBy("group").agg(F.count("*").alias("sets")), "group")
    need_text = written(classes.join(groups, "set").select("row_key", "set", "group", "sets"), "candidates")
    # What is needed grows with the documents: a join of two exchanges at every size.
    texts = docs.select("row_key", "text").join(need_text.hint("merge"), "row_key").dropDuplicates(["set"])
    sets = texts.select("group", "sets", "set", "text").mapInArrow(lambda it: _fetch(it, k), "group long, sets long, set long, tokens binary")
    links, core = None, None
    if not need_text.filter(F.col("sets") > BLOCK).isEmpty():
        sets = written(sets, "sets")
        links, core = _stars(sets.filter(F.col("sets") > BLOCK), percent)
    blocked = _blocked(sets, core).groupBy("group", "i", "j").applyInArrow(lambda t: _block_links(t, percent), "a long, b long")
    links = written(blocked if links is None else blocked.unionByName(links), "links")
    joined = components(links).select(F.col("node").alias("set"), F.col("component").alias("top"))
    of_class = classes.join(joined, "set", "left").withColumn("top", F.coalesce("top", "set"))
    lowest = of_class.groupBy("top").agg(F.min("least").alias("component_id"))
    of_set = written(of_class.select("set", "top").join(lowest, "top").select("set", "component_id", "top"), "sets")
    linked = known_docs.join(of_set, "set", "left")
    return linked.select("doc_id", "row_key", F.coalesce("top", "row_key").alias("group"), "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("row_key", "group")


#: All pairs that share a shingle; for small tables.
ORACLE = rf"""
WITH RECURSIVE w AS (SELECT row_number() OVER () AS rid, doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (SELECT DISTINCT rid, md5(array_to_string(ws[i:i + {SHINGLE - 1}], ' ')) AS h FROM (SELECT rid, ws, unnest(range(1, greatest(len(ws) - {SHINGLE - 2}, 2))) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT rid, count(*) AS n FROM s GROUP BY rid),
p AS (SELECT a.rid AS x, b.rid AS y, count(*) AS k FROM s a JOIN s b ON a.h = b.h AND a.rid <> b.rid GROUP BY 1, 2),
l AS (SELECT x, y FROM p JOIN n a ON a.rid = x JOIN n b ON b.rid = y WHERE 100 * k >= {PERCENT} * (a.n + b.n - k)),
r AS (SELECT x AS rid, x AS o FROM l UNION SELECT r.rid, l.y FROM r JOIN l ON r.o = l.x),
c AS (SELECT r.rid, min(doc_id) AS component_id FROM r JOIN w ON w.rid = r.o GROUP BY r.rid)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, coalesce(component_id, doc_id) AS component_id FROM w LEFT JOIN n USING (rid) LEFT JOIN c USING (rid)
"""
