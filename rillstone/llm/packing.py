"""Packing token sequences by Karmarkar-Karp multiway differencing.

Each task tokenizes its documents and cuts full windows off them, which stand alone. The rests, whole,
gather until they fill GROUP windows; then differencing spreads them over the least number of windows
that could hold them: partial partitions, at first one of each rest, are merged, largest spread first,
the fullest window of one with the emptiest of the other, which leaves windows of nearly equal length.
Whenever the fullest exceeds the capacity, the number of windows rises by one.

What does not fill a group travels, packed, to one of few tasks that take the rests of MEET tasks each and
pack them in the same way, the last ones together however few they are. So only those rests are
shuffled, at most GROUP windows a task. A sequence's id holds the partition of the input, or the meeting,
and its place there.
"""

from __future__ import annotations

import heapq
import itertools
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import for_python, written

CAPACITY, END = 4096, 2
#: Windows that rests fill before they are packed; tasks whose rests meet; words a worker keeps ready.
GROUP, MEET, CACHE = 128, 8, 600_000
#: Tokens that differencing may leave in a window.
SLACK = 24

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def differencing(sizes: list[int], windows: int) -> list[list[int]]:
    """Indices of sizes in each of the windows, whose sums are nearly equal; fullest first."""
    if windows == 1:
        return [list(range(len(sizes)))]
    order = itertools.count()
    # An entry: sums (descending, least one at 0) and what stands in each, as nested pairs.
    heap = [(-s, next(order), [s] + [0] * (windows - 1), [i] + [None] * (windows - 1)) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    while len(heap) > 1:
        _, _, a, x = heapq.heappop(heap)
        _, _, b, y = heapq.heappop(heap)
        merged = sorted(((p + q, i, j) for p, q, i, j in zip(a, reversed(b), x, reversed(y), strict=True)), key=lambda t: -t[0])
        least = merged[-1][0]
        sums = [t[0] - least for t in merged]
        held = [i if j is None else j if i is None else (i, j) for _, i, j in merged]
        heapq.heappush(heap, (-sums[0], next(order), sums, held))
    out = []
    for tree in heap[0][3]:
        found, stack = [], [tree]
        while stack:
            node = stack.pop()
            if isinstance(node, tuple):
                stack.extend(node)
            elif node is not None:
                found.append(node)
        out.append(found)
    return out


def pack(sizes: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """Windows of at most the capacity, as indices of sizes; every size must fit."""
    windows = max(1, -(-sum(sizes) // capacity))
    while True:
        found = differencing(sizes, windows)
        if max(sum(sizes[i] for i in w) for w in found) <= capacity:
            return [sorted(w) for w in found if w]
        windows += 1


class WordTokens:
    """Ids of a text by a tokenizer that never looks across a space, as little-endian bytes.

    Each distinct word is tokenized once while it stays in the cache. Of plain words (Latin letters,
    then punctuation, if any) letters and punctuation are pieces, if the tokenizer cuts there; such
    pieces go to its model alone. Other words go through the whole tokenizer.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[str, bytes] = {"": b""}
        self.pieces: dict[str, bytes] = {"": b""}
        pre = self.tokenizer.pre_tokenizer
        self.letters = str.maketrans({c: pre.pre_tokenize_str(c)[0][0] for c in map(chr, range(0xDF, 0x100)) if c.isalpha()}) if pre else {}
        tried = ("Ab", "\u00c9\u00dfa\u00ff.", "zq!?.,", "Ou\u00e8$$$", "\u00e4|", "Theaonenat,")
        self.plain = re.compile(r"([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([.,;:!?#*$%&|]*)")
        if any(self.quick(w) != self.ids(w) for w in tried):
            self.plain = re.compile(r"(?!)")  # another kind of tokenizer

    def ids(self, text: str) -> bytes:
        return b"".join(i.to_bytes(4, "little") for i in self.tokenizer.encode(text, add_special_tokens=False).ids)

    def piece(self, text: str) -> bytes:
        found = self.pieces.get(text)
        if found is None:
            found = b"".join([t.id.to_bytes(4, "little") for t in self.tokenizer.model.tokenize(text.translate(self.letters))])
            if len(self.pieces) > CACHE:
                self.pieces = {"": b""}
            self.pieces[text] = found
        return found

    def quick(self, word: str) -> bytes:
        m = self.plain.fullmatch(word)
        return self.piece(m[1].lower()) + self.piece(m[2]) if m else self.ids(word)

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        split = [t.split(" ") for t in texts]
        need = set(itertools.chain.from_iterable(split))
        missing = need - self.known.keys()
        if len(self.known) + len(missing) > CACHE:
            self.known = {"": b""}
            missing = need - self.known.keys()
        self.known.update((w, self.quick(w)) for w in missing)
        get = self.known.__getitem__
        for parts in split:
            yield b"".join(map(get, parts))


_loaded: dict[str, WordTokens] = {}


class _Packer:
    """Rows of SCHEMA for pieces of documents: (doc_id, start, ids, tokens of the document)."""

    def __init__(self, first_id: int, capacity: int, group: int):
        self.ids, self.capacity, self.group = itertools.count(first_id), capacity, group
        self.rests: list[tuple] = []
        self.waiting = 0

    def window(self, pieces: list[tuple]) -> Iterator[tuple]:
        seq, offset = next(self.ids), 0
        for doc_id, start, body, n in pieces:
            yield (doc_id, start, len(body) // 4, zlib.crc32(body), n, seq, offset)
            offset += len(body) // 4

    def differenced(self) -> Iterator[tuple]:
        pieces, self.rests, self.waiting = self.rests, [], 0
        for w in pack([len(p[2]) // 4 for p in pieces], self.capacity):
            yield from self.window([pieces[i] for i in w])

    def wait(self, piece: tuple) -> Iterator[tuple]:
        """Adds a rest; of the one that fills the group what exceeds it waits for the next."""
        full = self.group * (self.capacity - SLACK)
        doc_id, start, body, n = piece
        room = full - self.waiting
        self.rests.append((doc_id, start, body[: 4 * room], n))
        self.waiting += len(body[: 4 * room]) // 4
        if self.waiting >= full:
            yield from self.differenced()
            if len(body) > 4 * room:
                yield from self.wait((doc_id, start + room, body[4 * room :], n))

    def add(self, doc_id: int | None, body: bytes) -> Iterator[tuple]:
        n = len(body) // 4
        for start in range(0, n, self.capacity):
            piece = (doc_id, start, body[4 * start : 4 * (start + self.capacity)], n)
            yield from self.window([piece]) if len(piece[2]) == 4 * self.capacity else self.wait(piece)


#: Rows of the tokenizing tasks: pieces of sequences, and rests, which have ids and a partition instead.
STAGE = f"{SCHEMA}, ids binary, part long"
COLUMNS = [f.split()[0] for f in SCHEMA.split(", ")]


def _pack_partition(batches: Iterator[pa.RecordBatch], path: str, capacity: int, end: int, group: int) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    if path not in _loaded:
        _loaded[path] = WordTokens(path)
    tokens, tail = _loaded[path], end.to_bytes(4, "little")
    part = TaskContext.get().partitionId()
    packer = _Packer(part << 40, capacity, group)

    def rows(out: list[tuple], rests: list[tuple] = ()) -> Iterator[pa.RecordBatch]:
        whole = [*((*o, None, None) for o in out), *((i, start, None, None, n, None, None, body, part) for i, start, body, n in rests)]
        if whole:
            types = [pa.int64()] * len(COLUMNS) + [pa.binary(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*whole, strict=True), types, strict=True)], names=[*COLUMNS, "ids", "part"])

    for batch in batches:
        out: list[tuple] = []
        texts = [t or "" for t in batch.column("text").to_pylist()]
        for doc_id, body in zip(batch.column("doc_id").to_pylist(), tokens.encode(texts), strict=True):
            out += packer.add(doc_id, body + tail)
        yield from rows(out)
    yield from rows([], packer.rests)


def _pack_rests(key: tuple, batches: Iterator[pa.RecordBatch], capacity: int, group: int) -> Iterator[pa.RecordBatch]:
    """The rests of a meeting; sequences of meetings are numbered from 2**62 on."""
    packer = _Packer((1 << 62) + (key[0].as_py() << 40), capacity, group)
    names = ("doc_id", "start", "ids", "doc_tokens")
    for batch in batches:
        out = [row for piece in zip(*(batch.column(c).to_pylist() for c in names), strict=True) for row in packer.wait(piece)]
        yield _batch(out)
    yield _batch(list(packer.differenced()) if packer.rests else [])


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(COLUMNS)
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=COLUMNS)


def pack_documents(documents: DataFrame, path: str, capacity: int = CAPACITY, end: int = END, group: int = GROUP, meet: int = MEET) -> DataFrame:
    """Pieces of documents (doc_id, text) in sequences of at most capacity tokens.

    path: a tokenizers file whose pre-tokenizer splits at white space. Columns: doc_id, start,
    length, ids_crc32, doc_tokens, sequence_id, offset. A null or empty text is one token, the end.
    Repeated rows are packed each; an empty table gives no piece. Strings of special tokens in a
    text are those tokens, as the tokenizer has it. A very long text is one string in its task. Other
    columns are ignored, whatever their names.
    """
    first = written(documents.select("doc_id", "text").mapInArrow(lambda it: _pack_partition(it, path, capacity, end, group), STAGE), "pieces")
    rests = first.filter("ids IS NOT NULL").select(F.floor(F.col("part") / meet).alias("meeting"), "part", "doc_id", "start", "ids", "doc_tokens")

    def meeting(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _pack_rests(key, batches, capacity, group)

    packed = rests.groupBy("meeting").applyInArrow(meeting, SCHEMA)
    return first.filter("ids IS NULL").select(*COLUMNS).unionByName(packed)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    for_python(spark)
    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), str(public_tokenizers.path("word_bpe_49k.json")))
