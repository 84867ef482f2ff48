"""Conversation structure repair by composition of weighted finite-state machines.

A conversation is an input acceptor of its rows. An edit transducer keeps a row, gives it another role, deletes it or
inserts an empty one, each at a cost, and a grammar acceptor allows the roles (s?(ua)+)?: perhaps a system row, then
user and assistant in turns. The three are composed lazily, row by row from the states that are reached, and the
best path is the least by cost and then by its string of edits.

Rows are put in order by ranges, so that a conversation of any length lies in blocks of at most BLOCK rows. The
composed machine of a block is reduced to its best paths between states of the grammar; the shortest path over
those, topologically from the last block to the first, tells each block where it begins and ends, and the block then
gives its edits. No task holds a conversation: what meets by conversation is one small row a block.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import attach, for_python, written

#: Rows of a block, at most: a power of two.
BLOCK_BITS = 12
#: Costs of the edits, and of a truncated row that is not deleted.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
ROLES = {"s": "system", "u": "user", "a": "assistant"}
#: The grammar: what each state reads and where that leads; START is the first.
GRAMMAR = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
START, FINAL, STATES = 0, (0, 3), 4
LEGAL = ("su", "ua", "au")
#: A row's code: the initial of its role (the last: any other) and its fault.
INITIALS, FAULTS = "sua-", ("", "blank", "duplicate", "truncated")
WHITE = " \t\n\x0b\f\r"
Path = tuple[int, str, str]  # cost, edits, and of each edit the initial of the role it leaves or "-"


def edits(code: str) -> list[Path]:
    """The edit transducer's arcs that read a row of that code."""
    initial, fault = INITIALS[(ord(code) - 65) % 4], FAULTS[(ord(code) - 65) // 4]
    more = TRUNCATED if fault == "truncated" else 0
    out = [(DELETE, "D", "-")]
    if fault not in ("blank", "duplicate"):
        out += [(REROLE + more, "R", role) for role in "ua"]
        if initial in ROLES:
            out.append((KEEP + more, "K", initial))
    return out


@lru_cache(1024)
def step(code: str | None, state: int) -> dict[int, Path]:
    """Best path to each state of the grammar that inserts rows and then reads one of that code (None: none).

    Inserting twice leads from any state to any other that inserting reaches, so that a third never pays.
    """
    found: dict[int, Path] = {}

    def reach(to: int, path: Path) -> None:
        if to not in found or path < found[to]:
            found[to] = path

    layer: dict[int, Path] = {state: (0, "", "")}
    for inserted in range(3):
        for at, (cost, made, roles) in layer.items():
            if code is None:
                reach(at, (cost, made, roles))
                continue
            for more, edit, role in edits(code):
                to = at if role == "-" else GRAMMAR[at].get(role)
                if to is not None:
                    reach(to, (cost + more, made + edit, roles + role))
        if inserted < 2:
            layer = {to: (cost + INSERT, made + "I", roles + role) for at, (cost, made, roles) in layer.items() for role, to in GRAMMAR[at].items() if role in "ua"}
    return found


def paths(codes: str, state: int) -> dict[int, Path]:
    """Best paths from a state through the rows of a block.

    Paths of equal cost are never the beginning of one another, so that the least string stays the least
    whatever follows.
    """
    best: dict[int, Path] = {state: (0, "", "")}
    for code in codes:
        after: dict[int, Path] = {}
        for at, (cost, made, roles) in best.items():
            for to, (more, edit, role) in step(code, at).items():
                path = (cost + more, made + edit, roles + role)
                if to not in after or path < after[to]:
                    after[to] = path
        best = after
    return best


@lru_cache(1 << 14)
def machine(codes: str) -> tuple[list[int], list[int]]:
    """A block's best paths from state to state: their costs (-1: there is none) and the ranks of their strings."""
    found = [paths(codes, g) for g in range(STATES)]
    order = {s: n for n, s in enumerate(sorted({p[1] for best in found for p in best.values()}))}
    return [found[g][to][0] if to in found[g] else -1 for g in range(STATES) for to in range(STATES)], [order[found[g][to][1]] if to in found[g] else -1 for g in range(STATES) for to in range(STATES)]


@lru_cache(STATES)
def tail(state: int) -> Path:
    """The cheapest insertions that end a conversation."""
    return min(path for to, path in step(None, state).items() if to in FINAL)


def route(blocks: list[tuple[list[int], list[int]]]) -> tuple[int, list[int]]:
    """The least cost of a conversation of these blocks, and the states between them, the first and the last included."""
    ends = [tail(g) for g in range(STATES)]
    order = {s: n for n, s in enumerate(sorted({e[1] for e in ends}))}
    after = [(ends[g][0], order[ends[g][1]]) for g in range(STATES)]
    turns = []
    for costs, ranks in reversed(blocks):
        ways = [min((costs[g * STATES + to] + after[to][0], ranks[g * STATES + to], after[to][1], to) for to in range(STATES) if costs[g * STATES + to] >= 0) for g in range(STATES)]
        strings = {s: n for n, s in enumerate(sorted({w[1:3] for w in ways}))}
        after = [(w[0], strings[w[1:3]]) for w in ways]
        turns.append([w[3] for w in ways])
    states = [START]
    for to in reversed(turns):
        states.append(to[states[-1]])
    return after[START][0], states


@lru_cache(1 << 14)
def pieces(codes: str, begin: int, end: int, last: bool) -> tuple[list[str], list[str]]:
    """Of each row of a block its edits, insertions before it first (and after it, at a conversation's end), and their roles."""
    _, made, roles = paths(codes, begin)[end]
    cuts = [m.end() for m in re.finditer("I*[DKR]", made)]
    each = [made[a:b] for a, b in zip([0, *cuts], cuts, strict=False)]
    kinds = [roles[a:b] for a, b in zip([0, *cuts], cuts, strict=False)]
    if last:
        each[-1] += tail(end)[1]
        kinds[-1] += tail(end)[2]
    return each, kinds


MACHINES = "key string, block long, machine_costs array<int>, machine_ranks array<int>, faults array<int>, illegal int, ends string, low long, high long, turns int"


def _machines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        codes = batch.column("codes").to_pylist()
        built = [machine(c) for c in codes]
        initials = ["".join(INITIALS[(ord(x) - 65) % 4] for x in c) for c in codes]
        faults = [[sum((ord(x) - 65) // 4 == f for x in c) for f in range(4)] for c in codes]
        illegal = [sum(i[k : k + 2] not in LEGAL for k in range(len(i) - 1)) for i in initials]
        ints = pa.list_(pa.int32())
        yield pa.RecordBatch.from_arrays(
            [batch.column("key"), batch.column("block"), pa.array([b[0] for b in built], ints), pa.array([b[1] for b in built], ints), pa.array(faults, ints), pa.array(illegal, pa.int32()), pa.array([i[0] + i[-1] for i in initials]), *[batch.column(c) for c in ("low", "high", "turns")]],
            names=["key", "block", "machine_costs", "machine_ranks", "faults", "illegal", "ends", "low", "high", "turns"],
        )


ROUTES = "key string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, states array<struct<block:long,begin:int,end:int,last:boolean>>"


def _routes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each conversation (key, blocks in order) its counts, its cost and the states of its blocks."""
    for batch in batches:
        out: list[list] = [[] for _ in range(8)]
        for key, blocks in zip(batch.column("key").to_pylist(), batch.column("blocks").to_pylist(), strict=True):
            cost, states = route([(b["machine_costs"], b["machine_ranks"]) for b in blocks])
            illegal = sum(b["illegal"] for b in blocks) + sum(a["ends"][1] + b["ends"][0] not in LEGAL for a, b in zip(blocks, blocks[1:], strict=False))
            timed = [b for b in blocks if b["low"] is not None]
            turns = sum(b["turns"] for b in timed) - sum(a["high"] == b["low"] for a, b in zip(timed, timed[1:], strict=False))
            gaps = timed[-1]["high"] - timed[0]["low"] + 1 - turns if timed else 0
            faults = [sum(b["faults"][k] for b in blocks) for k in (1, 2, 3)]
            way = [{"block": b["block"], "begin": states[k], "end": states[k + 1], "last": k + 1 == len(blocks)} for k, b in enumerate(blocks)]
            for column, value in zip(out, (key, gaps, *faults, illegal, cost, way), strict=True):
                column.append(value)
        kind = pa.list_(pa.struct([("block", pa.int64()), ("begin", pa.int32()), ("end", pa.int32()), ("last", pa.bool_())]))
        arrays = [pa.array(out[0], pa.string()), *[pa.array(c, pa.int64()) for c in out[1:7]], pa.array(out[7], kind)]
        yield pa.RecordBatch.from_arrays(arrays, names=["key", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "states"])


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [pieces(*x) for x in zip(*[batch.column(c).to_pylist() for c in ("codes", "begin", "end", "last")], strict=True)]
        texts = pa.list_(pa.string())
        yield pa.RecordBatch.from_arrays([batch.column("at0"), pa.array([f[0] for f in found], texts), pa.array([f[1] for f in found], texts)], names=["at0", "edits", "roles"])


def _code(role: Column, fault: Column) -> Column:
    initial = F.substring(role, 1, 1)
    number = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    return F.char(F.lit(65) + number + 4 * fault)


def in_order(rows: DataFrame) -> DataFrame:
    """conv_id, key, turn, role, text, code and at of every row: at numbers rows by conversation and turn, nulls first.

    Rows of one turn are taken by role and a hash of their text. A null role or text is one space.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text"))
    each = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), role, text)
    each = each.groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("copies"))  # equal rows once, before anything meets
    each = written(each.select(F.to_json(F.struct("conv_id")).alias("key"), "*", F.md5("text").alias("digest")), "distinct-rows")
    said = ["key", "role", "digest"]
    first = each.groupBy(*said).agg(F.min(F.struct("turn")).alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n")
    each = attach(each, written(first, "said-again"), said)
    each = each.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    again = (F.col("copy") > 1) | (F.col("first").isNotNull() & ~F.col("turn").eqNullSafe(F.col("first.turn")))
    shown = F.rtrim(F.col("text"), F.lit(WHITE))
    fault = F.when(shown == "", 1).when(again, 2).when(~F.substring(shown, -1, 1).isin(".", "!", "?"), 3).otherwise(0)
    order = [F.col("key"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest"), F.col("copy")]
    dealt = each.repartitionByRange(*order).sortWithinPartitions(*order)
    return dealt.select("conv_id", "key", "turn", "role", "text", _code(F.col("role"), fault).alias("code"), F.monotonically_increasing_id().alias("at"))


def repair(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The edits of every conversation of rows (conv_id, turn, role, text), and a row of counts for each.

    Edits: conv_id, key, at, part, edit (K, R, D or I), role, text; in order of at and part those that are
    not D are the repaired conversation. Counts: key, gaps, blank, duplicate, truncated, illegal, cost. key stands for
    conv_id, a null too. Only the first fault of a row counts; a blank or repeated one is deleted. An empty table has
    no rows of either; other columns play no part.
    """
    for_python(rows.sparkSession, 5000)
    ordered = written(in_order(rows), "ordered-rows")
    block = F.shiftright("at", BLOCK_BITS)
    together = F.array_sort(F.collect_list(F.struct("at", "code")))  # at most a block's rows
    blocks = ordered.groupBy("key", block.alias("block")).agg(
        F.array_join(F.transform(together, lambda x: x["code"]), "").alias("codes"), F.min("at").alias("at0"),
        F.min("turn").alias("low"), F.max("turn").alias("high"), F.size(F.collect_set("turn")).alias("turns"),
    )
    blocks = written(blocks, "blocks")
    machines = blocks.drop("at0").mapInArrow(_machines, MACHINES)
    whole = machines.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("block", *[c for c in machines.columns if c not in ("key", "block")]))).alias("blocks"))
    routes = written(whole.mapInArrow(_routes, ROUTES), "routes")
    states = routes.select("key", F.explode("states").alias("s")).select("key", "s.*")
    each = blocks.join(states, ["key", "block"]).select("at0", "codes", "begin", "end", "last").mapInArrow(_pieces, "at0 long, edits array<string>, roles array<string>")
    each = each.select("at0", F.posexplode(F.arrays_zip("edits", "roles")).alias("n", "x")).select((F.col("at0") + F.col("n")).alias("at"), "x.*")
    done = ordered.drop("code", "turn").join(each, "at")
    done = done.withColumn("part", F.explode(F.sequence(F.lit(1), F.length("edits"))))
    edit, initial = F.expr("substring(edits, part, 1)"), F.expr("substring(roles, part, 1)")
    named = F.when(edit == "K", F.col("role")).when(initial == "u", ROLES["u"]).when(initial == "a", ROLES["a"])
    done = done.select("conv_id", "key", "at", "part", edit.alias("edit"), named.alias("role"), F.when(edit == "I", "").when(edit != "D", F.col("text")).alias("text"))
    return done, routes.drop("states")


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations with faults, by a hash of conversation and turn; nulls are one space."""
    space = F.lit(" ")
    h = F.crc32(F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))) % 20
    role, text = (F.coalesce(F.col(c).cast("string"), space) for c in ("role", "text"))
    text = F.when(h == 1, "").when(h == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    rows = rows.select("conv_id", "turn", F.when(h == 4, "user").otherwise(role).alias("role"), text.alias("text"), h.alias("h")).filter("h != 0")
    return rows.withColumn("h", F.explode(F.sequence(F.lit(1), F.when(F.col("h") == 3, 2).otherwise(1)))).drop("h")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation's faults, cheapest edits and repaired text, the last as a digest."""
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    done, counts = repair(damaged(rows))
    line = F.when(F.col("edit") != "D", F.concat("role", F.lit(":"), "text"))
    kept = F.array_sort(F.collect_list(F.struct("at", "part", "edit", line.alias("line"))))
    texts = done.groupBy("key").agg(kept.alias("e")).select("key", F.array_join(F.col("e.edit"), "").alias("audit"), F.sha2(F.array_join(F.col("e.line"), "\n"), 256).alias("repaired_sha256"))
    ids = rows.select("conv_id").distinct().withColumn("key", F.to_json(F.struct("conv_id")))
    all_ = ids.join(counts.hint("merge"), "key", "left").join(texts.hint("merge"), "key", "left")
    numbers = [F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return all_.select("conv_id", *numbers, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


#: The same, row by row: the best path to each state of the grammar, with its strings.
ORACLE = r"""
WITH RECURSIVE
crc AS (SELECT list_transform(range(256), lambda x: list_reduce([x::BIGINT, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
named AS (SELECT *, concat(coalesce(conv_id::VARCHAR, ' '), ':', coalesce(turn::VARCHAR, ' ')) AS name FROM conversations),
hashed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(name) + 1), lambda i: ord(name[i])::BIGINT)), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS h
  FROM named, crc),
damaged AS (
  SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role, CASE h WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(range(CASE h WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM hashed),
numbered AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS i FROM damaged),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS seen FROM numbered),
told AS (
  SELECT *, left(role, 1) AS initial, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 1 WHEN seen > 1 THEN 2 WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 3 ELSE 0 END AS fault,
    left(lag(role) OVER (PARTITION BY conv_id ORDER BY i), 1) || left(role, 1) AS pair
  FROM placed),
grammar(g, r, t) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
once AS (SELECT * FROM grammar WHERE r <> 's'),
inserts AS (
  SELECT DISTINCT g, g AS t, 0 AS cost, '' AS made, '' AS roles FROM (SELECT g FROM grammar UNION SELECT t FROM grammar) UNION ALL SELECT g, t, 5, 'I', r FROM once
  UNION ALL SELECT a.g, b.t, 10, 'II', a.r || b.r FROM once a JOIN once b ON a.t = b.g),
edits(edit, reads, r, cost) AS (VALUES ('K', 's', 's', 0), ('K', 'u', 'u', 0), ('K', 'a', 'a', 0), ('R', NULL, 'u', 1), ('R', NULL, 'a', 1)),
moves AS (
  SELECT n.g, e.reads, x.t, n.cost + e.cost AS cost, n.made || edit AS made, n.roles || x.r AS roles, true AS stays FROM inserts n JOIN grammar x ON x.g = n.t JOIN edits e ON e.r = x.r
  UNION ALL SELECT g, NULL, t, cost + 2, made || 'D', roles || '-', false FROM inserts),
sizes AS (SELECT conv_id, count(*) AS n FROM told GROUP BY conv_id),
best AS (
  SELECT conv_id, 0::BIGINT AS i, 0 AS g, {'cost': 0, 'made': '', 'roles': ''} AS p FROM sizes
  UNION ALL
  SELECT b.conv_id, b.i + 1, m.t, min({'cost': b.p.cost + m.cost + CASE WHEN stays AND fault = 3 THEN 5 ELSE 0 END, 'made': b.p.made || m.made, 'roles': b.p.roles || m.roles})
  FROM best b JOIN told d ON d.conv_id IS NOT DISTINCT FROM b.conv_id AND d.i = b.i + 1
  JOIN moves m ON m.g = b.g AND (m.reads IS NULL OR m.reads = d.initial) AND (NOT stays OR fault NOT IN (1, 2))
  GROUP BY b.conv_id, b.i, m.t),
ended AS (
  SELECT s.conv_id, min({'cost': b.p.cost + n.cost, 'made': b.p.made || n.made, 'roles': b.p.roles || n.roles}) AS p
  FROM sizes s JOIN best b ON b.conv_id IS NOT DISTINCT FROM s.conv_id AND b.i = s.n JOIN inserts n ON n.g = b.g AND n.t IN (0, 3) GROUP BY s.conv_id),
each AS (SELECT conv_id, p, unnest(range(1, length(p.made) + 1)) AS j FROM ended),
lines AS (
  SELECT e.conv_id, e.j, CASE WHEN p.made[j] = 'K' THEN d.role WHEN p.roles[j] = 'u' THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN p.made[j] = 'I' THEN '' ELSE d.text END AS line
  FROM each e LEFT JOIN told d ON d.conv_id IS NOT DISTINCT FROM e.conv_id AND d.i = length(replace(p.made[1:j], 'I', '')) WHERE p.made[j] <> 'D'),
texts AS (SELECT conv_id, string_agg(line, chr(10) ORDER BY j) AS repaired FROM lines GROUP BY conv_id),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate,
    count(*) FILTER (fault = 3) AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM told GROUP BY conv_id)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  coalesce(p.cost, 0)::BIGINT AS cost, coalesce(p.made, '') AS audit, sha256(coalesce(repaired, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN texts x ON x.conv_id IS NOT DISTINCT FROM o.conv_id
"""
