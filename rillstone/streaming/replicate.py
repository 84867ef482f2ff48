"""Replication as a stream: snapshot, change log, target, control.

Every micro-batch walks its schema changes, which are few, through the catalog on the driver; from them come the
intervals of every name's collection, and an as-of join tells which one an event belongs to at its time. All
events of documents, whatever schema changes stand between them, are then folded at once by collection and
key, and the rows that change are written as one run of the log-structured target.
"""

from __future__ import annotations

import json
import logging
import time
import uuid
from collections import defaultdict
from collections.abc import Callable
from enum import Enum
from typing import Any

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..config import Options
from ..functions.errors import CommandError, is_transient
from ..functions.scalars import bounded_size
from ..operators.asof import as_of, in_force
from ..operators.catalog import Catalog, Index
from ..operators.delta import overlaid, sequential
from ..operators.documents import why_violated
from ..operators.namespaces import STATE_DATABASE, selected
from ..operators.segments import LARGEST_SEGMENT, LEAST_SEGMENT, segment_docs, segments
from ..sources.logs import DML, TICK, Lease, StateTable, from_start, read_log, stream_log, ticking
from ..session import scratch, written
from .target import PLACE, SMALL, STORED, TARGET, Target, identity, slot, small_table

__all__ = ["TARGET", "Replicator", "State", "Target", "apply_changes", "histogram", "retried"]
Source = DataFrame | Callable[[], DataFrame] | None
log_ = logging.getLogger(__name__)
#: Names of collections up to which they are a filter of a scan.
MOST_NAMES = 1000
#: Batches whose times the state keeps.
KEPT_FLUSHES = 256
UPDATE = ("updated_fields", "removed_fields", "truncated_arrays")


def _at() -> Column:
    return F.struct(*[F.col(c).cast("long").alias(c) for c in ("t", "i", "seq")]).cast(PLACE)


def _reaches_inside() -> Column:
    """Whether an update writes below the fields of its document, or cuts arrays."""
    dotted = F.exists(F.coalesce("updated_fields", F.array()), lambda x: F.contains(x["path"], F.lit("."))) | F.exists(F.coalesce("removed_fields", F.array()), lambda x: F.contains(x, F.lit(".")))
    return (F.col("op") == "update") & (F.coalesce(dotted, F.lit(False)) | (F.coalesce(F.size("truncated_arrays"), F.lit(0)) > 0))


def apply_changes(target: DataFrame, log: DataFrame, source: Source = None, own: tuple[str, ...] = ("db", "coll", "key"), depth: int = 2) -> DataFrame:
    """target (own, doc and, if it has it, born) after the log's changes of documents.

    A key's last insert or replace that counts is its document, to which later updates apply in order.
    Where all of a key's updates write whole fields, the last write of each field counts: these are
    aggregates, so that a key of very many events is no hot spot. Keys with updates below fields take
    them one by one; one that fails has the document fetched from source (own, doc), or removed where
    source lacks it, and the next go on from that. Without a source a failed update is an error.
    born is the place in the log of the insert that made the document. depth: what is known of the log;
    0: it has no update, 1: none below fields.
    """
    keys, born = list(own), "born" in target.columns
    log = log.filter(F.col("op").isin(*DML)).select(*keys, _at().alias("at"), "op", "full_document", *UPDATE)
    life = log.groupBy(*keys).agg(
        F.max(F.when(F.col("op").isin("insert", "delete"), F.struct("at", "op"))).alias("life"),
        F.max(F.when(F.col("op").isin("insert", "replace"), F.struct("at", "full_document"))).alias("base"),
        F.max(_reaches_inside()).alias("inside"),
    )
    both = target.withColumn("_had", F.lit(True)).join(life, keys, "full_outer")
    alive = F.when(F.col("life").isNotNull(), F.col("life.op") == "insert").otherwise(F.col("_had"))
    both = both.filter(F.coalesce(alive, F.lit(False)))
    more = [F.coalesce(F.col("born"), F.col("life.at")).alias("born")] if born else []
    both = both.select(*keys, F.when(F.col("base").isNotNull(), F.col("base.full_document")).otherwise(F.col("doc")).alias("doc"), F.col("base.at").alias("base_at"), F.coalesce("inside", F.lit(False)).alias("inside"), *more)
    out = ["doc"] + (["born"] if born else [])
    if depth == 0:
        return both.select(*keys, *out)
    # Tables of a row a key or field that several of the joins below read: plans of their own would fold the log again for each.
    both = written(both, "alive")
    updates = log.filter("op = 'update'").join(both.select(*keys, "base_at", "inside"), keys).filter(F.col("base_at").isNull() | (F.col("at") > F.col("base_at")))

    # Whole fields: of each the last write; the fields set stand in the order in which they came to stay.
    sets = F.transform(F.coalesce("updated_fields", F.array()), lambda x, i: F.struct(i.alias("n"), F.lit("set").alias("op"), x["path"].alias("path"), x["value"].alias("value")))
    unsets = F.transform(F.coalesce("removed_fields", F.array()), lambda x, i: F.struct((i + 1_000_000_000).alias("n"), F.lit("unset").alias("op"), x.alias("path"), F.lit(None).cast("string").alias("value")))
    writes = updates.filter("NOT inside").select(*keys, "at", F.explode(F.concat(sets, unsets)).alias("w")).select(*keys, F.struct("at", "w.n").alias("w"), "w.op", "w.path", "w.value")
    by_path = [*keys, "path"]
    last = writes.groupBy(*by_path).agg(F.max(F.struct("w", "op", "value")).alias("last"), F.max(F.when(F.col("op") == "unset", F.col("w"))).alias("gone"), F.min(F.when(F.col("op") == "set", F.col("w"))).alias("first"))
    last = written(last, "last-writes")
    again = writes.join(last.filter("gone IS NOT NULL AND last.op = 'set'").select(*by_path, "gone"), by_path).filter("w > gone").groupBy(*by_path).agg(F.min("w").alias("since"))
    last = last.join(again, by_path, "left").withColumn("since", F.coalesce("since", "first"))
    fields = F.filter(F.sort_array(F.collect_list(F.struct("since", "path", F.col("last.value").alias("value"), F.col("last.op").alias("op")))), lambda x: x["op"] == "set")
    net = last.groupBy(*keys).agg(F.collect_list(F.when(F.col("gone").isNotNull(), F.col("path"))).alias("unset"), F.transform(fields, lambda x: F.struct(x["path"].alias("path"), x["value"].alias("value"))).alias("fields"))
    whole = written(both.filter("NOT inside").join(net, keys, "left"), "whole")
    plain = whole.filter("fields IS NULL").select(*keys, *out).unionByName(whole.filter("fields IS NOT NULL").withColumn("doc", overlaid(F.col("doc"), F.col("unset"), F.col("fields"))).select(*keys, *out))
    if depth == 1:
        return plain

    # Below fields: one update after another.
    nested = both.filter("inside")
    types = dict(log.dtypes)
    nothing = [F.lit(None).cast(types[c]).alias(c) for c in UPDATE]
    first = nested.select(*keys, F.lit(None).cast(PLACE).alias("at"), "doc", F.lit(None).cast("string").alias("fallback"), *nothing)
    after = updates.filter("inside").select(*keys, "at", F.lit(None).cast("string").alias("doc"), F.lit(None).cast("string").alias("fallback"), *UPDATE)
    rows = first.unionByName(after)
    done = sequential(rows, keys, "at")
    names = F.concat_ws(" ", *[F.col(c).cast("string") for c in keys])
    if source is None:
        error = F.raise_error(F.concat(F.lit("an update failed and there is no source to fetch the document from: "), names))
        done = done.select(*keys, F.when(F.col("failed"), error).otherwise(F.col("doc")).alias("doc"))
    else:
        failed = done.filter("failed").select(*keys)
        fresh = (source() if callable(source) else source).select(*keys, F.col("doc").alias("_fresh"))
        fetched = failed.join(fresh, keys, "left").withColumn("_failed", F.lit(True))
        again = rows.drop("fallback").join(fetched, keys).select(*keys, "at", "doc", F.col("_fresh").alias("fallback"), *UPDATE)
        done = done.filter("NOT failed").select(*keys, "doc").unionByName(sequential(again, keys, "at").select(*keys, "doc"))
        done = done.filter("doc IS NOT NULL")
    if born:
        done = done.join(nested.select(*keys, "born"), keys)
    return plain.unionByName(done.select(*keys, *out))


def _place(d: Row) -> tuple[int, int, int]:
    return (d.t, d.i, d.seq)


def _mentions(catalog: Catalog, names: list[tuple], ddl: list) -> dict[tuple, list[int]]:
    """Of each name (db, coll, uid) the schema changes, by number, that may change which collection it means."""
    by_name: dict[tuple, list[tuple]] = defaultdict(list)
    by_uid: dict[str, list[tuple]] = defaultdict(list)
    by_db: dict[str, set[tuple]] = defaultdict(set)
    uids: dict[tuple, set[str]] = defaultdict(set)  # that a collection of this name may have
    for name in names:
        by_name[name[:2]].append(name)
        by_db[name[0]].add(name[:2])
        by_uid[name[2]].append(name)
    for uid, ns in catalog.names.items():
        if uid in by_uid:
            uids[ns].add(uid)
            by_db[ns[0]].add(ns)
    out: dict[tuple, list[int]] = {}
    for k, d in enumerate(ddl):
        if d.op not in ("create", "drop", "rename", "dropDatabase"):
            continue
        places = {(d.db, d.coll)} if d.op != "dropDatabase" else set(by_db[d.db])
        body = json.loads(d.op_desc or "{}")
        if d.op == "create":
            uid = d.collection_uuid or body.get("uuid")
            if uid in by_uid:
                uids[(d.db, d.coll)].add(uid)
                by_db[d.db].add((d.db, d.coll))
        if d.op == "rename":
            to = (body["db"], body["coll"])
            uids[to] |= uids[(d.db, d.coll)]
            by_db[to[0]].add(to)
            places.add(to)
        for name in {n for p in places for n in [*by_name[p], *(m for u in uids[p] if u for m in by_uid[u])]}:
            out.setdefault(name, []).append(k)
    return out


class State(Enum):
    IDLE, RUNNING, PAUSED, FAILED, FINALIZING, FINALIZED = "idle", "running", "paused", "failed", "finalizing", "finalized"


class Replicator:
    """Starts, pauses, resumes and finalizes the replication of a log into a target.

    source: the documents now at the source (db, coll, key, doc), for updates that fail. begins: the
    logical time from which on the log is complete, if that is known. All that a restart needs is in
    the target's state: Replicator.recover() goes on from it.

    source_time: the source's logical time now. With it a running stream ticks: a batch without events reports
    the time that was read when the batch before it had ended, as all that was logged by then has been read.
    """

    def __init__(
        self, spark: SparkSession, log_path: str, target_path: str, include: tuple[str, ...] = (), exclude: tuple[str, ...] = (), fmt: str = "parquet",
        source: Source = None, begins: tuple[int, int] | None = None, source_major: int = 8, clock: Callable[[], float] = time.time, source_time: Callable[[], tuple[int, int]] | None = None, segment_bytes: int = LEAST_SEGMENT, **sizes: int,
    ):
        self.spark, self.log_path, self.fmt, self.path = spark, log_path, fmt, target_path
        self.source, self.begins, self.source_major = source, begins, source_major
        self.source_time, self.segment_bytes, self.seen_time = source_time, segment_bytes, (0, 0)
        self.target = Target(spark, target_path, **sizes)
        self.include, self.exclude, self.state, self.error, self.query = include, exclude, State.IDLE, None, None
        self.catalog = self.target.catalog
        self.checkpoint = f"{target_path}/checkpoint"
        self.lease = Lease(StateTable(spark, f"{target_path}/lease"), uuid.uuid4().hex, clock)

    @classmethod
    def of(cls, spark: SparkSession, log_path: str, target_path: str, options: Options, **more: Any) -> Replicator:
        """A replication by resolved options: the selection of names and the size of segments."""
        size = bounded_size(options.segment_size, LEAST_SEGMENT, LARGEST_SEGMENT) or LEAST_SEGMENT
        return cls(spark, log_path, target_path, include=options.include, exclude=options.exclude, segment_bytes=size, **more)

    @classmethod
    def recover(cls, spark: SparkSession, log_path: str, target_path: str, resume: bool = True, **options: Any) -> Replicator:
        """The replication that a target's state describes; one that was running runs again."""
        out = cls(spark, log_path, target_path, **options)
        saved = out.target.state
        if saved.get("state"):
            out.include, out.exclude = tuple(saved["include"]), tuple(saved["exclude"])
            out.state, out.error = State(saved["state"]), saved.get("error")
            if out.state is State.RUNNING:
                out.state = State.PAUSED
                if resume:
                    out.start()
        return out

    def _save(self, changed: DataFrame | None = None, **state: Any) -> None:
        own = {"state": self.state.value, "error": self.error, "include": list(self.include), "exclude": list(self.exclude), "catalog": self.catalog.to_json()}
        self.target.commit(changed, **(own | state))

    def clone(self, snapshot: DataFrame, at: tuple[int, int], specs: dict[tuple[str, str], dict[str, Any]] | None = None, finished: tuple[int, int] | None = None, segment_bytes: int | None = None) -> None:
        """Copies a snapshot (db, coll, key, doc) taken at a logical time; a second copy adds what is absent.

        The copy goes by segments of keys, of segment_bytes or more, small collections together, the largest first, each a
        commit of its own that the state counts. After a failure a call with the same time goes on with the first segment that
        is not there yet; the plan stands in the state. specs: options (and uuid) of collections that are dropped and
        created anew before the copy.
        """
        self._expect(State.IDLE, State.PAUSED)
        rows = snapshot.filter(selected(F.col("db"), F.col("coll"), self.include, self.exclude) & (F.col("db") != STATE_DATABASE))
        plan = self.target.state.get("plan")
        if plan is None or plan["at"] != list(at):
            for (db, coll), options in (specs or {}).items():
                self.catalog.recreate(db, coll, **options)
            sizes = rows.groupBy("db", "coll").agg(F.count("*").alias("n"), F.sum(F.octet_length("doc")).alias("bytes")).collect()  # a row a collection
            for r in sorted(sizes, key=lambda r: (r.db, r.coll)):
                self.catalog.create(r.db, r.coll)
            with scratch(self.spark):
                loads = self._loads(rows, sizes, segment_bytes or self.segment_bytes)
            plan = {"at": list(at), "loads": loads, "done": 0, "merge": bool(self.target.state["runs"])}
            self._save(plan=plan)
        names = [(db, coll, c.cid) for (db, coll), c in self.catalog.collections.items()]
        for n, load in enumerate(plan["loads"][plan["done"] :], plan["done"] + 1):
            part = rows
            if len(load["names"]) <= MOST_NAMES:
                part = part.filter(F.concat_ws(".", "db", "coll").isin([".".join(x) for x in load["names"]]))
            for test, bound in ((lambda k, v: k >= v, load.get("lo")), (lambda k, v: k < v, load.get("below"))):
                part = part if bound is None else part.filter(test(F.col("key"), bound))
            own = {tuple(x) for x in load["names"]}
            part = part.join(small_table(self.spark, [x for x in names if x[:2] in own], "db string, coll string, cid long"), ["db", "coll"]).dropDuplicates(["cid", "key"])
            if plan["merge"]:
                part = part.join(self.target.rows().select("cid", "key"), ["cid", "key"], "left_anti")
            self.target.load(part.select("cid", "key", "doc", F.lit(None).cast(PLACE).alias("born")), catalog=self.catalog.to_json(), plan=plan | {"done": n})
        self._save(plan=None, clone=list(at), finished=list(finished or at))

    def _loads(self, rows: DataFrame, sizes: list[Row], segment_bytes: int) -> list[dict[str, Any]]:
        """What to copy in turn: names, and of a large collection the keys from lo on and below the next one's."""
        out, small, room = [], [], 0
        for r in sorted(sizes, key=lambda r: (-(r.bytes or 0), r.db, r.coll)):
            size = r.bytes or 0
            if size >= 2 * segment_bytes:
                own = rows.filter((F.col("db") == r.db) & (F.col("coll") == r.coll))
                docs = segment_docs(size, size // r.n, 1, explicit=segment_bytes)
                lows = [x.lo for x in segments(own, "key", docs).orderBy("segment").select("lo").collect()]  # a key a segment
                bounds = [None, *lows[1:], None]
                out += [{"names": [[r.db, r.coll]], "lo": lo, "below": below} for lo, below in zip(bounds, bounds[1:], strict=False)]
                continue
            if small and room + size > segment_bytes:
                out.append({"names": small})
                small, room = [], 0
            small, room = [*small, [r.db, r.coll]], room + size
        return out + ([{"names": small}] if small else [])

    def batch(self, rows: DataFrame, number: int) -> None:
        """One micro-batch; one that was applied already is skipped. The lease is beaten beside it."""
        if self.target.state.get("batch", -1) >= number:
            return
        with self.lease.beating():
            self.target.epoch = self.lease.epoch
            with scratch(self.spark):
                retried(lambda: self._apply(rows, number), passing=lambda e: isinstance(e, CommandError) and is_transient(e.code))
            if self.source_time is not None:
                self.seen_time = tuple(self.source_time())

    def _apply(self, rows: DataFrame, number: int) -> None:
        now, began = self.target.state, time.time()
        self.catalog = self.target.catalog  # a batch that failed may have changed it
        t, i = now.get("clone", (0, 0))
        rows = rows.filter((F.col("t") > t) | ((F.col("t") == t) & (F.col("i") >= i)))
        chosen = (F.col("db") != STATE_DATABASE) & selected(F.col("db"), F.coalesce("coll", F.lit("")), self.include, self.exclude) & (F.col("op") != TICK)
        rows = rows.withColumns({"key": F.col("document_key"), "chosen": F.coalesce(chosen, F.lit(False))}).dropDuplicates(["t", "i", "seq"]).persist()
        held = [rows]
        try:
            depth = F.when(_reaches_inside(), 2).when(F.col("op") == "update", 1).otherwise(0)
            kept = F.col("chosen") & F.col("op").isin(*DML)
            seen = rows.agg(
                F.max(F.struct("t", "i")).alias("any"), F.max(F.when(F.col("op") != TICK, F.struct("t", "i"))).alias("real"), F.count_if("chosen").alias("n"), F.count_if(kept).alias("dml"),
                F.count_if(F.col("chosen") & ~F.col("op").isin(*DML)).alias("ddl"), F.max(F.when(kept, depth)).alias("depth"), F.max(F.when(kept, identity(F.col("key")) != F.col("key"))).alias("several"),
            ).first()
            ddl = rows.filter(F.col("chosen") & ~F.col("op").isin(*DML)).orderBy("t", "i", "seq").select("t", "i", "seq", "op", "db", "coll", "collection_uuid", "op_desc").collect() if seen.ddl else []  # schema changes are few
            changed = None
            if seen.dml or ddl:
                events = self._dealt(rows.filter(kept), ddl).withColumn("h", slot(F.col("cid"), F.col("key"))).select("cid", "key", "h", "t", "i", "seq", "op", "full_document", *UPDATE).persist()
                held.append(events)
                changed = self._changed(events, seen)
            latest = lambda name, at: max(tuple(now.get(name, (0, 0))), (at.t, at.i) if at else (0, 0))
            reported = latest("reported", seen.any)
            if seen.any is None:  # idle
                reported = max(reported, self.seen_time)
            flushes = [*now.get("flushes", []), [seen.n, round(time.time() - began, 3)]][-KEPT_FLUSHES:]
            self._save(changed, batch=number, flushes=flushes, reported=list(reported), checkpoint=list(latest("checkpoint", seen.real)), events=now.get("events", 0) + seen.n)
        finally:
            for frame in held:
                frame.unpersist()

    def _changed(self, events: DataFrame, seen: Row) -> DataFrame:
        """The rows that events change, with marks of those that go; only rows of their keys are read."""
        only = events.select("h").distinct()
        had = self.target.rows(F.broadcast(only) if seen.dml <= SMALL else written(only, "touched")) if self.target.state["runs"] else self.spark.createDataFrame([], STORED)
        had = written(had, "had") if self.target.state["runs"] else had
        source = self._numbered if self.source is not None else None
        new = apply_changes(had, events, source, ("cid", "key"), seen.depth or 0)
        new = new.join(small_table(self.spark, [(c.cid,) for c in self.catalog.collections.values()], "cid long"), "cid", "left_semi")
        if seen.several:
            new = _newest(new, events)
        return self.target.change(had, new.select("cid", "key", "doc", "born"))

    def _dealt(self, events: DataFrame, ddl: list) -> DataFrame:
        """events with cid, their collection's number at their time; walks the catalog through the schema changes.

        An event belongs to the collection of its uuid, if the catalog has it, else to that of its name;
        an insert makes a collection that is missing. A name (with a uuid) has an interval between each two
        schema changes that concern it; events find theirs by an as-of join. The driver gets a row an interval.
        """
        by = ["db", "coll", "uid"]
        events = events.withColumns({"uid": F.coalesce("collection_uuid", F.lit("")), "at": _at()}).select(*by, "at", "key", "t", "i", "seq", "op", "full_document", *UPDATE)
        names = [tuple(r) for r in events.select(*by).distinct().collect()]  # a row a collection
        mentions = _mentions(self.catalog, names, ddl)
        rows = [(*name, _place(ddl[k]), n + 1) for name, found in mentions.items() for n, k in enumerate(found)]
        if rows:
            changes = self.spark.createDataFrame(rows, f"db string, coll string, uid string, at {PLACE}, part int")
            events = as_of(events, changes, by, "at", "part").withColumn("part", F.coalesce("part", F.lit(0)))
        else:
            events = events.withColumn("part", F.lit(0))
        firsts = events.filter("op = 'insert'").groupBy(*by, "part").agg(F.min("at").alias("at")).collect()  # a row an interval at most
        intervals = self._intervals(names, ddl, mentions, {(r.db, r.coll, r.uid, r.part): tuple(r["at"]) for r in firsts})
        table = small_table(self.spark, intervals, f"db string, coll string, uid string, part int, before long, since {PLACE}, after long")
        cid = in_force(F.col("since"), F.col("at"), F.col("before"), F.col("after"))
        return events.join(table, [*by, "part"]).withColumn("cid", cid).filter("cid IS NOT NULL").drop("at", "part", "before", "since", "after", "uid")

    def _intervals(self, names: list[tuple], ddl: list, mentions: dict[tuple, list[int]], firsts: dict[tuple, tuple]) -> list[tuple]:
        """(db, coll, uid, part, before, since, after) of every interval of names: the collection's number, and where an insert
        makes a collection that is missing, since when and which one."""
        at_change: dict[int, list[tuple]] = defaultdict(list)
        for name, found in mentions.items():
            for k in found:
                at_change[k].append(name)
        same: dict[tuple, list[tuple]] = defaultdict(list)
        for name in names:
            same[name[:2]].append(name)
        part = dict.fromkeys(names, 0)
        out: dict[tuple, list] = {}

        def number(name: tuple) -> int | None:
            found = self.catalog.collections.get(self.catalog.names.get(name[2], name[:2]))
            return found.cid if found else None

        def begin(name: tuple) -> None:
            out[(*name, part[name])] = [number(name), None, None]

        for name in names:
            begin(name)
        steps = sorted([(_place(d), 0, k) for k, d in enumerate(ddl)] + [(at, 1, key) for key, at in firsts.items()], key=lambda s: s[:2])
        for at, kind, what in steps:
            if kind:
                name = what[:3]
                if number(name) is None:
                    self.catalog.create(*self.catalog.names.get(name[2], name[:2]), uuid=name[2] or None)
                    for other in same[name[:2]]:
                        now = out[(*other, part[other])]
                        if now[0] is None and now[1] is None and number(other) is not None:
                            now[1:] = [at, number(other)]
                continue
            d = ddl[what]
            body = json.loads(d.op_desc or "{}")
            if d.op == "create" and d.collection_uuid:
                body.setdefault("uuid", d.collection_uuid)
            self.catalog.apply(d.op, d.db, d.coll, body, self.source_major)
            for name in at_change[what]:
                part[name] += 1
                begin(name)
        return [(*key, *value) for key, value in out.items()]

    def _numbered(self) -> DataFrame:
        rows = self.source() if callable(self.source) else self.source
        names = [(db, coll, c.cid) for (db, coll), c in self.catalog.collections.items()]
        return rows.join(small_table(self.spark, names, "db string, coll string, cid long"), ["db", "coll"]).select("cid", "key", "doc")

    def start(self, once: bool = True, from_failure: bool = False, interval: str = "1 second") -> StreamingQuery:
        self._expect(State.IDLE, State.PAUSED, *([State.FAILED] if from_failure else []))
        saved = self.target.state
        resume = max(tuple(saved.get("checkpoint", (0, 0))), tuple(saved.get("clone", (0, 0))))
        if self.begins is not None:
            from_start(read_log(self.spark, self.log_path, self.fmt), *resume, begins=self.begins)
        self.lease.acquire()
        self.target.refresh()
        self.target.epoch = self.lease.epoch
        stream = stream_log(self.spark, self.log_path, self.fmt)
        if self.source_time is not None and not once:
            stream = stream.unionByName(ticking(self.spark))
        stream = stream.writeStream.foreachBatch(self.batch).option("checkpointLocation", self.checkpoint)
        self.state, self.error = State.RUNNING, None
        self._save()
        self.query = (stream.trigger(availableNow=True) if once else stream.trigger(processingTime=interval)).start()
        return self.query

    resume = start

    def wait(self) -> None:
        try:
            self.query.awaitTermination()
        except Exception as e:
            self._stopped(State.FAILED, str(e))
            raise
        self._stopped(State.PAUSED)

    def pause(self) -> None:
        self._expect(State.RUNNING)
        self.query.stop()
        self._stopped(State.PAUSED)

    def _stopped(self, state: State, error: str | None = None) -> None:
        self.state, self.error, self.catalog = state, error, self.target.catalog
        self._save()
        self.lease.release()

    def violated(self, ns: tuple[str, str], index: Index) -> str | None:
        """Why the target's rows do not allow a unique index, or None."""
        return why_violated(self.target.collection(*ns), "key", "doc", index)

    def finalize(self, violated: Callable[[tuple[str, str], Index], str | None] | None = None) -> list[dict[str, Any]]:
        if self.state is State.RUNNING:
            self.pause()
        self._expect(State.PAUSED)
        if not self.status()["initial_sync_completed"]:
            raise RuntimeError("the initial sync is not complete")
        self.state = State.FINALIZING
        report = self.catalog.finalize(violated or self.violated)
        self.state = State.FINALIZED
        self._save()
        return report

    def status(self, source_time: tuple[int, int] | None = None) -> dict[str, Any]:
        now = self.target.state
        reported, clone = tuple(now.get("reported", (0, 0))), tuple(now.get("clone", (0, 0)))
        done = reported > tuple(now.get("finished", clone))
        out = {"state": self.state.value, "events_applied": now.get("events", 0), "last_replicated": reported, "checkpoint": tuple(now.get("checkpoint", (0, 0))), "initial_sync_completed": done, "error": self.error}
        if source_time:
            out["lag_seconds"] = source_time[0] - (reported if reported > (0, 0) else clone)[0]
        return out

    def metrics(self) -> DataFrame:
        """The histogram of the latest batches' times, in one row."""
        rows = self.spark.createDataFrame([(n, s) for n, s in self.target.state.get("flushes", [])], "events long, seconds double")
        return histogram(rows, "seconds")

    def _expect(self, *states: State) -> None:
        if self.state not in states:
            raise RuntimeError(f"not possible while {self.state.value}")


def _newest(rows: DataFrame, dml: DataFrame) -> DataFrame:
    """Of rows whose keys share an _id (a document that moved between shards) the one touched last."""
    touched = dml.groupBy("cid", "key").agg(F.max(_at()).alias("_touched"))
    rank = F.row_number().over(Window.partitionBy("cid", identity(F.col("key"))).orderBy(F.col("_touched").desc_nulls_last(), F.col("born").desc_nulls_last(), "key"))
    return rows.join(touched, ["cid", "key"], "left").withColumn("_rank", rank).filter("_rank = 1").drop("_rank", "_touched")


def retried(run: Callable[[], Any], tries: int = 3, wait: float = 5.0, most: float = 30.0, passing: Callable[[Exception], bool] = lambda e: True) -> Any:
    """run, again after a doubling wait while its error is a passing one; tries 0: without end."""
    n = 0
    while True:
        try:
            return run()
        except Exception as e:
            n += 1
            if not passing(e) or n == tries:
                raise
            time.sleep(min(wait * 2 ** (n - 1), most))


#: Upper bounds, in seconds, of the histogram of flush times.
FLUSH_BOUNDS = (0.001, 0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0)


def histogram(rows: DataFrame, value: str, bounds: tuple[float, ...] = FLUSH_BOUNDS, *by: str) -> DataFrame:
    """Cumulative counts up to each bound, with count and sum: one row, or one of each group."""
    out = rows.groupBy(*by) if by else rows
    return out.agg(*[F.count_if(F.col(value) <= b).alias(f"le_{b:g}") for b in bounds], F.count(value).alias("count"), F.sum(value).alias("sum"))


def status_rows(applied: DataFrame) -> DataFrame:
    """applied with status: its columns as one ordered JSON text."""
    return applied.withColumn("status", F.to_json(F.struct(*applied.columns)))
