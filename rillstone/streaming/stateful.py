"""Folding a change log as a stateful operator, for streams whose target is not at hand.

A key's state is what its document follows from whatever the order of its events: its last insert or
delete, its last insert or replace, and of each path the last write after that. Each of them is a maximum, so
a key's events pass through in chunks, unsorted, and events that a restart reads again change nothing. What a
task holds of a key is its document and one write of each path, not its events.

A snapshot is the first batch's initial state. A deleted key leaves a mark, so that older events do not bring
it back; a timer removes the mark after a while.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from ..operators.delta import DeltaError, apply_step, compile_delta
from ..session import ship
from ..sources.logs import DML

#: The place of a snapshot's rows: before every event.
BEFORE = (-1, -1, -1)
#: Milliseconds for which a deleted key is remembered.
FORGET = 24 * 3600 * 1000
#: State by key on disk; no batches without events, as with timers of wall-clock time these would never end.
SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}
_PLACE = "t long, i long, seq long"


def _dump(doc: Any) -> str:
    return json.dumps(doc, ensure_ascii=False, separators=(",", ":"))


class Fold(StatefulProcessor):
    """keys, t, i, seq (of the last event), doc (null: the key is not there), failed (a write could not be applied).

    An update of a key that is not there changes nothing. Fields that are written after the document's
    insert or replace stand in the order of their last writes. A cut of an array is kept until the next insert or replace.
    """

    def __init__(self, keys: Sequence[str], forget: int = FORGET):
        self.keys, self.forget = list(keys), forget

    def init(self, handle: Any) -> None:
        self.handle = handle
        place = lambda p: ", ".join(f"{p}_{c}" for c in _PLACE.split(", "))
        writes = "array<struct<path:string,cut:string,t:long,i:long,seq:long,step:int,op:string,value:string>>"
        self.state = handle.getValueState("key", f"{place('life')}, op string, {place('base')}, doc string, {place('last')}, writes {writes}, forget_at long")

    def handleInitialState(self, key: tuple, initialState: pd.DataFrame, timerValues: Any) -> None:
        self.state.update((*BEFORE, "insert", *BEFORE, initialState["doc"].iloc[-1], *BEFORE, [], None))

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        found = self.state.get()  # the only reading of a key's state, and below its only writing: each is a message to the JVM
        life = (tuple(found[:3]), found[3]) if found else None
        base = (tuple(found[4:7]), found[7]) if found and found[7] is not None else None
        last, timer = (tuple(found[8:11]), found[12]) if found else (BEFORE, None)
        writes = {(w[0], w[1]): tuple(w[2:]) for w in (found[11] if found else None) or ()}
        for frame in rows:
            for row in frame.to_dict("records"):
                at, op = (int(row["t"]), int(row["i"]), int(row["seq"])), row["op"]
                last = max(last, at)
                if op in ("insert", "delete") and (life is None or at > life[0]):
                    life = (at, op)
                if op in ("insert", "replace") and (base is None or at > base[0]):
                    base = (at, row["full_document"])
                if op == "update":
                    self._note(writes, at, row)
        dead = life is None or life[1] == "delete"
        if timer is not None and not dead:
            self.handle.deleteTimer(timer)
            timer = None
        if dead:
            if life is not None:
                if timer is None:
                    timer = timerValues.getCurrentProcessingTimeInMs() + self.forget
                    self.handle.registerTimer(timer)
                self.state.update((*life[0], life[1], None, None, None, None, *last, None, timer))
            yield self._row(key, last, None, False)
            return
        since = base[0] if base else BEFORE
        writes = {k: w for k, w in writes.items() if w[:3] > since}
        self.state.update((*life[0], life[1], *since, base[1] if base else None, *last, [(*k, *w) for k, w in writes.items()], timer))
        doc, failed = self._document(base[1] if base else None, writes)
        yield self._row(key, last, doc, failed)

    def _note(self, writes: dict[tuple[str, str], tuple], at: tuple, row: dict[str, Any]) -> None:
        """An update's writes: of each path the last; cuts of arrays are all kept."""
        u, r, t = (row[c] if row[c] is not None else () for c in ("updated_fields", "removed_fields", "truncated_arrays"))
        steps = compile_delta([(x["path"], x["value"]) for x in u], list(r), [(x["field"], x["new_size"]) for x in t])
        for n, s in enumerate(steps):
            write = (*at, n, s["op"], s["value"])
            path = (s["path"], ".".join(map(str, (*at, n))) if s["op"] == "truncate" else "")
            if path not in writes or writes[path][:4] <= write[:4]:
                writes[path] = write

    def _document(self, text: str | None, writes: dict[tuple[str, str], tuple]) -> tuple[str | None, bool]:
        if text is None or not writes:
            return text, False
        doc = json.loads(text)
        try:
            for (*_, op, value), (path, _cut) in sorted((w, k) for k, w in writes.items()):
                apply_step(doc, op, path, value)
        except DeltaError:
            return text, True
        return _dump(doc), False

    def _row(self, key: tuple, last: tuple, doc: str | None, failed: bool) -> pd.DataFrame:
        return pd.DataFrame([(*key, *last, doc, failed)], columns=[*self.keys, "t", "i", "seq", "doc", "failed"])

    def handleExpiredTimer(self, key: tuple, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        self.state.clear()
        return iter(())


def stateful(log: DataFrame, keys: Sequence[str] = ("db", "coll", "key"), snapshot: DataFrame | None = None, forget: int = FORGET) -> DataFrame:
    """A stream of keys, t, i, seq, doc, failed: a row for each key that a micro-batch touches.

    log: a stream with keys, t, i, seq, op, full_document, updated_fields, removed_fields, truncated_arrays;
    snapshot (keys, doc, one row a key): what is there before it.
    """
    ship(log.sparkSession)
    kinds = dict(log.dtypes)
    schema = ", ".join(f"{c} {kinds[c]}" for c in keys) + f", {_PLACE}, doc string, failed boolean"
    rows = log.filter(F.col("op").isin(*DML)).select(*keys, *[F.col(c).cast("long").alias(c) for c in ("t", "i", "seq")], "op", "full_document", "updated_fields", "removed_fields", "truncated_arrays")
    first = snapshot.select(*keys, "doc").groupBy(*keys) if snapshot is not None else None
    return rows.groupBy(*keys).transformWithStateInPandas(Fold(keys, forget), schema, "Update", "ProcessingTime", first)


class Folded:
    """The rows of a stateful stream as a table: a folder a micro-batch, the last row of each key counts."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str] = ("db", "coll", "key")):
        self.spark, self.path, self.keys = spark, path, list(keys)

    def start(self, rows: DataFrame) -> StreamingQuery:
        """Works on all that is there now and goes on after the last batch at the next start; state lies on disk beside the rows."""
        conf = self.spark.conf
        before = {name: conf.get(name) for name in SETTINGS}
        for name, value in SETTINGS.items():
            conf.set(name, value)
        try:
            out = rows.writeStream.outputMode("update").foreachBatch(self._write).option("checkpointLocation", f"{self.path}/checkpoint")
            return out.trigger(availableNow=True).start()
        finally:
            for name, value in before.items():
                conf.set(name, value)

    def _write(self, rows: DataFrame, number: int) -> None:
        rows.write.mode("overwrite").parquet(f"{self.path}/rows/batch={number}")

    def read(self) -> DataFrame:
        """keys, doc, failed of the keys that are there."""
        rows = self.spark.read.parquet(f"{self.path}/rows")
        last = rows.groupBy(*self.keys).agg(F.max_by(F.struct("doc", "failed"), F.col("batch")).alias("row"))
        return last.select(*self.keys, "row.doc", "row.failed").filter("doc IS NOT NULL")
