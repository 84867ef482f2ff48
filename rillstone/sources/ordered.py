"""The change log as an ordered stream: offsets are logical times, not files.

A log is a folder of Parquet files of events to which files are added in the order of time. Which of their row
groups hold a range of time is told by the files' footers, each read once; tasks read those row groups, and
of these what lies in the range. So a stream can begin at any time, also in the middle of a file, and its
checkpoint says how far in time it is.
"""

from __future__ import annotations

import time
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import Any

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from ..session import ship
from .logs import EVENT_SCHEMA, TICK, HistoryLost

Place = tuple[int, int, int]
PLACE = ("t", "i", "seq")
#: After every event of a time, and before every event.
LAST, FIRST = 2**63 - 1, (-1, -1, -1)
#: Bytes of row groups that a task reads.
TASK_BYTES = 64 << 20


@dataclass(frozen=True)
class Group:
    """A row group: its file and number, its first and last seconds, rows and bytes."""

    path: str
    number: int
    first: int
    last: int
    rows: int
    size: int


@dataclass
class Slice(InputPartition):
    """Row groups of which a task reads what lies after one place and up to another; without any, a tick."""

    groups: list[Group]
    after: Place
    upto: Place


class OrderedLog(DataSource):
    """Format `ordered_log`. Options: path; from: the logical time `t.i` to begin with (default: the log's begin);
    begins: since when the log is complete; events: about how many a batch has at most (0: any number; a batch
    holds whole seconds, so that no transaction is cut); ticks: seconds after which a poll without events gives a tick.

    A stream that works on what is there now and ends (availableNow) takes one batch: leave events at 0 there.
    """

    @classmethod
    def name(cls) -> str:
        return "ordered_log"

    def schema(self) -> str:
        return EVENT_SCHEMA

    def streamReader(self, schema: Any) -> DataSourceStreamReader:
        return Reader({k.lower(): v for k, v in self.options.items()}, schema)


def _time(text: str | None) -> tuple[int, int] | None:
    if text is None:
        return None
    t, _, i = text.partition(".")
    return int(t), int(i or 0)


class Reader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str], schema: Any):
        from pyspark.sql.pandas.types import to_arrow_schema

        self.fs, self.path = _filesystem(options["path"])
        self.start, self.begins = _time(options.get("from")), _time(options.get("begins"))
        self.events, self.ticks = int(options.get("events", 0)), float(options.get("ticks", 0))
        self.arrow = to_arrow_schema(schema)
        self.known: dict[str, list[Group]] = {}
        self.at: Place | None = None  # where the last batch ended
        self.n_ticks, self.moved = 0, time.monotonic()

    # Driver

    def _footer(self, path: str) -> list[Group]:
        with self.fs.open_input_file(path) as f:
            meta = pq.ParquetFile(f).metadata
        column = next((c for c in range(meta.num_columns) if meta.schema.column(c).path == "t"), None)
        if column is None:
            raise ValueError(f"{path} has no column t")
        out = []
        for g in range(meta.num_row_groups):
            group = meta.row_group(g)
            stats = group.column(column).statistics
            if group.num_rows and (stats is None or not stats.has_min_max):
                raise ValueError(f"{path} has no statistics of t")
            if group.num_rows:
                out.append(Group(path, g, stats.min, stats.max, group.num_rows, group.total_byte_size))
        return out

    def _listed(self, folder: str) -> Iterator[str]:
        """The files of a folder and those below it; what writers still work on lies in folders of hidden names."""
        for f in self.fs.get_file_info(fs.FileSelector(folder, allow_not_found=True)):
            if f.base_name.startswith(("_", ".")):
                continue
            if f.type == fs.FileType.Directory:
                yield from self._listed(f.path)
            elif f.path.endswith(".parquet"):
                yield f.path

    def _groups(self) -> list[Group]:
        """All row groups; footers of files that are new are read, side by side."""
        paths = list(self._listed(self.path))
        new = [p for p in paths if p not in self.known]
        with ThreadPoolExecutor(16) as pool:
            self.known.update(zip(new, pool.map(self._footer, new), strict=True))
        for p in set(self.known) - set(paths):
            del self.known[p]
        return [g for p in paths for g in self.known[p]]

    def _extreme(self, groups: list[Group], last: bool) -> Place:
        """The exact last (or first) place of row groups that share the last (first) second."""
        t = max(g.last for g in groups) if last else min(g.first for g in groups)
        places = []
        for g in groups:
            if t == (g.last if last else g.first):
                with self.fs.open_input_file(g.path) as f:
                    rows = pq.ParquetFile(f).read_row_group(g.number, columns=list(PLACE))
                rows = rows.filter(pc.equal(rows["t"], t)).sort_by([(c, "descending" if last else "ascending") for c in PLACE])
                places.append(tuple(rows[c][0].as_py() for c in PLACE))
        return max(places) if last else min(places)

    def _offset(self, place: Place) -> dict[str, int]:
        return dict(zip(PLACE, place, strict=True)) | {"ticks": self.n_ticks}

    def initialOffset(self) -> dict[str, int]:
        groups = self._groups()
        start = self.start
        if start is None:
            return self._offset(FIRST)
        begins = self.begins or (self._extreme(groups, False)[:2] if groups else None)
        if begins is not None and begins > start:
            raise HistoryLost(f"the log begins at {begins[0]}.{begins[1]}, after {start[0]}.{start[1]}")
        return self._offset((start[0], start[1] - 1, LAST))

    def latestOffset(self) -> dict[str, int]:
        groups = self._groups()
        end = self._extreme(groups, True) if groups else FIRST
        if self.at is not None and self.at >= end:
            if self.ticks and time.monotonic() - self.moved >= self.ticks:
                self.n_ticks += 1
                self.moved = time.monotonic()
            return self._offset(self.at)
        if self.events and self.at is not None:
            end = min(end, self._bounded(groups, self.at))
        return self._offset(end)

    def _bounded(self, groups: list[Group], after: Place) -> Place:
        """The last row group's end up to which there are at most so many events, but one row group's at least."""
        left = sorted((g for g in groups if g.last > after[0] or (g.last == after[0] and after[1:] != (LAST, LAST))), key=lambda g: g.last)
        n, out = 0, None
        for g in left:
            n += g.rows
            if out is not None and n > self.events and g.last > out:
                break
            out = g.last
        return (out, LAST, LAST) if out is not None else after

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        after, upto = (tuple(o[c] for c in PLACE) for o in (start, end))
        if self.begins is not None and after != FIRST and (*self.begins, 0) > (after[0], after[1] + 1, 0) and self.begins[0] > after[0]:
            raise HistoryLost(f"the log begins at {self.begins[0]}.{self.begins[1]}, after {after[0]}.{after[1]}")
        self.n_ticks = max(self.n_ticks, end["ticks"])
        if self.at is None or upto > self.at:
            self.at, self.moved = upto, time.monotonic()
        out: list[InputPartition] = []
        size = 0
        for g in sorted(self._groups(), key=lambda g: (g.first, g.path, g.number)) if upto > after else []:
            if g.last >= after[0] and g.first <= upto[0]:
                if not out or size + g.size > TASK_BYTES:
                    out.append(Slice([], after, upto))
                    size = 0
                out[-1].groups.append(g)
                size += g.size
        if end["ticks"] > start["ticks"] and upto != FIRST:
            out.append(Slice([], upto, upto))
        return out

    # Tasks

    def read(self, partition: Slice) -> Iterator[pa.RecordBatch]:
        if not partition.groups:
            t, i = partition.upto[0], min(partition.upto[1], 2**32 - 1)
            row = {f.name: None for f in self.arrow} | {"t": t, "i": i, "op": TICK}
            yield pa.RecordBatch.from_pylist([row], schema=self.arrow)
            return
        for g in partition.groups:
            with self.fs.open_input_file(g.path) as f:
                for batch in pq.ParquetFile(f).iter_batches(row_groups=[g.number], batch_size=8192):
                    kept = batch.filter(pc.and_(_beyond(batch, partition.after), pc.invert(_beyond(batch, partition.upto))))
                    if kept.num_rows:
                        own = set(kept.schema.names)
                        columns = [kept.column(f.name).cast(f.type) if f.name in own else pa.nulls(kept.num_rows, f.type) for f in self.arrow]
                        yield pa.RecordBatch.from_arrays(columns, schema=self.arrow)


def _beyond(batch: pa.RecordBatch, place: Place) -> pa.Array:
    """Which rows come after a place."""
    out = pc.greater(batch.column("seq"), place[2])
    for name, value in (("i", place[1]), ("t", place[0])):
        c = batch.column(name)
        out = pc.or_(pc.greater(c, value), pc.and_(pc.equal(c, value), out))
    return out


def _filesystem(path: str) -> tuple[fs.FileSystem, str]:
    """Arrow's file system of a path, and the path in it."""
    return fs.FileSystem.from_uri(path) if ":" in path.split("/")[0] else (fs.LocalFileSystem(), path)


def stream_ordered(spark: SparkSession, path: str, **options: Any) -> DataFrame:
    """The log as an ordered stream; options are those of OrderedLog (start stands for from)."""
    ship(spark)
    spark.dataSource.register(OrderedLog)
    reader = spark.readStream.format("ordered_log").option("path", path)
    for name, value in options.items():
        if value is not None:
            reader = reader.option("from" if name == "start" else name, ".".join(map(str, value)) if isinstance(value, tuple) else value)
    return reader.load()
