"""Deltas of nested documents: compiling change descriptions and applying them.

Documents are text of ordered JSON. A delta is a list of steps (step, op, path, value): op is set,
unset or truncate; value is JSON, for truncate the new size. Steps of one number belong to one update.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ship

#: Bytes and fields of a follow-up update.
CHUNK_BYTES, CHUNK_FIELDS = 512 * 1024, 100
STEP_TYPE = "array<struct<step:int,op:string,path:string,value:string>>"


def _inside(path: str, arrays: Iterable[str]) -> bool:
    return any(path == a or path.startswith(a + ".") for a in arrays)


def chunked(fields: list[tuple[str, str | None]], max_bytes: int = CHUNK_BYTES, max_fields: int = CHUNK_FIELDS) -> list[list[tuple[str, str | None]]]:
    """Fields in order; a chunk closes with the field that brings it to a bound."""
    out: list[list] = [[]]
    size = 0
    for path, value in fields:
        out[-1].append((path, value))
        size += len(path.encode()) + len((value or "").encode()) + 7
        if size >= max_bytes or len(out[-1]) >= max_fields:
            out.append([])
            size = 0
    return [c for c in out if c]


def compile_delta(updated: list[tuple[str, str]], removed: list[str], truncated: list[tuple[str, int]]) -> list[dict]:
    """Steps of one change.

    Without writes into truncated arrays it is a single update: set, unset, truncate. Otherwise the
    first update truncates and writes what lies elsewhere, and the rest follows in bounded updates,
    all sets before all unsets.
    """
    arrays = [p for p, _ in truncated]
    late_set = [(p, v) for p, v in updated if _inside(p, arrays)]
    late_unset = [(p, None) for p in removed if _inside(p, arrays)]
    cut = [("truncate", p, str(n)) for p, n in truncated]
    sets = [("set", p, v) for p, v in updated if not _inside(p, arrays)]
    unsets = [("unset", p, None) for p in removed if not _inside(p, arrays)]
    first = cut + unsets + sets if late_set or late_unset else sets + unsets + cut
    steps = [{"step": 0, "op": o, "path": p, "value": v} for o, p, v in first]
    number = 0
    for op, fields in (("set", late_set), ("unset", late_unset)):
        for chunk in chunked(fields):
            number += 1
            steps += [{"step": number, "op": op, "path": p, "value": v} for p, v in chunk]
    return steps


class DeltaError(ValueError):
    """A path that leads through a scalar, or a field name into an array."""


def _child(node: object, name: str, make: bool) -> tuple[object, bool]:
    if isinstance(node, dict):
        if name in node:
            return node[name], True
        if make:
            node[name] = {}
            return node[name], True
        return None, False
    if isinstance(node, list):
        if not name.isdigit():
            if make:
                raise DeltaError(name)
            return None, False
        i = int(name)
        if make:
            node.extend([None] * (i + 1 - len(node)))
            if node[i] is None:
                node[i] = {}
        return (node[i], True) if i < len(node) else (None, False)
    if make:
        raise DeltaError(name)
    return None, False


def apply_step(doc: dict, op: str, path: str, value: str | None) -> None:
    """One write. A number names an element in an array and a field in an object; missing parents become objects.

    Writing beyond an array's end pads it with nulls; unsetting an element leaves a null.
    """
    *parents, last = path.split(".")
    node: object = doc
    for name in parents:
        node, found = _child(node, name, op == "set")
        if not found:
            if op == "truncate":
                raise DeltaError(path)
            return
    if op == "set":
        new = json.loads(value) if value is not None else None
        if isinstance(node, dict):
            node[last] = new
        elif isinstance(node, list) and last.isdigit():
            i = int(last)
            node.extend([None] * (i + 1 - len(node)))
            node[i] = new
        else:
            raise DeltaError(path)
    elif op == "unset":
        if isinstance(node, dict):
            node.pop(last, None)
        elif isinstance(node, list) and last.isdigit() and int(last) < len(node):
            node[int(last)] = None
    else:
        array, found = _child(node, last, False)
        if not isinstance(array, list):
            raise DeltaError(path)
        del array[int(value or 0) :]


def apply_delta(doc: str | None, steps: Iterable[dict] | None) -> tuple[str | None, bool]:
    """The document after the steps, and whether they could be applied (else it is unchanged)."""
    if doc is None:
        return None, True
    new = json.loads(doc)
    try:
        for s in sorted(() if steps is None else steps, key=lambda s: s["step"]):
            apply_step(new, s["op"], s["path"], s["value"])
    except DeltaError:
        return doc, False
    return json.dumps(new, ensure_ascii=False, separators=(",", ":")), True


def with_delta(rows: DataFrame, updated: str, removed: str, truncated: str, to: str = "steps") -> DataFrame:
    """Adds the steps of columns updated (path, value), removed (paths), truncated (field, new_size)."""

    ship(rows.sparkSession)

    @F.pandas_udf(STEP_TYPE)
    def compile_all(u: pd.Series, r: pd.Series, t: pd.Series) -> pd.Series:
        def one(a, b, c):  # noqa: ANN001
            return compile_delta([(x["path"], x["value"]) for x in (() if a is None else a)], list(() if b is None else b), [(x["field"], x["new_size"]) for x in (() if c is None else c)])

        return pd.Series([one(*x) for x in zip(u, r, t, strict=True)])

    return rows.withColumn(to, compile_all(updated, removed, truncated))


def applied(doc: Column, steps: Column) -> Column:
    """struct(doc, ok) of documents after their steps."""

    ship()

    @F.pandas_udf("doc string, ok boolean")
    def run(d: pd.Series, s: pd.Series) -> pd.DataFrame:
        done = [apply_delta(x, y) for x, y in zip(d, s, strict=True)]
        return pd.DataFrame({"doc": [x for x, _ in done], "ok": [y for _, y in done]})

    return run(doc, steps)


def overlaid(doc: Column, unset: Column, fields: Column) -> Column:
    """doc without the fields named by unset, then with fields (path, value) set in order: writes of whole fields never fail."""

    ship()

    @F.pandas_udf("string")
    def run(d: pd.Series, u: pd.Series, f: pd.Series) -> pd.Series:
        def one(text, names, pairs):  # noqa: ANN001
            new = json.loads(text)
            for name in names:
                new.pop(name, None)
            for x in pairs:
                new[x["path"]] = json.loads(x["value"]) if x["value"] is not None else None
            return json.dumps(new, ensure_ascii=False, separators=(",", ":"))

        return pd.Series([one(*x) for x in zip(d, u, f, strict=True)])

    return run(doc, unset, fields)


def sequential(rows: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """keys, doc, failed: each key's document after its updates, one by one in order.

    rows: keys, order (null: the row of the document), doc, fallback, updated_fields, removed_fields,
    truncated_arrays. An update that fails puts fallback in the document's place, or removes it where that is
    null, and the following updates go on from there. Rows stream through a task in order: what it
    holds is one document, however many updates a key has.
    """
    ship(rows.sparkSession)
    schema = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in keys) + ", doc string, failed boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: tuple | None = None
        doc, fallback, failed = None, None, False
        out: list[tuple] = []

        def close() -> None:
            if now is not None:
                out.append((*now, None if doc is None else json.dumps(doc, ensure_ascii=False, separators=(",", ":")), failed))

        for batch in batches:
            for row in batch.to_pylist():
                key = tuple(row[c] for c in keys)
                if key != now:
                    close()
                    now, failed, fallback = key, False, row["fallback"]
                    doc = json.loads(row["doc"]) if row["doc"] is not None else None
                if row[order] is None or doc is None:
                    continue
                u, r, t = (row[c] or () for c in ("updated_fields", "removed_fields", "truncated_arrays"))
                try:
                    for s in compile_delta([(x["path"], x["value"]) for x in u], list(r), [(x["field"], x["new_size"]) for x in t]):
                        apply_step(doc, s["op"], s["path"], s["value"])
                except DeltaError:
                    failed = True
                    doc = json.loads(fallback) if fallback is not None else None
            yield pa.RecordBatch.from_pylist([dict(zip((*keys, "doc", "failed"), o, strict=True)) for o in out], schema=arrow)
            out.clear()
        close()
        if out:
            yield pa.RecordBatch.from_pylist([dict(zip((*keys, "doc", "failed"), o, strict=True)) for o in out], schema=arrow)

    arrow = pa.schema([*[pa.field(c, {"bigint": pa.int64(), "string": pa.string()}[rows.schema[c].dataType.simpleString()]) for c in keys], pa.field("doc", pa.string()), pa.field("failed", pa.bool_())])
    return rows.repartition(*keys).sortWithinPartitions(*keys, F.col(order).asc_nulls_first()).mapInArrow(run, schema)


def estimated_bytes(key: Column, payload: Column) -> Column:
    """Size of an operation on the wire: its filter and its payload."""
    return F.octet_length(key) + F.octet_length(F.coalesce(payload, F.lit("")))
