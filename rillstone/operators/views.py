"""Predicates and update expressions of the document database, as columns.

match() compiles the filters of views, partial indexes and validators; expression() the operators that
pipeline updates use.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.errors import CommandError
from ..functions.scalars import pulled, sliced
from .catalog import NAMESPACE_NOT_FOUND, Catalog

#: Fixed value: the code of the error that views lead in a circle.
VIEW_CYCLE = 5

_COMPARE = {
    "$eq": lambda c, v: c.eqNullSafe(F.lit(v)), "$ne": lambda c, v: ~c.eqNullSafe(F.lit(v)),
    "$gt": lambda c, v: c > v, "$gte": lambda c, v: c >= v, "$lt": lambda c, v: c < v, "$lte": lambda c, v: c <= v,
    "$in": lambda c, v: c.isin(*v), "$nin": lambda c, v: ~F.coalesce(c.isin(*v), F.lit(False)),
    "$exists": lambda c, v: c.isNotNull() if v else c.isNull(), "$regex": lambda c, v: c.rlike(v),
}

#: Types of a schema validator and Spark's names of them.
_TYPES = {"string": ("string",), "int": ("int", "smallint", "tinyint"), "long": ("bigint",), "double": ("double", "float"), "bool": ("boolean",), "date": ("timestamp", "timestamp_ntz", "date"), "array": ("array",), "object": ("struct", "map")}


def match(query: dict[str, Any], types: dict[str, str] | None = None) -> Column:
    """Whether a row matches; unknown comparisons do not."""
    tests: list[Column] = []
    for key, want in query.items():
        if key in ("$and", "$or", "$nor"):
            parts = [match(q, types) for q in want]
            both = reduce((lambda a, b: a & b) if key == "$and" else (lambda a, b: a | b), parts)
            tests.append(~both if key == "$nor" else both)
        elif key == "$jsonSchema":
            tests.append(conforms(want, types or {}))
        elif key == "$expr":
            tests.append(expression(want))
        elif isinstance(want, dict) and want and all(k.startswith("$") for k in want):
            array = (types or {}).get(key, "").startswith("array")
            for op, value in want.items():
                if array and op in ("$eq", "$gt", "$gte", "$lt", "$lte", "$in", "$regex"):  # any element
                    tests.append(F.exists(key, _element_test(op, value)))
                    continue
                if array and op in ("$ne", "$nin"):
                    tests.append(~F.coalesce(F.exists(key, _element_test({"$ne": "$eq", "$nin": "$in"}[op], value)), F.lit(False)))
                    continue
                test = ~match({key: value}, types) if op == "$not" else _COMPARE[op](F.col(key), value)
                tests.append(test)
        else:
            tests.append(_any_element(key, want) if (types or {}).get(key, "").startswith("array") and not isinstance(want, list) else F.col(key).eqNullSafe(F.lit(want)))
    return F.coalesce(reduce(lambda a, b: a & b, tests, F.lit(True)), F.lit(False))


def _element_test(op: str, value: Any) -> Callable[[Column], Column]:
    return lambda x: _COMPARE[op](x, value)


def _any_element(column: str, want: Any) -> Column:
    """Of an array column: whether any element equals a value, as of null whether it is missing."""
    return F.col(column).isNull() if want is None else F.exists(column, lambda x: x == F.lit(want))


def conforms(schema: dict[str, Any], types: dict[str, str]) -> Column:
    """Required fields present, fields of the stated types and within the stated bounds. types: Spark's, by field."""
    tests = [F.col(c).isNotNull() for c in schema.get("required", ())]
    for name, rule in schema.get("properties", {}).items():
        kinds = rule.get("bsonType")
        if kinds and name in types:
            kinds = [kinds] if isinstance(kinds, str) else kinds
            fits = any(types[name].startswith(t) for k in kinds for t in _TYPES.get(k, (k,)))
            tests.append(F.lit(True) if fits else F.col(name).isNull())
        for bound, test in (("minimum", lambda c, v: c >= v), ("maximum", lambda c, v: c <= v)):
            if bound in rule:
                tests.append(F.coalesce(test(F.col(name), rule[bound]), F.lit(True)))
    return reduce(lambda a, b: a & b, tests, F.lit(True))


def expression(e: Any, names: dict[str, Column] | None = None) -> Column:
    """An aggregation expression; $field and $$variable are references."""
    names = names or {}
    sub = lambda x: expression(x, names)
    if isinstance(e, str) and e.startswith("$$"):
        head, _, rest = e[2:].partition(".")
        return names[head][rest] if rest else names[head]
    if isinstance(e, str) and e.startswith("$"):
        return F.col(e[1:])
    if isinstance(e, list):
        return F.array(*[sub(x) for x in e])
    if not isinstance(e, dict):
        return F.lit(e)
    ((op, arg),) = e.items()
    if op == "$literal":
        return F.lit(arg)
    if op == "$slice":
        array, *bounds = arg
        return sliced(sub(array), *bounds)
    if op in ("$filter", "$map"):
        body = lambda x: expression(arg["cond" if op == "$filter" else "in"], names | {arg.get("as", "this"): x})
        return F.filter(sub(arg["input"]), body) if op == "$filter" else F.transform(sub(arg["input"]), body)
    if op == "$let":
        return expression(arg["in"], names | {k: sub(v) for k, v in arg["vars"].items()})
    if op == "$cond":
        test, yes, no = (arg["if"], arg["then"], arg["else"]) if isinstance(arg, dict) else arg
        return F.when(sub(test), sub(yes)).otherwise(sub(no))
    if op == "$getField":
        return sub(arg["input"])[arg["field"]] if isinstance(arg, dict) else F.col(arg)
    if op == "$mergeObjects":
        return F.map_from_entries(_last_wins([F.map_entries(sub(x)) for x in arg]))
    args = [sub(x) for x in arg] if isinstance(arg, list) else [sub(arg)]
    simple = {
        "$concatArrays": lambda *a: F.concat(*a), "$reverseArray": F.reverse, "$arrayElemAt": lambda a, i: F.get(a, F.when(i < 0, F.size(a) + i).otherwise(i)),
        "$ifNull": lambda *a: F.coalesce(*a), "$max": lambda *a: F.greatest(*a) if len(a) > 1 else F.array_max(a[0]), "$min": lambda *a: F.least(*a) if len(a) > 1 else F.array_min(a[0]),
        "$subtract": lambda a, b: a - b, "$add": lambda *a: reduce(lambda x, y: x + y, a), "$multiply": lambda *a: reduce(lambda x, y: x * y, a), "$divide": lambda a, b: a / b,
        "$size": F.size, "$in": lambda x, a: F.array_contains(a, x), "$type": type_name, "$and": lambda *a: reduce(lambda x, y: x & y, a), "$or": lambda *a: reduce(lambda x, y: x | y, a), "$not": lambda a: ~a,
        "$eq": lambda a, b: a.eqNullSafe(b), "$ne": lambda a, b: ~a.eqNullSafe(b), "$gt": lambda a, b: a > b, "$gte": lambda a, b: a >= b, "$lt": lambda a, b: a < b, "$lte": lambda a, b: a <= b,
    }
    return simple[op](*args)


#: Names of the document database's types, by beginnings of Spark's.
TYPE_NAMES = {"string": "string", "int": "int", "smallint": "int", "tinyint": "int", "bigint": "long", "double": "double", "float": "double", "decimal": "decimal", "boolean": "bool", "timestamp": "date", "date": "date", "binary": "binData", "array": "array", "struct": "object", "map": "object"}


def type_name(value: Column) -> Column:
    """The name of a value's type in the document database."""
    out = F.lit("unknown")
    for spark_name, name in TYPE_NAMES.items():
        out = F.when(F.startswith(F.typeof(value), F.lit(spark_name)), name).otherwise(out)
    return F.when(value.isNull(), "null").otherwise(out)


def _last_wins(parts: list[Column]) -> Column:
    """Entries of several maps; of one key the last."""
    every = F.concat(*parts)
    return F.filter(every, lambda x, i: ~F.exists(F.slice(every, i + 2, F.size(every)), lambda y: y["key"] == x["key"]))


def _set(rows: DataFrame, values: dict[str, Column]) -> DataFrame:
    """Columns by name; a dotted one is a field of a struct, which is made if it is missing."""
    flat = {k: v for k, v in values.items() if "." not in k}
    rows = rows.withColumns(flat) if flat else rows
    for path, value in ((k, v) for k, v in values.items() if "." in k):
        root, *rest = path.split(".")
        if root in rows.columns:
            rows = rows.withColumn(root, F.col(root).withField(".".join(rest), value))
        else:
            for name in reversed(rest):
                value = F.struct(value.alias(name))
            rows = rows.withColumn(root, value)
    return rows


def update(rows: DataFrame, change: dict[str, Any] | list[dict[str, Any]]) -> DataFrame:
    """Rows after an update of top-level fields: $set, $unset, $inc, $pull, or a pipeline of $set and $unset."""
    for stage in change if isinstance(change, list) else [change]:
        for op, arg in stage.items():
            if op in ("$set", "$addFields"):
                rows = _set(rows, {k: expression(v) if isinstance(change, list) else F.lit(v) for k, v in arg.items()})
            elif op == "$inc":
                rows = rows.withColumns({k: F.coalesce(F.col(k), F.lit(0)) + v for k, v in arg.items()})
            elif op == "$pull":
                rows = rows.withColumns({k: pulled(F.col(k), v["$in"] if isinstance(v, dict) else [v]) for k, v in arg.items()})
            elif op == "$unset":
                for name in [arg] if isinstance(arg, str) else arg:
                    root, _, rest = name.partition(".")
                    rows = rows.withColumn(root, F.col(root).dropFields(rest)) if rest else rows.drop(name)
            else:
                raise ValueError(f"no such update: {op}")
    return rows


def run_pipeline(rows: DataFrame, stages: list[dict[str, Any]]) -> DataFrame:
    """A view's pipeline: $match, $project, $unwind, $replaceRoot, $group, $sort, $limit, $skip, $set, $unset."""
    for stage in stages:
        ((op, arg),) = stage.items()
        if op == "$match":
            rows = rows.filter(match(arg, dict(rows.dtypes)))
        elif op == "$project":
            if all(v in (0, False) for v in arg.values()):
                rows = rows.drop(*arg)
            else:
                rows = rows.select(*[F.col(k) if v in (1, True) else expression(v).alias(k) for k, v in arg.items() if v not in (0, False)])
        elif op == "$unwind":
            path = (arg if isinstance(arg, str) else arg["path"]).removeprefix("$")
            rows = rows.withColumn(path.split(".")[-1], F.explode(path))
        elif op == "$replaceRoot":
            rows = rows.select(arg["newRoot"].removeprefix("$") + ".*")
        elif op == "$group":
            make = {"$sum": F.sum, "$min": F.min, "$max": F.max, "$avg": F.avg, "$first": F.first, "$push": F.collect_list, "$addToSet": F.collect_set}
            keys = [expression(arg["_id"]).alias("_id")] if arg["_id"] is not None else []
            rows = rows.groupBy(*keys).agg(*[make[o](expression(x)).alias(k) for k, v in arg.items() if k != "_id" for o, x in v.items()])
        elif op == "$sort":
            rows = rows.orderBy(*[F.col(k).asc() if d > 0 else F.col(k).desc() for k, d in arg.items()])
        elif op == "$limit":
            rows = rows.limit(arg)
        elif op == "$skip":
            rows = rows.offset(arg)
        elif op in ("$set", "$addFields", "$unset"):
            rows = update(rows, [stage])
        else:
            raise ValueError(f"no such stage: {op}")
    return rows


class ViewGraph:
    """The views of a catalog as nodes of a graph, each on the collection or view that it names.

    Views are kept as text in the catalog, so that creating, changing, dropping and renaming them or what they
    stand on needs nothing but the log; what a view shows is resolved when it is read.
    """

    def __init__(self, catalog: Catalog):
        self.collections = catalog.collections

    def _on(self, ns: tuple[str, str]) -> tuple[str, str] | None:
        c = self.collections.get(ns)
        return (ns[0], c.options["viewOn"]) if c is not None and c.is_view else None

    def chain(self, ns: tuple[str, str]) -> list[tuple[str, str]]:
        """What a view stands on, down to the collection, the view first; an error if that is missing or leads in a circle."""
        out = [ns]
        while (on := self._on(out[-1])) is not None:
            if on in out:
                raise CommandError(VIEW_CYCLE, f"views lead in a circle: {'.'.join(on)}")
            out.append(on)
        if out[-1] not in self.collections:
            raise CommandError(NAMESPACE_NOT_FOUND, f"{'.'.join(ns)} stands on {'.'.join(out[-1])}, which is missing")
        return out

    def _chains(self) -> dict[tuple[str, str], list[tuple[str, str]] | str]:
        out: dict[tuple[str, str], list[tuple[str, str]] | str] = {}
        for ns, c in self.collections.items():
            if c.is_view:
                try:
                    out[ns] = self.chain(ns)
                except CommandError as e:
                    out[ns] = str(e)
        return out

    def order(self) -> list[tuple[str, str]]:
        """Views that can be read, each after those that it stands on."""
        found = {ns: len(c) for ns, c in self._chains().items() if isinstance(c, list)}
        return sorted(found, key=lambda ns: (found[ns], ns))

    def broken(self) -> dict[tuple[str, str], str]:
        """Views that cannot be read, and why: what they stand on was dropped, renamed, or is themselves."""
        return {ns: c for ns, c in self._chains().items() if isinstance(c, str)}

    def dependents(self, ns: tuple[str, str]) -> list[tuple[str, str]]:
        """Views that a drop or rename of ns makes unreadable."""
        return [v for v, c in self._chains().items() if isinstance(c, list) and ns in c[1:]]

    def stages(self, ns: tuple[str, str]) -> list[dict[str, Any]]:
        """All stages from the collection up to this view, as one pipeline."""
        out: list[dict[str, Any]] = []
        for view in reversed(self.chain(ns)[:-1]):
            pipeline = self.collections[view].options.get("pipeline", [])
            out += json.loads(pipeline) if isinstance(pipeline, str) else pipeline
        return out

    def read(self, ns: tuple[str, str], rows: Callable[[tuple[str, str]], DataFrame]) -> DataFrame:
        """What a view shows; rows gives a collection's documents as columns."""
        return run_pipeline(rows(self.chain(ns)[-1]), self.stages(ns))


def as_columns(docs: DataFrame, doc: str = "doc") -> DataFrame:
    """Documents (JSON) as columns, of the types that all of them have together; those without any field give no columns."""
    found = docs.agg(F.schema_of_variant_agg(F.parse_json(doc)).alias("s")).first().s
    if not found or not found.startswith("OBJECT<") or found == "OBJECT<>":
        return docs.select()
    return docs.select(F.from_json(doc, found.replace("OBJECT<", "STRUCT<").replace("VOID", "STRING")).alias("_d")).select("_d.*")


def create_view(spark: SparkSession, name: str, source: DataFrame, stages: list[dict[str, Any]]) -> None:
    run_pipeline(source, stages).createOrReplaceTempView(name)
