"""Documents as VARIANT: values along paths through arrays, filters, index keys run in the JVM; sizes are counted in Python (Arrow)."""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from functools import reduce
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ordering import BRACKETS, among, bracket, compared, encoded, field, items, kind_of, let, plainly_encoded
from ..session import ship
from .catalog import Index


def _step(x: Column, name: str) -> Column:
    """What a name leads to: of an object its field; of an array that field of each element, and by number an element."""
    of = _elements(x, "$", name)
    inside = _fields_of(of, name)
    if name.isdigit():
        inside = F.concat(F.array(F.try_variant_get(x, F.lit(f"$[{name}]"), "variant")), inside)
    return F.coalesce(inside, F.array(field(x, name)))


def _elements(x: Column, at: str, name: str) -> Column:
    """Of an array at a path its elements as structs of one field, null for those that are no objects; null if there is no array."""
    return F.try_variant_get(x, F.lit(at), f"array<struct<`{name.replace('`', '``')}`:variant>>")


def _fields_of(elements: Column, name: str) -> Column:
    return F.transform(F.filter(elements, lambda e: e.isNotNull()), lambda e: e[name])


def _two_steps(x: Column, first: str, name: str) -> Column:
    """Two names at once, which spares a copy of what the first leads to; only an array has its own way."""
    slow = F.flatten(F.transform(_step(x, first), _stepping(name)))
    if name.isdigit():
        return slow
    ahead = F.coalesce(_fields_of(_elements(x, f"$['{first}']", name), name), F.array(F.try_variant_get(x, F.lit(f"$['{first}']['{name}']"), "variant")))
    return F.when(_is_array(x), slow).otherwise(ahead)


def _is_array(x: Column) -> Column:
    return F.try_variant_get(x, F.lit("$"), "array<struct<>>").isNotNull()


def _stepping(name: str) -> Callable[[Column], Column]:
    return lambda x: _step(x, name)


def values_at(v: Column, path: str) -> Column:
    """What a dotted path leads to, through arrays on the way: an array with a null for what is missing."""
    names = path.split(".") if path else []
    if not names:
        return F.array(v)
    out, rest = (_two_steps(v, *names[:2]), names[2:]) if len(names) > 1 else (_step(v, names[0]), [])
    for name in rest:
        out = F.flatten(F.transform(out, _stepping(name)))
    return out


def _any(v: Column, path: str, test: Callable[[Column], Column]) -> Column:
    """Whether a test that holds for no array, and is never null, holds for one of the candidates."""
    return F.exists(values_at(v, path), lambda x: F.exists(F.coalesce(items(x), F.array(x)), test))


def candidates(v: Column, path: str) -> Column:
    """The values that a comparison tries: those at the path, and the elements of those that are arrays."""
    at = values_at(v, path)
    return F.concat(at, F.flatten(F.transform(at, lambda x: F.coalesce(items(x), F.expr("cast(array() AS array<variant>)")))))


#: The index key of an empty array, before all others.
EMPTY = "05"


def _missing(x: Column) -> Column:
    return x.isNull() | F.is_variant_null(x)


#: Types of $type by their brackets; of numbers all are one.
_TYPES = BRACKETS | dict.fromkeys(("int", "long", "double", "decimal"), BRACKETS["number"])


def _compared(v: Column, path: str, op: str, want: Any) -> Column:
    tried = candidates(v, path)
    if op == "$eq" and want is None:
        return F.exists(tried, _missing) | (F.size(tried) == 0)
    if op in ("$eq", "$gt", "$gte", "$lt", "$lte"):
        if isinstance(want, list):
            return F.exists(tried, lambda x: compared(x, op, want))
        return _any(v, path, lambda x: compared(x, op, want))
    if op in ("$ne", "$nin", "$not"):
        return ~{"$ne": lambda: _compared(v, path, "$eq", want), "$nin": lambda: _compared(v, path, "$in", want), "$not": lambda: _field(v, path, want)}[op]()
    if op == "$in":
        lists, others = [w for w in want if isinstance(w, list)], [w for w in want if not isinstance(w, list)]
        some = _any(v, path, lambda x: among(x, others)) if others else F.lit(False)
        if lists:
            some = some | F.exists(tried, lambda x: among(x, lists))
        return some | _compared(v, path, "$eq", None) if None in want else some
    if op == "$all":
        return reduce(lambda a, b: a & b, [_compared(v, path, "$eq", x) for x in want]) if want else F.lit(False)
    if op == "$exists":
        found = F.exists(values_at(v, path), lambda x: x.isNotNull())
        return found if want else ~found
    if op == "$size":
        return F.exists(values_at(v, path), lambda x: F.coalesce(F.size(F.try_variant_get(x, F.lit("$"), "array<struct<>>")), F.lit(-1)) == want)
    if op == "$elemMatch":
        return F.exists(values_at(v, path), lambda x: F.coalesce(F.exists(items(x), lambda e: _field(e, "", want)), F.lit(False)))
    if op == "$regex":
        return _any(v, path, lambda x: F.coalesce((kind_of(x) == "STR") & F.try_variant_get(x, F.lit("$"), "string").rlike(want), F.lit(False)))
    if op == "$type":
        return F.exists(tried, lambda x: x.isNotNull() & bracket(x).isin(*[_TYPES[t] for t in ([want] if isinstance(want, str) else want)]))
    raise ValueError(f"no such comparison: {op}")


def _field(v: Column, path: str, want: Any) -> Column:
    if isinstance(want, dict) and want and all(k.startswith("$") and k not in ("$and", "$or", "$nor", "$oid", "$date") and not k.startswith("$number") for k in want):
        return reduce(lambda a, b: a & b, [_compared(v, path, op, x) for op, x in want.items()])
    if isinstance(want, dict) and not path:
        return matches(v, want)
    return _compared(v, path, "$eq", want)


def matches(v: Column, query: dict[str, Any]) -> Column:
    """Whether a document matches a filter: a comparison holds if it holds for any element along its path.

    Values of different types are neither less nor greater; a missing field is like null. $elemMatch wants one
    element for all of its conditions.
    """
    tests = []
    for key, want in query.items():
        if key in ("$and", "$or", "$nor"):
            both = reduce((lambda a, b: a & b) if key == "$and" else (lambda a, b: a | b), [matches(v, q) for q in want])
            tests.append(~both if key == "$nor" else both)
        else:
            tests.append(_field(v, key, want))
    return F.coalesce(reduce(lambda a, b: a & b, tests, F.lit(True)), F.lit(False))


def _keys_of_value(x: Column) -> Column:
    """Encoded values that an index has of a value: of an array's elements, one of its own for an empty array."""
    return let(items(x), lambda of: F.when(F.size(of) == 0, F.array(F.lit(EMPTY))).when(of.isNotNull(), F.transform(of, encoded)).otherwise(F.array(encoded(x))))


def _keys_of(v: Column, path: str) -> Column:
    """Distinct encoded values that an index has of one field: those of null where there is none, and one of its own for an empty array."""
    found = F.array_distinct(F.flatten(F.transform(values_at(v, path), _keys_of_value)))
    return let(found, lambda some: F.when(F.size(some) == 0, F.array(F.lit(BRACKETS["null"]))).otherwise(some))


def _joined(part: Column) -> Callable[[Column], Column]:
    return lambda done: F.transform(part, lambda k: F.concat(done, F.array(k)))


def _combined(parts: list[Column]) -> Column:
    """All combinations of one key of each part, in order."""
    out = F.transform(parts[0], lambda k: F.array(k))
    for p in parts[1:]:
        out = F.flatten(F.transform(out, _joined(p)))
    return out


def _shared_head(paths: list[str]) -> str | None:
    """The first field that several paths go below, and none stops at."""
    heads = [p.split(".")[0] for p in paths]
    return next((h for h in heads if heads.count(h) > 1 and all("." in p for p, x in zip(paths, heads, strict=True) if x == h)), None)


def index_keys(v: Column, paths: list[str], sparse: bool = False) -> Column:
    """The keys that a document has in an index over these paths: arrays of encoded values, each once.

    An array on a path gives a key an element; fields of the same array of objects are taken of the same
    element. A sparse index has no key of a document that lacks all of its fields.
    """
    heads = [p.split(".")[0] for p in paths]
    head = _shared_head(paths)
    if head is not None:
        elements = let(F.try_variant_get(v, F.lit(f"$['{head}']"), "array<variant>"), lambda of: F.when(F.size(of) > 0, of).otherwise(F.array(field(v, head))))

        def of(e: Column) -> Column:
            return _combined([_keys_of(e, p.partition(".")[2]) if h == head else _keys_of(v, p) for p, h in zip(paths, heads, strict=True)])

        keys = F.array_distinct(F.flatten(F.transform(elements, of)))
    else:
        keys = _combined([_keys_of(v, p) for p in paths])
    if sparse:
        keys = F.when(_some_of(v, paths), keys).otherwise(F.expr("cast(array() AS array<array<string>>)"))
    return keys


def _some_of(v: Column, paths: list[str]) -> Column:
    """Whether a document has any of the fields."""
    return reduce(lambda a, b: a | b, [F.exists(values_at(v, p), lambda x: x.isNotNull()) for p in paths])


def _with_keys(docs: DataFrame, paths: list[str], sparse: bool, wanted: Column) -> DataFrame:
    """_of, keys: index_keys of docs (_of, _v) that are wanted, a row or more of each.

    What most documents hold, plain values of fields or of the objects of one array, is a column of its own and encoded
    by compiled code; lambda functions are interpreted, at some ten times the time. The rest goes through index_keys.
    """
    v, places = F.col("_v"), range(len(paths))
    head, names = _shared_head(paths), [p.partition(".")[2] for p in paths]
    wanted = wanted & _some_of(v, paths) if sparse else wanted
    if head is not None and all(p.startswith(f"{head}.") for p in paths) and "." not in "".join(names) and len({n.lower() for n in names}) == len(names):
        fields = ",".join(f"`{n.replace('`', '``')}`:variant" for n in names)
        docs = docs.select("_of", "_v", wanted.alias("_wanted"), F.try_variant_get(v, F.lit(f"$['{head}']"), f"array<struct<{fields}>>").alias("_e"))
        objects = F.coalesce((F.size("_e") > 0) & F.forall("_e", lambda e: e.isNotNull()), F.lit(False))
        docs = docs.select("_of", F.when(F.col("_wanted") & objects, F.col("_e")).alias("_e"), F.when(F.col("_wanted") & ~objects, index_keys(v, paths)).alias("_keys"))
        docs = docs.select("_of", "_keys", F.explode_outer("_e").alias("_e")).select("_of", "_keys", F.col("_e").isNotNull().alias("_wanted"), *[F.col("_e")[n].alias(f"_x{i}") for i, n in enumerate(names)])
        rest = F.when(F.col("_wanted"), _combined([F.array_distinct(_keys_of_value(F.col(f"_x{i}"))) for i in places])).otherwise(F.col("_keys"))
        carried = ["_of", "_keys", "_wanted"]
    else:
        direct = ["$" + "".join(f"['{n}']" for n in p.split(".")) for p in paths]
        docs = docs.select("_of", "_v", wanted.alias("_wanted"), *[F.try_variant_get(v, F.lit(d), "variant").alias(f"_x{i}") for i, d in enumerate(direct)])
        rest = F.when(F.col("_wanted"), index_keys(v, paths))
        carried = ["_of", "_v", "_wanted"]
    xs = [f"_x{i}" for i in places]
    docs = docs.select(*carried, *xs, *[F.to_json(x).alias(f"_j{i}") for i, x in enumerate(xs)])
    docs = docs.select(*carried, *xs, *[plainly_encoded(F.col(f"_j{i}")).alias(f"_p{i}") for i in places])
    plain = reduce(lambda a, b: a & b, [F.col(f"_p{i}").isNotNull() for i in places], F.col("_wanted"))
    docs = docs.select("_of", F.when(plain, F.array(F.array(*[F.col(f"_p{i}") for i in places]))).otherwise(rest).alias("keys"))
    # Outer, and filtered after it: a filter on the way in would have documents parsed and walked twice.
    return docs.select("_of", F.explode_outer("keys").alias("keys")).filter("keys IS NOT NULL")


def index_violations(rows: DataFrame, key: str, doc: str, paths: list[str], sparse: bool = False, partial: dict[str, Any] | None = None) -> DataFrame:
    """keys, n of index keys that more than one of the documents (key, doc: JSON) have; a unique index needs this to be empty."""
    wanted = F.lit(True) if partial is None else matches(F.col("_v"), partial)
    docs = rows.select(F.col(key).alias("_of"), F.parse_json(doc).alias("_v"))
    found = _with_keys(docs, paths, sparse, wanted).distinct()
    return found.groupBy("keys").agg(F.count("*").alias("n")).filter("n > 1")


def why_violated(rows: DataFrame, key: str, doc: str, index: Index) -> str | None:
    """Why documents (key, doc: JSON) do not allow a unique index, or None; its options may make it sparse or partial."""
    if not (index.unique or index.prepare_unique):
        return None
    options = dict(index.options)
    partial = options.get("partialFilterExpression")
    partial = json.loads(partial) if isinstance(partial, str) else partial
    twice = index_violations(rows, key, doc, [path for path, _ in index.keys], bool(options.get("sparse")), partial).limit(1).collect()
    return f"{twice[0].n} documents have the key {list(twice[0]['keys'])}" if twice else None


#: Bytes of extended values by their one field; of a whole number of 64 bits.
_EXTENDED = {"$oid": (12,), "$date": (8,), "$numberDouble": (8,), "$numberDecimal": (16,)}
_LONG = (8,)


def _octets(text: str) -> int:
    return len(text) if text.isascii() else len(text.encode("utf-8", "replace"))


def _value_size(x: Any) -> int:
    if isinstance(x, tuple):  # an object, by its size
        return x[0]
    if isinstance(x, str):
        return _octets(x) + 5
    if x is None or isinstance(x, bool):
        return int(x is not None)
    if isinstance(x, list):
        return 5 + sum(len(str(i)) + 2 + _value_size(e) for i, e in enumerate(x))
    return 4 if isinstance(x, int) and -(2**31) <= x < 2**31 else 8


def _object_size(pairs: list[tuple[str, Any]]) -> tuple[int]:
    """An object's size, as the parser hands over its fields; objects in it are sizes already."""
    if len(pairs) == 1 and pairs[0][0][:1] == "$":
        name, x = pairs[0]
        if name == "$numberLong" and isinstance(x, str):
            return _LONG
        if name in _EXTENDED and (isinstance(x, str) and (name != "$oid" or re.fullmatch("[0-9a-fA-F]{24}", x)) or name == "$date" and x is _LONG):
            return _EXTENDED[name]
    return (5 + sum(_octets(k) + 2 + _value_size(x) for k, x in pairs),)


def document_size(doc: Column) -> Column:
    """Bytes that a document (JSON text) takes in the database's binary form; null for null.

    A document is a length, its fields and an end; a field a type, its name with an end, and its value; an
    array is a document whose names are its places. Whole numbers take four bytes if they fit, else eight.
    """
    ship()

    @F.pandas_udf("bigint")
    def size(docs: pd.Series) -> pd.Series:
        read = json.JSONDecoder(object_pairs_hook=_object_size).decode
        return pd.Series([None if d is None else _value_size(read(d)) for d in docs], dtype="Int64")

    return size(doc)
