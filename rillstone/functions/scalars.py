"""Scalar functions on columns: hashes, logical times, paths, arrays, versions, sizes."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Offset and prime of the 32-bit FNV-1a hash.
FNV_OFFSET, FNV_PRIME = 2166136261, 16777619
MAX_INCREMENT = (1 << 32) - 1


def fnv1a(text: Column) -> Column:
    """32-bit FNV-1a of a string's UTF-8 bytes, as a bigint."""
    hexed = F.hex(F.encode(text, "UTF-8"))
    steps = F.when(F.length(hexed) > 0, F.sequence(F.lit(1), F.length(hexed) - 1, F.lit(2))).otherwise(F.array().cast("array<int>"))
    byte = lambda i: F.conv(F.substr(hexed, i, F.lit(2)), 16, 10).cast("bigint")
    return F.aggregate(steps, F.lit(FNV_OFFSET).cast("bigint"), lambda h, i: (h.bitwiseXOR(byte(i)) * F.lit(FNV_PRIME)).bitwiseAND(F.lit(MAX_INCREMENT)))


def route(key: Column, workers: int) -> Column:
    """The worker of a key."""
    return (fnv1a(key) % workers).cast("bigint")


def logical_time(t: Column, i: Column) -> Column:
    """Seconds and increment; structs compare field by field."""
    return F.struct(t.cast("bigint").alias("t"), i.cast("bigint").alias("i"))


def predecessor(ts: Column) -> Column:
    """The greatest logical time before ts; zero stays zero."""
    t, i = ts["t"], ts["i"]
    return F.when(i > 0, logical_time(t, i - 1)).when(t > 0, logical_time(t - 1, F.lit(MAX_INCREMENT))).otherwise(logical_time(F.lit(0), F.lit(0)))


def seconds(ts: Column) -> Column:
    """Epoch seconds of a timestamp without time zone."""
    return F.timestamp_diff("SECOND", F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'"), ts)


def rfc3339(t: Column) -> Column:
    """Epoch seconds as text, in UTC whatever the session's zone."""
    return F.date_format(F.timestamp_add("SECOND", t, F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'")), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def namespace(db: Column, coll: Column) -> Column:
    return F.concat_ws(".", db, coll)


def split_namespace(ns: Column) -> Column:
    """db and coll of `db.coll`, cut at the first dot; null without one."""
    at = F.instr(ns, ".")
    return F.when(at > 0, F.struct(F.substr(ns, F.lit(1), at - 1).alias("db"), F.substr(ns, at + 1, F.length(ns)).alias("coll")))


def path_conflicts(path: Column, truncated: Column) -> Column:
    """Whether path is one of the truncated arrays' paths or lies within one."""
    return F.exists(truncated, lambda p: (path == p) | F.startswith(path, F.concat(p, F.lit("."))))


def truncated(array: Column, size: Column | int) -> Column:
    size = size if isinstance(size, Column) else F.lit(size)
    return F.slice(array, F.lit(1), size)


def sliced(array: Column, n: int, count: int | None = None) -> Column:
    """The document database's slice: the first n, the last -n, or count from position n (clamped at the start)."""
    if count is None:
        return F.slice(array, F.lit(1), F.lit(n)) if n >= 0 else F.slice(array, F.greatest(F.size(array) + n, F.lit(0)) + 1, F.lit(-n))
    start = F.lit(n) if n >= 0 else F.greatest(F.size(array) + n, F.lit(0))
    return F.slice(array, start + 1, F.lit(count))


def pulled(array: Column, values: Sequence) -> Column:
    """array without elements equal to any of values."""
    return F.filter(array, lambda x: ~x.isin(*values))


def aligned(size: Column, step: int = 256) -> Column:
    """size rounded up to a multiple of step."""
    return F.floor((size + (step - 1)) / step).cast("bigint") * step


def parse_version(text: str) -> tuple[int, int, int, int]:
    """MAJOR.MINOR.PATCH[-BUILD] as numbers; a build that is missing is 0."""
    m = re.fullmatch(r"(\d+)\.(\d+)\.(\d+)(?:-(\d+))?(?:-.*)?", text)
    if not m:
        raise ValueError(f"not a version: {text!r}")
    return tuple(int(x or 0) for x in m.groups())


def compatible(source: str, target: str) -> bool:
    """A target of an older major version than the source is refused."""
    return parse_version(target)[0] >= parse_version(source)[0]


def version_parts(text: Column) -> Column:
    """major, minor, patch and build of a version's text (see parse_version), null if it is none."""
    pattern = r"^(\d+)\.(\d+)\.(\d+)(?:-(\d+))?(?:-.*)?$"
    part = lambda i: F.coalesce(F.nullif(F.regexp_extract(text, pattern, i), F.lit("")).cast("int"), F.lit(0))
    return F.when(text.rlike(pattern), F.struct(*[part(i).alias(n) for i, n in enumerate(("major", "minor", "patch", "build"), 1)]))


def hexed(data: Column) -> Column:
    """Lower-case hexadecimal text of bytes or of a text's UTF-8."""
    return F.lower(F.hex(data))


def key_json(*fields: Column) -> Column:
    """Ordered JSON of a document key; fields that are missing stand as null."""
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def byte_size(text: Column) -> Column:
    """The same as parse_bytes, of a column; null for what is no size."""
    pattern = r"^\s*(\d+(?:\.\d+)?)\s*([kmgtKMGT]?)([iI]?)[bB]?\s*$"
    power = F.instr(F.lit(" kmgt"), F.lower(F.regexp_extract(text, pattern, 2))) - 1
    power = F.when(F.regexp_extract(text, pattern, 2) == "", 0).otherwise(power)
    base = F.when(F.regexp_extract(text, pattern, 3) == "", 1000.0).otherwise(1024.0)
    return F.when(text.rlike(pattern), F.floor(F.regexp_extract(text, pattern, 1).cast("double") * F.pow(base, power)).cast("bigint"))


def parse_bytes(text: str) -> int:
    """Sizes like 500MB (powers of ten) or 1GiB (powers of two); plain numbers are bytes."""
    m = re.fullmatch(r"\s*(\d+(?:\.\d+)?)\s*([kmgt]?)(i?)b?\s*", text, re.I)
    if not m:
        raise ValueError(f"not a size: {text!r}")
    power = " kmgt".index(m[2].lower() or " ")
    return int(float(m[1]) * (1024 if m[3] else 1000) ** power)


def bounded_size(text: str, least: int, most: int) -> int:
    """A size within bounds; 0 stands for automatic."""
    size = parse_bytes(text)
    if size and not least <= size <= most:
        raise ValueError(f"{text} is not within {least} and {most} bytes")
    return size
