"""Selection of namespaces by lists of `db`, `db.coll` and `db.*`."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SYSTEM_DATABASES = ("admin", "config", "local")
#: Where the engine keeps its own state; never selected.
STATE_DATABASE = "rillstone_state"


@dataclass(frozen=True)
class Selection:
    """Whole databases, and collections by database; a bare `db` names the collection of an empty name."""

    whole: frozenset[str] = frozenset()
    named: dict[str, frozenset[str]] = field(default_factory=dict)

    @classmethod
    def of(cls, entries: Iterable[str]) -> Selection:
        """Once a database is whole, its other entries add nothing."""
        whole: set[str] = set()
        named: dict[str, set[str]] = {}
        for entry in entries:
            db, _, coll = entry.partition(".")
            if coll == "*":
                whole.add(db)
            else:
                named.setdefault(db, set()).add(coll)
        return cls(frozenset(whole), {db: frozenset(c) for db, c in named.items() if db not in whole})

    def __bool__(self) -> bool:
        return bool(self.whole or self.named)

    def has(self, db: Column, coll: Column) -> Column:
        tests = [db.isin(*sorted(self.whole))] if self.whole else []
        tests += [(db == d) & coll.isin(*sorted(c)) for d, c in sorted(self.named.items())]
        return F.coalesce(reduce(lambda a, b: a | b, tests, F.lit(False)), F.lit(False))


def selected(db: Column, coll: Column, include: Iterable[str] = (), exclude: Iterable[str] = ()) -> Column:
    """Excluded is never selected; with an include list only what it has is."""
    wanted, unwanted = Selection.of(include), Selection.of(exclude)
    return (wanted.has(db, coll) if wanted else F.lit(True)) & ~unwanted.has(db, coll)


def selected_by_join(rows: DataFrame, lists: DataFrame, rows_limit: int = 10_000) -> DataFrame:
    """The same for long lists: lists has kind (include, exclude), db, coll (* for all)."""

    sizes = {r.kind: r["count"] for r in lists.groupBy("kind").count().collect()}  # two kinds

    def having(frame: DataFrame, kind: str, how: str) -> DataFrame:
        if not sizes.get(kind):
            return frame
        own = lists.filter(F.col("kind") == kind).select(F.col("db").alias("_db"), F.col("coll").alias("_coll")).distinct()
        own = F.broadcast(own) if sizes[kind] <= rows_limit else own
        return frame.join(own, (F.col("db") == F.col("_db")) & ((F.col("_coll") == "*") | (F.col("coll") == F.col("_coll"))), how)

    return having(having(rows, "exclude", "left_anti"), "include", "left_semi")


def user_databases(db: Column) -> Column:
    return ~db.isin(*SYSTEM_DATABASES, STATE_DATABASE)


def user_collections(name: Column) -> Column:
    return ~name.rlike(r"^system\.")


def is_timeseries(view_on: Column) -> Column:
    return F.coalesce(F.startswith(view_on, F.lit("system.buckets.")), F.lit(False))
