"""What the operators share: the shared folder, size-checked joins, word expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship, shared_folder, written  # noqa: F401

#: White space that separates words, as a Java and RE2 character class.
WS = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Rows up to which a side is broadcast; rows of such sides are a few hundred bytes at most.
BROADCAST_ROWS = 50_000
#: Bytes of a batch that goes to Python, one row at least.
BATCH_BYTES = 16 << 20


def attach(big: DataFrame, small: DataFrame, keys: list[str], how: str = "left", rows: int = BROADCAST_ROWS) -> DataFrame:
    """big joined with small, a written table; small is broadcast only if it has few rows.

    Beyond that it is a plain join of two exchanges, whose hot keys adaptive execution splits.
    """
    few = small.limit(rows + 1).count() <= rows
    return big.join(F.broadcast(small) if few else small, keys, how)


def words(text: Column) -> Column:
    """Array of the words of a text; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WS), "")


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def for_python(spark: SparkSession, rows: int = 500) -> None:
    """Sends this package to Python workers and keeps Arrow batches small: texts may be long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    ship(spark)
