"""A training corpus in five stages: quality, lines, near duplicates, mixture, sequences.

Every stage takes rows of documents with any columns, of any names, of which doc_id, text, lang and source
count. Rows are told apart by a hash of id and text; repeated rows are judged alike and all go on, but
where a stage says otherwise. A null text is an empty one, a text of any length is worked on whole, and an
empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillstone.llm import jaccard_join, line_dedup, mixing, packing, quality_rules
from rillstone.llm.common import for_python, written


def _keyed(docs: DataFrame) -> DataFrame:
    """key, and the row as one column, so that no name clashes."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    return docs.select(F.xxhash64("doc_id", "text").alias("key"), row)


def _matched(docs: DataFrame, rows: DataFrame, how: str) -> DataFrame:
    """Joined by key. rows grows with docs, so both are shuffled at every size: nothing is broadcast."""
    return _keyed(docs).join(rows.hint("merge"), "key", how)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep; those of null, empty and very short texts go."""
    judged = quality_rules.judge(docs.select(F.xxhash64("doc_id", "text").alias("doc_id"), "text", "lang", "source"))
    rejected = written(judged.filter("NOT kept").select(F.col("doc_id").alias("key")).distinct(), "rejected")
    return _matched(docs, rejected, "left_anti").select("row.*")


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that stand, or nearly stand, in earlier ones; those left without words go.

    Of repeated rows the first stays.
    """
    rest = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("row")
    left = line_dedup.remove_near_lines(docs.select("doc_id", "text", rest)).filter("n_removed = 0 OR n_removed < n_lines")
    new = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return left.select(*[new[c].alias(c) if c in new else F.col(f"row.`{c}`") for c in docs.columns])


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, 5-word sets of similarity 0.8 or more, that of the least id; null is the last."""
    found = jaccard_join.near_duplicates(docs, k=5, percent=80).groupBy("group").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row_key")).alias("first"), F.count("*").alias("n"))
    stay = written(found.select(F.col("first.row_key").alias("key"), "n"), "stay")
    out = _matched(docs, stay.select("key"), "left_semi")
    repeated = not stay.filter("n > 1").isEmpty() and not _keyed(docs).groupBy("key").count().filter("count > 1").isEmpty()
    return (out.dropDuplicates(["key"]) if repeated else out).select("row.*")


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mixture uses it; those without words are not used."""
    mixed = mixing.mix(mixing.measured(docs.select(F.xxhash64("doc_id", "text").alias("doc_id"), "text", "source")))
    uses = written(mixed.filter("taken > 0").groupBy(F.col("doc_id").alias("key")).agg(F.max(F.expr("taken div size")).cast("int").alias("uses")), "uses")
    out = _matched(docs, uses, "inner").select("row", F.explode(F.sequence(F.lit(1), F.col("uses"))).alias("use"))
    return out.select("row.*")


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 4096 tokens."""
    import public_tokenizers

    for_python(spark)
    return packing.pack_documents(docs, str(public_tokenizers.path("word_bpe_49k.json")))


STAGES = [("quality rules", quality), ("line dedup", lines), ("n-gram Jaccard join", near), ("source mixing", mixture), ("packing", sequences)]

#: Tokenizers cannot be expressed in SQL; tests/llm/test_pipeline.py holds every stage to SQL or brute force on its own input.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; the others' are written to the shared folder on the way."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
