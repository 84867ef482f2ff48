"""Many updates of one key."""

from pyspark.sql import functions as F

from rillstone.streaming.replicate import TARGET, apply_changes


def test_more_updates_of_a_key_than_an_int_of_ten_thousands_counts(spark):
    n = 215_000
    log = spark.range(1, n + 1).select(
        F.lit("d").alias("db"), F.lit("c").alias("coll"), F.lit("k").alias("key"), F.col("id").alias("t"), F.lit(0).cast("long").alias("i"), F.lit(0).cast("long").alias("seq"),
        F.lit("update").alias("op"), F.lit(None).cast("string").alias("full_document"), F.array(F.struct(F.lit("a").alias("path"), F.col("id").cast("string").alias("value"))).alias("updated_fields"),
        F.lit(None).cast("array<string>").alias("removed_fields"), F.lit(None).cast("array<struct<field:string,new_size:int>>").alias("truncated_arrays"),
    )
    target = spark.createDataFrame([("d", "c", "k", "{}")], TARGET)
    assert apply_changes(target, log).first().doc == f'{{"a":{n}}}'
