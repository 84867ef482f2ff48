import pytest
from pyspark.sql import functions as F

from rillstone.operators.namespaces import selected, selected_by_join

WANTED, UNWANTED = ["farm.*", "mill.flour", "mill.bran"], ["farm.barn", "mill.*", "quay.boats"]
CASES = [
    ([], [], "anything", "at all", True),
    (WANTED, [], "farm", "silo", True),
    (WANTED, [], "mill", "bran", True),
    (WANTED, [], "mill", "wheel", False),
    (WANTED, [], "quay", "boats", False),
    ([], UNWANTED, "farm", "barn", False),
    ([], UNWANTED, "farm", "silo", True),
    ([], UNWANTED, "mill", "wheel", False),
    ([], UNWANTED, "dock", "boats", True),
    (WANTED, UNWANTED, "farm", "silo", True),
    (WANTED, UNWANTED, "farm", "barn", False),
    (WANTED, UNWANTED, "mill", "flour", False),
    (WANTED, UNWANTED, "quay", "nets", False),
    (["mill"], [], "mill", "", True),
    (["mill"], [], "mill", "flour", False),
    (["mill."], [], "mill", "flour", False),
    (["mill.flour.fine"], [], "mill", "flour.fine", True),
    (["mill.bran", "mill.*"], [], "mill", "oats", True),
    (["mill.*", "mill.bran"], [], "mill", "oats", True),
    (["mill.*"], ["mill.oats"], "mill", "oats", False),
]


@pytest.mark.parametrize("include, exclude, db, coll, want", CASES)
def test_selected(spark, include, exclude, db, coll, want):
    assert spark.range(1).select(selected(F.lit(db), F.lit(coll), include, exclude)).first()[0] is want


@pytest.mark.parametrize("include, exclude", [(WANTED, UNWANTED), ([], UNWANTED), (WANTED, []), ([], [])])
def test_join_form_agrees(spark, include, exclude):
    rows = spark.createDataFrame([(d, c) for d in ("farm", "mill", "quay", "dock") for c in ("barn", "flour", "bran", "boats")], "db string, coll string")
    lists = spark.createDataFrame([(k, *e.split(".")) for k, es in (("include", include), ("exclude", exclude)) for e in es], "kind string, db string, coll string")
    want = rows.filter(selected(F.col("db"), F.col("coll"), include, exclude)).collect()
    assert sorted(selected_by_join(rows, lists).collect()) == sorted(want)
