import json

import pytest

from rillstone.operators.delta import apply_delta, applied, compile_delta, with_delta


def _ops(steps):
    return [(s["step"], s["op"], s["path"]) for s in steps]


def test_plain_deltas_are_one_update():
    assert _ops(compile_delta([("price", "1"), ("owner.name", "2")], ["note"], [("rows", 3)])) == [(0, "set", "price"), (0, "set", "owner.name"), (0, "unset", "note"), (0, "truncate", "rows")]


def test_conflicts_follow():
    got = _ops(compile_delta([("rows.2", "1"), ("price", "2")], ["rows.0.tag", "note"], [("rows", 3)]))
    assert got == [(0, "truncate", "rows"), (0, "unset", "note"), (0, "set", "price"), (1, "set", "rows.2"), (2, "unset", "rows.0.tag")]
    assert {s["step"] for s in compile_delta([("rowspan", "1")], [], [("rows", 3)])} == {0}  # no prefix of path segments
    assert {s["step"] for s in compile_delta([("a", "1")], [], [("a.rows", 3)])} == {0}  # a parent of the array


def test_follow_ups_are_bounded():
    many = compile_delta([(f"rows.{i}", "1") for i in range(330)], [], [("rows", 1)])
    assert max(s["step"] for s in many) == 4
    assert [s["path"] for s in many if s["op"] == "set"] == [f"rows.{i}" for i in range(330)]
    large = compile_delta([(f"rows.{i}", json.dumps("y" * 30_000)) for i in range(60)], [], [("rows", 1)])
    assert max(s["step"] for s in large) >= 3


@pytest.mark.parametrize(
    "doc, path, value, want",
    [
        ({"bin": {"3": "oats"}}, "bin.3", "rye", {"bin": {"3": "rye"}}),
        ({"bin": ["oats", "hay"]}, "bin.1", "rye", {"bin": ["oats", "rye"]}),
        ({"bin": {"1": ["oats", "hay"]}}, "bin.1.0", 5, {"bin": {"1": [5, "hay"]}}),
        ({"bin": [7, {"1": "oats"}]}, "bin.1.1", "rye", {"bin": [7, {"1": "rye"}]}),
        ({"k": 1}, "bin.2", "x", {"k": 1, "bin": {"2": "x"}}),
        ({"bin": ["oats"]}, "bin.2", 4, {"bin": ["oats", None, 4]}),
        ({"bin": [[1], [2]]}, "bin.1.0", 9, {"bin": [[1], [9]]}),
    ],
)
def test_set_by_path(doc, path, value, want):
    got, ok = apply_delta(json.dumps(doc), [{"step": 0, "op": "set", "path": path, "value": json.dumps(value)}])
    assert ok and json.loads(got) == want


def test_unset_and_truncate():
    doc = json.dumps({"bin": [1, 2, 3], "lid": {"a": 1, "b": 2}})
    steps = [{"step": 0, "op": "unset", "path": "lid.a", "value": None}, {"step": 0, "op": "truncate", "path": "bin", "value": "2"}, {"step": 0, "op": "unset", "path": "bin.0", "value": None}, {"step": 0, "op": "unset", "path": "no.thing", "value": None}]
    assert apply_delta(doc, steps) == ('{"bin":[null,2],"lid":{"b":2}}', True)


def test_failing_delta_leaves_the_document():
    doc = json.dumps({"lid": 1, "bin": [1]})
    for op, path in (("set", "lid.b"), ("truncate", "lid"), ("truncate", "none.here"), ("set", "bin.x")):
        assert apply_delta(doc, [{"step": 0, "op": op, "path": path, "value": "1"}]) == (doc, False)


def test_in_dataframes(spark):
    rows = spark.createDataFrame([('{"rows":[4,5,6],"note":1}', [("rows.1", "9")], ["note"], [("rows", 2)])], "doc string, u array<struct<path:string,value:string>>, r array<string>, t array<struct<field:string,new_size:int>>")
    compiled = with_delta(rows, "u", "r", "t")
    got = compiled.select(applied(compiled.doc, compiled.steps).alias("x")).first().x
    assert got.ok and json.loads(got.doc) == {"rows": [4, 9]}
