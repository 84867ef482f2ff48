import random

from rillstone.operators import fold

SCHEMA = "key long, `order` struct<ts:long,event_id:long>, op string, value double, field string"


def _sequential(events):
    live = {}
    for key, order, op, value, _ in sorted(events, key=lambda e: e[1]):
        if op == "insert" or op == "replace" and key in live:
            live[key] = [value, 0, value]
        elif op == "update" and key in live:
            live[key][1] += 1
            live[key][2] = value
        elif op == "delete":
            live.pop(key, None)
    return {k: tuple(v) for k, v in live.items()}


def test_state_is_the_sequential_fold(spark):
    rng = random.Random(5)
    events = [(rng.randrange(60), (i // 3, i), rng.choice(["insert", "replace", "update", "update", "delete"]), float(i), "f") for i in range(600)]
    got = {r.key: (r.base_value, r.n_deltas, r.last_value) for r in fold.state(spark.createDataFrame(events, SCHEMA)).collect()}
    assert got == _sequential(events)


def test_every_handover_from_snapshot_to_log_agrees(spark):
    rng = random.Random(6)
    events = [(rng.randrange(8), (i, i), rng.choice(["insert", "delete", "replace"]), float(i), "f") for i in range(40)]
    whole = {k: v[0] for k, v in _sequential(events).items()}
    for cut in (0, 13, 27, 40):
        snapshot = [(k, (0, 0), "x", v[0], "f") for k, v in _sequential(events[:cut]).items()]
        log = fold.with_snapshot(spark.createDataFrame(events[cut:], SCHEMA), spark.createDataFrame(snapshot, SCHEMA))
        assert {r.key: r.base_value for r in fold.state(log).collect()} == whole


def test_empty_log(spark):
    assert fold.state(spark.createDataFrame([], SCHEMA)).count() == 0


def test_epochs_and_tail(spark):
    rows = spark.createDataFrame([(i, i // 4, i % 3 == 0) for i in range(12)], "i long, day long, ddl boolean")
    got = {r.i: r.epoch for r in fold.epochs(rows, rows.ddl, ["i"]).collect()}
    assert got == {i: i // 3 + 1 for i in range(12)}
    assert sorted((r.day, r.i) for r in fold.tail(rows, "day", ["i"], 1).collect()) == [(0, 3), (1, 7), (2, 11)]
