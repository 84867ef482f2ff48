import json
from pathlib import Path

import pytest

from rillstone.config import Options
from rillstone.functions.errors import CommandError
from rillstone.operators.catalog import NEVER_EXPIRES, OPTIONS_CONFLICT, Catalog, Index, Unsupported, collection_rows, index_rows, looked_up
from rillstone.operators.asof import as_of
from rillstone.operators.segments import LEAST_SEGMENT
from rillstone.session import shared_folder
from rillstone.sources.logs import EVENT_SCHEMA, HistoryLost, Lease, Stale, StateTable, from_start
from rillstone.streaming.replicate import TARGET, Replicator, State, apply_changes, histogram, retried
from rillstone.streaming.target import STORED, Target


def test_indexes_are_relaxed_and_restored():
    c = Catalog()
    c.create("shop", "bills", "u1")
    c.create_indexes("shop", "bills", [Index("_id_", (("_id", 1),)), Index("u", (("x", 1),), unique=True), Index("t", (("at", 1),), expire_after=60), Index("h", (("y", 1),), hidden=True)])
    own = c.collections["shop", "bills"].indexes
    assert set(own) == {"u", "t", "h"} and not own["u"].unique and own["t"].expire_after == NEVER_EXPIRES and not own["h"].hidden
    report = c.finalize(lambda ns, i: "duplicate" if i.name == "u" else None)
    assert report == [{"namespace": "shop.bills", "name": "u", "type": "failed", "reason": "duplicate"}]
    assert own["t"].expire_after == 60 and own["h"].hidden and not own["u"].unique and own["u"].unsuccessful


def test_conflicting_options_make_an_index_anew():
    c = Catalog()
    c.create("shop", "bills")
    c.create_indexes("shop", "bills", [Index("u", (("x", 1),), unique=True)])

    def conflict(ns, index):
        raise CommandError(OPTIONS_CONFLICT, "options")

    assert c.finalize(conflict) == [] and c.collections["shop", "bills"].indexes["u"] == Index("u", (("x", 1),), unique=True)


def test_schema_changes():
    c = Catalog()
    c.apply("create", "shop", "a", {"uuid": "1", "capped": True, "size": 1000})
    c.apply("modify", "shop", "a", {"cappedSize": 5001}, source_major=6)
    assert c.collections["shop", "a"].options["size"] == 5120
    assert c.apply("rename", "shop", "a", {"db": "shop", "coll": "b"})
    assert c.uuids() == {"1": ("shop", "b")} and c.name_of("1") == ("shop", "b") and c.name_of("2") is None
    assert not c.apply("rename", "shop", "gone", {"db": "shop", "coll": "b"})
    assert c.uuids() == {"1": ("shop", "b")}  # what has the name that a missing one should get stays
    assert c.apply("rename", "shop", "b", {"db": "shop", "coll": "b"}) and c.uuids() == {"1": ("shop", "b")}
    assert not c.apply("modify", "shop", "gone", {"cappedMax": 3})
    c.apply("dropIndexes", "shop", "b", {"indexes": [{"name": "none"}]})
    c.create("shop", "system.views")
    c.apply("create", "shop", "series", {"viewOn": "system.buckets.series"})
    assert set(c.collections) == {("shop", "b"), ("shop", "system.views")}
    for op in ("reshardCollection", "refineCollectionShardKey", "invalidate"):
        with pytest.raises(Unsupported):
            c.apply(op, "shop", "b", {})
    c.apply("shardCollection", "shop", "b", {"key": [["k", "hashed"]], "unique": True})
    again = Catalog.from_json(c.to_json())
    assert again.collections == c.collections and again.last_cid == c.last_cid
    c.apply("dropDatabase", "shop", None, {})
    assert set(c.collections) == {("shop", "system.views")}
    with pytest.raises(CommandError):
        c.spec("shop", "b")


def test_listings(spark):
    c = Catalog()
    c.create("shop", "bills", "u1")
    c.create("shop", "late", viewOn="bills")
    c.create_indexes("shop", "bills", [Index("n", (("no", 1),))])
    rows = collection_rows(spark, c)
    assert looked_up(rows, db="shop", name="late").type == "view"
    with pytest.raises(CommandError, match="nothing is named"):
        looked_up(rows, db="shop", name="none")
    assert [r.name for r in index_rows(spark, c).collect()] == ["n"]


COLUMNS = [f.split()[0] for f in ("seq t i op db coll collection_uuid txn_number lsid document_key full_document updated_fields removed_fields truncated_arrays op_desc disambiguated_paths").split()]


def _event(seq, t, op, key=None, doc=None, coll="c", **more):
    return dict.fromkeys(COLUMNS) | {"seq": seq, "t": t, "i": 1, "op": op, "db": "d", "coll": coll, "document_key": key, "full_document": doc and json.dumps(doc, separators=(",", ":"))} | more


def _update(seq, t, key, sets=(), unsets=(), cuts=(), **more):
    return _event(seq, t, "update", key, updated_fields=[(p, json.dumps(v)) for p, v in sets], removed_fields=list(unsets), truncated_arrays=list(cuts), **more)


def _log(spark, events):
    frame = spark.createDataFrame(events, EVENT_SCHEMA)
    return frame.withColumn("key", frame.document_key)


def _rows(frame):
    return {(x.coll, x.key): x.doc for x in frame.collect()}


def test_updates_apply_one_by_one_and_failed_ones_are_fetched(spark):
    target = spark.createDataFrame([("d", "c", k, "{}") for k in "abc"], TARGET)
    events = [_update(0, 1, "a", [("x", 1)]), _update(1, 2, "a", [("x.y", 1)]), _update(2, 3, "a", [("z", 3)]), _update(3, 4, "b", [("x", 1)], ["q"]), _update(4, 5, "c", [("x", 1)]), _update(5, 6, "c", [("x.y", 1)])]
    with pytest.raises(Exception, match="no source"):
        apply_changes(target, _log(spark, events)).collect()
    source = spark.createDataFrame([("d", "c", "a", '{"x":{"y":1},"w":0}')], TARGET)
    assert _rows(apply_changes(target, _log(spark, events), source)) == {("c", "a"): '{"x":{"y":1},"w":0,"z":3}', ("c", "b"): '{"x":1}'}


def test_fields_keep_the_order_of_their_writes(spark):
    target = spark.createDataFrame([("d", "c", "a", '{"a":1,"b":2}')], TARGET)
    events = [_update(0, 1, "a", [("c", 1), ("d", 1)]), _update(1, 2, "a", [], ["a", "c"]), _update(2, 3, "a", [("a", 9), ("b", 7)]), _update(3, 4, "a", [("c", 5)]), _update(4, 5, "a", [("a", 8)])]
    want = {("c", "a"): '{"b":7,"d":1,"a":8,"c":5}'}
    assert _rows(apply_changes(target, _log(spark, events))) == want
    events.append(_update(5, 6, "a", [("e.f", 1)]))  # the same one by one
    assert _rows(apply_changes(target, _log(spark, events))) == {("c", "a"): '{"b":7,"d":1,"a":8,"c":5,"e":{"f":1}}'}


def test_changes_are_folded_once(spark):
    target = spark.createDataFrame([("d", "c", "a", '{"v":1}'), ("d", "c", "b", '{"v":{"w":1}}')], TARGET)
    events = [_update(0, 1, "a", [("v", 2)]), _update(1, 2, "b", [("v.w", 3)])]
    log = _log(spark, events)
    out = apply_changes(target, log)
    assert _rows(out) == {("c", "a"): '{"v":2}', ("c", "b"): '{"v":{"w":3}}'}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert 0 < plan.count("LogicalRDD") + plan.count("LocalRelation") <= 3  # the log and the target; without tables on the way they were read 27 times


def test_replication(spark, tmp_path):
    log = str(tmp_path / "log")
    first = [
        _event(0, 10, "insert", "1", {"a": 1}),
        _update(1, 11, "1", [("b.c", 2)]),
        _event(2, 12, "replace", "2", {"never": 1}),
        _event(3, 13, "insert", "3", {"z": 1}, coll="hidden"),
        _event(4, 14, "insert", "9", {"old": 1}, coll="gone"),
        _event(5, 15, "drop", coll="gone"),
        _event(6, 16, "insert", "9", {"new": 1}, coll="gone"),
        _event(7, 17, "delete", "0"),
        _event(8, 17, "create", coll="series", op_desc=json.dumps({"viewOn": "system.buckets.series"})),
        _event(9, 18, "@tick", coll=None),
    ]
    spark.createDataFrame(first, EVENT_SCHEMA).coalesce(1).write.parquet(log)
    r = Replicator(spark, log, str(tmp_path / "target"), exclude=("d.hidden",))
    r.clone(spark.createDataFrame([("d", "c", "0", "{}"), ("d", "c", "5", '{"k":[1,2,3]}'), ("d", "hidden", "7", "{}")], TARGET), (9, 0))
    r.start()
    r.wait()
    rows = lambda: _rows(r.target.read())
    assert rows() == {("c", "1"): '{"a":1,"b":{"c":2}}', ("c", "5"): '{"k":[1,2,3]}', ("gone", "9"): '{"new":1}'}
    status = r.status((20, 0))
    assert status["initial_sync_completed"] and status["lag_seconds"] == 2 and status["checkpoint"] == (17, 1) and status["last_replicated"] == (18, 1)
    more = [
        _update(10, 18, "5", [("k.0", 7)], [], [("k", 2)]),
        _event(11, 19, "rename", coll="gone", op_desc=json.dumps({"db": "d", "coll": "kept"})),
        _event(12, 20, "rename", coll="missing", op_desc=json.dumps({"db": "d", "coll": "kept"})),
        _event(13, 21, "rename", coll="c", op_desc=json.dumps({"db": "d", "coll": "c"})),
        _event(14, 22, "insert", "4", {"s": 1}, coll="hidden"),
    ]
    spark.createDataFrame(more, EVENT_SCHEMA).coalesce(1).write.mode("append").parquet(log)
    r.resume()
    r.wait()
    assert rows() == {("c", "1"): '{"a":1,"b":{"c":2}}', ("c", "5"): '{"k":[7,2]}', ("kept", "9"): '{"new":1}'}
    assert r.status()["checkpoint"] == (22, 1)  # events that are left out move it, too
    before = rows()
    r.batch(spark.createDataFrame(more, EVENT_SCHEMA), 0)  # applied already
    assert rows() == before and r.finalize() == [] and r.state is State.FINALIZED
    with pytest.raises(RuntimeError):
        r.start()
    assert Replicator.recover(spark, log, str(tmp_path / "target")).state is State.FINALIZED


def test_a_batch_writes_in_proportion_to_itself(spark, tmp_path):
    r = Replicator(spark, str(tmp_path / "log"), str(tmp_path / "target"))
    pad = "x" * 200
    r.clone(spark.range(40_000).selectExpr("'d' AS db", "'c' AS coll", "cast(id AS string) AS key", f"concat('{{\"n\":', hash(id), ',\"p\":\"', sha2(cast(id AS string), 512), '{pad}\"}}') AS doc"), (1, 0))
    whole = r.target.state["runs"][0]["bytes"]
    rows = [_event(n, 2, "replace", str(n * 40), {"n": n}) for n in range(1000)]  # scattered over all keys
    tables = lambda: {p.name for p in Path(shared_folder(spark).removeprefix("file:"), "rillstone").glob("*")}
    before = tables()
    r.batch(spark.createDataFrame(rows, EVENT_SCHEMA), 0)
    runs = r.target.state["runs"]
    assert tables() == before  # what a batch writes on the way is gone
    assert [x["level"] for x in runs] == [0, 1] and runs[1]["bytes"] == whole and runs[0]["bytes"] < whole / 20
    assert r.target.read().count() == 40_000 and r.target.read().filter("length(doc) < 20").count() == 1000
    r.batch(spark.createDataFrame([_event(2000, 3, "drop")], EVENT_SCHEMA), 1)
    assert r.target.state["runs"] == runs and r.target.read().count() == 0  # a drop touches no row
    r.batch(spark.createDataFrame([_event(2001, 4, "insert", "7", {"n": 2})], EVENT_SCHEMA), 2)
    assert _rows(r.target.read()) == {("c", "7"): '{"n":2}'}


def test_a_clone_goes_on_after_a_failure(spark, tmp_path, monkeypatch):
    rows = [("d", "big", f"{n:04d}", json.dumps({"n": n, "p": "x" * 80})) for n in range(600)] + [("d", f"small{k}", "1", "{}") for k in range(5)]
    snapshot = spark.createDataFrame(rows, TARGET)
    r = Replicator(spark, "", str(tmp_path / "target"))
    load, calls = Target.load, []

    def fails(self, part, **state):
        calls.append(1)
        if len(calls) == 3:
            raise OSError("the machine is gone")
        load(self, part, **state)

    monkeypatch.setattr(Target, "load", fails)
    with pytest.raises(OSError):
        r.clone(snapshot, (5, 0), segment_bytes=10_000)
    assert not r.status()["initial_sync_completed"]
    again = Replicator.recover(spark, "", str(tmp_path / "target"), resume=False)
    plan = again.target.state["plan"]
    assert plan["done"] == 2 and len(plan["loads"]) > 4 and len(plan["loads"][-1]["names"]) == 5
    assert 0 < again.target.rows().count() < 600
    again.clone(snapshot, (5, 0), segment_bytes=10_000)
    assert len(calls) == 3 + len(plan["loads"]) - 2  # what was there is not copied again
    assert sorted((x.db, x.coll, x.key, x.doc) for x in again.target.read().collect()) == sorted(rows) and again.target.orphans() == []
    again.clone(spark.createDataFrame([("d", "big", "0001", "{}"), ("d", "new", "1", "{}")], TARGET), (6, 0))
    assert again.target.read().count() == len(rows) + 1 and again.target.state["clone"] == [6, 0]


def test_runs_are_merged_by_levels(spark, tmp_path):
    import random

    made = random.Random(5)
    r = Replicator(spark, str(tmp_path / "log"), str(tmp_path / "target"), bucket_bytes=2000, first_level=6000, ratio=3, fan=2)
    r.clone(spark.createDataFrame([("d", "c", str(n), json.dumps({"n": n})) for n in range(60)], TARGET), (1, 0))
    want, seq, deepest, split = {str(n): {"n": n} for n in range(60)}, 0, 0, False
    for number in range(5):
        events = []
        for _ in range(25):
            key, seq = str(made.randrange(120)), seq + 1
            op = made.choice(["insert", "replace", "delete", "update"])
            doc = {"s": seq}
            events.append(_update(seq, 2 + number, key, [("u", seq)]) if op == "update" else _event(seq, 2 + number, op, key, doc if op != "delete" else None))
            if op == "insert" or op == "replace" and key in want:
                want[key] = doc
            elif op == "delete":
                want.pop(key, None)
            elif op == "update" and key in want:
                want[key] = want[key] | {"u": seq}
        r.batch(spark.createDataFrame(events, EVENT_SCHEMA), number)
        assert {k: json.loads(d) for (_, k), d in _rows(r.target.read()).items()} == want
        runs = r.target.state["runs"]
        levels = [x["level"] for x in runs]
        assert levels == sorted(levels) and levels.count(0) < 2 and all(levels.count(k) < 2 for k in levels)
        deepest, split = max(deepest, *levels), split or any(x["bits"] for x in runs)
    assert deepest > 1 and split and r.target.orphans() == []
    again = Replicator.recover(spark, str(tmp_path / "log"), str(tmp_path / "target"), resume=False)
    assert {k: json.loads(d) for (_, k), d in _rows(again.target.read()).items()} == want


def test_of_two_writers_the_stale_one_fails(spark, tmp_path):
    path = str(tmp_path / "target")
    first, second = (Target(spark, path) for _ in range(2))
    rows = lambda k: spark.createDataFrame([(1, k, "{}", None, False)], f"{STORED}, gone boolean")
    first.commit(rows("a"))
    with pytest.raises(Stale):
        second.commit(rows("b"))
    second.refresh()
    second.commit(rows("b"))
    assert sorted(x.key for x in Target(spark, path).rows().collect()) == ["a", "b"] and second.orphans() == []
    later = Target(spark, path)
    later.epoch = 3  # of a later lease
    later.commit()
    second.refresh()
    with pytest.raises(Stale, match="epoch"):
        second.commit(rows("c"))
    assert Target(spark, path).rows().count() == 2


def test_the_lease_is_beaten_beside_a_batch(spark, tmp_path):
    import time

    table = StateTable(spark, str(tmp_path / "lease"))
    a, b = Lease(table, "a"), Lease(table, "b")
    a.BEAT = b.BEAT = 0.2
    a.STALE = b.STALE = 1.0
    a.acquire()
    with a.beating():
        time.sleep(1.6)  # longer than a beat lasts
        with pytest.raises(RuntimeError, match="holds"):
            b.acquire()
    time.sleep(1.1)
    with pytest.raises(RuntimeError, match="lost"), a.beating():
        table.write({"owner": "b", "beat": time.time() + 60, "epoch": 9})
        time.sleep(1.1)
    assert a.epoch == 1
    with pytest.raises(RuntimeError):
        a.beat()


def test_as_of(spark):
    from pyspark.sql import functions as F

    rows = [("hot", n) for n in range(0, 3000, 3)] + [("b", n) for n in range(40)] + [("none", 5)] + [("b", 7)] * 2
    changes = [("hot", n, n) for n in range(100, 3000, 700)] + [("b", 7, 70), ("b", 20, 200), ("other", 1, 1), ("hot", 1700, None)]
    got = as_of(spark.createDataFrame(rows, "g string, at long").withColumn("x", F.lit(1)), spark.createDataFrame(changes, "g string, at long, v long"), ["g"], "at", "v", slices=9).collect()
    last = lambda g, at: max(((c[1], c[2]) for c in changes if c[0] == g and c[1] < at), default=(0, None))[1]
    assert sorted((r.g, r.at, r.v if r.v is not None else -1) for r in got) == sorted((g, at, last(g, at) if last(g, at) is not None else -1) for g, at in rows)
    assert all(r.x == 1 for r in got)


def test_schema_changes_and_events_of_one_batch(spark, tmp_path):
    """Collections that events make, drop and rename in turn, by name and by uuid, in one batch and one event a batch."""
    import random

    made = random.Random(3)
    for turn in range(1):
        events, t = [], 10
        for n in range(60):
            t += 1
            coll, to = made.choice("abc"), made.choice("abc")
            kind = made.choice(["insert"] * 5 + ["delete", "replace", "drop", "rename", "create"])
            uid = made.choice([None, None, "u" + coll])
            if kind == "rename":
                events.append(_event(n, t, "rename", coll=coll, op_desc=json.dumps({"db": "d", "coll": to})))
            elif kind == "create":
                events.append(_event(n, t, "create", coll=coll, collection_uuid="u" + coll, op_desc="{}"))
            elif kind == "drop":
                events.append(_event(n, t, "drop", coll=coll))
            else:
                events.append(_event(n, t, kind, str(made.randrange(6)), {"n": n} if kind != "delete" else None, coll=coll, collection_uuid=uid))
        results = []
        for name, size in (("one", len(events)), ("each", 12)):
            r = Replicator(spark, "", str(tmp_path / f"{name}{turn}"), fan=3)
            for k in range(0, len(events), size):
                r.batch(spark.createDataFrame(events[k : k + size], EVENT_SCHEMA), k)
            results.append(_rows(r.target.read()))
        assert results[0] == results[1]


def test_events_follow_the_uuid_of_their_collection(spark, tmp_path):
    r = Replicator(spark, str(tmp_path / "log"), str(tmp_path / "target"))
    r.clone(spark.createDataFrame([("d", "c", "1", '{"n":0}')], TARGET), (1, 0), specs={("d", "c"): {"uuid": "ab"}})
    r.lease.acquire()
    to = json.dumps({"db": "d", "coll": "e"})
    r.batch(spark.createDataFrame([_event(0, 2, "rename", op_desc=to), _event(1, 3, "replace", "1", {"n": 1}, collection_uuid="ab"), _event(2, 4, "insert", "1", {"n": 9}, collection_uuid="cd")], EVENT_SCHEMA), 0)
    assert _rows(r.target.read()) == {("e", "1"): '{"n":1}', ("c", "1"): '{"n":9}'}


def test_a_document_that_moves_between_shards_stays_one(spark, tmp_path):
    r = Replicator(spark, str(tmp_path / "log"), str(tmp_path / "target"))
    r.clone(spark.createDataFrame([("d", "c", '{"k":1,"_id":5}', '{"_id":5,"k":1}')], TARGET), (1, 0))
    r.lease.acquire()
    r.batch(spark.createDataFrame([_event(0, 2, "insert", '{"k":2,"_id":5}', {"_id": 5, "k": 2})], EVENT_SCHEMA), 0)
    assert _rows(r.target.read()) == {("c", '{"k":2,"_id":5}'): '{"_id":5,"k":2}'}


def test_capped_collections_keep_the_order_of_insertion(spark, tmp_path):
    r = Replicator(spark, str(tmp_path / "log"), str(tmp_path / "target"))
    r.lease.acquire()
    made = _event(0, 1, "create", op_desc=json.dumps({"capped": True, "max": 3}))
    r.batch(spark.createDataFrame([made, *[_event(1 + n, 2, "insert", k, {"n": n}) for n, k in enumerate("zyxwv")], _event(9, 3, "replace", "y", {"n": 99})], EVENT_SCHEMA), 0)
    assert [x.key for x in r.target.natural("d", "c").collect()] == ["x", "w", "v"]


def test_failure_and_restart(spark, tmp_path):
    """A stream that fails, and a new process that goes on from the target's state."""
    log, path = str(tmp_path / "log"), str(tmp_path / "target")
    index = {"name": "u", "keys": [["x", 1]], "unique": True}
    events = [_event(0, 10, "insert", "1", {"x": 1}), _event(1, 11, "insert", "2", {"x": 1}), _event(2, 12, "createIndexes", op_desc=json.dumps({"indexes": [index]})), _update(3, 13, "1", [("x.y", 1)])]
    spark.createDataFrame(events, EVENT_SCHEMA).coalesce(1).write.parquet(log)
    now = [0.0]
    r = Replicator(spark, log, path, clock=lambda: now[0])
    r.clone(spark.createDataFrame([], TARGET), (9, 0))
    r.start()
    other = Replicator(spark, log, path, clock=lambda: now[0])
    with pytest.raises(RuntimeError, match="lease"):
        other.start()
    with pytest.raises(Exception, match="no source"):
        r.wait()
    assert r.state is State.FAILED and r.target.read().count() == 0
    del r
    source = spark.createDataFrame([("d", "c", "1", '{"x":{"y":1}}')], TARGET)
    again = Replicator.recover(spark, log, path, source=source, clock=lambda: now[0])
    assert again.state is State.FAILED and "no source" in again.error
    with pytest.raises(RuntimeError):
        again.start()
    again.start(from_failure=True)
    again.wait()
    assert _rows(again.target.read()) == {("c", "1"): '{"x":{"y":1}}', ("c", "2"): '{"x":1}'}
    # A process that dies while running is followed by one that runs on.
    again.start()
    again.wait()
    again.state = State.RUNNING
    again._save()
    third = Replicator.recover(spark, log, path, source=source, clock=lambda: now[0])
    third.wait()
    spark.createDataFrame([_event(4, 14, "replace", "1", {"x": 1})], EVENT_SCHEMA).coalesce(1).write.mode("append").parquet(log)
    third.resume()
    third.wait()
    report = third.finalize()
    assert [(x["namespace"], x["name"], x["type"]) for x in report] == [("d.c", "u", "failed")] and "1" in report[0]["reason"]


def test_an_idle_stream_ticks(spark, tmp_path):
    import time

    log = str(tmp_path / "log")
    spark.createDataFrame([_event(0, 10, "insert", "1", {"x": 1})], EVENT_SCHEMA).coalesce(1).write.parquet(log)
    r = Replicator.of(spark, log, str(tmp_path / "target"), Options.resolve({"exclude": ("d.hidden",)}, {}), source_time=lambda: (77, 0))
    assert r.exclude == ("d.hidden",) and r.segment_bytes == LEAST_SEGMENT
    r.start(once=False)
    until = time.time() + 90
    while r.target.state.get("reported") != [77, 0] and time.time() < until:
        time.sleep(0.5)
    r.pause()
    status = r.status((80, 0))
    assert status["last_replicated"] == (77, 0) and status["checkpoint"] == (10, 1) and status["lag_seconds"] == 3
    assert r.metrics().first()["count"] >= 2 and _rows(r.target.read()) == {("c", "1"): '{"x":1}'}


def test_lost_history(spark, tmp_path):
    log = spark.createDataFrame([_event(0, 10, "insert", "1")], EVENT_SCHEMA)
    assert from_start(log, 10, 1).count() == 1
    with pytest.raises(HistoryLost):
        from_start(log, 9, 0)
    log.write.parquet(str(tmp_path / "log"))
    r = Replicator(spark, str(tmp_path / "log"), str(tmp_path / "target"), begins=(10, 0))
    r.clone(spark.createDataFrame([], TARGET), (9, 0))
    with pytest.raises(HistoryLost):
        r.start()


def test_state_table(spark, tmp_path):
    s = StateTable(spark, str(tmp_path / "state"))
    assert s.read() is None
    s.write({"a": 1})
    s.write({"a": 2})
    assert s.read() == {"a": 2}
    s.reset()
    assert s.read() is None


def test_histogram_and_retries(spark):
    row = histogram(spark.createDataFrame([(0.002,), (0.3,), (9.0,)], "v double"), "v").first()
    assert row["le_0.005"] == 1 and row["le_0.5"] == 2 and row["le_5"] == 2 and row["count"] == 3
    calls = []

    def fails():
        calls.append(1)
        raise OSError

    with pytest.raises(OSError):
        retried(fails, tries=3, wait=0)
    assert len(calls) == 3
