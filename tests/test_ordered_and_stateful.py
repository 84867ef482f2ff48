"""The ordered source and the stateful fold, each held to a plain way."""

import json
import random
import time

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from rillstone.sources.logs import EVENT_SCHEMA, TICK, stream_log
from rillstone.sources.ordered import stream_ordered
from rillstone.streaming.replicate import apply_changes
from rillstone.streaming.stateful import Folded, stateful

KEYS = ("db", "coll", "key")


def event(n, t, op, key, doc=None, sets=(), unsets=(), cuts=(), i=0):
    row = dict.fromkeys(c.split(" ")[0] for c in EVENT_SCHEMA.replace("array<struct<path:string,value:string>>", "x").replace("array<struct<field:string,new_size:int>>", "x").replace("map<string,array<string>>", "x").split(", "))
    return row | {"seq": n, "t": t, "i": i, "op": op, "db": "d", "coll": "c", "document_key": key, "full_document": json.dumps(doc) if doc is not None else None, "updated_fields": list(sets), "removed_fields": list(unsets), "truncated_arrays": list(cuts)}


def write(spark, path, rows, files=1):
    spark.createDataFrame(rows, EVENT_SCHEMA).repartitionByRange(files, "t", "i", "seq").write.mode("append").parquet(path)


def drained(stream, path, checkpoint):
    query = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def test_resume_in_the_middle_of_a_file(spark, tmp_path):
    log, out, at = (str(tmp_path / n) for n in ("log", "out", "checkpoint"))
    write(spark, log, [event(n, 100 + n // 3, "insert", str(n), {"n": n}, i=n % 3) for n in range(60)])
    drained(stream_ordered(spark, log, start=(106, 1)), out, at)
    read = lambda: sorted(r.seq for r in spark.read.parquet(out).collect())
    assert read() == list(range(19, 60))
    write(spark, log, [event(n, 100 + n // 3, "insert", str(n), {"n": n}, i=n % 3) for n in range(60, 90)], files=3)
    drained(stream_ordered(spark, log, start=(106, 1)), out, at)
    assert read() == list(range(19, 90))
    row = spark.read.parquet(out).filter("seq = 61").first()
    assert (row.t, row.i, row.op, row.full_document, row.disambiguated_paths) == (120, 1, "insert", '{"n": 61}', None)


def test_lost_history(spark, tmp_path):
    log = str(tmp_path / "log")
    write(spark, log, [event(n, 100 + n, "delete", str(n)) for n in range(5)])
    for options in ({"start": (99, 0)}, {"start": (102, 0), "begins": (103, 0)}):
        with pytest.raises(StreamingQueryException, match="the log begins at"):
            drained(stream_ordered(spark, log, **options), str(tmp_path / "out"), str(tmp_path / f"c{len(options)}"))
    drained(stream_ordered(spark, log, start=(100, 0)), str(tmp_path / "out2"), str(tmp_path / "c3"))
    assert spark.read.parquet(str(tmp_path / "out2")).count() == 5


def test_bounded_batches_and_ticks(spark, tmp_path):
    log, seen = str(tmp_path / "log"), []
    write(spark, log, [event(n, 100 + n // 2, "insert", str(n), {}) for n in range(10)])
    stream = stream_ordered(spark, log, events=12, ticks=1)
    query = stream.writeStream.foreachBatch(lambda rows, n: seen.append(sorted((r.t, r.op) for r in rows.select("t", "op").collect()))).option("checkpointLocation", str(tmp_path / "c")).trigger(processingTime="200 milliseconds").start()
    wait = lambda done: [time.sleep(0.2) for _ in range(300) if query.isActive and not done()]
    try:
        wait(lambda: [(104, TICK)] in seen)
        for a in (10, 20, 30):
            write(spark, log, [event(n, 100 + n // 2, "insert", str(n), {}) for n in range(a, a + 10)])
        wait(lambda: any((119, "insert") in b for b in seen))
    finally:
        query.stop()
    assert query.exception() is None and [(104, TICK)] in seen
    events = [[x for x in b if x[1] != TICK] for b in seen]
    assert sorted(x for b in events for x in b) == sorted((100 + n // 2, "insert") for n in range(40))
    assert all(len(b) <= 12 for b in events)
    firsts = [b[0][0] for b in events if b]
    assert firsts == sorted(firsts)


def made(seed, n, start=0):
    """A log of few keys with all kinds of writes, none of which fails."""
    r = random.Random(seed)
    rows = []
    for k in range(start, start + n):
        key, op = str(r.randrange(6)), r.choice(["insert", "replace", "delete", "update", "update", "update", "update"])
        sets, unsets, cuts = [], [], []
        if op == "update":
            what = r.randrange(4)
            if what == 0:
                sets = [{"path": r.choice(["a", "o.x", "o.y", "o"]), "value": str(k)}]
                sets = [s | {"value": json.dumps({"x": k})} if s["path"] == "o" else s for s in sets]
            elif what == 1:
                unsets = [r.choice(["a", "o.x"])]
            elif what == 2:
                cuts = [{"field": "l", "new_size": r.randrange(3)}]
            else:
                sets = [{"path": f"l.{r.randrange(4)}", "value": str(k)}]
        rows.append(event(k, 100 + k, op, key, {"o": {"x": 0}, "l": [1, 2, 3]} if op in ("insert", "replace") else None, sets, unsets, cuts))
    return rows


def folded(rows):
    return {r.key: json.loads(r.doc) for r in rows.collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_stateful_fold_equals_apply_changes_and_goes_on(spark, tmp_path, seed):
    log = str(tmp_path / "log")
    snapshot = spark.createDataFrame([("d", "c", str(k), '{"o":{"x":9},"l":[0]}') for k in range(3, 8)], "db string, coll string, key string, doc string")
    table = Folded(spark, str(tmp_path / "folded"))
    every = []
    for part in range(2):
        rows = made(seed * 10 + part, 80, part * 80)
        every += rows
        write(spark, log, rows, files=2)
        stream = stream_ordered(spark, log).withColumnRenamed("document_key", "key")
        table.start(stateful(stream, KEYS, snapshot)).awaitTermination()
        plain = apply_changes(snapshot, spark.createDataFrame(every, EVENT_SCHEMA).withColumnRenamed("document_key", "key"))
        left = snapshot.join(table.spark.read.parquet(f"{table.path}/rows"), list(KEYS), "left_anti")
        now = table.read()
        assert now.filter("failed").isEmpty()
        assert folded(now.select("key", "doc").union(left.select("key", "doc"))) == folded(plain)


def test_failed_write_is_told_and_mended_by_the_next_document(spark, tmp_path):
    log, table = str(tmp_path / "log"), Folded(spark, str(tmp_path / "folded"))
    bad = [event(0, 100, "insert", "1", {"n": 1}), event(1, 101, "update", "1", sets=[{"path": "n.x", "value": "2"}]), event(2, 101, "update", "2", sets=[{"path": "n", "value": "2"}])]
    for rows, failed in ((bad, True), ([event(3, 102, "replace", "1", {"m": 1})], False)):
        write(spark, log, rows)
        table.start(stateful(stream_ordered(spark, log).withColumnRenamed("document_key", "key"))).awaitTermination()
        (row,) = table.read().collect()
        assert (row.key, row.failed) == ("1", failed)
    assert row.doc == '{"m": 1}'


@pytest.mark.parametrize("forget", [1, 10**9])
def test_deleted_keys_are_remembered_for_a_while(spark, tmp_path, forget):
    log, table = str(tmp_path / "log"), Folded(spark, str(tmp_path / "folded"))
    old = event(0, 100, "insert", "1", {})
    for rows in ([old, event(1, 101, "delete", "1")], [event(2, 102, "insert", "2", {})], [old]):
        write(spark, log, rows)
        table.start(stateful(stream_log(spark, log).withColumnRenamed("document_key", "key"), forget=forget)).awaitTermination()
        time.sleep(0.1)
    assert sorted(r.key for r in table.read().collect()) == (["1", "2"] if forget == 1 else ["2"])
