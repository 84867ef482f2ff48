import os

import duckdb
import pytest

from rillstone.config import Options
from rillstone.functions.errors import error_class, is_benign, is_transient
from rillstone.plans import catalogue
from rillstone.sources.logs import Lease, StateTable, key_of

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def test_options_precedence():
    env = {"RILLSTONE_READ_WORKERS": "3", "RILLSTONE_INCLUDE": "a.*,b.c"}
    o = Options.resolve({"read_workers": 7}, env)
    assert o.read_workers == 7 and o.include == ("a.*", "b.c")
    assert Options.resolve({}, env).automatic(16) == {"parallel_collections": 2, "read_workers": 3, "insert_workers": 32, "apply_workers": 16}
    for bad in ({"nope": 1}, {"segment_size": "1MB"}, {"read_workers": -1}):
        with pytest.raises(ValueError):
            Options.resolve(bad, {})


def test_errors():
    assert error_class(11000) == "duplicate_key" and error_class(1) is None
    assert is_benign(26) and not is_benign(11000) and is_transient(91) and is_transient(None, ("NetworkError",))


def test_keys():
    assert key_of({"_id": 1}, ("k",)) == '{"_id":1,"k":null}' and key_of({"_id": "é"}) == '{"_id":"é"}'


def test_lease(spark, tmp_path):
    now = [0.0]
    table = StateTable(spark, str(tmp_path / "lease"))
    a, b = (Lease(table, n, lambda: now[0]) for n in "ab")
    a.acquire()
    with pytest.raises(RuntimeError):
        b.acquire()
    now[0] = 40.0
    b.acquire()
    with pytest.raises(RuntimeError):
        a.beat()
    b.release()
    a.acquire()


def _rows(frame):
    frame = frame[sorted(frame.columns)].astype(object)
    return sorted(repr(tuple(float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else v for v in row)) for row in frame.where(frame.notna(), None).itertuples(index=False, name=None))


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for f in os.listdir(SF):
        path = f"{SF}/{f}"
        con.sql(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    return con


@pytest.mark.parametrize("name", list(catalogue.QUERIES))
def test_query_equals_its_sql(spark, db, name):
    assert _rows(catalogue.QUERIES[name](spark, SF).toPandas()) == _rows(db.sql(catalogue.ORACLES[name]).df())
