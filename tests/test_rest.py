import json
import os

import numpy as np
import pytest
from numpy.testing import assert_array_equal

import hypercell
from hypercell import Table, config, ms_descriptor, settings
from hypercell.errors import InvalidTable
from hypercell.operators.export import export, read_dataset
from hypercell.operators.merge import merge_np_partitions
from hypercell.operators.rows import runs
from hypercell.operators.table import create
from hypercell.plans.taql import QueryError
from hypercell.sources import descriptor as D

COLUMNS = {
    "FIELD_ID": [0, 0, 0, 1, 1, 1, 1, 2, 2, 2],
    "DATA_DESC_ID": [0, 0, 0, 0, 0, 0, 0, 1, 1, 1],
    "SCAN_NUMBER": [0, 1, 0, 1, 0, 1, 0, 1, 0, 1],
    "ANTENNA1": [0, 0, 1, 1, 1, 2, 1, 0, 0, 1],
    "ANTENNA2": [1, 2, 2, 3, 2, 1, 0, 1, 1, 2],
    "PROCESSOR_ID": [0] * 10,
}


@pytest.fixture(scope="module")
def sorting(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("s") / "sorting.ms")
    t = create(spark, path, {c: D.column("int") for c in COLUMNS} | {"TIME": D.column("double")})
    t.addrows(10)
    for c, v in COLUMNS.items():
        t.putcol(c, np.array(v, np.int32))
    t.putcol("TIME", np.array([1.0, 0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2, 0.1]))
    return path


def test_order(sorting):
    """Rising and falling keys; equal ones keep the rows' order."""
    q = Table.from_taql(f"SELECT ROWID() AS R FROM {sorting} ORDER BY SCAN_NUMBER DESC, FIELD_ID")
    assert q.getcol("R").tolist() == [1, 3, 5, 7, 9, 0, 2, 4, 6, 8]
    q = Table.from_taql(f"SELECT ROWID() AS R FROM {sorting} ORDER BY ANTENNA2, TIME DESC")
    assert q.getcol("R").tolist() == [6, 0, 5, 7, 8, 1, 2, 4, 9, 3]


def test_groups(sorting):
    q = Table.from_taql(f"SELECT ANTENNA1, ANTENNA2, GROWID() AS ROW, GAGGR(TIME) AS TIME, GAGGR(FIELD_ID) AS FIELD_ID, GAGGR(SCAN_NUMBER) AS SCAN FROM {sorting} GROUPBY ANTENNA1, ANTENNA2")
    got = q.to_arrow().to_pylist()
    assert [(r["ANTENNA1"], r["ANTENNA2"]) for r in got] == [(0, 1), (0, 2), (1, 2), (1, 3), (2, 1), (1, 0)]
    assert got[0] == {"ANTENNA1": 0, "ANTENNA2": 1, "ROW": [0, 7, 8], "TIME": [1.0, 0.3, 0.2], "FIELD_ID": [0, 2, 2], "SCAN": [0, 1, 0]}
    assert got[2]["ROW"] == [2, 4, 9] and got[2]["SCAN"] == [0, 0, 1]


def test_table_argument(sorting):
    with hypercell.table(sorting) as t, Table.from_taql("SELECT TIME, ANTENNA1, ANTENNA2, ROWID() AS ROW FROM $1 ORDER BY TIME, ANTENNA1, ANTENNA2", [t]) as q:
        got = q.to_arrow()
        assert got["ROW"].to_pylist() == list(range(9, -1, -1))
        assert got["ANTENNA1"].to_pylist() == [1, 0, 0, 1, 2, 1, 1, 1, 0, 0]
        assert got["ANTENNA2"].to_pylist() == [2, 1, 1, 0, 1, 2, 3, 2, 2, 1]
        assert q.getcol("ROW", ([0, 9],)).tolist() == [9, 0]


def test_more_queries(sorting):
    def rows(query, *tables):
        return [tuple(r.values()) for r in Table.from_taql(query, list(tables)).to_arrow().to_pylist()]

    assert rows(f"SELECT ANTENNA1 FROM {sorting} WHERE TIME > 0.85 || FIELD_ID == 2 LIMIT 3") == [(0,), (0,), (0,)]
    assert rows(f"SELECT DISTINCT FIELD_ID FROM {sorting} ORDER BY FIELD_ID DESC") == [(2,), (1,), (0,)]
    assert rows(f"SELECT FIELD_ID, GCOUNT() AS N, GMAX(ANTENNA2) AS M FROM {sorting} GROUPBY FIELD_ID HAVING GCOUNT() > 3") == [(1, 4, 3)]
    assert rows(f"SELECT -ANTENNA2 + 2 * 3 AS X FROM {sorting} WHERE ROWID() IN [0, 3] ORDERBY X") == [(3,), (5,)]
    assert rows(f"SELECT GSUM(FIELD_ID) AS S FROM [SELECT FIELD_ID FROM {sorting} WHERE FIELD_ID BETWEEN 1 AND 2]") == [(10,)]
    assert rows(f"SELECT a.TIME FROM {sorting} a JOIN $1 b ON a.TIME = b.TIME WHERE b.FIELD_ID = 0 AND NOT a.ANTENNA1 = 1", hypercell.table(sorting)) == [(1.0,), (0.9,)]
    assert rows(f"SELECT ANTENNA1 FROM {sorting} ORDER BY TIME LIMIT 2 OFFSET 1") == [(0,), (0,)]


@pytest.mark.parametrize("query", ["SELEC x", "SELECT FROM", "SELECT a FROM $2", "SELECT NOPE FROM $1", "SELECT TIME FROM $1 WHERE (", "SELECT UNHEARD(TIME) AS x FROM $1", "SELECT TIME FROM $1 LIMIT x", "SELECT TIME, TIME FROM $1"])
def test_bad_queries(sorting, query):
    with pytest.raises(QueryError):
        Table.from_taql(query, [hypercell.table(sorting)])


def test_changes_by_query(spark, tmp_path):
    p = str(tmp_path / "q")
    Table.from_taql(f"CREATE TABLE {p} [A I4, B R8, S S] LIMIT 5", spark=spark)
    Table.from_taql(f"UPDATE {p} SET A = ROWID(), B = A + 0.5, S = 'x' WHERE ROWID() < 4")
    assert hypercell.table(p).getcol("A").tolist() == [0, 1, 2, 3, 0]
    assert hypercell.table(p).getcol("B").tolist() == [0.5, 0.5, 0.5, 0.5, 0.0]
    Table.from_taql(f"DELETE FROM {p} WHERE A = 1")
    assert hypercell.table(p).getcol("A").tolist() == [0, 2, 3, 0]
    made = Table.from_taql(f"SELECT A FROM {p} ORDER BY A DESC GIVING {p}2")
    assert made.getcol("A").tolist() == [3, 2, 0, 0] and hypercell.table(f"{p}2").nrow() == 4


@pytest.mark.parametrize("n,chunk", [(100, 33), (125, 42)])
def test_merge(spark, n, chunk):
    rng = np.random.default_rng(42)
    parts = []
    for a in range(0, n, chunk):
        m = min(chunk, n - a)
        p = {"DDID": rng.integers(0, 10, m).astype(np.int32), "TIME": rng.integers(0, 10, m) / 2.0, "A1": rng.integers(0, 10, m).astype(np.int64), "W": rng.random(m).astype(np.float32)}
        o = np.lexsort(list(p.values())[::-1])
        parts.append({k: v[o] for k, v in p.items()})
    got = merge_np_partitions(parts, spark)
    whole = {k: np.concatenate([p[k] for p in parts]) for k in parts[0]}
    o = np.lexsort(list(whole.values())[::-1])
    for k, v in whole.items():
        assert_array_equal(got[k], v[o])
        assert got[k].dtype == v.dtype


def test_merge_errors(spark):
    a = np.zeros(3)
    assert merge_np_partitions([], spark) == {}
    for bad in ([{"x": a.reshape(3, 1)}], [{"x": a, "y": np.zeros(2)}], [{"x": a}, {"x": a, "y": a}], [{"x": a}, {"x": a.astype(np.int32)}], [{"x": a.astype(np.int16)}]):
        with pytest.raises(InvalidTable):
            merge_np_partitions(bad, spark)


def test_config():
    assert list(config) == sorted(config)
    with pytest.raises(KeyError):
        config["missing"]
    config["a.b"] = "1"
    with settings(**{"a.b": "2", "c": "3"}):
        assert (config["a.b"], config["c"]) == ("2", "3")
        with settings(**{"a.b": "4"}):
            assert config["a.b"] == "4"
        assert config["a.b"] == "2"
    assert config["a.b"] == "1" and "c" not in config
    with pytest.raises(RuntimeError), settings(**{"a.b": "9"}):
        raise RuntimeError
    assert config["a.b"] == "1"
    del config["a.b"]
    assert config.get("a.b") is None
    with pytest.raises(TypeError):
        config["x"] = 1


def test_descriptors(spark, tmp_path):
    w = ms_descriptor("weather")
    assert D.columns(w) == ["ANTENNA_ID", "INTERVAL", "TIME"]
    assert w["TIME"]["keywords"] == {"QuantumUnits": ["s"], "MEASINFO": {"Ref": "UTC", "type": "epoch"}}
    assert len(D.columns(ms_descriptor("WEATHER", True))) == 19
    assert len(D.columns(ms_descriptor("MAIN"))) == 21 and len(D.SUBTABLES) == 17
    with pytest.raises(InvalidTable):
        ms_descriptor("NOTHING")
    ms = str(tmp_path / "t.ms")
    with Table.ms_from_descriptor(ms, spark=spark) as t:
        assert not os.path.exists(f"{ms}/WEATHER") and os.path.exists(f"{ms}/ANTENNA")
        assert "WEATHER" not in t.tabledesc()["_keywords_"]
    desc = ms_descriptor("WEATHER")
    desc["BLAH"] = dict(desc["TIME"])
    with Table.ms_from_descriptor(ms, "WEATHER", desc, spark=spark) as t:
        assert t.columns() == ["ANTENNA_ID", "BLAH", "INTERVAL", "TIME"]
    assert hypercell.table(ms).tabledesc()["_keywords_"]["WEATHER"] == f"Table: {ms}/WEATHER"
    with hypercell.table(f"{ms}::WEATHER") as t:
        assert t.nrow() == 0
        t.addrows(3)
        assert t.getcol("TIME").tolist() == [0, 0, 0]


def test_export(spark, sorting, tmp_path):
    out = str(tmp_path / "out")
    assert export(spark, sorting, out, ["FIELD_ID", "DATA_DESC_ID"], 2) == ["MAIN"]
    found = [os.path.join(d, f) for d, _, names in os.walk(out) for f in names if f.endswith(".parquet")]
    assert all("FIELD_ID=" in f and "DATA_DESC_ID=" in f for f in found) and len(found) >= 5
    got = read_dataset(spark, f"{out}/MAIN")
    assert got.count() == 10 and got.where("FIELD_ID = 1").count() == 4
    assert "PartitionFilters" in got.where("FIELD_ID = 1")._jdf.queryExecution().toString()
    assert sorted(r["TIME"] for r in got.where("TIME > 0.25 and TIME < 0.65").collect()) == [0.3, 0.4, 0.5, 0.6]


def test_runs(spark):
    ids = [0, 1, 2, 5, 6, 9, *range((1 << 20) - 3, (1 << 20) + 4), *range((1 << 21), (1 << 21) + 2)]
    got = sorted((r["start"], r["stop"], r["n"]) for r in runs(spark.createDataFrame([(i,) for i in ids], "__row__ long")).collect())
    assert got == [(0, 2, 3), (5, 6, 2), (9, 9, 1), ((1 << 20) - 3, (1 << 20) + 3, 7), (1 << 21, (1 << 21) + 1, 2)]
    assert runs(spark.createDataFrame([], "__row__ long")).collect() == []


def test_stream_appends_once(spark, tmp_path):
    from hypercell.streaming.append import append_to

    p, src = str(tmp_path / "st"), str(tmp_path / "src")
    create(spark, p, {"A": D.column("int64"), "B": D.column("double")})
    spark.range(5).selectExpr("id AS A", "id * 0.5D AS B").write.parquet(src)
    stream = spark.readStream.schema("A long, B double").parquet(src)
    for _ in range(2):
        q = append_to(stream, p, ["A"]).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
        q.awaitTermination()
    assert hypercell.table(p).getcol("A").tolist() == [0, 1, 2, 3, 4]


def test_stream_survives_a_crash_anywhere(spark, tmp_path, monkeypatch):
    """A batch whose writer stops before, while or after its data are written is appended once when it is repeated."""
    from hypercell.sources.storage import Store
    from hypercell.streaming.append import append_to

    p, src = str(tmp_path / "st"), str(tmp_path / "src")
    create(spark, p, {"A": D.column("int64")})
    spark.range(4).selectExpr("id AS A").write.parquet(src)
    stream = spark.readStream.schema("A long").parquet(src)

    def go():
        append_to(stream, p, ["A"]).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start().awaitTermination()

    publish = Store._publish
    for stop in ("before", "after"):

        def broken(self, *a, stop=stop):
            if stop == "after":
                publish(self, *a)
            raise OSError("stopped")

        monkeypatch.setattr(Store, "_publish", broken)
        with pytest.raises(Exception, match="stopped"):
            go()
        monkeypatch.setattr(Store, "_publish", publish)
        assert hypercell.table(p).getcol("A").tolist() == ([] if stop == "before" else [0, 1, 2, 3])
    go()
    assert hypercell.table(p).getcol("A").tolist() == [0, 1, 2, 3]
