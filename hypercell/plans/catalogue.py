"""Registered queries over the driver's tables, each beside its SQL."""

from __future__ import annotations

import json
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hypercell.errors import InvalidTable
from hypercell.functions import ndexpr as N
from hypercell.functions.selection import normalise
from hypercell.operators import export, merge
from hypercell.operators.rows import POS, runs
from hypercell.operators.table import Table, create, write_table
from hypercell.sources import descriptor as D
from hypercell.sources.descriptor import ROW
from hypercell.sources.storage import scratch

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}

#: Columns of the tables that number their rows from 0.
ROW_OF = {"orders": "o_orderkey", "events": "event_id", "embeddings": "vec_id", "customer": "c_custkey", "documents": "doc_id"}


def register(sql: str | None = None):
    def add(f):
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _table(spark: SparkSession, sf_dir: str, name: str, desc: dict | None = None) -> Table:
    df = _read(spark, sf_dir, name)
    row = ROW_OF[name]
    return Table(spark, df.withColumn(ROW, F.col(row).cast("long")), desc or D.of_schema(df.schema))


# -- scans -------------------------------------------------------------------------------------------------------------


def _stored(spark, df: DataFrame, row: str, desc: dict | None = None, path: str | None = None) -> Table:
    """A DataFrame written as a table with all its columns, and opened."""
    return write_table(df.withColumn("at", F.col(row)), path or scratch(spark, "table"), desc, row="at")


@register("SELECT * FROM lineitem")
def scan_all(spark, sf_dir):
    df = _read(spark, sf_dir, "lineitem")
    return Table(spark, df, D.of_schema(df.schema), order=[F.col(c) for c in df.columns]).scan()


@register("SELECT event_id, ts, event_type, value FROM events")
def open_stored(spark, sf_dir):
    t = _stored(spark, _read(spark, sf_dir, "events").drop("props"), "event_id")
    return Table.from_filename(t.name(), spark=spark).scan(["event_id", "ts", "event_type", "value"])


@register("SELECT n_nationkey, n_name FROM nation")
def open_subtable(spark, sf_dir):
    main = _stored(spark, _read(spark, sf_dir, "region"), "r_regionkey").name()
    _stored(spark, _read(spark, sf_dir, "nation"), "n_nationkey", path=f"{main}/NATION")
    with Table.from_filename(f"{main}::NATION", spark=spark) as t:
        return t.scan(["n_nationkey", "n_name"])


@register("SELECT vec_id, label FROM embeddings")
def scan_without_mixed_ranks(spark, sf_dir):
    """Cells of one and of two dimensions in a column leave it out of a scan."""
    df = _read(spark, sf_dir, "embeddings").withColumn("mixed", F.when(F.col("vec_id") % 2 == 0, F.struct(F.array(F.lit(64)).alias("shape"), F.col("embedding").alias("data"))).otherwise(F.struct(F.array(F.lit(8), F.lit(8)).alias("shape"), F.col("embedding").alias("data"))))
    desc = {"vec_id": D.column("int64"), "label": D.column("int"), "mixed": D.column("float", -1), **{k: {} for k in D.TABLE_KEYS}}
    return Table.from_dataframe(df.drop("embedding"), desc, row="vec_id").scan()


@register("SELECT name, value_type, ndim, size FROM (VALUES ('embedding', 'float', 1, 64), ('label', 'int', NULL, NULL), ('vec_id', 'int64', NULL, NULL)) t(name, value_type, ndim, size)")
def descriptor_metadata(spark, sf_dir):
    """Descriptors that Arrow results carry, of the table and of each column."""
    t = _vectors(spark, sf_dir)
    got = t.to_arrow([slice(0, 3)])
    rows = [(f.name, d["valueType"], d.get("ndim"), (d.get("shape") or [None])[0]) for f in got.schema for d in [json.loads(f.metadata[b"descriptor"])]]
    return spark.createDataFrame(rows, "name string, value_type string, ndim int, size int")


@register("SELECT o_orderkey, o_totalprice FROM orders")
def scan_project(spark, sf_dir):
    return _table(spark, sf_dir, "orders").select(columns=["o_orderkey", "o_totalprice"]).select("o_orderkey", "o_totalprice")


@register('SELECT c_custkey AS "row", c_name, c_custkey - 10 AS pos FROM customer WHERE c_custkey BETWEEN 10 AND 19')
def row_slice(spark, sf_dir):
    got = _table(spark, sf_dir, "customer").select([slice(10, 20)], ["c_name"])
    return got.select(F.col(ROW).alias("row"), "c_name", F.col(POS).alias("pos"))


_WANTED = [97, 3, 55, 4, 0, 141]


@register(f"SELECT p.pos, o_orderkey, o_totalprice FROM orders JOIN (VALUES {', '.join(f'({r}, {i})' for i, r in enumerate(_WANTED))}) p(k, pos) ON o_orderkey = p.k")
def row_gather_order(spark, sf_dir):
    got = _table(spark, sf_dir, "orders").select([_WANTED], ["o_orderkey", "o_totalprice"])
    return got.select(F.col(POS).cast("int").alias("pos"), "o_orderkey", "o_totalprice")


@register("SELECT CAST(count(*) AS BIGINT) AS n_rows, 5 AS n_columns FROM customer")
def row_count(spark, sf_dir):
    t = _table(spark, sf_dir, "customer")
    return t.df.agg(F.count("*").alias("n_rows"), F.lit(t.ncolumns()).alias("n_columns"))


@register("SELECT name, value_type, CAST(ndim AS INTEGER) AS ndim, CASE WHEN name = 'embedding' THEN [64] END AS shape, '' AS comment, CAST(NULL AS VARCHAR[]) AS units FROM (VALUES ('embedding', 'float', 1), ('label', 'int', NULL), ('vec_id', 'int64', NULL)) t(name, value_type, ndim)")
def describe(spark, sf_dir):
    return _vectors(spark, sf_dir).describe()


@register("SELECT * FROM (VALUES ('closed', true), ('closed again', false), ('read after close', true)) t(step, said)")
def close_table(spark, sf_dir):
    t = _table(spark, sf_dir, "customer")
    return spark.createDataFrame([("closed", t.close()), ("closed again", t.close()), ("read after close", _refused(t.nrow, InvalidTable))], "step string, said boolean")


def _refused(f: Callable, *errors: type) -> bool:
    try:
        f()
    except errors:
        return True
    return False


@register("SELECT * FROM (VALUES ('twice the same', true), ('beyond the cell', true), ('beyond the table', true), ('in range', false), ('negative', false), ('empty list', false)) t(index, refused)")
def index_errors(spark, sf_dir):
    t = _vectors(spark, sf_dir)
    n = t.nrow()
    cases = {
        "twice the same": ([1, 1],),
        "beyond the cell": ([0], [64]),
        "beyond the table": ([n],),
        "in range": ([n - 1], [63]),
        "negative": ([0, -1], [-1, 3]),
        "empty list": ([], [5]),
    }
    return spark.createDataFrame([(k, _refused(lambda i=i: t.cells("embedding", i).foreach(lambda r: None), Exception)) for k, i in cases.items()], "index string, refused boolean")


@register("SELECT vec_id, CAST(embedding[6] AS DOUBLE) AS v FROM embeddings")
def empty_list_selects_all(spark, sf_dir):
    got = _vectors(spark, sf_dir).cells("embedding", ([], [5]))
    return got.select(F.col(ROW).alias("vec_id"), F.get("cell", F.lit(0)).cast("double").alias("v"))


@register("""
SELECT r, c, CASE WHEN r = 1 OR c = 1 THEN -1.0 ELSE CAST((SELECT embedding[CASE c WHEN 0 THEN 8 ELSE 3 END] FROM embeddings WHERE vec_id = CASE r WHEN 0 THEN 5 ELSE 2 END) AS DOUBLE) END AS v
FROM (SELECT unnest(range(3)) AS r) CROSS JOIN (SELECT unnest(range(3)) AS c)""")
def getcol_result(spark, sf_dir):
    """Elements put into an array that keeps what skipped rows and places had."""
    out = _vectors(spark, sf_dir).getcol("embedding", ([5, -1, 2], [7, -1, 2]), result=np.full((3, 3), -1, np.float32))
    return spark.createDataFrame([(r, c, float(out[r, c])) for r in range(3) for c in range(3)], "r long, c long, v double")


@register("SELECT doc_id, CASE WHEN l.doc_id IS NULL THEN -5 ELSE q END AS v FROM documents d LEFT JOIN (SELECT doc_id, min(quality) AS q FROM labels GROUP BY doc_id) l USING (doc_id) WHERE doc_id < 40")
def getcol_missing_rows(spark, sf_dir):
    """Missing cells keep the result's values, and a result that is smaller takes the cells' corner."""
    labels = _read(spark, sf_dir, "labels").groupBy("doc_id").agg(F.array(F.min("quality"), F.max("toxic")).alias("cell"))
    df = _read(spark, sf_dir, "documents").select("doc_id").join(labels, "doc_id", "left")
    t = Table.from_dataframe(df, {"doc_id": D.column("int64"), "cell": D.column("int", 1), **{k: {} for k in D.TABLE_KEYS}}, row="doc_id")
    out = t.getcol("cell", (slice(0, 40),), result=np.full((40, 1), -5, np.int32))
    return spark.createDataFrame([(i, int(out[i, 0])) for i in range(40)], "doc_id long, v int")


# -- cells -------------------------------------------------------------------------------------------------------------

_EMBEDDING = D.column("float", shape=[64])


def _vectors(spark, sf_dir) -> Table:
    return _table(spark, sf_dir, "embeddings", {"vec_id": D.column("int64"), "label": D.column("int"), "embedding": _EMBEDDING, **{k: {} for k in D.TABLE_KEYS}})


@register("""
SELECT r.pos, c.i, CAST(CASE WHEN r.k < 0 OR c.k < 0 THEN -10 ELSE e.embedding[c.k + 1] END AS DOUBLE) AS v
FROM (VALUES (0, 4), (1, -1), (2, 2), (3, 0)) r(pos, k) CROSS JOIN (VALUES (0, 63), (1, 0), (2, -1), (3, 5)) c(i, k) LEFT JOIN embeddings e ON e.vec_id = r.k""")
def nd_gather_fill(spark, sf_dir):
    got = _vectors(spark, sf_dir).cells("embedding", ([4, -1, 2, 0], [63, 0, -1, 5]), fill=-10)
    cell = F.coalesce("cell", N.filled([F.lit(4)], -10, T.FloatType()))
    return got.select(F.col(POS).cast("int").alias("pos"), F.posexplode(cell).alias("i", "x")).select("pos", "i", F.col("x").cast("double").alias("v"))


@register("SELECT vec_id, CAST(len(embedding[17:48]) AS BIGINT) AS n, list_sum(list_transform(embedding[17:48], lambda x: CAST(x AS DOUBLE))) AS total FROM embeddings")
def cell_slice(spark, sf_dir):
    got = _vectors(spark, sf_dir).cells("embedding", (None, slice(16, 48)))
    total = F.aggregate(F.transform("cell", lambda x: x.cast("double")), F.lit(0.0), lambda a, x: a + x)
    return got.select(F.col(ROW).alias("vec_id"), F.size("cell").cast("long").alias("n"), total.alias("total"))


@register("SELECT vec_id, i, CAST(embedding[k + 1] AS DOUBLE) AS v FROM embeddings CROSS JOIN (VALUES (0, 9), (1, 2), (2, 40)) c(i, k)")
def cell_gather(spark, sf_dir):
    got = _vectors(spark, sf_dir).cells("embedding", (None, [9, 2, 40]))
    return got.select(F.col(ROW).alias("vec_id"), F.posexplode("cell").alias("i", "x")).select("vec_id", "i", F.col("x").cast("double").alias("v"))


@register("SELECT vec_id, a, b, CAST(embedding[a * 8 + b + 1] AS DOUBLE) AS v FROM embeddings CROSS JOIN (SELECT unnest(range(3)) AS a) CROSS JOIN (SELECT unnest(range(2)) AS b)")
def cell_corner(spark, sf_dir):
    got = _vectors(spark, sf_dir).df.select("vec_id", N.corner(N.reshape(F.col("embedding"), [8, 8]), [3, 2]).alias("cell"))
    rows = got.select("vec_id", F.posexplode("cell").alias("a", "r"))
    rows = rows.select("vec_id", "a", F.posexplode("r").alias("b", "x"))
    return rows.select("vec_id", F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b"), F.col("x").cast("double").alias("v"))


@register("""
SELECT vec_id, i, j, CAST(embedding[a * 8 + b + 1] AS DOUBLE) AS v FROM embeddings
CROSS JOIN (VALUES (0, 7), (1, 0)) x(i, a) CROSS JOIN (VALUES (0, 5), (1, 1), (2, 6)) y(j, b)""")
def nd_gather_2d(spark, sf_dir):
    dims = normalise((None, [7, 0], [5, 1, 6]))[1:]
    cell = N.gather(N.reshape(F.col("embedding"), [8, 8]), dims, 2, T.FloatType())
    rows = _vectors(spark, sf_dir).df.select("vec_id", F.posexplode(cell).alias("i", "r"))
    return rows.select("vec_id", "i", F.posexplode("r").alias("j", "x")).select("vec_id", "i", "j", F.col("x").cast("double").alias("v"))


@register("SELECT vec_id, CAST(i - 1 AS INTEGER) AS i, CAST(embedding[i] AS DOUBLE) AS v FROM embeddings, unnest(range(1, 65)) t(i)")
def flat_offset(spark, sf_dir):
    flat = N.flat(N.reshape(F.col("embedding"), [4, 4, 4]), 3)
    return _vectors(spark, sf_dir).df.select("vec_id", F.posexplode(flat).alias("i", "x")).select("vec_id", "i", F.col("x").cast("double").alias("v"))


@register("SELECT vec_id, 8 AS a, 8 AS b FROM embeddings")
def row_shape_fixed(spark, sf_dir):
    shape = N.shape(N.reshape(F.col("embedding"), [8, 8]), 2)
    return _vectors(spark, sf_dir).df.select("vec_id", F.get(shape, F.lit(0)).alias("a"), F.get(shape, F.lit(1)).alias("b"))


@register("SELECT d.doc_id, CASE WHEN l.doc_id IS NULL THEN NULL ELSE 2 END AS n FROM documents d LEFT JOIN (SELECT doc_id, min(quality) AS q FROM labels GROUP BY doc_id) l USING (doc_id)")
def row_shape_missing(spark, sf_dir):
    labels = _read(spark, sf_dir, "labels").groupBy("doc_id").agg(F.array(F.min("quality"), F.max("toxic")).alias("cell"))
    df = _read(spark, sf_dir, "documents").select("doc_id").join(labels, "doc_id", "left").withColumn(ROW, F.col("doc_id"))
    t = Table(spark, df, {"doc_id": D.column("int64"), "cell": D.column("int", 1), **{k: {} for k in D.TABLE_KEYS}})
    return t.shapes("cell").select(F.col(ROW).alias("doc_id"), F.get("shape", F.lit(0)).alias("n"))


@register("SELECT conv_id, CAST(count(*) AS INTEGER) AS n FROM conversations GROUP BY conv_id")
def row_shape_variable(spark, sf_dir):
    df = _read(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list("turn")).alias("cell")).withColumn(ROW, F.col("conv_id"))
    t = Table(spark, df, {"conv_id": D.column("int64"), "cell": D.column("int64", 1), **{k: {} for k in D.TABLE_KEYS}})
    return t.shapes("cell").select(F.col(ROW).alias("conv_id"), F.get("shape", F.lit(0)).alias("n"))


@register("SELECT event_id, value * value + CAST(user_id AS DOUBLE) * CAST(user_id AS DOUBLE) AS power FROM events")
def complex_power(spark, sf_dir):
    pair = F.array("value", F.col("user_id").cast("double"))
    return _read(spark, sf_dir, "events").select("event_id", N.power(pair).alias("power"))


@register("SELECT event_id, value * 2.0 - CAST(user_id AS DOUBLE) * 3.0 AS re, value * 3.0 + CAST(user_id AS DOUBLE) * 2.0 AS im FROM events")
def complex_product(spark, sf_dir):
    p = N.complex_product(F.array("value", F.col("user_id").cast("double")), F.array(F.lit(2.0), F.lit(3.0)))
    return _read(spark, sf_dir, "events").select("event_id", N.real(p).alias("re"), N.imag(p).alias("im"))


@register("""
SELECT CAST(min(k) AS BIGINT) AS start, CAST(max(k) AS BIGINT) AS stop, CAST(count(*) AS BIGINT) AS n FROM (
  SELECT k, k - row_number() OVER (ORDER BY k) AS g FROM (SELECT DISTINCT event_id AS k FROM events WHERE event_type <> 'click' AND value < 60)) GROUP BY g""")
def chunk_runs(spark, sf_dir):
    df = _read(spark, sf_dir, "events").where("event_type <> 'click' and value < 60")
    return runs(df.select(F.col("event_id").alias(ROW)))


# -- writes: a stored table is changed, and read again ---------------------------------------------------------------------


def _events_stored(spark, sf_dir) -> Table:
    return _stored(spark, _read(spark, sf_dir, "events").select("event_id", "value"), "event_id")


@register("SELECT event_id, CASE event_id WHEN 7 THEN 70.5 WHEN 2 THEN 20.5 WHEN 11 THEN 110.5 ELSE value END AS value FROM events")
def putcol_scatter(spark, sf_dir):
    t = _events_stored(spark, sf_dir)
    t.putcol("value", np.array([70.5, 0.5, 20.5, 110.5]), ([7, -1, 2, 11],))
    return t.scan(["event_id", "value"])


@register("SELECT vec_id, CAST(i - 1 AS INTEGER) AS i, CASE WHEN i - 1 = 9 THEN -1.0 WHEN i - 1 = 2 THEN -2.0 ELSE CAST(embedding[i] AS DOUBLE) END AS v FROM embeddings, unnest(range(1, 65)) t(i)")
def putcol_cells(spark, sf_dir):
    t = _stored(spark, _read(spark, sf_dir, "embeddings"), "vec_id", _vectors(spark, sf_dir).tabledesc())
    t.put_cells("embedding", t.df.select(ROW, F.lit([-1.0, -9.0, -2.0]).alias("cell")), (None, [9, -1, 2]))
    return t.df.select("vec_id", F.posexplode("embedding").alias("i", "x")).select("vec_id", "i", F.col("x").cast("double").alias("v"))


@register("SELECT event_id, CASE WHEN event_id < 100 THEN event_id * 0.5 ELSE value END AS value FROM events")
def putcol_prefix(spark, sf_dir):
    t = _events_stored(spark, sf_dir)
    t.putcol("value", np.arange(100) * 0.5)
    return t.scan(["event_id", "value"])


@register("SELECT n_nationkey, n_name FROM nation UNION ALL SELECT 0, '' FROM range(5)")
def addrows(spark, sf_dir):
    t = _stored(spark, _read(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("n_nationkey"), "n_name"), "n_nationkey")
    t.addrows(5)
    return t.scan(["n_nationkey", "n_name"])


@register("SELECT n_nationkey, n_name, 0.0::DOUBLE AS weight, '' AS note FROM nation")
def addcols(spark, sf_dir):
    t = _stored(spark, _read(spark, sf_dir, "nation").select("n_nationkey", "n_name"), "n_nationkey")
    t.addcols({"weight": D.column("double"), "note": D.column("string")})
    return t.scan(["n_nationkey", "n_name", "weight", "note"])


@register("SELECT i AS \"row\", CASE i WHEN 1 THEN [3, 4] END AS shape, CASE i WHEN 1 THEN 11 END AS total FROM (SELECT unnest(range(3)) AS i)")
def put_missing_grows(spark, sf_dir):
    """A missing cell gets the selection's shape, filled with defaults."""
    t = create(spark, scratch(spark, "table"), {"V": D.column("int", 2)})
    t.addrows(3)
    t.putcol("V", np.array([[[5, 6]]], np.int32), ([1], [2], [0, 3]))
    shapes = t.shapes("V").select(ROW, "shape")
    total = F.aggregate(F.flatten("V"), F.lit(0), lambda a, x: a + x)
    return t.df.select(ROW, total.alias("total")).join(shapes, ROW).select(F.col(ROW).alias("row"), "shape", "total")


@register("SELECT * FROM (VALUES ('fraction', true), ('null in a cell', true), ('beyond the table', true), ('wrong rank', true), ('several instances', true), ('strictly read-only', true), ('fits', false)) t(put, refused)")
def put_errors(spark, sf_dir):
    t = create(spark, scratch(spark, "table"), {"I": D.column("int"), "V": D.column("int", shape=[3])})
    t.addrows(2)
    made = lambda cell, kind: spark.createDataFrame([(0, cell)], f"{ROW} long, cell {kind}")
    cases = {
        "fraction": lambda: t.put_cells("I", made(1.75, "double")),
        "null in a cell": lambda: t.put_cells("V", made([1, None, 3], "array<int>")),
        "beyond the table": lambda: t.putcol("I", np.array([1]), ([2],)),
        "wrong rank": lambda: t.putcol("I", np.ones((2, 2), np.int32)),
        "several instances": lambda: Table.from_filename(t.name(), ninstances=2, spark=spark).addrows(1),
        "strictly read-only": lambda: Table.from_filename(t.name(), strict=True, spark=spark).addrows(1),
        "fits": lambda: t.put_cells("V", made([1.0, 2.0, 3.0], "array<double>")),
    }
    return spark.createDataFrame([(k, _refused(f, Exception)) for k, f in cases.items()], "put string, refused boolean")


@register("SELECT * FROM (VALUES ('ANTENNA_ID', 'int', false), ('INTERVAL', 'double', false), ('TIME', 'double', false), ('DEW_POINT', 'float', true)) t(name, value_type, optional)")
def weather_descriptor(spark, sf_dir):
    needed, full = D.ms_descriptor("WEATHER"), D.ms_descriptor("WEATHER", True)
    rows = [(c, full[c]["valueType"], c not in needed) for c in D.columns(full) if c in needed or c == "DEW_POINT"]
    return spark.createDataFrame(rows, "name string, value_type string, optional boolean")


@register("SELECT p_partkey, CAST(p_size AS SMALLINT) AS size16, CAST(p_partkey AS DOUBLE) AS key64 FROM part")
def cast_checked(spark, sf_dir):
    df = _read(spark, sf_dir, "part")
    return df.select("p_partkey", N.checked_cast(F.col("p_size"), df.schema["p_size"].dataType, "short").alias("size16"), N.checked_cast(F.col("p_partkey"), df.schema["p_partkey"].dataType, "double").alias("key64"))


# -- the query language ----------------------------------------------------------------------------------------------------


def _taql(spark, query: str, *tables: Table) -> DataFrame:
    t = Table.from_taql(query, list(tables), spark=spark)
    return t._df.select(*t.columns())


def _events(spark, sf_dir) -> Table:
    return _table(spark, sf_dir, "events")


@register("SELECT event_id, user_id, value, event_id AS \"row\", row_number() OVER (ORDER BY user_id, value, event_id) - 1 AS place FROM events")
def taql_order(spark, sf_dir):
    """The whole order, by the rows' places in the result."""
    t = Table.from_taql("SELECT event_id, user_id, value, ROWID() AS row FROM $1 ORDER BY user_id, value", [_events(spark, sf_dir)], spark=spark)
    return t.df.select("event_id", "user_id", "value", "row", F.col(ROW).alias("place"))


@register("SELECT event_type, bucket, count(*) AS n, list(event_id ORDER BY event_id) AS row_ids, list(value ORDER BY event_id) AS vals FROM (SELECT *, user_id % 5 AS bucket FROM events) GROUP BY event_type, bucket")
def taql_gaggr(spark, sf_dir):
    return _taql(spark, "SELECT event_type, user_id % 5 AS bucket, GCOUNT() AS n, GROWID() AS row_ids, GAGGR(value) AS vals FROM $1 GROUPBY event_type, user_id % 5", _events(spark, sf_dir))


@register("SELECT o_orderkey, o_orderkey AS \"row\" FROM orders WHERE o_totalprice > 100000 AND o_orderstatus IN ('F', 'O')")
def taql_table_arg(spark, sf_dir):
    return _taql(spark, "SELECT o_orderkey, ROWID() AS row FROM $1 WHERE o_totalprice > 100000 && o_orderstatus IN ['F', 'O']", _table(spark, sf_dir, "orders"))


@register("SELECT event_type, count(*) AS n, min(value) AS lo, max(value) AS hi, round(avg(value), 6) AS mean FROM events GROUP BY event_type HAVING count(*) > 1")
def taql_aggregates(spark, sf_dir):
    got = _taql(spark, "SELECT event_type, GCOUNT() AS n, GMIN(value) AS lo, GMAX(value) AS hi, GMEAN(value) AS mean FROM $1 GROUPBY event_type HAVING GCOUNT() > 1", _events(spark, sf_dir))
    return got.withColumn("mean", F.round("mean", 6))


@register("SELECT c_custkey, c_name, o_orderkey FROM customer JOIN orders ON o_custkey = c_custkey WHERE o_totalprice > 250000")
def taql_join(spark, sf_dir):
    query = "SELECT c.c_custkey, c.c_name, o.o_orderkey FROM $2 o JOIN $1 c ON o.o_custkey = c.c_custkey WHERE o.o_totalprice > 250000"
    return _taql(spark, query, _table(spark, sf_dir, "customer"), _table(spark, sf_dir, "orders"))


@register("SELECT DISTINCT event_type FROM events")
def taql_distinct(spark, sf_dir):
    return _taql(spark, "SELECT DISTINCT event_type FROM $1", _events(spark, sf_dir))


@register("SELECT event_id, value FROM events WHERE value BETWEEN 10 AND 60 ORDER BY value DESC, event_id LIMIT 20 OFFSET 5")
def taql_limit(spark, sf_dir):
    return _taql(spark, "SELECT event_id, value FROM $1 WHERE value BETWEEN 10 AND 60 ORDERBY value DESC LIMIT 20 OFFSET 5", _events(spark, sf_dir))


@register("SELECT event_type, count(*) AS n FROM (SELECT event_type, user_id FROM events WHERE user_id > 10) GROUP BY event_type")
def taql_subquery(spark, sf_dir):
    return _taql(spark, "SELECT event_type, GCOUNT() AS n FROM [SELECT event_type, user_id, event_id FROM $1 WHERE user_id > 10] GROUPBY event_type", _events(spark, sf_dir))


# -- merge and export ----------------------------------------------------------------------------------------------------------


@register("SELECT user_id, value, event_id FROM events")
def merge_sorted(spark, sf_dir):
    df = _read(spark, sf_dir, "events").select("user_id", "value", "event_id")
    return merge.merge_partitions([df.where(f"event_id % 3 = {k}") for k in range(3)], ["user_id", "value", "event_id"])


@register("""
SELECT event_type, chunk, count(*) AS n, min(event_id) AS lo, max(event_id) AS hi FROM (
  SELECT event_type, event_id, CAST(floor((row_number() OVER (PARTITION BY event_type ORDER BY event_id) - 1) / 1000) AS BIGINT) AS chunk FROM events) GROUP BY event_type, chunk""")
def export_chunks(spark, sf_dir):
    return export.chunk_plan(_read(spark, sf_dir, "events"), ["event_type"], 1000, "event_id")


@register("SELECT l_orderkey, l_quantity, l_extendedprice, l_returnflag FROM lineitem WHERE l_quantity >= 10 AND l_quantity < 20 AND l_discount > 0.05 AND l_returnflag = 'A'")
def dataset_predicate(spark, sf_dir):
    """Rows written in folders by a column, read with predicates on it and on others."""
    path = scratch(spark, "dataset")
    export.write_dataset(_read(spark, sf_dir, "lineitem"), path, ["l_returnflag"], 50_000, ["l_orderkey", "l_linenumber"])
    df = export.read_dataset(spark, path)
    return df.where("l_quantity >= 10 and l_quantity < 20 and l_discount > 0.05 and l_returnflag = 'A'").select("l_orderkey", "l_quantity", "l_extendedprice", "l_returnflag")


@register("SELECT event_type, event_id, value FROM events")
def export_table(spark, sf_dir):
    """A stored table exported by a partition column, and read back."""
    t = _stored(spark, _read(spark, sf_dir, "events").select("event_id", "event_type", "value"), "event_id")
    out = scratch(spark, "export")
    export.export(spark, t.name(), out, ["event_type"], 500)
    return export.read_dataset(spark, f"{out}/MAIN").select("event_type", "event_id", "value")


@register("SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def command_export(spark, sf_dir):
    """The same from the command line."""
    from hypercell.__main__ import main

    t = _stored(spark, _read(spark, sf_dir, "events").select("event_id", "event_type", "value"), "event_id")
    out = scratch(spark, "export")
    main(["export", t.name(), "-p", "event_type", "-nr", "500", "-o", out])
    return export.read_dataset(spark, f"{out}/MAIN").groupBy("event_type").agg(F.count("*").alias("n"))


@register("SELECT * FROM (VALUES ('fixed', 'fixed_size_list', true), ('list', 'list', true)) t(strategy, kind, sane)")
def arrow_strategy(spark, sf_dir):
    from hypercell.config import settings

    rows = []
    for how, kind in (("fixed", "fixed_size_list"), ("list", "list")):
        with settings(**{"convert.strategy": how}):
            got = _vectors(spark, sf_dir).to_arrow([slice(0, 4)], "embedding")
            rows.append((how, str(got.schema.field("embedding").type).split("<")[0], got.num_rows == 4))
    return spark.createDataFrame(rows, "strategy string, kind string, sane boolean")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
