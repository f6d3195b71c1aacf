"""Tables of scalar and N-dimensional cells over DataFrames."""

from __future__ import annotations

import copy
import logging
import uuid
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hypercell.config import strategy
from hypercell.errors import InvalidTable, NotSupported
from hypercell.functions import ndexpr as N
from hypercell.functions import selection as S
from hypercell.functions.types import cell_type, depth_of
from hypercell.operators import cells
from hypercell.operators.rows import POS, number_rows, select_rows
from hypercell.sources import descriptor as D
from hypercell.sources.descriptor import ROW
from hypercell.sources.storage import Store, split

log = logging.getLogger(__name__)


def _session(spark: SparkSession | None) -> SparkSession:
    return spark or SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()


class Table:
    """A table by its rows' positions (``__row__``), its columns' descriptors, and a lazy DataFrame.

    Reads build DataFrames (``df``, ``select``, ``cells``, ``shapes``); ``to_arrow``, ``getcol`` and ``row_shapes`` bring a result to the driver.
    """

    def __init__(self, spark: SparkSession, df: DataFrame, desc: dict, path: str | None = None, readonly: bool = False, ninstances: int = 1, lockoptions="auto", strict: bool = False, order: list | None = None, rows: int | None = None):
        self._rows = rows
        self.spark, self._df, self._desc, self._path = spark, df, desc, path
        self._instances, self._lock, self._order = ninstances, lockoptions, order
        # Opening read-only does not refuse writes unless asked to be strict.
        self._refuse = readonly and strict
        self._open = True

    # -- opening -------------------------------------------------------------------------------------------------------

    @classmethod
    def from_filename(cls, filename: str, ninstances: int = 1, readonly: bool = True, lockoptions="auto", strict: bool = False, spark: SparkSession | None = None) -> "Table":
        spark = _session(spark)
        store = Store(spark, split(str(filename)))
        if not store.exists():
            raise InvalidTable(f"{filename} is not a table")
        return cls(spark, store.read(), store.descriptor(), store.path, readonly, ninstances, lockoptions, strict, rows=store.rows())

    @classmethod
    def from_dataframe(cls, df: DataFrame, desc: dict | None = None, row: str | None = None, order: Sequence | None = None) -> "Table":
        """A table over any DataFrame. Row numbers are the column ``row``, or come from a total order given in ``order``."""
        desc = desc or D.of_schema((df.drop(row) if row else df).schema)
        if row:
            df = df.withColumn(ROW, F.col(row).cast("long"))
        elif ROW not in df.columns:
            if not order:
                raise InvalidTable("rows of a DataFrame have no order: give a row column or an order")
            df = number_rows(df, [F.col(c) if isinstance(c, str) else c for c in order])
        return cls(df.sparkSession, df, desc)

    @classmethod
    def ms_from_descriptor(cls, filename: str, subtable: str = "MAIN", table_desc: dict | None = None, dminfo: dict | None = None, spark: SparkSession | None = None) -> "Table":
        """Create a main table, or a subtable that its main table then names. What was there is replaced. The user's columns
        win over required ones of the same name."""
        spark = _session(spark)
        name = (subtable or "MAIN").upper()
        desc = D.merged(D.ms_descriptor(name, False), table_desc)
        path = str(filename).rstrip("/")
        if name != "MAIN":
            path = f"{path}/{name}"
        made = create(spark, path, desc)
        if name != "MAIN":
            main = Store(spark, str(filename))
            if main.exists():
                of_main = main.descriptor()
                of_main.setdefault("_keywords_", {})[name] = f"Table: {path}"
                main.set_descriptor(of_main)
        else:
            for sub in D.DEFAULT_SUBTABLES:
                create(spark, f"{path}/{sub}", D.ms_descriptor(sub))
                desc.setdefault("_keywords_", {})[sub] = f"Table: {path}/{sub}"
            Store(spark, path).set_descriptor(desc)
            made._desc = desc
        return made

    @classmethod
    def from_taql(cls, query: str, tables: Sequence["Table"] | "Table" | None = None, spark: SparkSession | None = None) -> "Table":
        """The result of a query; ``$1``, ``$2``, ... stand for the given tables."""
        from hypercell.plans.taql import run

        if isinstance(tables, Table):
            tables = [tables]
        return run(_session(spark), query, list(tables or []))

    # -- life ----------------------------------------------------------------------------------------------------------

    def close(self) -> bool:
        """True if it was open."""
        was, self._open = self._open, False
        return was

    def __enter__(self) -> "Table":
        return self

    def __exit__(self, *_) -> None:
        self.close()

    def _live(self) -> None:
        if not self._open:
            raise InvalidTable("the table is closed")

    # -- what it is ----------------------------------------------------------------------------------------------------

    @property
    def df(self) -> DataFrame:
        """All rows and columns with ``__row__``, in no order."""
        self._live()
        if ROW not in self._df.columns:
            if not self._order:
                raise InvalidTable("the table's rows have no order")
            self._df = number_rows(self._df, self._order)
        return self._df

    def name(self) -> str | None:
        return self._path

    def nrow(self) -> int:
        self._live()
        if self._rows is None:
            self._rows = self._df.count()
        return self._rows

    def columns(self) -> list[str]:
        self._live()
        return [c for c in self._df.columns if not c.startswith("__")] if self._path is None else D.columns(self._desc)

    def ncolumns(self) -> int:
        return len(self.columns())

    def tabledesc(self) -> dict:
        self._live()
        return copy.deepcopy(self._desc)

    def getcoldesc(self, column: str) -> dict:
        return copy.deepcopy(self._column(column))

    def getdminfo(self, column: str | None = None) -> dict:
        """Data managers by group, or the one that holds a column."""
        groups: dict[str, dict] = {}
        for c in self.columns():
            g = self._column(c).get("dataManagerGroup") or "StandardStMan"
            groups.setdefault(g, {"NAME": g, "TYPE": self._column(c).get("dataManagerType") or "StandardStMan", "COLUMNS": [], "SPEC": {}})["COLUMNS"].append(c)
        found = {f"*{i + 1}": {**v, "SEQNR": i} for i, v in enumerate(groups.values())}
        if column is None:
            return found
        self._column(column)
        return next(v for v in found.values() if column in v["COLUMNS"])

    def lockoptions(self) -> dict:
        self._live()
        return dict(self._lock) if isinstance(self._lock, dict) else {"option": self._lock}

    def describe(self) -> DataFrame:
        """The columns' descriptors as rows."""
        rows = [(c, d["valueType"], d.get("ndim"), d.get("shape"), d.get("comment", ""), (d.get("keywords") or {}).get("QuantumUnits")) for c in self.columns() for d in [self._column(c)]]
        return self.spark.createDataFrame(rows, "name string, value_type string, ndim int, shape array<int>, comment string, units array<string>")

    def _column(self, column: str) -> dict:
        self._live()
        if column not in self._desc or column not in self._df.columns:
            raise InvalidTable(f"Column {column} does not exist")
        return self._desc[column]

    # -- reading -------------------------------------------------------------------------------------------------------

    def select(self, index: S.Index = None, columns: str | Sequence[str] | None = None) -> DataFrame:
        """Selected rows (a selection of other dimensions is an IndexError) and columns, with ``__row__`` and ``__pos__``."""
        if isinstance(columns, str):
            columns = [columns]
        rows = S.rows_only(index)
        for c in columns or ():
            self._column(c)
        return select_rows(self.df, rows).select(ROW, POS, *(columns if columns is not None else self.columns()))

    def _bounded(self, rows: S.Dim) -> None:
        highest = rows.highest if isinstance(rows, S.Points) else (rows.stop or 0) - 1 if rows is not None else -1
        if highest >= 0 and highest >= (n := self.nrow()):
            raise IndexError(f"row {highest} exceeds a table of {n} rows")

    def _nested(self, df: DataFrame, columns: Sequence[str], named: bool) -> tuple[DataFrame, list[str]]:
        """Cells of any rank as nested arrays where the selected ones share a rank; others are left out, or an error if ``named``."""
        flat = [c for c in columns if D.is_flat(self._desc[c])]
        if not flat:
            return df, list(columns)
        ranks = df.agg(*[F.min(F.size(F.col(c)["shape"])).alias(f"lo_{c}") for c in flat], *[F.max(F.size(F.col(c)["shape"])).alias(f"hi_{c}") for c in flat]).first()
        keep = list(columns)
        for c in flat:
            lo, hi = ranks[f"lo_{c}"], ranks[f"hi_{c}"]
            if lo != hi or lo is None:
                if named:
                    raise InvalidTable(f"the cells of column {c} have no common rank")
                log.warning("column %s is left out: its cells have no common rank", c)
                keep.remove(c)
            else:
                df = df.withColumn(c, unflatten(F.col(c), lo))
        return df.select(ROW, POS, *keep), keep

    def scan(self, columns: str | Sequence[str] | None = None) -> DataFrame:
        """All rows in no order, lazily; in a scan of all columns, those without a common rank are left out."""
        self._live()
        wanted = [columns] if isinstance(columns, str) else list(columns if columns is not None else self.columns())
        for c in wanted:
            self._column(c)
        df, wanted = self._nested(self._df.withColumns({k: F.lit(0).cast("long") for k in (POS, ROW) if k not in self._df.columns}), wanted, columns is not None)
        return df.select(*wanted)

    def to_arrow(self, index: S.Index = None, columns: str | Sequence[str] | None = None) -> pa.Table:
        """Selected rows in order, as an Arrow table with the descriptors as metadata.

        Cells that share a shape become fixed-size lists (see ``config.strategy``). In a scan of all columns, those without a common rank
        are left out.
        """
        named = columns is not None
        wanted = [columns] if isinstance(columns, str) else list(columns) if named else self.columns()
        if index is not None:
            self._bounded(S.rows_only(index))
        if index is None and ROW not in self._df.columns:
            df = self._df.orderBy(*self._order) if self._order else self._df
            df = df.withColumn(POS, F.lit(0)).withColumn(ROW, F.lit(0))
            df, wanted = self._nested(df, wanted, named)
            got = df.select(*wanted).toArrow()
        else:
            df, wanted = self._nested(self.select(index, wanted), wanted, named)
            got = df.orderBy(POS).select(*wanted).toArrow()
        fixed = strategy() == "fixed"
        fields, arrays = [], []
        for c in wanted:
            d = self._desc[c]
            kind = cell_type(d["valueType"])
            arr = cells.to_arrow(got.column(c), kind, fixed, (list(d["shape"]) + [2] * kind.is_complex) if d.get("shape") else None)
            arrays.append(arr)
            fields.append(pa.field(c, arr.type, metadata={"descriptor": _json(d)}))
        return pa.Table.from_arrays(arrays, schema=pa.schema(fields, metadata={"descriptor": _json({k: v for k, v in self._desc.items() if k in D.TABLE_KEYS})}))

    def cells(self, column: str, index: S.Index = None, fill=None) -> DataFrame:
        """``__pos__``, ``__row__`` and ``cell``: the selected elements of the selected rows, places in the wanted order.

        A negative index gives ``fill`` (null if None; both parts of a complex number); a negative or missing row a null cell.
        """
        d = self._column(column)
        dims = S.normalise(index)
        rows, inner = (dims[0] if dims else None), dims[1:]
        self._bounded(rows)
        kind = cell_type(d["valueType"])
        df = select_rows(self.df, rows).select(POS, ROW, column)
        if D.is_flat(d):
            df, _ = self._nested(df, [column], True)
        rank = _depth(df.schema[column].dataType) - kind.is_complex
        if shape := d.get("shape"):
            for k, dim in enumerate(inner[: len(shape)]):
                S.extent(dim, shape[k])
        # A pair is never taken apart: its axis is beyond the rank.
        cell = N.gather(F.col(column), inner[:rank], rank + kind.is_complex, kind.spark, fill)
        return df.select(POS, ROW, cell.alias("cell"))

    def getcol(self, column: str, index: S.Index = None, result: np.ndarray | None = None) -> np.ndarray:
        """The selected elements as a numpy array. With ``result``, they are put into it: places skipped by negative indices, and
        missing rows, keep what is there; a smaller array takes the leading corner of the cells."""
        d = self._column(column)
        kind = cell_type(d["valueType"])
        dims = list(S.normalise(index))
        if result is not None:
            if np.dtype(kind.numpy) != result.dtype and kind.name != "string":
                raise TypeError(f"the result's type {result.dtype} is not the column's")
            rank = result.ndim - 1
            if len(dims) > 1:
                for k, dim in enumerate(dims[1 : 1 + rank]):
                    if isinstance(dim, S.Points) and len(dim.index) != result.shape[1 + k]:
                        raise InvalidTable("the result's shape is not the selection's")
            dims = [*dims, *[None] * (1 + rank - len(dims))]
            dims[1:] = [S.Span(0, n) if dim is None else dim for dim, n in zip(dims[1:], result.shape[1:], strict=False)]
        got = self.cells(column, _raw(dims)).orderBy(POS).select("cell", ROW).toArrow()
        if result is None:
            if D.depth(d) and not len(got) and d.get("shape"):
                return np.empty((0, *d["shape"]), kind.numpy)
            values, mask = cells.to_numpy(got.column("cell"), kind, column)
            if mask is not None and mask.any():
                values = np.ma.masked_array(values, mask) if values.dtype != object else values
            return values
        if len(got) != len(result):
            raise InvalidTable(f"{len(got)} rows are selected, the result has {len(result)}")
        out = result
        there = np.flatnonzero(~np.asarray(got.column("cell").combine_chunks().is_null()))
        if len(there):
            values, mask = _with_gaps(got.column("cell").take(there), kind, column, result.shape[1:], dims[1:])
            part = out[there]
            part[~mask] = values[~mask]
            out[there] = part
        return out

    def shapes(self, column: str, index: S.Index = None) -> DataFrame:
        """``__pos__``, ``__row__`` and ``shape`` (C order; [1] for scalars; null for missing cells)."""
        d = self._column(column)
        rows = S.rows_only(index)
        self._bounded(rows)
        kind = cell_type(d["valueType"])
        df = select_rows(self.df, rows)
        if D.is_flat(d):
            return df.select(POS, ROW, F.col(column)["shape"].alias("shape"))
        return df.select(POS, ROW, N.shape(F.col(column), D.depth(d) - kind.is_complex).alias("shape"))

    def row_shapes(self, column: str, index: S.Index = None) -> pa.Array:
        """Shapes of the selected cells: fixed-size lists, or ones for a scalar column."""
        d = self._column(column)
        got = cells._plain(self.shapes(column, index).orderBy(POS).select("shape").toArrow().column("shape"))
        if D.depth(d) - cell_type(d["valueType"]).is_complex == 0 and not D.is_flat(d):
            return pa.array([1 if v is not None else None for v in got.to_pylist()], pa.uint8())
        values = got.to_pylist()
        ranks = {len(v) for v in values if v is not None}
        if len(ranks) > 1:
            raise InvalidTable(f"the cells of column {column} have no common rank")
        return pa.array(values, pa.list_(pa.int32(), ranks.pop() if ranks else max(1, d.get("ndim") or 1)))

    # -- writing -------------------------------------------------------------------------------------------------------

    def _writable(self) -> Store:
        self._live()
        if self._instances > 1:
            raise NotSupported("writes with ninstances > 1 are not supported")
        if self._refuse:
            raise InvalidTable("the table was opened strictly read-only")
        if self._path is None:
            raise InvalidTable("the result of a query has no place to write to")
        return Store(self.spark, self._path)

    def _commit(self, store: Store, df: DataFrame, desc: dict, clustered: bool = False) -> None:
        store.commit(df, desc, clustered)
        self._desc, self._df, self._rows = desc, store.read(), store.rows()

    def addrows(self, nrow: int) -> None:
        """Append rows of defaults: zeros, empty strings and false; fixed shapes are filled with them, other cells are missing."""
        store = self._writable()
        if nrow < 0:
            raise ValueError("the number of rows is negative")
        have = self.nrow()
        new = self.spark.range(have, have + nrow).withColumnRenamed("id", ROW)
        new = new.select(ROW, *[_default(self._desc[c]).alias(c) for c in D.columns(self._desc)])
        self._commit(store, self.df.unionByName(new), self._desc)

    def addcols(self, columndescs: dict, dminfo: dict | None = None) -> None:
        """Add columns of defaults."""
        store = self._writable()
        for c in columndescs:
            if c in self._desc:
                raise InvalidTable(f"Column {c} exists")
        desc = self._desc | {k: {"keywords": {}, "comment": "", "dataManagerGroup": "StandardStMan", "dataManagerType": "StandardStMan", "maxlen": 0, "option": 0, **v} for k, v in columndescs.items()}
        self._commit(store, self.df.withColumns({c: _default(desc[c]) for c in columndescs}), desc, clustered=True)

    def putcol(self, column: str, data: np.ndarray, index: S.Index = None) -> None:
        """Put elements at the selected places. Without a row selection the data are the first rows'. The data's type must
        fit the column's without loss; negative indices skip their places."""
        d = self._column(column)
        kind = cell_type(d["valueType"])
        data = np.asarray(data) if not isinstance(data, np.ndarray) else data
        dims = S.normalise(index)
        rows, inner = (dims[0] if dims else None), dims[1:]
        rank = D.depth(d) - kind.is_complex
        if not D.is_flat(d) and data.ndim - 1 != rank:
            raise InvalidTable(f"data of {data.ndim - 1} dimensions do not fit column {column} of {rank}")
        if data.ndim < 1 or not len(data) and rows is None:
            return
        for k, dim in enumerate(inner[:rank]):
            if dim is not None and S.extent(S.Span(dim.start, dim.stop or data.shape[k + 1] + dim.start) if isinstance(dim, S.Span) else dim, 1 << 62) != data.shape[k + 1]:
                raise InvalidTable("the data's shape is not the selection's")
            if (shape := d.get("shape")) is not None:
                S.extent(dim, shape[k])
        if shape := d.get("shape"):
            for k, n in enumerate(shape):
                if (k >= len(inner) or inner[k] is None) and data.shape[k + 1] != n:
                    raise InvalidTable("the data's shape is not the column's")
        self._bounded(rows)
        where = list(range(len(data))) if rows is None else S.indices(rows, self.nrow())
        if len(where) != len(data):
            raise InvalidTable(f"{len(data)} rows of data for {len(where)} selected rows")
        if rows is None and len(data) > self.nrow():
            raise IndexError(f"{len(data)} rows of data exceed the table")
        arr = cells.from_numpy(data, kind)
        keep = [i for i, r in enumerate(where) if r >= 0]
        if not keep:
            return
        update = self.spark.createDataFrame(pa.table({"__at__": pa.array([where[i] for i in keep], pa.int64()), "cell": arr.take(pa.array(keep, pa.int64()))}))
        self.put_cells(column, update.withColumnRenamed("__at__", ROW), index=_raw([None, *inner]), local=True)

    def put_cells(self, column: str, updates: DataFrame, index: S.Index = None, local: bool = False) -> None:
        """Put ``cell`` of ``updates`` (``__row__`` and ``cell``, distinct rows) at the selected places of those rows' cells. A value
        that the column's type would change, and a null inside a cell, are errors.

        A join on the row; the rest of a cell stays. A missing cell gets the update's shape, grown to the selection's end and filled
        with defaults. ``local``: the updates come from the driver's memory, and are broadcast if they are few.
        """
        store = self._writable()
        d = self._column(column)
        kind = cell_type(d["valueType"])
        inner = S.normalise(index)[1:]
        rank = D.depth(d) - kind.is_complex
        small = local and updates.limit(10_001).count() <= 10_000
        levels, source = depth_of(updates.schema["cell"].dataType)
        if not D.is_flat(d) and levels != D.depth(d):
            raise InvalidTable(f"cells of {levels} levels do not fit column {column} of {D.depth(d)}")
        cell = N.each(F.col("cell"), levels, lambda x: N.checked_cast(x, source, kind.name))
        if levels:
            cell = F.when(N.has_null(F.col("cell"), levels), F.raise_error(F.lit(f"a cell for column {column} holds a null"))).otherwise(cell)
        update = updates.select(ROW, cell.alias("__cell__"), F.lit(True).alias("__put__"))
        joined = self.df.join(F.broadcast(update) if small else update, ROW, "left")
        old, new = F.col(column), F.col("__cell__")
        if D.is_flat(d):
            depth = levels
            ranks = depth - kind.is_complex
            body = F.struct((F.array(*[n.cast("int") for n in N.sizes(new, ranks)]) if ranks else F.array().cast("array<int>")).alias("shape"), (N.flat(new, depth - kind.is_complex) if ranks else F.array(new)).alias("data"))
        elif not rank or not any(x is not None for x in inner):
            body = new
        else:
            grown = [_end(x, n) for x, n in zip([*inner, *[None] * (rank - len(inner))], N.sizes(new, rank), strict=False)]
            blank = N.filled([*grown, *[F.lit(2)] * kind.is_complex], kind.default, kind.spark)
            body = N.scatter(F.coalesce(old, blank), new, inner, rank)
        self._commit(store, joined.withColumn(column, F.when(F.col("__put__"), body).otherwise(old)).drop("__cell__", "__put__"), self._desc)

    def add_dataframe(self, df: DataFrame, order: Sequence) -> None:
        """Append a DataFrame's rows in a total order; columns it lacks get defaults."""
        store = self._writable()
        have = self.nrow()
        new = number_rows(df, [F.col(c) if isinstance(c, str) else c for c in order])
        new = new.select((F.col(ROW) + have).alias(ROW), *[(F.col(c).cast(self._df.schema[c].dataType) if c in df.columns else _default(self._desc[c])).alias(c) for c in D.columns(self._desc)])
        self._commit(store, self.df.unionByName(new), self._desc)


def _json(x) -> str:
    import json

    return json.dumps(x, sort_keys=True)


def _raw(dims: Sequence[S.Dim]) -> tuple:
    """An index that normalises to ``dims``."""
    return tuple(None if d is None else slice(d.start, d.stop) if isinstance(d, S.Span) else list(d.index) for d in dims)


def _depth(kind) -> int:
    from hypercell.functions.types import depth_of

    return depth_of(kind)[0]


def _end(dim: S.Dim, size):
    if dim is None:
        return size
    if isinstance(dim, S.Span):
        return F.lit(dim.stop) if dim.stop is not None else size + dim.start
    return F.lit(dim.highest + 1)


def _default(d: dict):
    kind = cell_type(d["valueType"])
    spark = D.field("x", d).dataType
    if D.is_flat(d):
        return F.lit(None).cast(spark)
    if d.get("shape"):
        return N.filled([F.lit(n) for n in [*d["shape"], *[2] * kind.is_complex]], kind.default, kind.spark)
    if d.get("ndim"):
        return F.lit(None).cast(spark)
    return N.filled([F.lit(2)], 0.0, kind.spark) if kind.is_complex else F.lit(kind.default).cast(spark)


def unflatten(cell, rank: int):
    """Nested arrays from a shape and flat data."""
    shape, data = cell["shape"], cell["data"]
    if rank == 0:
        return F.get(data, F.lit(0))

    def build(at, k: int):
        if k == rank - 1:
            return F.slice(data, at + 1, F.get(shape, F.lit(k)))
        step = F.aggregate(F.slice(shape, k + 2, rank - k - 1), F.lit(1), lambda a, b: a * b)
        n = F.get(shape, F.lit(k))
        return F.transform(F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>")), lambda i: build(at + i * step, k + 1))

    return F.when(cell.isNotNull(), build(F.lit(0), 0))


def _with_gaps(arr, kind, column: str, shape: tuple, dims: list[S.Dim]) -> tuple[np.ndarray, np.ndarray]:
    """Values and a mask of gaps, where skipped places are null at any level."""
    arr = cells._plain(arr)
    full = (len(arr), *shape)
    values = np.zeros(full, object if kind.name == "string" else kind.numpy)
    mask = np.zeros(full, bool)
    for k, dim in enumerate(dims):
        if isinstance(dim, S.Points):
            skip = [i for i, x in enumerate(dim.index) if x < 0]
            if skip:
                mask[(slice(None),) * (1 + k) + (skip,)] = True
    flat = cells._plain(arr)
    while cells._is_list(flat.type):
        flat = flat.flatten()
    data = flat.drop_null() if kind.name == "string" else flat.drop_null()
    if kind.name == "string":
        found = np.array(data.to_pylist(), dtype=object)
    else:
        found = np.asarray(data).astype(np.float32 if kind.numpy is np.complex64 else np.float64 if kind.is_complex else kind.numpy)
        if kind.is_complex:
            found = np.ascontiguousarray(found).view(kind.numpy)
    if len(found) != int((~mask).sum()):
        raise InvalidTable(f"the cells of column {column} do not fill the result's shape")
    values[~mask] = found
    return values, mask


def create(spark: SparkSession, path: str, desc: dict) -> Table:
    """A new empty table, in place of what is there."""
    store = Store(spark, path)
    if store.exists():
        store.remove()
    desc = {k: {} for k in D.TABLE_KEYS} | desc
    store.commit(spark.createDataFrame([], D.schema(desc)), desc, clustered=True)
    return Table(spark, store.read(), desc, store.path)


def write_table(df: DataFrame, path: str, desc: dict | None = None, row: str | None = None, order: Sequence | None = None) -> Table:
    """Store a DataFrame as a table."""
    spark = df.sparkSession
    made = Table.from_dataframe(df, desc, row, order)
    store = Store(spark, path)
    if store.exists():
        store.remove()
    store.commit(made.df, made._desc)
    return Table.from_filename(path, spark=spark)


def safe_multithreaded_writes() -> bool:
    """Whether several writers may work on a table at once: they may not."""
    return False
