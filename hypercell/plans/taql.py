"""A table query language: parsed to a small tree, emitted as Spark SQL.

SELECT with expressions, FROM a table's path, ``$n`` or a subquery, JOIN ... ON, WHERE, GROUPBY with aggregates per group, HAVING,
ORDERBY, LIMIT, OFFSET, DISTINCT and GIVING; CREATE TABLE, UPDATE and DELETE. Rows of a result are in source order unless sorted,
groups in order of first appearance; ties of a sort stay in source order.
"""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hypercell.errors import InvalidTable, NotSupported
from hypercell.operators.rows import number_rows
from hypercell.operators.table import Table, create, write_table
from hypercell.sources import descriptor as D
from hypercell.sources.descriptor import ROW


class QueryError(InvalidTable):
    """A query that cannot be understood."""


_TOKEN = re.compile(
    r"""\s+|\#[^\n]*
    |(?P<num>\d+\.\d*(?:[eE][+-]?\d+)?|\.\d+(?:[eE][+-]?\d+)?|\d+[eE][+-]?\d+|\d+)
    |(?P<str>'(?:[^']|'')*'|"[^"]*")
    |(?P<arg>\$\d+)
    |(?P<name>[A-Za-z_][A-Za-z0-9_]*)
    |(?P<op>==|!=|<>|<=|>=|&&|\|\||\*\*|//|[-+*/%=<>!()\[\],.:])""",
    re.X,
)
_PATH = re.compile(r"""\s*(?:'([^']*)'|"([^"]*)"|([^\s,()\[\]]+))""")
_TYPES = {"B": "boolean", "U1": "uchar", "I2": "short", "U2": "ushort", "I4": "int", "U4": "uint", "I8": "int64", "R4": "float", "R8": "double", "C4": "complex", "C8": "complex", "C16": "dcomplex", "S": "string"}
_CLAUSES = {"FROM", "WHERE", "GROUPBY", "GROUP", "HAVING", "ORDERBY", "ORDER", "LIMIT", "OFFSET", "GIVING", "AS", "ASC", "DESC", "JOIN", "ON", "SET", "INTO", "INNER", "LEFT"}

#: Rows up to which LIMIT and OFFSET keep the first rows of each partition in memory; beyond, sorted rows are numbered instead.
TOP = 100_000

# Functions over the rows of a group.
_AGGREGATES = {
    "GCOUNT": "count({0})", "GMIN": "min({0})", "GMAX": "max({0})", "GSUM": "sum({0})", "GMEAN": "avg({0})", "GVARIANCE": "var_pop({0})",
    "GSTDDEV": "stddev_pop({0})", "GSUMSQR": "sum({0} * {0})", "GRMS": "sqrt(avg({0} * {0}))", "GPRODUCT": "product({0})", "GANY": "bool_or({0})", "GALL": "bool_and({0})",
    "GNTRUE": "count_if({0})", "GNFALSE": "count_if(NOT {0})", "GMEDIAN": "percentile({0}, 0.5)", "GFRACTILE": "percentile({0}, {1})", "GFIRST": "min_by({0}, `__row__`)", "GLAST": "max_by({0}, `__row__`)",
}
# Functions of single rows: the Spark function, or a form.
_FUNCTIONS = {
    "SIN": "sin", "COS": "cos", "TAN": "tan", "ASIN": "asin", "ACOS": "acos", "ATAN": "atan", "ATAN2": "atan2", "SINH": "sinh", "COSH": "cosh", "TANH": "tanh",
    "EXP": "exp", "LOG": "ln", "LOG10": "log10", "SQRT": "sqrt", "ABS": "abs", "SIGN": "sign", "ROUND": "round", "FLOOR": "floor", "CEIL": "ceil", "POW": "pow",
    "SQUARE": "({0} * {0})", "CUBE": "({0} * {0} * {0})", "FMOD": "({0} % {1})", "PI": "pi()", "E": "e()", "IIF": "if({0}, {1}, {2})", "ISNAN": "isnan({0})", "ISNULL": "({0} IS NULL)",
    "ISDEFINED": "({0} IS NOT NULL)", "NDIM": None, "NELEMENTS": None, "COUNT": None, "UPPER": "upper", "UPCASE": "upper", "LOWER": "lower", "DOWNCASE": "lower", "TRIM": "trim", "LTRIM": "ltrim", "RTRIM": "rtrim",
    "STRLENGTH": "length", "LEN": "length", "SUBSTR": "substr({0}, {1} + 1, {2})", "STRING": "string({0})", "INT": "bigint({0})", "INTEGER": "bigint({0})", "BOOL": "boolean({0})", "REAL": "double({0})",
    "SUM": "aggregate({0}, double(0), (a, x) -> a + x)", "MEAN": "(aggregate({0}, double(0), (a, x) -> a + x) / size({0}))", "ANY": "exists({0}, x -> x)", "ALL": "forall({0}, x -> x)",
    "NTRUE": "size(filter({0}, x -> x))", "NFALSE": "size(filter({0}, x -> NOT x))", "REVERSE": "reverse({0})", "FLATTEN": "flatten({0})",
}


@dataclass
class Query:
    items: list[tuple[tuple, str | None]] = field(default_factory=list)  # empty: all columns
    distinct: bool = False
    sources: list[tuple] = field(default_factory=list)  # (source, alias, kind of join, condition)
    where: tuple | None = None
    group: list[tuple] | None = None
    having: tuple | None = None
    order: list[tuple[tuple, bool]] = field(default_factory=list)
    limit: int | None = None
    offset: int | None = None
    giving: str | None = None


class Parser:
    """Recursive descent over the text; the tree's nodes are tuples."""

    def __init__(self, text: str):
        self.text, self.at = text, 0

    # tokens

    def _scan(self) -> tuple[str, str, int]:
        at = self.at
        while True:
            if at >= len(self.text):
                return "end", "", at
            m = _TOKEN.match(self.text, at)
            if not m:
                raise QueryError(f"unexpected {self.text[at]!r} at {at}")
            at = m.end()
            if m.lastgroup:
                return m.lastgroup, m[0], at

    def peek(self) -> tuple[str, str]:
        kind, text, _ = self._scan()
        return kind, text

    def next(self) -> tuple[str, str]:
        kind, text, self.at = self._scan()
        return kind, text

    def word(self, *words: str) -> bool:
        """Take the next token if it is one of these words."""
        kind, text = self.peek()
        if kind == "name" and text.upper() in words:
            self.next()
            return True
        return False

    def op(self, *ops: str) -> str | None:
        kind, text = self.peek()
        if kind == "op" and text in ops:
            self.next()
            return text
        return None

    def need(self, what: str) -> None:
        kind, text = self.next()
        if text.upper() != what:
            raise QueryError(f"{what} is expected, not {text or 'the end'!r}")

    # clauses

    def statement(self) -> tuple:
        if self.word("SELECT"):
            out = ("select", self.select())
        elif self.word("CREATE"):
            out = self.create()
        elif self.word("UPDATE"):
            out = self.update()
        elif self.word("DELETE"):
            self.need("FROM")
            source = self.source()
            out = ("delete", source, self.expr() if self.word("WHERE") else None)
        else:
            raise QueryError(f"SELECT, CREATE, UPDATE or DELETE is expected, not {self.peek()[1]!r}")
        if self.peek()[0] != "end":
            raise QueryError(f"unexpected {self.peek()[1]!r}")
        return out

    def select(self) -> Query:
        q = Query(distinct=self.word("DISTINCT"))
        if self.op("*"):
            pass
        elif not (self.peek()[0] == "name" and self.peek()[1].upper() == "FROM"):
            while True:
                e = self.expr()
                name = self.next()[1] if self.word("AS") else None
                q.items.append((e, name))
                if not self.op(","):
                    break
        self.need("FROM")
        while True:
            q.sources.append((self.source(), self._alias(), "cross", None))
            if not self.op(","):
                break
        while True:
            kind = "left" if self.word("LEFT") else "inner"
            if kind == "inner":
                self.word("INNER")
            if not self.word("JOIN"):
                break
            source, name = self.source(), self._alias()
            self.need("ON")
            q.sources.append((source, name, kind, self.expr()))
        while True:
            if self.word("WHERE"):
                q.where = self.expr()
            elif self.word("GROUPBY") or (self.word("GROUP") and self._by()):
                q.group = self._list()
            elif self.word("HAVING"):
                q.having = self.expr()
            elif self.word("ORDERBY") or (self.word("ORDER") and self._by()):
                while True:
                    e = self.expr()
                    q.order.append((e, not self.word("DESC")))
                    self.word("ASC")
                    if not self.op(","):
                        break
            elif self.word("LIMIT"):
                q.limit = self._whole()
            elif self.word("OFFSET"):
                q.offset = self._whole()
            elif self.word("GIVING"):
                q.giving = self.path()
            else:
                return q

    def _by(self) -> bool:
        self.need("BY")
        return True

    def _alias(self) -> str | None:
        if self.word("AS"):
            return self.next()[1]
        kind, text = self.peek()
        if kind == "name" and text.upper() not in _CLAUSES:
            return self.next()[1]
        return None

    def _whole(self) -> int:
        kind, text = self.next()
        if kind != "num" or not text.isdigit():
            raise QueryError(f"a whole number is expected, not {text!r}")
        return int(text)

    def _list(self) -> list[tuple]:
        out = [self.expr()]
        while self.op(","):
            out.append(self.expr())
        return out

    def path(self) -> str:
        m = _PATH.match(self.text, self.at)
        if not m:
            raise QueryError("a table is expected")
        self.at = m.end()
        return next(x for x in m.groups() if x is not None)

    def source(self) -> tuple:
        kind, text = self.peek() if self.text[self.at :].lstrip()[:1] in ("$", "(", "[") else ("path", "")
        if kind == "arg":
            self.next()
            return ("arg", int(text[1:]))
        if kind == "op":
            close = ")" if self.next()[1] == "(" else "]"
            self.need("SELECT")
            q = self.select()
            if not self.op(close):
                raise QueryError(f"{close} is expected")
            return ("query", q)
        return ("path", self.path())

    def create(self) -> tuple:
        self.need("TABLE")
        path, cols, n = self.path(), {}, 0
        close = {"[": "]", "(": ")"}.get(self.op("[", "(") or "")
        if close:
            while not self.op(close):
                name, kind = self.next()[1], self.next()[1].upper()
                if kind not in _TYPES:
                    raise QueryError(f"unknown type {kind}")
                cols[name] = D.column(_TYPES[kind])
                self.op(",")
        if self.word("LIMIT"):
            n = self._whole()
        return ("create", path, cols, n)

    def update(self) -> tuple:
        source = self.source()
        self.need("SET")
        sets = []
        while True:
            name = self.next()[1]
            if not self.op("=", "=="):
                raise QueryError("= is expected")
            sets.append((name, self.expr()))
            if not self.op(","):
                break
        return ("update", source, sets, self.expr() if self.word("WHERE") else None)

    # expressions, loosest first

    def expr(self) -> tuple:
        left = self._and()
        while self.op("||") or self.word("OR"):
            left = ("binary", "OR", left, self._and())
        return left

    def _and(self) -> tuple:
        left = self._not()
        while self.op("&&") or self.word("AND"):
            left = ("binary", "AND", left, self._not())
        return left

    def _not(self) -> tuple:
        if self.op("!") or self.word("NOT"):
            return ("not", self._not())
        return self._compare()

    def _compare(self) -> tuple:
        left = self._sum()
        negate = self.word("NOT")
        if self.word("IN"):
            close = {"[": "]", "(": ")"}.get(self.op("[", "(") or "")
            if not close:
                raise QueryError("a list is expected after IN")
            out = ("in", left, self._list())
            if not self.op(close):
                raise QueryError(f"{close} is expected")
        elif self.word("BETWEEN"):
            low = self._sum()
            self.need("AND")
            out = ("between", left, low, self._sum())
        elif self.word("LIKE"):
            out = ("binary", "LIKE", left, self._sum())
        elif op := self.op("==", "=", "!=", "<>", "<=", ">=", "<", ">"):
            return ("binary", {"==": "=", "!=": "<>"}.get(op, op), left, self._sum())
        else:
            return left
        return ("not", out) if negate else out

    def _sum(self) -> tuple:
        left = self._product()
        while op := self.op("+", "-"):
            left = ("binary", op, left, self._product())
        return left

    def _product(self) -> tuple:
        left = self._unary()
        while op := self.op("*", "//", "/", "%"):
            left = ("binary", op, left, self._unary())
        return left

    def _unary(self) -> tuple:
        if op := self.op("-", "+"):
            x = self._unary()
            return ("minus", x) if op == "-" else x
        base = self._primary()
        return ("call", "POW", [base, self._unary()]) if self.op("**") else base

    def _primary(self) -> tuple:
        kind, text = self.next()
        if kind == "num":
            return ("number", text)
        if kind == "str":
            return ("string", text[1:-1].replace("''", "'") if text[0] == "'" else text[1:-1])
        if kind == "op" and text == "(":
            e = self.expr()
            if not self.op(")"):
                raise QueryError(") is expected")
            return e
        if kind == "op" and text == "[":
            e = ("array", self._list())
            if not self.op("]"):
                raise QueryError("] is expected")
            return e
        if kind == "name":
            if self.op("("):
                args: list[tuple] = []
                if not self.op(")"):
                    args = self._list()
                    if not self.op(")"):
                        raise QueryError(") is expected")
                return ("call", text.upper(), args)
            if self.op("."):
                return ("column", self.next()[1], text)
            if text.upper() in ("TRUE", "FALSE", "T", "F"):
                return ("bool", text.upper()[0] == "T")
            return ("column", text, None)
        raise QueryError(f"an expression is expected, not {text or 'the end'!r}")


def _aggregates(e) -> bool:
    if isinstance(e, tuple):
        if e and e[0] == "call" and (e[1] in _AGGREGATES or e[1] in ("GAGGR", "GROWID")):
            return True
        return any(_aggregates(x) for x in e[1:])
    return isinstance(e, list) and any(_aggregates(x) for x in e)


def _quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


@dataclass
class Emitter:
    """SQL text of expressions. ``columns``: known columns, by alias of their table."""

    columns: dict[str, list[str]]
    grouped: bool = False

    def sql(self, e: tuple) -> str:
        return getattr(self, f"_{e[0]}")(*e[1:])

    def _number(self, text: str) -> str:
        return text if text.isdigit() else f"double('{text}')"

    def _string(self, text: str) -> str:
        return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"

    def _bool(self, value: bool) -> str:
        return "true" if value else "false"

    def _array(self, items: list) -> str:
        return f"array({', '.join(map(self.sql, items))})"

    def _column(self, name: str, table: str | None) -> str:
        if table is not None and table not in self.columns:
            raise QueryError(f"there is no table {table}")
        owners = [t for t, cols in self.columns.items() if (table is None or t == table) and any(c.lower() == name.lower() for c in cols)]
        if not owners:
            raise QueryError(f"Column {name} does not exist")
        if len(owners) > 1:
            raise QueryError(f"column {name} is in more than one table")
        return f"{_quote(owners[0])}.{_quote(name)}"

    def _row(self) -> str:
        return f"{_quote(next(iter(self.columns)))}.`{ROW}`"

    def _not(self, x: tuple) -> str:
        return f"(NOT {self.sql(x)})"

    def _minus(self, x: tuple) -> str:
        return f"(-{self.sql(x)})"

    def _in(self, x: tuple, items: list) -> str:
        return f"({self.sql(x)} IN ({', '.join(map(self.sql, items))}))"

    def _between(self, x: tuple, low: tuple, high: tuple) -> str:
        return f"({self.sql(x)} BETWEEN {self.sql(low)} AND {self.sql(high)})"

    def _binary(self, op: str, a: tuple, b: tuple) -> str:
        x, y = self.sql(a), self.sql(b)
        if op == "//":
            return f"floor({x} / {y})"
        return f"({x} {op} {y})"

    def _call(self, name: str, args: list) -> str:
        if name in ("ROWID", "ROWNUMBER", "ROWNR"):
            return self._row() if name == "ROWID" else f"({self._row()} + 1)"
        got = [self.sql(a) for a in args]
        if name == "GROWID":
            return f"array_sort(collect_list({self._row()}))"
        if name == "GAGGR":
            if len(got) != 1:
                raise QueryError("GAGGR takes one argument")
            return f"transform(array_sort(collect_list(struct({self._row()} AS r, {got[0]} AS x)), (a, b) -> CASE WHEN a.r < b.r THEN -1 WHEN a.r > b.r THEN 1 ELSE 0 END), s -> s.x)"
        if name in _AGGREGATES:
            if name == "GCOUNT" and not got:
                return "count(1)"
            return self._fill(_AGGREGATES[name].replace(f"`{ROW}`", self._row()), got, name)
        if name in ("MIN", "MAX"):
            return f"array_{name.lower()}({got[0]})" if len(got) == 1 else f"{'least' if name == 'MIN' else 'greatest'}({', '.join(got)})"
        if name in ("NELEMENTS", "COUNT"):
            return f"size({got[0]})"
        form = _FUNCTIONS.get(name)
        if form is None:
            raise QueryError(f"unknown function {name}")
        return self._fill(form, got, name) if "{" in form or "(" in form else f"{form}({', '.join(got)})"

    def _fill(self, form: str, got: list[str], name: str) -> str:
        try:
            return re.sub(r"\{(\d)\}", lambda m: got[int(m[1])], form)
        except IndexError:
            raise QueryError(f"{name} lacks an argument") from None


def _named(e: tuple, name: str | None, k: int) -> str:
    return name or (e[1] if e[0] == "column" else f"Col_{k + 1}")


class _Runner:
    def __init__(self, spark: SparkSession, tables: list[Table]):
        self.spark, self.tables = spark, tables
        self.views: list[str] = []

    def _table(self, source: tuple) -> Table:
        if source[0] == "arg":
            if not 1 <= source[1] <= len(self.tables):
                raise QueryError(f"there is no table argument ${source[1]}")
            return self.tables[source[1] - 1]
        if source[0] == "query":
            return self.select(source[1])
        return Table.from_filename(source[1], spark=self.spark)

    def _view(self, df: DataFrame) -> str:
        name = f"hypercell_{uuid.uuid4().hex}"
        df.createOrReplaceTempView(name)
        self.views.append(name)
        return name

    def drop(self) -> None:
        for v in self.views:
            self.spark.catalog.dropTempView(v)

    def select(self, q: Query) -> Table:
        found = [(self._table(s), alias or f"t{k}", kind, on) for k, (s, alias, kind, on) in enumerate(q.sources)]
        if any(kind == "cross" for _, _, kind, _ in found[1:]):
            raise NotSupported("tables are joined with JOIN ... ON, not with a comma")
        emit = Emitter({alias: [*t.columns(), ROW] for t, alias, _, _ in found})
        parts = []
        for k, (t, alias, kind, on) in enumerate(found):
            view = f"{self._view(t.df)} AS {_quote(alias)}"
            parts.append(view if not k else f"{kind.upper()} JOIN {view} ON {emit.sql(on)}")
        items = q.items or [(("column", c, alias), c) for t, alias, _, _ in found for c in t.columns()]
        names = [_named(e, n, k) for k, (e, n) in enumerate(items)]
        if len({n.lower() for n in names}) != len(names):
            raise QueryError("two result columns have one name")
        by_name = {n.lower(): e for n, (e, _) in zip(names, items, strict=True)}
        order = []
        for e, up in q.order:
            if e[0] == "column" and e[2] is None and e[1].lower() in by_name and not any(c.lower() == e[1].lower() for cols in emit.columns.values() for c in cols):
                e = by_name[e[1].lower()]
            order.append((e, up))
        grouped = q.group is not None or q.having is not None or any(_aggregates(e) for e, _ in items)
        row = emit._row()
        out = [f"{emit.sql(e)} AS {_quote(n)}" for (e, _), n in zip(items, names, strict=True)]
        out += [f"{emit.sql(e)} AS __o{k}" for k, (e, _) in enumerate(order)]
        out.append(f"{f'min({row})' if grouped else row} AS __src__")
        sql = f"SELECT {', '.join(out)} FROM {' '.join(parts)}"
        if q.where:
            sql += f" WHERE {emit.sql(q.where)}"
        if q.group:
            sql += f" GROUP BY {', '.join(map(emit.sql, q.group))}"
        if q.having:
            sql += f" HAVING {emit.sql(q.having)}"
        if q.distinct:
            keys = ", ".join(map(_quote, names))
            sql = f"SELECT {keys}, {''.join(f'min(__o{k}) AS __o{k}, ' for k in range(len(order)))}min(__src__) AS __src__ FROM ({sql}) GROUP BY {keys}"
        ordering = [*(f"__o{k} {'ASC' if up else 'DESC'}" for k, (_, up) in enumerate(order)), "__src__"]
        far = (q.limit or 0) + (q.offset or 0) > TOP
        if (q.limit is not None or q.offset) and not far:
            sql += f" ORDER BY {', '.join(ordering)}" + (f" LIMIT {q.limit}" if q.limit is not None else "") + (f" OFFSET {q.offset}" if q.offset else "")
        df = self.spark.sql(sql)
        desc = D.of_schema(df.select(*names).schema)
        for (e, _), n in zip(items, names, strict=True):
            if e[0] == "column":
                owner = next(t for t, alias, _, _ in found if (e[2] is None or alias == e[2]) and any(c.lower() == e[1].lower() for c in t.columns()))
                desc[n] = next(v for c, v in owner._desc.items() if c.lower() == e[1].lower())
        by = [F.col(f"__o{k}").asc() if up else F.col(f"__o{k}").desc() for k, (_, up) in enumerate(order)]
        result = Table(self.spark, df, desc, order=[*by, F.col("__src__")])
        if far:
            skip = q.offset or 0
            part = F.col(ROW) >= skip if q.limit is None else F.col(ROW).between(skip, skip + q.limit - 1)
            result = Table(self.spark, result.df.where(part).withColumn(ROW, F.col(ROW) - skip), desc)
        if q.giving:
            return write_table(result.df.select(ROW, *names), q.giving, desc, row=ROW)
        return result

    def create(self, path: str, cols: dict, n: int) -> Table:
        t = create(self.spark, path, cols)
        if n:
            t.addrows(n)
        return t

    def update(self, source: tuple, sets: list, where: tuple | None) -> Table:
        t = self._table(source)
        store = t._writable()
        emit = Emitter({"t0": [*t.columns(), ROW]})
        view = self._view(t.df)
        new = dict(sets)
        for c in new:
            t._column(c)
        cond = emit.sql(where) if where else "true"
        kinds = {f.name: f.dataType.simpleString() for f in t.df.schema.fields}
        cols = [f"CASE WHEN {cond} THEN CAST({emit.sql(new[c])} AS {kinds[c]}) ELSE `t0`.{_quote(c)} END AS {_quote(c)}" if c in new else f"`t0`.{_quote(c)}" for c in t.columns()]
        t._commit(store, self.spark.sql(f"SELECT `t0`.`{ROW}`, {', '.join(cols)} FROM {view} AS `t0`"), t._desc, clustered=True)
        return t

    def delete(self, source: tuple, where: tuple | None) -> Table:
        t = self._table(source)
        store = t._writable()
        emit = Emitter({"t0": [*t.columns(), ROW]})
        view = self._view(t.df)
        kept = self.spark.sql(f"SELECT * FROM {view} AS `t0` WHERE {f'NOT coalesce({emit.sql(where)}, false)' if where else 'false'}")
        t._commit(store, number_rows(kept.withColumnRenamed(ROW, "__old__"), [F.col("__old__")]), t._desc)
        return t


def run(spark: SparkSession, query: str, tables: list[Table]) -> Table:
    """Parse and run a query; malformed ones raise QueryError."""
    kind, *rest = Parser(query).statement()
    runner = _Runner(spark, tables)
    try:
        return getattr(runner, kind)(*rest)
    finally:
        runner.drop()
