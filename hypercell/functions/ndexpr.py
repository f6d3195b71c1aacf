"""Column expressions over nested-array cells: gather, scatter, shape, reshape, flatten, complex pairs.

All are built-in functions that run in the JVM. A contiguous run becomes ``slice``, other selections ``transform`` over a literal
index list. In array dimensions index 0 is the outermost (C order).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hypercell.functions.selection import Dim, Points, Span
from hypercell.functions.types import nested


def _checked(ok: Column, value: Column, what: str) -> Column:
    return F.when(ok, value).otherwise(F.raise_error(F.lit(what)))


def filled(sizes: Sequence[Column], value, kind: T.DataType) -> Column:
    """A nested array of one value."""
    out = F.lit(value).cast(kind)
    for n in reversed(sizes):
        out = F.array_repeat(out, n.cast("int"))
    return out


def sizes(cell: Column, depth: int) -> list[Column]:
    """Lengths of the levels, read along the first elements."""
    out = []
    for _ in range(depth):
        out.append(F.size(cell))
        cell = F.get(cell, F.lit(0))
    return out


def shape(cell: Column, depth: int) -> Column:
    """Shape as an array, outermost first; null for a null cell."""
    return F.when(cell.isNull(), F.lit(None)).otherwise(F.array(*[n.cast("int") for n in sizes(cell, depth)]) if depth else F.array(F.lit(1)))


def gather(cell: Column, dims: Sequence[Dim], depth: int, kind: T.DataType, fill=None) -> Column:
    """The selected elements in the wanted order.

    Dimensions beyond ``depth`` are ignored. A negative index gives ``fill`` (null if that is None) in all that lies below it; an
    index beyond the cell raises an error.
    """
    dims = list(dims[:depth]) + [None] * (depth - len(dims))
    while dims and dims[-1] is None and len(dims) > 0:
        dims.pop()
    return F.when(cell.isNotNull(), _gather(cell, dims, depth, kind, fill)) if dims else cell


def _gather(cell: Column, dims: list[Dim], depth: int, kind: T.DataType, fill) -> Column:
    if not dims:
        return cell
    dim, rest = dims[0], dims[1:]
    run = dim.run if isinstance(dim, Points) else dim
    if dim is None:
        return F.transform(cell, lambda x: _gather(x, rest, depth - 1, kind, fill))
    if run is not None:
        n = F.lit(run.stop - run.start) if run.stop is not None else F.greatest(F.size(cell) - run.start, F.lit(0))
        part = F.slice(cell, run.start + 1, n)
        if run.stop is not None:
            part = _checked(F.size(cell) >= run.stop, part, f"indices to {run.stop - 1} exceed a cell's dimension")
        return F.transform(part, lambda x: _gather(x, rest, depth - 1, kind, fill)) if any(d is not None for d in rest) else part
    wanted = F.lit(list(dim.index)).cast("array<int>")

    def pick(i: Column) -> Column:
        x = F.get(cell, i)
        x = _gather(x, rest, depth - 1, kind, fill)
        if min(dim.index) >= 0:
            return x
        if fill is None:
            gap = F.lit(None).cast(nested(kind, depth - 1))
        else:
            below = sizes(F.get(cell, F.lit(0)), depth - 1)
            gap = filled([_extent(d, n) for d, n in zip([*rest, *[None] * (depth - 1 - len(rest))], below, strict=True)], fill, kind)
        return F.when(i < 0, gap).otherwise(x)

    return _checked(F.size(cell) > max(dim.highest, -1), F.transform(wanted, pick), f"index {dim.highest} exceeds a cell's dimension")


def _extent(dim: Dim, size: Column) -> Column:
    if dim is None:
        return size
    if isinstance(dim, Span):
        return F.lit(dim.stop - dim.start) if dim.stop is not None else F.greatest(size - dim.start, F.lit(0))
    return F.lit(len(dim.index))


def scatter(cell: Column, update: Column, dims: Sequence[Dim], depth: int) -> Column:
    """The cell with the elements of ``update`` put at the selected places; negative places are skipped, null elements too."""
    dims = list(dims[:depth]) + [None] * (depth - len(dims))
    return _scatter(cell, update, dims)


def _scatter(cell: Column, update: Column, dims: list[Dim]) -> Column:
    if not dims:
        return F.coalesce(update, cell)
    dim, rest = dims[0], dims[1:]
    if dim is None:
        ok = F.size(cell) == F.size(update)
        return _checked(ok, F.transform(cell, lambda x, i: _scatter(x, F.get(update, i), rest)), "the update's shape is not the selection's")
    if isinstance(dim, Span):
        a, b = dim.start, dim.stop
        inside = (lambda i: (i >= a) & (i < b)) if b is not None else (lambda i: i >= a)
        body = F.transform(cell, lambda x, i: F.when(inside(i), _scatter(x, F.get(update, i - a), rest)).otherwise(x))
        return _checked(F.size(cell) >= (b if b is not None else a), body, f"indices to {(b or a) - 1} exceed a cell's dimension")
    place = F.lit(list(dim.index)).cast("array<int>")

    def put(x: Column, i: Column) -> Column:
        at = F.array_position(place, i).cast("int")
        return F.when(at > 0, _scatter(x, F.get(update, at - 1), rest)).otherwise(x)

    return _checked(F.size(cell) > dim.highest, F.transform(cell, put), f"index {dim.highest} exceeds a cell's dimension")


def corner(cell: Column, shape_: Sequence[int]) -> Column:
    """The leading corner of a cell."""
    dims = [Span(0, n) for n in shape_]
    return _gather(cell, dims, len(dims), T.NullType(), None)


def flat(cell: Column, depth: int) -> Column:
    """All elements in C order."""
    for _ in range(depth - 1):
        cell = F.flatten(cell)
    return cell


def reshape(cell: Column, shape_: Sequence[int]) -> Column:
    """A flat array as nested arrays of a fixed shape; the last level is innermost."""
    total = reduce(lambda a, b: a * b, shape_, 1)
    out = _checked(F.size(cell) == total, cell, f"the cell has not {total} elements")
    for n in reversed(list(shape_)[1:]):
        total //= n
        out = _cut(out, total, n)
    return out


def _cut(flat_: Column, parts: int, n: int) -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(parts - 1)), lambda i: F.slice(flat_, i * n + 1, n))


def each(cell: Column, depth: int, change: Callable[[Column], Column]) -> Column:
    """Every element below ``depth`` levels changed."""
    return F.transform(cell, lambda x: each(x, depth - 1, change)) if depth else change(cell)


def has_null(cell: Column, depth: int) -> Column:
    """Whether an element at any level below the cell is null."""
    if not depth:
        return cell.isNull()
    return F.exists(cell, lambda x: x.isNull() | (F.coalesce(has_null(x, depth - 1), F.lit(False)) if depth > 1 else F.lit(False)))


def real(pair: Column) -> Column:
    return F.get(pair, F.lit(0))


def imag(pair: Column) -> Column:
    return F.get(pair, F.lit(1))


def power(pair: Column) -> Column:
    """Squared magnitude of a complex pair."""
    return real(pair) * real(pair) + imag(pair) * imag(pair)


def complex_product(a: Column, b: Column) -> Column:
    return F.array(real(a) * real(b) - imag(a) * imag(b), real(a) * imag(b) + imag(a) * real(b))


_TIMES = (T.TimestampType, T.TimestampNTZType)


def checked_cast(value: Column, source: T.DataType, name: str) -> Column:
    """A scalar cast that loses nothing, or raises an error: fractions, values out of range, and whole numbers that a floating
    type cannot hold. Strings are never cast. Nulls stay."""
    from hypercell.functions.types import cell_type

    target = cell_type(name)
    floats = (T.FloatType, T.DoubleType)
    if isinstance(source, T.StringType) != (target.name == "string"):
        return F.when(value.isNotNull(), F.raise_error(F.lit(f"strings are not cast to or from {name}")).cast(target.spark))
    if isinstance(source, _TIMES) != (target.name == "timestamp"):
        return F.when(value.isNotNull(), F.raise_error(F.lit(f"times are not cast to or from {name}")).cast(target.spark))
    if target.name in ("string", "timestamp"):
        return value.cast(target.spark)
    number = value.cast("int") if isinstance(source, T.BooleanType) else value
    if isinstance(target.spark, floats):
        if isinstance(source, (T.LongType, T.IntegerType)):
            limit = 1 << (24 if isinstance(target.spark, T.FloatType) else 53)
            return F.when(number.between(-limit, limit) | number.isNull(), number.cast(target.spark)).otherwise(F.raise_error(F.lit(f"a whole number is not exact as {name}")))
        return number.cast(target.spark)
    whole = (number == F.floor(number)) if isinstance(source, floats) else F.lit(True)
    ok = number.isNull() | (whole & number.between(target.low, target.high))
    return F.when(ok, number.cast(target.spark)).otherwise(F.raise_error(F.lit(f"a value does not fit {name}")))
