"""Cells in Arrow and numpy form, on the driver's side."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from hypercell.errors import InvalidTable
from hypercell.functions.types import CellType


def _plain(arr: pa.Array | pa.ChunkedArray) -> pa.Array:
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks() if arr.num_chunks != 1 else arr.chunk(0)
        if isinstance(arr, pa.ChunkedArray):
            arr = arr.chunk(0) if arr.num_chunks else pa.array([], arr.type)
    return arr


def _is_list(kind: pa.DataType) -> bool:
    return pa.types.is_list(kind) or pa.types.is_large_list(kind) or pa.types.is_fixed_size_list(kind)


def levels(kind: pa.DataType) -> int:
    n = 0
    while _is_list(kind):
        kind, n = kind.value_type, n + 1
    return n


def common_shape(arr: pa.Array) -> list[int] | None:
    """The shape that all cells share, or None if shapes differ or a cell is missing."""
    out = []
    while _is_list(arr.type):
        if arr.null_count:
            return None
        lens = np.diff(np.asarray(arr.offsets)) if not pa.types.is_fixed_size_list(arr.type) else np.full(len(arr), arr.type.list_size)
        if len(lens) and (lens != lens[0]).any():
            return None
        if not len(lens):
            return None
        out.append(int(lens[0]))
        arr = arr.flatten()
    return None if arr.null_count else out


def leaf(arr: pa.Array, kind: CellType) -> pa.Array:
    """Values in the value type's Arrow type."""
    if kind.name == "boolean" and pa.types.is_boolean(arr.type):
        return arr.cast(pa.uint8())
    return arr.cast(kind.arrow)


def to_arrow(arr: pa.Array | pa.ChunkedArray, kind: CellType, fixed: bool, empty_shape: list[int] | None = None) -> pa.Array:
    """Lists narrowed to the value type; as fixed-size lists if all cells share a shape and ``fixed`` is wanted. The pairs of complex
    numbers are of fixed size in either case that is fixed."""
    arr = _plain(arr)
    if not _is_list(arr.type):
        return leaf(arr, kind)
    shape = common_shape(arr)
    if not len(arr) and empty_shape is not None:
        shape = empty_shape
    if fixed and shape is not None:
        values = arr
        while _is_list(values.type):
            values = values.flatten()
        out = leaf(values, kind)
        for n in reversed(shape):
            out = pa.FixedSizeListArray.from_arrays(out, n)
        return out
    return _rebuild(arr, kind, fixed, levels(arr.type))


def _rebuild(arr: pa.Array, kind: CellType, fixed: bool, n: int) -> pa.Array:
    if not _is_list(arr.type):
        return leaf(arr, kind)
    inner = _rebuild(arr.flatten(), kind, fixed, n - 1)
    if fixed and kind.is_complex and n == 1 and not arr.null_count:
        return pa.FixedSizeListArray.from_arrays(inner, 2)
    lens = np.asarray(arr.value_lengths().fill_null(0))
    offsets = pa.array(np.concatenate(([0], np.cumsum(lens))).astype(np.int32))
    if arr.null_count:
        return pa.ListArray.from_arrays(offsets, inner, mask=arr.is_null())
    return pa.ListArray.from_arrays(offsets, inner)


def to_numpy(arr: pa.Array | pa.ChunkedArray, kind: CellType, name: str) -> tuple[np.ndarray, np.ndarray | None]:
    """Values in C order and a mask of missing ones, or None if there are none. Cells of different shapes raise TypeError."""
    arr = _plain(arr)
    if not _is_list(arr.type):
        if kind.name == "string":
            out = np.array(arr.to_pylist(), dtype=object)
        else:
            out = np.asarray(arr.fill_null(kind.default) if arr.null_count else arr).astype(kind.numpy)
        return out, np.asarray(arr.is_null()) if arr.null_count else None
    shape = [len(arr)]
    values = arr
    while _is_list(values.type):
        if values.null_count:
            raise TypeError(f"variably shaped column {name}: a cell is missing")
        lens = np.asarray(values.value_lengths())
        if len(lens) and (lens != lens[0]).any():
            raise TypeError(f"variably shaped column {name} has no numpy form")
        shape.append(int(lens[0]) if len(lens) else 0)
        values = values.flatten()
    mask = np.asarray(values.is_null()).reshape(shape) if values.null_count else None
    if kind.name == "string":
        flat = np.array(values.to_pylist(), dtype=object)
    else:
        flat = np.asarray(values.fill_null(kind.default) if values.null_count else values)
    out = flat.reshape(shape)
    if kind.is_complex:
        out = np.ascontiguousarray(out.astype(np.float32 if kind.numpy is np.complex64 else np.float64)).view(kind.numpy)[..., 0]
        mask = mask[..., 0] if mask is not None else None
    else:
        out = out.astype(kind.numpy) if kind.name != "string" else out
    return out, mask


def from_numpy(data: np.ndarray, kind: CellType) -> pa.Array:
    """Rows of nested lists for Spark, after a cast that loses nothing."""
    data = np.asarray(data)
    if (data.dtype.kind in "OUS") != (kind.name == "string"):
        raise TypeError(f"{data.dtype} data do not go into a {kind.name} column: strings are never cast")
    if kind.is_complex:
        if data.dtype.kind != "c":
            data = data.astype(np.complex128)
        pairs = np.ascontiguousarray(data.astype(np.complex128)).view(np.float64).reshape(*data.shape, 2)
        flat, shape = pairs.ravel(), pairs.shape
    else:
        if data.dtype.kind == "c":
            raise TypeError(f"complex data do not go into a {kind.name} column")
        flat, shape = np.ascontiguousarray(data).ravel(), data.shape
    if kind.name == "string":
        out = pa.array([None if x is None else str(x) for x in flat.tolist()], pa.string())
    elif kind.name == "boolean":
        if flat.dtype.kind != "b" and not np.isin(flat, (0, 1)).all():
            raise InvalidTable("a boolean column takes 0 and 1 only")
        out = pa.array(flat.astype(bool))
    else:
        source = pa.array(flat.astype(np.uint8) if flat.dtype.kind == "b" else flat)
        out = source.cast(kind.arrow, safe=True)
        wide = {pa.uint8(): pa.int16(), pa.uint16(): pa.int32(), pa.uint32(): pa.int64()}.get(kind.arrow)
        out = out.cast(wide) if wide else out
    for n in reversed(shape[1:]):
        out = pa.ListArray.from_arrays(pa.array(np.arange(0, len(out) + 1, n, dtype=np.int32) if n else np.zeros(int(np.prod(shape[:1])) + 1, np.int32)), out)
    return out
