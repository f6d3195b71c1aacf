"""Selections in several dimensions, normalised on the driver.

A dimension is selected by ``None`` or ``slice(None)`` (all of it), a slice of step 1, or a list or 1-d array of indices
in the wanted order. An empty list means all as well. A negative index skips its place: nothing is read or written there.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Span:
    """Indices ``start`` to ``stop - 1``; an open end is None."""

    start: int
    stop: int | None

    def bounded(self, size: int) -> "Span":
        return Span(self.start, size if self.stop is None else self.stop)


@dataclass(frozen=True)
class Points:
    """Indices in the wanted order."""

    index: tuple[int, ...]

    @property
    def highest(self) -> int:
        return max(self.index)

    @property
    def run(self) -> Span | None:
        """The span that these indices are, if they are one."""
        a = self.index[0]
        return Span(a, a + len(self.index)) if a >= 0 and self.index == tuple(range(a, a + len(self.index))) else None


Dim = Span | Points | None
Index = Sequence | None


def _dimension(d: int, x) -> Dim:
    if x is None:
        return None
    if isinstance(x, slice):
        if x.step not in (None, 1):
            raise ValueError(f"slice step {x.step} is not 1")
        if x.start is None and x.stop is None:
            return None
        start = 0 if x.start is None else int(x.start)
        if start < 0 or (x.stop is not None and x.stop < 0):
            raise ValueError(f"slice {x} in dimension {d} has a negative bound")
        return Span(start, None if x.stop is None else int(x.stop))
    if isinstance(x, np.ndarray):
        if x.ndim != 1:
            raise ValueError(f"Multi-dimensional ndarray received as index in dimension {d}")
        if x.size and x.dtype.kind not in "iu":
            raise TypeError(f"Invalid index type {x.dtype} for dimension {d}")
        x = x.tolist()
    if not isinstance(x, list):
        raise TypeError(f"Invalid index type {type(x)} for dimension {d}")
    if not x:
        return None
    if any(isinstance(i, bool) or not isinstance(i, (int, np.integer)) for i in x):
        raise TypeError(f"Invalid index in dimension {d}: whole numbers are needed")
    got = tuple(int(i) for i in x)
    real = [i for i in got if i >= 0]
    if len(set(real)) != len(real):
        raise IndexError(f"dimension {d} selects an index twice")
    return Points(got)


def normalise(index: Index) -> tuple[Dim, ...]:
    """The dimensions of an index, rows first."""
    if index is None:
        return ()
    if not isinstance(index, (tuple, list)):
        raise TypeError("index must be a tuple of (None, slices or numpy arrays), or None")
    return tuple(_dimension(d, x) for d, x in enumerate(index))


def rows_only(index: Index) -> Dim:
    """The row selection of an index that may not select anything else."""
    dims = normalise(index)
    if len(dims) > 1:
        raise IndexError("only rows can be selected here")
    return dims[0] if dims else None


def extent(dim: Dim, size: int) -> int:
    """Places that a dimension of ``size`` gives; raises IndexError beyond it."""
    if dim is None:
        return size
    if isinstance(dim, Span):
        b = dim.bounded(size)
        if b.stop > size:
            raise IndexError(f"indices to {b.stop - 1} exceed a dimension of {size}")
        return max(0, b.stop - b.start)
    if dim.highest >= size:
        raise IndexError(f"index {dim.highest} exceeds a dimension of {size}")
    return len(dim.index)


def indices(dim: Dim, size: int) -> list[int]:
    if dim is None:
        return list(range(size))
    if isinstance(dim, Span):
        return list(range(dim.start, dim.bounded(size).stop))
    return list(dim.index)
