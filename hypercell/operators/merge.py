"""Merge of sorted partitions."""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from hypercell.errors import InvalidTable

_KINDS = {"int32": T.IntegerType(), "int64": T.LongType(), "float32": T.FloatType(), "float64": T.DoubleType()}


def merge_partitions(parts: list[DataFrame], keys: list[str] | None = None) -> DataFrame:
    """One DataFrame in ascending order of all columns (or ``keys``, then the rest): a range exchange and a sort of each range,
    so the order holds across partitions. NaN comes after all numbers."""
    if not parts:
        raise InvalidTable("there is nothing to merge")
    names = parts[0].columns
    for p in parts[1:]:
        if sorted(p.columns) != sorted(names):
            raise InvalidTable("partitions have different columns")
        for c in names:
            if p.schema[c].dataType != parts[0].schema[c].dataType:
                raise InvalidTable(f"type mismatch in column {c}")
    order = [*(keys or []), *(c for c in names if c not in (keys or []))]
    return reduce(DataFrame.unionByName, parts).orderBy(*order)


def merge_np_partitions(parts: list[dict[str, np.ndarray]], spark: SparkSession | None = None) -> dict[str, np.ndarray]:
    """Arrays of all partitions in ascending order of the first partition's columns; ``[]`` gives ``{}``."""
    if not parts:
        return {}
    names = list(parts[0])
    for p in parts:
        if len(p) != len(names):
            raise InvalidTable("partitions have different numbers of arrays")
        for c in names:
            if c not in p:
                raise InvalidTable(f"a partition has no array {c}")
            a = p[c]
            if a.ndim != 1:
                raise InvalidTable(f"array {c} is not 1D")
            if len(a) != len(p[names[0]]):
                raise InvalidTable("arrays of a partition have different lengths")
            if str(a.dtype) not in _KINDS:
                raise InvalidTable(f"type {a.dtype} of array {c} is not supported")
            if a.dtype != parts[0][c].dtype:
                raise InvalidTable(f"type mismatch in array {c}")
    import pandas as pd

    spark = spark or SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()
    schema = T.StructType([T.StructField(c, _KINDS[str(parts[0][c].dtype)]) for c in names])
    frames = [spark.createDataFrame(pd.DataFrame({c: p[c] for c in names}), schema) for p in parts]
    got = merge_partitions(frames, names).toArrow()
    return {c: got.column(c).to_numpy().astype(parts[0][c].dtype) for c in names}
