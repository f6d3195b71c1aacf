"""A self-check: writes a small table, reads it back and compares."""

from __future__ import annotations

import tempfile

import numpy as np
from pyspark.sql import SparkSession

from hypercell.operators.table import Table
from hypercell.sources import descriptor as D

ANTENNAS, CHANNELS, CORRELATIONS = 8, 16, 4


def sanity(spark: SparkSession | None = None) -> None:
    """Raises AssertionError if what is read is not what was written."""
    a1, a2 = np.triu_indices(ANTENNAS, 1)
    n = len(a1)
    data = {
        "TIME": np.linspace(0.0, 1.0, n),
        "ANTENNA1": a1.astype(np.int32),
        "ANTENNA2": a2.astype(np.int32),
        "NAMES": np.array([f"{x}&{y}" for x, y in zip(a1, a2, strict=True)], dtype=object),
        "DATA": np.arange(n * CHANNELS * CORRELATIONS).reshape(n, CHANNELS, CORRELATIONS) * (1 + 1j),
        "FLAG": (np.arange(n * CHANNELS * CORRELATIONS) % 2 == 0).reshape(n, CHANNELS, CORRELATIONS),
    }
    desc = {"NAMES": D.column("string"), "DATA": D.column("dcomplex", shape=[CHANNELS, CORRELATIONS]), "FLAG": D.column("boolean", shape=[CHANNELS, CORRELATIONS])}
    with tempfile.TemporaryDirectory() as d, Table.ms_from_descriptor(f"{d}/sanity.ms", table_desc=desc, spark=spark) as t:
        t.addrows(n)
        for c, x in data.items():
            t.putcol(c, x)
        for c, x in data.items():
            got = t.getcol(c)
            assert got.shape == x.shape and (got == x).all(), c
