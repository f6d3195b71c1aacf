"""Rows by position."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hypercell.functions.selection import Dim, Points, Span
from hypercell.sources.descriptor import ROW
from hypercell.sources.storage import shared_folder

POS = "__pos__"
#: Row lists of up to so many entries are broadcast; longer ones are joined by a shuffle.
BROADCAST_ROWS = 1_000_000


def select_rows(df: DataFrame, rows: Dim) -> DataFrame:
    """The selected rows with ``__pos__``, their place in the selection.

    A run of rows is a range filter, which Parquet statistics prune; a list is joined. A negative row gives a row of nulls.
    """
    if rows is None:
        return df.withColumn(POS, F.col(ROW))
    run = rows.run if isinstance(rows, Points) else rows
    if isinstance(run, Span):
        ok = F.col(ROW) >= run.start
        if run.stop is not None:
            ok &= F.col(ROW) < run.stop
        return df.where(ok).withColumn(POS, F.col(ROW) - run.start)
    wanted = df.sparkSession.createDataFrame(list(enumerate(rows.index)), f"{POS} long, wanted long")
    real = [i for i in rows.index if i >= 0]
    near = df.where(F.col(ROW).between(min(real), max(real))) if real else df.where(F.lit(False))
    if all(i >= 0 for i in rows.index):
        right = F.broadcast(wanted) if len(rows.index) <= BROADCAST_ROWS else wanted
        return near.join(right, F.col(ROW) == F.col("wanted")).drop("wanted")
    # The list is the outer side; only its matches come from the table.
    hits = near.join(F.broadcast(wanted) if len(rows.index) <= BROADCAST_ROWS else wanted, F.col(ROW) == F.col("wanted"), "left_semi")
    return wanted.join(hits, F.col(ROW) == F.col("wanted"), "left").drop("wanted")


def number_rows(df: DataFrame, order: list[Column], name: str = ROW) -> DataFrame:
    """Consecutive numbers from 0 in the given order.

    The sorted rows stay dealt over partitions; only the partitions' row counts meet in the driver. The rows are checkpointed
    between, so that both passes see the same partitions.
    """
    spark = df.sparkSession
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_folder(spark))
    dealt = df.orderBy(*order).withColumn("__at__", F.monotonically_increasing_id()).checkpoint()
    part = F.shiftright("__at__", 33).cast("int")
    counts = sorted((r["p"], r["n"]) for r in dealt.groupBy(part.alias("p")).agg(F.count("*").alias("n")).collect())
    base, total = [], 0
    for p, n in counts:
        base.append((p, total))
        total += n
    first = spark.createDataFrame(base, "__part__ int, __first__ long")
    within = F.col("__at__") - F.shiftleft(F.shiftright("__at__", 33), 33)
    return dealt.withColumn("__part__", part).join(F.broadcast(first), "__part__").withColumn(name, F.col("__first__") + within).drop("__part__", "__first__", "__at__")


def runs(df: DataFrame, key: str = ROW) -> DataFrame:
    """Runs of consecutive values of ``key``: ``start``, ``stop`` (the last one) and ``n``.

    Values are dealt by ranges of 2**20, numbered within each, and runs that touch a range's ends are joined by a second pass
    over the few that do, so no window holds the whole table.
    """
    from pyspark.sql import Window

    src = df.select(F.col(key).cast("long").alias("k")).where("k is not null").distinct().withColumn("cell", F.shiftright("k", 20))
    w = Window.partitionBy("cell").orderBy("k")
    parts = src.withColumn("g", F.col("k") - F.row_number().over(w)).groupBy("cell", "g").agg(F.min("k").alias("start"), F.max("k").alias("stop"))
    # A run that begins where a range does belongs to the run that ends just before, if there is one.
    ends = parts.select((F.col("stop") + 1).alias("start"), F.lit(True).alias("joined"))
    marked = parts.join(ends, "start", "left")
    order = Window.orderBy("start")
    crossing = marked.where((F.col("start") % (1 << 20) == 0) | ((F.col("stop") + 1) % (1 << 20) == 0))
    inside = marked.join(crossing.select("start"), "start", "left_anti").select("start", "stop")
    joined = crossing.withColumn("run", F.sum(F.when(F.col("joined"), 0).otherwise(1)).over(order)).groupBy("run").agg(F.min("start").alias("start"), F.max("stop").alias("stop")).drop("run")
    return inside.unionByName(joined).select("start", "stop", (F.col("stop") - F.col("start") + 1).alias("n"))
