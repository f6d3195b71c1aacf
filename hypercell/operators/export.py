"""Export to hive-partitioned Parquet, and such datasets read back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hypercell.operators.table import Table
from hypercell.sources import descriptor as D
from hypercell.sources.descriptor import ROW
from hypercell.sources.storage import Store

PARTITIONS, NROW = ("FIELD_ID", "PROCESSOR_ID", "DATA_DESC_ID"), 1000


def write_dataset(df: DataFrame, path: str, partition: Sequence[str] = (), nrow: int = NROW, order: Sequence[str] = ()) -> None:
    """``path/A=a/B=b/part-*.parquet`` with at most ``nrow`` rows a file; what is there is replaced.

    Rows are dealt by the partition columns and ranges of the order, so a large partition is written by many tasks, and a small
    one gives few files.
    """
    cols = [F.col(c) for c in partition]
    if cols or order:
        df = df.repartitionByRange(*cols, *[F.col(c) for c in order]).sortWithinPartitions(*cols, *[F.col(c) for c in order])
    writer = df.write.mode("overwrite").option("maxRecordsPerFile", nrow).format("parquet")
    (writer.partitionBy(*partition) if partition else writer).save(path)


def export(spark: SparkSession, ms: str, out: str, partition: Sequence[str] = PARTITIONS, nrow: int = NROW) -> list[str]:
    """Export a main table to ``out/MAIN`` by partition columns, and each linked subtable to ``out/NAME``; names of what was written.

    Cells without a common rank are left out, as in a scan.
    """
    main = Table.from_filename(ms, spark=spark)
    missing = [c for c in partition if c not in main.columns()]
    if missing:
        main._column(missing[0])
    done = []
    for name, t, by in [("MAIN", main, partition), *((n, Table.from_filename(p, spark=spark), ()) for n, p in subtables(main))]:
        cols = [c for c in t.columns() if not D.is_flat(t.getcoldesc(c))]
        write_dataset(t.df.select(ROW, *cols), f"{out.rstrip('/')}/{name}", by, nrow, [ROW])
        done.append(name)
    return done


def subtables(main: Table) -> list[tuple[str, str]]:
    """Names and paths of linked subtables that exist."""
    found = []
    for name, link in sorted(main.tabledesc().get("_keywords_", {}).items()):
        if isinstance(link, str) and link.startswith("Table: ") and not name.startswith("ASDM"):
            path = link[len("Table: ") :]
            if Store(main.spark, path).exists():
                found.append((name, path))
    return found


def read_dataset(spark: SparkSession, path: str) -> DataFrame:
    """An exported dataset; filters on partition columns prune folders, others reach the files."""
    return spark.read.parquet(path)


def chunk_plan(df: DataFrame, partition: Sequence[str], nrow: int, row: str = ROW) -> DataFrame:
    """Chunks of ``nrow`` rows in row order in each partition: the partition columns, ``chunk``, ``n``, ``lo`` and ``hi`` row.

    Rows are numbered within ranges of 65,536 row ids and the ranges' counts added up, so a large partition is numbered by many tasks.
    """
    src = df.select(*partition, F.col(row).alias("r"), F.shiftright(F.col(row).cast("long"), 16).alias("cell"))
    before = Window.partitionBy(*partition).orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = src.groupBy(*partition, "cell").agg(F.count("*").alias("c"))
    cells = cells.select(*[F.col(p).alias(f"p_{p}") for p in partition], F.col("cell").alias("p_cell"), F.coalesce(F.sum("c").over(before), F.lit(0)).alias("skip"))
    same = F.lit(True)
    for c in (*partition, "cell"):
        same &= src[c].eqNullSafe(cells[f"p_{c}"])
    place = F.row_number().over(Window.partitionBy(*partition, "cell").orderBy("r")) + F.col("skip") - 1
    numbered = src.join(cells, same).select(*partition, "r", F.floor(place / nrow).cast("long").alias("chunk"))
    return numbered.groupBy(*partition, "chunk").agg(F.count("*").alias("n"), F.min("r").alias("lo"), F.max("r").alias("hi"))
