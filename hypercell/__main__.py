"""``python -m hypercell export MS -p FIELD_ID,DATA_DESC_ID -n 1000 -o out``"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from hypercell.operators.export import NROW, PARTITIONS, export


def main(args: list[str] | None = None) -> list[str]:
    parser = argparse.ArgumentParser("hypercell")
    sub = parser.add_subparsers(dest="command", required=True)
    e = sub.add_parser("export", help="write a main table and its subtables as hive-partitioned Parquet")
    e.add_argument("ms")
    e.add_argument("-p", "--partition", default=",".join(PARTITIONS), help="partition columns, comma-separated")
    e.add_argument("-f", "--format", default="parquet", choices=["parquet", "arrow"], help="both give Parquet files, which Arrow reads")
    e.add_argument("-nr", "--nrow", type=int, default=NROW, help="most rows of a file")
    e.add_argument("-o", "--output", required=True)
    a = parser.parse_args(args)
    spark = SparkSession.builder.getOrCreate()
    return export(spark, a.ms, a.output, [c for c in a.partition.split(",") if c], a.nrow)


if __name__ == "__main__":
    print("\n".join(main()))
