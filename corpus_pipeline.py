"""A training-data pipeline over ``documents``: each stage works on all that the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hypercell.llm import bpe, decontaminate, linededup, neardup, quality
from hypercell.llm.common import discard, durable, scratch
from hypercell.llm.queries import QUALITY_FOLDS, QUALITY_HELD_OUT, vocabulary


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the pairwise ranking, learned from the labels in ``sf_dir``, does not reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.train(docs, labels, folds=QUALITY_FOLDS, held_out=QUALITY_HELD_OUT)
    return quality.keep(docs, model)


def _left(docs: DataFrame, out: DataFrame) -> DataFrame:
    """Documents whose lines were cut; one that has nothing left goes, as the line's first document keeps it."""
    out = out.where((F.col("lines_dropped") == 0) | (F.trim("text") != ""))
    return out.select(*[F.when(F.col("lines_dropped") > 0, F.length("text")).otherwise(F.col(c)).cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else F.col(c) for c in docs.columns])


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that recur across documents, or vary such a line."""
    return _left(docs, linededup.dedup(docs, variants=True))


def _once(docs: DataFrame) -> DataFrame:
    """One of the rows that have an id and a text in common."""
    again = durable(docs.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id"))
    if again.isEmpty():
        return docs
    one = docs.join(again, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"]).select(docs.columns)
    return docs.join(again, "doc_id", "left_anti").select(docs.columns).unionByName(one)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, repeated rows among them, without long lines that another group's document holds too."""
    gone = durable(neardup.link(docs).where(~F.col("kept")).select("doc_id").distinct())
    kept = docs.join(gone, "doc_id", "left_anti").select(docs.columns)
    return _left(docs, linededup.dedup_long(_once(kept)))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids`` (little-endian unsigned 32-bit integers) and digests of them and of the decoded bytes."""
    coded = bpe.encode(docs, vocabulary(), decoded=True)
    return coded.select("doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"), "ids", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", line_dedup),
    ("near dedup", near_dedup),
    ("decontamination", decontamination),
    ("byte bpe", byte_bpe),
]

#: The stages' models and merges have no SQL form; tests compare with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet in a shared folder and read again; what nothing reads any more goes."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for name, stage in STAGES[:-1]:
        path = scratch(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.mode("overwrite").parquet(path)
        docs = spark.read.parquet(path)
        if before:
            discard(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
