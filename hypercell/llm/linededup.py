"""Line dedup with a log-template tree of fixed depth.

A line's leaf is its number of tokens and its leading tokens, where tokens with digits count as variable. Within a leaf, the
tokens that recur at their place stay and the others become variable fields; lines whose template recurs across
documents are dropped, but for the document of the smallest id. Templates are made once for each distinct masked line, and a
line without a recurring template of its own joins the most similar one of its leaf.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hypercell.llm.common import chunks, durable, lean, ship, small, spread

#: Leading tokens that lead to a leaf.
DEPTH = 3
#: Fewest characters, white space apart, of a line that is parsed: shorter ones ("And.") recur by chance.
MIN_CHARS = 10
#: Documents in which a template recurs, and in which a token must recur at its place to stay in it.
MIN_DOCS = 8
#: Least share of a template's tokens that are not variable, in hundredths, and of these that a variant shares.
CONSTANT = 70
#: A line of more tokens is too long to recur by chance: its exact repeats count from two documents on.
LONG = 50
FIELD = "<*>"
#: Templates of a leaf that a line meets at once.
BLOCK = 256

_TOKEN = re.compile(r"[^ \t\r\f\v]+")
_DIGIT = re.compile(r"[0-9]")


def tokens(line: str) -> list[str]:
    """Tokens of a line; those with digits are variable fields. A line that is not parsed has none."""
    found = _TOKEN.findall(line)
    return [FIELD if _DIGIT.search(t) else t for t in found] if sum(map(len, found)) >= MIN_CHARS else []


def leaf(found: list[str]) -> int:
    """The leaf's key: a signed 64-bit hash of the number of tokens and the leading ones."""
    key = xxhash.xxh64_intdigest(f"{len(found)} {' '.join(found[:DEPTH])}".encode())
    return key - (1 << 64) if key >> 63 else key


def _leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The lines that are parsed, with their leaf and, of long ones, a digest of the line as it stands."""
    for batch in batches:
        for part in chunks(batch, 2, 2 << 20):
            ids, hashes, lines, keys, exact = [], [], [], [], []
            for i, h, text in zip(*(c.to_pylist() for c in part.columns), strict=True):
                for k, line in enumerate(text.split("\n")):
                    found = tokens(line)
                    if found:
                        ids.append(i)
                        hashes.append(h)
                        lines.append(k)
                        keys.append(leaf(found))
                        exact.append(hashlib.md5(line.encode()).digest() if len(found) > LONG else None)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(hashes, pa.int64()), pa.array(lines, pa.int32()), pa.array(keys, pa.int64()), pa.array(exact, pa.binary())], ["id", "h", "line", "leaf", "exact"])


_LINES = "id long, h long, line int, leaf long, exact binary"


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Wanted lines as masked tokens joined by spaces with their digest, and the places whose token is new in its text's lines of the
    leaf (null: all of them)."""
    for batch in batches:
        for part in chunks(batch, 2, 2 << 20):
            ids, hashes, lines, keys, found, digest, many, fresh = [], [], [], [], [], [], [], []
            for i, h, text, wanted, m in zip(*(c.to_pylist() for c in part.columns), strict=True):
                split = text.split("\n")
                seen: dict[int, set[tuple[int, str]]] = {}
                for k in wanted:
                    t = tokens(split[k])
                    key = leaf(t)
                    now = set(enumerate(t))
                    before = seen.get(key)
                    fresh.append(None if before is None else [p for p, _ in now - before])
                    seen[key] = now if before is None else before | now
                    masked = " ".join(t)
                    ids.append(i)
                    hashes.append(h)
                    lines.append(k)
                    keys.append(key)
                    found.append(masked)
                    digest.append(hashlib.md5(masked.encode()).digest())
                    many.append(m)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(hashes, pa.int64()), pa.array(lines, pa.int32()), pa.array(keys, pa.int64()), pa.array(found, pa.string()), pa.array(digest, pa.binary()), pa.array(many, pa.bool_()), pa.array(fresh, pa.list_(pa.int32()))], ["id", "h", "line", "leaf", "masked", "key", "many", "fresh"])


def _keyed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return df.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("h"), text.alias("text")).where("id is not null")


def _wanted(texts: DataFrame, lines: DataFrame) -> DataFrame:
    """The lines of leaves that many lines share: ``id``, ``h``, ``line``, ``leaf``, ``masked``, ``key``, whether the id has ``many``
    texts, and ``fresh``. Rows that repeat an id and a text count once."""
    # Lines of a leaf are at least as many as its documents; what this lets through is counted again below.
    often = durable(lines.groupBy("leaf").agg(F.count("*").alias("n")).where(F.col("n") >= MIN_DOCS).select("leaf"))
    wanted = spread(lines.select("id", "h", "line", "leaf"), often, ["leaf"], "id", "line").groupBy("id", "h").agg(F.collect_set("line").alias("lines"))
    wanted = wanted.withColumn("many", F.count("*").over(Window.partitionBy("id")) > 1)
    found = texts.join(wanted, ["id", "h"]).dropDuplicates(["id", "h"]).select("id", "h", "text", "lines", "many")
    return durable(found.mapInArrow(lean(_tokens), "id long, h long, line int, leaf long, masked string, key binary, many boolean, fresh array<int>"))


def _templates(found: DataFrame, distinct: DataFrame) -> DataFrame:
    """``key``, ``leaf``, ``template`` and its digest ``t`` of the distinct masked lines that are constant enough."""
    placed = found.select("leaf", "id", "many", "fresh", F.posexplode(F.split("masked", " ")).alias("place", "token")).where(F.col("fresh").isNull() | F.array_contains("fresh", F.col("place")))
    docs = F.count(F.when(~F.col("many"), 1)) + F.countDistinct(F.when(F.col("many"), F.col("id")))
    stays = durable(placed.groupBy("leaf", "place", "token").agg(docs.alias("n")).where(F.col("n") >= MIN_DOCS).select("leaf", "place", "token", F.lit(True).alias("stays")))
    exploded = distinct.select("key", "leaf", F.posexplode(F.split("masked", " ")).alias("place", "token"))
    flagged = spread(exploded, stays, ["leaf", "place", "token"], "key", how="left")
    fields = F.sort_array(F.collect_list(F.struct("place", F.when(F.col("stays"), F.col("token")).otherwise(FIELD).alias("f"))))
    made = flagged.groupBy("key", "leaf").agg(fields.alias("fields")).select("key", "leaf", F.col("fields.f").alias("fields"))
    made = made.where(100 * F.size(F.filter("fields", lambda t: t != FIELD)) >= CONSTANT * F.size("fields"))
    made = made.select("key", "leaf", F.array_join("fields", " ").alias("template"))
    return durable(made.withColumn("t", F.unhex(F.md5(F.col("template").cast("binary")))))


def _variants(distinct: DataFrame, own: DataFrame) -> DataFrame:
    """``key``, ``template`` and ``first`` of masked lines without a recurring template of their own, with the most similar recurring
    one of their leaf: at least ``CONSTANT`` of its tokens that are not fields are the line's. A line meets the templates of its
    leaf in blocks, one row each."""
    known = own.groupBy("t", "leaf", "template", "first").agg(F.count("*").alias("lines"))
    known = known.withColumn("block", F.floor((F.row_number().over(Window.partitionBy("leaf").orderBy("t")) - 1) / BLOCK))
    fields = F.split("template", " ")
    entry = F.struct("template", "first", fields.alias("fields"), F.size(F.filter(fields, lambda x: x != FIELD)).alias("size"))
    blocks = durable(known.groupBy("leaf", "block").agg(F.collect_list(entry).alias("known")))
    left = distinct.join(own.select("key"), "key", "left_anti")
    met = spread(left, blocks, ["leaf"], "key").withColumn("tokens", F.split("masked", " "))

    def scored(t):
        same = F.size(F.filter(F.zip_with("tokens", t["fields"], lambda a, b: (b != FIELD) & (a == b)), lambda x: x))
        return F.struct((-same / t["size"]).alias("rank"), t["template"].alias("template"), t["first"].alias("first"), (100 * same >= CONSTANT * t["size"]).alias("fits"))

    best = met.select("key", F.array_min(F.filter(F.transform("known", scored), lambda x: x["fits"])).alias("best")).where("best is not null")
    return best.groupBy("key").agg(F.min("best").alias("best")).select("key", "best.template", "best.first")


def recurring(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", variants: bool = False, long: bool = False) -> DataFrame:
    """The lines to drop: ``id``, ``h`` (hash of the text they stand in) and ``line`` (from 0), distinct.

    Documents are counted by id, so repeated rows count once; a template's lines stay in the document of the smallest id.
    With ``variants``, lines that differ from a recurring template of their leaf in a few tokens go as well; with ``long``, exact
    repeats of long lines go from two documents on.
    """
    ship(df.sparkSession)
    texts = _keyed(df, id_col, text_col)
    lines = durable(texts.mapInArrow(lean(_leaves), _LINES))
    found = _wanted(texts, lines)
    distinct = durable(found.select("key", "leaf", "masked").distinct())
    made = _templates(found, distinct)
    # A template has one leaf: the leading tokens of a leaf stay in its templates.
    docs = spread(found.select("id", "line", "key"), made.select("key", "t"), ["key"], "id").select("t", "id").distinct()
    counted = durable(docs.groupBy("t").agg(F.count("*").alias("docs"), F.min("id").alias("first")).where(F.col("docs") >= MIN_DOCS))
    own = durable(made.join(counted, "t").select("key", "leaf", "t", "template", "first"))
    gone = own.select("key", "first")
    if variants:
        gone = gone.unionByName(_variants(distinct, own).select("key", "first"))
    out = spread(found.select("id", "h", "line", "key"), durable(gone), ["key"], "id", "line").where("id <> first").select("id", "h", "line")
    if long:
        out = out.unionByName(_repeats(lines)).distinct()
    return out


def _repeats(lines: DataFrame) -> DataFrame:
    keyed = lines.where("exact is not null")
    twice = durable(keyed.groupBy("exact").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first <> last").drop("last"))
    return spread(keyed, twice, ["exact"], "id", "line").where("id <> first").select("id", "h", "line").distinct()


def repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Exact repeats of lines of more than ``LONG`` tokens in two or more documents: ``id``, ``h`` and ``line``, but for the
    document of the smallest id."""
    ship(df.sparkSession)
    return _repeats(durable(_keyed(df, id_col, text_col).mapInArrow(lean(_leaves), _LINES).where("exact is not null")))


def dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", variants: bool = False, long: bool = False) -> DataFrame:
    """The input's rows and columns, with recurring lines cut from the text, and ``lines_dropped``, which replaces a column of
    that name.

    A null text stays null; rows without an id, and lines of fewer than ``MIN_CHARS`` characters, stay as they are; repeated rows
    are treated alike and change nothing in the others; an empty table gives an empty one. A text whose lines all recur becomes
    empty. With ``variants``, edited variants of recurring lines go too; with ``long``, long lines from two documents on.
    """
    return _cut(df, recurring(df, id_col, text_col, variants, long), id_col, text_col)


def dedup_long(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """As ``dedup``, for exact repeats of long lines. It belongs after near dedup: copies of a document that lack their common
    lines are not alike any more."""
    return _cut(df, repeats(df, id_col, text_col), id_col, text_col)


def _cut(df: DataFrame, gone: DataFrame, id_col: str, text_col: str) -> DataFrame:
    gone = durable(gone.groupBy("id", "h").agg(F.collect_set("line").alias("lines")))
    if small(gone):
        gone = F.broadcast(gone)
    columns = [c for c in df.columns if c != "lines_dropped"]
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    src = df.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("h"), F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"))
    out = src.join(gone, ["id", "h"], "left")
    old = F.col("row").getField(text_col)
    kept = F.array_join(F.filter(F.split(old, "\n"), lambda x, i: ~F.array_contains("lines", i)), "\n")
    new = [F.when(F.col("lines").isNull(), old).otherwise(kept).alias(c) if c == text_col else F.col("row").getField(c).alias(c) for c in columns]
    return out.select(*new, F.coalesce(F.size("lines"), F.lit(0)).cast("long").alias("lines_dropped"))
