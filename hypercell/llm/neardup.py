"""Near-duplicates by MinHash with an inverted join on signature coordinates.

Documents with equal shingle sets form a class that one of them stands for. Representatives are posted under each pair of a
signature coordinate and its value. Two passes find links: first each posting list links its members with its first and
last one, which gathers groups of near copies in proportion to their size; then members of different groups meet under
the rarest coordinates of their signatures only (prefix), and the coordinates that this skips are counted for the pairs that met.
The members of crowded lists meet under their rarest shingles instead, so that stragglers of a large group do not meet all
of it. Links are confirmed on full shingle sets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hypercell.llm.common import chunks, durable, id_text, lean, ship
from hypercell.llm.graph import components
from hypercell.llm.words import hash_words, mix, padded

#: Words of a shingle, and the least similarity of a link in hundredths.
SHINGLE, SIMILAR = 5, 75
#: Coordinates of a signature, and how many must agree. A pair of similarity 0.75 fails that with probability 3e-5.
COORDINATES, MATCHES = 32, 14
#: Coordinates, rarest first, of which two documents that agree in MATCHES must share one.
PREFIX = COORDINATES - MATCHES + 1
#: Agreeing coordinates that make a candidate in the first pass, which only serves to gather groups.
FIRST_PASS = 8
#: Ids of candidates that are broadcast to fetch their texts; more are joined by a shuffle.
BROADCAST_IDS = 1_000_000

#: Members of a posting list beyond which its documents meet under their rarest shingles instead.
CROWD = 32

#: Counters of the table that orders shingles.
COUNTERS = 1 << 20

_U = np.uint64
_RNG = np.random.default_rng(977)
_FACTORS = _RNG.integers(1, 1 << 63, COORDINATES, dtype=np.uint64) * _U(2) + _U(1)
_PLACE = _RNG.integers(1, 1 << 63, SHINGLE, dtype=np.uint64) * _U(2) + _U(1)
_SALT = _RNG.integers(1, 1 << 63, COORDINATES, dtype=np.uint64)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_SEP = np.zeros(256, bool)
_SEP[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def shingles(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of each text's distinct shingles, ascending, and where each text's end."""
    coded = [t.encode() for t in texts]
    buf = np.frombuffer(b" ".join(coded) + b" ", np.uint8)
    at = np.concatenate(([0], np.cumsum([len(c) + 1 for c in coded])))
    is_word = ~_SEP[buf]
    edge = np.flatnonzero(np.diff(np.concatenate(([False], is_word)).astype(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    word = hash_words(padded(_LOWER[buf]), starts, ends - starts)
    doc = np.searchsorted(at, starts, side="right") - 1
    counts = np.bincount(doc, minlength=len(texts)) if len(doc) else np.zeros(len(texts), np.int64)
    last = np.cumsum(counts)
    per = np.where(counts >= SHINGLE, counts - SHINGLE + 1, (counts > 0).astype(np.int64))
    out_ends = np.cumsum(per)
    out = np.empty(int(per.sum()), np.uint64)
    with np.errstate(over="ignore"):
        n = len(word) - SHINGLE + 1
        if n > 0:
            full = word[:n] * _PLACE[0]
            for j in range(1, SHINGLE):
                full += word[j : j + n] * _PLACE[j]
            inside = doc[:n] == doc[SHINGLE - 1 :]
            keep = np.ones(len(out), bool)
            keep[out_ends[(counts > 0) & (counts < SHINGLE)] - 1] = False
            out[keep] = full[inside]
        for d in np.flatnonzero((counts > 0) & (counts < SHINGLE)).tolist():
            k = int(counts[d])
            out[out_ends[d] - 1] = (word[last[d] - k : last[d]] * _PLACE[:k]).sum(dtype=np.uint64) + _U(k)
        out = mix(out)
    begin = 0
    for end in out_ends.tolist():
        out[begin:end].sort()
        begin = end
    fresh = np.ones(len(out), bool)
    if len(out):
        fresh[1:] = out[1:] != out[:-1]
        fresh[(out_ends - per)[per > 0]] = True
    kept = np.concatenate(([0], np.cumsum(fresh)))
    return out[fresh], kept[out_ends]


def signatures(hashes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For each set the keys of its coordinate-value pairs; rows of empty sets mean nothing."""
    starts = np.concatenate(([0], ends[:-1]))
    full = np.flatnonzero(ends > starts)
    out = np.zeros((len(ends), COORDINATES), np.uint64)
    if len(full):
        with np.errstate(over="ignore"):
            for k in range(COORDINATES):
                out[full, k] = mix(np.minimum.reduceat(hashes * _FACTORS[k], starts[full]) + _SALT[k])
    return out


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in chunks(batch, 1, 2 << 20):
            hashes, ends = shingles(part.column(1).to_pylist())
            starts = np.concatenate(([0], ends[:-1]))
            sigs = signatures(hashes, ends).view(np.int64)
            digest = [hashlib.blake2b(hashes[a:b], digest_size=16).digest() if b > a else None for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
            values = pa.array(sigs.ravel(), pa.int64())
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(ends) + 1, dtype=np.int32) * COORDINATES), values)
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(ends - starts, pa.int64()), pa.array(digest, pa.binary()), lists], ["id", "h", "n", "digest", "sig"])


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in chunks(batch, (2, 3), 1 << 20):
            a, b = part.column(2).to_pylist(), part.column(3).to_pylist()
            x, x_ends = shingles(a)
            y, y_ends = shingles(b)
            ok = []
            i = j = 0
            for p, q in zip(x_ends.tolist(), y_ends.tolist(), strict=True):
                common = len(np.intersect1d(x[i:p], y[j:q], assume_unique=True))
                ok.append(common > 0 and 100 * common >= SIMILAR * (p - i + q - j - common))
                i, j = p, q
            keep = pa.array(ok, pa.bool_())
            yield pa.RecordBatch.from_arrays([part.column(0).filter(keep), part.column(1).filter(keep)], ["a", "b"])


def confirm(pairs: DataFrame, texts: DataFrame, reps: DataFrame) -> DataFrame:
    """The pairs ``a``, ``b`` whose full sets are similar enough. ``texts``: ``id``, ``h`` and
    ``text``; ``reps`` tells with which ``h`` a ``rep`` speaks."""
    pairs = durable(pairs)
    texts = durable(_texts_of(pairs.select(F.explode(F.array("a", "b")).alias("rep")).distinct(), texts, reps))
    left = texts.select(F.col("id").alias("a"), F.col("text").alias("ta"))
    right = texts.select(F.col("id").alias("b"), F.col("text").alias("tb"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "ta", "tb")
    return both.mapInArrow(lean(_confirm), "a long, b long")


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What a task adds to the counters."""
    table = np.zeros(COUNTERS, np.int64)
    for batch in batches:
        for part in chunks(batch, 1, 1 << 20):
            hashes, _ = shingles(part.column(1).to_pylist())
            table += np.bincount((hashes & _U(COUNTERS - 1)).astype(np.int64), minlength=COUNTERS)
    at = np.flatnonzero(table)
    if len(at):
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(table[at], pa.int64())], ["counter", "n"])


def _prefixes(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            for part in chunks(batch, 1, 1 << 20):
                hashes, ends = shingles(part.column(1).to_pylist())
                out: list[list[np.ndarray]] = [[], [], [], []]
                begin = 0
                for rep, end in zip(part.column(0).to_pylist(), ends.tolist(), strict=True):
                    h = hashes[begin:end]
                    c = table[(h & _U(COUNTERS - 1)).astype(np.int64)]
                    order = np.lexsort((h, c))[: (100 - SIMILAR) * len(h) // 100 + 1]
                    met = c[order] > 1
                    h = h[order].view(np.int64)
                    for o, x in zip(out, (np.full(int(met.sum()), rep), h[met], np.flatnonzero(met) + 1, np.roll(h, 1)[met]), strict=True):
                        o.append(x)
                    begin = end
                if out[0]:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(o), pa.int64()) for o in out], ["rep", "shingle", "place", "before"])

    return run


def _texts_of(ids: DataFrame, texts: DataFrame, reps: DataFrame) -> DataFrame:
    """``id`` and ``text`` of representatives (``ids``: distinct ``rep``), one row each."""
    ids = durable(ids.join(reps, "rep").select(F.col("rep").alias("id"), "h"))
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    return texts.join(ids, ["id", "h"], "left_semi").dropDuplicates(["id"]).select("id", "text")


def crowd_pairs(crowd: DataFrame, texts: DataFrame, reps: DataFrame) -> DataFrame:
    """``a`` and ``b`` of ``crowd`` (``rep``, ``n`` and ``group``, distinct) in different groups that may be similar enough.

    An exact prefix filter: in one order of all shingles two similar sets share one of their first, and how many come into
    question follows from both sizes. The order is by counts in a table of fixed size, rarest first; counters that several shingles
    share make it less sharp, not wrong. Shingles with a count of one meet nobody.
    """
    spark = crowd.sparkSession
    texts = durable(_texts_of(crowd.select("rep"), texts, reps))
    counts = texts.mapInArrow(lean(_count), "counter long, n long").groupBy("counter").agg(F.sum("n").alias("n")).toArrow()
    table = np.zeros(COUNTERS, np.int32)
    table[counts.column("counter").to_numpy()] = np.minimum(counts.column("n").to_numpy(), np.iinfo(np.int32).max)
    placed = texts.mapInArrow(lean(_prefixes(spark.sparkContext.broadcast(table))), "rep long, shingle long, place long, before long")
    placed = durable(placed.join(crowd, "rep"))
    x, y = (placed.select("shingle", *[F.col(c).alias(f"{c}_{k}") for c in ("rep", "n", "group", "place", "before")]) for k in "ab")
    overlap = F.ceil(SIMILAR * (F.col("n_a") + F.col("n_b")) / (100 + SIMILAR))
    near = (F.col("rep_a") < F.col("rep_b")) & (F.col("group_a") != F.col("group_b")) & (F.col("place_a") <= F.col("n_a") - overlap + 1) & (F.col("place_b") <= F.col("n_b") - overlap + 1)
    # A pair that met under the shingle before this one, in both orders, does not meet again.
    near &= (F.col("before_a") != F.col("before_b")) | (F.least("place_a", "place_b") == 1)
    return x.join(y, "shingle").where(near).select(F.col("rep_a").alias("a"), F.col("rep_b").alias("b")).distinct()


def link(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``id_col``, ``n_shingles``, ``component_id`` (the smallest id reachable over links, its own
    included) and ``kept`` (it is its own component's smallest).

    Null and empty texts, and texts of white space, have no shingles and no links. Equal texts are linked. Of rows that repeat an
    id with different texts, the one with the smallest text hash speaks for the id: all get its component, and each its own
    ``n_shingles``. A row without an id takes no part: its component is null and it is kept. Other columns are left out.
    """
    ship(df.sparkSession)
    texts = id_text(df, id_col, text_col).withColumn("h", F.xxhash64("text"))
    docs = durable(texts.mapInArrow(lean(_sketch), "id long, h long, n long, digest binary, sig array<long>"))
    one = docs.where("id is not null").groupBy("id").agg(F.min("h").alias("h"))
    full = docs.join(one, ["id", "h"]).where("digest is not null")
    classes = durable(full.groupBy("digest").agg(F.min("id").alias("rep")))
    member = durable(full.join(classes, "digest").select("id", "h", "rep", "n", F.when(F.col("id") == F.col("rep"), F.col("sig")).alias("sig")))
    reps = durable(member.where("sig is not null").groupBy("rep").agg(F.first("h").alias("h"), F.max("n").alias("n"), F.first("sig").alias("sig")))
    texts = texts.where("id is not null")

    posted = reps.select("rep", "n", F.explode("sig").alias("key"))
    lists = posted.groupBy("key").agg(F.count("*").alias("f"), F.min("rep").alias("low"), F.max("rep").alias("high")).where("f > 1")
    met = durable(posted.join(lists, "key"))

    hubs = met.select("rep", F.explode(F.array("low", "high")).alias("hub")).where("rep <> hub")
    first = hubs.select(F.least("rep", "hub").alias("a"), F.greatest("rep", "hub").alias("b")).groupBy("a", "b").agg(F.count("*").alias("c")).where(F.col("c") >= FIRST_PASS)
    found = durable(confirm(first.select("a", "b"), texts, reps))
    group = components(found)

    ranked = met.select("rep", "n", "key", "f").withColumns({
        "place": F.row_number().over(Window.partitionBy("rep").orderBy("f", "key")),
        "shared": F.count("*").over(Window.partitionBy("rep")),
    })
    # A coordinate that nobody shares comes before those that somebody does.
    prefix = ranked.where(F.col("shared") >= MATCHES).where(F.col("place") + COORDINATES - F.col("shared") <= PREFIX)
    prefix = prefix.join(group.withColumnRenamed("node", "rep"), "rep", "left").select("rep", "n", "key", F.coalesce("label", "rep").alias("group"))
    prefix = durable(prefix)
    mixed = durable(prefix.groupBy("key").agg(F.min("group").alias("g"), F.max("group").alias("h"), F.count("*").alias("members")).where("g <> h").select("key", "members"))
    prefix = durable(prefix.join(mixed, "key"))
    crowd = prefix.where(F.col("members") > CROWD).select("rep", "n", "group").distinct()
    # Members of a list meet with half of each key of their signatures at hand, so that only pairs that agree in enough leave the join.
    half = reps.select("rep", F.transform("sig", lambda k: k.bitwiseAND(F.lit(0x7FFFFFFF)).cast("int")).alias("sig"))
    lists = durable(prefix.where(F.col("members") <= CROWD).join(half, "rep"))
    x, y = (lists.select("key", *[F.col(c).alias(f"{c}_{k}") for c in ("rep", "n", "group", "sig")]) for k in "ab")
    near = (F.col("rep_a") < F.col("rep_b")) & (F.col("group_a") != F.col("group_b")) & (100 * F.least("n_a", "n_b") >= SIMILAR * F.greatest("n_a", "n_b"))
    met = x.join(y, (x["key"] == y["key"]) & near & (F.size(F.array_intersect("sig_a", "sig_b")) >= MATCHES)).select(F.col("rep_a").alias("a"), F.col("rep_b").alias("b"))
    crowd = crowd_pairs(durable(crowd), texts, reps)
    sig_a, sig_b = half.select(F.col("rep").alias("a"), F.col("sig").alias("sa")), half.select(F.col("rep").alias("b"), F.col("sig").alias("sb"))
    crowd = crowd.join(sig_a, "a").join(sig_b, "b").where(F.size(F.array_intersect("sa", "sb")) >= MATCHES).select("a", "b")
    more = confirm(met.unionByName(crowd).distinct(), texts, reps)
    label = components(found.unionByName(more)).withColumnRenamed("node", "rep")

    placed = member.select("id", "rep").distinct().join(label, "rep", "left").select("id", F.coalesce("label", "rep").alias("component"))
    out = docs.select("id", "n").join(placed, "id", "left").select("id", "n", F.coalesce("component", "id").alias("component"))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"), F.coalesce(F.col("id") == F.col("component"), F.lit(True)).alias("kept"))
