"""Benchmark decontamination with an Aho-Corasick automaton over normalised benchmark texts.

Lower-cased words of the benchmark's texts form windows; the automaton's letters are the ids of those words, so that one
scan of a document's words finds every occurring window, whose words map back to places in the original text.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import repeat

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hypercell.llm.common import chunks, lean, ship

#: Words of a window.
WINDOW = 13
#: A document is contaminated if at least one of so many words is hit.
SHARE = 20
#: Bytes of benchmark text in one automaton; a larger benchmark takes several automata and as many scans.
SHARD_BYTES = 1 << 20

_KEEP = bytes(range(0x30, 0x3A)) + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100))
_UPPER = bytes(range(0x41, 0x5B))
NORMAL = bytes(c if c in _KEEP else c + 32 if c in _UPPER else 0x20 for c in range(256))


def words(text: str) -> list[bytes]:
    """Words of a text: runs of digits, letters a-z (A-Z in lower case) and all characters beyond ASCII."""
    return text.encode().translate(NORMAL).split()


class Matcher:
    """The automaton of some benchmark texts. ``items``: pairs of an item id and a text."""

    def __init__(self, items: Sequence[tuple[int, str]], window: int = WINDOW):
        ids: dict[bytes, int] = {}
        where: dict[tuple[int, ...], set[int]] = {}
        for item, text in items:
            seq = tuple(ids.setdefault(w, len(ids) + 1) for w in words(text))
            for i in range(max(1, len(seq) - window + 1) if seq else 0):
                where.setdefault(seq[i : i + window], set()).add(item)
        self.ids = ids
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for seq, found in where.items():
            self.automaton.add_word(seq, (len(seq), tuple(found)))
        if where:
            self.automaton.make_automaton()

    def scan(self, found: list[bytes]) -> tuple[list[tuple[int, int]], set[int]]:
        """Runs of hit words (first, last + 1), in order and apart, and the items whose windows occur."""
        if not self.ids or not found:
            return [], set()
        seq = tuple(map(self.ids.get, found, repeat(0)))
        runs: list[tuple[int, int]] = []
        items: set[int] = set()
        for end, (n, who) in self.automaton.iter(seq):
            items.update(who)
            a, b = end - n + 1, end + 1
            while runs and runs[-1][1] >= a:
                last = runs.pop()
                a, b = min(a, last[0]), max(b, last[1])
            runs.append((a, b))
        return runs, items


def join_runs(a: list[tuple[int, int]], b: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for x, y in sorted([*a, *b]):
        if out and out[-1][1] >= x:
            out[-1] = (out[-1][0], max(y, out[-1][1]))
        else:
            out.append((x, y))
    return out


def spans(text: str, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Code point offsets in the original text of runs of words."""
    data = text.encode()
    is_word = np.frombuffer(data.translate(NORMAL), np.uint8) != 0x20
    edge = np.flatnonzero(np.diff(np.concatenate(([False], is_word, [False])).astype(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    points = np.concatenate(([0], np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)))
    return [(int(points[starts[a]]), int(points[ends[b - 1]])) for a, b in runs]


def shards(bench: DataFrame, id_col: str, text_cols: Sequence[str], size: int = SHARD_BYTES) -> Iterator[list[tuple[int, str]]]:
    """The benchmark in parts of about ``size`` bytes, which the driver holds one at a time."""
    part: list[tuple[int, str]] = []
    held = 0
    src = bench.select(F.col(id_col).cast("long").alias("id"), *(F.col(c).cast("string").alias(f"t{i}") for i, c in enumerate(text_cols)))
    for row in src.where(F.col("id").isNotNull()).toLocalIterator():
        for text in row[1:]:
            if text:
                part.append((row[0], text))
                held += len(text.encode())
        if held >= size:
            yield part
            part, held = [], 0
    if part:
        yield part


def scan(df: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", bench_cols: Sequence[str] = ("text",), window: int = WINDOW, carry: bool = False) -> DataFrame:
    """One row per input row: ``id_col``, ``n_words``, ``n_hit`` (words inside an occurring window), ``spans`` (code point
    offsets of the hit runs in the original text), ``items`` (sorted ids of the items whose windows occur) and ``contaminated``.

    A window is ``window`` consecutive words of one benchmark text, or all words of a shorter text. Null and empty texts have
    no words and no hits; benchmark rows without id, text or words are left out; repeated rows on either side change nothing
    but the number of rows; an empty benchmark hits nothing. Other columns are left out and cannot clash; with ``carry`` the
    whole input row comes along as the struct ``row``.
    """
    spark = df.sparkSession
    ship(spark)
    state = "array<struct<first:long,last:long>>"
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    row = [F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")] if carry else []
    out = df.select(F.col(id_col).cast("long").alias("id"), text.alias("text"), F.lit(None).cast(state).alias("runs"), F.lit(None).cast("array<long>").alias("items"), *row)
    carried = out.schema.fields[4:]
    kinds = lambda ddl: T.StructType([*T.StructType.fromDDL(ddl).fields, *carried])
    parts = shards(bench, item_col, bench_cols)
    now = next(parts, [])
    while now is not None:
        after = next(parts, None)
        shared = spark.sparkContext.broadcast(now)
        last = after is None
        out = out.mapInArrow(lean(_scanner(shared, window, last)), kinds("id long, n_words long, n_hit long, spans array<struct<start:long,end:long>>, items array<long>, contaminated boolean" if last else f"id long, text string, runs {state}, items array<long>"))
        now = after
    return out.withColumnRenamed("id", id_col)


def clean(df: DataFrame, bench: DataFrame, text_col: str = "text", **how) -> DataFrame:
    """The input's rows and columns without contaminated rows; needs no id. Nulls and ties as in ``scan``."""
    found = scan(df.withColumn(_NO_ID, F.lit(None).cast("long")), bench, id_col=_NO_ID, text_col=text_col, carry=True, **how)
    return found.where(~F.col("contaminated")).select(*[F.col("row").getField(c).alias(c) for c in df.columns])


_NO_ID = "hypercell no id"


_live: list = []


def matcher(items: Sequence[tuple[int, str]], window: int) -> Matcher:
    """This process's automaton, which the tasks of one scan share."""
    for held, size, made in _live:
        if held is items and size == window:
            return made
    _live[:] = [(items, window, Matcher(items, window))]
    return _live[0][2]


def _scanner(shared, window: int, last: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = matcher(shared.value, window)
        for batch in batches:
            for part in chunks(batch, 1, 2 << 20):
                texts = part.column(1).to_pylist()
                rows = []
                for text, runs, items in zip(texts, part.column(2).to_pylist(), part.column(3).to_pylist(), strict=True):
                    found = words(text)
                    new, who = m.scan(found)
                    runs = join_runs([(r["first"], r["last"]) for r in runs], new) if runs else new
                    rows.append((len(found), runs, sorted(who.union(items or ()))))
                items = pa.array([r[2] for r in rows], pa.list_(pa.int64()))
                if not last:
                    kept = pa.array([[{"first": a, "last": b} for a, b in r[1]] for r in rows], pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())])))
                    yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), kept, items, *part.columns[4:]], ["id", "text", "runs", "items", *part.schema.names[4:]])
                    continue
                hit = [sum(b - a for a, b in r[1]) for r in rows]
                place = pa.array([[{"start": a, "end": b} for a, b in spans(t, r[1])] if r[1] else [] for t, r in zip(texts, rows, strict=True)], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))
                bad = [h > 0 and SHARE * h >= r[0] for h, r in zip(hit, rows, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([r[0] for r in rows], pa.int64()), pa.array(hit, pa.int64()), place, items, pa.array(bad, pa.bool_()), *part.columns[4:]], ["id", "n_words", "n_hit", "spans", "items", "contaminated", *part.schema.names[4:]])

    return run
