"""Token ids in binary files of coded segments, in the order of the documents' ids."""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hypercell.llm import idcoder, words
from hypercell.llm.common import chunks, id_text, lean, ragged, raw, ship

#: Bytes of text that a worker tokenizes at once, and ids from which on a segment is closed behind a document.
CHUNK_BYTES, SEGMENT_IDS = 1 << 20, 8 << 20
#: Two to this power are the slots for pieces whose ids a worker remembers; the memory starts anew when half of them are used.
MEMO_BITS = 21
#: A byte that no text in UTF-8 has, and how many pieces, with it behind each, the library's model gets at once.
APART, TOGETHER = 0xC0, 16
#: Largest tokenizer file that is broadcast.
MAX_TOKENIZER_BYTES = 64 << 20


class Tokens:
    """Ids of texts by the tokenizers library.

    A byte-level tokenizer without normaliser splits a text by ``words.PATTERN`` and encodes each piece on its own; each distinct
    piece is then encoded once, by the library. Texts in which a string of an added token occurs, and all texts of other tokenizers,
    go to the library as they are.
    """

    def __init__(self, definition: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        pre = repr(self.tokenizer.pre_tokenizer).replace(" ", "")
        self.by_piece = self.tokenizer.normalizer is None and pre.startswith("ByteLevel(add_prefix_space=False") and "use_regex=True" in pre
        self.added = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        # Bytes as the characters that a byte-level vocabulary writes them with: printable ones stand for themselves.
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = iter(range(256, 512))
        self.chars = [chr(b) if b in plain else chr(next(rest)) for b in range(256)]
        # The id of ``APART`` and a tokenizer that is the model only, if pieces with that byte between them have the ids they have alone:
        # merges go by their ranks, and none has that byte.
        model = json.loads(definition)["model"]
        plain = model.get("type") == "BPE" and not any(model.get(x) for x in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
        merged = plain and any(self.chars[APART] in "".join(m) for m in model["merges"])
        self.apart = model["vocab"].get(self.chars[APART]) if plain and not merged else None
        self.model = Tokenizer(self.tokenizer.model) if self.apart is not None else None
        self._forget()

    def _forget(self) -> None:
        self.known = words.Seen(MEMO_BITS)
        self.at, self.n = np.empty(1 << (MEMO_BITS - 1), np.int64), np.empty(1 << (MEMO_BITS - 1), np.int64)
        self.ids, self.used = np.empty(1 << 16, np.uint32), 0

    def _encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        return np.fromiter(chain.from_iterable(found), np.uint32), np.array([len(f) for f in found], np.int64)

    def _words(self, buf: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of each piece by the library's model, which is what follows the split."""
        ends = np.cumsum(lens)
        if self.apart is not None:
            bounds = ends + np.arange(1, len(ends) + 1)
            data = np.insert(buf[ragged(starts, lens)], ends, APART).tobytes().decode("latin-1").translate(self.chars)
            cuts = [0, *bounds[TOGETHER - 1 : -1 : TOGETHER].tolist(), len(data)]
            found = [e.ids for e in self.model.encode_batch_fast([data[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)], add_special_tokens=False)]
            ids = np.fromiter(chain.from_iterable(found), np.uint32)
            at = np.flatnonzero(ids == self.apart)
            if len(at) == len(lens):
                return np.delete(ids, at), np.diff(at, prepend=-1) - 1
        data = buf[ragged(starts, lens)].tobytes().decode("latin-1").translate(self.chars)
        tokenize = self.tokenizer.model.tokenize
        cuts = [0, *ends.tolist()]
        found = [[t.id for t in tokenize(data[a:b])] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        return np.fromiter(chain.from_iterable(found), np.uint32), np.array([len(f) for f in found], np.int64)

    def _learn(self, h: np.ndarray, buf: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> None:
        _, one = np.unique(h, return_index=True)
        one = one[: self.known.room]
        starts, lens = starts[one], lens[one]
        ids, n = self._words(buf, starts, lens)
        new = slice(self.known.n, self.known.n + len(one))
        self.known.add(h[one], buf, starts, lens)
        if self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids[: self.used], np.empty(self.used + len(ids), np.uint32)])
        self.ids[self.used : self.used + len(ids)] = ids
        self.at[new], self.n[new] = self.used + np.cumsum(n) - n, n
        self.used += len(ids)

    def _pieces(self, buf: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces in order, and how many each has."""
        h = words.hash_words(buf, starts, lens)
        entry = self.known.find(h, buf, starts, lens)
        new = np.flatnonzero(entry < 0)
        if len(new):
            if len(new) > self.known.room:
                self._forget()
                new = np.arange(len(h))
            self._learn(h[new], buf, starts[new], lens[new])
            entry[new] = self.known.find(h[new], buf, starts[new], lens[new])
            if (entry < 0).any():  # two pieces share a hash
                return self._words(buf, starts, lens)
        n = self.n[entry]
        return self.ids[ragged(self.at[entry], n)], n

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in order, and how many each text has."""
        off, data = raw(texts)
        if not self.by_piece or any(data.tobytes().find(t) >= 0 for t in self.added):
            ids, n = zip(*(self._encode([t]) for t in texts.to_pylist()), strict=True) if len(texts) else ((), ())
            return np.concatenate([np.empty(0, np.uint32), *ids]), np.array([k.sum() for k in n], np.int64)
        if len(data) <= words.LONG:
            return self._texts(off, data)
        got, n = [np.empty(0, np.uint32)], []
        for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True):
            parts = [self._texts(np.array([0, len(p)]), np.frombuffer(p, np.uint8))[0] for p in words.bounded(data[a:b].tobytes())]
            got += parts
            n.append(sum(map(len, parts)))
        return np.concatenate(got), np.array(n, np.int64)

    def _texts(self, off: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        starts = words.cut(data, off[1:])
        lens = np.diff(starts, append=len(data))
        if not len(starts):
            return np.empty(0, np.uint32), np.zeros(len(off) - 1, np.int64)
        ids, n = self._pieces(words.padded(data), starts, lens)
        ends = np.concatenate(([0], np.cumsum(n)))[np.searchsorted(starts, off)]
        return ids, np.diff(ends)


_live: dict[str, Tokens] = {}


def tokens(definition: str) -> Tokens:
    """This process's encoder, which keeps what it has seen from task to task."""
    if definition not in _live:
        _live.clear()
        _live[definition] = Tokens(definition)
    return _live[definition]


def write(df: DataFrame, path: str, definition: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Tokenize and write to the folder ``path``, through Spark's writer, so that a lost or repeated task leaves nothing behind.

    The rows of the files are segments (``file``, ``seq``, ``n_ids`` and ``segment``, see ``idcoder``) of whole documents, in the
    order of ``file`` and ``seq`` by ascending document id (nulls first, then by text). Each document is followed by ``end_id``.
    A null or empty text has that id only; repeated rows are repeated documents; an empty table gives no segment.
    """
    spark = df.sparkSession
    ship(spark)
    if len(definition.encode()) > MAX_TOKENIZER_BYTES:
        raise ValueError("the tokenizer's file is too large")
    shared = spark.sparkContext.broadcast(definition)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = None
        part = TaskContext.get().partitionId()
        docs: list[np.ndarray] = []
        counts: list[np.ndarray] = []
        ids: list[np.ndarray] = []
        seq = 0

        def close() -> pa.RecordBatch:
            nonlocal seq
            all_ids = np.concatenate(ids)
            segment = idcoder.pack(np.concatenate(docs), np.concatenate(counts), all_ids)
            out = pa.RecordBatch.from_pydict({"file": pa.array([part], pa.int32()), "seq": pa.array([seq], pa.int32()), "n_ids": pa.array([len(all_ids)], pa.int64()), "segment": pa.array([segment], pa.binary())})
            seq += 1
            docs.clear(), counts.clear(), ids.clear()
            return out

        for batch in batches:
            for piece in chunks(batch, 1, CHUNK_BYTES):
                coder = coder or tokens(shared.value)
                found, n = coder.encode(piece.column(1))
                ends = np.cumsum(n + 1)
                whole = np.full(int(ends[-1]), end_id, np.uint32)
                mine = np.ones(len(whole), bool)
                mine[ends - 1] = False
                whole[mine] = found
                # A missing id is written as the smallest number.
                docs.append(np.asarray(pc.fill_null(piece.column(0), -(1 << 63))))
                counts.append(n + 1)
                ids.append(whole)
                if sum(map(len, ids)) >= SEGMENT_IDS:
                    yield close()
        if ids:
            yield close()

    src = id_text(df, id_col, text_col).repartitionByRange(F.col("id").asc_nulls_first()).sortWithinPartitions(F.col("id").asc_nulls_first(), "text")
    src.mapInArrow(lean(run), "file int, seq int, n_ids long, segment binary").write.mode("overwrite").parquet(path)


def read(spark: SparkSession, path: str, keep_ids: bool = True) -> DataFrame:
    """The documents in files that ``write`` wrote: ``id``, ``start`` (ids of all documents before it), ``n_ids`` (with the end id),
    ``crc32`` (of its ids as little-endian unsigned 32-bit integers) and, if ``keep_ids``, ``ids`` (those bytes).

    Every block's checksum is verified. Each segment is decoded alone, so a lost task repeats little.
    """
    ship(spark)
    segments = spark.read.parquet(path)
    per_file = sorted((r["file"], r["n"]) for r in segments.groupBy("file").agg(F.sum("n_ids").alias("n")).collect())  # a row per file
    bases, total = [], 0
    for f, n in per_file:
        bases.append((f, total))
        total += n
    base = spark.createDataFrame(bases, "file int, base long")
    before = Window.partitionBy("file").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    starts = segments.select("file", "seq", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("within")).join(base, "file").select("file", "seq", (F.col("base") + F.col("within")).alias("start"))
    src = segments.join(starts, ["file", "seq"]).select("start", "segment")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, segment in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                docs, counts, ids = idcoder.unpack(segment.as_py())
                ends = np.cumsum(counts)
                data = memoryview(ids.astype("<u4").tobytes())
                sums = [zlib.crc32(data[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), counts.tolist(), strict=True)]
                out = [pa.array(docs, pa.int64(), mask=docs == -(1 << 63)), pa.array(start + ends - counts, pa.int64()), pa.array(counts, pa.int64()), pa.array(sums, pa.int64())]
                if keep_ids:
                    out.append(pa.array([data[4 * (e - n) : 4 * e].tobytes() for e, n in zip(ends.tolist(), counts.tolist(), strict=True)], pa.binary()))
                yield pa.RecordBatch.from_arrays(out, ["id", "start", "n_ids", "crc32", "ids"][: len(out)])

    return src.mapInArrow(lean(run), "id long, start long, n_ids long, crc32 long" + ", ids binary" * keep_ids)
