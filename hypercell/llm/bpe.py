"""Byte-level BPE encoding and decoding.

Two tiers resolve a pre-token: a minimal perfect hash over the vocabulary answers pre-tokens that are tokens themselves;
the others are merged with a heap of candidate pairs over bytes that are linked in both directions.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hypercell.llm import words
from hypercell.llm.common import binary_array, chunks, id_text, lean, ragged, raw, ship

_U = np.uint64

#: Largest rank file that is broadcast; larger vocabularies are refused.
MAX_VOCAB_BYTES = 64 << 20
#: Bytes of text that a worker tokenizes at once.
CHUNK_BYTES = 1 << 20
#: Two to this power are the slots for merged pre-tokens that a worker remembers; the memory starts anew when half of them are used.
MEMO_BITS = 20


class PerfectHash:
    """Minimal perfect hash of distinct byte strings by hash and displace; a lookup verifies the bytes."""

    def __init__(self, keys: list[bytes]):
        n = len(keys)
        self.n = n
        lens = np.array([len(k) for k in keys], np.int64)
        self.buf = words.padded(b"".join(keys))
        places = np.cumsum(lens) - lens
        h = words.hash_words(self.buf, places, lens)
        self.n_buckets = max(1, n // 3)
        bucket = (h >> _U(33)) % _U(self.n_buckets)
        order = np.argsort(bucket, kind="stable")
        sizes = np.bincount(bucket.astype(np.int64), minlength=self.n_buckets)
        starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        disp = np.zeros(self.n_buckets, np.int64)
        taken = np.zeros(n, bool)
        slot_of = np.empty(n, np.int64)
        by_size = np.argsort(-sizes, kind="stable")
        tries = np.arange(64, dtype=np.uint64)
        single = []
        for b in by_size.tolist():
            k = int(sizes[b])
            if k == 0:
                break
            members = order[starts[b] : starts[b] + k]
            if k == 1:
                single.append((b, int(members[0])))
                continue
            d = 0
            while True:
                slots = self._slots(h[members][None, :], (tries + _U(d))[:, None])
                ok = ~taken[slots].any(axis=1)
                s = np.sort(slots, axis=1)
                ok &= (s[:, 1:] != s[:, :-1]).all(axis=1)
                if ok.any():
                    i = int(ok.argmax())
                    disp[b] = d + i
                    taken[slots[i]] = True
                    slot_of[members] = slots[i]
                    break
                d += 64
                if d > 1 << 24:
                    raise ValueError("two keys share a 64-bit hash")
        free = np.flatnonzero(~taken)
        for (b, m), s in zip(single, free.tolist(), strict=True):
            disp[b] = -s - 1
            slot_of[m] = s
        self.disp = disp
        inv = np.empty(n, np.int64)
        inv[slot_of] = np.arange(n)
        self.value = inv  # slot -> index of its key
        self.h = h[inv]
        self.lens = lens[inv]
        self.starts = places[inv]

    def _slots(self, h: np.ndarray, d: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (words.mix(h + d * _U(0xD6E8FEB86659FD93)) % _U(self.n)).astype(np.int64)

    def lookup(self, h: np.ndarray, buf: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
        """For each word, with its hash, the index of the equal key, or -1."""
        out = np.full(len(h), -1, np.int64)
        if not len(out) or not self.n:
            return out
        d = self.disp[((h >> _U(33)) % _U(self.n_buckets)).astype(np.int64)]
        slot = np.where(d < 0, -d - 1, self._slots(h, np.maximum(d, 0).astype(np.uint64)))
        hit = np.flatnonzero((self.h[slot] == h) & (self.lens[slot] == lens))
        at = slot[hit]
        equal = words.same(buf, starts[hit], self.buf, self.starts[at], lens[hit])
        out[hit[equal]] = self.value[at[equal]]
        return out


def merge(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: always join the pair of the lowest rank, the leftmost of equal ones."""
    n = len(word)
    if n == 1:
        return [ranks[word]]
    get = ranks.get
    nxt = list(range(1, n + 1))
    prv = list(range(-1, n - 1))
    step = n + 1
    now: list[int | None] = [get(word[i : i + 2]) for i in range(n - 1)]
    now.append(None)
    heap = [r * step + i for i, r in enumerate(now) if r is not None]
    heapify(heap)
    while heap:
        r, i = divmod(heappop(heap), step)
        if now[i] != r:
            continue
        j = nxt[i]
        k = nxt[j]
        nxt[i] = k
        now[j] = None
        if k < n:
            prv[k] = i
            r = get(word[i : nxt[k]])
            now[i] = r
            if r is not None:
                heappush(heap, r * step + i)
        else:
            now[i] = None
        p = prv[i]
        if p >= 0:
            r = get(word[p:k])
            now[p] = r
            if r is not None:
                heappush(heap, r * step + p)
    out = []
    i = 0
    while i < n:
        k = nxt[i]
        out.append(ranks[word[i:k]])
        i = k
    return out


class Codec:
    """Encoder and decoder of one rank file and split pattern; picklable, and of bounded size."""

    def __init__(self, rank_file: bytes, pattern: str):
        if len(rank_file) > MAX_VOCAB_BYTES:
            raise ValueError(f"a vocabulary of {len(rank_file)} bytes exceeds {MAX_VOCAB_BYTES}")
        pairs = [line.split() for line in rank_file.splitlines() if line.strip()]
        self.tokens = [base64.b64decode(a) for a, _ in pairs]
        self.ids = np.array([int(b) for _, b in pairs], np.int64)
        self.pattern = pattern
        self.table = PerfectHash(self.tokens)
        by_id: list[bytes] = [b""] * (int(self.ids.max()) + 1 if len(self.ids) else 0)
        for t, i in zip(self.tokens, self.ids.tolist(), strict=True):
            by_id[i] = t
        self.blob = np.frombuffer(b"".join(by_id), np.uint8)
        self.token_len = np.array([len(t) for t in by_id], np.int64)
        self.token_at = np.concatenate(([0], np.cumsum(self.token_len)[:-1])) if by_id else np.empty(0, np.int64)
        self._live()

    def _live(self) -> None:
        self.split = None if self.pattern == words.PATTERN else regex.compile(self.pattern).finditer
        self.ranks = dict(zip(self.tokens, self.ids.tolist(), strict=True))
        self._forget()

    def _forget(self) -> None:
        self.memo = words.Seen(MEMO_BITS)
        self.at, self.n = np.empty(1 << (MEMO_BITS - 1), np.int64), np.empty(1 << (MEMO_BITS - 1), np.int64)
        self.merged, self.used = np.empty(1 << 16, np.uint32), 0

    def __getstate__(self) -> dict:
        return {k: self.__dict__[k] for k in ("tokens", "ids", "pattern", "table", "blob", "token_len", "token_at")}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self._live()

    def _starts(self, off: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where pre-tokens start and how long they are."""
        if self.split is None:
            starts = words.cut(data, off[1:])
            return starts, np.diff(starts, append=len(data))
        found = []
        for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True):
            text = data[a:b].tobytes().decode()
            at = np.concatenate(([0], np.cumsum((np.frombuffer(text.encode("utf-32-le"), np.uint32)[:, None] >= [0, 0x80, 0x800, 0x10000]).sum(axis=1)))) if text else np.zeros(1, np.int64)
            spans = np.array([m.span() for m in self.split(text) if m.end() > m.start()], np.int64).reshape(-1, 2)
            found.append(a + at[spans])
        spans = np.concatenate(found) if found else np.empty((0, 2), np.int64)
        return spans[:, 0], spans[:, 1] - spans[:, 0]

    def _learn(self, h: np.ndarray, buf: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> None:
        """Merge distinct pre-tokens, as many as there is room for, and remember them."""
        starts, lens = starts[: self.memo.room], lens[: self.memo.room]
        found = [merge(buf[a : a + k].tobytes(), self.ranks) for a, k in zip(starts.tolist(), lens.tolist(), strict=True)]
        n = np.array([len(f) for f in found], np.int64)
        total = int(n.sum())
        new = slice(self.memo.n, self.memo.n + len(n))
        self.memo.add(h[: len(n)], buf, starts, lens)
        if self.used + total > len(self.merged):
            self.merged = np.concatenate([self.merged[: self.used], np.empty(self.used + total, np.uint32)])
        self.merged[self.used : self.used + total] = np.fromiter(chain.from_iterable(found), np.uint32, total)
        self.at[new], self.n[new] = self.used + np.cumsum(n) - n, n
        self.used += total

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of ``texts`` in order, and where each text's ids end."""
        off, data = raw(texts)
        if self.split is not None or len(data) <= words.LONG:
            return self._encode(off, data)
        ids, n = [np.empty(0, np.uint32)], []
        for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True):
            parts = [self._encode(np.array([0, len(p)]), np.frombuffer(p, np.uint8))[0] for p in words.bounded(data[a:b].tobytes())]
            ids += parts
            n.append(sum(map(len, parts)))
        return np.concatenate(ids), np.cumsum(np.array(n, np.int64))

    def _encode(self, off: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        starts, lens = self._starts(off, data)
        if not len(starts):
            return np.empty(0, np.uint32), np.zeros(len(off) - 1, np.int64)
        buf = words.padded(data)
        h = words.hash_words(buf, starts, lens)
        key = self.table.lookup(h, buf, starts, lens)
        n = np.ones(len(key), np.int64)
        miss = np.flatnonzero(key < 0)
        entry, alone = self._entries(h[miss], buf, starts[miss], lens[miss])
        n[miss] = self.n[entry]
        for i, m in alone:
            n[miss[i]] = len(m)
        at = np.cumsum(n) - n
        ids = np.empty(int(n.sum()), np.uint32)
        hit = np.flatnonzero(key >= 0)
        ids[at[hit]] = self.ids[key[hit]]
        ids[ragged(at[miss], n[miss])] = self.merged[ragged(self.at[entry], n[miss])] if not alone else 0
        if alone:
            many = np.setdiff1d(np.arange(len(miss)), [i for i, _ in alone])
            ids[ragged(at[miss[many]], n[miss[many]])] = self.merged[ragged(self.at[entry[many]], n[miss[many]])]
            for i, m in alone:
                ids[at[miss[i]] : at[miss[i]] + len(m)] = m
        ends = np.append(at, len(ids))
        return ids, ends[np.searchsorted(starts, off[1:])]

    def _entries(self, h: np.ndarray, buf: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, list[tuple[int, list[int]]]]:
        """Where the ids of each pre-token are remembered; those that could not be, with their ids."""
        entry = self.memo.find(h, buf, starts, lens)
        new = np.flatnonzero(entry < 0)
        if not len(new):
            return entry, []
        _, one = np.unique(h[new], return_index=True)
        if len(one) > self.memo.room:
            self._forget()
            new = np.arange(len(h))
            _, one = np.unique(h, return_index=True)
        one = new[one]
        self._learn(h[one], buf, starts[one], lens[one])
        entry[new] = self.memo.find(h[new], buf, starts[new], lens[new])
        left = np.flatnonzero(entry < 0)  # no room, or two share a hash
        entry[left] = 0
        return entry, [(i, merge(buf[starts[i] : starts[i] + lens[i]].tobytes(), self.ranks)) for i in left.tolist()]

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All bytes of ``ids`` in order, and where each text's bytes end."""
        ids = ids.astype(np.int64)
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.token_len)):
            raise ValueError("an id is outside the vocabulary")
        n = self.token_len[ids]
        per_id = np.concatenate(([0], np.cumsum(n)))
        return self.blob[ragged(self.token_at[ids], n)], per_id[ends]


def codec(path: str, pattern: str) -> Codec:
    with open(path, "rb") as f:
        return Codec(f.read(), pattern)


def _rows(ids: pa.Array, parts: list[pa.Array], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([ids, *parts], names)


def encode(df: DataFrame, coder: Codec, id_col: str = "doc_id", text_col: str = "text", decoded: bool = False) -> DataFrame:
    """One row per input row: ``id_col``, ``ids`` (the ids as little-endian unsigned 32-bit integers, binary) and, if
    ``decoded``, the bytes that those ids decode to.

    A null or empty text has no ids (empty binary); a null id stays null; repeated rows give repeated rows; an empty table
    gives an empty one; other columns are left out. Texts of any length are encoded whole.
    """
    spark = df.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(coder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = shared.value
        for batch in batches:
            for part in chunks(batch, 1, CHUNK_BYTES):
                ids, ends = c.encode(part.column(1))
                out = [binary_array(ids.astype("<u4").view(np.uint8), ends * 4)]
                if decoded:
                    out.append(binary_array(*c.decode(ids, ends)))
                yield _rows(part.column(0), out, ["id", "ids", "decoded"][: 2 + decoded])

    out = id_text(df, id_col, text_col).mapInArrow(lean(run), "id long, ids binary" + ", decoded binary" * decoded)
    return out.withColumnRenamed("id", id_col)


def decode(df: DataFrame, coder: Codec, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """One row per input row: ``id_col`` and ``decoded`` (binary) from ids as ``encode`` writes them; null ids decode to nothing."""
    spark = df.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(coder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = shared.value
        for batch in batches:
            for part in chunks(batch, 1, CHUNK_BYTES):
                off, data = raw(part.column(1))
                yield _rows(part.column(0), [binary_array(*c.decode(np.frombuffer(data.tobytes(), "<u4"), off[1:] // 4))], ["id", "decoded"])

    src = df.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(ids_col), F.lit(b"")).alias("ids"))
    return src.mapInArrow(lean(run), "id long, decoded binary").withColumnRenamed("id", id_col)
