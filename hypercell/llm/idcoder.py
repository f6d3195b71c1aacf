"""Adaptive context-mixing range coder for token ids.

A segment's ids are numbered by falling frequency (order 0) and cut into blocks, each of which starts from an empty model. In
a block the contexts of one and two previous ids each predict an id; how sure a context is and how often it was right lately
give the share of the range that its id gets, and the rest goes to the order-0 frequencies of all ids. All blocks are
coded side by side in numpy, in whole numbers only, so that results are the same everywhere.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

#: Ids of a block, blocks coded side by side, and the first id that is too large.
BLOCK, LANES, MAX_ID = 2048, 4096, 1 << 24

_B1, _B2 = 9, 10  # bits of the slots of the contexts of one and two ids
_TOTAL = 12  # bits of the coder's frequencies
_ONE = 1 << _TOTAL
_LOW = 8  # bits of a number within its bucket that are coded at once
_MOST = _ONE - _ONE // 16  # what one context gets at most
_RATE = 5
_STEP = np.int32(_ONE >> _RATE)
# The range stays between 2 ** 32 and 2 ** 48 from id to id; digits have 16 bits.
_FLOOR, _BELOW = 1 << 32, (1 << 32) - 1
# The share at first for each step of confidence, from 1 to 7.
_START = 512
_H1, _H2, _H3 = 0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35


def bucket(rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of ranks that a rank is in, and how many of its bits it leaves open: 16 buckets for each doubling."""
    open_bits = np.maximum(np.frexp(rank.astype(np.float64))[1] - 5, 0).astype(np.int64)
    return (open_bits << 4) + (rank >> open_bits), open_bits


def _slots(one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    a = (one * _H1) & 0xFFFFFFFF
    b = ((one * _H2) ^ (two * _H3 + 1)) & 0xFFFFFFFF
    return a >> (32 - _B1), ((b * _H1) & 0xFFFFFFFF) >> (32 - _B2)


def _mask(where: np.ndarray) -> np.ndarray:
    """All bits set where a condition holds; choosing by bits costs no mispredicted branches, unlike ``np.where``."""
    out = where.astype(np.int32)
    return np.negative(out, out=out)


def _pick(mask: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a`` where the mask is set, else ``b``."""
    out = a ^ b
    out &= mask
    out ^= b
    return out


class Order0:
    """How often each bucket of ranks occurs, in shares of ``_ONE``."""

    def __init__(self, freq: np.ndarray, n_ranks: int):
        self.freq = freq.astype(np.int64)
        self.start = np.cumsum(self.freq) - self.freq
        self.rank, self.bits = bucket(np.arange(n_ranks))
        n = np.arange(len(freq))
        self.open = np.maximum((n >> 4) - 1, 0)
        self.first = np.where(n < 32, n, ((n & 15) + 16) << self.open)
        # The same by each place in the whole share.
        find = np.repeat(n, self.freq)
        self.start_at, self.freq_at = self.start[find].astype(np.int32), self.freq[find].astype(np.int32)
        self.open_at, self.first_at = self.open[find].astype(np.int32), self.first[find].astype(np.int32)

    @classmethod
    def of(cls, counts: np.ndarray) -> "Order0":
        """``counts`` by rank."""
        total = np.bincount(bucket(np.arange(len(counts)))[0], counts)
        freq = np.maximum(1, (total * _ONE // max(1, counts.sum())).astype(np.int64))
        while (over := int(freq.sum()) - _ONE) > 0:  # ones that were raised are taken from the largest
            big = np.flatnonzero(freq == freq.max())[0]
            freq[big] -= min(over, max(1, int(freq[big]) // 2))
        if len(freq):
            freq[0] -= int(freq.sum()) - _ONE
        return cls(freq, len(counts))


class _Model:
    """The contexts of all lanes: the rank that each slot predicts with its confidence, and each context's average share."""

    def __init__(self, lanes: int):
        self.tables = (np.zeros(lanes << _B1, np.int32), np.zeros(lanes << _B2, np.int32))
        self.base = (np.arange(lanes, dtype=np.int64) << _B1, np.arange(lanes, dtype=np.int64) << _B2)
        self.share = (np.full(lanes, _START, np.int32), np.full(lanes, _START, np.int32))
        self.most = np.full(lanes, _MOST, np.int32)

    def predict(self, at: tuple[np.ndarray, np.ndarray], k: int) -> None:
        """What gets which share: the context of two ids first, that of one id a part of what is left."""
        self.at, self.k = at, k
        (t1, t2), (s1, s2), (at1, at2) = self.tables, self.share, at
        e1, e2 = t1.take(at1, mode="clip"), t2.take(at2, mode="clip")
        self.entry = (e1, e2)
        self.conf = c1, c2 = e1 & 7, e2 & 7
        self.x1, self.x2 = e1 >> 3, e2 >> 3
        most = self.most[:k]
        f1, f2 = np.minimum(c1 * s1[:k], most), np.minimum(c2 * s2[:k], most)
        f1 *= _ONE - f2
        f1 >>= _TOTAL
        both = f1 * (self.x1 == self.x2)
        f2 += both
        f1 -= both
        self.f1, self.f2, self.a1 = f1, f2, f1 + f2

    def update(self, x: np.ndarray, same: tuple[np.ndarray, np.ndarray]) -> None:
        """``same``: where each context predicted ``x``."""
        fresh = (x << 3) | 1
        for table, at, e, c, equal, share in zip(self.tables, self.at, self.entry, self.conf, same, self.share, strict=True):
            known = c > 0
            hit = equal & known
            one = hit.astype(np.int32)
            new = e - 1
            one += one
            new += one
            np.minimum(new, e | 7, out=new)
            table[at] = _pick(_mask((c < 2) > hit), fresh, new)
            s = share[: self.k]
            step = s >> _RATE
            one *= _STEP // 2
            step -= one
            step *= known
            s -= step


class _Encoder:
    def __init__(self, lanes: int, steps: int):
        self.low = np.zeros(lanes, np.int64)
        self.range = np.full(lanes, (1 << 48) - 1, np.int64)
        # The first digits of all lanes, then the second ones, and so on; an id takes 48 bits at most. Only what is written takes memory.
        self.out = np.empty(lanes * (3 * steps + 4), np.int32)
        self.at = np.arange(lanes, dtype=np.int64)

    def put(self, k: int, start: np.ndarray, freq: np.ndarray) -> None:
        r = self.range[:k] >> 2 * _TOTAL
        self.low[:k] += r * start
        np.multiply(r, freq, out=self.range[:k])

    def put_bits(self, k: int, value: np.ndarray, bits: np.ndarray) -> None:
        r = self.range[:k] >> bits
        self.low[:k] += r * value
        self.range[:k] = r

    def settle(self, k: int) -> None:
        small = np.flatnonzero(self.range[:k] < _FLOOR)
        while len(small):
            x, rng, at = self.low[small], self.range[small] << 16, self.at[small]
            self.out[at] = x >> 32  # 17 bits: the carry is settled at the end
            self.at[small] = at + len(self.at)
            self.low[small] = (x & _BELOW) << 16
            self.range[small] = rng
            small = small[rng < _FLOOR]

    def digits(self) -> list[bytes]:
        # The range holds a number whose digits but the first are zero.
        self.out[self.at] = (self.low + _BELOW) >> 32
        lanes = len(self.at)
        lens = self.at // lanes + 1
        rows = int(lens.max(initial=0))
        digit = np.ascontiguousarray(self.out[: rows * lanes].reshape(rows, lanes).T)[np.arange(rows)[None, :] < lens[:, None]]
        while (over := digit >> 16).any():
            digit &= 0xFFFF
            digit[:-1] += over[1:]
        data, ends = digit.astype("<u2").tobytes(), np.cumsum(lens).tolist()
        return [data[2 * a : 2 * b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]


class _Decoder:
    def __init__(self, blocks: list[bytes]):
        lens = np.array([len(b) // 2 for b in blocks], np.int64)
        # Zeros follow each block's digits.
        self.width = int(lens.max(initial=0)) + 4
        grid = np.zeros((len(blocks), self.width), "<u2")
        grid[np.arange(self.width)[None, :] < lens[:, None]] = np.concatenate([np.frombuffer(b, "<u2") for b in blocks])
        self.data = grid.ravel()
        self.at = np.arange(len(blocks), dtype=np.int64) * self.width
        self.last = self.at + self.width - 1
        d = [self.data[self.at + i].astype(np.int64) for i in range(3)]
        self.code = (d[0] << 32) | (d[1] << 16) | d[2]
        self.at += 3
        self.range = np.full(len(blocks), (1 << 48) - 1, np.int64)

    def look(self, k: int) -> np.ndarray:
        self.r = self.range[:k] >> 2 * _TOTAL
        # Exact: both are whole numbers below 2 ** 48, and the quotient has 24 bits and is 2 ** -24 from the next number at least.
        return np.minimum((self.code[:k] / self.r).astype(np.int32), _ONE * _ONE - 1)

    def take(self, k: int, start: np.ndarray, freq: np.ndarray) -> None:
        self.code[:k] -= self.r * start
        np.multiply(self.r, freq, out=self.range[:k])

    def take_bits(self, k: int, bits: np.ndarray) -> np.ndarray:
        r = self.range[:k] >> bits
        value = np.minimum((self.code[:k] / r).astype(np.int64), (1 << bits) - 1)
        self.code[:k] -= r * value
        self.range[:k] = r
        return value

    def settle(self, k: int) -> None:
        small = np.flatnonzero(self.range[:k] < _FLOOR)
        while len(small):
            at, rng = self.at[small], self.range[small] << 16
            self.code[small] = (self.code[small] << 16) | self.data[np.minimum(at, self.last[small])]
            self.at[small] = at + 1
            self.range[small] = rng
            small = small[rng < _FLOOR]


def _active(lens: np.ndarray) -> np.ndarray:
    """How many lanes, longest first, have an id at each step."""
    return len(lens) - np.searchsorted(np.sort(lens), np.arange(int(lens.max(initial=0))), side="right")


def _bounds(model: _Model, hit2: np.ndarray, known: np.ndarray, start: np.ndarray, freq: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and size of the share of an id, of ``_ONE`` times ``_ONE``: of a context's hit (masks: of two ids, of
    any), or of the id's bucket, which has ``start`` and ``freq``, in what the contexts leave."""
    left = _ONE - model.a1
    first = left * start
    first += model.a1 << _TOTAL
    size = left * freq
    return _pick(known, (model.f2 & ~hit2) << _TOTAL, first), _pick(known, _pick(hit2, model.f2, model.f1) << _TOTAL, size)


def _flat(lens: np.ndarray) -> bool:
    """Whether all lanes but the last have the same length."""
    return bool((lens[:-1] == lens[:1]).all())


def encode_blocks(ranks: np.ndarray, lens: np.ndarray, zero: Order0) -> list[bytes]:
    """Code consecutive blocks of ``ranks`` of the given lengths (longest first) side by side."""
    lanes = len(lens)
    steps = int(lens.max(initial=0))
    model, coder = _Model(lanes), _Encoder(lanes, steps)
    grid = np.zeros((lanes, steps), np.int32)
    if _flat(lens):
        grid.ravel()[: len(ranks)] = ranks
    else:
        grid[np.arange(steps)[None, :] < lens[:, None]] = ranks
    start_of, freq_of, first_of, bits_of = (a.astype(np.int32) for a in (zero.start, zero.freq, zero.first, zero.bits))
    active = _active(lens).tolist()
    one = np.zeros((2, lanes), np.int64)
    wide_ranks = int(zero.bits.max(initial=0)) > _LOW
    for begin in range(0, steps, 64):  # what does not hang on the model, for many steps at once
        part = np.ascontiguousarray(grid[:, begin : begin + 64].T)
        wide = np.concatenate([one, part])
        one = wide[-2:]
        at1, at2 = _slots(wide[1:-1], wide[:-2])
        at1 += model.base[0]
        at2 += model.base[1]
        of, bits = zero.rank[part], bits_of[part]
        start, freq = start_of[of], freq_of[of]
        rest = part - first_of[of]
        for t in range(len(part)):
            k = active[begin + t]
            x = part[t, :k]
            model.predict((at1[t, :k], at2[t, :k]), k)
            same = same1, same2 = x == model.x1, x == model.x2
            hit2 = same2 & (model.f2 > 0)
            known = same1 & (model.f1 > 0)
            known |= hit2
            known = _mask(known)
            coder.put(k, *_bounds(model, _mask(hit2), known, start[t, :k], freq[t, :k]))
            # An id that a context predicted takes no bits.
            other = ~known
            b, value = bits[t, :k] & other, rest[t, :k] & other
            if wide_ranks:
                low = np.minimum(b, _LOW)
                coder.put_bits(k, value & ((1 << low) - 1), low)
                coder.settle(k)
                coder.put_bits(k, value >> low, b - low)
            else:
                coder.put_bits(k, value, b)
            coder.settle(k)
            model.update(x, same)
    return coder.digits()


def decode_blocks(blocks: list[bytes], lens: np.ndarray, zero: Order0) -> np.ndarray:
    """The ranks of blocks of the given lengths (longest first), one after another."""
    lanes = len(lens)
    steps = int(lens.max(initial=0))
    model, coder = _Model(lanes), _Decoder(blocks)
    grid = np.zeros((steps, lanes), np.int32)
    one, two = np.zeros(lanes, np.int64), np.zeros(lanes, np.int64)
    wide_ranks = int(zero.bits.max(initial=0)) > _LOW
    for t, k in enumerate(_active(lens).tolist()):
        at1, at2 = _slots(one[:k], two[:k])
        model.predict((at1 + model.base[0][:k], at2 + model.base[1][:k]), k)
        v = coder.look(k)
        place = v >> _TOTAL
        hit2, known = _mask(place < model.f2), _mask(place < model.a1)
        of = ((v - (model.a1 << _TOTAL)) / (_ONE - model.a1)).astype(np.int64)  # clipped where a context hit
        coder.take(k, *_bounds(model, hit2, known, zero.start_at.take(of, mode="clip"), zero.freq_at.take(of, mode="clip")))
        b = zero.open_at.take(of, mode="clip") & ~known
        if wide_ranks:
            low = np.minimum(b, _LOW)
            value = coder.take_bits(k, low)
            coder.settle(k)
            value |= coder.take_bits(k, b - low) << low
        else:
            value = coder.take_bits(k, b)
        coder.settle(k)
        x = (zero.first_at.take(of, mode="clip") + value).astype(np.int32)
        x = _pick(known, _pick(hit2, model.x2, model.x1), x)
        grid[t, :k] = x
        model.update(x, (x == model.x1, x == model.x2))
        two[:k] = one[:k]
        one[:k] = x
    flat = np.ascontiguousarray(grid.T)
    if _flat(lens):
        return flat.ravel()[: int(lens.sum())]
    return flat[np.arange(steps)[None, :] < lens[:, None]]


# A segment: magic, documents, ids, blocks, bytes of the packed index; the index (document ids, then ids in each document, the number of
# distinct ids, differences of these by falling frequency, shares of their buckets; zlib); of each block ids, bytes and CRC-32 of its ids; the blocks.
_MAGIC = b"HCI3"
_HEAD = struct.Struct("<4sIQII")


def pack(doc_ids: np.ndarray, counts: np.ndarray, ids: np.ndarray, block: int = BLOCK) -> bytes:
    """A segment of whole documents."""
    if len(ids) and int(ids.max()) >= MAX_ID:
        raise ValueError(f"ids from {MAX_ID} on cannot be coded")
    often = np.bincount(ids) if len(ids) else np.zeros(0, np.int64)
    order = np.argsort(-often, kind="stable")[: np.count_nonzero(often)]
    zero = Order0.of(often[order])
    order = order[np.lexsort((order, zero.rank))]  # within a bucket by id
    rank = np.zeros(len(often), np.int32)
    rank[order] = np.arange(len(order))
    n_blocks = -(-len(ids) // block)
    lens = np.full(n_blocks, block, np.int64)
    if n_blocks:
        lens[-1] = len(ids) - block * (n_blocks - 1)
    coded: list[bytes] = []
    for a in range(0, n_blocks, LANES):
        coded += encode_blocks(rank[ids[a * block : (a + LANES) * block]], lens[a : a + LANES], zero)
    plain = ids.astype("<u4")
    sums = [zlib.crc32(plain[i * block : (i + 1) * block]) for i in range(n_blocks)]
    index = zlib.compress(b"".join([doc_ids.astype("<i8").tobytes(), counts.astype("<u8").tobytes(), struct.pack("<I", len(order)), np.diff(order, prepend=0).astype("<i4").tobytes(), zero.freq.astype("<u2").tobytes()]), 6)
    table = np.array([lens, [len(c) for c in coded], sums], "<u4").T.tobytes() if n_blocks else b""
    return b"".join([_HEAD.pack(_MAGIC, len(doc_ids), len(ids), n_blocks, len(index)), index, table, *coded])


def unpack(segment: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document ids, ids in each document, and all ids of a segment; a damaged one raises an error."""
    magic, n_docs, n_ids, n_blocks, n_index = _HEAD.unpack_from(segment)
    if magic != _MAGIC:
        raise ValueError("not a segment of ids")
    at = _HEAD.size
    try:
        index = zlib.decompress(segment[at : at + n_index])
    except zlib.error as e:
        raise ValueError("the segment's index is damaged") from e
    docs, counts = np.frombuffer(index, "<i8", n_docs), np.frombuffer(index, "<u8", n_docs, 8 * n_docs).astype(np.int64)
    (n_known,) = struct.unpack_from("<I", index, 16 * n_docs)
    known = np.cumsum(np.frombuffer(index, "<i4", n_known, 16 * n_docs + 4))
    zero = Order0(np.frombuffer(index, "<u2", -1, 16 * n_docs + 4 + 4 * n_known), n_known)
    at += n_index
    table = np.frombuffer(segment, "<u4", 3 * n_blocks, at).reshape(n_blocks, 3).astype(np.int64)
    at += 12 * n_blocks
    ends = at + np.cumsum(table[:, 1])
    parts = []
    for a in range(0, n_blocks, LANES):
        rows = range(a, min(a + LANES, n_blocks))
        lens = table[a : a + LANES, 0]
        ranks = decode_blocks([segment[ends[i] - table[i, 1] : ends[i]] for i in rows], lens, zero)
        got = known[np.minimum(ranks, n_known - 1)].astype("<u4")
        begin = 0
        for i, n in zip(rows, lens.tolist(), strict=True):
            if zlib.crc32(got[begin : begin + n]) != table[i, 2]:
                raise ValueError(f"block {i} is damaged")
            begin += n
        parts.append(got)
    ids = np.concatenate(parts) if parts else np.empty(0, "<u4")
    if len(ids) != n_ids or counts.sum() != n_ids:
        raise ValueError("the segment's counts disagree")
    return docs, counts, ids
