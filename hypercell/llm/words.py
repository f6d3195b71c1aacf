"""Words and pre-tokens of texts as places in a buffer of bytes, their hashes, and a table of those seen, in numpy.

A buffer has at least eight spare bytes behind its text (see ``padded``), so that a word can be read in lanes of eight bytes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import regex

from hypercell.llm.common import ragged

_U = np.uint64
_MASK = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
_FACTOR = _U(0x9E3779B97F4A7C15)

#: Bytes of a text beyond which it is cut in parts.
LONG = 4 << 20

_SAFE = re.compile(rb"[A-Za-z] [A-Za-z]")
_ENDINGS = {*b"stmd", tuple(b"re"), tuple(b"ve"), tuple(b"ll")}

#: The pattern of byte-level tokenizers that ``cut`` follows (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_OTHER, _LETTER, _NUMBER, _SPACE = range(4)
_kinds: np.ndarray | None = None


def kinds() -> np.ndarray:
    """The class of each code point: letter, number, white space or other."""
    global _kinds
    if _kinds is None:
        table = np.zeros(0x110000, np.uint8)
        points = np.concatenate([np.arange(0xD800), np.arange(0xE000, 0x110000)]).astype("<u4").tobytes().decode("utf-32-le")
        for kind, pattern in ((_LETTER, r"\p{L}"), (_NUMBER, r"\p{N}"), (_SPACE, r"\s")):
            for m in regex.finditer(pattern + "+", points):
                a, b = (p if p < 0xD800 else p + 0x800 for p in m.span())
                table[a:b] = kind
        table[0xD800:0xE000] = _OTHER
        _kinds = table
    return _kinds


# The class of each ASCII byte; white space as Unicode has it.
_ASCII_KINDS = bytes(_LETTER if chr(c).isalpha() else _NUMBER if chr(c).isdigit() else _SPACE if c in b" \t\n\r\f\v" else _OTHER for c in range(128)) + bytes(128)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def padded(data: bytes | np.ndarray) -> np.ndarray:
    """A copy with spare bytes."""
    out = np.zeros(len(data) + 8, np.uint8)
    out[: len(data)] = np.frombuffer(data, np.uint8)
    return out


def _eights(buf: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, as a number."""
    return np.ndarray((len(buf) - 7,), "<u8", buf, strides=(1,))


def first_eight(buf: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    return _eights(buf)[starts] & _MASK[np.minimum(lens, 8)]


def hash_words(buf: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word."""
    with np.errstate(over="ignore"):
        h = mix(first_eight(buf, starts, lens) + lens.astype(np.uint64) * _FACTOR)
        more, k = np.flatnonzero(lens > 8), 8
        while len(more):
            h[more] = mix(h[more] * _FACTOR + first_eight(buf, starts[more] + k, lens[more] - k))
            k += 8
            more = more[lens[more] > k]
    return h | _U(1)  # never zero


def same(a: np.ndarray, a_starts: np.ndarray, b: np.ndarray, b_starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Whether words of equal lengths in two buffers are equal."""
    ok = first_eight(a, a_starts, lens) == first_eight(b, b_starts, lens)
    more, k = np.flatnonzero(ok & (lens > 8)), 8
    while len(more):
        fits = first_eight(a, a_starts[more] + k, lens[more] - k) == first_eight(b, b_starts[more] + k, lens[more] - k)
        ok[more[~fits]] = False
        k += 8
        more = more[fits & (lens[more] > k)]
    return ok


class Seen:
    """An open hash table of words; a lookup compares all bytes. It holds half as many words as it has slots."""

    def __init__(self, bits: int):
        self.mask, self.n = (1 << bits) - 1, 0
        self.slot_hash = np.zeros(1 << bits, np.uint64)
        self.slot = np.empty(1 << bits, np.int32)
        self.len = np.empty(1 << (bits - 1), np.int32)
        self.first = np.empty(1 << (bits - 1), np.uint64)
        self.start = np.empty(1 << (bits - 1), np.int64)
        self.buf, self.used = np.zeros(1 << 16, np.uint8), 0

    @property
    def room(self) -> int:
        return len(self.len) - self.n

    def find(self, h: np.ndarray, buf: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
        """The number of each word, or -1."""
        if not self.n:
            return np.full(len(h), -1, np.int64)
        at = ((h >> _U(20)) & _U(self.mask)).astype(np.int64)
        there = self.slot_hash[at]
        left = np.flatnonzero((there != h) & (there != 0))
        while len(left):
            at[left] = (at[left] + 1) & self.mask
            there[left] = now = self.slot_hash[at[left]]
            left = left[(now != h[left]) & (now != 0)]
        entry = self.slot[at].astype(np.int64)
        bad = there == 0
        entry[bad] = 0
        bad |= (self.len[entry] != lens) | (self.first[entry] != first_eight(buf, starts, lens))
        more, k = np.flatnonzero((lens > 8) & ~bad), 8
        while len(more):
            rest = lens[more] - k
            wrong = first_eight(buf, starts[more] + k, rest) != first_eight(self.buf, self.start[entry[more]] + k, rest)
            bad[more[wrong]] = True
            k += 8
            more = more[~wrong & (rest > 8)]
        entry[bad] = -1
        return entry

    def add(self, h: np.ndarray, buf: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> None:
        """Take words of distinct hashes that are not there, as many as there is room for; their numbers follow on."""
        n, size = len(h), int(lens.sum())
        if self.used + size + 8 > len(self.buf):
            self.buf = np.concatenate([self.buf[: self.used], np.zeros(max(len(self.buf), size) + size + 8, np.uint8)])
        self.buf[self.used : self.used + size] = buf[ragged(starts, lens)]
        new = slice(self.n, self.n + n)
        self.len[new], self.first[new] = lens, first_eight(buf, starts, lens)
        self.start[new] = self.used + np.cumsum(lens) - lens
        self.used += size
        left, at = np.arange(n), ((h >> _U(20)) & _U(self.mask)).astype(np.int64)
        while len(left):
            free = left[self.slot_hash[at[left]] == 0]
            self.slot[at[free]] = self.n + free  # of several that want a slot, the last has it
            won = free[self.slot[at[free]] == self.n + free]
            self.slot_hash[at[won]] = h[won]
            done = np.zeros(n, bool)
            done[won] = True
            left = left[~done[left]]
            at[left] = (at[left] + 1) & self.mask
        self.n += n


def _kinds_of(data: np.ndarray) -> np.ndarray:
    """The class of the character that each byte belongs to."""
    kind = np.frombuffer(bytearray(data.tobytes().translate(_ASCII_KINDS)), np.uint8)
    lead = np.flatnonzero(data >= 0xC0)
    if len(lead):
        table, wide = kinds(), padded(data)
        size = 2 + (data[lead] >= 0xE0).astype(np.int64) + (data[lead] >= 0xF0)
        for n, bits in ((2, 0x1F), (3, 0x0F), (4, 0x07)):
            at = lead[size == n]
            point = wide[at].astype(np.int64) & bits
            for k in range(1, n):
                point = (point << 6) | (wide[at + k] & 0x3F)
            found = table[point]
            for k in range(n):
                kind[at + k] = found
    return kind


def cut(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Where the matches of ``PATTERN`` in consecutive UTF-8 texts start; they leave nothing out. ``ends``: of the texts, in bytes."""
    n = int(ends[-1]) if len(ends) else 0
    if not n:
        return np.empty(0, np.int64)
    data = data[:n]
    kind = _kinds_of(data)
    new = np.zeros(n + 1, bool)  # where a text starts, and the end
    new[ends] = True
    new[0] = True
    mark = new.copy()
    mark[1:n] |= kind[1:] != kind[:-1]
    runs = np.flatnonzero(mark)
    begin, end = runs[:-1], runs[1:]
    of = kind[begin]
    # The last character of white space that something follows stands alone, or, if it is a blank, begins what follows.
    followed = end[of == _SPACE]
    followed = followed[~new[followed]]
    last = followed - 1
    while len(inside := np.flatnonzero((data[last] & 0xC0) == 0x80)):
        last[inside] -= 1
    mark[last] = True
    mark[followed[data[last] == 0x20]] = False
    # A lone apostrophe that no blank precedes takes a short ending with it.
    lone = np.flatnonzero((data[begin] == 0x27) & (end - begin == 1) & mark[begin])
    for i in lone.tolist():
        a = int(begin[i])
        if i + 1 >= len(begin) or new[a + 1] or of[i + 1] != _LETTER:
            continue
        c = int(data[a + 1])
        k = 1 if c in _ENDINGS else 2 if a + 2 < end[i + 1] and (c, int(data[a + 2])) in _ENDINGS else 0
        if k:
            mark[a + 1] = False
            mark[a + 1 + k] = True
    return np.flatnonzero(mark[:n])


def bounded(text: bytes, size: int = LONG) -> Iterator[bytes]:
    """A UTF-8 text in parts of about ``size`` bytes, cut before a blank between two ASCII letters, where a match of ``PATTERN`` always
    starts; a text without such a place stays whole."""
    at = 0
    while len(text) - at > size:
        m = _SAFE.search(text, at + size)
        if not m:
            break
        yield text[at : m.start() + 1]
        at = m.start() + 1
    yield text[at:]
