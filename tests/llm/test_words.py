import numpy as np
import pyarrow as pa
import regex
from hypothesis import given, settings
from hypothesis import strategies as st

from hypercell.llm import words as W
from hypercell.llm.common import raw

SPLIT = regex.compile(W.PATTERN)


def starts(texts):
    off, data = raw(pa.array(texts, pa.string()))
    return W.cut(data, off[1:]).tolist()


def plain(texts):
    out, at = [], 0
    for t in texts:
        for m in SPLIT.findall(t):
            out.append(at)
            at += len(m.encode())
    return out


@settings(max_examples=400, deadline=None)
@given(st.lists(st.text(st.sampled_from("abstmdrevl'''   \n\t.!1\u0663\u00e9\u00df\u6f22\u0301\u00a0\u2003\u0085\x1c\U0001f642"), max_size=14), max_size=4))
def test_cut_as_the_pattern(texts):
    assert starts(texts) == plain(texts)


def test_cut_at_every_point():
    texts = [f"a{chr(c)} {chr(c)}1{chr(c)}" for c in range(0x110000) if not 0xD800 <= c < 0xE000 and (c < 0x3100 or c % 97 == 0)]
    assert starts(texts) == plain(texts)


def test_bounded_parts_split_alike():
    text = ("some words, and \u00fcmlauts  \n\n it's 1 2 " * 300).encode()
    for size in (50, 333, 10**6):
        parts = list(W.bounded(text, size))
        assert b"".join(parts) == text and (size > len(text) or len(parts) > 3)
        assert sum(len(SPLIT.findall(p.decode())) for p in parts) == len(SPLIT.findall(text.decode()))
    assert list(W.bounded(b"a" * 1000, 10)) == [b"a" * 1000] and list(W.bounded(b"", 10)) == [b""]


def test_seen_words():
    rng = np.random.default_rng(1)
    texts = [bytes(rng.integers(97, 100, rng.integers(1, 30))) for _ in range(3000)]
    lens = np.array([len(t) for t in texts])
    at, buf = np.cumsum(lens) - lens, W.padded(b"".join(texts))
    h = W.hash_words(buf, at, lens)
    assert len(set(h.tolist())) == len(set(texts))
    seen = W.Seen(14)
    assert (seen.find(h, buf, at, lens) == -1).all()
    _, one = np.unique(h, return_index=True)
    for part in np.array_split(one, 5):
        seen.add(h[part], buf, at[part], lens[part])
    got = seen.find(h, buf, at, lens)
    assert [texts[one[i]] for i in got] == texts
    assert seen.find(h, buf[::-1].copy(), at, lens).max() < len(one)  # equal hashes of other bytes are no hit
    wrong = W.padded(b"".join(t[::-1] for t in texts))
    assert all(texts[i] != texts[i][::-1] or g >= 0 for i, g in enumerate(seen.find(h, wrong, at, lens)))
