import hashlib

import numpy as np
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from hypercell.llm import bpe, words
from hypercell.llm.queries import vocabulary


@pytest.fixture(scope="module")
def coder():
    return vocabulary()


@pytest.fixture(scope="module")
def plain(coder):
    return tiktoken.Encoding("plain", pat_str=coder.pattern, mergeable_ranks=coder.ranks, special_tokens={})


def same(coder, plain, texts):
    ids, ends = coder.encode(pa.array(texts, pa.string()))
    begin = 0
    for t, e in zip(texts, ends.tolist(), strict=True):
        assert ids[begin:e].tolist() == plain.encode_ordinary(t), t[:80]
        begin = e
    data, at = coder.decode(ids, ends)
    assert data.tobytes() == "".join(texts).encode()
    assert at.tolist() == np.cumsum([len(t.encode()) for t in texts]).tolist()


def test_as_the_library(coder, plain):
    same(coder, plain, ["", "Hello, world!", "a" * 3000, "ab" * 2000 + "\n\n  x ", "I'm we'll 12345  \t\r\n", "", "漢字かな交じり文 🙂", " \x1c\x85\xa0y", "<|endoftext|>"])


def test_all_kinds_of_characters(coder, plain):
    points = [c for c in range(0x2FF)] + list(range(0x300, 0x110000, 211))
    same(coder, plain, [f"a{chr(c)} 1{chr(c)}{chr(c)}b" for c in points if not 0xD800 <= c < 0xE000])


@settings(max_examples=150, deadline=None)
@given(texts=st.lists(st.text(st.characters(codec="utf-8"), max_size=60), max_size=4))
def test_any_text(coder, plain, texts):
    same(coder, plain, texts)


def test_perfect_hash(coder):
    table = coder.table
    assert sorted(table.value.tolist()) == list(range(len(coder.tokens)))  # minimal: every slot has one key
    wanted = [*coder.tokens[:500], b"\xff\xfe\xfd", b"not a token at all"]
    lens = np.array([len(w) for w in wanted])
    starts, buf = np.cumsum(lens) - lens, words.padded(b"".join(wanted))
    assert table.lookup(words.hash_words(buf, starts, lens), buf, starts, lens).tolist() == [*range(500), -1, -1]


def test_little_memory(coder, plain, monkeypatch):
    monkeypatch.setattr(bpe, "MEMO_BITS", 4)
    small = bpe.Codec.__new__(bpe.Codec)
    small.__setstate__(coder.__getstate__())
    for k in range(3):
        same(small, plain, [" ".join(f"zq{i}x{k}ü" for i in range(40)), "zqx " * 50, ""])


def test_long_texts_in_parts(coder, plain, monkeypatch):
    monkeypatch.setattr(words, "LONG", 100)
    monkeypatch.setattr(words.bounded, "__defaults__", (100,))
    same(coder, plain, ["some words and  more\n\n " * 40, "", "a" * 500, "x y"])


def test_another_pattern(coder):
    own = bpe.Codec.__new__(bpe.Codec)
    own.__setstate__(coder.__getstate__() | {"pattern": r"\p{L}+|[^\p{L}]+"})
    same(own, tiktoken.Encoding("own", pat_str=own.pattern, mergeable_ranks=own.ranks, special_tokens={}), ["ab ü漢1 🙂x", "", "  a"])


def test_query(spark, plain):
    from hypercell.llm import queries

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    want = []
    for r in docs:
        ids = np.array(plain.encode_ordinary(r["text"] or ""), "<u4")
        want.append((r["doc_id"], len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256((r["text"] or "").encode()).hexdigest()))
    assert sorted(tuple(r) for r in queries.op1_byte_bpe(spark, "/root/testdata/sf0.001").collect()) == sorted(want)


def test_merge_prefers_the_leftmost_of_equal_ranks():
    ranks = {b"a": 0, b"b": 1, b"aa": 2, b"aab": 3}
    assert bpe.merge(b"aaab", ranks) == [2, 0, 1]
    assert bpe.merge(b"aaaa", ranks) == [2, 2]


def test_odd_rows(odd, none, coder, plain):
    got = sorted(((r["doc_id"], bytes(r["ids"]), bytes(r["decoded"])) for r in bpe.encode(odd, coder, decoded=True).collect()), key=repr)
    want = sorted(((r["doc_id"], np.array(plain.encode_ordinary(r["text"] or ""), "<u4").tobytes(), (r["text"] or "").encode()) for r in odd.collect()), key=repr)
    assert got == want
    assert bpe.encode(none, coder).collect() == []
    back = bpe.decode(bpe.encode(odd, coder), coder).collect()
    assert sorted(hashlib.sha256(r["decoded"]).hexdigest() for r in back) == sorted(hashlib.sha256(x[2]).hexdigest() for x in want)


def test_bad_ids(coder):
    with pytest.raises(ValueError):
        coder.decode(np.array([len(coder.token_len)]), np.array([1]))
