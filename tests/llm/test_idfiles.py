import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from hypercell.llm import idcoder as C
from hypercell.llm import idfiles

DEFINITION = open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8").read()


def back(ids, block=C.BLOCK):
    ids = np.asarray(ids, np.uint32)
    docs, counts, got = C.unpack(C.pack(np.array([5]), np.array([len(ids)]), ids, block))
    assert got.tolist() == ids.tolist() and docs.tolist() == [5] and counts.tolist() == [len(ids)]


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, C.MAX_ID - 1) | st.integers(0, 3), max_size=400), st.sampled_from([1, 7, 64, 2048]))
def test_any_ids_come_back(ids, block):
    back(ids, block)


def test_predictable_ids_are_small():
    rng = np.random.default_rng(0)
    # The numbers of distinct ids come with each segment, which counts in one so small.
    for ids, most in ((np.zeros(20_000, int), 0.3), (np.tile([5, 6, 5, 7, 8, 900], 4000), 0.6), (rng.integers(0, 50_000, 20_000), 20), (rng.zipf(1.3, 20_000) % 50_000, 8.3)):
        back(ids)
        assert 8 * len(C.pack(np.array([1]), np.array([len(ids)]), ids.astype(np.uint32))) <= most * len(ids)


def test_many_lanes_and_carries(monkeypatch):
    monkeypatch.setattr(C, "LANES", 8)
    back(np.random.default_rng(2).integers(0, 1 << 24, 5000), 100)


def test_blocks_stand_alone():
    ids = np.random.default_rng(4).integers(0, 1000, 300, dtype=np.uint32)
    zero = C.Order0.of(np.ones(1000, np.int64))
    whole = C.encode_blocks(ids, np.array([100, 100, 100]), zero)
    assert whole[1] == C.encode_blocks(ids[100:200], np.array([100]), zero)[0]
    assert C.decode_blocks(whole[1:2], np.array([100]), zero).tolist() == ids[100:200].tolist()


def test_every_rank_has_a_bucket():
    ranks = np.concatenate([np.arange(70_000), np.arange(C.MAX_ID - 50, C.MAX_ID)])
    of, bits = C.bucket(ranks)
    zero = C.Order0.of(np.ones(1000, np.int64))
    assert zero.freq.sum() == 1 << 12 and zero.freq.min() > 0
    n = np.arange(int(of.max()) + 1)
    first = np.where(n < 32, n, ((n & 15) + 16) << np.maximum((n >> 4) - 1, 0))
    assert ((ranks >= first[of]) & (ranks < first[of] + (1 << bits))).all()


def test_smaller_than_zlib_on_real_ids():
    """Against zlib on the same ids as 16-bit numbers, in the same blocks and as a whole."""
    text = pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text"]).column("text").combine_chunks()
    ids, _ = idfiles.tokens(DEFINITION).encode(text if isinstance(text, pa.Array) else text.chunk(0))
    coded = len(C.pack(np.array([1]), np.array([len(ids)]), ids))
    blocks = sum(len(zlib.compress(ids[i : i + C.BLOCK].astype("<u2").tobytes(), 9)) for i in range(0, len(ids), C.BLOCK))
    assert coded < 0.8 * blocks and coded < 0.95 * len(zlib.compress(ids.astype("<u2").tobytes(), 9))


def test_damage_is_noticed():
    seg = bytearray(C.pack(np.array([1]), np.array([5000]), np.random.default_rng(5).integers(0, 40_000, 5000, dtype=np.uint32)))
    seg[-700] ^= 4
    with pytest.raises(ValueError, match="damaged"):
        C.unpack(bytes(seg))
    with pytest.raises(ValueError):
        C.unpack(b"XXXX" + bytes(seg[4:]))
    with pytest.raises(ValueError):
        C.pack(np.array([1]), np.array([1]), np.array([C.MAX_ID], np.uint32))


@pytest.fixture(scope="module")
def plain():
    t = Tokenizer.from_str(DEFINITION)
    return lambda text: t.encode(text, add_special_tokens=False).ids


def check(tokens, texts, plain):
    ids, n = tokens.encode(pa.array(texts, pa.string()))
    ends = np.cumsum(n)
    for t, e, k in zip(texts, ends.tolist(), n.tolist(), strict=True):
        assert ids[e - k : e].tolist() == plain(t), t


def test_pieces_as_whole_texts(plain, monkeypatch):
    points = [c for c in range(0x300)] + [c for c in range(0x300, 0x110000, 401) if not 0xD800 <= c < 0xE000]
    texts = ["", "It's  a\n\n test’s  \t 123", " ", "\x1c a \x85 b", "we'll 're''s 'd'tis", *[f"a{chr(c)} {chr(c)}1{chr(c)}" for c in points]]
    for bits in (idfiles.MEMO_BITS, 9):
        monkeypatch.setattr(idfiles, "MEMO_BITS", bits)
        tokens = idfiles.Tokens(DEFINITION)
        assert tokens.by_piece
        for _ in range(2):
            check(tokens, texts, plain)
            for part in range(0, len(texts), 50):
                check(tokens, texts[part : part + 50], plain)


def test_long_texts_in_parts(plain, monkeypatch):
    monkeypatch.setattr(idfiles.words, "LONG", 100)
    monkeypatch.setattr(idfiles.words.bounded, "__defaults__", (100,))
    check(idfiles.Tokens(DEFINITION), ["some words and  more\n\n " * 40, "", "a" * 500, "x y"], plain)


def test_added_tokens_are_the_librarys(plain):
    """The library's defaults hold: a special token's string in a text is that token."""
    assert plain("hello <|endoftext|> world") == [31373, 220, 50256, 995]
    check(idfiles.Tokens(DEFINITION), ["hello <|endoftext|> world", "x", "<|endoftext|>", ""], plain)


def expected(rows, plain):
    out, start = [], 0
    for i, text in sorted(((r["doc_id"], r["text"] or "") for r in rows), key=lambda x: (x[0] is not None, x[0], x[1].encode())):
        ids = [*plain(text), 0]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return sorted(out, key=repr)


def rows(df):
    return sorted(((r["id"], r["start"], r["n_ids"], r["crc32"]) for r in df.collect()), key=repr)


def test_files(spark, odd, none, plain, tmp_path, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    for k, df in enumerate((odd, docs.repartition(5))):
        path = str(tmp_path / f"f{k}")
        idfiles.write(df, path, DEFINITION)
        got = idfiles.read(spark, path)
        assert rows(got) == expected(df.collect(), plain)
        assert all(zlib.crc32(r["ids"]) == r["crc32"] and len(r["ids"]) == 4 * r["n_ids"] for r in got.collect())
    idfiles.write(none, str(tmp_path / "none"), DEFINITION)
    assert idfiles.read(spark, str(tmp_path / "none")).collect() == []


def test_query(spark, plain):
    from hypercell.llm import queries

    got = queries.op7_id_files(spark, "/root/testdata/sf0.001").collect()
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    assert sorted((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in got) == sorted(expected(docs, plain))


def test_pieces_together_have_the_ids_they_have_alone():
    coder = idfiles.Tokens(DEFINITION)
    assert coder.apart is not None
    rng = np.random.default_rng(7)
    # Pieces of any bytes; the last ones have the byte between pieces too, and go one by one.
    for low, high, n in ((97, 105, 500), (0, 0xC0, 333), (0xC1, 256, 16), (97, 99, 1), (0, 256, 100)):
        lens = rng.integers(1, 30, n)
        buf = rng.integers(low, high, lens.sum(), dtype=np.uint8)
        starts = np.cumsum(lens) - lens
        alone = [[t.id for t in coder.tokenizer.model.tokenize(buf[a : a + k].tobytes().decode("latin-1").translate(coder.chars))] for a, k in zip(starts, lens, strict=True)]
        ids, counts = coder._words(buf, starts, lens)
        assert counts.tolist() == [len(a) for a in alone] and ids.tolist() == [i for a in alone for i in a]


def test_a_hit_takes_one_share_of_the_range(monkeypatch):
    """The coder narrows the range once for an id's context and bucket, and once for its open bits if there are any."""
    calls = []
    put = C._Encoder.put
    monkeypatch.setattr(C._Encoder, "put", lambda self, *a: (calls.append(1), put(self, *a))[1])
    back(np.random.default_rng(8).integers(0, 3000, 1000), 100)
    assert len(calls) == 100
