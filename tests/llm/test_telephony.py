import hashlib
import zlib

import numpy as np
import pytest

from hypercell.llm import telephony as A


def scalar_mulaw(c):
    c = ~c & 0xFF
    x = ((c & 15) << 3) + 132 << (c >> 4 & 7)
    return 132 - x if c & 128 else x - 132


def scalar_alaw(c):
    c ^= 0x55
    e, m = c >> 4 & 7, c & 15
    x = (m << 4) + 8 if e == 0 else ((m << 4) + 0x108) << (e - 1)
    return x if c & 128 else -x


def scalar_adpcm(block):
    value = int.from_bytes(block[:2], "little", signed=True)
    at = min(block[2], 88)
    out = [value]
    for b in block[4:]:
        for code in (b & 15, b >> 4):
            step = int(A.STEPS[at])
            d = (step >> 3) + (step if code & 4 else 0) + (step >> 1 if code & 2 else 0) + (step >> 2 if code & 1 else 0)
            value = max(-32768, min(32767, value - d if code & 8 else value + d))
            at = max(0, min(88, at + [-1, -1, -1, -1, 2, 4, 6, 8][code & 7]))
            out.append(value)
    return out


def test_tables():
    assert A.MULAW_TABLE.tolist() == [scalar_mulaw(c) for c in range(256)]
    assert A.ALAW_TABLE.tolist() == [scalar_alaw(c) for c in range(256)]
    assert (A.MULAW_TABLE[0], A.MULAW_TABLE[0x80], A.MULAW_TABLE[0xFF]) == (-32124, 32124, 0)
    assert (A.ALAW_TABLE[0x55], A.ALAW_TABLE[0xD5], A.ALAW_TABLE[0xAA]) == (-8, 8, 32256)


def test_adpcm_blocks_side_by_side():
    blocks = np.random.default_rng(3).integers(0, 256, (40, 96), dtype=np.uint8)
    assert A.decode_adpcm(blocks).tolist() == [scalar_adpcm(bytes(b)) for b in blocks]


@pytest.mark.parametrize("codec", A.CODECS)
def test_files_read_back(codec):
    data = A.pad(bytes(range(256)) * 5)
    assert A.parse(A.wav(data, codec))[:3] == (codec, A.RATE, data)
    with pytest.raises(ValueError):
        A.parse(A.wav(data, codec)[:-100])
    with pytest.raises(ValueError):
        A.parse(A.wav_pcm(np.zeros(3, np.int16)))


def test_resampling():
    x = np.array([0, 10, 20, -20], np.int16)
    assert A.resample(x, 8000, 16000).tolist() == [0, 5, 10, 15, 20, 0, -20, -20]
    assert A.resample(x, 8000, 8000).tolist() == x.tolist()
    assert A.resample(x, 16000, 8000).tolist() == [0, 20]
    assert A.resample(x[:0], 8000).tolist() == []
    assert len(A.resample(x, 8000, 11025)) == 5


def test_padding():
    assert (len(A.pad(b"")), len(A.pad(b"x" * 576)), len(A.pad(b"x" * 577))) == (576, 576, 1152)
    assert A.pad(b"x")[1:] == b"\xff" * 575


def test_odd_rows(spark, odd, none):
    got = A.load(A.store(odd)).collect()
    want = sorted((hashlib.sha256(A.pad((r["text"] or "").encode())).hexdigest() for r in odd.collect()))
    assert sorted(hashlib.sha256(r["payload"]).hexdigest() for r in got) == want
    for r in got:
        codec, rate, data, block = A.parse(bytes(r["media"]))
        x = A.resample(A.samples(codec, [data], block)[0], rate)
        assert bytes(r["pcm"]) == A.wav_pcm(x) and r["feature"] == A.feature(codec, x)
    assert A.load(A.store(none)).collect() == []
    media = A.store(odd, codec="alaw").selectExpr("doc_id", "media", "'x' AS payload", "1 AS extra").unionByName(spark.sql("SELECT 99L AS doc_id, cast(null AS binary) AS media, 'x' AS payload, 1 AS extra"))
    again = A.load(media)
    assert again.columns == ["doc_id", "media", "extra", "payload", "pcm", "feature"]
    assert again.where("doc_id = 99").first()["pcm"] is None


def test_query(spark):
    from hypercell.llm import queries

    docs = {r["doc_id"]: A.pad((r["text"] or "").encode()) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    got = queries.op10_telephony(spark, "/root/testdata/sf0.001").collect()
    assert len(got) == len(docs)
    for r in got:
        data = docs[r["doc_id"]]
        assert (r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(data), hashlib.sha256(data).hexdigest(), zlib.crc32(data[-32:]))
        assert r["n_bytes"] <= r["payload_bytes"] and r["media_bytes"] > r["payload_bytes"]
