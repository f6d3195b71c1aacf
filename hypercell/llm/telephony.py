"""Media columns of telephony audio: mu-law, A-law and IMA ADPCM in WAV, decoded and stored as resampled PCM."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from hypercell.llm.common import chunks, id_text, lean, ship

# Fixed values of the formats (WAVE format tags; IMA ADPCM step sizes and index changes).
PCM, ALAW, MULAW, IMA_ADPCM = 1, 6, 7, 17
STEPS = np.array([
    7, 8, 9, 10, 11, 12, 13, 14, 16, 17, 19, 21, 23, 25, 28, 31, 34, 37, 41, 45, 50, 55, 60, 66, 73, 80, 88, 97, 107, 118,
    130, 143, 157, 173, 190, 209, 230, 253, 279, 307, 337, 371, 408, 449, 494, 544, 598, 658, 724, 796, 876, 963, 1060, 1166,
    1282, 1411, 1552, 1707, 1878, 2066, 2272, 2499, 2749, 3024, 3327, 3660, 4026, 4428, 4871, 5358, 5894, 6484, 7132, 7845,
    8630, 9493, 10442, 11487, 12635, 13899, 15289, 16818, 18500, 20350, 22385, 24623, 27086, 29794, 32767,
], np.int32)
TURN = np.array([-1, -1, -1, -1, 2, 4, 6, 8], np.int32)

#: Bytes of an ADPCM block, and what payloads are padded to a multiple of.
BLOCK = 576
#: Samples a second, as stored and as resampled.
RATE, PCM_RATE = 8000, 16000
CODECS = ("mulaw", "alaw", "ima_adpcm")
_TAG = {"mulaw": MULAW, "alaw": ALAW, "ima_adpcm": IMA_ADPCM}


def _mulaw_table() -> np.ndarray:
    c = ~np.arange(256, dtype=np.int32) & 0xFF
    size = (((c & 0x0F) << 3) + 0x84 << ((c >> 4) & 7)) - 0x84
    return np.where(c & 0x80, -size, size).astype(np.int16)


def _alaw_table() -> np.ndarray:
    c = np.arange(256, dtype=np.int32) ^ 0x55
    part = (c >> 4) & 7
    size = ((c & 0x0F) << 4) + 8
    size = np.where(part > 0, (size + 0x100) << np.maximum(part - 1, 0), size)
    return np.where(c & 0x80, size, -size).astype(np.int16)


MULAW_TABLE, ALAW_TABLE = _mulaw_table(), _alaw_table()

# What a 4-bit code adds at each step size, and the step index that follows: tables by (index, code).
_CODE = np.arange(16)
_DIFF = (STEPS[:, None] >> 3) + sum(np.where(_CODE & bit, STEPS[:, None] >> shift, 0) for bit, shift in ((4, 0), (2, 1), (1, 2)))
_DIFF = np.where(_CODE & 8, -_DIFF, _DIFF).astype(np.int32).ravel()
_NEXT = (np.clip(np.arange(len(STEPS))[:, None] + TURN[_CODE & 7], 0, len(STEPS) - 1) * 16).astype(np.int32).ravel()


def decode_adpcm(blocks: np.ndarray) -> np.ndarray:
    """Samples of mono IMA ADPCM blocks, decoded side by side. ``blocks``: (blocks, bytes); result: (blocks, samples)."""
    n, size = blocks.shape
    out = np.empty(((size - 4) * 2 + 1, n), np.int16)
    head = np.ascontiguousarray(blocks[:, :4])
    value = head[:, :2].copy().view("<i2").ravel().astype(np.int32)
    at = np.minimum(head[:, 2], len(STEPS) - 1).astype(np.int32) * 16
    out[0] = value
    codes = np.ascontiguousarray(blocks[:, 4:].T)
    for k in range(size - 4):
        byte = codes[k].astype(np.int32)
        for half, code in enumerate((byte & 15, byte >> 4)):
            at += code
            value += _DIFF[at]
            np.clip(value, -32768, 32767, out=value)
            at = _NEXT[at]
            out[2 * k + 1 + half] = value
    return out.T


def wav(data: bytes, codec: str, rate: int = RATE) -> bytes:
    """A mono WAV file around samples of a telephony codec, as they are."""
    if codec == "ima_adpcm":
        per = (BLOCK - 4) * 2 + 1
        fmt = struct.pack("<HHIIHHHH", IMA_ADPCM, 1, rate, rate * BLOCK // per, BLOCK, 4, 2, per)
        n = len(data) // BLOCK * per
    else:
        fmt = struct.pack("<HHIIHHH", _TAG[codec], 1, rate, rate, 1, 8, 0)
        n = len(data)
    body = b"WAVEfmt " + struct.pack("<I", len(fmt)) + fmt + b"fact" + struct.pack("<II", 4, n) + b"data" + struct.pack("<I", len(data)) + data + b"\0" * (len(data) % 2)
    return b"RIFF" + struct.pack("<I", len(body)) + body


def wav_pcm(samples: np.ndarray, rate: int = PCM_RATE) -> bytes:
    """A mono 16-bit PCM WAV file."""
    data = samples.astype("<i2").tobytes()
    fmt = struct.pack("<HHIIHH", PCM, 1, rate, rate * 2, 2, 16)
    body = b"WAVEfmt " + struct.pack("<I", len(fmt)) + fmt + b"data" + struct.pack("<I", len(data)) + data
    return b"RIFF" + struct.pack("<I", len(body)) + body


def parse(media: bytes) -> tuple[str, int, bytes, int]:
    """Codec, rate, sample bytes and block size of a mono telephony WAV file."""
    if media[:4] != b"RIFF" or media[8:12] != b"WAVE":
        raise ValueError("not a WAVE file")
    at, fmt, data = 12, b"", b""
    while at + 8 <= len(media):
        kind, n = media[at : at + 4], struct.unpack_from("<I", media, at + 4)[0]
        if kind == b"fmt ":
            fmt = media[at + 8 : at + 8 + n]
        elif kind == b"data":
            data = media[at + 8 : at + 8 + n]
            if len(data) != n:
                raise ValueError("truncated samples")
        at += 8 + n + n % 2
    tag, channels, rate, _, block = struct.unpack_from("<HHIIH", fmt)
    names = {v: k for k, v in _TAG.items()}
    if channels != 1 or tag not in names:
        raise ValueError(f"unsupported: format {tag}, {channels} channels")
    return names[tag], rate, data, block


def samples(codec: str, data: list[bytes], block: int = BLOCK) -> list[np.ndarray]:
    """16-bit samples of each payload of one codec; ADPCM blocks of all payloads are decoded together."""
    if codec != "ima_adpcm":
        table = MULAW_TABLE if codec == "mulaw" else ALAW_TABLE
        return [table[np.frombuffer(d, np.uint8)] for d in data]
    counts = [len(d) // block for d in data]
    flat = decode_adpcm(np.frombuffer(b"".join(d[: c * block] for d, c in zip(data, counts, strict=True)), np.uint8).reshape(-1, block)) if sum(counts) else np.empty((0, 1), np.int16)
    ends = np.cumsum(counts)
    return [np.ascontiguousarray(flat[e - c : e]).ravel() for e, c in zip(ends, counts, strict=True)]


def resample(x: np.ndarray, rate: int, to: int = PCM_RATE) -> np.ndarray:
    """Linear interpolation in whole numbers, so that the result is the same everywhere."""
    if rate == to or not len(x):
        return x
    if to == 2 * rate:
        wide = x.astype(np.int32)
        out = np.empty(2 * len(x), np.int16)
        out[::2] = x
        out[1:-1:2] = (wide[:-1] + wide[1:]) >> 1
        out[-1] = x[-1]
        return out
    at = np.arange(len(x) * to // rate, dtype=np.int64) * rate
    i, part = at // to, at % to
    wide = x.astype(np.int64)
    return (wide[i] + (wide[np.minimum(i + 1, len(x) - 1)] - wide[i]) * part // to).astype(np.int16)


def feature(codec: str, x: np.ndarray) -> str:
    """Codec, sample count, mean size, peak and sign changes."""
    size = np.abs(x.astype(np.int32))
    n = len(x)
    return f"{codec}:{n}:{int(size.sum()) // n if n else 0}:{int(size.max()) if n else 0}:{int(np.count_nonzero((x[1:] < 0) != (x[:-1] < 0)))}"


def pad(data: bytes, block: int = BLOCK, fill: bytes = b"\xff") -> bytes:
    return data + fill * (block - len(data) if len(data) < block else -len(data) % block)


def store(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", codec: str | None = None) -> DataFrame:
    """One row per input row: ``id_col``, ``n_bytes`` and ``media``, a WAV file whose samples are the text's UTF-8 bytes,
    padded with bytes 255 to a positive multiple of 576.

    Without ``codec`` the payload's CRC-32 chooses one, so that equal texts are stored alike. A null text counts as empty;
    null ids and repeated rows stay; other columns are left out.
    """
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, 1, 2 << 20):
                n, media = [], []
                for text in part.column(1).to_pylist():
                    data = text.encode()
                    n.append(len(data))
                    data = pad(data)
                    media.append(wav(data, codec or CODECS[zlib.crc32(data) % len(CODECS)]))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n, pa.int64()), pa.array(media, pa.binary())], ["id", "n_bytes", "media"])

    return id_text(df, id_col, text_col).mapInArrow(lean(run), "id long, n_bytes long, media binary").withColumnRenamed("id", id_col)


def load(df: DataFrame, media_col: str = "media", rate: int = PCM_RATE) -> DataFrame:
    """The input's columns and, read from the WAV file in ``media_col``: ``payload`` (its sample bytes), ``pcm`` (a 16-bit
    PCM WAV file of ``rate`` samples a second) and ``feature``; they replace columns of those names. Null media give nulls; a file
    that is not mono mu-law, A-law or IMA ADPCM raises an error.
    """
    ship(df.sparkSession)
    new = ("payload", "pcm", "feature")
    src = df.drop(*new)
    place = src.columns.index(media_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, place, 2 << 20):
                files = [None if m is None else parse(m) for m in part.column(place).to_pylist()]
                pcm: list[bytes | None] = [None] * len(files)
                said: list[str | None] = [None] * len(files)
                kinds: dict[tuple[str, int], list[int]] = {}
                for i, f in enumerate(files):
                    if f is not None:
                        kinds.setdefault((f[0], f[3]), []).append(i)
                for (codec, block), rows in kinds.items():
                    for i, x in zip(rows, samples(codec, [files[i][2] for i in rows], block), strict=True):
                        y = resample(x, files[i][1], rate)
                        pcm[i], said[i] = wav_pcm(y, rate), feature(codec, y)
                out = [pa.array([None if f is None else f[2] for f in files], pa.binary()), pa.array(pcm, pa.binary()), pa.array(said, pa.string())]
                yield pa.RecordBatch.from_arrays([*part.columns, *out], [*part.schema.names, *new])

    added = [T.StructField("payload", T.BinaryType()), T.StructField("pcm", T.BinaryType()), T.StructField("feature", T.StringType())]
    return src.mapInArrow(lean(run), T.StructType([*src.schema.fields, *added]))
