"""Telephony audio columns: mu-law, A-law and IMA ADPCM decoding, resampling, WAV storage.

G.711 bytes are expanded by 256-entry lookup tables, which are built from the companding
rule. IMA ADPCM is decoded with numpy across blocks: the nibbles of a block depend on each
other, so step t of every block of a batch is computed at once. All features are integers,
so a result doesn't depend on how rows were batched.

Edge cases: null and empty texts give one padding unit of 576 bytes of 255; equal texts
give equal results; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .textkit import groups, small_batches, table, utf8_list

UNIT = 576
RATE = 8000
FORMAT_PCM, FORMAT_ALAW, FORMAT_MULAW = 1, 6, 7

# The IMA ADPCM index adjustments by nibble and the 89 step sizes.
ADPCM_INDEX = np.array([-1, -1, -1, -1, 2, 4, 6, 8, -1, -1, -1, -1, 2, 4, 6, 8], dtype=np.int64)
ADPCM_STEP = np.array([
    7, 8, 9, 10, 11, 12, 13, 14, 16, 17, 19, 21, 23, 25, 28, 31, 34, 37, 41, 45, 50, 55, 60, 66, 73, 80, 88, 97, 107, 118,
    130, 143, 157, 173, 190, 209, 230, 253, 279, 307, 337, 371, 408, 449, 494, 544, 598, 658, 724, 796, 876, 963, 1060, 1166,
    1282, 1411, 1552, 1707, 1878, 2066, 2272, 2499, 2749, 3024, 3327, 3660, 4026, 4428, 4871, 5358, 5894, 6484, 7132, 7845,
    8630, 9493, 10442, 11487, 12635, 13899, 15289, 16818, 18500, 20350, 22385, 24623, 27086, 29794, 32767,
], dtype=np.int64)


def _mulaw() -> np.ndarray:
    x = ~np.arange(256) & 0xFF
    magnitude = ((((x & 15) << 3) + 132) << ((x >> 4) & 7)) - 132
    return np.where(x & 128, -magnitude, magnitude).astype(np.int16)


def _alaw() -> np.ndarray:
    x = np.arange(256) ^ 0x55
    exponent, low = (x >> 4) & 7, (x & 15) << 4
    magnitude = np.where(exponent == 0, low + 8, (low + 264) << np.maximum(exponent - 1, 0))
    return np.where(x & 128, magnitude, -magnitude).astype(np.int16)


MULAW, ALAW = _mulaw(), _alaw()


def decode_adpcm(blocks: np.ndarray) -> np.ndarray:
    """Samples (n, 1 + 2 * (width - 4)) of mono IMA ADPCM blocks (n, width), all at once.

    A block begins with its first sample (little-endian int16) and its step index; an index
    above 88 counts as 88.
    """
    n, width = blocks.shape
    value = blocks[:, :2].copy().view("<i2")[:, 0].astype(np.int64)
    index = np.minimum(blocks[:, 2].astype(np.int64), 88)
    out = np.empty((1 + 2 * (width - 4), n), dtype=np.int16)
    out[0] = value
    data = np.ascontiguousarray(blocks[:, 4:].T)
    for t in range(2 * (width - 4)):
        nibble = (data[t >> 1] >> (4 * (t & 1))) & 15
        step = ADPCM_STEP[index]
        delta = step >> 3
        delta = delta + np.where(nibble & 4, step, 0) + np.where(nibble & 2, step >> 1, 0) + np.where(nibble & 1, step >> 2, 0)
        value = np.clip(np.where(nibble & 8, value - delta, value + delta), -32768, 32767)
        index = np.clip(index + ADPCM_INDEX[nibble], 0, 88)
        out[t + 1] = value
    return out.T


def resample_double(pcm: np.ndarray) -> np.ndarray:
    """Twice the rate by linear interpolation, in integers."""
    wide = pcm.astype(np.int32)
    following = np.append(wide[1:], wide[-1:])
    return np.stack([wide, (wide + following) >> 1], axis=1).reshape(-1).astype("<i2")


def write_wav(data: bytes, format_tag: int, rate: int, bits: int) -> bytes:
    """A mono RIFF/WAVE file."""
    unit = bits // 8
    fmt = struct.pack("<HHIIHHH", format_tag, 1, rate, rate * unit, unit, bits, 0)
    fact = struct.pack("<I", len(data) // unit)
    body = b"WAVE" + b"".join(tag + struct.pack("<I", len(x)) + x + b"\0" * (len(x) & 1) for tag, x in ((b"fmt ", fmt), (b"fact", fact), (b"data", data)))
    return b"RIFF" + struct.pack("<I", len(body)) + body


def read_wav(wav: bytes) -> tuple[int, int, bytes]:
    """Format tag, rate and the data chunk of a mono WAV file."""
    if wav[:4] != b"RIFF" or wav[8:12] != b"WAVE":
        raise ValueError("not a WAV file")
    at, tag, rate = 12, 0, 0
    while at + 8 <= len(wav):
        kind, (size,) = wav[at : at + 4], struct.unpack_from("<I", wav, at + 4)
        if kind == b"fmt ":
            tag, _, rate = struct.unpack_from("<HHI", wav, at + 8)
        elif kind == b"data":
            return tag, rate, wav[at + 8 : at + 8 + size]
        at += 8 + size + (size & 1)
    raise ValueError("no data chunk")


def expand(wav: bytes) -> tuple[int, np.ndarray]:
    """Rate and 16-bit samples of a stored G.711 or PCM file."""
    tag, rate, data = read_wav(wav)
    raw = np.frombuffer(data, dtype=np.uint8)
    if tag == FORMAT_MULAW:
        return rate, MULAW[raw]
    if tag == FORMAT_ALAW:
        return rate, ALAW[raw]
    return rate, np.frombuffer(data, dtype="<i2")


def payload_of(text: bytes) -> bytes:
    """The text and bytes 255 up to a positive multiple of UNIT."""
    return text + b"\xff" * (-len(text) % UNIT if text else UNIT)


def stored_pcm(wav: bytes) -> bytes:
    """The stored file expanded, resampled to twice its rate, as a 16-bit PCM WAV file."""
    rate, pcm = expand(wav)
    return write_wav(resample_double(pcm).tobytes(), FORMAT_PCM, 2 * rate, 16)


def _level(pcm: np.ndarray) -> tuple[int, int, int]:
    """Sum of squares, peak and sign changes."""
    wide = pcm.astype(np.int64)
    return int(wide @ wide), int(np.abs(wide).max()), int(np.count_nonzero(np.diff(wide < 0)))


def describe(texts: list[bytes]) -> Iterator[tuple]:
    """For each text: n_bytes, payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, feature."""
    for begin, end in groups(texts):
        files = [write_wav(payload_of(t), FORMAT_MULAW, RATE, 8) for t in texts[begin:end]]
        payloads = [read_wav(f)[2] for f in files]
        blocks = np.frombuffer(b"".join(payloads), dtype=np.uint8).reshape(-1, UNIT)
        adpcm = decode_adpcm(blocks)
        at = 0
        for text, wav, payload in zip(texts[begin:end], files, payloads, strict=True):
            n = len(payload) // UNIT
            _, pcm = expand(wav)
            energy, peak, crossings = _level(pcm)
            other, _, _ = _level(ALAW[np.frombuffer(payload, dtype=np.uint8)])
            decoded = adpcm[at : at + n].reshape(-1)
            at += n
            energy_adpcm, peak_adpcm, _ = _level(decoded)
            feature = f"ulaw:{energy}:{peak}:{crossings};alaw:{other};adpcm:{energy_adpcm}:{peak_adpcm};pcm16k:{zlib.crc32(stored_pcm(wav)):08x}"
            yield (
                len(text), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]),
                len(wav), hashlib.sha256(wav).hexdigest(), feature,
            )


_FIELDS = [("n_bytes", pa.int64()), ("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("tail_crc32", pa.int64()), ("media_bytes", pa.int64()), ("media_sha256", pa.string()), ("feature", pa.string())]
_SCHEMA = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def media_digests(docs: DataFrame) -> DataFrame:
    """One row for each document: its text stored as a mu-law file, read back and described."""
    small_batches(docs.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = list(describe(utf8_list(batch.column(1))))
            columns = list(zip(*rows, strict=True)) if rows else [[] for _ in _FIELDS]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, type=t) for c, (_, t) in zip(columns, _FIELDS, strict=True))],
                names=["doc_id", *(n for n, _ in _FIELDS)],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, _SCHEMA)


def encode_audio(docs: DataFrame) -> DataFrame:
    """The files themselves: doc_id, ulaw_wav (8-bit mu-law) and pcm_wav (16-bit, resampled)."""
    small_batches(docs.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            files = [write_wav(payload_of(t), FORMAT_MULAW, RATE, 8) for t in utf8_list(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(files, pa.binary()), pa.array([stored_pcm(f) for f in files], pa.binary())], names=["doc_id", "ulaw_wav", "pcm_wav"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, ulaw_wav binary, pcm_wav binary")


def op4_telephony_audio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media_digests(table(spark, sf_dir, "documents"))
