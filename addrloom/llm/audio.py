"""Media columns for telephony audio: mu-law WAV storage, companding tables, ADPCM blocks, resampled PCM."""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import bound_batches, by_bytes, sums, utf8

#: Bytes that a payload is padded to a multiple of, which is also the length of an ADPCM block; and what it is padded with.
BLOCK, PAD = 192, 32
RATE = 8000
#: Samples that are computed at once, whole blocks; longer recordings go slice by slice.
SLICE = BLOCK << 12
#: File format of the media and PCM columns: small row groups, since a cell can be large, and no dictionary for what hardly repeats.
LAYOUT = {"compression": "zstd", "parquet__compression__codec__zstd__level": "11", "parquet__page__size": str(4 << 20), "parquet__enable__dictionary": "false", "parquet__block__size": str(16 << 20)}

# Fixed values of the IMA ADPCM format: step sizes follow its published table, index changes by nibble.
# fmt: off
IMA_STEPS = np.array([
    7, 8, 9, 10, 11, 12, 13, 14, 16, 17, 19, 21, 23, 25, 28, 31, 34, 37, 41, 45, 50, 55, 60, 66, 73, 80, 88, 97, 107, 118,
    130, 143, 157, 173, 190, 209, 230, 253, 279, 307, 337, 371, 408, 449, 494, 544, 598, 658, 724, 796, 876, 963, 1060,
    1166, 1282, 1411, 1552, 1707, 1878, 2066, 2272, 2499, 2749, 3024, 3327, 3660, 4026, 4428, 4871, 5358, 5894, 6484, 7132,
    7845, 8630, 9493, 10442, 11487, 12635, 13899, 15289, 16818, 18500, 20350, 22385, 24623, 27086, 29794, 32767,
], np.int32)
IMA_INDEX = np.array([-1, -1, -1, -1, 2, 4, 6, 8], np.int32)
# fmt: on


def mu_law_table() -> np.ndarray:
    """G.711 mu-law: 256 codes to 16-bit samples."""
    u = ~np.arange(256) & 0xFF
    size = (((u & 0x0F) << 3) + 0x84 << (u >> 4 & 7)) - 0x84
    return np.where(u & 0x80, -size, size).astype(np.int16)


def a_law_table() -> np.ndarray:
    """G.711 A-law: 256 codes to 16-bit samples."""
    a = np.arange(256) ^ 0x55
    step, low = a >> 4 & 7, (a & 0x0F) << 4
    size = np.where(step == 0, low + 8, low + 0x108 << np.maximum(step - 1, 0))
    return np.where(a & 0x80, size, -size).astype(np.int16)


#: What follows a nibble's three magnitude bits at each step: one table, (step index, nibble) to difference and to the next index.
_DIFF = np.stack([np.where(n & 8, -1, 1) * ((IMA_STEPS >> 3) + (IMA_STEPS * (n >> 2 & 1)) + (IMA_STEPS >> 1) * (n >> 1 & 1) + (IMA_STEPS >> 2) * (n & 1)) for n in range(16)], 1).astype(np.int32).ravel()
_NEXT = np.stack([np.clip(np.arange(89) + IMA_INDEX[n & 7], 0, 88) for n in range(16)], 1).astype(np.int32).ravel() * 16
MU_LAW, A_LAW = mu_law_table(), a_law_table()


def decode_adpcm(blocks: np.ndarray) -> np.ndarray:
    """IMA ADPCM blocks (n, length) of bytes to 16-bit samples (n, 1 + 2 * (length - 4)), all blocks at once.

    A block begins with its first sample (little-endian), its step index (kept within 0 to 88)
    and a reserved byte; each further byte holds two samples, the low half first.
    """
    n, length = blocks.shape
    out = np.empty((1 + 2 * (length - 4), n), np.int16)
    now = (blocks[:, 0].astype(np.int32) | blocks[:, 1].astype(np.int32) << 8).astype(np.int16).astype(np.int32)
    state = np.minimum(blocks[:, 2], 88).astype(np.int32) * 16
    out[0] = now
    turned = np.ascontiguousarray(blocks[:, 4:].T)
    for k in range(length - 4):
        for half, nibble in enumerate((turned[k] & 15, turned[k] >> 4)):
            at = state + nibble
            now += _DIFF[at]
            np.clip(now, -32768, 32767, out=now)
            state = _NEXT[at]
            out[1 + 2 * k + half] = now
    return out.T


def following(pcm: np.ndarray, begin: int, end: int, last: int) -> np.ndarray:
    """For each sample from begin to end the next one of its recording, whose last sample, at last - 1, is held."""
    return np.append(pcm[begin + 1 : end], pcm[min(end, last - 1)])


def between(even: np.ndarray, after: np.ndarray) -> np.ndarray:
    """The samples at twice the rate that lie between even ones and those after them, by linear interpolation."""
    return (even.astype(np.int32) + after >> 1).astype(np.int16)


def doubled(even: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Twice the sampling rate by linear interpolation."""
    out = np.empty(2 * len(even), np.int16)
    out[0::2] = even
    out[1::2] = between(even, after)
    return out


def pack_pcm(pcm: np.ndarray) -> bytes:
    """Lossless storage of 16-bit samples at twice the rate: every other sample, then of those between the difference (modulo 2^16) to their neighbours' mean, which is what compresses well."""
    out = np.empty((2, len(pcm) // 2), "<i2")
    pack_into(out, 0, pcm, pcm[-2:-1])
    return out.tobytes()


def pack_into(out: np.ndarray, at: int, pcm: np.ndarray, after_last: np.ndarray) -> None:
    """Puts a part of a recording, which begins at its even sample `at`, into its storage (2, even samples); after_last: the even sample that comes next."""
    even, odd = pcm[0::2], pcm[1::2]
    out[0, at : at + len(even)] = even
    out[1, at : at + len(even)] = odd - between(even, np.append(even[1:], after_last))


def unpack_parts(stored: bytes | memoryview) -> Iterator[np.ndarray]:
    """The samples that `pack_pcm` was given, slice by slice."""
    even, rest = np.frombuffer(stored, "<i2").reshape(2, -1)
    for a in range(0, len(even), SLICE):
        z = min(a + SLICE, len(even))
        out = doubled(even[a:z], following(even, a, z, len(even)))
        out[1::2] += rest[a:z]
        yield out


def unpack_pcm(stored: bytes) -> np.ndarray:
    """The samples that `pack_pcm` was given."""
    return np.concatenate([np.zeros(0, np.int16), *unpack_parts(stored)])


def wav(text: bytes | memoryview, n_bytes: int) -> bytes:
    """Mu-law WAV of a text's bytes, padded: fmt (tag 7), fact, a chunk `ulen` with the unpadded length, data."""
    pad = max(BLOCK, -(-len(text) // BLOCK) * BLOCK) - len(text)
    size = len(text) + pad
    head = b"WAVE" + b"fmt " + struct.pack("<IHHIIHHH", 18, 7, 1, RATE, RATE, 1, 8, 0) + b"fact" + struct.pack("<II", 4, size) + b"ulen" + struct.pack("<IQ", 8, n_bytes) + b"data" + struct.pack("<I", size)
    return b"".join([b"RIFF", struct.pack("<I", len(head) + size), head, text, bytes([PAD]) * pad])


def read_wav(media: bytes | memoryview) -> tuple[memoryview, int]:
    """Samples and unpadded length, found by walking the chunks."""
    view, at, n, data = memoryview(media), 12, 0, memoryview(b"")
    while at + 8 <= len(media):
        kind, size = media[at : at + 4], struct.unpack_from("<I", media, at + 4)[0]
        if kind == b"ulen":
            n = struct.unpack_from("<Q", media, at + 8)[0]
        elif kind == b"data":
            data = view[at + 8 : at + 8 + size]
        at += 8 + size + (size & 1)
    return data, n


def store_telephony(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and media: every whole text's UTF-8 bytes as 8-bit mu-law samples of a WAV file.

    Padded with spaces to a positive multiple of 192, so an empty or null text is one block. No shuffle. Rows
    without an id, or that repeat one, are rows like any other, and further columns aren't read; no rows give none.
    """
    bound_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in by_bytes(whole, "text", 1 << 20):
                off, data = utf8(b.column("text"))
                raw, at = memoryview(np.ascontiguousarray(data)), off.tolist()
                made = [wav(raw[begin:end], end - begin) for begin, end in zip(at, at[1:], strict=False)]
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(made, pa.binary())], ["doc_id", "media"])

    return docs.selectExpr(f"cast(`{id_col}` as long) doc_id", f"`{text_col}` text").mapInArrow(run, "doc_id long, media binary")


def views(col: pa.Array) -> list[memoryview | None]:
    """The cells of a binary column, not copied."""
    return [memoryview(x.as_buffer()).cast("B") if x.is_valid else None for x in col]


def cells(data: np.ndarray, off: np.ndarray, null: np.ndarray) -> pa.Array:
    """A binary column of data's bytes between successive offsets, not copied."""
    valid = pa.py_buffer(np.packbits(~null, bitorder="little"))
    return pa.BinaryArray.from_buffers(pa.binary(), len(null), [valid, pa.py_buffer(off.astype(np.int32)), pa.py_buffer(data)], int(null.sum()))


FEATURES = {"doc_id": "long", "n_bytes": "long", "payload_bytes": "long", "payload_sha256": "string", "tail_crc32": "long", "media_bytes": "long", "media_sha256": "string", "feature": "string"}
_ARROW = {"long": pa.int64(), "string": pa.string()}


def features_of(b: pa.RecordBatch, keep_pcm: bool) -> pa.RecordBatch:
    """What `telephony_features` returns for a batch. Samples are computed SLICE at a time, so beside the batch and the PCM to store memory doesn't grow with a recording."""
    made = views(b.column("media"))
    null = np.array([m is None for m in made], bool)
    read = [read_wav(m) if m is not None else (memoryview(bytes(BLOCK)), 0) for m in made]
    size = np.array([len(x) for x, _ in read], np.int64)
    off = np.concatenate([[0], np.cumsum(size)])
    flat = np.frombuffer(read[0][0] if len(read) == 1 else b"".join(x for x, _ in read), np.uint8)
    power, crc = np.zeros((4, len(read)), np.int64), [0] * len(read)
    # A recording's PCM takes four bytes for each of its samples; none is kept of what is null.
    place = np.concatenate([[0], np.cumsum(np.where(null, 0, 4 * size))])
    pcm_bytes = np.empty(place[-1] if keep_pcm else 0, np.uint8)
    for a in range(0, len(flat), SLICE):
        z = min(a + SLICE, len(flat))
        inside = np.clip(off, a, z) - a
        codes = flat[a : z + 1]  # with the sample that comes next, if any
        mu, al, ad = MU_LAW[codes], A_LAW[codes[: z - a]], decode_adpcm(codes[: z - a].reshape(-1, BLOCK))
        turn = np.zeros(z - a, np.int8)
        before = MU_LAW[flat[a - 1]] if a else 0
        turn[:] = (mu[: z - a] < 0) != (np.append(before, mu[: z - a - 1]) < 0)
        turn[off[(off >= a) & (off < z)] - a] = 0
        power += np.stack([sums(np.square(mu[: z - a], dtype=np.int64), inside), sums(np.square(al, dtype=np.int64), inside), sums(np.square(ad, dtype=np.int64).sum(1), inside // BLOCK), sums(turn, inside)])
        for k in range(np.searchsorted(off, a, "right") - 1, np.searchsorted(off, z)):
            begin, end = inside[k], inside[k + 1]
            after = following(mu, begin, end, off[k + 1] - a)
            pcm = doubled(mu[begin:end], after)
            crc[k] = zlib.crc32(pcm.data, crc[k])
            if keep_pcm and not null[k]:
                pack_into(pcm_bytes[place[k] : place[k + 1]].view("<i2").reshape(2, -1), a + begin - off[k], pcm, after[-1:])
    rows: list[list] = []
    for k, (m, (data, n)) in enumerate(zip(made, read, strict=True)):
        if m is None:
            rows.append([None] * (len(FEATURES) - 1))
            continue
        e = [(power[j, k] / s) ** 0.5 for j, s in enumerate((size[k], size[k], size[k] // BLOCK * (1 + 2 * (BLOCK - 4))))]
        feature = f"mu_rms={e[0]:.3f};a_rms={e[1]:.3f};adpcm_rms={e[2]:.3f};crossings={power[3, k]};pcm_crc={crc[k]:08x}"
        rows.append([n, len(data), hashlib.sha256(data).hexdigest(), zlib.crc32(data[-16:]), len(m), hashlib.sha256(m).hexdigest(), feature])
    columns = [b.column("doc_id"), *(pa.array([r[j] for r in rows], _ARROW[t]) for j, t in enumerate([*FEATURES.values()][1:]))]
    return pa.RecordBatch.from_arrays([*columns, cells(pcm_bytes, place, null)] if keep_pcm else columns, [*FEATURES, *["pcm"] * keep_pcm])


def telephony_features(media: DataFrame, keep_pcm: bool = False) -> DataFrame:
    """Reads doc_id and media back: payload digests and a feature string; with keep_pcm also `pcm`, 16-bit samples at 16 kHz as `pack_pcm` stores them.

    feature: energies of the payload as mu-law, as A-law and as IMA ADPCM blocks of 192 bytes,
    zero crossings, and the CRC of the resampled PCM; all sums are whole numbers, so equal
    payloads have equal features whatever they are batched with. A null media is null in all
    columns. The stored PCM of a recording is one cell of four bytes a sample.
    """
    bound_batches(media.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in by_bytes(whole, "media", 1 << 20):
                yield features_of(b, keep_pcm)

    return media.select("doc_id", "media").mapInArrow(run, ", ".join(f"{k} {t}" for k, t in FEATURES.items()) + ", pcm binary" * keep_pcm)


def pcm_digests(col: pa.Array) -> tuple[pa.Array, pa.Array]:
    """Bytes and CRC of the samples that stored PCM holds; null where it is."""
    size, crc = [], []
    for x in views(col):
        size.append(None if x is None else len(x))
        n = 0
        for part in unpack_parts(x) if x is not None else ():
            n = zlib.crc32(part.data, n)
        crc.append(None if x is None else n)
    return pa.array(size, pa.int64()), pa.array(crc, pa.int64())


def read_features(written: DataFrame) -> DataFrame:
    """The digest columns of stored features, with pcm_bytes and pcm_crc32 of the samples that the stored PCM holds (null where the media is)."""
    bound_batches(written.sparkSession)
    own = [c for c in written.columns if c != "pcm"]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in written.schema.fields if f.name != "pcm") + ", pcm_bytes long, pcm_crc32 long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in own), *pcm_digests(b.column("pcm"))], [*own, "pcm_bytes", "pcm_crc32"])

    return written.mapInArrow(run, schema)
