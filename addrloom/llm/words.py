"""Words of many texts at once, as spans of their bytes; and byte strings as exact pairs of numbers, or as 64-bit keys."""

from __future__ import annotations

import hashlib

import numpy as np

_RANDOM = np.random.Generator(np.random.PCG64(17)).integers(1, 1 << 63, 4, np.uint64) | np.uint64(1)
_MIX, _LAST, _HIGH, _LONG = _RANDOM
#: Bytes that `packed` holds exactly, and the masks that keep the first k of eight bytes.
EXACT = 15
_MASK = np.array([(1 << 8 * k) - 1 for k in range(8)] + [(1 << 64) - 1], np.uint64)
#: Bytes whose words are looked at together.
SLICE = 1 << 20


def spans(inside: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of each maximal run of bytes that are inside, cut at the texts' ends; and the first run's number for each offset."""
    n = len(inside)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(off), np.int64)
    before = np.zeros(n, bool)
    before[1:] = inside[:-1]
    before[off[:-1][off[:-1] < n]] = False
    begin = np.flatnonzero(inside & ~before)
    after = np.zeros(n, bool)
    after[:-1] = inside[1:]
    ends = off[1:][(off[1:] > 0)] - 1
    after[ends] = False
    end = np.flatnonzero(inside & ~after) + 1
    return begin, end, np.searchsorted(begin, off)


def finish(x: np.ndarray) -> np.ndarray:
    x = x * _MIX
    x = (x ^ (x >> np.uint64(31))) * _LAST
    return x ^ (x >> np.uint64(29))


def packed(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Two numbers for each byte string between begin and end, and the places of the strings of more than EXACT bytes.

    The first holds bytes 0 to 7, the second bytes 8 to 14 and, in its top byte, the length plus
    one; so up to EXACT bytes equal numbers are equal strings. For longer strings they mean nothing.
    """
    padded = np.concatenate([data, np.zeros(16, np.uint8)])
    eight = np.ndarray(len(data) + 9, "<u8", padded, strides=(1,))  # the eight bytes from each place on
    n = end - begin
    low = eight[begin] & _MASK[np.minimum(n, 8)]
    high = eight[begin + np.minimum(n, 8)] & _MASK[np.clip(n - 8, 0, 7)] | np.minimum(n + 1, 255).astype(np.uint64) << np.uint64(56)
    return low, high, np.flatnonzero(n > EXACT)


def mixed(low: np.ndarray, high: np.ndarray, seed: int = 0) -> np.ndarray:
    """Keys of the pairs. Without a seed anyone can find pairs that share a key; with a secret one, two given pairs share it by chance alone."""
    if seed:
        return finish(finish(low ^ np.uint64(seed)) + high * np.uint64(int(_HIGH) * (seed | 1) % (1 << 64)))
    return finish(finish(low) + high * _HIGH)


def keys(data: np.ndarray, begin: np.ndarray, end: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit keys of the byte strings between begin and end, equal for equal strings wherever they stand: mixed from all their bytes, or, of more than EXACT bytes, a BLAKE2 digest. They are keyed by the seed, if there is one."""
    low, high, long = packed(data, begin, end)
    out = mixed(low, high, seed)
    key = seed.to_bytes(8, "little") if seed else b""
    for k in long.tolist():
        out[k] = int.from_bytes(hashlib.blake2b(data[begin[k] : end[k]], digest_size=8, key=key).digest(), "little")
    return out


def sequence_digest(text: bytes) -> bytes:
    """16 bytes (BLAKE2) that name the sequence of a text's words in lower case, however they are parted; taken in slices of about SLICE bytes, cut between words."""
    digest, at, gap = hashlib.blake2b(digest_size=16), 0, b""
    while at < len(text):
        to = at + SLICE
        while to < len(text) and text[to] not in b" \t\n\v\f\r":
            to += 1
        if some := text[at:to].lower().split():
            digest.update(gap + b" ".join(some))
            gap = b" "
        at = to
    return digest.digest()


def word_keys(inside: np.ndarray, data: np.ndarray, off: np.ndarray, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The keys of all words (runs of bytes for which inside is true) of the texts in data, and each offset's first word; in slices of about SLICE bytes, cut between words."""
    parts, at, first = [], 0, np.zeros(len(off), np.int64)
    while at < len(data) or not parts:
        to = len(data)
        if to - at > SLICE:
            gaps = np.flatnonzero(~inside[data[at + SLICE :][: 1 << 16]])
            step = 1 << 16
            while not len(gaps) and at + SLICE + step < len(data):
                gaps = np.flatnonzero(~inside[data[at + SLICE + step :][: 1 << 16]]) + step
                step += 1 << 16
            to = at + SLICE + int(gaps[0]) if len(gaps) else len(data)
        own = np.clip(off, at, to) - at
        begin, end, number = spans(inside[data[at:to]], own)
        first[off >= at] = (number + sum(map(len, parts)))[off >= at]
        parts.append(keys(data[at:to], begin, end, seed))
        at = to
    return np.concatenate(parts), first
