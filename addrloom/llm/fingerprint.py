"""Document fingerprints by locally consistent parsing.

A text is parsed in levels. At each level runs of one name are collapsed, deterministic coin
tossing reduces every name to a label of eight values that depends on three neighbours to the
left, and phrases begin at the labels' local maxima; a phrase's name is a hash of the names in it.
So a phrase depends only on its surroundings: equal substrings share their interior phrases
wherever they stand, and a long text can be parsed piece by piece. A fingerprint is a MinHash
sketch of the phrases of level LEVEL, counted as often as they occur.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, ordered_ranges

#: Level whose phrases (of about six code points) are sketched, sketch size (two to the power six), code points parsed together.
LEVEL, SLOTS, TOGETHER = 2, 64, 1 << 18
_C = [np.uint64(x) for x in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53, 0x9E3779B97F4A7C15)]
_RNG = np.random.Generator(np.random.PCG64(11))
_POW = _RNG.integers(1, 1 << 63, 64, np.uint64) | np.uint64(1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * _C[0]
    x = (x ^ (x >> np.uint64(29))) * _C[1]
    return x ^ (x >> np.uint64(32))


#: Index of a power of two's bit, by the top six bits of its product with a de Bruijn number.
_DE_BRUIJN = np.uint64(0x03F79D71B4CB0A89)
_BIT = np.zeros(64, np.uint8)
with np.errstate(over="ignore"):
    _BIT[((np.uint64(1) << np.arange(64, dtype=np.uint64)) * _DE_BRUIJN) >> np.uint64(58)] = np.arange(64)


def _toss(n: int) -> np.ndarray:
    """Next label for each pair (left label, own label) below n: twice the lowest bit in which they differ, plus the own bit there."""
    left, own = np.meshgrid(np.arange(n), np.arange(n), indexing="ij")
    d = left ^ own
    bit = np.zeros_like(d)
    for k in range(n.bit_length() - 1, -1, -1):
        bit[(d >> k & 1) == 1] = k
    return (2 * bit + (own >> bit & 1)).astype(np.uint8).ravel()


_SECOND, _THIRD = _toss(128), _toss(16)


def _before(x: np.ndarray, starts: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Each element's left neighbour; `first` for the elements at starts."""
    out = np.empty_like(x)
    out[1:] = x[:-1]
    out[starts] = first
    return out


def _collapsed(names: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each run of equal names within a text becomes one name of its symbol and length."""
    starts = off[:-1][off[1:] > off[:-1]]
    same = np.zeros(len(names), bool)
    same[1:] = names[1:] == names[:-1]
    same[starts] = False
    if not same.any():
        return names, off
    keep = np.flatnonzero(~same)
    return _of_runs(names[keep], np.diff(np.append(keep, len(names)))), np.searchsorted(keep, off)


def _of_runs(names: np.ndarray, run: np.ndarray) -> np.ndarray:
    out, long = names.copy(), run > 1
    out[long] = _mix(out[long] + run[long].astype(np.uint64) * _C[2])
    return out


def _tops(names: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Whether a phrase may begin at a name: its label is above both neighbours'."""
    differ = names ^ _before(names, starts, ~names[starts])
    low = differ & (~differ + np.uint64(1))
    label = _BIT[(low * _DE_BRUIJN) >> np.uint64(58)] * np.uint8(2) + ((names & low) != 0)
    for table, width in ((_SECOND, 128), (_THIRD, 16)):
        label = table[_before(label, starts, label[starts] ^ 1).astype(np.int32) * width + label]
    top = np.ones(len(label), bool)
    top[1:] = label[1:] > label[:-1]
    top[:-1] &= label[:-1] > label[1:]
    return top


def _phrases(names: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Names of the phrases that begin at the given places; the last reaches to the end."""
    place = np.arange(len(names)) - np.repeat(begin, np.diff(np.append(begin, len(names))))
    return _mix(np.add.reduceat(names * _POW[np.minimum(place, 63)], begin) + _C[2])


def next_level(names: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names and offsets of the phrases of one level up. Texts lie between the offsets; each non-empty one has a phrase."""
    if not len(names):
        return names, off
    names, off = _collapsed(names, off)
    starts = off[:-1][off[1:] > off[:-1]]
    top = _tops(names, starts)
    ends = off[1:][off[1:] > off[:-1]] - 1
    top[ends] = False  # a text's last name never begins a phrase, but for the only one
    top[starts] = True
    begin = np.flatnonzero(top)
    return _phrases(names, begin), np.searchsorted(begin, off)


#: Names to the left on which a phrase's beginning can depend: three tosses and a neighbour, with room to spare.
CONTEXT = 8


def _runs_in_pieces(pieces: Iterator[np.ndarray]) -> Iterator[np.ndarray]:
    """What `_collapsed` gives for one text whose names come in pieces."""
    name, count = None, 0  # the run that may go on
    for x in pieces:
        if not len(x):
            continue
        first = np.flatnonzero(np.append(True, x[1:] != x[:-1]))
        symbol, run = x[first], np.diff(np.append(first, len(x)))
        if name is not None:
            if symbol[0] == name:
                run[0] += count
            else:
                symbol, run = np.append(name, symbol), np.append(count, run)
        name, count = symbol[-1], int(run[-1])
        yield _of_runs(symbol[:-1], run[:-1])
    if name is not None:
        yield _of_runs(np.array([name], np.uint64), np.array([count]))


def next_level_in_pieces(pieces: Iterator[np.ndarray]) -> Iterator[np.ndarray]:
    """The same phrases as `next_level` for one text, whose names come and go in pieces, so that memory doesn't grow with it.

    What is kept between pieces is the last phrase, which may go on, and CONTEXT names before it.
    """
    held, known = np.zeros(0, np.uint64), 0  # names kept, and how many of them are only context
    for x in _runs_in_pieces(pieces):
        held = np.concatenate([held, x])
        if len(held) < known + CONTEXT:
            continue
        top = _tops(held, np.zeros(1, np.int64))
        top[: known + 1] = False
        top[known] = True  # the pending phrase begins here
        top[-1] = False  # not decided yet: its right neighbour is unknown
        begin = np.flatnonzero(top)
        if len(begin) > 1:
            last = int(begin[-1])
            yield _phrases(held[known:last], begin[:-1] - known)
            keep = max(0, last - CONTEXT)
            held, known = held[keep:], last - keep
    if len(held):
        top = _tops(held, np.zeros(1, np.int64))
        top[: known + 1] = False
        top[-1] = False
        top[known] = True
        yield _phrases(held[known:], np.flatnonzero(top) - known)


def _occurrences(names: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Names made distinct within their text: the second, third... occurrence of a name gets a name of its own."""
    doc = np.repeat(np.arange(len(off) - 1, dtype=np.uint64), np.diff(off))
    order = np.argsort(doc << np.uint64(44) | names >> np.uint64(20))
    x, d = names[order], doc[order]
    new = np.flatnonzero(np.append(True, (x[1:] != x[:-1]) | (d[1:] != d[:-1])))
    rank = np.arange(len(x)) - np.repeat(new, np.diff(np.append(new, len(x))))
    again = rank > 0
    out = names.copy()
    out[order[again]] = _mix(x[again] + rank[again].astype(np.uint64) * _C[2])
    return out


def _codes(text: str) -> np.ndarray:
    return _mix(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + _C[2])


def _long_names(text: str, level: int) -> np.ndarray:
    """The phrase names of one long text, parsed in pieces of TOGETHER code points."""
    names: Iterator[np.ndarray] = (_codes(text[k : k + TOGETHER]) for k in range(0, len(text), TOGETHER))
    for _ in range(level):
        names = next_level_in_pieces(names)
    return np.concatenate([*names])


def sketches(texts: list[str], level: int = LEVEL) -> np.ndarray:
    """A row of SLOTS 16-bit values for each text; all ones for an empty text.

    One-permutation hashing of the phrases with their multiplicity: a phrase falls into the slot
    of its top bits, the least of a slot stays, and an empty slot takes over the next full one's
    value, changed by the distance. A text of more than TOGETHER code points is parsed in pieces.
    """
    out = np.full((len(texts), SLOTS), _EMPTY, np.uint64)
    long = [k for k, t in enumerate(texts) if len(t) > TOGETHER]
    short = [k for k, t in enumerate(texts) if len(t) <= TOGETHER]
    for k in long:
        names = _long_names(texts[k], level)
        out[k] = _least(names, np.array([0, len(names)]))[0]
    names = _codes("".join(texts[k] for k in short))
    off = np.append(0, np.cumsum([len(texts[k]) for k in short], dtype=np.int64))
    for _ in range(level):
        names, off = next_level(names, off)
    out[short] = _least(names, off)
    have = out != _EMPTY
    place = np.where(np.tile(have, 2), np.arange(2 * SLOTS), 4 * SLOTS)
    at = np.minimum.accumulate(place[:, ::-1], axis=1)[:, ::-1][:, :SLOTS]
    far = (at - np.arange(SLOTS)).astype(np.uint64)
    got = np.take_along_axis(out, at % SLOTS, 1)
    got = np.where(far > 0, _mix(got + far * _C[2]), got)
    got[~have.any(axis=1)] = _EMPTY
    return (got & np.uint64(0xFFFF)).astype(np.uint16)


_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def _least(names: np.ndarray, off: np.ndarray) -> np.ndarray:
    """The least phrase of each slot of each text; _EMPTY where there is none."""
    texts = len(off) - 1
    out = np.full(texts * SLOTS, _EMPTY, np.uint64)
    if len(names):
        names = _mix(_occurrences(names, off) + _C[1])
        np.minimum.at(out, np.repeat(np.arange(texts) * SLOTS, np.diff(off)) + (names >> np.uint64(64 - 6)).astype(np.int64), names << np.uint64(6) >> np.uint64(6))
    return out.reshape(texts, SLOTS)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of two texts of equal length that agrees, 0 to 1, from the part j of their slots that agree: 2j / (1 + j)."""
    j = (a == b).mean(axis=-1)
    return 2 * j / (1 + j)


def to_hex(rows: np.ndarray) -> list[str]:
    return [r.tobytes().hex() for r in rows.astype(">u2")]


def edited(text: str, after: str) -> str:
    """The last floor(n / 4) code points replaced by the first as many (or all) of the next document."""
    k = len(text) // 4
    return text[: len(text) - k] + after[:k]


def fingerprint_pairs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of every document.

    The next document is the next by ascending doc_id, the first's after the last. One shuffle, of
    texts, into id ranges; the first document of each range is also sent to the range before it
    (the first of all to the last), so no task needs another's rows. Rows with equal ids follow
    each other by text; null ids come first; a null text is empty, and two empty texts are alike
    (1). A single document is its own next one. A long text costs its own bytes and eight for each
    level-2 phrase; what is computed together is bounded.
    """
    bound_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows, ranges = ordered_ranges(rows, "doc_id", "text")
    # Ranges can be empty: each non-empty range's predecessor is the non-empty one before. One row per range on the driver.
    heads = sorted((r["_p"], r["i"], r["n"]) for r in rows.groupBy("_p").agg(F.min("doc_id").alias("i"), F.count_if(F.col("doc_id").isNull()).alias("n")).collect())
    before = {p: heads[k - 1][0] for k, (p, _, _) in enumerate(heads)}
    first = {p: None if n else i for p, i, n in heads}
    spark = docs.sparkSession
    marks = spark.createDataFrame([(p, first[p], before[p]) for p in first], "_p int, _first long, _before int")
    x = rows.join(F.broadcast(marks), "_p")
    x = x.withColumn("_to", F.when(F.col("doc_id").eqNullSafe(F.col("_first")), F.array(F.struct(F.col("_p").alias("p"), F.lit(0).alias("late")), F.struct(F.col("_before").alias("p"), F.lit(1).alias("late")))).otherwise(F.array(F.struct(F.col("_p").alias("p"), F.lit(0).alias("late")))))
    x = x.select("doc_id", "text", F.inline("_to")).repartitionById(ranges, F.col("p")).sortWithinPartitions("late", "doc_id", "text").select("doc_id", "text", "late")
    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"

    def flush(ids: list, texts: list[str]) -> pa.RecordBatch:
        """All but the last of texts, which is the next of the one before it."""
        new = [edited(a, b) for a, b in zip(texts, texts[1:], strict=False)]
        own, other = sketches(texts), sketches(new)
        return pa.RecordBatch.from_arrays([
            pa.array(ids[:-1], pa.int64()), pa.array([len(t) for t in texts[:-1]], pa.int64()), pa.array([hashlib.sha256(t.encode()).hexdigest() for t in new], pa.string()),
            pa.array(to_hex(own[:-1]), pa.string()), pa.array(to_hex(other), pa.string()), pa.array(likeness(own[:-1], other)), pa.array(likeness(own[:-1], own[1:])),
        ], ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list = []
        texts: list[str] = []
        size, over = 0, False
        for b in batches:
            for i, t, late in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), b.column("late").to_pylist(), strict=True):
                if over:
                    break
                ids.append(i)
                texts.append(t)
                size += len(t)
                over = bool(late)  # the first document of the next range: the last one's next
                if len(texts) > 1 and size > TOGETHER:
                    yield flush(ids, texts)
                    ids, texts, size = ids[-1:], texts[-1:], len(t)
        if len(texts) > 1:
            yield flush(ids, texts)

    return x.mapInArrow(run, schema)
