"""Quality classifier: histogram gradient-boosted trees over document statistics."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words
from .common import bound_batches, by_bytes, fitted, sums, utf8

#: Labelled rows that a model is fitted on at most: those with the least hashes of their ids.
SAMPLE = 8000
#: Score from which a document is kept.
KEEP = 0.7
TREES, DEPTH, BINS, RATE, RIDGE, LEAST_ROWS = 80, 4, 32, 0.15, 1.0, 4

_CLASSES = ("lower", "upper", "digit", "blank", "newline", "stop", "cry", "bar", "junk", "wide", "other")


def _class_table() -> np.ndarray:
    out = np.full(256, _CLASSES.index("other"), np.uint8)
    for name, chars in (("lower", "abcdefghijklmnopqrstuvwxyz"), ("upper", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"), ("digit", "0123456789"), ("blank", " \t\r\v\f"), ("newline", "\n"), ("stop", ".,"), ("cry", "!?"), ("bar", "|"), ("junk", "%$*&#@~^_=+<>\\")):
        out[[ord(c) for c in chars]] = _CLASSES.index(name)
    out[128:] = _CLASSES.index("wide")
    return out


_CLASS = _class_table()
FEATURES = (*_CLASSES[:-1], "length", "words", "word_length", "distinct_words", "top_word", "stutter", "distinct_pairs", "lines", "distinct_lines", "line_length", "marked_words")


_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_BARE = np.array([not (48 <= c < 58 or 65 <= c < 91 or 97 <= c < 123 or c >= 128) for c in range(256)])


def _repetition(key: np.ndarray, text: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray]:
    """For each text how many of its keys are distinct, and how often its most frequent one occurs."""
    own = words.mixed(key, text.astype(np.uint64) + np.uint64(1))
    order = np.argsort(own)
    start = np.flatnonzero(np.append(True, np.diff(own[order]) != 0)) if len(own) else np.zeros(0, np.int64)
    where, count, top = text[order[start]], np.diff(np.append(start, len(own))), np.zeros(texts, np.int64)
    np.maximum.at(top, where, count)
    return np.bincount(where, minlength=texts), top


def statistics(off: np.ndarray, data: np.ndarray) -> np.ndarray:
    """One row of FEATURES per text: shares of byte classes, and of repetition among words, pairs and lines. Zeros for words and lines of a text without words.

    Words are runs of bytes other than ASCII white space. All is counted over whole texts, by
    64-bit keys of words and lines, so a long text costs a few numbers a word.
    """
    n, texts = np.diff(off), len(off) - 1
    kind = _CLASS[data]
    part = [sums(kind == k, off) / np.maximum(n, 1) for k in range(len(_CLASSES) - 1)]
    key, first = words.word_keys(~_SPACE, data, off)
    m, chars = np.diff(first), sums((data & 0xC0) != 0x80, off)
    some, text = np.maximum(m, 1), np.repeat(np.arange(texts), m)
    next_ = text[1:] == text[:-1]
    distinct, top = _repetition(key, text, texts)
    pairs, _ = _repetition(words.mixed(key[:-1], key[1:])[next_], text[:-1][next_], texts)
    stutter = np.bincount(text[:-1][next_ & (key[1:] == key[:-1])], minlength=texts)
    newline = np.flatnonzero(data == 10)
    begin, end = np.sort(np.concatenate([off[:-1], newline + 1]), kind="stable"), np.sort(np.concatenate([newline, off[1:]]), kind="stable")
    of_line = np.repeat(np.arange(texts), np.diff(np.searchsorted(newline, off)) + 1)
    lines = np.bincount(of_line, minlength=texts)
    own_lines, _ = _repetition(words.keys(data, begin, end), of_line, texts)
    last = np.zeros(len(data), bool)  # bytes that end a word and are neither letter nor digit
    if len(data):
        last[:-1] = _SPACE[data[1:]]
        last[off[1:][off[1:] > 0] - 1] = True
        last &= _BARE[data] & ~_SPACE[data]
    rest = np.stack([
        np.log1p(m), chars / some, distinct / some, top / some, stutter / some, pairs / np.maximum(m - 1, 1),
        np.log1p(lines), own_lines / lines, np.log1p(chars / lines), sums(last, off) / some,
    ], 1)
    return np.column_stack([*part, np.log1p(n), np.where(m[:, None] > 0, rest, 0.0)])


@dataclass
class Forest:
    """Trees as complete binary arrays: column and cut of each inner node, value of each leaf."""

    column: np.ndarray  # (trees, inner nodes)
    cut: np.ndarray
    leaf: np.ndarray  # (trees, leaves)
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        rows, trees = np.arange(len(x))[:, None], np.arange(len(self.leaf))[None, :]
        at = np.zeros((len(x), len(self.leaf)), np.int64)
        for _ in range(int(np.log2(self.leaf.shape[1]))):
            at = 2 * at + 1 + (x[rows, self.column[trees, at]] > self.cut[trees, at])
        raw = self.base + self.leaf[trees, at - self.column.shape[1]].sum(axis=1)
        return 1 / (1 + np.exp(-raw))


def fit(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> Forest:
    """Boosts logistic loss; splits are found on histograms of up to BINS quantile bins per column.

    y may lie between 0 and 1. Without rows, or with one class only, the trees are empty and
    the score is the (smoothed) share of ones.
    """
    inner = (1 << depth) - 1
    p0 = (y.sum() + 0.5) / (len(y) + 1)
    base = float(np.log(p0 / (1 - p0)))
    if not len(y) or y.min() == y.max():
        return Forest(np.zeros((1, inner), np.int64), np.full((1, inner), np.inf), np.zeros((1, inner + 1)), base)
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1], method="lower")) for c in x.T]
    binned = np.stack([np.searchsorted(c, v, "left") for c, v in zip(cuts, x.T, strict=True)], 1)
    width, f = BINS, x.shape[1]
    raw = np.full(len(y), base)
    out_col, out_cut, out_leaf = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-raw))
        g, h = p - y, p * (1 - p)
        col, cut, level = np.zeros(inner, np.int64), np.full(inner, np.inf), np.zeros(len(y), np.int64)
        for d in range(depth):
            nodes = 1 << d
            key = (level[:, None] * f + np.arange(f)) * width + binned
            hist = [np.bincount(key.ravel(), np.repeat(v, f), nodes * f * width).reshape(nodes, f, width).cumsum(axis=2) for v in (g, h, np.ones(len(y)))]
            lg, lh, ln = hist
            tg, th, tn = (v[:, :, -1:] for v in hist)
            gain = lg**2 / (lh + RIDGE) + (tg - lg) ** 2 / (th - lh + RIDGE) - tg**2 / (th + RIDGE)
            gain[(ln < LEAST_ROWS) | (tn - ln < LEAST_ROWS)] = 0
            flat = gain.reshape(nodes, -1)
            best = flat.argmax(axis=1)
            c, b = best // width, best % width
            ok = flat[np.arange(nodes), best] > 1e-6
            at = nodes - 1 + np.arange(nodes)
            col[at] = np.where(ok, c, 0)
            cut[at] = [cuts[j][k] if good and k < len(cuts[j]) else np.inf for j, k, good in zip(c, b, ok, strict=True)]
            limit = np.where(ok, b, width)
            level = 2 * level + (binned[np.arange(len(y)), col[at][level]] > limit[level])
        leaf = -RATE * np.bincount(level, g, inner + 1) / (np.bincount(level, h, inner + 1) + RIDGE)
        raw += leaf[level]
        out_col.append(col)
        out_cut.append(cut)
        out_leaf.append(leaf)
    return Forest(np.array(out_col), np.array(out_cut), np.array(out_leaf), base)


def labelled(docs: DataFrame, labels: DataFrame, label: str, modulus: int, held_out: int, sample: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text and label (y) of at most `sample` ids to learn from, one row of each.

    Rows with crc32(id as text) mod modulus = held_out are never among them; of the others those
    with the least hashes are taken. An id's labels are averaged if it has several; null labels don't
    count, and neither do null ids. Of several rows with one id the text of the least hash stands
    for it, so the sample is bounded whatever repeats. Null texts are empty ones. Only ids and
    labels are sorted; the documents are joined with that bounded set.
    """
    y = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label).cast("double").alias("y")).dropna()
    y = y.filter(F.crc32(F.col("doc_id").cast("string")) % modulus != held_out).groupBy("doc_id").agg(F.avg("y").alias("y"))
    y = y.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return own.join(F.broadcast(y), "doc_id").groupBy("doc_id").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"), F.first("y").alias("y"))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", modulus: int = 4, held_out: int = 2, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> Forest:
    """Fits the trees in one executor task, from the statistics (not the texts) of the bounded sample (see `labelled`); the driver gets the finished trees.

    Without labelled rows, or with one class only, every score is the smoothed share of that label.
    """
    bound_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = statistics(*utf8(b.column("text")))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("y"), pa.array(list(x), pa.list_(pa.float64()))], ["doc_id", "y", "x"])

    def learn(batches: Iterator[pa.RecordBatch]) -> bytes:
        got = [(np.array(b.column("x").to_pylist(), float).reshape(-1, len(FEATURES)), np.asarray(b.column("y"), float)) for b in batches]
        x, y = (np.concatenate(v) for v in zip((np.zeros((0, len(FEATURES))), np.zeros(0)), *got, strict=True))
        return pickle.dumps(fit(x, y), protocol=5)

    return pickle.loads(fitted(labelled(docs, labels, label, modulus, held_out, sample, id_col, text_col).mapInArrow(run, "doc_id long, y double, x array<double>"), learn))


def text_scores(forest: Forest, col: pa.Array) -> np.ndarray:
    """Scores of a column of whole texts; a null counts as empty."""
    return forest.score(statistics(*utf8(col)))


def score_documents(docs: DataFrame, scores: Callable[[pa.Array], np.ndarray], modulus: int, held_out: int, threshold: float = KEEP, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score and predicted (score >= threshold) of every whole text. No shuffle.

    A null text counts as empty, a null id is held out from nothing (held_out is false), rows that
    repeat an id or a text are scored one by one; equal texts have equal scores.
    """
    bound_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.crc32(F.col(id_col).cast("long").cast("string")) % modulus == held_out, F.lit(False)).alias("held_out"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in by_bytes(whole, "text", 2 << 20):
                s = scores(b.column("text"))
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), pa.array(s, pa.float64()), pa.array(s >= threshold).cast(pa.int32())], ["doc_id", "held_out", "score", "predicted"])

    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def keep_documents(docs: DataFrame, keep: Callable[[pa.Array], np.ndarray], text_col: str = "text") -> DataFrame:
    """The rows of docs, all columns as they are, for whose texts keep is true; null texts are handed on as such. No shuffle."""
    bound_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in by_bytes(whole, text_col, 2 << 20):
                yield b.filter(pa.array(keep(b.column(text_col))))

    return docs.mapInArrow(run, docs.schema)
