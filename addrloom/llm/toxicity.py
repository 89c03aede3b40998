"""Toxicity: a bidirectional gated recurrent network with attention pooling over word and character inputs.

A text's words (runs of letters, digits and non-ASCII characters, lower-cased) are cut into
overlapping windows; each window is read by a gated recurrent network in both directions and
pooled by attention; a document's score follows from its highest window. Inputs of a word are of
its units: the word itself, and of its characters the first three, four and five and all trigrams.
Each kind brings a trained embedding and its evidence, a smoothed log-odds over the training
documents, which for a training document leaves out its own label (without that the network would
trust words that it has seen the labels of; on held-out rows that costs a quarter of the recall).
What fewer than SUPPORT documents hold shares one embedding of its kind. Network and embeddings
are trained together in numpy, by backpropagation through time.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words
from .common import fitted, utf8
from .quality import labelled

#: Labelled rows to learn from at most.
SAMPLE = 4000
#: Words of a window, words between the beginnings of two windows, hidden units of a direction, size of an embedding.
WINDOW, STRIDE, HIDDEN, SIZE = 32, 16, 8, 3
#: Documents that must hold a unit for it to have evidence, and an embedding of its own; strength of the prior in the log-odds.
KNOWN, SUPPORT, PRIOR = 3, 40, 6.0
#: Training: least steps, windows of a step, rates of the network and of the embeddings, embeddings that a step leaves out, one document in VALIDATION is kept for the scale.
STEPS, BATCH, RATE, EMBEDDING_RATE, LEFT_OUT, VALIDATION = 900, 128, 0.01, 0.01, 0.75, 5
#: A word's kinds of units: itself, three prefixes, trigrams.
KINDS = 5
INPUTS = KINDS * (1 + SIZE)
#: Words of a long text that are read together.
TOGETHER = 1 << 16

_INSIDE = np.zeros(256, bool)
_INSIDE[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def lowered(data: np.ndarray) -> np.ndarray:
    """UTF-8 bytes with A to Z and the capitals of Latin-1 made small; lengths stay."""
    out = _LOWER[data]
    if len(data) > 1:
        wide = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
        out[1:][wide] += 32
    return out


@dataclass
class Units:
    """What the distinct words of a batch consist of. A word's units: itself, three prefixes, then its trigrams."""

    key: np.ndarray  # of units: 4 for each word, then the trigrams
    trigram_word: np.ndarray  # of each trigram, its word


def read(off: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, Units]:
    """For each word its number among the distinct ones, the first word of each text, and the distinct words' units."""
    low = lowered(data)
    begin, end, first = words.spans(_INSIDE[data], off)
    distinct, at, number = np.unique(words.keys(low, begin, end), return_index=True, return_inverse=True)
    b, e = begin[at], end[at]
    # Characters of the distinct words: bytes that don't continue one.
    chars = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
    cb, ce = np.searchsorted(chars, b), np.searchsorted(chars, e)
    prefix = [words.keys(low, b, chars[np.minimum(cb + k, ce)]) + np.uint64(k) for k in (3, 4, 5)]
    count = np.maximum(ce - cb - 2, 0)
    word = np.repeat(np.arange(len(b)), count)
    start = np.repeat(cb - (np.cumsum(count) - count), count) + np.arange(len(word))
    grams = words.keys(low, chars[start], chars[start + 3]) + np.uint64(9)
    return number.ravel(), first, Units(np.concatenate([distinct, *prefix, grams]), word)


def windows(first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First word and text of each window. A text has a window at least, and its windows cover all its words."""
    n = np.diff(first)
    count = np.maximum(1, -(-(n - (WINDOW - STRIDE)) // STRIDE))
    text = np.repeat(np.arange(len(n)), count)
    k = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    return first[:-1][text] + k * STRIDE, text


@dataclass
class Vocabulary:
    """Units that are known, sorted; `own` is the row of a unit's embedding. The first KINDS rows are those of units without one, by kind."""

    key: np.ndarray
    value: np.ndarray  # evidence
    own: np.ndarray

    def of(self, units: Units) -> tuple[np.ndarray, np.ndarray]:
        """Row of the embedding and evidence of each unit."""
        n = (len(units.key) - len(units.trigram_word)) // 4
        kind = np.minimum(np.arange(len(units.key)) // max(n, 1), KINDS - 1)
        if not len(self.key):
            return kind, np.zeros(len(kind), np.float32)
        at = np.minimum(np.searchsorted(self.key, units.key), len(self.key) - 1)
        known = self.key[at] == units.key
        own = self.own[at]
        return np.where(known & (own >= 0), own, kind), np.where(known, self.value[at], 0).astype(np.float32)


def inputs(units: Units, row: np.ndarray, value: np.ndarray, embedding: np.ndarray) -> np.ndarray:
    """(distinct words, INPUTS): evidence and embedding by kind; of a word's trigrams the largest evidence and the mean embedding, zeros without any."""
    n = (len(units.key) - len(units.trigram_word)) // 4
    four = np.concatenate([value[: 4 * n, None], embedding[row[: 4 * n]]], 1).reshape(4, n, 1 + SIZE)
    gram = np.zeros((n, 1 + SIZE), np.float32)
    if len(units.trigram_word):
        begin = np.flatnonzero(np.append(True, np.diff(units.trigram_word) > 0))
        w = units.trigram_word[begin]
        gram[w, 0] = np.maximum.reduceat(value[4 * n :], begin)
        gram[w, 1:] = np.add.reduceat(embedding[row[4 * n :]], begin) / np.diff(np.append(begin, len(units.trigram_word)))[:, None]
    return np.concatenate([*four, gram], 1)


def part(units: Units, word: np.ndarray, grams: np.ndarray) -> tuple[Units, np.ndarray]:
    """The units of some of the distinct words, and their places among all units; grams: the first trigram of each word."""
    n = len(grams) - 1
    count = np.diff(grams)[word]
    take = np.repeat(grams[word] - (np.cumsum(count) - count), count) + np.arange(count.sum())
    at = np.concatenate([*(k * n + word for k in range(4)), 4 * n + take])
    return Units(units.key[at], np.repeat(np.arange(len(word)), count)), at


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


Weights = dict[str, np.ndarray]


def fresh(seed: int = 3) -> Weights:
    r, h = np.random.Generator(np.random.PCG64(seed)), HIDDEN
    w: Weights = {}
    for d in "fb":
        w |= {f"W{d}": r.normal(0, 0.3, (INPUTS, 3 * h)), f"U{d}": r.normal(0, 0.3, (h, 3 * h)), f"c{d}": np.zeros(3 * h)}
    w |= {"A": r.normal(0, 0.3, (2 * h, h)), "a": r.normal(0, 0.3, h), "o": r.normal(0, 0.3, 2 * h), "b": np.zeros(1)}
    return {k: v.astype(np.float32) for k, v in w.items()}


def _direction(w: Weights, d: str, x: np.ndarray, mask: np.ndarray, keep: bool) -> tuple[np.ndarray, list]:
    """Hidden states (steps, windows, HIDDEN) of one direction; x (steps, windows, 3 * HIDDEN) are projected inputs."""
    steps, n, h = len(x), x.shape[1], HIDDEN
    state, out, tape = np.zeros((n, h), np.float32), np.empty((steps, n, h), np.float32), []
    for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
        u = state @ w[f"U{d}"]
        gates = _sigmoid(x[t, :, : 2 * h] + u[:, : 2 * h])
        z, r = gates[:, :h], gates[:, h:]
        new = np.tanh(x[t, :, 2 * h :] + r * u[:, 2 * h :])
        z = z * mask[t][:, None]  # past a window's end the state stays
        after = state + z * (new - state)
        if keep:
            tape.append((t, state, u, gates, z, new))
        out[t] = state = after
    return out, tape


def forward(w: Weights, x: dict[str, np.ndarray], mask: np.ndarray, keep: bool = False) -> tuple[np.ndarray, tuple]:
    """Logits of windows; mask (steps, windows) is 1 at their words. A window without words has the pooled vector 0."""
    hf, tf = _direction(w, "f", x["f"], mask, keep)
    hb, tb = _direction(w, "b", x["b"], mask, keep)
    h = np.concatenate([hf, hb], 2)
    hidden = np.tanh(h @ w["A"])
    e = np.where(mask > 0, hidden @ w["a"], -30)
    e = np.exp(e - e.max(axis=0)) * mask
    share = e / np.maximum(e.sum(axis=0), 1e-9)
    pooled = np.einsum("tn,tnk->nk", share, h)
    return pooled @ w["o"] + w["b"][0], (h, hidden, share, pooled, tf, tb)


def gradients(w: Weights, raw: np.ndarray, mask: np.ndarray, y: np.ndarray) -> tuple[float, Weights, np.ndarray]:
    """Loss and gradients, of the weights and of the inputs, for windows with inputs raw (steps, windows, INPUTS) and labels y."""
    n, h2 = len(y), HIDDEN
    x = {d: raw @ w[f"W{d}"] + w[f"c{d}"] for d in "fb"}
    logit, (h, hidden, share, pooled, tf, tb) = forward(w, x, mask, keep=True)
    p = _sigmoid(logit)
    loss = float(-np.mean(y * np.log(p + 1e-7) + (1 - y) * np.log(1 - p + 1e-7)))
    g: Weights = {}
    dlogit = (p - y) / n
    g["o"], g["b"] = pooled.T @ dlogit, np.array([dlogit.sum()])
    dpooled = dlogit[:, None] * w["o"]
    dh = share[:, :, None] * dpooled
    dshare = np.einsum("tnk,nk->tn", h, dpooled)
    de = share * (dshare - (share * dshare).sum(axis=0))
    g["a"] = np.einsum("tnk,tn->k", hidden, de)
    dhidden = de[:, :, None] * w["a"] * (1 - hidden**2)
    g["A"] = np.einsum("tni,tnk->ik", h, dhidden)
    dh += dhidden @ w["A"].T
    draw = np.zeros_like(raw)
    for d, tape, part in (("f", tf, dh[:, :, :h2]), ("b", tb, dh[:, :, h2:])):
        u_w, carry = w[f"U{d}"], np.zeros((n, h2), np.float32)
        gu, dx = np.zeros_like(u_w), np.zeros_like(x[d])
        for t, state, u, gates, z, new in reversed(tape):
            out = part[t] + carry
            zr, r = gates[:, :h2], gates[:, h2:]
            dz = out * (new - state) * mask[t][:, None] * zr * (1 - zr)
            dnew = out * z * (1 - new**2)
            dr = dnew * u[:, 2 * h2 :] * r * (1 - r)
            dx[t] = np.concatenate([dz, dr, dnew], 1)
            du = np.concatenate([dz, dr, dnew * r], 1)
            gu += state.T @ du
            carry = out * (1 - z) + du @ u_w.T
        g[f"U{d}"], g[f"c{d}"] = gu, dx.sum(axis=(0, 1))
        g[f"W{d}"] = raw.reshape(-1, raw.shape[2]).T @ dx.reshape(-1, dx.shape[2])
        draw += dx @ w[f"W{d}"].T
    return loss, g, draw


@dataclass
class Model:
    weights: Weights
    vocabulary: Vocabulary
    embedding: np.ndarray
    scale: float
    shift: float

    def scores(self, col: pa.Array) -> np.ndarray:
        """Score of each text: all its windows are read; a null or empty text has one empty window."""
        off, data = utf8(col)
        top = np.full(len(off) - 1, -np.inf)
        for piece_off, piece, text in pieces(off, data):
            number, first, units = read(piece_off, piece)
            table = inputs(units, *self.vocabulary.of(units), self.embedding)
            np.maximum.at(top, text, highest(self.weights, table, number, first))
        return 1 / (1 + np.exp(-(self.scale * np.clip(top, -30, 30) + self.shift)))


def pieces(off: np.ndarray, data: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Offsets, bytes and text numbers of what is read together: texts of some MB as they are; a longer one in pieces whose windows are together those of the whole."""
    begin_text = 0
    for k in [*np.flatnonzero(np.diff(off) > 8 * TOGETHER).tolist(), len(off) - 1]:
        if k > begin_text:
            yield off[begin_text : k + 1] - off[begin_text], data[off[begin_text] : off[k]], np.arange(begin_text, k)
        begin_text = k + 1
        if k < len(off) - 1:
            own = data[off[k] : off[k + 1]]
            begin, end, _ = words.spans(_INSIDE[own], np.array([0, len(own)]))
            if not len(begin):
                yield np.array([0, 0]), own[:0], np.array([k])
            for a in range(0, max(1, len(begin) - (WINDOW - STRIDE)) if len(begin) else 0, TOGETHER):
                z = min(a + TOGETHER + WINDOW - STRIDE, len(begin))
                yield np.array([0, end[z - 1] - begin[a]]), own[begin[a] : end[z - 1]], np.array([k])


def gather(number: np.ndarray, first: np.ndarray, begin: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(WINDOW, windows): the distinct word at each place, and whether there is one."""
    at = begin[None, :] + np.arange(WINDOW)[:, None]
    mask = at < first[1:][text][None, :]
    return number[np.minimum(at, len(number) - 1)] if len(number) else np.zeros(at.shape, np.int64), mask.astype(np.float32)


def highest(w: Weights, table: np.ndarray, number: np.ndarray, first: np.ndarray, together: int = 2048) -> np.ndarray:
    """The largest logit among each text's windows."""
    begin, text = windows(first)
    if not len(table):
        table = np.zeros((1, INPUTS), np.float32)
    projected = {d: table @ w[f"W{d}"] + w[f"c{d}"] for d in "fb"}
    out = np.full(len(first) - 1, -np.inf)
    for k in range(0, len(begin), together):
        at, mask = gather(number, first, begin[k : k + together], text[k : k + together])
        logit, _ = forward(w, {d: p[at] for d, p in projected.items()}, mask)
        np.maximum.at(out, text[k : k + together], logit)
    return out


@dataclass
class Sample:
    """The words of all training texts: numbers of distinct words, the first word of each text, the distinct words' units."""

    number: np.ndarray
    first: np.ndarray
    units: Units


def gathered(batches: Iterator[tuple[np.ndarray, np.ndarray]]) -> Sample:
    """Reads texts batch by batch; of a batch only its word numbers and its distinct words stay."""
    numbers, firsts, keys, grams, gram_words = [], [np.zeros(1, np.int64)], [], [], []
    words_before = texts_before = 0
    for off, data in batches:
        number, first, units = read(off, data)
        n = (len(units.key) - len(units.trigram_word)) // 4
        numbers.append((number + words_before).astype(np.int32))
        firsts.append(first[1:] + texts_before)
        keys.append(units.key[: 4 * n].reshape(4, n))
        grams.append(units.key[4 * n :])
        gram_words.append(units.trigram_word + words_before)
        words_before, texts_before = words_before + n, texts_before + int(first[-1])
    if not keys:
        return Sample(np.zeros(0, np.int64), np.zeros(1, np.int64), Units(np.zeros(0, np.uint64), np.zeros(0, np.int64)))
    four, gram, gram_word = np.concatenate(keys, 1), np.concatenate(grams), np.concatenate(gram_words)
    _, at, name = np.unique(four[0], return_index=True, return_inverse=True)  # one entry for each distinct word of all batches
    new = np.full(four.shape[1], -1, np.int64)
    new[at] = np.arange(len(at))
    there = new[gram_word] >= 0
    gram, gram_word = gram[there], new[gram_word[there]]
    order = np.argsort(gram_word, kind="stable")
    return Sample(name.ravel()[np.concatenate(numbers)], np.concatenate(firsts), Units(np.concatenate([*four[:, at], gram[order]]), gram_word[order]))


def _holders(s: Sample, unit: np.ndarray, units: int, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each unit the toxic documents and all documents that hold it; in blocks of documents, which bounds the memory."""
    n = (len(s.units.key) - len(s.units.trigram_word)) // 4
    toxic, both = np.zeros(units), np.zeros(units)
    grams = np.searchsorted(s.units.trigram_word, np.arange(n + 1))
    for d in range(0, len(y), 128):
        some = min(128, len(y) - d)
        pair = np.unique(s.number[s.first[d] : s.first[d + some]] * some + np.repeat(np.arange(some), np.diff(s.first[d : d + some + 1])))
        word, doc = pair // some, pair % some
        count = np.diff(grams)[word]
        at = np.repeat(grams[word] - (np.cumsum(count) - count), count) + np.arange(count.sum())
        parts = [unit[k * n + word].astype(np.int64) * some + doc for k in range(4)]
        held = np.unique(np.concatenate([*parts, unit[4 * n + at].astype(np.int64) * some + np.repeat(doc, count)]))
        np.add.at(toxic, held // some, y[d + held % some])
        np.add.at(both, held // some, 1.0)
    return toxic, both


def _odds(toxic: np.ndarray, both: np.ndarray, base: float) -> np.ndarray:
    p = np.clip((np.maximum(toxic, 0) + PRIOR * base) / (np.maximum(both, 0) + PRIOR), 1e-4, 1 - 1e-4)
    return np.where(both >= KNOWN, np.log(p / (1 - p)) - np.log(base / (1 - base)), 0).astype(np.float32)


def _strength(units: Units, value: np.ndarray) -> np.ndarray:
    """The largest log-odds among each distinct word's units."""
    n = (len(units.key) - len(units.trigram_word)) // 4
    out = value[: 4 * n].reshape(4, n).max(axis=0)
    np.maximum.at(out, units.trigram_word, value[4 * n :])
    return out


def fit(s: Sample, y: np.ndarray, seed: int = 3, support: int = SUPPORT, left_out: float = LEFT_OUT) -> Model:
    """Trains on whole documents whose labels hold for them as a whole; support and left_out as in SUPPORT and LEFT_OUT.

    Which windows stand for a document is told by the log-odds of their units, counted without
    that document's own label: its two strongest, and of clean documents others at random. The
    network is then scaled to documents by the highest windows of documents it wasn't trained on.
    """
    y = (np.asarray(y) >= 0.5).astype(np.float64)
    none = np.zeros(0)
    if not len(y) or y.min() == y.max():
        p = (y.sum() + 0.5) / (len(y) + 1)
        return Model(fresh(seed), Vocabulary(none.astype(np.uint64), none, none.astype(np.int32)), np.zeros((KINDS, SIZE), np.float32), 0.0, float(np.log(p / (1 - p))))
    rng = np.random.Generator(np.random.PCG64(seed))
    number, first, units = s.number, s.first, s.units
    key, unit = np.unique(units.key, return_inverse=True)
    unit = unit.ravel().astype(np.int32)
    toxic, both = _holders(s, unit, len(key), y)
    base = y.mean()
    # A training document's evidence leaves its own label out: two values of a unit, one for each label.
    odds = [_odds(toxic - label, both - 1, base)[unit] for label in (0, 1)]
    strength = np.stack([_strength(units, v) for v in odds])
    known = both >= KNOWN
    kept = both[known] >= support
    vocabulary = Vocabulary(key[known], _odds(toxic, both, base)[known], np.where(kept, KINDS - 1 + np.cumsum(kept), -1).astype(np.int32))
    row, _ = vocabulary.of(units)
    begin, text = windows(first)
    label = y.astype(np.int64)
    total = np.zeros(len(begin), np.float32)
    for k in range(0, len(begin), 4096):
        at, mask = gather(number, first, begin[k : k + 4096], text[k : k + 4096])
        power = np.where(mask > 0, strength[label[text[k : k + 4096]][None, :], at], -9)
        total[k : k + 4096] = np.sort(power, axis=0)[-3:].sum(axis=0)
    order = np.lexsort((-total, text))
    rank = np.arange(len(order)) - np.searchsorted(text[order], text[order])
    chosen = order[rank < 2]
    spare = order[(rank >= 2) & (y[text[order]] == 0)]
    chosen = np.concatenate([chosen, rng.choice(spare, min(len(spare), len(y)), replace=False)]) if len(spare) else chosen
    # Of a toxic document only windows count that are nearly as strong as its strongest.
    best = np.full(len(y), -np.inf)
    np.maximum.at(best, text, total)
    chosen = chosen[(y[text[chosen]] == 0) | (total[chosen] >= best[text[chosen]] - 1)]
    spared = np.arange(len(y)) % VALIDATION == 0
    if y[spared].min() == y[spared].max() or y[~spared].min() == y[~spared].max():
        spared[:] = False
    chosen = chosen[~spared[text[chosen]]]
    grams = np.searchsorted(units.trigram_word, np.arange((len(units.key) - len(units.trigram_word)) // 4 + 1))
    embedding = rng.normal(0, 0.1, (KINDS + int(kept.sum()), SIZE)).astype(np.float32)
    w, slow = fresh(seed), np.full(len(embedding), 1e-4, np.float32)
    mean, var, step = {k: np.zeros_like(v) for k, v in w.items()}, {k: np.zeros_like(v) for k, v in w.items()}, 0
    while step < STEPS:
        rng.shuffle(chosen)
        for k in range(0, len(chosen), BATCH):
            c = chosen[k : k + BATCH]
            at, mask = gather(number, first, begin[c], text[c])
            # Distinct words of the step, apart for either label, since their evidence differs.
            two = at * 2 + label[text[c]][None, :]
            word, place = np.unique(two, return_inverse=True)
            place = place.reshape(at.shape)
            some, of_all = part(units, word >> 1, grams)
            toxic_word = np.concatenate([np.tile(word & 1, 4), (word & 1)[some.trigram_word]])
            evidence = np.where(toxic_word == 1, odds[1][of_all], odds[0][of_all])
            stays = (rng.random(len(of_all)) >= left_out).astype(np.float32)
            rows = np.where(stays > 0, row[of_all], np.concatenate([np.repeat(np.arange(4), len(word)), np.full(len(some.trigram_word), 4)]))
            raw = inputs(some, rows, evidence, embedding)[place] * mask[:, :, None]
            _, g, draw = gradients(w, raw, mask, y[text[c]].astype(np.float32))
            step += 1
            for name, v in g.items():
                v = v + 1e-4 * w[name]
                mean[name] = 0.9 * mean[name] + 0.1 * v
                var[name] = 0.99 * var[name] + 0.01 * v * v
                w[name] = (w[name] - RATE * (mean[name] / (1 - 0.9**step)) / (np.sqrt(var[name] / (1 - 0.99**step)) + 1e-6)).astype(np.float32)
            # Embeddings: the words' gradients go to the rows of their units; each row has its own rate, by its squared gradients so far.
            flat = (draw * mask[:, :, None]).reshape(-1, INPUTS)
            order = np.argsort(place, axis=None, kind="stable")
            by_word = np.add.reduceat(flat[order], np.searchsorted(place.ravel()[order], np.arange(len(word)))).reshape(len(word), KINDS, 1 + SIZE)[:, :, 1:]
            count = np.bincount(some.trigram_word, minlength=len(word))
            parts = np.concatenate([*(by_word[:, j] for j in range(4)), by_word[some.trigram_word, 4] / count[some.trigram_word][:, None]])
            order = np.argsort(rows, kind="stable")
            changed, at_row = np.unique(rows[order], return_index=True)
            grad = np.add.reduceat(parts[order], at_row) + 1e-5 * embedding[changed]
            slow[changed] += np.square(grad).mean(axis=1)
            embedding[changed] -= EMBEDDING_RATE * grad / np.sqrt(slow[changed])[:, None]
    # Documents: the highest window's logit to a probability, one scale and one shift.
    top = np.full(len(y), -np.inf)
    for v in (0, 1):
        top = np.where(label == v, highest(w, inputs(units, row, odds[v], embedding), number, first), top)
    top = np.clip(top, -12, 12)
    if spared.any():
        top, y = top[spared], y[spared]
    scale, shift = 1.0, 0.0
    for _ in range(200):
        p = 1 / (1 + np.exp(-(scale * top + shift)))
        d, h = p - y, p * (1 - p) + 1e-4
        a = np.array([[np.sum(h * top * top) + 1.0, np.sum(h * top)], [np.sum(h * top), np.sum(h) + 0.01]])
        ds, db = np.linalg.solve(a, [np.sum(d * top) + 1.0 * (scale - 1), np.sum(d) + 0.01 * shift])
        scale, shift = scale - 0.5 * ds, shift - 0.5 * db
    return Model(w, vocabulary, embedding, float(max(scale, 0.1)), float(shift))


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", modulus: int = 3, held_out: int = 1, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Fits the model in one executor task, on the whole texts of at most `sample` labelled ids outside the held-out fold; the driver gets the finished model.

    Null texts count as empty ones, and an id that several rows have is learned from once (see
    `labelled`). The task keeps four bytes for each word of the sample, however long a text is.
    Without labelled rows, or with one class only, every score is the smoothed share of that label.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> bytes:
        y: list[float] = []

        def texts() -> Iterator[tuple[np.ndarray, np.ndarray]]:
            for b in batches:
                y.extend(b.column("y").to_pylist())
                yield utf8(b.column("text"))

        got = gathered(texts())
        return pickle.dumps(fit(got, np.array(y)), protocol=5)

    return pickle.loads(fitted(labelled(docs, labels, label, modulus, held_out, sample, id_col, text_col), run))


def cross_validated(docs: DataFrame, labels: DataFrame, grid: list[tuple[int, float]], folds: int = 3, label: str = "toxic", modulus: int = 3, held_out: int = 1, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """support, left_out, fold, and of the fold's documents the four counts at 0.7 and the summed log loss: how settings do on labelled rows that the fit hasn't seen.

    All rows are of the sample that `train` learns from, so the contract's held-out rows take no part
    in a choice. A setting and fold is a group, which holds that bounded sample once and is a task of
    its own. Without labelled rows there are no groups. SUPPORT and LEFT_OUT are what
    `best_setting` gives at sf0.1 over the grid that README names.
    """
    rows = labelled(docs, labels, label, modulus, held_out, sample, id_col, text_col)
    rows = rows.withColumn("own", F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(folds)).cast("int"))
    tries = F.array(*(F.struct(F.lit(a).alias("support"), F.lit(float(b)).alias("left_out"), F.lit(k).alias("fold")) for a, b in grid for k in range(folds)))
    schema = "support long, left_out double, fold long, hits long, false_alarms long, misses long, passes long, loss double"

    def run(key: tuple, group: pa.Table) -> pa.Table:
        support, left_out, fold = (x.as_py() for x in key)
        group = group.sort_by("doc_id")
        own = group.column("own").to_numpy() == fold
        seen, unseen = group.filter(pa.array(~own)), group.filter(pa.array(own))
        model = fit(gathered(utf8(b.column("text")) for b in seen.to_batches(max_chunksize=64)), seen.column("y").to_numpy(), support=support, left_out=left_out)
        scores = [model.scores(b.column("text")) for b in unseen.to_batches(max_chunksize=64)]
        p = np.clip(np.concatenate([np.zeros(0), *scores]), 1e-7, 1 - 1e-7)
        y, hit = unseen.column("y").to_numpy() >= 0.5, p >= 0.7
        made = [int((hit & y).sum()), int((hit & ~y).sum()), int((~hit & y).sum()), int((~hit & ~y).sum()), float(-np.log(np.where(y, p, 1 - p)).sum())]
        return pa.Table.from_pydict(dict(zip([x.split()[0] for x in schema.split(", ")], [[v] for v in (support, left_out, fold, *made)], strict=True)))

    return rows.select("*", F.inline(tries)).repartition(len(grid) * folds, "support", "left_out", "fold").groupBy("support", "left_out", "fold").applyInArrow(run, schema)


def best_setting(validated: DataFrame) -> DataFrame:
    """The settings from the best on: by F1 at 0.7 over all folds together, then by the log loss."""
    g = validated.groupBy("support", "left_out").agg(*(F.sum(c).alias(c) for c in ("hits", "false_alarms", "misses", "passes", "loss")))
    f1 = 2 * F.col("hits") / F.greatest(2 * F.col("hits") + F.col("false_alarms") + F.col("misses"), F.lit(1))
    return g.withColumn("f1", f1).orderBy(F.col("f1").desc(), "loss", "support", "left_out")
