"""Token counts, and the chunk-wise encoder that the token operators share.

A text is split at spaces, which are safe boundaries for both tokenizers: neither a merge nor a
normalisation crosses one. Distinct chunks are encoded by the library in batches; their ids are
kept in an open-addressing table of numpy arrays, so that the rest of the work on a batch of texts
is a few array operations. Chunks of up to 15 bytes are compared as the bytes they are, longer
ones by a dictionary of their bytes, so no two chunks are ever taken for one another. A chunk whose
isolated encoding could differ from the one in its text (white space at its ends, which joins a
run of white space) sends its segment to the library.

A long text is cut into segments at single spaces between ASCII letters or, where there is none,
between letters of any script at a space or before a mark that ends a clause, after the library
has shown on the text around it that it makes the same tokens of both sides alone. So neither
arrays nor library calls grow with a text's length, but for a run of letters without such a
place, which is one word to the tokenizer and goes to the library whole.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import words
from .common import bound_batches, by_bytes, sums, utf8

#: Letters, whose encoding can't depend on anything beyond the run they form, and marks that may follow.
_PLAIN = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ]+([.,!?;:|%$*&#]*)\Z")
#: Slots of a worker's table (a power of two, at most half of them used), ids kept, chunks that one library call encodes.
BITS, POOL, TOGETHER = 22, 12 << 20, 4096
SLOTS, _SHIFT = 1 << BITS, np.uint64(64 - BITS)
#: Bytes of a segment from which a long text is cut; bytes of segments encoded together; bytes of long chunks kept.
SEGMENT, GROUP, LONG_KEPT = 1 << 18, 2 << 20, 8 << 20
#: Marks in a chunk's second number: a long chunk, whose first number counts it; a text's first chunk.
_LONG, _HEAD = np.uint64(1 << 63), np.uint64(1 << 62)

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True


#: A space between two letters; the place between a letter and a mark that ends a clause, which a letter follows.
_GAP = re.compile(r"(?<=[^\W\d_])(?: (?=[^\W\d_])|(?=[。、，．！？；：…!?,.;:][^\W\d_]))")
#: Characters on either side of a cut on which the library is asked; places of a block that it is asked about.
AROUND, ASKED = 48, 64


def segments(off: np.ndarray, data: np.ndarray, segment: int, agreed: Callable[[str, str, bool], bool]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of each segment, whether it begins right at the end of the one before, and the first segment of each text.

    A text of more than `segment` bytes ends one at the first place from there on that is safe: a
    single space between ASCII letters, which belongs to neither side, or, in a block of `segment`
    bytes without one, a place of _GAP that agreed (left, right, whether a space parts them) holds
    for safe.
    """
    cuts: list[tuple[int, bool]] = []
    for k in np.flatnonzero(np.diff(off) > segment).tolist():
        at, to = int(off[k]), int(off[k + 1])
        while at + segment < to:
            low, cut = at + segment, None
            while low < to - 1 and cut is None:  # looked for block by block
                part = data[low - 1 : min(low + segment, to)]
                found = np.flatnonzero((part[1:-1] == 32) & _LETTER[part[:-2]] & _LETTER[part[2:]])
                cut = (low + int(found[0]), False) if len(found) else _agreed_cut(part[1:], low, agreed)
                low += segment - 1
            if cut is None:
                break
            cuts.append(cut)
            at = cut[0] + (not cut[1])
    place, bare = np.array([c for c, _ in cuts], np.int64), np.array([x for _, x in cuts], bool)
    begin = np.concatenate([off[:-1], place + ~bare])
    order = np.argsort(begin, kind="stable")
    joined = np.concatenate([np.zeros(len(off) - 1, bool), bare])[order]
    return begin[order], np.sort(np.concatenate([off[1:], place]), kind="stable"), joined, np.arange(len(off)) + np.searchsorted(place, off)


def _agreed_cut(part: np.ndarray, low: int, agreed: Callable[[str, str, bool], bool]) -> tuple[int, bool] | None:
    lead = int(np.argmax((part & 0xC0) != 0x80))  # bytes of a character that began before
    text = part[lead:].tobytes().decode("utf-8", "ignore")
    for n, m in enumerate(_GAP.finditer(text)):
        if n == ASKED:
            break
        if agreed(text[max(0, m.start() - AROUND) : m.start()], text[m.end() : m.end() + AROUND], bool(m[0])):
            return low + lead + len(text[: m.start()].encode()), not m[0]
    return None


class ChunkEncoder:
    """Ids of whole texts, exactly as the library gives them without added special tokens."""

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(path)
        # A tokenizer that keeps white space gets each chunk with the space before it.
        self.lead = " " if self.lib.encode("a  b", add_special_tokens=False).ids != self.lib.encode("a b", add_special_tokens=False).ids else ""
        self.reset()

    def reset(self) -> None:
        self.low, self.high = np.zeros(SLOTS, np.uint64), np.zeros(SLOTS, np.uint64)  # high is 0 where a slot is free
        self.at = np.zeros(SLOTS, np.int32)
        self.n = np.zeros(SLOTS, np.int32)  # -1: not to be encoded alone
        self.pool, self.used, self.kept = np.zeros(1 << 16, np.uint32), 0, 0
        self.long: dict[bytes, int] = {}
        self.long_bytes = 0

    def _lib(self, texts: list[str]) -> list[list[int]]:
        out: list[list[int]] = []
        for k in range(0, len(texts), TOGETHER):
            out += [e.ids for e in self.lib.encode_batch_fast(texts[k : k + TOGETHER], add_special_tokens=False)]
        return out

    def _agreed(self, left: str, right: str, space: bool) -> bool:
        """Whether the library makes the same tokens of both sides alone as of the whole."""
        whole, a, b = self._lib([left + " " * space + right, left, self.lead * space + right])
        return whole == a + b

    def _plain(self, chunks: list[str], runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids and lengths of chunks of `runs` pre-tokens each, which one text of them all splits into as well."""
        e = self.lib.encode(self.lead + " ".join(chunks), add_special_tokens=False)
        at = np.array(e.word_ids, np.int64)
        ends = np.append(np.flatnonzero(np.diff(at)) + 1, len(at))
        if len(ends) == runs.sum():
            return np.array(e.ids, np.uint32), np.diff(ends[np.cumsum(runs) - 1], prepend=0)
        ids = self._lib([self.lead + c for c in chunks])
        return np.array([x for y in ids for x in y], np.uint32), np.array([len(x) for x in ids])

    def _put(self, low: np.ndarray, high: np.ndarray, ids: np.ndarray, lengths: np.ndarray) -> None:
        need = self.used + len(ids)
        if need > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros(max(need, 2 * len(self.pool)) - len(self.pool), np.uint32)])
        self.pool[self.used : need] = ids
        at = self.used + np.cumsum(np.maximum(lengths, 0)) - np.maximum(lengths, 0)
        self.used, self.kept = need, self.kept + len(low)
        slot = (words.mixed(low, high) >> _SHIFT).astype(np.int64)
        todo = np.arange(len(low))
        while len(todo):
            s = slot[todo]
            free = todo[self.high[s] == 0]
            _, one = np.unique(slot[free], return_index=True)  # of several for one slot one is taken
            w = free[one]
            at_slot = slot[w]
            self.low[at_slot], self.high[at_slot], self.at[at_slot], self.n[at_slot] = low[w], high[w], at[w], lengths[w]
            left = np.ones(len(low), bool)
            left[w] = False
            todo = todo[left[todo]]
            slot[todo] = (slot[todo] + 1) % SLOTS

    def _find(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Slots of chunks; -1 where a chunk is not in the table."""
        slot = (words.mixed(low, high) >> _SHIFT).astype(np.int64)
        todo = np.flatnonzero((self.high[slot] != high) | (self.low[slot] != low))
        while len(todo):
            free = self.high[slot[todo]] == 0
            slot[todo[free]] = -1
            todo = todo[~free]
            slot[todo] = (slot[todo] + 1) % SLOTS
            there = slot[todo]
            todo = todo[(self.high[there] != high[todo]) | (self.low[there] != low[todo])]
        return slot

    def _learn(self, low: np.ndarray, high: np.ndarray, chunks: list[str]) -> None:
        plain, runs, other = [], [], []
        for k, c in enumerate(chunks):
            if m := _PLAIN.match(c):
                plain.append(k)
                runs.append(2 if m[1] else 1)
            else:
                other.append(k)
        for k in range(0, len(plain), TOGETHER):
            part = plain[k : k + TOGETHER]
            self._put(low[part], high[part], *self._plain([chunks[j] for j in part], np.array(runs[k : k + TOGETHER])))
        if other:
            ids = self._lib([self.lead + chunks[j] for j in other])
            alone = [not self.lead or bool(c) and not c[0].isspace() and not c[-1].isspace() for c in (chunks[j] for j in other)]
            self._keep(low[other], high[other], ids, alone)

    def _keep(self, low: np.ndarray, high: np.ndarray, ids: list[list[int]], alone: list[bool]) -> None:
        self._put(low, high, np.array([x for y, ok in zip(ids, alone, strict=True) if ok for x in y], np.uint32), np.array([len(x) if ok else -1 for x, ok in zip(ids, alone, strict=True)]))

    def _names(self, data: np.ndarray, begin: np.ndarray, end: np.ndarray, heads: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The two numbers that name each chunk; heads: the texts' first chunks."""
        low, high, long = words.packed(data, begin, end)
        for k in long.tolist():
            raw = data[begin[k] : end[k]].tobytes()
            if (number := self.long.get(raw)) is None:
                number = self.long[raw] = len(self.long)
                self.long_bytes += len(raw)
            low[k], high[k] = number, _LONG
        if self.lead:  # a text's first chunk has no space before it
            high[heads] ^= _HEAD
        return low, high

    def encode(self, off: np.ndarray, data: np.ndarray, with_ids: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """Lengths of the texts that data holds between the offsets, and all their ids (none without with_ids)."""
        if len(off) < 2:
            return np.zeros(0, np.int64), np.zeros(0, np.uint32)
        begin, end, head, first = segments(off, data, SEGMENT, self._agreed)
        head[first[:-1]] = True
        lengths, ids, at = [], [], 0
        while at < len(begin):
            to = max(at + 1, int(np.searchsorted(end, begin[at] + GROUP, "right")))
            n, x = self._encode(begin[at:to] - begin[at], end[at:to] - begin[at], data[begin[at] : end[to - 1]], head[at:to], with_ids)
            lengths.append(n)
            ids.append(x)
            at = to
        return sums(np.concatenate(lengths), first), np.concatenate(ids)

    def _encode(self, seg_begin: np.ndarray, seg_end: np.ndarray, data: np.ndarray, head: np.ndarray, with_ids: bool) -> tuple[np.ndarray, np.ndarray]:
        """The same for segments; between two of one text there is a space, unless the second is a head."""
        if self.kept > SLOTS // 2 or self.used > POOL or self.long_bytes > LONG_KEPT:
            self.reset()
        space = np.flatnonzero(data == 32)
        space = space[space < seg_end[np.searchsorted(seg_begin, space, "right") - 1]]
        begin, end = np.sort(np.concatenate([seg_begin, space + 1])), np.sort(np.concatenate([space, seg_end]))
        first = np.searchsorted(space, np.append(seg_begin, len(data) + 1)) + np.arange(len(seg_begin) + 1)  # of each segment, its first chunk's number
        heads = first[:-1][head]
        low, high = self._names(data, begin, end, heads)
        slot = self._find(low, high)
        if len(miss := np.flatnonzero(slot < 0)):
            if self.kept + len(miss) > SLOTS * 3 // 4:  # no batch has as many unless its texts are all but free of repetition
                self.reset()
                low, high = self._names(data, begin, end, heads)
                miss = np.arange(len(low))
            order = miss[np.lexsort((low[miss], high[miss]))]
            new = np.append(True, (low[order[1:]] != low[order[:-1]]) | (high[order[1:]] != high[order[:-1]]))
            at = np.sort(order[new])
            raw = data.tobytes()
            chunks = [raw[b:e].decode("utf-8", "replace") for b, e in zip(begin[at].tolist(), end[at].tolist(), strict=True)]
            is_head = np.zeros(len(low), bool)
            if self.lead:
                is_head[heads] = True
            is_head = is_head[at]
            self._learn(low[at[~is_head]], high[at[~is_head]], [c for c, h in zip(chunks, is_head.tolist(), strict=True) if not h])
            if is_head.any():
                own = [c for c, h in zip(chunks, is_head.tolist(), strict=True) if h]
                self._keep(low[at[is_head]], high[at[is_head]], self._lib(own), [bool(c) and not c[-1].isspace() for c in own])
            slot = self._find(low, high)
        n = self.n[slot].astype(np.int64)
        odd = np.flatnonzero(sums(n < 0, first)) if (n < 0).any() else []
        n = np.maximum(n, 0)
        lengths = sums(n, first)
        ids = np.zeros(0, np.uint32)
        if with_ids:
            take = np.repeat(self.at[slot] - (np.cumsum(n) - n), n)
            take += np.arange(len(take))
            ids = self.pool[take]
        if len(odd):  # these segments go to the library as they are
            whole = self._lib([("" if head[k] else self.lead) + data[seg_begin[k] : seg_end[k]].tobytes().decode("utf-8", "replace") for k in odd])
            parts, old = np.split(ids, np.cumsum(lengths)[:-1]) if with_ids else [], lengths
            lengths = old.copy()
            for k, x in zip(odd, whole, strict=True):
                lengths[k] = len(x)
                if with_ids:
                    parts[k] = np.array(x, np.uint32)
            ids = np.concatenate(parts) if with_ids else ids
        return lengths, ids


_ENCODERS: dict[str, ChunkEncoder] = {}


def encoder(path: str) -> ChunkEncoder:
    """One encoder per worker and file; Python workers are reused, and so is its table."""
    if path not in _ENCODERS:
        _ENCODERS[path] = ChunkEncoder(path)
    return _ENCODERS[path]


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def count_tokens(docs: DataFrame, tokenizer: str, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text", batch_bytes: int = 2 << 20) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every whole text; a null or empty text has 0 of both.

    Only lengths leave the worker. Batches hold up to batch_bytes of text, however many rows
    that is, so a few very long texts cost as much per batch as many short ones. No shuffle. Rows
    without an id, or that repeat one, are rows like any other, and further columns aren't read;
    no rows give none.
    tokenizer: path of a file of the tokenizers library, the same on all machines.
    """
    bound_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(tokenizer)
        for whole in batches:
            for b in by_bytes(whole, "text", batch_bytes):
                off, data = utf8(b.column("text"))
                n, _ = tool.encode(off, data, with_ids=False)
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(np.diff(off)), pa.array(n), pa.array(n > limit)], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.selectExpr(f"cast(`{id_col}` as long) doc_id", f"`{text_col}` text").mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
