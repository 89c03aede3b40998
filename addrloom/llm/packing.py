"""Best-fit packing of token pieces into sequences, refined by swaps between underfull bins."""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, by_bytes, stored, utf8
from .tokens import encoder

#: Tokens of a sequence; pieces that one task packs.
CAPACITY, GROUP = 4096, 40_000
PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: a document's ids and end_id, cut only where they exceed the capacity. No shuffle.

    A null or empty text is the end id alone; rows that repeat an id are pieces of their own; a null id stays null.
    """
    bound_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(tokenizer)
        for whole in batches:
            for b in by_bytes(whole, "text", 2 << 20):
                n, ids = tool.encode(*utf8(b.column("text")))
                raw = memoryview(np.insert(ids, np.cumsum(n), end_id).astype("<u4")).cast("B")
                n = n + 1
                count = -(-n // capacity)
                row = np.repeat(np.arange(len(n)), count)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
                start = piece * capacity
                length = np.minimum(capacity, n[row] - start)
                at = 4 * ((np.cumsum(n) - n)[row] + start)
                crc = [zlib.crc32(raw[x:y]) for x, y in zip(at.tolist(), (at + 4 * length).tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([b.column("doc_id").take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(start), pa.array(length), pa.array(crc, pa.int64())], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.selectExpr(f"cast(`{id_col}` as long) doc_id", f"`{text_col}` text").mapInArrow(run, PIECE)


def best_fit(lengths: np.ndarray, capacity: int = CAPACITY) -> np.ndarray:
    """Bin of each length: longest first, each into the fullest bin that still has room."""
    out = np.empty(len(lengths), np.int64)
    room: dict[int, list[int]] = defaultdict(list)
    mask = bins = 0  # bit r: some bin has r free
    for k, n in zip((order := np.argsort(-lengths, kind="stable")).tolist(), lengths[order].tolist(), strict=True):
        fits = mask >> n
        if fits:
            r = n + (fits & -fits).bit_length() - 1
            b = room[r].pop()
            if not room[r]:
                mask ^= 1 << r
        else:
            b, r, bins = bins, capacity, bins + 1
        out[k] = b
        if r > n:
            room[r - n].append(b)
            mask |= 1 << (r - n)
    return out


class _Underfull:
    """Underfull bins by gap, and by gap and length of a piece they hold; so a step is found without a look at each piece."""

    def __init__(self, capacity: int) -> None:
        self.bins: dict[int, dict[int, None]] = defaultdict(dict)
        self.holders: dict[int, dict[int, dict[int, None]]] = defaultdict(lambda: defaultdict(dict))
        self.mask = 0  # bit g: some bin has the gap g
        self.next = np.zeros((capacity + 1, capacity + 1), np.int32)  # [g, x]: the least length from x on in a bin of gap g, or 0; rows are touched when used
        self.stale: set[int] = set()

    def add(self, b: int, gap: int, lengths: dict[int, list[int]]) -> None:
        self.bins[gap][b] = None
        self.mask |= 1 << gap
        own = self.holders[gap]
        for n in lengths:
            if n not in own:
                self.stale.add(gap)
            own[n][b] = None

    def remove(self, b: int, gap: int, lengths: dict[int, list[int]]) -> None:
        del self.bins[gap][b]
        if not self.bins[gap]:
            del self.bins[gap]
            self.mask ^= 1 << gap
        own = self.holders[gap]
        for n in lengths:
            del own[n][b]
            if not own[n]:
                del own[n]
                self.stale.add(gap)

    def move(self, lengths: dict[int, list[int]], gap: int) -> tuple[tuple[int, ...], int, int] | None:
        """The longest piece of a bin with this gap that fits another which it leaves fuller than the first was, and the fullest such bin."""
        for n in sorted(lengths, reverse=True):
            fits = self.mask >> n
            if fits:
                g = n + (fits & -fits).bit_length() - 1
                if g < gap + n:
                    return (n,), 0, next(iter(self.bins[g]))
        return None

    def exchange(self, lengths: dict[int, list[int]], gap: int) -> tuple[tuple[int, ...], int, int] | None:
        """One or two pieces for a smaller one of another bin, which it leaves fuller than the first was; that with the most gain."""
        if not self.bins:
            return None
        for g in self.stale:
            held = np.array([*sorted(self.holders[g]), 0], np.int32)
            self.next[g] = held[np.searchsorted(held[:-1], np.arange(self.next.shape[1]))]
        self.stale.clear()
        n = sorted(lengths, reverse=True)
        own = {x: (x,) for x in n}
        for i, x in enumerate(n):
            for y in n[i if len(lengths[x]) > 1 else i + 1 :]:
                own.setdefault(x + y, (x, y))
        total = np.fromiter(own, np.int64, len(own))[:, None]
        gaps = np.fromiter(self.bins, np.int64, len(self.bins))[None, :]
        size = self.next[gaps, np.maximum(total - gaps, 1)]
        gain = np.where((size > 0) & (size < total) & (gaps < gap + total - size), total - size, 0)
        k, g = divmod(int(gain.argmax()), gain.shape[1])
        if not gain[k, g]:
            return None
        there = int(size[k, g])
        return own[int(total[k, 0])], there, next(iter(self.holders[int(gaps[0, g])][there]))


def refine(lengths: np.ndarray, where: np.ndarray, capacity: int = CAPACITY) -> np.ndarray:
    """Local search on a packing. Empties the emptiest bins by steps that raise the sum of squared fills.

    A step moves a piece of the bin into another underfull bin, or exchanges one or two of its
    pieces for one smaller piece there; the receiving bin gets fuller than the giving one was. The
    underfull bins are gone through from the emptiest on, again and again, until none allows a
    step, or the lower bound of bins is reached.
    """
    where = where.copy()
    fill = np.bincount(where, lengths).astype(np.int64).tolist()
    least, used = -(-int(lengths.sum()) // capacity), sum(n > 0 for n in fill)
    if used <= least:
        return where
    content: dict[int, dict[int, list[int]]] = defaultdict(dict)
    for k, (b, n) in enumerate(zip(where.tolist(), lengths.tolist(), strict=True)):
        if fill[b] < capacity:
            content[b].setdefault(n, []).append(k)
    index = _Underfull(capacity)
    for b, own in content.items():
        index.add(b, capacity - fill[b], own)

    def take(b: int, n: int) -> int:
        k = content[b][n].pop()
        if not content[b][n]:
            del content[b][n]
        fill[b] -= n
        return k

    def put(b: int, n: int, k: int) -> None:
        content[b].setdefault(n, []).append(k)
        fill[b] += n
        where[k] = b

    changed = True
    while changed:
        changed = False
        for low in sorted((b for b in content if 0 < fill[b] < capacity), key=lambda b: (fill[b], b)):
            if fill[low] == capacity:
                continue
            index.remove(low, capacity - fill[low], content[low])
            while fill[low]:
                gap = capacity - fill[low]
                step = index.move(content[low], gap) or index.exchange(content[low], gap)
                if step is None:
                    break
                mine, back, other = step
                index.remove(other, capacity - fill[other], content[other])
                if back:
                    k = take(other, back)
                for n in mine:
                    put(other, n, take(low, n))
                if back:
                    put(low, back, k)
                if fill[other] < capacity:
                    index.add(other, capacity - fill[other], content[other])
                changed = True
            if fill[low]:
                index.add(low, capacity - fill[low], content[low])
            else:
                used -= 1
                if used == least:
                    return where
    return where


def _pack(rows: DataFrame, group: int, number: int, capacity: int) -> DataFrame:
    """Packs stored piece rows in groups of about `group`, dealt evenly; adds sequence_id, offset and the bin's fill."""
    total = rows.count()
    groups = max(1, -(-total // group))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [b for b in batches if b.num_rows]
        if not got:
            return
        t = pa.Table.from_batches(got).combine_chunks()
        t = t.sort_by([("doc_id", "ascending"), ("piece", "ascending"), ("ids_crc32", "ascending")])
        n = np.asarray(t["length"])
        where = refine(n, best_fit(n, capacity), capacity)
        order = np.argsort(where, kind="stable")
        ends = np.cumsum(n[order])
        b = where[order]
        first = np.flatnonzero(np.diff(b, prepend=-1))
        begin = (ends - n[order])[first]
        offset = np.empty(len(n), np.int64)
        offset[order] = ends - n[order] - np.repeat(begin, np.diff(np.append(first, len(b))))
        fill = np.bincount(where, n).astype(np.int64)[where]
        seq = (np.int64(number) << 52) + (np.asarray(t["_g"]).astype(np.int64) << 24) + where
        t = t.drop_columns(["_g"]).append_column("sequence_id", pa.array(seq)).append_column("offset", pa.array(offset)).append_column("fill", pa.array(fill))
        yield from t.to_batches(max_chunksize=20_000)

    dealt = rows.withColumn("_g", F.pmod(F.monotonically_increasing_id(), F.lit(groups)).cast("int")) if groups > 1 else rows.withColumn("_g", F.lit(0))
    return dealt.repartitionById(groups, F.col("_g")).mapInArrow(run, PIECE + ", sequence_id long, offset long, fill long")


def pack(rows: DataFrame, capacity: int = CAPACITY, group: int = GROUP, full: float = 0.995) -> DataFrame:
    """sequence_id and offset for each piece; sequences are gapless from 0 and hold at most `capacity` tokens.

    Groups of pieces are packed apart; what their underfull bins hold is gathered and packed
    again, in fewer groups, so that the waste doesn't grow with the number of groups. Rounds go on
    until one group holds the rest, or until a round saves no bin: its bins are then left as they were.
    A bin filled to the part `full` counts as done. Of equal lengths the lesser id and piece goes
    first, so a group's packing depends on its pieces alone; pieces with null or repeated ids are
    pieces like any other, and an empty table gives an empty one.
    """
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    todo, done, number = stored(rows.select(columns)), [], 0
    rest, before = None, 0
    while True:
        many = todo.count() > group
        out = _pack(todo, group, number, capacity)
        if many or rest is not None:
            out = stored(out)
        if rest is not None and out.filter(F.col("offset") == 0).count() >= before:
            done.append(rest)
            break
        if not many:
            done.append(out)
            break
        done.append(out.filter(F.col("fill") >= full * capacity))
        rest = out.filter(F.col("fill") < full * capacity)
        before = rest.filter(F.col("offset") == 0).count()
        todo, number = stored(rest.select(columns)), number + 1
    result = done[0]
    for x in done[1:]:
        result = result.unionByName(x)
    return result.select(*columns, "sequence_id", "offset")
