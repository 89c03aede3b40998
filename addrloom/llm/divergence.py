"""Source divergence audit: how far the term shares of a language's sources lie apart, in whole numbers.

Terms are counted once per group (language, source); a language keeps those in at least LEAST of
its documents. Its kept terms are dealt in blocks and its sources in blocks, and each pair of
them is a dense tile, an int64 matrix of counts. A tile's shares are set against each other tile's
of its term block by broadcasting, all pairs of groups at once; the sums over a block's terms are
partial matrices of pairs, which are added up, and each task's heaps of a group's highest terms
are merged.

All numbers are whole: a share is 1 + floor(SCALE * (count + 1) / (N + V)) of the group's N
occurrences of V kept terms, and the divergence of p from q is floor((p - q)**2 / q). Sums stay
below 2**63 as shares sum to about SCALE.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import bound_batches, stored, utf8

#: Documents of its language that a kept term is in; scale of a share, taken in STEPS digits' groups of 1000; terms that a group reports.
LEAST, SCALE, STEPS, REPORTED = 3, 10**9, 3, 200
#: Terms and sources of a tile; different terms that a task counts before it gives them on; bytes of a piece of text.
TERMS, SOURCES, HELD, PIECE = 256, 64, 800_000, 1 << 20
#: Terms are runs of letters and of bytes from 0x80 on; A to Z are lower-cased, all other bytes part them.
FOLD = bytes(b if b >= 0x80 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))

COUNTS = "lang string, source string, term binary, doc long, n long, docs long"
COLUMNS = [c.split()[0] for c in COUNTS.split(", ")]


def pieces(text: bytes, limit: int = PIECE) -> Iterator[bytes]:
    """The folded text in pieces of up to limit bytes, cut at spaces; a longer term is a piece of its own."""
    text = text.translate(FOLD)
    at = 0
    while at < len(text):
        to = at + limit
        if to < len(text):
            cut = text.rfind(b" ", at, to)
            cut = text.find(b" ", to) if cut <= at else cut
            to = len(text) if cut < 0 else cut
        yield text[at:to]
        at = to


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences of a group's terms and documents that hold them, summed over what a task has read since it last gave them on. A text of several pieces gives each piece's terms on with a number of its own (doc), so that its documents are counted later; a group's row without a term says that it occurs."""
    n, docs, groups, held = {}, {}, set(), 0

    def given() -> Iterator[pa.RecordBatch]:
        for g, own in n.items():
            yield from _batches(g, own, None, docs[g])

    for b in batches:
        off, data = utf8(b.column("text"))
        raw, off = data.tobytes(), off.tolist()
        for lang, source, doc, at, to in zip(b.column("lang").to_pylist(), b.column("source").to_pylist(), b.column("doc").to_pylist(), off, off[1:], strict=False):
            g = (lang, source)
            groups.add(g)
            if to - at > PIECE:
                for piece in pieces(raw[at:to]):
                    yield from _batches(g, Counter(piece.split()), doc, None)
                continue
            own = n.get(g)
            if own is None:
                own, docs[g] = n.setdefault(g, Counter()), Counter()
            words = raw[at:to].translate(FOLD).split()
            before = len(own)
            own.update(words)
            docs[g].update(set(words))
            held += len(own) - before
            if held > HELD:
                yield from given()
                n, docs, held = {}, {}, 0
        if len(groups) > HELD:
            yield from _named(groups)
            groups = set()
    yield from given()
    yield from _named(groups)


def _batches(group: tuple[str, str], counts: Counter[bytes], doc: int | None, docs: Counter[bytes] | None) -> Iterator[pa.RecordBatch]:
    """A group's counts, in batches of 16,384 terms."""
    size = len(counts)
    terms, n = pa.array(counts.keys(), pa.binary(), size=size), pa.array(counts.values(), pa.int64(), size=size)
    seen = pa.array(map(docs.__getitem__, counts), pa.int64(), size=size) if docs is not None else pa.repeat(pa.scalar(0, pa.int64()), size)
    same = [pa.repeat(pa.scalar(x, kind), size) for x, kind in ((group[0], pa.string()), (group[1], pa.string()), (doc, pa.int64()))]
    whole = pa.RecordBatch.from_arrays([*same[:2], terms, same[2], n, seen], COLUMNS)
    for at in range(0, size, 1 << 14):
        yield whole.slice(at, 1 << 14)


def _named(groups: set[tuple[str, str]]) -> Iterator[pa.RecordBatch]:
    if groups:
        lang, source = zip(*groups, strict=True)
        zeros = pa.array([0] * len(lang), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(lang), pa.array(source), pa.nulls(len(lang), pa.binary()), pa.nulls(len(lang), pa.int64()), zeros, zeros], COLUMNS)


def term_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> tuple[DataFrame, DataFrame]:
    """Counts (lang, source, term, n, docs) and groups (lang, source): every group that occurs. Nulls are ''; a row is a document, whatever its id."""
    bound_batches(docs.sparkSession)
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = docs.select(text(lang_col).alias("lang"), text(source_col).alias("source"), F.monotonically_increasing_id().alias("doc"), text(text_col).alias("text"))
    part = stored(rows.mapInArrow(_counted, COUNTS), compression="zstd")
    groups = part.filter("term is null").select("lang", "source").distinct()
    key = ["lang", "source", "term"]
    long = part.filter("doc is not null").groupBy(*key, "doc").agg(F.sum("n").alias("n")).select(*key, "n", F.lit(1).cast("long").alias("docs"))
    counts = part.filter("term is not null and doc is null").select(*key, "n", "docs").unionByName(long).groupBy(*key).agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    return counts, groups


def shares(counts: np.ndarray, below: np.ndarray | int) -> np.ndarray:
    """1 + floor(SCALE * (counts + 1) / below), exact in int64 for counts below 2**53: digits are divided out three at a time."""
    rest, out = counts + 1, np.zeros(np.broadcast(counts, below).shape, np.int64)
    for _ in range(STEPS):
        rest = rest * 1000
        out = out * 1000 + rest // below
        rest = rest % below
    return out + 1


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


class _Cells:
    """A batch's lists of cells as arrays."""

    def __init__(self, col: pa.ListArray):
        self.at, self.size = np.asarray(col.offsets), np.asarray(col.value_lengths().fill_null(0))
        self.columns = [np.asarray(col.values.field(k)) for k in range(3)]

    def tile(self, row: int, places: int, sources: dict) -> tuple[np.ndarray, np.ndarray]:
        """Counts and shares of a row's block of sources by its block of terms."""
        n = np.zeros((len(sources["names"]), places), np.int64)
        at = self.at[row]
        source, term, count = (c[at : at + self.size[row]] for c in self.columns)
        n[source, term] = count
        return n, shares(n, np.asarray(sources["below"], np.int64)[:, None])


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial matrices of pairs, added up over the tiles of a task, and its heaps of the highest terms."""
    matrices: dict[tuple, tuple[list, list, np.ndarray]] = {}
    heaps: dict[tuple, list] = {}

    def pairs() -> Iterator[pa.RecordBatch]:
        for (lang, _, _), (a, b, m) in matrices.items():
            g, h = (x.ravel() for x in np.indices(m.shape))
            other = np.array([x != y for x in a for y in b]) if len(a) and len(b) else np.zeros(0, bool)
            yield _found(lang, "pair", [a[k] for k in g[other]], [b[k] for k in h[other]], m.ravel()[other])

    for batch in batches:
        cells_a, cells_b = _Cells(batch.column("cells_a")), _Cells(batch.column("cells_b"))
        for row, x in enumerate(batch.drop_columns(["cells_a", "cells_b"]).to_pylist()):
            a, b, terms = x["a"], x["b"], x["terms"]
            n, p = cells_a.tile(row, len(terms), a)
            if x["sa"] == x["sb"]:
                of_lang = shares(np.asarray(x["lang_n"], np.int64), x["lang_below"])
                for k, name in enumerate(a["names"]):
                    at = np.flatnonzero((n[k] > 0) & (p[k] > of_lang))
                    value = divergence(p[k, at], of_lang[at]).tolist()
                    heap = heaps.setdefault((x["lang"], name), [])
                    heap += [(-v, terms[t]) for v, t in zip(value, at.tolist(), strict=True)]
                    heap.sort()
                    del heap[REPORTED:]
                q = p
            else:
                _, q = cells_b.tile(row, len(terms), b)
            for key, one, other, u, w in (((x["lang"], x["sa"], x["sb"]), a, b, p, q), ((x["lang"], x["sb"], x["sa"]), b, a, q, p)):
                total = divergence(u[:, None, :], w[None, :, :]).sum(2)
                held = matrices.get(key)
                matrices[key] = (one["names"], other["names"], total if held is None else held[2] + total)
                if x["sa"] == x["sb"]:
                    break
        if len(matrices) > 256:
            yield from pairs()
            matrices = {}
        if len(heaps) > 4096:
            yield from _heaps(heaps)
            heaps = {}
    yield from pairs()
    yield from _heaps(heaps)


def _heaps(heaps: dict[tuple, list]) -> Iterator[pa.RecordBatch]:
    for (lang, name), heap in heaps.items():
        yield _found(lang, "term", [name] * len(heap), [t.decode() for _, t in heap], np.array([-v for v, _ in heap], np.int64))


def _found(lang: str, part: str, source: list[str], item: list[str], value: np.ndarray) -> pa.RecordBatch:
    n = len(source)
    return pa.RecordBatch.from_arrays([pa.array([lang] * n, pa.string()), pa.array(source, pa.string()), pa.array([part] * n, pa.string()), pa.array(item, pa.string()), pa.array(value, pa.int64())], ["lang", "source", "part", "item", "value"])


def audit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """lang, source, part, item, value, rank: of each group its divergence from every other source of its language (pair), and its REPORTED terms that stand out most against the language (term).

    Null texts, languages and sources are ''. Ranks count from 1 by value, then by the item's
    bytes. A language without kept terms has pairs of value 0 and no terms; a group without terms
    has its pairs. Rows that repeat an id are documents of their own; no rows give none.
    """
    counts, groups = term_counts(docs, text_col, lang_col, source_col)
    counts = stored(counts, compression="zstd")
    terms = counts.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs")).filter(F.col("docs") >= LEAST).drop("docs")
    terms = stored(terms, compression="zstd")
    langs = stored(terms.groupBy("lang").agg(F.count(F.lit(1)).alias("V"), F.sum("lang_n").alias("lang_total")))  # of known size, so that few languages are no reason for a shuffle

    def block(c: str, size: int, many: str):
        return F.pmod(F.xxhash64(c), F.greatest(F.lit(1), F.ceil(F.col(many) / size)))

    # blocks of terms and of sources: a place within a block is what a tile's rows and columns are
    placed = terms.join(langs, "lang").withColumn("tb", block("term", TERMS, "V"))
    placed = stored(placed.withColumn("tp", F.row_number().over(Window.partitionBy("lang", "tb").orderBy("term")) - 1), compression="zstd")
    many = groups.groupBy("lang").agg(F.count(F.lit(1)).alias("S"))
    places = groups.join(many, "lang").withColumn("sb", block("source", SOURCES, "S")).drop("S")
    places = stored(places.withColumn("sp", F.row_number().over(Window.partitionBy("lang", "sb").orderBy("source")) - 1))
    cells = counts.drop("docs").join(placed.select("lang", "term", "tb", "tp"), ["lang", "term"]).join(places, ["lang", "source"])
    cells = stored(cells.select("lang", "source", "sb", "sp", "tb", "tp", "n"), compression="zstd")
    sizes = cells.groupBy("lang", "source").agg(F.sum("n").alias("N"))
    own = places.join(sizes, ["lang", "source"], "left").join(langs, "lang", "left")
    own = stored(own.select("lang", "source", F.coalesce("N", F.lit(0)).alias("N"), F.coalesce("V", F.lit(0)).alias("V"), "sb", "sp"))

    listed = lambda *c: F.array_sort(F.collect_list(F.struct(*c)))
    term_blocks = placed.groupBy("lang", "tb", "V", "lang_total").agg(listed("tp", "term", "lang_n").alias("t"))
    term_blocks = term_blocks.select("lang", "tb", F.col("t.term").alias("terms"), F.col("t.lang_n").alias("lang_n"), (F.col("lang_total") + F.col("V")).alias("lang_below"))
    source_blocks = own.filter("V > 0").groupBy("lang", "sb").agg(listed("sp", "source", "N", "V").alias("s"))
    source_blocks = stored(source_blocks.select("lang", "sb", F.struct(F.col("s.source").alias("names"), F.transform("s", lambda x: x["N"] + x["V"]).alias("below")).alias("s")))
    tiles = cells.groupBy("lang", "tb", "sb").agg(F.collect_list(F.struct("sp", "tp", "n")).alias("cells"))
    tiles = stored(tiles, compression="zstd")

    side = lambda x: source_blocks.select("lang", F.col("sb").alias(f"s{x}"), F.col("s").alias(x))
    cells_of = lambda x: tiles.select("lang", "tb", F.col("sb").alias(f"s{x}"), F.col("cells").alias(f"cells_{x}"))
    two = side("a").join(side("b"), "lang").filter("sa <= sb")  # of blocks, not of sources
    work = term_blocks.join(two, "lang").join(cells_of("a"), ["lang", "tb", "sa"], "left").join(cells_of("b"), ["lang", "tb", "sb"], "left")
    made = stored(work.mapInArrow(_compared, "lang string, source string, part string, item string, value long"), compression="zstd")

    bare = own.filter("V = 0").select("lang", "source")
    none = bare.join(bare.withColumnRenamed("source", "item"), "lang").filter("source <> item").select("lang", "source", F.lit("pair").alias("part"), "item", F.lit(0).cast("long").alias("value"))
    pairs = made.filter("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value")).unionByName(none)
    rank = F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(F.col("value").desc(), "item"))
    ranked = lambda df: df.withColumn("rank", rank.cast("int"))
    top = ranked(made.filter("part = 'term'")).filter(F.col("rank") <= REPORTED)
    return ranked(pairs).unionByName(top)
