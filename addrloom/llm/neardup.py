"""MinHash near-duplicates: banded candidates, sequential Bayesian pruning, exact verification.

Documents with equal words form a class; classes are compared by one member. Signatures
are cut into bands; classes that share a band are candidates. Of a pair's signatures batches are
compared one after another, and the pair is dropped as soon as the posterior probability that its
similarity reaches the threshold falls below MISS; every survivor is confirmed on both full
shingle sets. Candidates are tried in two rounds: first each bucket's members with the bucket's
least member, then, where a bucket still holds several components, all members of different ones.

Rows are named by their place in the stored sketches, texts by an MD5 digest and classes by a
BLAKE2 digest of their words, so neither null nor repeated ids matter. Links of the first round
are confirmed on the words themselves, those of the second by 64-bit keys of five words' keys.
Keys are made with a secret that is drawn anew for each run, so that nobody can write words or
shingles which share a key; by chance two given ones do once in 2**64.
"""

from __future__ import annotations

import secrets
from collections.abc import Iterator
from functools import reduce
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import words
from .common import bound_batches, by_bytes, stored, tidy, utf8
from .components import components

#: Words of a shingle; threshold as a fraction.
WORDS, ABOVE, BELOW = 5, 75, 100
#: Hash functions, of a band, of a batch of the comparison; probability of missing a pair that the comparison may have.
HASHES, ROWS, STEP, MISS = 128, 4, 16, 1e-6
BANDS = HASHES // ROWS
#: Members that are verified against one copy of a centre's text; members of a bucket that a tile holds on either side.
BLOCK, TILE = 64, 256
#: Parts of a component whose least ids are found apart.
PARTS = 256
#: Rows (of two numbers) up to which a counted table is broadcast.
SMALL = 100_000
#: Bytes of text whose shingles are made at once.
SLICE = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_RNG = np.random.Generator(np.random.PCG64(23))
_PLACE = _RNG.integers(1, 1 << 63, WORDS + 1, np.uint64) | np.uint64(1)
_LENGTH = np.arange(WORDS, dtype=np.uint64) * _PLACE[WORDS]
#: Bytes of two texts up to which they are compared as sets of word tuples; longer ones as sorted numbers.
TUPLES = 1 << 21
_TURN = _RNG.integers(1, 1 << 63, HASHES, np.uint64) | np.uint64(1)


def shingles(off: np.ndarray, data: np.ndarray, seed: int = 0) -> list[np.ndarray]:
    """The sorted 64-bit keys of each text's distinct shingles, keyed by the seed; a text of one to four words has one, one without words none."""
    key, first = words.word_keys(~_SPACE, _LOWER[data], off, seed)
    n = np.diff(first)
    if len(key) >= WORDS:
        run = reduce(np.add, (key[j : len(key) - WORDS + 1 + j] * _PLACE[j] for j in range(WORDS)))
        run = words.finish(run)
    out = []
    for a, k in zip(first.tolist(), n.tolist(), strict=False):
        if k >= WORDS:
            out.append(np.unique(run[a : a + k - WORDS + 1]))
        elif k:
            out.append(words.finish((key[a : a + k] * _PLACE[:k]).sum(dtype=np.uint64, keepdims=True) + _LENGTH[k]))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def signatures(sets: list[np.ndarray], together: int = 1 << 15) -> np.ndarray:
    """(texts, HASHES) 16-bit values. Rows of empty sets mean nothing."""
    out = np.zeros((len(sets), HASHES), np.uint64)
    full = [k for k, s in enumerate(sets) if len(s)]
    at = 0
    while at < len(full):
        size, to = 0, at
        while to < len(full) and (to == at or size + len(sets[full[to]]) <= together):
            size += len(sets[full[to]])
            to += 1
        own = full[at:to]
        flat = np.concatenate([sets[k] for k in own])
        begin = np.cumsum([0, *(len(sets[k]) for k in own[:-1])])
        turned = np.empty_like(flat)
        for h in range(HASHES):
            np.multiply(flat, _TURN[h], out=turned)
            out[own, h] = np.minimum.reduceat(turned, begin)
        at = to
    return (words.finish(out) >> np.uint64(48)).astype(np.uint16)


def exactly_linked(a: bytes, b: bytes) -> bool:
    """Whether 100 * intersection >= 75 * union of two texts' shingle sets, by the words themselves."""
    x, y = a.lower().split(), b.lower().split()  # of bytes: A to Z, and the six white-space bytes
    if len(a) + len(b) <= TUPLES:
        s, t = ({tuple(w)} if 0 < len(w) < WORDS else set(zip(*(w[k:] for k in range(WORDS)), strict=False)) for w in (x, y))
        both, either = len(s & t), len(s | t)
    else:
        number: dict[bytes, int] = {}
        u, v = (np.fromiter((number.setdefault(w, len(number)) for w in z), np.int64, len(z)) for z in (x, y))
        if min(len(u), len(v)) < WORDS:  # one word sequence as a whole equals no run of five words of another
            return len(u) == len(v) and bool((u == v).all())
        runs = np.concatenate([u, v])
        for k in range(1, WORDS):  # numbers of runs of k + 1 words
            p, q = (runs[: len(u) - k + 1], u), (runs[len(u) - k + 1 :], v)
            pair = np.concatenate([r[:-1] * len(number) + z[k:] for r, z in (p, q)])
            runs = np.unique(pair, return_inverse=True)[1].ravel()
        s, t = np.unique(runs[: len(u) - WORDS + 1]), np.unique(runs[len(u) - WORDS + 1 :])
        both = len(np.intersect1d(s, t, assume_unique=True))
        either = len(s) + len(t) - both
    return bool(either) and BELOW * both >= ABOVE * either


def text_key(text: Column) -> Column:
    """16 bytes that name a text, whatever ids its rows have."""
    return F.unhex(F.md5(F.coalesce(text.cast("string"), F.lit(""))))


def sketch(docs: DataFrame, seed: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, key (of the text), n (shingles), words (a digest of their sequence) and sig for each row; no shuffle.

    A null text counts as empty; texts without words have n = 0 and a signature without meaning.
    A long text's words are keyed slice by slice, so its arrays hold eight bytes a word.
    """
    bound_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in by_bytes(whole, "text", SLICE):
                off, data = utf8(b.column("text"))
                sets = shingles(off, data, seed)
                sig = np.ascontiguousarray(signatures(sets), ">u2")
                n = np.array([len(s) for s in sets], np.int64)
                own = [words.sequence_digest(data[x:y].tobytes()) for x, y in zip(off.tolist(), off[1:].tolist(), strict=False)]
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("key"), pa.array(n), pa.array(own, pa.binary()), pa.array([r.tobytes() for r in sig], pa.binary())], ["doc_id", "key", "n", "words", "sig"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.withColumn("key", text_key(F.col("text"))).mapInArrow(run, "doc_id long, key binary, n long, words binary, sig binary")


def least_matches(hashes: int = HASHES, step: int = STEP, miss: float = MISS, similarity: float = ABOVE / BELOW) -> np.ndarray:
    """After each batch, the fewest agreeing values of a pair that stays.

    With a uniform prior the similarity after m of n agreements is Beta(m + 1, n - m + 1); it
    exceeds t with the probability that a Binomial(n + 1, t) is at most m.
    """
    out = []
    for n in range(step, hashes + 1, step):
        tail, m = 0.0, -1
        while tail < miss:
            m += 1
            tail += comb(n + 1, m) * similarity**m * (1 - similarity) ** (n + 1 - m)
        out.append(m)
    return np.array(out)


_LEAST = least_matches()


def survivors(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which pairs of rows (n, HASHES) stay through all batches."""
    alive = np.arange(len(a))
    agree = np.zeros(len(a), np.int32)
    for k, least in enumerate(_LEAST):
        part = slice(k * STEP, (k + 1) * STEP)
        agree[alive] += (a[alive, part] == b[alive, part]).sum(axis=1, dtype=np.int32)
        alive = alive[agree[alive] >= least]
    return alive


def _rows(col: pa.Array) -> np.ndarray:
    _, data = utf8(col)
    return data.view(">u2").reshape(-1, HASHES)


def _dealt(pairs: DataFrame) -> DataFrame:
    """node, y, block and role (0: the centre y itself) for pairs (x, y): the pairs of a centre in blocks of at most BLOCK.

    Pairs are brought into ranges of (y, hash of x) and numbered within, so a centre with a third
    of all pairs spreads like any other; what follows is dealt out by block, never by centre.
    """
    own = pairs.repartitionByRange(F.col("y"), F.xxhash64("x")).sortWithinPartitions("y")
    members = stored(own.select(F.col("x").alias("node"), "y", F.floor(F.monotonically_increasing_id() / BLOCK).alias("block")))
    centres = members.select(F.col("y").alias("node"), "y", "block").distinct()
    return members.withColumn("role", F.lit(1)).unionByName(centres.withColumn("role", F.lit(0)))


def _by_block(rows: DataFrame) -> DataFrame:
    """A block's rows in one task, each centre before its members."""
    return rows.repartition("block").sortWithinPartitions("block", "y", "role", "node")


def _pruned(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """Pairs (x, y) whose sizes allow a link and whose signatures pass the sequential comparison."""
    rows = _by_block(_dealt(pairs).join(reps.select("node", "sig", "n").hint("merge"), "node").select("block", "y", "role", "node", "sig", "n"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sig, n = np.zeros((1, HASHES), ">u2"), np.zeros(1, np.int64)  # of the last centre so far
        for b in batches:
            role = np.asarray(b.column("role"))
            sig, n = np.concatenate([sig[-1:], _rows(b.column("sig"))]), np.concatenate([n[-1:], np.asarray(b.column("n"))])
            centre = np.maximum.accumulate(np.where(role == 0, np.arange(1, len(role) + 1), 0))
            at = np.flatnonzero(role == 1)
            low, high = np.minimum(n[at + 1], n[centre[at]]), np.maximum(n[at + 1], n[centre[at]])
            at = at[low * BELOW >= high * ABOVE]
            stay = pa.array(at[survivors(sig[at + 1], sig[centre[at]])])
            yield pa.RecordBatch.from_arrays([b.column("node").take(stay), b.column("y").take(stay)], ["x", "y"])
            if len(role):
                sig, n = sig[centre[-1] :][:1], n[centre[-1] :][:1]

    return rows.mapInArrow(run, "x long, y long")


def _texts_of(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """key and text, once each, for the keys and some others: a bitmap of 8 million bits (1 MB, whatever the number of keys) is broadcast.

    It only spares the shuffle rows that can't match; a join by key has to follow, which needs no
    further shuffle. Copies are put together before the shuffle, so those of one text are no hot key.
    """
    h = lambda c: F.xxhash64(c)
    part, bit = lambda c: F.pmod(h(c), F.lit(256)), lambda c: F.pmod(F.shiftright(h(c), 8), F.lit(32768))
    maps = keys.select(part("key").alias("_part"), bit("key").alias("_bit")).groupBy("_part").agg(F.expr("bitmap_construct_agg(_bit)").alias("_map"))
    x = docs.withColumn("_part", part("key")).join(F.broadcast(maps), "_part")
    place = bit("key")
    byte = F.conv(F.hex(F.expr("substring(_map, cast(_at as int) + 1, 1)")), 16, 10).cast("int")
    x = x.withColumn("_at", F.floor(place / 8)).withColumn("_one", F.pow(F.lit(2), place % 8).cast("int"))
    return x.filter(byte.bitwiseAND(F.col("_one")) != 0).groupBy("key").agg(F.first("text").alias("text"))


def confirmed(texts: DataFrame, reps: DataFrame, pairs: DataFrame, seed: int) -> DataFrame:
    """The stored pairs (x, y) for which 100 * intersection >= 75 * union on the full shingle sets, first by keys, then by the words themselves.

    texts: key and text of all rows; reps: node and the key of its text.
    """
    bound_batches(texts.sparkSession)
    wanted = stored(_dealt(pairs).join(reps.select("node", "key").hint("merge"), "node"))
    rows = _by_block(wanted.hint("merge").join(_texts_of(texts, wanted.select("key")), "key").select("block", "y", "role", "node", "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, keys, centre = None, np.zeros(0, np.uint64), b""
        for whole in batches:
            for b in by_bytes(whole, "text", SLICE):
                xs, ys = [], []
                off, data = utf8(b.column("text"))
                for k, (block, y, role, x, s) in enumerate(zip(*(b.column(c).to_pylist() for c in ("block", "y", "role", "node")), shingles(off, data, seed), strict=True)):
                    if role == 0:
                        now, keys, centre = (block, y), s, data[off[k] : off[k + 1]].tobytes()
                    elif now == (block, y) and len(s) and len(keys):
                        at = np.minimum(np.searchsorted(keys, s), len(keys) - 1)
                        both = int((keys[at] == s).sum())
                        if BELOW * both >= ABOVE * (len(s) + len(keys) - both) and exactly_linked(centre, data[off[k] : off[k + 1]].tobytes()):
                            xs.append(x)
                            ys.append(y)
                yield pa.RecordBatch.from_arrays([pa.array(xs, pa.int64()), pa.array(ys, pa.int64())], ["u", "v"])

    return rows.mapInArrow(run, "u long, v long")


def _full_sets(texts: DataFrame, nodes: DataFrame, seed: int) -> DataFrame:
    """node and the shingle set (sorted 64-bit keys as bytes) of the nodes (with their keys)."""
    rows = nodes.hint("merge").join(_texts_of(texts, nodes.select("key")), "key").select("node", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in by_bytes(whole, "text", SLICE):
                yield pa.RecordBatch.from_arrays([b.column("node"), pa.array([s.tobytes() for s in shingles(*utf8(b.column("text")), seed)], pa.binary())], ["node", "keys"])

    return rows.mapInArrow(run, "node long, keys binary")


class _Side:
    """Members of a tile: ids, components, signatures and full sets."""

    def __init__(self, parts: list[pa.RecordBatch]) -> None:
        self.id, self.comp = (np.concatenate([np.asarray(p.column(c)) for p in parts]) for c in ("node", "comp"))
        self.sig = np.concatenate([_rows(p.column("sig")) for p in parts])
        data = [utf8(p.column("keys")) for p in parts]
        self.n = np.concatenate([np.diff(off) for off, _ in data]) // 8
        self.keys = np.concatenate([np.frombuffer(d.tobytes(), np.uint64) for _, d in data])
        self.end = np.cumsum(self.n)


def _tile_links(a: _Side, b: _Side) -> list[tuple[int, int]]:
    """Links between members of a and of b that join components, as many as a forest of them has.

    Signatures are compared first, batch by batch; the survivors' intersections with a member's
    full set are then counted in one pass. A member of a component that is already joined with
    the other's isn't compared again.
    """
    root = {int(c): int(c) for c in np.concatenate([a.comp, b.comp])}

    def find(c: int) -> int:
        while root[c] != c:
            root[c] = c = root[root[c]]
        return c

    names, number = np.unique(b.keys, return_inverse=True)
    mark = np.zeros(len(names) + 1, bool)
    group = np.array([find(int(c)) for c in b.comp])
    links: list[tuple[int, int]] = []
    for k in range(len(a.id)):
        own = find(int(a.comp[k]))
        at = np.flatnonzero((group != own) & (np.minimum(b.n, a.n[k]) * BELOW >= np.maximum(b.n, a.n[k]) * ABOVE))
        if not len(at):
            continue
        at = at[survivors(np.broadcast_to(a.sig[k], (len(at), HASHES)), b.sig[at])]
        if not len(at):
            continue
        keys = a.keys[a.end[k] - a.n[k] : a.end[k]]
        place = np.minimum(np.searchsorted(names, keys), len(names) - 1)
        place = place[names[place] == keys]
        mark[place] = True
        n = b.n[at]
        take = np.repeat(b.end[at] - n - (np.cumsum(n) - n), n) + np.arange(n.sum())
        both = np.add.reduceat(mark[number[take]], np.cumsum(n) - n, dtype=np.int64)
        mark[place] = False
        for y in at[BELOW * both >= ABOVE * (n + a.n[k] - both)].tolist():
            other = find(int(b.comp[y]))
            own = find(own)
            if other != own:
                links.append((int(a.id[k]), int(b.id[y])))
                low, high = sorted((own, other))
                root[high] = low
                group[(group == high)] = low
    return links


def _cross(texts: DataFrame, members: DataFrame, reps: DataFrame, comps: DataFrame, seed: int) -> DataFrame:
    """Links (u, v) that join components within buckets which hold several.

    In each bucket the members outside its largest component (the left side) are compared with
    all members, in tiles of TILE on either side, so a bucket of any size is dealt over many
    tasks. A tile gets its members' signatures and full shingle sets and returns no more links
    than it joins components.
    """
    m = members.join(comps.hint("merge"), "node", "left").withColumn("comp", F.coalesce("component", "node")).drop("component")
    count = m.groupBy("bucket", "comp").agg(F.count(F.lit(1)).alias("size"))
    open_ = count.groupBy("bucket").agg(F.sum("size").alias("all"), F.max(F.struct("size", "comp")).alias("top"), F.count(F.lit(1)).alias("comps")).filter("comps > 1 and `all` > 2")
    open_ = open_.select("bucket", F.col("top.comp").alias("main"), F.ceil((F.col("all") - F.col("top.size")) / TILE).cast("int").alias("lefts"), F.ceil(F.col("all") / TILE).cast("int").alias("rights"))
    m = stored(m.join(open_.hint("merge"), "bucket"))
    sets = _full_sets(texts, m.select("node").distinct().join(reps.select("node", "key").hint("merge"), "node"), seed)
    m = m.join(sets.join(reps.select("node", "sig").hint("merge"), "node").hint("merge"), "node")
    h = F.xxhash64("node")
    spread = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    columns = ["bucket", "i", "j", "side", "node", "comp", "sig", "keys"]
    # Each member takes its places as right side (one for each block of the left) and, outside the largest component, as left side.
    right = F.transform(spread("lefts"), lambda i: F.struct(i.alias("i"), F.pmod(h, F.col("rights")).cast("int").alias("j"), F.lit(1).alias("side")))
    left = F.transform(spread("rights"), lambda j: F.struct(F.pmod(h, F.col("lefts")).cast("int").alias("i"), j.alias("j"), F.lit(0).alias("side")))
    places = F.when(F.col("comp") == F.col("main"), right).otherwise(F.concat(right, left))
    x = m.select("bucket", "node", "comp", "sig", "keys", F.inline(places)).select(*columns)
    x = x.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j", "side", "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: tuple | None = None
        sides: list[list[pa.RecordBatch]] = [[], []]

        def done() -> Iterator[pa.RecordBatch]:
            if sides[0] and sides[1]:
                links = _tile_links(_Side(sides[0]), _Side(sides[1]))
                if links:
                    yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in links], pa.int64()), pa.array([y for _, y in links], pa.int64())], ["u", "v"])
            sides[0].clear()
            sides[1].clear()

        for b in batches:
            keys = list(zip(*(b.column(c).to_pylist() for c in columns[:4]), strict=True))
            at = 0
            while at < len(keys):
                to = at
                while to < len(keys) and keys[to] == keys[at]:
                    to += 1
                if keys[at][:3] != now:
                    yield from done()
                    now = keys[at][:3]
                sides[keys[at][3]].append(b.slice(at, to - at))
                at = to
        yield from done()

    return x.mapInArrow(run, "u long, v long")


def grouped(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, key (of the text), n_shingles, component (names the group of near-duplicates; null without shingles), component_id and kept for every row. Null and repeated ids, empty texts and tables as in `near_duplicates`."""
    tidy(docs.sparkSession)
    texts = docs.select(text_key(F.col(text_col)).alias("key"), F.col(text_col).cast("string").alias("text"))
    seed = secrets.randbits(63) | 1 << 63
    every = stored(sketch(docs, seed, id_col, text_col).withColumn("node", F.monotonically_increasing_id()))
    full = every.filter("n > 0")
    classes = stored(full.groupBy("words").agg(F.min(F.struct("node", "key", "n", "sig")).alias("first"), F.min("doc_id").alias("least")).select("words", "first.*", "least"))
    reps = classes.select("node", "key", "n", "sig")
    band = lambda k: F.xxhash64(F.lit(k), F.expr(f"substring(sig, {2 * ROWS * k + 1}, {2 * ROWS})"))
    bands = reps.select("node", F.explode(F.array(*(band(k) for k in range(BANDS)))).alias("bucket"))
    centres = bands.groupBy("bucket").agg(F.min("node").alias("centre"), F.count(F.lit(1)).alias("many")).filter("many > 1").drop("many")
    members = stored(bands.join(centres.hint("merge"), "bucket"))
    tidy(docs.sparkSession)
    first = members.filter("node <> centre").select(F.col("node").alias("x"), F.col("centre").alias("y")).distinct()
    pairs = stored(_pruned(stored(first), reps))
    tidy(docs.sparkSession)
    links = stored(confirmed(texts, reps, pairs, seed).distinct())
    tidy(docs.sparkSession)
    comps = stored(components(links))
    more = stored(_cross(texts, members.drop("centre"), reps, comps, seed).distinct())
    tidy(docs.sparkSession)
    if not more.isEmpty():
        # Components of the components that these links join, and from them those of the nodes.
        of = comps.select(F.col("node").alias("_node"), "component")
        end = lambda x, c: x.join(of.hint("merge"), F.col(c) == F.col("_node"), "left").withColumn(c, F.coalesce("component", c)).select("u", "v")
        over = stored(components(stored(end(end(more, "u"), "v"))))
        least = over.select(F.col("node").alias("_of"), F.col("component").alias("_least"))
        least = F.broadcast(least) if over.count() <= SMALL else least.hint("merge")
        joined = comps.join(least, F.col("component") == F.col("_of"), "left").select("node", F.coalesce("_least", "component").alias("component"))
        lone = over.join(comps.select("node").hint("merge"), "node", "left_anti").select("node", "component")
        comps = stored(joined.unionByName(lone))
    # The least id of a component, of any size: by parts of it, then of the parts, then back to the parts.
    own = stored(comps.hint("merge").join(classes.select("node", "least"), "node").withColumn("part", F.pmod(F.xxhash64("node"), F.lit(PARTS))))
    parts = own.groupBy("component", "part").agg(F.min("least").alias("least"))
    parts = parts.select("component", "part").join(parts.groupBy("component").agg(F.min("least").alias("_least")).hint("merge"), "component")
    named = own.join(parts.hint("merge"), ["component", "part"]).select("node", "component", "_least")
    labels = classes.select("words", "node", "least").join(named.hint("merge"), "node", "left")
    labels = labels.select("words", F.coalesce("component", "node").alias("component"), F.coalesce("_least", "least").alias("component_id"))
    grouped_ = full.select("doc_id", "key", "words", "n").join(labels.hint("merge"), "words").select("doc_id", "key", F.col("n").alias("n_shingles"), "component", "component_id")
    # Rows without words, however many, are joined with nothing.
    bare = every.filter("n = 0").select("doc_id", "key", F.col("n").alias("n_shingles"), F.lit(None).cast("long").alias("component"), F.col("doc_id").alias("component_id"))
    return grouped_.unionByName(bare).withColumn("kept", F.col("component_id").eqNullSafe(F.col("doc_id")))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row.

    component_id is the least doc_id reachable over links of 100 * intersection >= 75 * union,
    itself included. A null or empty text, or one without words, has n_shingles 0 and is linked
    with nothing. Links are those of the texts: a row without an id takes the least id of its
    component, or null where no row of that has one. Rows that share an id are in one component
    only if their texts are, and then are all kept or all not; unlinked texts under one id are rows
    of their own, each with the least id of its component, so both may be kept. Columns besides
    id_col and text_col are not read; an empty table gives an empty one.
    """
    return grouped(docs, id_col, text_col).select("doc_id", "n_shingles", "component_id", "kept")
