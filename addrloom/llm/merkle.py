"""Merkle manifest of a dataset: authentication paths by traversal scheduling over aligned blocks.

Each row is a leaf; a source's leaves, ascending by id, form a tree in which every three
consecutive nodes become their hash, and the sources' roots form another such tree above. Leaves
are cut into aligned blocks of SPAN, a power of three. Within a block the paths are advanced leaf
by leaf: for each level the current run of three nodes is held, and a treehash stack makes the
next run while the leaves under the current one pass, so that a block's state is logarithmic in
its leaves. The roots of blocks are the leaves of the next round, until a source has one node;
what a block's leaves share above it is appended to their paths.

Texts are hashed where they are read; only ids, sources and digests are shuffled. Digests are
hashed as their 64 lowercase hexadecimal digits; paths hold them as 32 bytes each.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bound_batches, stored

#: Children of a node; levels and leaves of an aligned block.
ARITY, LEVELS = 3, 7
SPAN = ARITY**LEVELS


def node(children: list[bytes]) -> bytes:
    return sha256(b"".join(children)).hexdigest().encode()


def field(value: Column) -> Column:
    """`-` if null, else the value's UTF-8 byte count, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(columns: list[Column]) -> Column:
    return F.sha2(F.concat(*(field(c) for c in columns)), 256)


class Treehash:
    """Takes leaves one by one and gives the nodes of a height, with fewer than three pending nodes a level."""

    def __init__(self, height: int):
        self.pending: list[list[bytes]] = [[] for _ in range(height)]
        self.nodes: list[bytes] = []

    def _above(self, level: int, digest: bytes) -> None:
        while level < len(self.pending):
            held = self.pending[level]
            held.append(digest)
            if len(held) < ARITY:
                return
            digest, level = node(held), level + 1
            held.clear()
        self.nodes.append(digest)

    def add(self, digest: bytes) -> None:
        self._above(0, digest)

    def close(self) -> list[bytes]:
        """No leaf follows: runs that are not full, even of one, become their hash."""
        for level, held in enumerate(self.pending):
            if held:
                digest = node(held)
                held.clear()
                self._above(level + 1, digest)
        return self.nodes


def traverse(leaves: list[bytes], height: int) -> Iterator[tuple[bytes, bytes]]:
    """The siblings of each leaf in order, level by level below the root, joined; and the root.

    Level h holds the run of up to three nodes of height h above the present leaf. Its successor
    is made by a treehash that takes one leaf for each leaf that passes: both take as long.
    """
    n = len(leaves)
    width = [ARITY ** (h + 1) for h in range(height)]
    hashes = [Treehash(h) for h in range(height)]
    top = Treehash(height)
    for k, x in enumerate(leaves):  # the first runs, and the root, in one pass
        top.add(x)
        for h in range(height):
            if k < width[h]:
                hashes[h].add(x)
    root = top.close()[0]
    runs = [t.close() for t in hashes]
    hashes = [Treehash(h) for h in range(height)]
    for k in range(n):
        out, place = [], k
        for run in runs:
            own = place % ARITY
            out += run[:own] + run[own + 1 :]
            place //= ARITY
        yield bytes.fromhex(b"".join(out).decode()), root
        for h in range(height):
            if (ahead := k + width[h]) < n:
                hashes[h].add(leaves[ahead])
            if (k + 1) % width[h] == 0:
                runs[h], hashes[h] = hashes[h].close(), Treehash(h)


def height_of(leaves: int) -> int:
    """Levels above that many leaves: none above one."""
    h = 0
    while leaves > 1:
        leaves, h = -(-leaves // ARITY), h + 1
    return h


def fold(digest: bytes, siblings: bytes, place: int, leaves: int) -> tuple[bytes, bytes]:
    """The root that a leaf at a place and its path give, and the rest of the path."""
    at = 0
    while leaves > 1:
        own, count = place % ARITY, min(ARITY, leaves - place // ARITY * ARITY)
        run = [siblings[at + 32 * k : at + 32 * k + 32].hex().encode() for k in range(count - 1)]
        at += 32 * len(run)
        run.insert(own, digest)
        digest, place, leaves = node(run), place // ARITY, -(-leaves // ARITY)
    return digest, siblings[at:]


def leaves(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", fields: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"), text_col: str = "text") -> DataFrame:
    """doc_id, source, leaf and tampered: the leaf of the same row without line feeds in its text, where 2 divides the CRC-32 of the id's decimals, else null. One pass over the texts."""
    named = [F.col(c) for c in fields]
    bare = [F.translate(F.col(c), "\n", "") if c == text_col else F.col(c) for c in fields]
    chosen = F.crc32(F.col(id_col).cast("string").cast("binary")) % 2 == 0
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"), leaf(named).alias("leaf"), F.when(chosen, leaf(bare)).alias("tampered"))


def _placed(rows: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """Adds place (from 0) and total within each key, for rows ordered by key (null first) and order.

    Rows are sorted in ranges, which cut a large key as well. A range's places follow those of
    the same key in ranges before: the driver sees one row a range, and that is what is broadcast.
    """
    sort = [F.col(key).asc_nulls_first(), *order]
    own = stored(rows.repartitionByRange(*sort).sortWithinPartitions(*sort).withColumn("_at", F.monotonically_increasing_id()), compression="zstd")
    part = F.shiftright("_at", 33).alias("_p")
    runs = stored(own.groupBy(part, F.col(key)).agg(F.count(F.lit(1)).alias("n"), F.min("_at").alias("first")))
    mark = F.struct(F.col(key).isNotNull().alias("some"), F.col(key).alias("k"))
    ends = runs.groupBy("_p").agg(F.min(mark).alias("low"), F.max(mark).alias("high"), F.max_by("n", mark).alias("n_high"))
    before, carried, last = [], 0, None
    for r in sorted(ends.collect(), key=lambda r: r["_p"]):
        base = carried if last == r["low"] else 0
        before.append((r["_p"], base))
        carried, last = (base if r["low"] == r["high"] else 0) + r["n_high"], r["high"]
    base = own.sparkSession.createDataFrame(before, "_p long, _base long")
    totals = runs.groupBy(F.col(key).alias("_k")).agg(F.sum("n").alias("total"))
    # the first run of a range goes on where the range before ended; all others start at 0
    heads = runs.join(F.broadcast(base), "_p").withColumn("_base", F.when(F.col("first").bitwiseAND(F.lit((1 << 33) - 1)) == 0, F.col("_base")).otherwise(F.lit(0)))
    heads = heads.join(totals, F.col(key).eqNullSafe(F.col("_k"))).select(F.col("_p"), F.col(key).alias("_k"), F.col("first").alias("_first"), "_base", "total")
    out = own.withColumn("_q", F.shiftright("_at", 33)).join(heads, (F.col("_q") == F.col("_p")) & F.col(key).eqNullSafe(F.col("_k")))
    return out.withColumn("place", F.col("_at") - F.col("_first") + F.col("_base")).drop("_at", "_q", "_p", "_k", "_first", "_base")


def _round(nodes: DataFrame, key: str) -> DataFrame:
    """Adds to nodes (key, place, total, digest, whatever else) the siblings within their blocks and the block's root: one task's group is at most SPAN nodes."""
    names = nodes.columns

    def run(group: pa.Table) -> pa.Table:
        group = group.take(pa.array(np.argsort(group.column("place").to_numpy(), kind="stable")))
        height = LEVELS if group.column("total")[0].as_py() > SPAN else height_of(group.num_rows)
        paths, roots = zip(*traverse([x.encode() for x in group.column("digest").to_pylist()], height), strict=True)
        return pa.table([*(group.column(c) for c in names), pa.array(paths, pa.binary()), pa.array([r.decode() for r in roots], pa.string())], names=[*names, "path", "above"])

    schema = T.StructType([*nodes.schema.fields, T.StructField("path", T.BinaryType()), T.StructField("above", T.StringType())])
    return nodes.withColumn("_block", _block()).groupBy(key, "_block").applyInArrow(run, schema)


def _block() -> Column:
    return F.floor(F.col("place") / SPAN).cast("long")


def authenticate(nodes: DataFrame, key: str) -> DataFrame:
    """Adds path and root to nodes (key, place, total, digest, whatever else): in rounds over blocks, whose roots are the next round's nodes, while a key has more than one."""
    most = nodes.agg(F.max("total")).first()[0] or 0
    below = stored(_round(nodes, key), compression="zstd")
    if most <= SPAN:
        return below.withColumnRenamed("above", "root")
    blocks = below.filter(F.col("place") % SPAN == 0).select(key, _block().alias("place"), F.ceil(F.col("total") / SPAN).cast("long").alias("total"), F.col("above").alias("digest"))
    upper = authenticate(stored(blocks), key).select(F.col(key).alias("_k"), F.col("place").alias("_b"), F.col("path").alias("_shared"), "root")
    joined = below.withColumn("_block", _block()).join(upper, F.col(key).eqNullSafe(F.col("_k")) & (F.col("_block") == F.col("_b")))
    return joined.select(*nodes.columns, F.concat("path", "_shared").alias("path"), "root")


def manifest(rows: DataFrame) -> DataFrame:
    """Of `leaves`: doc_id, leaf, tampered, place and total (within the source), path, subroot; of the source: source_place, sources, source_path, root.

    Ids ascend, null first; rows of one id follow each other by their leaves. A null source is the
    first of the sources. A single row's tree is its leaf, and its path is empty; no rows give none.
    """
    bound_batches(rows.sparkSession)
    own = _placed(stored(rows, compression="zstd"), "source", [F.col("doc_id").asc_nulls_first(), F.col("leaf")])
    paths = authenticate(own.withColumnRenamed("leaf", "digest"), "source")
    roots = paths.filter("place = 0").select(F.lit(0).cast("long").alias("tree"), "source", F.col("root").alias("digest"))
    top = authenticate(_placed(stored(roots), "tree", [F.col("source").asc_nulls_first()]), "tree")
    of_source = top.select(F.col("source").alias("_s"), F.col("digest").alias("subroot"), F.col("place").alias("source_place"), F.col("total").alias("sources"), F.col("path").alias("source_path"), F.col("root").alias("_root"))
    joined = paths.drop("root").join(of_source, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    return joined.withColumnsRenamed({"digest": "leaf", "_root": "root"})


def verify(entries: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256 (of the whole path), folded_root (from tampered where there is one, else leaf, and the path) and verified (it equals root)."""
    columns = ["leaf", "tampered", "place", "total", "path", "source_place", "sources", "source_path"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            proofs, folded = [], []
            for own, changed, place, total, path, at, sources, above in zip(*(b.column(c).to_pylist() for c in columns), strict=True):
                siblings = path + above
                proofs.append(sha256(siblings.hex().encode()).hexdigest())
                digest, rest = fold((changed or own).encode(), siblings, place, total)
                folded.append(fold(digest, rest, at, sources)[0].decode())
            ok = [x == y for x, y in zip(folded, b.column("root").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("doc_id", "leaf", "subroot", "root")), pa.array(proofs, pa.string()), pa.array(folded, pa.string()), pa.array(ok, pa.bool_())], ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"])

    bound_batches(entries.sparkSession)
    schema = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    return entries.select("doc_id", "subroot", "root", *columns).mapInArrow(run, schema)
