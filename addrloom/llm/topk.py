"""Exact top-k by integer inner product: a table of angles to many pivots gives bounds, candidates are evaluated in bound order.

Equal vectors are one candidate that stands for its k + 1 least ids, so copies are evaluated once
however many they are. Every vector's angles to PIVOTS pivots are computed once and stored with it.
The angle is a metric: between a query and a candidate it is at least the largest difference of
their angles to any pivot, which bounds the inner product from above. Candidates are stored in
blocks, sorted by nearest pivot and angle to it; a block's ranges of angles bound all its vectors
at once. A query starts from its k + 1 best scores in its own block, passes by the blocks whose
bound is below them, and evaluates the candidates of the others in the order of their bounds until
the next bound is below its (k + 1)-th score.

Bounds only decide what is evaluated, with SLACK for their rounding; scores are exact. Rows, copies
and repeated ids are told apart by their place in the stored table.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import bound_batches, discard, stored

#: Pivots; vectors they are chosen from (the first by hash); radians by which a computed angle may be wrong.
PIVOTS, SAMPLE, SLACK = 32, 1024, 4e-6
#: Vectors and bytes of a block; blocks whose ranges one row holds; queries of a block of queries; most range partitions.
BLOCK, BLOCK_BYTES, PACK, ASKED, MOST_RANGES = 4096, 4 << 20, 2048, 256, 1 << 14
#: A sum of products below this is exact in float64, in any order.
EXACT = float(1 << 53)

BLOCKS = "block long, dim int, n int, class binary, vectors binary, angles binary, norms binary, ids array<array<long>>, rows array<array<long>>, low binary, high binary, longest double"
QUESTIONS = "class long, dim int, vector binary, angles binary, norm double, least double"
TASKS = "block long, n int, classes binary, asked binary, angles binary, norms binary, least binary"


def _floors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """floor(1024 * x) of each component, as float64, which holds it exactly: 1024 is a power of two, and a double of 2**53 or more is whole. Vectors with a null, nan or infinite component go."""
    for b in batches:
        col = b.column("embedding")
        at, size = np.asarray(col.offsets), np.asarray(col.value_lengths().fill_null(0), np.int64)
        flat = np.asarray(col.values.cast(pa.float64(), safe=False).fill_null(np.nan))
        ids, keep, out = b.column("vec_id"), [], []
        present = np.asarray(col.is_valid())
        for k in np.flatnonzero(present).tolist():
            v = flat[at[k] : at[k] + size[k]]
            if np.isfinite(v).all():
                keep.append(k)
                out.append(np.floor(1024.0 * v).astype("<f8").tobytes())
        yield pa.RecordBatch.from_arrays([ids.take(pa.array(keep, pa.int64())), pa.array(out, pa.binary())], ["vec_id", "vector"])


def _matrix(raw: bytes, rows: int) -> np.ndarray:
    return np.frombuffer(raw, "<f8").reshape(rows, -1)


def angles(vectors: np.ndarray, norms: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Angles to unit pivots, a row for each vector; the shorter of the two is filled up with zeros. A vector of zeros has right angles."""
    m = min(vectors.shape[1], pivots.shape[1])
    with np.errstate(invalid="ignore", divide="ignore", over="ignore"):
        unit = np.where(norms[:, None] > 0, vectors[:, :m] / norms[:, None], 0.0)
    return np.arccos(np.clip(unit @ pivots[:, :m].T, -1.0, 1.0)).astype("<f4")


def lengths(vectors: np.ndarray) -> np.ndarray:
    """Euclidean lengths without overflow."""
    top = np.abs(vectors).max(1, initial=0.0)
    scaled = vectors / np.where(top > 0, top, 1.0)[:, None]
    return top * np.sqrt((scaled * scaled).sum(1))


def choose_pivots(sample: list[np.ndarray], many: int = PIVOTS) -> np.ndarray:
    """Unit vectors far from each other: each next one has the largest angle to its nearest predecessor. Fewer, where the sample has fewer directions."""
    dim = max((len(v) for v in sample), default=0)
    if not dim:
        return np.zeros((0, 0))
    x = np.stack([np.pad(v, (0, dim - len(v))) for v in sample])
    norms = lengths(x)
    x = x[norms > 0] / norms[norms > 0][:, None]
    if not len(x):
        return np.zeros((0, dim))
    chosen, near = [0], x @ x[0]
    while len(chosen) < min(many, len(x)) and near.min() < 1 - 1e-9:
        chosen.append(int(near.argmin()))
        near = np.maximum(near, x @ x[chosen[-1]])
    return x[chosen]


def bounds(norm: float, own: np.ndarray, norms: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Upper bounds of the inner products of one vector with others, from their angles to the same pivots."""
    apart = np.abs(other - own).max(1, initial=0.0)
    with np.errstate(over="ignore"):
        return _upper(norm * norms, apart)


def _upper(product: np.ndarray, apart: np.ndarray) -> np.ndarray:
    c = np.cos(np.maximum(apart.astype(np.float64) - SLACK, 0.0))
    return product * c + np.abs(product) * 1e-9 + 1.0


def products(vectors: np.ndarray, one: np.ndarray) -> np.ndarray:
    """Exact inner products, as float64 where these hold them, else as Python's integers."""
    with np.errstate(over="ignore"):
        if not len(one) or np.abs(vectors).max(initial=0.0) * np.abs(one).max() * len(one) < EXACT:
            return vectors @ one
    own = [int(x) for x in one]
    return np.array([sum(int(a) * b for a, b in zip(v, own, strict=True)) for v in vectors.tolist()] + [None], object)[:-1]


def best(vector: np.ndarray, norm: float, own: np.ndarray, vectors: np.ndarray, norms: np.ndarray, other: np.ndarray, first: np.ndarray, k: int, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Places and scores of the k best candidates that may reach least, by score, then by their least id (first): evaluated in bound order, in growing steps, until the next bound is below the k-th score."""
    upper = bounds(norm, own, norms, other)
    order = np.flatnonzero(upper >= least)
    order = order[np.argsort(-upper[order], kind="stable")]
    at, step, places, scores = 0, 4 * k, np.zeros(0, np.int64), np.zeros(0)
    while at < len(order) and upper[order[at]] >= least:
        some = order[at : at + step]
        at, step = at + step, 2 * step
        got = products(vectors[some], vector)
        some, got = some[got >= least], got[got >= least]
        places, scores = np.append(places, some), np.append(scores, got)
        top = _descending(scores, first[places])[:k]
        places, scores = places[top], scores[top]
        least = max(least, _reached(scores, k))
    return places, scores


def _descending(scores: np.ndarray, first: np.ndarray) -> np.ndarray:
    if scores.dtype == object:
        return np.array(sorted(range(len(scores)), key=lambda j: (-scores[j], first[j])), np.int64)
    return np.lexsort((first, -scores))


def _reached(scores: np.ndarray, k: int) -> float:
    """What a bound has to reach once there are k scores; a little less than the last, for its rounding where it isn't a float64."""
    return float(scores[-1]) - abs(float(scores[-1])) * 1e-12 if len(scores) == k else -np.inf


def _first(ids: pa.Array) -> np.ndarray:
    """The least id of each class, for ties: null after all others."""
    return np.array([x[0] if x[0] is not None else (1 << 63) - 1 for x in ids.to_pylist()], np.int64)


def _blocks(pivots: np.ndarray, k: int, what: str):
    """Packs sorted classes into blocks (what = blocks), or gives the queries among them with their k-th score in their own block (what = questions)."""

    def cut(rows: list[tuple], number: int) -> pa.RecordBatch | None:
        dim = len(rows[0][1]) // 8
        v = _matrix(b"".join(r[1] for r in rows), len(rows))
        norms = lengths(v)
        a = angles(v, norms, pivots)
        ids, members = [r[2] for r in rows], [r[3] for r in rows]
        if what == "blocks":
            one = [number, dim, len(rows), struct.pack(f"<{len(rows)}q", *(r[0] for r in rows)), v.astype("<f8").tobytes(), a.tobytes(), norms.tobytes(), ids, members, a.min(0).tobytes(), a.max(0).tobytes(), float(norms.max())]
            return pa.RecordBatch.from_pylist([dict(zip(_names(BLOCKS), one, strict=True))], schema=_schema(BLOCKS))
        first, out = _first(pa.array(ids, pa.list_(pa.int64()))), []
        for j in (j for j, r in enumerate(rows) if r[4]):
            _, scores = best(v[j], norms[j], a[j], v, norms, a, first, k, -np.inf)
            out.append(dict(zip(_names(QUESTIONS), [rows[j][0], dim, v[j].tobytes(), a[j].tobytes(), float(norms[j]), _reached(scores, k)], strict=True)))
        return pa.RecordBatch.from_pylist(out, schema=_schema(QUESTIONS)) if out else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, rows = TaskContext.get().partitionId() << 32, []
        for b in batches:
            for r in zip(*(b.column(c).to_pylist() for c in ("class", "vector", "ids", "rows", "asked")), strict=True):
                if rows and (len(r[1]) != len(rows[0][1]) or len(rows) >= BLOCK or (len(rows) + 1) * len(r[1]) > BLOCK_BYTES):
                    if (made := cut(rows, number)) is not None:
                        yield made
                    number, rows = number + 1, []
                rows.append(r)
        if rows and (made := cut(rows, number)) is not None:
            yield made

    return run


def _names(ddl: str) -> list[str]:
    return [x.split()[0] for x in ddl.split(", ")]


def _schema(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "double": pa.float64(), "array<long>": pa.list_(pa.int64()), "array<array<long>>": pa.list_(pa.list_(pa.int64()))}
    return pa.schema([(n, kinds[t]) for n, t in (x.split() for x in ddl.split(", "))])


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Queries of one dimension, up to ASKED, as one row."""

    def row(held: list[dict]) -> pa.RecordBatch:
        join = lambda c: pa.array([b"".join(x[c] for x in held)], pa.binary())
        pack = lambda kind, c: pa.array([struct.pack(f"<{len(held)}{kind}", *(x[c] for x in held))], pa.binary())
        return pa.RecordBatch.from_arrays([pa.array([held[0]["dim"]], pa.int32()), pa.array([len(held)], pa.int32()), pack("q", "class"), join("vector"), join("angles"), pack("d", "norm"), pack("d", "least")], ["dim", "n", "classes", "asked", "angles", "norms", "least"])

    held: list[dict] = []
    for b in batches:
        for x in b.to_pylist():
            if held and (x["dim"] != held[0]["dim"] or len(held) >= ASKED or (len(held) + 1) * len(x["vector"]) > BLOCK_BYTES):
                yield row(held)
                held = []
            held.append(x)
    if held:
        yield row(held)


def _passed(pivots: int):
    """Of each block of queries and pack of block ranges: a row for each block that may hold a result, with the queries for which it may."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for x in b.to_pylist():
                n = x["n"]
                own, norms, least = np.frombuffer(x["angles"], "<f4").reshape(n, -1), np.frombuffer(x["norms"]), np.frombuffer(x["least"])
                classes, asked = np.frombuffer(x["classes"], "<i8"), _matrix(x["asked"], n)
                for r in (r for r in x["ranges"] if r["dim"] == x["dim"]):
                    low, high = np.frombuffer(r["low"], "<f4"), np.frombuffer(r["high"], "<f4")
                    apart = np.maximum(low - own, own - high).max(1, initial=0.0) if pivots else np.zeros(n)
                    with np.errstate(over="ignore"):
                        # the bound falls with the angle; where it is negative, the shortest vector of the block has the largest product, which 0 bounds
                        go = np.maximum(_upper(norms * r["longest"], apart), 1.0) >= least
                    if go.any():
                        one = [r["block"], int(go.sum()), classes[go].tobytes(), asked[go].tobytes(), own[go].tobytes(), norms[go].tobytes(), least[go].tobytes()]
                        yield pa.RecordBatch.from_pylist([dict(zip(_names(TASKS), one, strict=True))], schema=_schema(TASKS))

    return run


def _evaluated(k: int):
    """The k best rows that each query finds in a block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for x in b.to_pylist():
                n, m = x["n"], x["members"]
                asked, v = _matrix(x["asked"], n), _matrix(x["vectors"], m)
                own, other = np.frombuffer(x["angles"], "<f4").reshape(n, -1), np.frombuffer(x["table"], "<f4").reshape(m, -1)
                norms, others, least = np.frombuffer(x["norms"]), np.frombuffer(x["others"]), np.frombuffer(x["least"])
                classes, first = np.frombuffer(x["classes"], "<i8").tolist(), _first(pa.array(x["ids"], pa.list_(pa.int64())))
                out = ([], [], [], [])
                for q in range(n):
                    places, scores = best(asked[q], norms[q], own[q], v, others, other, first, k, least[q])
                    found = [(int(s), i, r) for p, s in zip(places.tolist(), scores.tolist(), strict=True) for i, r in zip(x["ids"][p], x["rows"][p], strict=True)]
                    found.sort(key=lambda y: (-y[0], y[1] is None, y[1] or 0, y[2]))
                    for s, i, r in found[:k]:
                        for column, value in zip(out, (classes[q], s, i, r), strict=True):
                            column.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], ["class", "score", "vec_id", "row"])

    return run


def top_k(table: DataFrame, k: int = 10, every: int = 100, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k highest inner products of each query with every other row.

    Queries are the rows whose id is divisible by every; candidates are all rows but the query's
    own row. A vector's components count as floor(1024 * x); a null vector, or one with a null or
    non-finite component, takes no part. Ties go to the smaller id, null ids last; a repeated id's
    rows are candidates, and queries, one by one. Vectors of different lengths aren't compared. A
    score beyond 64 bits is an error. Without rows there is no result; further columns aren't read.
    """
    spark = table.sparkSession
    bound_batches(spark)
    most = k + 1  # a query's own row is among its results and goes in the end
    given = table.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("embedding"))
    rows = stored(given.mapInArrow(_floors, "vec_id long, vector binary").withColumn("row", F.monotonically_increasing_id()), compression="zstd")
    is_query = F.col("vec_id") % every == 0

    least = Window.partitionBy("vector").orderBy(F.col("vec_id").asc_nulls_last(), "row")
    members = rows.withColumn("_n", F.row_number().over(least)).filter(F.col("_n") <= most).groupBy("vector").agg(F.array_sort(F.collect_list(F.struct("_n", "vec_id", "row"))).alias("m"))
    asked = rows.filter(is_query).select("vector").distinct().withColumn("asked", F.lit(True))
    classes = members.join(asked, "vector", "left").select("vector", F.col("m.vec_id").alias("ids"), F.col("m.row").alias("rows"), F.coalesce("asked", F.lit(False)).alias("asked"))
    classes = stored(classes.withColumn("class", F.monotonically_increasing_id()), compression="zstd")

    sample = classes.select("vector").orderBy(F.xxhash64("vector"), "vector").limit(SAMPLE).collect()
    pivots = choose_pivots([np.frombuffer(r["vector"], "<f8") for r in sample])
    parts = min(MOST_RANGES, max(1, -(-classes.count() // BLOCK)))

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw = b.column("vector").to_pylist()
            dim = np.array([len(r) // 8 for r in raw], np.int32)
            pivot, angle = np.zeros(len(raw), np.int32), np.zeros(len(raw))
            for d in np.unique(dim).tolist() if len(pivots) else []:
                at = np.flatnonzero(dim == d)
                v = _matrix(b"".join(raw[j] for j in at), len(at))
                a = angles(v, lengths(v), pivots)
                pivot[at], angle[at] = a.argmin(1), a.min(1)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(dim), pa.array(pivot), pa.array(angle)], [*b.schema.names, "dim", "pivot", "angle"])

    order = ["dim", "pivot", "angle", "class"]
    schema = "vector binary, ids array<long>, rows array<long>, asked boolean, class long, dim int, pivot int, angle double"
    near = stored(classes.mapInArrow(placed, schema).repartitionByRange(parts, *order).sortWithinPartitions(*order), compression="zstd")
    blocks = stored(near.mapInArrow(_blocks(pivots, most, "blocks"), BLOCKS), compression="zstd")
    questions = stored(near.mapInArrow(_blocks(pivots, most, "questions"), QUESTIONS))
    discard(near)

    packs = max(1, -(-blocks.count() // PACK))
    ranges = blocks.select(F.pmod(F.xxhash64("block"), F.lit(packs)).cast("int").alias("pack"), F.struct("block", "dim", "low", "high", "longest").alias("r")).groupBy("pack").agg(F.collect_list("r").alias("ranges"))
    groups = questions.sortWithinPartitions("dim").mapInArrow(_gathered, "dim int, n int, classes binary, asked binary, angles binary, norms binary, least binary")
    tasks = groups.withColumn("pack", F.explode(F.sequence(F.lit(0), F.lit(packs - 1)))).join(ranges, "pack").drop("pack").mapInArrow(_passed(len(pivots)), TASKS)
    payload = blocks.select("block", F.col("n").alias("members"), "vectors", F.col("angles").alias("table"), F.col("norms").alias("others"), "ids", "rows")
    spread = min(blocks.count(), MOST_RANGES) or 1  # dealt by count and not by bytes: the work lies in the pairs
    found = tasks.repartition(spread, "block").join(payload.repartition(spread, "block"), "block").mapInArrow(_evaluated(most), "class long, score long, vec_id long, row long")

    nearest = Window.partitionBy("class").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last(), "row")
    found = found.withColumn("_n", F.row_number().over(nearest)).filter(F.col("_n") <= most).groupBy("class").agg(F.array_sort(F.collect_list(F.struct("_n", "vec_id", "row", "score"))).alias("m"))
    queries = rows.filter(is_query).select(F.col("vec_id").alias("query_id"), F.col("row").alias("own"), "vector").join(classes.select("vector", "class"), "vector")
    others = F.slice(F.filter("m", lambda x: x["row"] != F.col("own")), 1, k)
    out = queries.drop("vector").join(found, "class").select("query_id", F.posexplode(others).alias("at", "x"))
    return out.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("vec_id"), F.col("x.score").alias("score"))
