"""What the operators of this subpackage share: table access, shared storage, Arrow batches, ordering.

Conventions, for every operator here:

* a null text counts as the empty text; a null id is carried through as null;
* only the named id and text columns are read, so further columns never clash;
* rows that repeat an id are rows like any other unless the operator says otherwise;
* empty tables give empty results with the same columns.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..workers import ship_package

#: Bounds of what one Arrow batch brings to a Python worker.
BATCH_ROWS, BATCH_BYTES = 1024, 2 << 20
#: Rows that the Parquet reader decodes at once: a batch's texts are one array on the heap.
READ_ROWS = 512
#: Bytes of text that one range of `ordered_ranges` should hold, and the most ranges it makes.
RANGE_BYTES, MAX_RANGES = 24 << 20, 1 << 16


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bound_batches(spark: SparkSession) -> None:
    """Limits Arrow batches by rows and by bytes, and the reader's batches by rows, so that long texts can't fill a worker's or an executor's memory; and sees to it that workers can import this package."""
    ship_package(spark)
    spark.conf.set("spark.sql.parquet.columnarReaderBatchSize", str(READ_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where that is unset, a temporary one in local mode, and otherwise the warehouse.

    A warehouse that may be Spark's default (spark-warehouse on a local disk, below the driver's
    working folder) counts as shared on one machine only: elsewhere each executor would write to a
    disk of its own.
    """
    if base := spark.conf.get("spark.checkpoint.dir", None):
        return base.rstrip("/")
    master = spark.sparkContext.master
    if master == "local" or master.startswith("local["):
        base = "file://" + tempfile.mkdtemp(prefix="addrloom-shared-")
        spark.conf.set("spark.checkpoint.dir", base)
        return base
    base = (spark.conf.get("spark.sql.warehouse.dir", None) or "").rstrip("/")
    own = base.startswith(("file:", "/")) and base.endswith("/spark-warehouse")
    if not base or own and not master.startswith("local-cluster["):
        raise ValueError("spark.checkpoint.dir or spark.sql.warehouse.dir has to name a folder that driver and executors share")
    return base


#: Paths of stored tables, oldest first.
_STORED: list[str] = []


def stored(df: DataFrame, **options: str) -> DataFrame:
    """Writes df as Parquet into the shared folder and reads it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/addrloom-{uuid.uuid4().hex}"
    writer = df.write
    for k, v in options.items():
        writer = writer.option(k.replace("__", "."), v)
    writer.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._addrloom_path = path
    _STORED.append(path)
    return out


def _delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(p, True)


def discard(df: DataFrame) -> None:
    """Deletes what `stored` has written for df."""
    if path := getattr(df, "_addrloom_path", None):
        _delete(df.sparkSession, path)
        if path in _STORED:
            _STORED.remove(path)


def tidy(spark: SparkSession) -> None:
    """Collects the driver's garbage. An operator of a hundred exchanges leaves plans, statistics and shuffles behind, which Spark lets go, files included, only once their last reference is collected."""
    spark._jvm.System.gc()


def stored_so_far() -> int:
    return len(_STORED)


def discard_since(spark: SparkSession, mark: int, keep: DataFrame) -> None:
    """Deletes the tables stored since `stored_so_far` gave mark, but for that of keep, which must not need them any more."""
    for path in [p for p in _STORED[mark:] if p != getattr(keep, "_addrloom_path", None)]:
        _delete(spark, path)
        _STORED.remove(path)


def utf8(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (from 0) and bytes of a string column; null is empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("")
    n = len(col)
    kind = np.int64 if pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type) else np.int32
    _, off, data = col.buffers()
    if not n or off is None:
        return np.zeros(n + 1, np.int64), np.zeros(0, np.uint8)
    off = np.frombuffer(off, kind)[col.offset : col.offset + n + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None else np.zeros(0, np.uint8)
    return off - off[0], data


def by_bytes(batch: pa.RecordBatch, column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Slices a batch so that each holds up to `limit` bytes of the column, or one row."""
    off, _ = utf8(batch.column(column))
    at, n = 0, batch.num_rows
    while at < n:
        to = max(at + 1, int(np.searchsorted(off, off[at] + limit, "right")) - 1)
        yield batch.slice(at, min(to, n) - at)
        at = min(to, n)


def sums(values: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Sum of values between successive offsets; 0 for empty ranges."""
    out = np.zeros(len(off) - 1, np.int64 if values.dtype.kind in "biu" else np.float64)
    full = off[1:] > off[:-1]
    if full.any():
        out[full] = np.add.reduceat(values, off[:-1][full], dtype=out.dtype)
    return out


def fitted(rows: DataFrame, fit: Callable[[Iterator[pa.RecordBatch]], bytes]) -> bytes:
    """What fit makes of a bounded sample, whose rows (ascending by doc_id and text) one executor task reads batch by batch; the driver gets the result alone."""
    bound_batches(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays([pa.array([fit(batches)], pa.binary())], ["model"])

    made = rows.repartition(1).sortWithinPartitions("doc_id").mapInArrow(run, "model binary").first()
    return bytes(made["model"]) if made else fit(iter(()))


def ordered_ranges(df: DataFrame, id_col: str, text_col: str, range_bytes: int = RANGE_BYTES) -> tuple[DataFrame, int]:
    """Adds `_p`, the number of the id range that a row belongs to, ascending with the id; null ids come first.

    Boundaries are taken from finer quantiles of all ids, joined until a range holds about
    range_bytes of text, so a region of long texts is no larger a task than others. They are
    computed once, and the ranges stay the same however often the plan is run. Only ids and lengths
    are aggregated; the driver gets one boundary and one sum per fine range, at most MAX_RANGES.
    Rows of one id are never parted.
    """
    lengths = stored(df.select(F.col(id_col), F.octet_length(text_col).alias("_bytes")))  # so that the texts are read once for this
    n, size = lengths.agg(F.count(F.lit(1)), F.sum("_bytes")).first()
    fine = int(min(MAX_RANGES, max(1, -(-8 * (size or 0) // range_bytes)), max(1, n)))
    cuts: list[float] = []
    if (size or 0) > range_bytes and fine > 1:
        at = [k / fine for k in range(1, fine)]
        cuts = sorted(set(lengths.select(F.col(id_col).cast("double").alias("x")).approxQuantile("x", at, 0.2 / fine)))
        sums_ = dict(_numbered(lengths, id_col, cuts).groupBy("_p").agg(F.sum("_bytes")).collect())
        kept, held = [], sums_.get(0) or 0
        for k, cut in enumerate(cuts, 1):
            own = sums_.get(k) or 0
            if held and held + own > range_bytes:
                kept.append(cut)
                held = 0
            held += own
        cuts = kept
    discard(lengths)
    if not cuts:
        return df.withColumn("_p", F.lit(0)), 1
    return _numbered(df, id_col, cuts), len(cuts) + 1


def _numbered(df: DataFrame, id_col: str, cuts: list[float]) -> DataFrame:
    """Adds `_p`, the number of cuts that are not above the id."""
    from pyspark.ml.feature import Bucketizer

    tool = Bucketizer(splits=[-float("inf"), *cuts, float("inf")], inputCol="_x", outputCol="_b", handleInvalid="keep")
    out = tool.transform(df.withColumn("_x", F.coalesce(F.col(id_col).cast("double"), F.lit(-1.7e308))))
    return out.withColumn("_p", F.col("_b").cast("int")).drop("_x", "_b")
