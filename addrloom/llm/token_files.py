"""Token-ID output: Parquet list columns in id order, read back by column and page."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bound_batches, by_bytes, ordered_ranges, stored, utf8
from .tokens import encoder

#: File format: dictionary for ids (at most one vocabulary of them), delta encoding for the ascending columns,
#: 32 MB row groups, and pages small enough for the page index to skip to a document.
LAYOUT = {
    "compression": "zstd",
    "parquet__writer__version": "PARQUET_2_0",
    "parquet__block__size": str(32 << 20),
    "parquet__page__size": str(256 << 10),
    "parquet__page__row__count__limit": "2000",
    "parquet__enable__dictionary#ids.list.element": "true",
    "parquet__enable__dictionary#doc_id": "false",
    "parquet__enable__dictionary#start_in_range": "false",
}
SCHEMA = "range int, doc_id long, start_in_range long, n_tokens long, ids array<int>"


def write_token_files(docs: DataFrame, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encodes every whole text, appends end_id, and writes one file per id range, documents ascending by id.

    Columns: range, doc_id, start_in_range (ids before the document within its range), n_tokens
    and ids. One shuffle, of texts, by ranges that follow the ids' quantiles. Rows of one id
    follow each other by text; null ids come first; a null text is just the end id.
    """
    bound_batches(docs.sparkSession)
    rows, ranges = ordered_ranges(docs.selectExpr(f"cast(`{id_col}` as long) doc_id", f"`{text_col}` text"), "doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool, start = encoder(tokenizer), 0
        for whole in batches:
            for b in by_bytes(whole, "text", 2 << 20):
                n, ids = tool.encode(*utf8(b.column("text")))
                ids = np.insert(ids, np.cumsum(n), end_id).astype(np.int32)
                n = n + 1
                ends = np.cumsum(n)
                lists = pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pa.array(ids))
                yield pa.RecordBatch.from_arrays([b.column("_p"), b.column("doc_id"), pa.array(start + ends - n), pa.array(n), lists], ["range", "doc_id", "start_in_range", "n_tokens", "ids"])
                start += int(ends[-1])

    made = rows.repartitionById(ranges, F.col("_p")).sortWithinPartitions("doc_id", "text").mapInArrow(run, SCHEMA)
    return stored(made, **LAYOUT)


def read_digests(files: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of each document, from the files.

    The ids of all ranges before are summed from the n_tokens column alone; the driver sees one
    row per range (at most 65,536), which is also what is broadcast. Null and repeated ids are
    rows like any other; files without rows give none.
    """
    spark: SparkSession = files.sparkSession
    bound_batches(spark)
    total, before = 0, []
    for r, n in sorted(files.groupBy("range").agg(F.sum("n_tokens")).collect()):
        before.append((r, total))
        total += n
    base = spark.createDataFrame(before, "range int, before long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            col = b.column("ids")
            off = np.asarray(col.offsets)
            raw = memoryview(np.ascontiguousarray(np.asarray(col.values), "<i4")).cast("B")
            crc = [zlib.crc32(raw[4 * x : 4 * y]) for x, y in zip(off.tolist(), off[1:].tolist(), strict=False)]
            yield pa.RecordBatch.from_arrays([b.column("range"), b.column("doc_id"), b.column("start_in_range"), pa.array(np.diff(off), pa.int64()), pa.array(crc, pa.int64())], ["range", "doc_id", "start_in_range", "n_tokens", "ids_crc32"])

    read = files.select("range", "doc_id", "start_in_range", "ids").mapInArrow(run, "range int, doc_id long, start_in_range long, n_tokens long, ids_crc32 long")
    return read.join(F.broadcast(base), "range").select("doc_id", (F.col("before") + F.col("start_in_range")).alias("start"), "n_tokens", "ids_crc32")
