"""Records of delimited files with quoted line breaks, read by many tasks a file.

A file is read as lines, each with the split that it begins in. Whether a split begins inside a
quoted field depends on all before it, so it is found by a prefix scan: one pass gives for each
split what it makes of either beginning (leave a field open, close it, or keep or turn what it
found), windows over the splits of a file compose these, and a second pass puts the lines of each
split together to records from its true beginning. Records that reach beyond their split are put
together from the pieces that the first pass has kept, of which a split has two at most.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..workers import ship_package
from .shared import stored

SPLIT = "file string, start long, end_out boolean, end_in boolean, some_out boolean, crlf boolean, tail_out string, head_in string, tail_in string"
#: Splits (about 100 bytes each) up to which their beginnings are broadcast.
BROADCAST_SPLITS = 1_000_000


def ends_inside(line: str, inside: bool, delimiter: str = ",", quote: str = '"') -> bool:
    """Whether a quoted field is open at a line's end. A quote opens a field only as its first character; doubled, it is a character of it."""
    if quote not in line:
        return inside
    at = 0
    while True:
        if inside:
            if (at := line.find(quote, at) + 1) == 0:
                return True
            if line[at : at + 1] == quote:
                at += 1
                continue
            inside = False
        elif line[at : at + 1] == quote:
            inside, at = True, at + 1
            continue
        if (at := line.find(delimiter, at) + 1) == 0:
            return False


class _Reading:
    """The lines of a split, read from one of the two beginnings."""

    def __init__(self, inside: bool):
        self.inside, self.head, self.open, self.some = inside, None, [], False
        self.begun = not inside  # whether a record has begun in this split

    def add(self, line: str) -> str | None:
        """Takes a line; gives the record that it ends, if that began here."""
        self.inside = ends_inside(line, self.inside)
        self.open.append(line)
        if self.inside:
            return None
        whole, self.open = "\n".join(self.open), []
        if self.begun:
            self.some = True
            return whole
        self.head, self.begun = whole, True
        return None

    def rest(self) -> tuple[str | None, str | None]:
        """What goes to the record begun before the split, and the record that is open at its end."""
        whole = "\n".join(self.open) if self.open else None
        return (self.head, whole) if self.begun else (whole, None)


def _runs(batches: Iterator[pa.RecordBatch], *columns: str) -> Iterator[tuple[tuple, list[str]]]:
    """What a split's lines have in common (file, start and further columns), and the lines, batch by batch."""
    for b in batches:
        start, file = np.asarray(b.column("start")), np.asarray(b.column("file").dictionary_encode().indices)
        cuts = np.flatnonzero((start[1:] != start[:-1]) | (file[1:] != file[:-1])) + 1
        for at, to in zip([0, *cuts.tolist()], [*cuts.tolist(), b.num_rows], strict=True):
            if to > at:
                yield tuple(b.column(c)[at].as_py() for c in ("file", "start", *columns)), b.column("value").slice(at, to - at).to_pylist()


def _scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each split: what it makes of either beginning."""
    kinds = {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_()}
    fields = [c.split() for c in SPLIT.split(", ")]
    now, out, inner, joined, crlf = None, _Reading(False), _Reading(True), None, False

    def done() -> pa.RecordBatch:
        tail = out.rest()[1]
        row = [*now, out.inside, inner.inside, out.some, crlf, tail, *(inner.rest() if inner is not out else (joined, tail))]
        return pa.RecordBatch.from_arrays([pa.array([x], kinds[k]) for x, (_, k) in zip(row, fields, strict=True)], [n for n, _ in fields])

    for split, lines in _runs(batches):
        if split != now:
            if now:
                yield done()
            now, out, inner, joined, crlf = split, _Reading(False), _Reading(True), None, lines[0].endswith("\r")
        for line in lines:
            if inner is out and not out.open and '"' not in line:
                continue  # a record by itself
            out.add(line)
            if inner is not out:
                inner.add(line)
                if not out.inside and not inner.inside:  # from here on both are the same
                    joined, inner = inner.head, out
    if now:
        yield done()


def _put_together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now, reading, first = None, None, False
    for (*split, inside, crlf), lines in _runs(batches, "inside", "crlf"):
        if split != now:
            now, reading, first = split, _Reading(inside), split[1] == 0
        own = []
        for line in lines:
            record = line if reading.begun and not reading.open and '"' not in line else reading.add(line)
            if record is not None:
                own.append(record.replace("\r\n", "\n") if crlf else record)
        if own:
            yield _found(own, [split[0]] * len(own), [first] + [False] * (len(own) - 1))
            first = False


def _found(records: list[str], files: list[str], heads: list[bool]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(records, pa.string()), pa.array(files, pa.string()), pa.array(heads, pa.bool_())], ["record", "file", "header"])


def beginnings(splits: DataFrame) -> DataFrame:
    """Adds inside: whether a split begins in a quoted field. Splits that end alike, whatever their beginning, make all before them of no matter; after the last of them each split that turns its beginning counts."""
    order = Window.partitionBy("file").orderBy("start")
    fixed, turned = F.col("end_out") == F.col("end_in"), F.col("end_out") & ~F.col("end_in")
    x = splits.withColumn("_since", F.sum(fixed.cast("int")).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    since = Window.partitionBy("file", "_since")
    base = F.max((fixed & F.col("end_out")).cast("int")).over(since)
    turns = F.sum(turned.cast("int")).over(since.orderBy("start").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    x = x.withColumn("_after", (base + turns) % 2 == 1)
    return x.withColumn("inside", F.coalesce(F.lag("_after").over(order), F.lit(False))).drop("_since", "_after")


def records(spark: SparkSession, paths: list[str]) -> DataFrame:
    """record (text, without its line end), file, and header: whether it is its file's first. No order.

    Lines end with \\n, or with \\r\\n in a file whose first one does; line ends of such a file's
    fields become \\n, as in Spark's reader of whole files, those of others stay. A field that is open
    at a file's end makes one record to there, without a last line end; empty lines are none. Two passes; nothing is
    shuffled but a split's description, with its at most two pieces of records that reach beyond.
    """
    ship_package(spark)
    lines = spark.read.option("lineSep", "\n").text(paths).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    x = beginnings(stored(lines.mapInArrow(_scanned, SPLIT)))
    x = stored(x.withColumn("crlf", F.max((F.col("start") == 0) & F.col("crlf")).over(Window.partitionBy("file"))))

    begins = x.select("file", "start", "inside", "crlf")
    if begins.count() <= BROADCAST_SPLITS:  # each split's lines stay in their order
        keyed = lines.join(F.broadcast(begins), ["file", "start"])
    else:
        keyed = lines.withColumn("n", F.monotonically_increasing_id()).join(begins.hint("merge"), ["file", "start"]).sortWithinPartitions("file", "start", "n")
    whole = keyed.select("value", "file", "start", "inside", "crlf").mapInArrow(_put_together, "record string, file string, header boolean")

    piece = lambda kind, text, header: x.select("file", "start", "crlf", F.lit(kind).alias("kind"), text.alias("text"), header.alias("header"))
    ends = piece(0, F.when(F.col("inside"), F.col("head_in")), F.lit(False))
    opens = piece(1, F.when(F.col("inside"), F.col("tail_in")).otherwise(F.col("tail_out")), (F.col("start") == 0) & ~F.col("some_out"))
    chain = F.sum("kind").over(Window.partitionBy("file").orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    pieces = opens.unionByName(ends).filter("text is not null").withColumn("_chain", chain)
    parts = pieces.groupBy("file", "_chain").agg(F.array_sort(F.collect_list(F.struct("start", "kind", "text"))).alias("p"), F.max("header").alias("header"), F.max("crlf").alias("crlf"))
    whole_text = F.array_join(F.transform("p", lambda y: y["text"]), "\n")
    parts = parts.select(F.when(F.col("crlf"), F.replace(whole_text, F.lit("\r\n"), F.lit("\n"))).otherwise(whole_text).alias("record"), "file", "header")
    out = whole.unionByName(parts).withColumn("record", F.regexp_replace("record", "\r$", ""))
    return out.filter("record <> ''")
