"""Sources: delimited files with an explicit schema, validation with rejects, discovery, sampling."""

from __future__ import annotations

import csv
import io
import re
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import is_blank, strip
from ..schema import COUNT_FIELD, RAW_FIELDS, REQUIRED, raw_schema
from .digests import digests
from .records import records

# Column names that hold addresses, by strategy.
_LONG = ["addr_text", "raw_address", "address", "customer_address", "full_address", "shipping_address", "delivery_address"]
ADDRESS_COLUMNS = {
    "sample": _LONG,
    "compare": ["address", "full_address", "Address", "FULL_ADDRESS", "customer_address", "shipping_address"],
    "batch": ["addr_text", "address", "full_address", "Address", "addr"],
    "report": _LONG[:5],
}

#: Bytes of a file with quoted line breaks from which it is read over splits: that takes some six times the work of one task that reads it whole, and any number of tasks.
SPLIT_BYTES = 1 << 30


def _file_system(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def files_of(spark: SparkSession, paths: str | list[str]) -> list[str]:
    """The files that paths, patterns and folders name, in that order; hidden ones are left out. Raises FileNotFoundError for one that names none."""
    out: list[str] = []
    for path in [paths] if isinstance(paths, str) else paths:
        fs, p = _file_system(spark, path)
        found = [f for s in fs.globStatus(p) or [] for f in (fs.listStatus(s.getPath()) if s.isDirectory() else [s])]
        own = sorted(str(f.getPath()) for f in found if f.isFile() and f.getPath().getName()[0] not in "._")
        if not own:
            raise FileNotFoundError(path)
        out += own
    return list(dict.fromkeys(out))


def header(spark: SparkSession, path: str, most: int = 1 << 20) -> list[str]:
    """Column names of a file's first record; only its first bytes are read, by the driver."""
    fs, p = _file_system(spark, path)
    stream = fs.open(p)
    try:
        raw = b""
        while len(raw) < most and b"\n" not in raw and (got := bytes(stream.readNBytes(1 << 16))):
            raw += got
    finally:
        stream.close()
    text = raw.decode("utf-8", "replace").removeprefix("\ufeff")
    return next(csv.reader(io.StringIO(text)), [])


def missing_columns(columns: list[str], required: list[str] = REQUIRED) -> list[str]:
    """Required columns that aren't there, in the order in which they are required."""
    return [c for c in required if c not in columns]


def read_addresses(spark: SparkSession, paths: str | list[str], required: list[str] = REQUIRED, multi_line: bool = True, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """All columns as strings, unknown ones included, with source_file; short rows have nulls.

    Files are read by their own headers: those with like headers together, and their rows put
    together by name, so neither another order nor another set of columns shifts a value. Quoted
    line breaks are part of a field; with multi_line off they end a record. Files of more than
    split_bytes are read by many tasks either way (see `records`), smaller ones by one. Raises FileNotFoundError for a path that isn't there, ValueError for a file
    without a header or required column.
    """
    files = files_of(spark, paths)
    with ThreadPoolExecutor(16) as pool:
        names = list(pool.map(lambda f: header(spark, f), files))
    by: dict[tuple[str, ...], list[str]] = {}
    for f, own in zip(files, names, strict=True):
        if not own:
            raise ValueError(f"no header: {f}")
        if gone := missing_columns(own, required):
            raise ValueError(f"missing columns: {', '.join(gone)} ({f})")
        by.setdefault(tuple(own), []).append(f)
    large = multi_line and any(fs.getFileStatus(p).getLen() > split_bytes for fs, p in (_file_system(spark, f) for f in files))
    if large:
        parts = []
        for own, group in by.items():
            found = records(spark, group).filter("not header")
            parts.append(found.select(F.from_csv("record", ", ".join("`" + c.replace("`", "``") + "` string" for c in own), {"quote": '"', "escape": '"', "multiLine": "true"}).alias("r"), F.col("file").alias("source_file")).select("r.*", "source_file"))
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    reader = spark.read.option("header", True).option("enforceSchema", True).option("multiLine", multi_line).option("quote", '"').option("escape", '"').option("encoding", "UTF-8")
    parts = [reader.schema(raw_schema(list(own))).csv(group).withColumn("source_file", F.col("_metadata.file_path")) for own, group in by.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def classified(raw: DataFrame, required: list[str] = REQUIRED) -> DataFrame:
    """Trims the known columns, reads the count (0 if it isn't a number), and adds reject_reason (null: valid).

    The first of address, code and city that is empty names the reason.
    """
    out = raw
    for c in RAW_FIELDS:
        if c in raw.columns:
            out = out.withColumn(c, strip(F.coalesce(F.col(c), F.lit(""))))
    if COUNT_FIELD in raw.columns:
        out = out.withColumn(COUNT_FIELD, F.coalesce(F.try_to_number(F.nullif(strip(F.col(COUNT_FIELD)), F.lit("")), F.lit("S999999999")).cast("int"), F.lit(0)))
    reason = F.coalesce(*(F.when(F.col(c) == "", F.lit(f"Empty {c}")) for c in required if c in raw.columns), F.lit(None).cast("string"))
    return out.withColumn("reject_reason", reason)


def valid(c: DataFrame) -> DataFrame:
    return c.filter("reject_reason is null").drop("reject_reason")


def rejects(c: DataFrame) -> DataFrame:
    return c.filter("reject_reason is not null")


def address_column(df: DataFrame, strategy: str = "sample") -> str:
    """The column that holds addresses, by name; what happens without a match depends on the strategy."""
    columns = df.columns
    for name in ADDRESS_COLUMNS[strategy]:
        if name in columns:
            return name
    if strategy == "sample":
        return next((c for c in columns if "address" in c.lower()), columns[1] if len(columns) > 1 else columns[0])
    if strategy == "compare":
        if found := [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]:
            return found[0]
    if strategy == "report":
        return columns[0]
    raise ValueError("no address column")


def with_address(df: DataFrame, column: str) -> DataFrame:
    """Rows whose address is neither null nor blank."""
    return df.filter(~is_blank(F.col(column)))


#: Rows that a task of `spread` gets.
TASK_ROWS = 50_000


def spread(df: DataFrame, rows: int) -> DataFrame:
    """Deals a table of about so many rows out evenly, for the expensive projections that follow: over all cores, and over more tasks as it grows, so none grows with it.

    How many partitions there are doesn't tell: a file's splits may hold one row group among them,
    and a join's partitions are put together by their bytes, which say little of what a row will cost.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(max(cores, -(-rows // TASK_ROWS)))


#: Bytes that a file's record has at least, most likely; shorter ones make the last block of `spread_in_order` longer.
LEAST_RECORD = 20


def spread_in_order(df: DataFrame, size: int) -> DataFrame:
    """Deals the rows of a file of so many bytes, which one task has to read, out for what follows: in blocks of TASK_ROWS, one after another as in the file.

    How many rows there are isn't known before they are read, so there are blocks for as many as the
    file may hold; those beyond its rows are empty and cost next to nothing.
    """
    blocks = -(-size // (TASK_ROWS * LEAST_RECORD))
    if blocks <= 1:
        return df
    at = df.withColumn("_at", F.monotonically_increasing_id())  # of one partition: 0, 1, 2, ...
    return at.repartitionById(blocks, F.least(F.floor(F.col("_at") / TASK_ROWS), F.lit(blocks - 1)).cast("int")).sortWithinPartitions("_at").drop("_at")


def head(df: DataFrame, n: int, order: str) -> DataFrame:
    return df.orderBy(order).limit(n)


def hashed_sample(df: DataFrame, n: int, key: str, seed: int = 42) -> DataFrame:
    """n rows that look random and are the same in every run and engine: those with the least digests of seed and key."""
    return df.orderBy(F.md5(F.concat(F.lit(f"{seed}|"), F.col(key).cast("string"))), key).limit(n)


def _pattern(glob: str) -> str:
    """A regular expression for a path pattern: * and ? stay within a folder, **/ stands for any folders or none."""
    parts = {"**/": "(?:.*/)?", "**": ".*", "*": "[^/]*", "?": "[^/]"}
    return "".join(parts.get(x) or re.escape(x) for x in re.findall(r"\*\*/|\*\*|\*|\?|[^*?]+", glob))


def _listed(spark: SparkSession, pattern: str) -> list[str]:
    fs, path = _file_system(spark, pattern if "**" not in pattern else pattern.split("**")[0].rstrip("/") or "/")
    found = fs.globStatus(path) or []
    if "**" not in pattern:
        return [str(f.getPath()) for f in found if f.isFile()]
    rest, out = re.compile(_pattern("**" + pattern.split("**", 1)[1])), []
    for folder in (f for f in found if f.isDirectory()):
        base, files = str(folder.getPath()).rstrip("/") + "/", fs.listFiles(folder.getPath(), True)
        while files.hasNext():
            name = str(files.next().getPath())
            if rest.fullmatch(name.removeprefix(base)):
                out.append(name)
    return out


def discover(spark: SparkSession, patterns: list[str]) -> list[str]:
    """Files that any of the patterns match, ** included, once each, sorted; through Hadoop's file systems, so any store will do."""
    return sorted({f for p in patterns for f in _listed(spark, p)})


def numbered(spark: SparkSession, folder: str, start: int, end: int) -> list[str]:
    """p{start}.csv to p{end}.csv where they exist, sorted as text (p10 before p5)."""
    return sorted(f for k in range(start, end + 1) for f in _listed(spark, f"{folder}/p{k}.csv"))


def fingerprints(spark: SparkSession, paths: list[str]) -> DataFrame:
    """path, size, SHA-256 and error of whole files, read chunk by chunk in tasks of like bytes; see `digests`. The driver lists their sizes."""
    listed = []
    for p in paths:
        fs, path = _file_system(spark, p)
        listed.append((p, fs.getFileStatus(path).getLen()))
    return digests(spark, listed)


def part_number(c):
    """Number of a p{n} file, from its path; null if its name has none."""
    return F.regexp_extract(c, r"(?:^|/)p(\d+)[^/]*$", 1).cast("int")


# Marks that outputs carry in their names.
OUTPUT_MARKS = ("results", "gpu", "sustained", "balanced", "optimized")


def processed_part(c):
    """p{n} of the input that an output file was made from, by its name: ..._p{n}_... with one of the marks, or p{n}_..._results_...; else null."""
    name = F.regexp_extract(c, r"([^/]*)$", 1)
    long = F.when(name.rlike("_(" + "|".join(OUTPUT_MARKS) + ")_"), F.nullif(F.regexp_extract(name, r"_p(\d+)_", 1), F.lit("")))
    short = F.when(name.contains("_results_"), F.nullif(F.regexp_extract(name, r"^p(\d+)_", 1), F.lit("")))
    return F.concat(F.lit("p"), F.coalesce(short, long))


def expand_variables(text: str, env: dict[str, str]) -> str:
    """${NAME} replaced by its value; an unset name stays as it is."""
    return re.sub(r"\$\{(\w+)\}", lambda m: env.get(m[1], m[0]), text)
