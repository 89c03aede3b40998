"""Runs over many files: discovery, skipping, one output per file, reports. A file that fails doesn't end the run."""

from __future__ import annotations

import json
import time
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Config
from ..sources import journal, readers, sinks
from .parsers import parser, with_inputs

def parsed_file(spark: SparkSession, path: str, c: Config) -> DataFrame:
    """The valid rows of a file, by the configuration's parser. One task reads the file (many if it is a large one); many parse its rows, which keep their order."""
    raw = readers.read_addresses(spark, path, c.required_columns)
    if len(files := readers.files_of(spark, path)) == 1:
        fs, p = readers._file_system(spark, files[0])
        if (size := fs.getFileStatus(p).getLen()) <= readers.SPLIT_BYTES:
            raw = readers.spread_in_order(raw, size)
    rows = readers.valid(readers.classified(raw, c.required_columns))
    return parser(c.parser_type, c.complexity_threshold)(with_inputs(rows, c.parser_type), "addr_text", "parsed")


def _process(spark: SparkSession, path: str, modified: int, c: Config, stamp: str) -> dict:
    """The journal's entry for one file, whatever becomes of it. The output is written before its entry, and never over another."""
    name = path.rsplit("/", 1)[-1].rsplit(".", 1)[0]
    out, began = f"{c.batch_output.rstrip('/')}/{name}-{journal.path_key(path)}_processed_{stamp}", time.time()
    entry = {"path": path, "output": None, "rows": 0, "succeeded": 0, "error": None, "modified": modified}
    try:
        rows = parsed_file(spark, path, c).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            ok = rows.agg(F.count_if("parsed.parse_success")).first()[0]
            n = sinks.write_csv(sinks.hybrid(rows, round(time.time() - began, 3), c.parser_type), out)
        finally:
            rows.unpersist()
        entry |= {"output": _qualified(spark, out), "status": "completed", "rows": n, "succeeded": ok}
    except Exception as e:
        entry |= {"status": "failed", "error": f"{type(e).__name__}: {str(e)[:300]}"}
    now = time.time()
    entry |= {"seconds": now - began, "at": now}
    journal.append(spark, f"{c.batch_output.rstrip('/')}/_journal", entry)
    return entry


def _qualified(spark: SparkSession, path: str) -> str:
    fs, p = readers._file_system(spark, path)
    return str(fs.makeQualified(p))


def run_batch(spark: SparkSession, c: Config, skip: bool = True, together: int = 4) -> dict:
    """Processes all files that the patterns find and that aren't done yet; returns the batch report.

    Files run `together` at a time, each as one job over all blocks of its rows. Each file's entry is added
    to the journal in the output folder as soon as its output is there, so a run that was broken
    off at any point goes on where it was: what has no output written to its end, or no entry, is
    processed again, into an output of its own. Files of one name in different folders have
    outputs of different names.
    """
    out = c.batch_output.rstrip("/")
    files = readers.discover(spark, c.batch_input)
    stat = lambda f: readers._file_system(spark, f)
    changed = {f: int(fs.getFileStatus(p).getModificationTime()) for f in files for fs, p in [stat(f)]}
    listed = spark.createDataFrame(sorted(changed.items()), "path string, modified long")
    before = journal.current(journal.entries(spark, f"{out}/_journal"))
    todo = sorted(r.path for r in (journal.pending(listed, before, journal.committed(spark, out)) if skip else listed).collect())
    stamp = datetime.now().strftime("%Y%m%d_%H%M%S_%f")
    with ThreadPoolExecutor(max(1, together)) as pool:
        done = list(pool.map(lambda f: _process(spark, f, changed[f], c, stamp), todo))
    rows = spark.createDataFrame([tuple(e[n.split()[0]] for n in journal.ENTRY.split(", ")) for e in done], journal.ENTRY)
    per_file = rows.select(F.row_number().over(sinks.Window.orderBy("path")).cast("int").alias("file_index"), F.col("path").alias("source_file"), "rows", "succeeded", (F.col("rows") - F.col("succeeded")).alias("errors"), "seconds", F.when(F.col("seconds") > 0, F.col("rows") / F.col("seconds")).otherwise(F.lit(0.0)).alias("rate"))
    report = sinks.batch_report(per_file).first().asDict(recursive=True)
    report |= {"at": stamp, "skipped": [f for f in files if f not in set(todo)], "failed": {e["path"]: e["error"] for e in done if e["status"] == "failed"}}
    for name, text in (("batch_report.json", json.dumps(report, default=str, indent=1)), ("batch_report.txt", sinks.batch_text(report))):
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(f"{out}/_{stamp}_{name}")
    return report
