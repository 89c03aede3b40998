"""A journal of what a run has done: one small file per entry, complete or not there at all.

An entry is written beside the journal and takes its place by a rename, which file systems do as
one step; nothing that is there is ever changed, so a reader sees whole entries, and a run that
dies loses at most the entry it was writing. An output counts once it has both its _SUCCESS, which
Spark writes last, and its entry.
"""

from __future__ import annotations

import hashlib
import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .readers import _file_system

ENTRY = "path string, output string, status string, rows long, succeeded long, seconds double, error string, modified long, at double"
COMMITTED = "_SUCCESS"


def path_key(path: str) -> str:
    """Eight characters that tell files of one name in different folders apart."""
    return hashlib.sha256(path.encode()).hexdigest()[:8]


def append(spark: SparkSession, folder: str, entry: dict) -> None:
    """Adds an entry. Raises OSError if the file system refuses."""
    fs, target = _file_system(spark, f"{folder}/{entry['at']:017.6f}-{uuid.uuid4().hex}.json")
    _, draft = _file_system(spark, f"{folder}/_draft-{uuid.uuid4().hex}")
    stream = fs.create(draft, False)
    try:
        stream.write(bytearray((json.dumps(entry) + "\n").encode()))
    finally:
        stream.close()
    if not fs.rename(draft, target):
        raise OSError(f"can't write to {folder}")


def entries(spark: SparkSession, folder: str) -> DataFrame:
    """All entries; none where there is no journal."""
    fs, p = _file_system(spark, folder)
    if not fs.exists(p) or not any(f.getPath().getName().endswith(".json") for f in fs.listStatus(p)):
        return spark.createDataFrame([], ENTRY)
    return spark.read.schema(ENTRY).json(f"{folder}/*.json")


def current(journal: DataFrame) -> DataFrame:
    """The last entry of each path."""
    fields = [c for c in journal.columns if c != "path"]
    return journal.groupBy("path").agg(F.max_by(F.struct(*fields), "at").alias("e")).select("path", "e.*")


def committed(spark: SparkSession, folder: str, mark: str = "_processed_") -> DataFrame:
    """path and modified (of _SUCCESS) of the folder's outputs that were written to their end."""
    fs, p = _file_system(spark, folder)
    found = []
    for f in fs.listStatus(p) if fs.exists(p) else []:
        done = spark._jvm.org.apache.hadoop.fs.Path(f.getPath(), COMMITTED)
        if f.isDirectory() and mark in f.getPath().getName() and fs.exists(done):
            found.append((str(f.getPath()), int(fs.getFileStatus(done).getModificationTime())))
    return spark.createDataFrame(found, "path string, modified long")


def pending(files: DataFrame, done: DataFrame, outputs: DataFrame) -> DataFrame:
    """Of files (path, modified) those still to be processed.

    A file is done if its last entry says completed and its output is committed (a file without
    rows has none), and it hasn't changed since. Outputs that no entry names aren't anyone's.
    """
    kept = done.filter("status = 'completed'").join(outputs.select(F.col("path").alias("output"), F.lit(True).alias("there")), "output", "left").filter("there or rows = 0")
    kept = kept.select("path", F.col("modified").alias("_seen"))
    return files.join(kept, "path", "left").filter("_seen is null or _seen < modified").select("path", "modified")


# State: versions beside each other, of which the last complete one counts


def _versions(spark: SparkSession, path: str) -> list[tuple[str, bool]]:
    """Names of the versions in their order, and whether each is complete."""
    fs, p = _file_system(spark, path)
    names = sorted(f.getPath().getName() for f in (fs.listStatus(p) if fs.exists(p) else []) if f.isDirectory() and f.getPath().getName().startswith("v"))
    return [(n, bool(fs.exists(spark._jvm.org.apache.hadoop.fs.Path(p, f"{n}/{COMMITTED}")))) for n in names]


def save_state(state: DataFrame, path: str) -> None:
    """Writes the next version of the state at path; it counts from the moment its _SUCCESS is there, and the one before until then. Nothing is renamed; older versions are deleted afterwards."""
    spark = state.sparkSession
    before = _versions(spark, path)
    number = int(before[-1][0][1:11]) + 1 if before else 0
    state.write.parquet(f"{path}/v{number:010d}-{uuid.uuid4().hex}")
    for name, _ in before:
        fs, p = _file_system(spark, f"{path}/{name}")
        fs.delete(p, True)


def load_state(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The last complete version at path; an empty state where none has been saved."""
    whole = [name for name, complete in _versions(spark, path) if complete]
    return spark.read.schema(schema).parquet(f"{path}/{whole[-1]}") if whole else spark.createDataFrame([], schema)
