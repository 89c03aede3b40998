"""Mergeable distinct counts by postal code: the K least hashes of a code's names.

The least K of several files' least K are the least K of all their rows, so what is merged from
stored sketches equals a sketch from scratch, hash by hash, and a further file costs only its own
rows. Below K names the count is exact; from K on it is estimated from the K-th hash, with a
relative standard error of 1 / sqrt(K - 2). A sketch is a table of rows, not a cell.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import effective_pin
from .pins import _folded

#: Hashes that a sketch keeps: 3.2 % relative standard error. Up to 1,000 Spark limits groups before the shuffle (spark.sql.window.group.limit.threshold).
K = 1000
KEY = ["pin_code", "kind"]
SCHEMA = "pin_code string, kind string, hash long, source string"
_RANGE = float(1 << 60)


def hashed(name: Column) -> Column:
    """The first 60 bits of the name's MD5."""
    return F.conv(F.substring(F.md5(name), 1, 15), 16, 10).cast("long")


def names(rows: DataFrame, source: str = "source_file") -> DataFrame:
    """source, pin_code, kind and name: localities, societies and addresses of successful rows, in lower case; empty ones don't count."""
    ok = F.col("parsed.parse_success")
    of = {"locality": F.col("parsed.locality"), "society": F.col("parsed.society_name"), "address": F.col("addr_text")}
    kinds = F.array(*(F.struct(F.lit(k).alias("kind"), _folded(c, ok).alias("name")) for k, c in of.items()))
    return rows.select(F.col(source).alias("source"), effective_pin(F.col("parsed.pin_code"), F.col("pincode")).alias("pin_code"), F.inline(kinds)).filter("name is not null")


def merge(sketches: DataFrame, by: list[str] = KEY, k: int = K) -> DataFrame:
    """by and hash: the k least distinct hashes of each key. Each task passes on k a key at most, so a hot key's task gets k from each, however many rows the key has."""
    w = Window.partitionBy(*by).orderBy("hash")
    return sketches.select(*by, "hash").distinct().withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= k).drop("_n")


def sketch(names: DataFrame, by: list[str] = KEY, k: int = K) -> DataFrame:
    """The sketches of names by key; a null name is none, a name that repeats is one."""
    return merge(names.select(*by, hashed(F.col("name")).alias("hash")).filter("hash is not null"), by, k)


def save(sketches: DataFrame, folder: str) -> None:
    """Stores the sketches of one or more sources; what the folder holds of the same sources is replaced, others stay. A null source is one of its own."""
    sketches.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("source").parquet(folder)


def load(spark: SparkSession, folder: str) -> DataFrame:
    """The stored sketches of all sources."""
    return spark.read.schema(SCHEMA).parquet(folder)


def estimate(sketches: DataFrame, by: list[str] = KEY, k: int = K) -> DataFrame:
    """by, kept and names: the number of distinct names, exact where fewer than k hashes are kept."""
    g = sketches.groupBy(*by).agg(F.count("hash").alias("kept"), F.max("hash").alias("_last"))
    far = F.lit(float(k - 1) * _RANGE) / (F.col("_last") + 1).cast("double")
    return g.select(*by, "kept", F.when(F.col("kept") < k, F.col("kept").cast("double")).otherwise(far).alias("names"))
