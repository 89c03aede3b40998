"""Measured runs: what each stage took, recorded in a table that comparisons read."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

RUN = "stage string, rows long, succeeded long, bytes long, seconds double, at double"


def record(rows: DataFrame, stages: dict[str, Callable[[DataFrame], DataFrame]], path: str, text: str = "addr_text", result: str = "parsed") -> DataFrame:
    """Runs each stage over all rows, its result going nowhere, and appends to the table at path: rows, successes, bytes read of the text column, and seconds. Returns that table.

    Counts are observed as the rows go by, so nothing is run twice. Seconds are the driver's, of the whole
    job; the table holds a row per stage and run.
    """
    done = []
    for name, stage in stages.items():
        seen, began = Observation(), time.time()
        out = stage(rows).observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(F.col(f"{result}.parse_success")).alias("succeeded"), F.coalesce(F.sum(F.octet_length(text)), F.lit(0)).alias("bytes"))
        out.write.format("noop").mode("overwrite").save()
        now = time.time()
        done.append((name, int(seen.get["rows"]), int(seen.get["succeeded"]), int(seen.get["bytes"]), now - began, now))
    spark = rows.sparkSession
    spark.createDataFrame(done, RUN).coalesce(1).write.mode("append").parquet(path)
    return spark.read.schema(RUN).parquet(path)


def latest(runs: DataFrame) -> DataFrame:
    """The last run of each stage, with milliseconds a row and rows a second (0 where nothing was run)."""
    g = runs.groupBy("stage").agg(F.max_by(F.struct("rows", "succeeded", "bytes", "seconds"), "at").alias("r")).select("stage", "r.*")
    ratio = lambda a, b: F.when(b > 0, a / b).otherwise(F.lit(0.0))
    return g.withColumn("ms", ratio(F.col("seconds") * 1000, F.col("rows"))).withColumn("rate", ratio(F.col("rows"), F.col("seconds")))


def with_measured(metrics: DataFrame, runs: DataFrame, name: str = "parser") -> DataFrame:
    """A comparison's rows with ms, rate, rows and bytes of the last recorded run of each; null for one that wasn't run."""
    return metrics.drop("ms").join(latest(runs).select(F.col("stage").alias(name), "ms", "rate", "rows", "succeeded", "bytes"), name, "left")
