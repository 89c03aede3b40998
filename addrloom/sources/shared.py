"""Tables between the steps of an operator, in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where that is unset, a temporary folder, but on one machine only."""
    if not (base := spark.conf.get("spark.checkpoint.dir", None)):
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir has to name a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="addrloom-shared-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def stored(df: DataFrame) -> DataFrame:
    """Writes df as Parquet and reads it back: cuts lineage, and what follows survives lost executors."""
    path = f"{shared_dir(df.sparkSession)}/addrloom-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._addrloom_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes what `stored` has written for these tables, once nothing reads them any more."""
    for t in tables:
        if path := getattr(t, "_addrloom_path", None):
            p = t.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(t.sparkSession._jsc.hadoopConfiguration()).delete(p, True)
