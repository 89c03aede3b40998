"""Streams: parsing file by file, throughput by second, and consolidation that keeps its leaders as state."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions.rules import rule_parse
from ..operators.consolidate import THRESHOLD, leaders_of
from ..workers import ship_package


def address_stream(spark: SparkSession, folder: str, schema: T.StructType, files_per_trigger: int = 10, fmt: str = "csv") -> DataFrame:
    """Files of a folder as a stream; the number taken at once bounds each batch, and the checkpoint skips what was read."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
    if fmt == "csv":
        reader = reader.option("header", True).option("escape", '"')
    return reader.format(fmt).load(folder)


def parsed_stream(stream: DataFrame, column: str = "addr_text") -> DataFrame:
    return rule_parse(stream, column)


def run_to_parquet(stream: DataFrame, out: str, checkpoint: str) -> None:
    """Processes all that is there, exactly once across restarts, and stops."""
    stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def throughput(stream: DataFrame, ts: str = "ts", seconds: int = 1, late: str = "10 seconds") -> DataFrame:
    """Events per interval; an interval is final once the watermark has passed it."""
    return stream.withWatermark(ts, late).groupBy(F.window(ts, f"{seconds} seconds").alias("w")).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("at"), "n")


CONSOLIDATED = "pin_key string, name_key string, leader string, rows long, leader_rows long"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class _Leaders(StatefulProcessor):
    """A code's leaders, a list in their order, and the rows that each has drawn, a map; both go once the code has been quiet."""

    def __init__(self, threshold: float, quiet: int | None):
        self.threshold, self.quiet = threshold, quiet

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.leaders = handle.getListState("leaders", "name string")
        self.drawn = handle.getMapState("drawn", "name string", "rows long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        got = pd.concat(list(rows)).sort_values("row_id")
        names = got["name_key"].drop_duplicates().tolist()
        known = [x[0] for x in self.leaders.get()] if self.leaders.exists() else []
        found = dict(zip(names, leaders_of([*known, *names], self.threshold)[len(known) :], strict=True))
        if new := [n for n in names if found[n] == n and n not in set(known)]:
            self.leaders.appendList([(n,) for n in new])
        each = got.groupby("name_key", sort=False).size()
        more: dict[str, int] = {}
        for n in names:
            more[found[n]] = more.get(found[n], 0) + int(each[n])
        total = {}
        for leader, n in more.items():
            total[leader] = n + (self.drawn.getValue((leader,))[0] if self.drawn.containsKey((leader,)) else 0)
            self.drawn.updateValue((leader,), (total[leader],))
        if self.quiet is not None:
            for old in list(self.handle.listTimers()):
                self.handle.deleteTimer(old)
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.quiet)
        yield pd.DataFrame({"pin_key": key[0], "name_key": names, "leader": [found[n] for n in names], "rows": [int(each[n]) for n in names], "leader_rows": [total[found[n]] for n in names]})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        self.leaders.clear()
        self.drawn.clear()
        yield pd.DataFrame({"pin_key": pd.Series(dtype=str), "name_key": pd.Series(dtype=str), "leader": pd.Series(dtype=str), "rows": pd.Series(dtype="int64"), "leader_rows": pd.Series(dtype="int64")})

    def close(self) -> None:
        pass


def consolidated_stream(stream: DataFrame, threshold: float = THRESHOLD, quiet: int | None = None) -> DataFrame:
    """pin_key, name_key, leader, rows (of the name in this batch) and leader_rows (that its leader has drawn so far); input columns row_id, pin_key and name_key (not null).

    A code's leaders are only ever added to, one entry each. Within a batch names are taken in
    order of row_id, so a stream whose batches follow that order gives what the batch operator
    gives. With quiet (milliseconds), the state of a code without rows for so long goes, and a
    name that comes later starts anew; such a stream runs on until it is stopped, as timers need
    batches without rows.
    """
    spark = stream.sparkSession
    ship_package(spark)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", _ROCKS)  # keyed state needs it
    return stream.select("pin_key", "row_id", "name_key").groupBy("pin_key").transformWithStateInPandas(_Leaders(threshold, quiet), CONSOLIDATED, "Append", "ProcessingTime" if quiet is not None else "None")
