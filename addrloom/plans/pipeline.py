"""The consolidation pipeline from files to enriched files and statistics."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Config
from ..operators import consolidate
from ..sources import readers, sinks, workbook
from .parsers import parser, with_inputs


def consolidated(rows: DataFrame, fuzzy: bool = False, threshold: float = consolidate.THRESHOLD, normalize: bool = True) -> DataFrame:
    """Parsed rows with name_key, pin_key and group_id."""
    keyed = consolidate.keyed(rows, normalize)
    if fuzzy:
        keyed = consolidate.with_leaders(keyed, consolidate.fuzzy_leaders(keyed, threshold))
    return consolidate.group_members(keyed)


def consolidate_files(spark: SparkSession, c: Config) -> str:
    """Reads, validates, parses, groups and writes, a workbook too if one is asked for; returns the report. The parsed rows are kept for the two passes over them."""
    raw = readers.read_addresses(spark, c.input_path, c.required_columns)
    checked = readers.classified(raw, c.required_columns).withColumn("row_id", F.monotonically_increasing_id())
    parse = parser(c.parser_type, c.complexity_threshold)
    rows = consolidated(parse(with_inputs(readers.valid(checked), c.parser_type), "addr_text", "parsed"), c.fuzzy, c.fuzzy_threshold, c.normalize).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        written = sinks.write_csv(sinks.enriched(rows, [x for x in raw.columns if x != "source_file"]), c.output_path)
        if c.report_path:
            workbook.write_workbook(sinks.sheets(rows), c.report_path)
        stats = consolidate.group_stats(consolidate.exact_groups(rows), rows)
        return sinks.report_text(stats.withColumn("written", F.lit(written)), "Consolidation")
    finally:
        rows.unpersist()
