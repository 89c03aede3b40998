"""Sinks: enriched, flat and comprehensive outputs, metadata and reports, the manifest of processed files."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import location_identifier, sanitize, truncated
from ..operators.advice import about_batch
from ..operators.metrics import LEAST_RATE, UTILISATION_TARGET, batch_score
from ..schema import COMPARED, COUNT_FIELD, FIELDS, RAW_FIELDS, SHORT
from .readers import _file_system
from .shared import stored


@dataclass
class Run:
    """What is known of a run besides its rows."""

    at: str = ""
    seconds: float = 0.0
    gpu_rows: int = 0
    device: str = "CPU"
    rate: float = 0.0
    utilisation: float = 0.0
    efficiency: float = 0.0
    target_rate: float = 2000.0
    errors: list[str] = field(default_factory=list)
    advice: list[str] = field(default_factory=list)


def enriched(rows: DataFrame, original: list[str]) -> DataFrame:
    """The original columns, the twelve parsed fields by their short names, group_id and location_identifier; all as clean text."""
    parsed = [sanitize(F.col(f"parsed.{f}")).alias(SHORT[f]) for f in FIELDS]
    where = location_identifier(sanitize(F.col("parsed.society_name")), sanitize(F.col("parsed.pin_code"))).alias("location_identifier")
    return rows.select(*(sanitize(F.col(c)).alias(c) for c in original), *parsed, F.col("group_id"), where)


#: Values are written as they are, white space at their ends included.
CSV = {"header": "true", "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def write_csv(df: DataFrame, path: str) -> int:
    """Writes CSV with a header and returns the number of rows, counted as they are written; without rows nothing stays."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").options(**CSV).csv(path)
    n = int(seen.get["n"])
    if not n:
        fs, p = _file_system(df.sparkSession, path)
        fs.delete(p, True)
    return n


def flat_results(rows: DataFrame, address: str = "addr_text", order: str = "row_id") -> DataFrame:
    """id from 1, address, eleven fields (blank unless parsed), success, error (blank if parsed), note."""
    ok = F.col("parsed.parse_success")
    keep = lambda f: F.when(ok, F.col(f"parsed.{f}")).otherwise(F.lit(""))
    return ranked(rows, order).select(F.col("ordinal").alias("id"), F.col(address).alias("original_address"), *(keep(f).alias(f) for f in COMPARED), ok.alias("parse_success"), F.when(ok, F.lit("")).otherwise(F.coalesce("parsed.parse_error", F.lit(""))).alias("parse_error"), keep("note").alias("note"))


#: Rows that one range of `ranked` should hold, and the most ranges it makes.
RANGE_ROWS, MAX_RANGES = 250_000, 1 << 15


def ranked(rows: DataFrame, order: str, name: str = "ordinal", ranges: int | None = None) -> DataFrame:
    """Adds the 1-based place of each row in ascending order of a numeric column, without gathering the rows in one task.

    Rows fall into ranges by the column's quantiles, as many as their number asks for; a range's
    first place is the number of rows in the ranges before it, one count for each; places within
    are row numbers per range. Equal values share no order but their own.
    """
    keys = rows.select(F.col(order).cast("double").alias("x"))
    ranges = ranges or min(MAX_RANGES, -(-keys.count() // RANGE_ROWS))
    cuts = sorted(set(keys.approxQuantile("x", [k / ranges for k in range(1, ranges)], 0.2 / ranges))) if ranges > 1 else []
    if not cuts:
        return rows.withColumn(name, F.row_number().over(Window.orderBy(order)).cast("long"))  # one range's rows
    tool = Bucketizer(splits=[-float("inf"), *cuts, float("inf")], inputCol="_x", outputCol="_part", handleInvalid="keep")
    x = tool.transform(rows.withColumn("_x", F.coalesce(F.col(order).cast("double"), F.lit(-1.7e308)))).drop("_x")
    counts = tool.transform(keys.withColumn("_x", F.coalesce("x", F.lit(-1.7e308)))).groupBy("_part").count()
    before = counts.select(F.col("_part"), (F.sum("count").over(Window.orderBy("_part")) - F.col("count")).alias("_before"))
    place = F.row_number().over(Window.partitionBy("_part").orderBy(order)).cast("long") + F.col("_before")
    return x.join(F.broadcast(before), "_part").withColumn(name, place).drop("_part", "_before")


def placed(rows: DataFrame, *order: Column, name: str = "place") -> DataFrame:
    """Adds the 1-based place of each row in an order of any keys, which should be total, without gathering the rows in one task.

    Rows are sorted in ranges by all keys and stored; a range's first place follows from the
    numbers of rows in the ranges before it, of which the driver sees one for each.
    """
    own = stored(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()))
    part, before, total = F.shiftright("_at", 33).cast("long"), [], 0
    for p, n in sorted(tuple(r) for r in own.groupBy(part.alias("p")).count().collect()):
        before.append((p, total))
        total += n
    base = own.sparkSession.createDataFrame(before, "_part long, _before long")
    at = F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return own.withColumn("_part", part).join(F.broadcast(base), "_part").withColumn(name, at).drop("_part", "_before", "_at")


def comprehensive(rows: DataFrame, original: list[str], gpu_rows: int, order: str = "row_id") -> DataFrame:
    """The original columns, parsed_ fields, success and error, and the device of each row: GPU for the first gpu_rows."""
    x = ranked(rows, order)
    return x.select(*original, *(F.col(f"parsed.{f}").alias(f"parsed_{f}") for f in FIELDS), F.col("parsed.parse_success").alias("parse_success"), F.coalesce("parsed.parse_error", F.lit("")).alias("parse_error"), F.when(F.col("ordinal") <= gpu_rows, F.lit("GPU")).otherwise(F.lit("CPU")).alias("processing_device"))


def comprehensive_full(rows: DataFrame, original: list[str], run: Run, order: str = "row_id") -> DataFrame:
    """All of `comprehensive`, with a run's time, device and rates beside each row."""
    return comprehensive(rows, original, run.gpu_rows, order).select(
        *original, *(f"parsed_{f}" for f in FIELDS), "parse_success", "parse_error",
        F.lit(run.at).alias("processing_timestamp"), F.lit(float(run.seconds)).alias("processing_time_seconds"), F.col("processing_device").alias("processed_by_device"), F.lit(run.device).alias("gpu_device_name"),
        F.lit(float(run.rate)).alias("throughput_rate"), F.lit(float(run.utilisation)).alias("gpu_utilization_percent"), F.lit(float(run.efficiency)).alias("processing_efficiency"),
    )


def hybrid(rows: DataFrame, seconds: float = 0.0, method: str = "hybrid_gpu_cpu") -> DataFrame:
    """The nine original columns (empty where a file hasn't them), the twelve fields by their short names, and four about the processing."""
    own = [F.col(c).cast("string").alias(c) if c in rows.columns else F.lit("").alias(c) for c in [*RAW_FIELDS, COUNT_FIELD]]
    return rows.select(*own, *(F.col(f"parsed.{f}").alias(SHORT[f]) for f in FIELDS), F.col("parsed.parse_success").alias("parse_success"), F.coalesce("parsed.parse_error", F.lit("")).alias("parse_error"), F.lit(method).alias("processing_method"), F.lit(float(seconds)).alias("processing_time"))


def metadata(rows: DataFrame) -> DataFrame:
    """One row about a run's result: counts and rates from the records' own success."""
    ok = F.col("parsed.parse_success")
    return rows.agg(F.count(F.lit(1)).alias("total_rows"), F.count_if(ok).alias("successful"), F.count_if(~ok).alias("failed"), F.round(F.avg(ok.cast("double")) * 100, 6).alias("success_rate"))


def file_reports(rows: DataFrame, seconds: DataFrame, by: str = "source_file") -> DataFrame:
    """A row per file: its index in order of names, rows, successes, errors, success rate, seconds and rate. seconds: file and seconds, measured outside."""
    ok = F.col("parsed.parse_success")
    g = rows.groupBy(by).agg(F.count(F.lit(1)).alias("rows"), F.count_if(ok).alias("succeeded"), F.count_if(~ok).alias("errors"))
    x = g.join(seconds, by, "left").withColumn("seconds", F.coalesce("seconds", F.lit(0.0)))
    rate = F.when(F.col("seconds") > 0, F.col("rows") / F.col("seconds")).otherwise(F.lit(0.0))
    place = F.row_number().over(Window.orderBy(by)).cast("int")  # one short row per file
    return x.select(place.alias("file_index"), by, "rows", "succeeded", "errors", F.round(F.col("succeeded") / F.col("rows") * 100, 6).alias("success_rate"), "seconds", F.round(rate, 6).alias("rate"))


def batch_report(files: DataFrame, utilisation: float = 0.0, efficiency: float = 0.0) -> DataFrame:
    """One row over file reports: totals, mean and peak rate, variation of the rates around their mean, score, targets met, advice, and the files as an array."""
    own = F.when(F.col("rate") > 0, F.col("rate"))
    g = files.agg(
        F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), F.coalesce(F.sum("succeeded"), F.lit(0)).alias("succeeded"), F.coalesce(F.avg(own), F.lit(0.0)).alias("mean_rate"), F.coalesce(F.max("rate"), F.lit(0.0)).alias("peak_rate"),
        F.coalesce(F.stddev_pop(own), F.lit(0.0)).alias("spread"), F.array_sort(F.collect_list(F.struct("file_index", "source_file", "rows", "succeeded", "errors", "seconds", "rate"))).alias("details"),
    )
    rate, use, eff = F.col("mean_rate"), F.lit(float(utilisation)), F.lit(float(efficiency))
    variation = F.when(rate > 0, F.col("spread") / rate).otherwise(F.lit(0.0))
    return g.select(
        "files", "rows", "succeeded", F.round(rate, 6).alias("mean_rate"), F.round("peak_rate", 6).alias("peak_rate"), F.round(variation, 6).alias("variation"), F.round(batch_score(rate, use, eff), 6).alias("score"),
        (rate >= LEAST_RATE).alias("rate_target_met"), (use >= UTILISATION_TARGET).alias("utilisation_target_met"), about_batch(rate, use, eff, variation).alias("advice"), "details",
    )


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def first_errors(rows: DataFrame, n: int = 5, order: str = "row_id") -> DataFrame:
    """The first n failed rows and their errors."""
    return rows.filter(~F.col("parsed.parse_success")).orderBy(order).limit(n).select(order, F.col("parsed.parse_error").alias("error"))


def sheets(rows: DataFrame, order: str = "row_id") -> dict[str, DataFrame]:
    """The tables of a workbook: details, summary, quality (rows by number of fields) and failed rows."""
    from ..operators.compare import SHEET_FIELDS, field_count

    shaped = rows.select(order, truncated(F.col("addr_text")).alias("address"), *(F.col(f"parsed.{f}").alias(f) for f in SHEET_FIELDS), field_count("parsed", SHEET_FIELDS).alias("fields"), F.col("parsed.parse_success").alias("ok"), F.coalesce("parsed.parse_error", F.lit("")).alias("error"))
    return {
        "details": shaped.drop("error"),
        "summary": shaped.agg(F.count(F.lit(1)).alias("rows"), F.count_if("ok").alias("parsed"), F.round(F.avg("fields"), 6).alias("fields_per_row")),
        "quality": shaped.groupBy("fields").agg(F.count(F.lit(1)).alias("rows")),
        "failed": shaped.filter("not ok").select(order, "address", "error"),
    }


def report_text(one_row: DataFrame, title: str) -> str:
    """A text report of a one-row table."""
    row = one_row.first()
    return "\n".join([title, "=" * len(title), *(f"{k}: {v}" for k, v in row.asDict().items())]) if row else title


def _section(title: str, values: dict[str, object]) -> list[str]:
    return [title, "-" * len(title), *(f"{k}: {v}" for k, v in values.items()), ""]


def preamble(meta: dict[str, float], run: Run) -> list[str]:
    """The comment lines that precede a comprehensive CSV; Spark writes them beside it, as readers with comment='#' would skip them."""
    total, ok, bad = int(meta["total_rows"]), int(meta["successful"]), int(meta["failed"])
    share = run.gpu_rows / total * 100 if total else 0.0
    out = ["RUN", f"At: {run.at}", f"Seconds: {run.seconds:.2f}", f"Rows: {total:,}", f"Parsed: {ok:,}", f"Failed: {bad:,}", f"Success rate: {meta['success_rate'] or 0:.1f}%", f"Rate: {run.rate:.1f} a second", f"Utilisation: {run.utilisation:.1f}%", f"Efficiency: {run.efficiency:.1f}%", f"Device: {run.device}", f"GPU rows: {run.gpu_rows:,} ({share:.1f}%)", f"CPU rows: {max(0, total - run.gpu_rows):,} ({100 - share if total else 0:.1f}%)"]
    if run.errors:
        out += [f"Errors: {len(run.errors)}", *(f"  - {e}" for e in run.errors[:5])]
    if run.advice:
        out += ["Advice:", *(f"  - {a}" for a in run.advice[:3])]
    return [f"# {x}" for x in out] + ["#"]


def performance_text(meta: dict[str, float], run: Run) -> str:
    """The report of a run: summary, rates against their targets, device, advice."""
    total = int(meta["total_rows"])
    lines = ["PERFORMANCE", "===========", ""]
    lines += _section("Summary", {"Rows": f"{total:,}", "Parsed": f"{int(meta['successful']):,}", "Failed": f"{int(meta['failed']):,}", "Success rate": f"{meta['success_rate'] or 0:.1f}%", "Seconds": f"{run.seconds:.2f}"})
    lines += _section("Rates", {"Rate": f"{run.rate:.1f} a second", "Target": f"{run.target_rate:.0f} a second", "Achieved": f"{run.rate / max(run.target_rate, 1) * 100:.1f}%", "Utilisation": f"{run.utilisation:.1f}%", "Efficiency": f"{run.efficiency:.1f}%"})
    lines += _section("Devices", {"Device": run.device, "GPU rows": f"{run.gpu_rows:,}", "CPU rows": f"{max(0, total - run.gpu_rows):,}"})
    if run.advice:
        lines += _section("Advice", {str(k): a for k, a in enumerate(run.advice, 1)})
    return "\n".join(lines)


def error_text(counts: list[tuple[str, int]], first: list[tuple[object, str]]) -> str:
    """The report of failures: how often each error occurred, and the first rows that failed."""
    total = sum(n for _, n in counts)
    lines = ["ERRORS", "======", "", f"Total: {total:,}", ""]
    lines += _section("By kind", {e: f"{n:,} ({n / total * 100:.1f}%)" for e, n in sorted(counts, key=lambda x: (-x[1], x[0]))}) if total else ["none", ""]
    return "\n".join(lines + (_section("First rows", {str(k): e for k, e in first}) if first else []))


def batch_text(report: dict) -> str:
    """The report of a batch: totals, rates, targets, then a line per file."""
    lines = ["BATCH", "=====", ""]
    lines += _section("Summary", {"Files": report["files"], "Rows": f"{report['rows']:,}", "Parsed": f"{report['succeeded']:,}", "Mean rate": f"{report['mean_rate']:.1f}", "Peak rate": f"{report['peak_rate']:.1f}", "Score": f"{report['score']:.1f}"})
    lines += _section("Files", {f"{d['file_index']}. {d['source_file']}": f"{d['rows']:,} rows, {d['errors']:,} errors, {d['seconds']:.2f} s" for d in report["details"]})
    return "\n".join(lines + _section("Advice", {str(k): a for k, a in enumerate(report["advice"], 1)}))


def name_list(names: DataFrame, path: str, column: str = "society_name") -> None:
    names.select(column).orderBy(column).write.mode("overwrite").text(path)


def first_names(names: DataFrame, n: int = 20, column: str = "society_name") -> DataFrame:
    """The first n distinct names in order."""
    return names.select(column).orderBy(column).limit(n)


def unprocessed(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """Files that the manifest doesn't list as completed with the same content. Columns: path, sha256; the manifest has status too."""
    return files.join(manifest.filter("status = 'completed'").select("path", "sha256"), ["path", "sha256"], "left_anti")


def append_manifest(entries: DataFrame, path: str) -> None:
    """Adds rows (path, sha256, status, rows) to the manifest; the newest row of a path counts."""
    entries.withColumn("at", F.current_timestamp()).write.mode("append").parquet(path)


def current_manifest(manifest: DataFrame) -> DataFrame:
    return manifest.groupBy("path").agg(F.max_by(F.struct("sha256", "status", "rows"), "at").alias("e")).select("path", "e.*")


def to_process(files: DataFrame, manifest: DataFrame, outputs: DataFrame) -> DataFrame:
    """Files (path, modified) that are still to be processed.

    Skipped are those that the manifest lists as completed and whose output is there, and those
    for which an output with their name, <name>_processed_..., is newer than they are. outputs: path, modified.
    """
    name = lambda c: F.regexp_extract(c, r"([^/]*?)(?:\.[^./]*)?$", 1)
    made = outputs.select(F.col("path").alias("output"), F.regexp_extract("path", r"([^/]*)_processed_[^/]*$", 1).alias("base"), F.col("modified").alias("made")).filter("base <> ''")
    done = manifest.filter("status = 'completed'").join(outputs.select(F.col("path").alias("output")), "output", "left_semi").select("path").distinct()
    newest = made.groupBy("base").agg(F.max("made").alias("made"))
    rest = files.join(done, "path", "left_anti").withColumn("base", name(F.col("path"))).join(newest, "base", "left")
    return rest.filter(F.col("made").isNull() | (F.col("made") <= F.col("modified"))).select("path", "modified")
