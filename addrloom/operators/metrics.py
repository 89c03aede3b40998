"""Run metrics: rolling throughput, benchmark aggregates, regressions, scores, bottlenecks, retry schedules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Addresses a second and utilisation in percent that runs are held against.
LEAST_RATE, RATE_TARGET, UTILISATION_TARGET = 1500.0, 2000.0, 90.0
# Attempts, base and largest delay in seconds, whether delays double.
RECOVERY = {
    "gpu_processing": (2, 0.5, 5.0, True),
    "memory_allocation": (3, 1.0, 10.0, True),
    "model_loading": (3, 2.0, 30.0, True),
    "timeout": (3, 5.0, 60.0, True),
    "critical_system": (1, 10.0, 10.0, False),
}


def per_second(events: DataFrame, ts: str = "ts", seconds: int = 1) -> DataFrame:
    """Events in each interval that has any."""
    return events.groupBy(F.window(ts, f"{seconds} seconds").alias("w")).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("at"), "n")


def running(rows: DataFrame, value: str, order: str, by: str, last: int | None = None) -> DataFrame:
    """Adds running_mean and running_peak of value within each `by`: from its first row, or over the last rows only."""
    w = Window.partitionBy(by).orderBy(order).rowsBetween(Window.unboundedPreceding if last is None else -(last - 1), Window.currentRow)
    return rows.withColumn("running_mean", F.avg(value).over(w)).withColumn("running_peak", F.max(value).over(w))


def relative(rows: DataFrame, value: str) -> DataFrame:
    """Adds relative_pct, to the mean of all rows (1 at least), and needs_optimization below 80."""
    mean = rows.agg(F.greatest(F.avg(value), F.lit(1.0)).alias("_mean"))
    x = rows.crossJoin(F.broadcast(mean))  # one row
    pct = F.col(value) / F.col("_mean") * 100
    return x.withColumn("relative_pct", pct).withColumn("needs_optimization", pct < 80).drop("_mean")


def benchmark_summary(runs: DataFrame, by: str = "configuration", value: str = "throughput", ok: str = "ok", utilisation: str = "utilisation") -> DataFrame:
    """Per configuration over its successful runs: mean, largest, least, sample deviation (0 for one run), utilisation; success rate over all runs."""
    v = F.when(F.col(ok), F.col(value))
    g = runs.groupBy(by).agg(F.avg(v).alias("avg_throughput"), F.max(v).alias("max_throughput"), F.min(v).alias("min_throughput"), F.coalesce(F.stddev_samp(v), F.lit(0.0)).alias("throughput_std"), F.avg(F.when(F.col(ok), F.col(utilisation))).alias("avg_utilisation"), F.avg(F.col(ok).cast("double")).alias("share"), F.count(F.lit(1)).alias("test_count"))
    return g.filter("avg_throughput is not null").withColumn("success_rate", F.col("share") * 100).drop("share")


def best_configuration(summary: DataFrame, by: str = "configuration") -> DataFrame:
    return summary.agg(F.min_by(by, F.struct(-F.col("avg_throughput"), F.col(by))).alias("best_configuration"), F.max("avg_throughput").alias("best_throughput"))


def ranked_suites(summary: DataFrame, notable: float = 500.0) -> DataFrame:
    """Adds place by best throughput, its gap to the best, and whether the gap is notable. One short row per configuration."""
    w = Window.orderBy(F.col("max_throughput").desc(), "configuration")
    best = summary.agg(F.max("max_throughput").alias("_best"))
    x = summary.withColumn("place", F.row_number().over(w)).crossJoin(F.broadcast(best))  # one row
    return x.withColumn("gap", F.col("_best") - F.col("max_throughput")).withColumn("notable", F.col("gap") > notable).drop("_best")


def recovery_rate(errors: DataFrame, recovered: str = "recovered") -> DataFrame:
    """Errors, those recovered from, and their percentage of one error at least."""
    g = errors.agg(F.count(F.lit(1)).alias("errors"), F.count_if(recovered).alias("recovered"))
    return g.withColumn("recovery_pct", F.round(F.col("recovered") / F.greatest("errors", F.lit(1)) * 100, 6))


def variation(runs: DataFrame, value: str, mean: Column | None = None, limit: float = 0.3) -> DataFrame:
    """Population deviation around a reported mean over that mean, and whether it is above the limit."""
    m = mean if mean is not None else F.avg(value)
    g = runs.agg(m.alias("mean"), F.var_pop(value).alias("var"), F.avg(value).alias("own"))
    var = F.col("var") + (F.col("own") - F.col("mean")) * (F.col("own") - F.col("mean"))
    cv = F.when(F.col("mean") > 0, F.sqrt(var) / F.col("mean")).otherwise(F.lit(0.0))
    return g.select(cv.alias("variation"), (cv > limit).alias("variable"))


def regression(baseline: DataFrame, current: DataFrame, by: str = "configuration", threshold: float = 0.1) -> DataFrame:
    """Change of the mean throughput of configurations that both have; a regression falls below minus the threshold."""
    b = baseline.select(by, F.col("avg_throughput").alias("baseline_throughput"))
    c = current.select(by, F.col("avg_throughput").alias("current_throughput"))
    change = F.when(F.col("baseline_throughput") > 0, (F.col("current_throughput") - F.col("baseline_throughput")) / F.col("baseline_throughput")).otherwise(F.lit(0.0))
    return b.join(c, by).withColumn("change_percent", change * 100).withColumn("regression", change < -threshold)


def capped(value: Column, target: float, points: float) -> Column:
    return F.least(value / target * points, F.lit(points))


def report_score(rate: Column, utilisation: Column, efficiency: Column) -> Column:
    """40 points for the rate, 40 for utilisation, 20 for efficiency (percent)."""
    return capped(rate, RATE_TARGET, 100.0) * 0.4 + capped(utilisation, UTILISATION_TARGET, 100.0) * 0.4 + efficiency * 0.2


def validation_score(rate: Column, utilisation: Column) -> Column:
    return capped(rate, LEAST_RATE, 50.0) + capped(utilisation, UTILISATION_TARGET, 50.0)


def batch_score(rate: Column, utilisation: Column, efficiency: Column) -> Column:
    return capped(rate, LEAST_RATE, 50.0) + capped(utilisation, UTILISATION_TARGET, 30.0) + efficiency * 0.2


def file_efficiency(rate: Column, utilisation: Column, efficiency: Column) -> Column:
    return (efficiency + capped(rate, LEAST_RATE, 100.0) + capped(utilisation, UTILISATION_TARGET, 100.0)) / 3


def tier(rate: Column) -> Column:
    return F.when(rate >= 1500, F.lit("ULTIMATE")).when(rate >= 1000, F.lit("EXCELLENT")).when(rate >= 500, F.lit("GOOD")).otherwise(F.lit("STANDARD"))


def config_name(batch: Column, cpu_ratio: Column, compiled: Column, half: Column) -> Column:
    size = F.when(batch >= 500, F.lit("HighBatch")).when(batch <= 200, F.lit("LowBatch")).otherwise(F.lit("MedBatch"))
    cpu = F.when(cpu_ratio >= 0.05, F.lit("HighCPU")).when(cpu_ratio <= 0.02, F.lit("LowCPU"))
    return F.concat_ws("_", size, cpu, F.when(compiled, F.lit("Compiled")), F.when(half, F.lit("FP16")))


def bottleneck(waiting: Column, workers: Column, results: Column, capacity: Column) -> Column:
    """Where a queue is stuck; empty if nowhere."""
    return F.when((waiting == 0) & (workers > 0), F.lit("data_feeding")).when(results >= capacity * 0.8, F.lit("result_collection")).otherwise(F.lit(""))


def workload_split(total: Column, cpu_ratio: Column, utilisation: Column) -> tuple[Column, Column]:
    """GPU and CPU rows of a batch; utilisation is a fraction. 95 to 98 percent go to the GPU, one row at least to the CPU."""
    ratio = F.when(utilisation > 0.95, F.least(cpu_ratio * 1.5, F.lit(0.05))).when(utilisation < 0.80, F.greatest(cpu_ratio * 0.5, F.lit(0.01))).otherwise(cpu_ratio)
    cpu = F.greatest(F.lit(1), F.floor(total * ratio))
    gpu_share = (total - cpu) / total
    floor95 = F.greatest(F.floor(total * 0.95), total - F.greatest(F.lit(10), F.floor(total * 0.05)))
    gpu = F.when(gpu_share < 0.95, floor95).when(gpu_share > 0.98, total - F.greatest(F.lit(1), F.floor(total * 0.02))).otherwise(total - cpu)
    gpu = F.when(total > 0, gpu).otherwise(F.lit(0)).cast("long")
    return gpu, (total - gpu).cast("long")


def backoff_schedule(spark) -> DataFrame:
    """error_type, attempt (from 0) and delay of every retry."""
    rows = [(e, k, min(base * 2**k, most) if doubles else base) for e, (attempts, base, most, doubles) in RECOVERY.items() for k in range(attempts)]
    return spark.createDataFrame(rows, "error_type string, attempt int, delay double")


def batch_sizes(size: int, attempts: int = 3) -> list[int]:
    """Batch sizes tried after memory runs out: halved each time, 1 at least."""
    return [max(1, size >> k) for k in range(1, attempts + 1)]


def error_counts(errors: DataFrame, by: str = "error_type") -> DataFrame:
    return errors.groupBy(by).agg(F.count(F.lit(1)).alias("errors"))


def recommendations(rate: Column, utilisation: Column, efficiency: Column) -> Column:
    """Advice that applies, in order; one line if none does."""
    rules = F.filter(F.array(
        F.when(rate < LEAST_RATE, F.lit("raise throughput")), F.when(utilisation < UTILISATION_TARGET, F.lit("raise utilisation")), F.when(efficiency < 80, F.lit("raise efficiency")),
    ), lambda x: x.isNotNull())
    return F.when(F.size(rules) == 0, F.array(F.lit("targets achieved"))).otherwise(rules)


def batch_totals(files: DataFrame) -> DataFrame:
    """Over files (rows, succeeded, seconds): sums, and the unweighted mean of their rates."""
    return files.agg(F.count(F.lit(1)).alias("files"), F.sum("rows").alias("rows"), F.sum("succeeded").alias("succeeded"), F.avg(F.when(F.col("seconds") > 0, F.col("rows") / F.col("seconds"))).alias("avg_rate"))
