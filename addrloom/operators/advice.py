"""Advice from thresholds: about a run, about benchmark results, about a batch of files. Each rule is a condition and a line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .metrics import LEAST_RATE, UTILISATION_TARGET


def lines(rules: list[tuple[Column, str]], otherwise: str | None = None) -> Column:
    """The lines whose conditions hold, in order; `otherwise` alone if none does. An unknown condition doesn't hold."""
    found = F.filter(F.array(*(F.when(when, F.lit(text)) for when, text in rules)), lambda x: x.isNotNull())
    return found if otherwise is None else F.when(F.size(found) == 0, F.array(F.lit(otherwise))).otherwise(found)


def about_run(rate: Column, utilisation: Column, bottleneck: Column, memory: Column, temperature: Column, target_rate: float = 2000.0, target_utilisation: float = UTILISATION_TARGET) -> Column:
    """Advice on one run: rate in rows a second, utilisation and memory in percent, temperature in degrees."""
    low_use, low_rate = utilisation < target_utilisation, rate < target_rate * 0.8
    return lines([
        (low_use & (utilisation < 50), "utilisation is very low: larger batches, or fewer rows for the CPU"),
        (low_use & (utilisation >= 50) & (utilisation < 70), "utilisation is low: a longer queue, or more streams"),
        (low_rate & (rate < target_rate * 0.5), "rate is below half the target: compile the model, use half precision"),
        (low_rate & (rate >= target_rate * 0.5), "rate is below the target: larger batches, or more memory for them"),
        (bottleneck == "data_feeding", "feeding is slow: more feeders, or cheaper preparation of batches"),
        (bottleneck == "result_collection", "collecting is slow: more collectors, or cheaper output"),
        (memory > 95, "memory is nearly full: smaller batches"),
        (memory < 70, "memory is free: larger batches"),
        (temperature > 80, "temperature is high: check the cooling"),
    ])


def about_benchmarks(summary: DataFrame) -> DataFrame:
    """Advice on a benchmark summary, a row per line with its place; configurations with a low success rate by name."""
    best = summary.agg(F.max("avg_throughput").alias("rate"), F.max("avg_utilisation").alias("use"), F.count(F.lit(1)).alias("n"))
    general = best.select(F.explode(F.when(F.col("n") == 0, F.array(F.lit("no successful runs"))).otherwise(lines([
        (F.col("rate") < 1000, "rate is low: accelerate, enlarge batches or compile the model"),
        ((F.col("rate") >= 1000) & (F.col("rate") < 1500), "rate is moderate: tune batch sizes and the queue"),
        (F.col("use") < 70, "utilisation is low: enlarge batches or feed faster"),
        (F.col("use") > 95, "utilisation is very high: watch heat and memory"),
    ]))).alias("advice"))
    failing = summary.filter("success_rate < 90").select(F.concat(F.lit("low success rate: "), F.col("configuration")).alias("advice"))
    return general.unionByName(failing)


def about_suite(summary: DataFrame, target_rate: float = 2000.0, memory_limited: bool = False, gpu_memory_limited: bool = False, cpu_limited: bool = False) -> DataFrame:
    """Advice on a suite by its best configuration, the machine's limits and the spread among configurations: one row, an array."""
    own = summary.agg(F.max_by("avg_utilisation", "avg_throughput").alias("use"), F.max("avg_throughput").alias("rate"), F.min("avg_throughput").alias("worst"), F.count(F.lit(1)).alias("n"))
    rate, use = F.col("rate"), F.col("use")
    some = lines([
        (rate < target_rate * 0.5, "best rate is below half the target: better hardware, or acceleration"),
        ((rate >= target_rate * 0.5) & (rate < target_rate * 0.8), "best rate is below the target: larger batches, or a compiled model"),
        (use < 70, "utilisation is low: enlarge batches or feed faster"),
        (use > 95, "utilisation is very high: watch heat and memory"),
        (F.lit(memory_limited), "little memory: smaller batches"),
        (F.lit(gpu_memory_limited), "little GPU memory: half precision, smaller batches"),
        (F.lit(cpu_limited), "few cores: fewer rows for the CPU"),
        ((F.col("n") > 1) & (rate > F.col("worst") * 1.5), "configurations differ much: keep to the best"),
    ])
    return own.select(F.when(F.col("n") == 0, F.array(F.lit("no results"))).otherwise(some).alias("advice"))


def about_batch(rate: Column, utilisation: Column, efficiency: Column, variation: Column) -> Column:
    """Advice on a batch of files: mean rate, utilisation, efficiency (percent), and variation of the files' rates around the mean."""
    return lines([
        (rate < LEAST_RATE, "raise throughput"), (utilisation < UTILISATION_TARGET, "raise utilisation"), (efficiency < 80, "raise efficiency"),
        (variation > 0.3, "files differ much: like sizes, like batches"),
    ], "targets achieved")
