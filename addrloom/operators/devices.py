"""Rules about machines, as expressions: fixed splits of a batch, conflicts, capacity from hardware, progress, time estimates."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

# Shares of a batch by device, the fastest first; the last device takes what is left.
SPLITS = {
    "70/30": (0.70, 0.30), "65/30/5": (0.65, 0.30, 0.05), "80/1/19": (0.80, 0.01, 0.19), "75/1/24": (0.75, 0.01, 0.24), "90/1/9": (0.90, 0.01, 0.09),
    "85/2/13": (0.85, 0.02, 0.13), "95/5": (0.95, 0.05), "80/20": (0.80, 0.20), "90/10": (0.90, 0.10), "98/2": (0.98, 0.02),
}
#: Seconds to start with, seconds a row, and what an estimate is stretched by to be safe.
START_SECONDS, ROW_SECONDS, SLACK = 10.0, 0.5, 1.5


def fixed_split(total: Column, shares: tuple[float, ...]) -> Column:
    """Array of rows by device: the whole part of each share, the rest for the last device."""
    own = [F.floor(total * F.lit(s)).cast("long") for s in shares[:-1]]
    return F.array(*own, (total - reduce(add, own, F.lit(0))).cast("long"))


def even_split(total: Column, workers: int) -> Column:
    """Array of rows by worker: equal whole parts, the rest for the last."""
    own = F.floor(total / workers).cast("long")
    return F.array(*[own] * (workers - 1), (total - own * (workers - 1)).cast("long"))


def conflict(reserved: Column, streams: Column, intensive: Column, workers: Column, most_workers: Column) -> Column:
    """Whether devices get in each other's way, so that they should work one after the other."""
    return (reserved & (streams >= 2)) | (intensive & (workers >= most_workers)) | ((streams > 0) & (workers > F.floor(most_workers / 2)))


def capacity(gpus: Column, gpu_mb: Column, usable: Column, cores: Column, memory_gb: Column) -> Column:
    """Addresses a second that a machine is expected to make; gpu_mb: memory of all its GPUs together."""
    gpu = F.when(gpu_mb > 8000, F.lit(4.0)).when(gpu_mb > 4000, F.lit(2.5)).otherwise(F.lit(1.5)) * F.when(gpus > 1, F.least(gpus * 0.7, F.lit(2.0))).otherwise(F.lit(1.0))
    cpu = F.when(cores >= 16, F.lit(1.3)).when(cores >= 8, F.lit(1.1)).otherwise(F.lit(1.0))
    memory = F.when(memory_gb >= 32, F.lit(1.2)).when(memory_gb >= 16, F.lit(1.1)).otherwise(F.lit(1.0))
    return F.floor(F.lit(500.0) * F.when((gpus > 0) & usable, gpu).otherwise(F.lit(1.0)) * cpu * memory + 1e-9).cast("long")


def settings(gpus: Column, gpu_mb: Column, cores: Column, memory_gb: Column, least_gpu_mb: Column) -> dict[str, Column]:
    """Batch size, queue, CPU share and limits that fit a machine; least_gpu_mb: memory of its smallest GPU."""
    each = gpu_mb / F.greatest(gpus, F.lit(1))
    by_gpu = lambda large, middle, small, none: F.when(gpus <= 0, F.lit(none)).when(each > 8000, F.lit(large)).when(each > 4000, F.lit(middle)).otherwise(F.lit(small))
    return {
        "batch_size": by_gpu(600, 400, 200, 400),
        "queue_size": by_gpu(15, 10, 8, 10),
        "cpu_ratio": F.when(cores >= 16, F.lit(0.01)).when(cores >= 8, F.lit(0.02)).otherwise(F.lit(0.03)),
        "streams": F.when(gpus > 0, F.least(gpus * 2, F.lit(4))).otherwise(F.lit(2)).cast("int"),
        "workers": F.when(cores < 4, F.lit(1)).otherwise(F.greatest(F.lit(2), F.floor(cores / 4))).cast("int"),
        "memory_limited": memory_gb < 8,
        "gpu_memory_limited": (gpus > 0) & (least_gpu_mb < 4000),
        "cpu_limited": cores < 4,
    }


def tuning(gpu_gb: Column, cores: Column, target: Column) -> dict[str, Column]:
    """Parameters by GPU memory, cores and target rate, as a validator recommends them."""
    gpu = lambda a, b, c: F.when(gpu_gb >= 12, F.lit(a)).when(gpu_gb >= 8, F.lit(b)).otherwise(F.lit(c))
    cpu = lambda a, b, c: F.when(cores >= 16, F.lit(a)).when(cores >= 8, F.lit(b)).otherwise(F.lit(c))
    rate = lambda a, b, c: F.when(target >= 2500, F.lit(a)).when(target >= 2000, F.lit(b)).otherwise(F.lit(c))
    return {
        "batch_size": gpu(800, 600, 400), "memory_share": gpu(0.95, 0.90, 0.85), "queue_size": gpu(15, 12, 8), "streams": gpu(3, 2, 2),
        "cpu_ratio": cpu(0.02, 0.03, 0.05), "workers": cpu(4, 3, 2), "cpu_batch_size": cpu(75, 60, 50), "log_interval": rate(5, 10, 15), "utilisation": rate(0.95, 0.90, 0.85),
    }


def progress(done: Column, total: Column, seconds: Column) -> dict[str, Column]:
    """Percent done, rows a second so far, and minutes to go (0 while nothing is done)."""
    rate = F.when(seconds > 0, done / seconds).otherwise(F.lit(0.0))
    return {"percent": F.when(total > 0, done / total * 100).otherwise(F.lit(0.0)), "rate": rate, "eta_minutes": F.when(rate > 0, (total - done) / rate / 60).otherwise(F.lit(0.0))}


def time_estimate(lines: Column, valid_share: Column) -> dict[str, Column]:
    """Rows with an address among the lines of a file, seconds to parse them, and the same with slack."""
    rows = F.floor(lines * valid_share + 1e-9).cast("long")
    seconds = F.lit(START_SECONDS) + rows * F.lit(ROW_SECONDS)
    return {"rows": rows, "seconds": seconds, "safe_seconds": seconds * F.lit(SLACK)}
