"""Complexity of an address, 0 to 1, from the kinds of words it holds, its length and its numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import word_count

# Weight and patterns of each kind, in the order in which they are added.
KINDS = [
    (0.30, ["road", "street", "lane", "marg", "path", "avenue", "cross", "galli"]),
    (0.25, ["near", "opposite", "behind", "beside", "next to", "close to", "besides"]),
    (0.20, ["society", "complex", "residency", "apartments", "towers", "enclave", "chembers", "nisarg"]),
    (0.15, ["phase", "sector", "block", "wing", "plot", "survey", "nagar", "vihar"]),
    (0.05, [","]),
    (0.05, ["floor", "flat", "unit", "apartment", "shop", "office", "daisy", "center"]),
]


def complexity(c: Column) -> Column:
    """Each kind adds its weight times the share of its patterns that occur; then length, words, and three or more numbers."""
    c = F.coalesce(c, F.lit(""))
    low, total = F.lower(c), F.lit(0.0)
    for weight, patterns in KINDS:
        hits = sum((low.contains(p).cast("int") for p in patterns), F.lit(0))
        total = total + F.least(hits / F.lit(float(len(patterns))), F.lit(1.0)) * weight
    total = total + F.least(F.length(c) / F.lit(100.0), F.lit(1.0)) * 0.10
    total = total + F.least(word_count(c) / F.lit(10.0), F.lit(1.0)) * 0.10
    total = total + F.when(F.regexp_count(c, F.lit(r"\d+")) >= 3, F.lit(0.15)).otherwise(F.lit(0.0))
    return F.least(F.greatest(total, F.lit(0.0)), F.lit(1.0))
