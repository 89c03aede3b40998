"""Summaries by postal code, consolidation ratios, top lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import effective_pin, none_if_empty, strip, title_case, truncated
from ..sources.shared import stored


def pin_counts(rows: DataFrame) -> DataFrame:
    """The counts of `pin_summary` without its lists, which may be as long as a code has names: nothing here grows with a code."""
    ok = F.col("parsed.parse_success")
    x = rows.select(effective_pin(F.col("parsed.pin_code"), F.col("pincode")).alias("pin_code"), ok.alias("ok"), _folded(F.col("parsed.locality"), ok).alias("locality"), _folded(F.col("parsed.society_name"), ok).alias("society"))
    g = x.groupBy("pin_code").agg(F.count(F.lit(1)).alias("total_addresses"), F.count_if("ok").alias("successful_parses"), F.countDistinct("locality").alias("distinct_localities_count"), F.countDistinct("society").alias("distinct_societies_count"))
    return g.withColumn("success_rate_percent", F.col("successful_parses") / F.col("total_addresses") * 100)


def by_size(summary: DataFrame) -> DataFrame:
    """A summary from the largest code to the smallest, equal ones by code: totally ordered, by ranges."""
    return summary.orderBy(F.col("total_addresses").desc(), "pin_code")


def _folded(c: Column, on: Column) -> Column:
    return F.when(on, none_if_empty(F.lower(strip(c))))


def _combined(rows: DataFrame) -> DataFrame:
    """pin_code, locality, society, n and ok: rows by code and both folded names (of successes), counted by hash and stored, so that rows are parsed once."""
    ok = F.col("parsed.parse_success")
    x = rows.select(effective_pin(F.col("parsed.pin_code"), F.col("pincode")).alias("pin_code"), ok.alias("ok"), _folded(F.col("parsed.locality"), ok).alias("locality"), _folded(F.col("parsed.society_name"), ok).alias("society"))
    return stored(x.groupBy("pin_code", "locality", "society").agg(F.count(F.lit(1)).alias("n"), F.count_if("ok").alias("ok")))


def pin_names(rows: DataFrame, combined: DataFrame | None = None) -> DataFrame:
    """pin_code, kind (locality or society), name and addresses: the distinct names of each code as a long table, of which no row grows with a code."""
    x = _combined(rows) if combined is None else combined
    kinds = F.array(*(F.struct(F.lit(k).alias("kind"), F.col(k).alias("name")) for k in ("locality", "society")))
    return x.select("pin_code", "n", F.inline(kinds)).filter("name is not null").groupBy("pin_code", "kind", "name").agg(F.sum("n").alias("addresses"))


def pin_summary(rows: DataFrame, sample: int = 5, titles: bool = True) -> DataFrame:
    """One row per effective code: addresses, successes, rate, distinct localities and societies of successes (in any case), their lists.

    Names are folded to lower case for counting; titles only shape the lists. success_rate_percent
    isn't rounded. Names are made distinct by grouping before any list; all_localities and
    all_societies are as long as a code has names, for which `pin_names` is the table without bound.
    """
    combined = _combined(rows)
    g = combined.groupBy("pin_code").agg(F.sum("n").alias("total_addresses"), F.sum("ok").alias("successful_parses"))
    shape = title_case if titles else (lambda c: c)
    of = lambda kind: F.when(F.col("kind") == kind, shape(F.col("name")))
    by_name = lambda kind: F.transform(F.array_sort(F.collect_list(F.when(F.col("kind") == kind, F.struct(F.col("name"), of(kind).alias("shown"))))), lambda x: x["shown"])
    lists = pin_names(rows, combined).groupBy("pin_code").agg(by_name("locality").alias("l"), by_name("society").alias("s"))
    short = lambda c: F.concat(F.array_join(F.slice(c, 1, sample), "; "), F.when(F.size(c) > sample, F.lit("...")).otherwise(F.lit("")))
    none = F.array().cast("array<string>")
    g = g.join(lists, "pin_code", "left").withColumn("l", F.coalesce("l", none)).withColumn("s", F.coalesce("s", none))
    return g.select(
        "pin_code", "total_addresses", "successful_parses", (F.col("successful_parses") / F.col("total_addresses") * 100).alias("success_rate_percent"),
        F.size("l").cast("long").alias("distinct_localities_count"), F.size("s").cast("long").alias("distinct_societies_count"), short(F.col("l")).alias("localities_sample"), short(F.col("s")).alias("societies_sample"),
        F.array_join("l", "; ").alias("all_localities"), F.array_join("s", "; ").alias("all_societies"),
    )


def consolidation_by_pin(rows: DataFrame) -> DataFrame:
    """Successes only, names as they are: distinct societies and localities per code, and by how much they are fewer than addresses."""
    x = rows.filter("parsed.parse_success").select(effective_pin(F.col("parsed.pin_code"), default="Unknown").alias("pin_code"), none_if_empty(F.col("parsed.society_name")).alias("s"), none_if_empty(F.col("parsed.locality")).alias("l"))
    g = x.groupBy("pin_code").agg(F.count(F.lit(1)).alias("total_addresses"), F.countDistinct("s").alias("distinct_societies"), F.countDistinct("l").alias("distinct_localities"))
    pct = lambda c: F.round((F.col("total_addresses") - F.col(c)) / F.col("total_addresses") * 100, 6)
    return g.select("*", pct("distinct_societies").alias("society_consolidation_pct"), pct("distinct_localities").alias("locality_consolidation_pct"))


def consolidation_levels(summary: DataFrame) -> DataFrame:
    """One row over a code summary: how far societies, localities and codes consolidate addresses, and means per code."""
    g = summary.agg(F.sum("total_addresses").alias("total_addresses"), F.sum("distinct_societies_count").alias("societies"), F.sum("distinct_localities_count").alias("localities"), F.count(F.lit(1)).alias("pins"))
    n = F.col("total_addresses")
    out = ["total_addresses", "societies", "localities", "pins"]
    return g.select(
        *out, *(F.round((n - F.col(c)) / n * 100, 6).alias(f"{c}_pct") for c in out[1:]), *(F.round(n / F.when(F.col(c) > 0, F.col(c)), 6).alias(f"{c}_factor") for c in out[1:]),
        F.round(n / F.col("pins"), 6).alias("addresses_per_pin"), F.round(F.col("societies") / F.col("pins"), 6).alias("societies_per_pin"), F.round(F.col("localities") / F.col("pins"), 6).alias("localities_per_pin"),
    )


def top(summary: DataFrame, by: str, n: int, columns: list[str] | None = None) -> DataFrame:
    """The n codes with the most `by`; equal ones by code."""
    return summary.orderBy(F.col(by).desc(), F.col("pin_code")).limit(n).select(*(columns or ["pin_code", "total_addresses", by] if by != "total_addresses" else columns or ["pin_code", by]))


def samples(rows: DataFrame, n: int = 3) -> DataFrame:
    """The first n rows of each code, with shortened addresses."""
    x = rows.select("row_id", effective_pin(F.col("parsed.pin_code"), F.col("pincode")).alias("pin_code"), truncated(F.col("addr_text")).alias("address"), F.col("parsed.society_name").alias("society"), F.col("parsed.locality").alias("locality"))
    return x.withColumn("place", F.row_number().over(Window.partitionBy("pin_code").orderBy("row_id"))).filter(F.col("place") <= n)


def quality_buckets(summary: DataFrame, least: int = 10) -> DataFrame:
    """Codes of at least `least` addresses that nearly all parse, or mostly don't."""
    big = F.col("total_addresses") >= least
    return summary.agg(F.count_if(big & (F.col("success_rate_percent") > 90)).alias("high_quality"), F.count_if(big & (F.col("success_rate_percent") < 50)).alias("low_quality"))


def societies(rows: DataFrame) -> DataFrame:
    """Distinct names, stripped, none empty."""
    return rows.select(strip(F.col("parsed.society_name")).alias("society_name")).filter("society_name <> ''").distinct()


def keyword_buckets(names: DataFrame, keywords: tuple[str, ...] = ("apartment", "society", "complex", "tower", "residency")) -> DataFrame:
    return names.agg(F.count(F.lit(1)).alias("names"), *(F.count_if(F.lower("society_name").contains(k)).alias(k) for k in keywords))


def diversity(rows: DataFrame) -> DataFrame:
    return rows.agg(F.countDistinct(none_if_empty(F.col("parsed.city"))).alias("cities"), F.countDistinct(none_if_empty(F.col("parsed.pin_code"))).alias("pins")).select((F.col("cities") + F.col("pins")).alias("diversity"), "cities", "pins")
