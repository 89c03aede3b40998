"""Consolidation: records that name the same building and postal code form a group."""

from __future__ import annotations

from collections import Counter

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.similarity import common_subsequence, could_reach, sorted_tokens, token_sort_similarity
from ..functions.text import is_blank, normalize_name
from ..sources.shared import stored
from ..workers import ship_package
from . import similar

UNMATCHED = "UNMATCHED"
#: Fields of the parsed record that grouping reads.
READ = ["society_name", "pin_code"]
#: Similarity from which names belong together.
THRESHOLD = 0.85


def _name_key(society: Column, normalize: bool = True) -> Column:
    return F.when(~is_blank(society), normalize_name(society) if normalize else society)


def keyed(df: DataFrame, normalize: bool = True) -> DataFrame:
    """Adds name_key and pin_key, from the parsed record; name_key is null where there is no society: such rows stay unmatched."""
    return df.withColumn("name_key", _name_key(F.col("parsed.society_name"), normalize)).withColumn("pin_key", F.coalesce(F.col("parsed.pin_code"), F.lit("")))


def group_id(name, pin):
    """Deterministic: the same key has the same id in every run."""
    return F.md5(F.concat(name, F.lit("|"), pin))


def named(rows: DataFrame) -> DataFrame:
    """name_key, pin_key, society (of the first row), n and first_row of each distinct name and code; a null name is a name.

    Rows are first counted by the shown name as well: sums and minima of numbers, which a hash
    aggregate takes before the shuffle, without sorting. The first of the shown names is picked
    from what is left. Rows without keys (parsed records that `keyed` hasn't seen) get them once
    for each shown name and code, not row by row.
    """
    society, pin = F.col("parsed.society_name"), F.coalesce(F.col("parsed.pin_code"), F.lit(""))
    bare = "name_key" not in rows.columns
    x = rows.select("row_id", society.alias("society"), pin.alias("pin_key")) if bare else rows.select("row_id", "name_key", "pin_key", society.alias("society"))
    shown = x.groupBy(*(c for c in x.columns if c != "row_id")).agg(F.count(F.lit(1)).alias("n"), F.min("row_id").alias("first_row"))
    if bare:
        shown = shown.withColumn("name_key", _name_key(F.col("society")))
    return shown.groupBy("name_key", "pin_key").agg(F.min_by("society", "first_row").alias("society"), F.sum("n").alias("n"), F.min("first_row").alias("first_row"))


def grouped(names: DataFrame, key: str = "name_key") -> DataFrame:
    """group_id, society_name (of the first record), pin_code, record_count and first_row of names with a group key."""
    none = F.col(key).isNull()
    x = names.withColumn("group_id", F.when(none, F.lit(UNMATCHED)).otherwise(group_id(F.col(key), F.col("pin_key"))))
    g = x.groupBy("group_id").agg(F.min_by(F.struct("society", "pin_key"), "first_row").alias("first"), F.sum("n").alias("record_count"), F.min("first_row").alias("first_row"))
    shown = lambda c: F.when(F.col("group_id") == UNMATCHED, F.lit("")).otherwise(F.col(f"first.{c}"))
    return g.select("group_id", shown("society").alias("society_name"), shown("pin_key").alias("pin_code"), "record_count", "first_row")


def exact_groups(rows: DataFrame) -> DataFrame:
    """group_id, society_name (of the first record), pin_code and record_count; one group UNMATCHED without name."""
    return grouped(named(rows))


def leaders_of(names: list[str], threshold: float) -> list[str]:
    """For distinct names in order of appearance, the first leader each is similar enough to; a name without one leads itself.

    Leaders are kept by the length of their sorted words, so a name is only held against those
    whose length allows the threshold, and, among these, whose characters do.
    """
    leaders: dict[int, list[tuple[int, str, str, Counter[str]]]] = {}
    known: set[str] = set()
    out = []
    for n in names:
        own = sorted_tokens(n)
        found = n
        if n and threshold <= 0:
            found = min((x for v in leaders.values() for x in v), default=(0, n, "", None))[1]
        elif n and own:
            have = Counter(own)
            fits = sorted(x for size, v in leaders.items() if could_reach(len(own), size, threshold) for x in v)
            for _, key, tokens, chars in fits:
                total = len(own) + len(tokens)
                if 2 * (have & chars).total() / total >= threshold and 1 - (total - 2 * common_subsequence(own, tokens)) / total >= threshold:
                    found = key
                    break
        if found == n and n not in known:
            known.add(n)
            leaders.setdefault(len(own), []).append((len(known), n, own, Counter(own)))
        out.append(found)
    return out


def leader_table(names: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Adds leader to names (pin_key, name_key, first_row, whatever else).

    What a row joins depends only on its code, its name and the leaders before it, so the distinct
    names in order of their first rows decide for all rows: the first leader that a name is similar
    enough to, else the name itself. Names without words lead themselves.
    """
    if threshold <= 0:  # a code's first name draws all but the empty ones
        first = names.filter("name_key is not null").groupBy("pin_key").agg(F.min_by("name_key", "first_row").alias("leader"))
        return names.join(first, "pin_key", "left").withColumn("leader", F.when(F.col("name_key") != "", F.col("leader")).otherwise(F.col("name_key")))
    led = similar.leaders(similar.name_table(names.select("pin_key", "name_key", "first_row"), threshold - 1e-6), threshold)
    return names.join(led, ["pin_key", "name_key"], "left").withColumn("leader", F.coalesce("leader", "name_key"))


def fuzzy_leaders(rows: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """pin_key, name_key and leader for each distinct (code, name)."""
    names = stored(rows.filter("name_key is not null").groupBy("pin_key", "name_key").agg(F.min("row_id").alias("first_row")))
    return leader_table(names, threshold).select("pin_key", "name_key", "leader")


def with_leaders(rows: DataFrame, leaders: DataFrame) -> DataFrame:
    """Replaces each row's name by its leader's. The optimizer broadcasts the leaders where they are small."""
    x = rows.join(leaders, ["pin_key", "name_key"], "left")
    return x.withColumn("name_key", F.coalesce("leader", "name_key")).drop("leader")


def fuzzy_groups(rows: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The groups of `exact_groups` with each name replaced by its leader's.

    Rows are counted by code and name and stored, so they are read and parsed once; leaders and
    groups are made of one row per distinct name. The names of rows without a code are one code's
    names like any other's.
    """
    return grouped(leader_table(stored(named(rows)), threshold), "leader")


def candidate_pairs(rows: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """pin_key, left_name, right_name and similarity (six places) of all pairs of a code's distinct names that reach the threshold, the lesser name left."""
    limit = threshold - 1e-6  # similarities are rounded to six places
    n = stored(rows.select("pin_key", "name_key").distinct()).filter("name_key <> ''")  # a filter before it would parse each row once more
    if limit <= 0:
        j = n.alias("a").join(n.alias("b"), (F.col("a.pin_key") == F.col("b.pin_key")) & (F.col("a.name_key") < F.col("b.name_key")))
        ship_package(rows.sparkSession)
        like = F.pandas_udf(lambda x, y: pd.Series([token_sort_similarity(a, b) for a, b in zip(x, y, strict=True)], dtype="float64"), "double")
        out = j.select(F.col("a.pin_key").alias("pin_key"), F.col("a.name_key").alias("left_name"), F.col("b.name_key").alias("right_name"), like("a.name_key", "b.name_key").alias("similarity"))
    else:
        out = similar.pairs(similar.name_table(n, limit), limit).select("left.pin_key", F.col("left.name_key").alias("left_name"), F.col("right.name_key").alias("right_name"), "similarity")
    return out.withColumn("similarity", F.round("similarity", 6)).filter(F.col("similarity") >= threshold)


def group_members(rows: DataFrame, groups: DataFrame | None = None) -> DataFrame:
    """Each row with the id of its group."""
    none = F.col("name_key").isNull()
    return rows.withColumn("group_id", F.when(none, F.lit(UNMATCHED)).otherwise(group_id(F.col("name_key"), F.col("pin_key"))))


def group_stats(groups: DataFrame, rows: DataFrame) -> DataFrame:
    """One row: totals, mean and largest group (the first of equals, unmatched last), unmatched, match rate, parse successes."""
    g = groups.agg(
        F.count(F.lit(1)).alias("total_groups"),
        F.coalesce(F.max("record_count"), F.lit(0)).alias("largest_group_size"),
        F.coalesce(F.max_by("society_name", F.struct("record_count", (F.col("group_id") != UNMATCHED).cast("int"), -F.col("first_row"))), F.lit("")).alias("largest_group_name"),
        F.coalesce(F.sum(F.when(F.col("group_id") == UNMATCHED, F.col("record_count"))), F.lit(0)).alias("unmatched_count"),
    )
    r = rows.agg(F.count(F.lit(1)).alias("total_records"), F.count_if(F.col("parsed.parse_success")).alias("parse_success_count"))
    x = g.crossJoin(F.broadcast(r))  # one row each
    ratio = lambda a, b: F.when(b > 0, a / b).otherwise(F.lit(0.0))
    n = F.col("total_records")
    return x.select(
        "total_records", "total_groups", F.round(ratio(n, F.col("total_groups")), 6).alias("avg_records_per_group"), "largest_group_size", "largest_group_name",
        F.round(ratio(n - F.col("unmatched_count"), n) * 100, 6).alias("match_percentage"), "parse_success_count", (n - F.col("parse_success_count")).alias("parse_failure_count"), "unmatched_count",
    )

