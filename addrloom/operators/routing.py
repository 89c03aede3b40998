"""Routing between the rule parser and an entity recogniser, fallback, and the threshold that gives a share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.complexity import complexity
from ..schema import failed

THRESHOLD = 0.6
RULES, ENTITIES = "rules", "entities"


def routed(df: DataFrame, column: str = "addr_text", threshold: float = THRESHOLD) -> DataFrame:
    """Adds complexity and route."""
    return df.withColumn("complexity", complexity(F.col(column))).withColumn("route", F.when(F.col("complexity") >= threshold, F.lit(ENTITIES)).otherwise(F.lit(RULES)))


def _noted(c: Column, note: Column) -> Column:
    return c.withField("note", note)


def resolved(df: DataFrame, rules: str = "by_rules", entities: str = "by_entities", out: str = "parsed", fallback: bool = True) -> DataFrame:
    """The routed parser's record; if it failed, the other's; if both failed, one error for both. Adds `used` and `fell_back`."""
    first = F.col("route") == ENTITIES
    own, other = F.when(first, F.col(entities)).otherwise(F.col(rules)), F.when(first, F.col(rules)).otherwise(F.col(entities))
    name, other_name = F.when(first, F.lit(ENTITIES)).otherwise(F.lit(RULES)), F.when(first, F.lit(RULES)).otherwise(F.lit(ENTITIES))
    score = F.format_number("complexity", 2)  # of the exact value, as a tie of the decimal notation is none
    good = _noted(own, F.concat(F.lit("Parsed using "), name, F.lit(" parser (complexity: "), score, F.lit(")")))
    second = _noted(other, F.concat(F.lit("Parsed using "), other_name, F.lit(" parser (fallback, complexity: "), score, F.lit(")")))
    x = df.withColumn("_own", own).withColumn("_other", other)
    ok, other_ok = F.col("_own.parse_success"), F.col("_other.parse_success")
    both = failed(F.concat(F.lit("Both parsers failed. Primary: "), name, F.lit(", Fallback: "), F.coalesce(F.col("_other.parse_error"), F.lit(""))))
    result = F.when(ok, good).when(other_ok, second).otherwise(both) if fallback else F.when(ok, good).otherwise(own)
    used = F.when(ok, name).when(other_ok & F.lit(fallback), other_name)
    return x.withColumn(out, result).withColumn("used", used).withColumn("fell_back", ~ok & other_ok & F.lit(fallback)).drop("_own", "_other")


Parser = Callable[[DataFrame, str, str], DataFrame]


def routed_parse(df: DataFrame, rules: Parser, entities: Parser, column: str = "addr_text", out: str = "parsed", threshold: float = THRESHOLD, fallback: bool = True) -> DataFrame:
    """Adds complexity, route, the record, `used` and `fell_back`: each row is read by the parser it is routed to, and by the other only if that fails.

    A parser takes rows, the column to read and the column to write. It is given null where it
    isn't asked, which it answers with a failed record at no cost, so nothing is split or joined.
    """
    asked = lambda x, when, read, parser, to: parser(x.withColumn(read, F.when(when, F.col(column))), read, to).drop(read)
    x = routed(df, column, threshold)
    x = asked(x, F.col("route") == RULES, "_asked", rules, "_rules")
    x = asked(x, F.col("route") == ENTITIES, "_asked", entities, "_entities")
    first = F.when(F.col("route") == ENTITIES, F.col("_entities")).otherwise(F.col("_rules"))
    x = x.withColumn("_first", first).drop("_rules", "_entities")
    if not fallback:
        x = x.withColumn("_second", failed(F.lit("")))
    else:
        again = ~F.col("_first.parse_success")
        x = asked(x, again & (F.col("route") == ENTITIES), "_asked", rules, "_rules")
        x = asked(x, again & (F.col("route") == RULES), "_asked", entities, "_entities")
        x = x.withColumn("_second", F.when(F.col("route") == ENTITIES, F.col("_rules")).otherwise(F.col("_entities"))).drop("_rules", "_entities")
    own = lambda name: F.when(F.col("route") == name, F.col("_first")).otherwise(F.col("_second"))
    x = x.withColumn("by_rules", own(RULES)).withColumn("by_entities", own(ENTITIES)).drop("_first", "_second")
    return resolved(x, out=out, fallback=fallback).drop("by_rules", "by_entities")


def usage(df: DataFrame) -> DataFrame:
    """One row: how often each parser was used, fell back, failed; percentages to one place."""
    g = df.agg(F.count(F.lit(1)).alias("total_attempts"), F.count_if(F.col("used").isNotNull()).alias("total_parsed"), F.count_if(F.col("used") == RULES).alias("rules_used"), F.count_if(F.col("used") == ENTITIES).alias("entities_used"), F.count_if("fell_back").alias("fallback_used"))
    pct = lambda a, b: F.when(F.col(b) > 0, F.round(F.col(a) / F.col(b) * 100, 1)).otherwise(F.lit(0.0))
    return g.select("*", (F.col("total_attempts") - F.col("total_parsed")).alias("total_failed"), pct("total_parsed", "total_attempts").alias("success_rate_percent"), pct("rules_used", "total_parsed").alias("rules_usage_percent"), pct("entities_used", "total_parsed").alias("entities_usage_percent"), pct("fallback_used", "total_attempts").alias("fallback_usage_percent"))


def tuned_threshold(df: DataFrame, column: str = "complexity", share: float = 0.3, current: float = THRESHOLD) -> DataFrame:
    """One row: the score at place int(n * (1 - share)) of the ascending scores; 0.5 past the end; the current threshold without rows.

    Scores are first counted by value, and places are found on the distinct values, whose number
    is bounded by the score's form, so one task never sees more than those.
    """
    by = df.groupBy(F.col(column).alias("score")).agg(F.count(F.lit(1)).alias("n"))
    upto = Window.orderBy("score").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    everything = Window.orderBy("score").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    x = by.withColumn("upto", F.sum("n").over(upto)).withColumn("total", F.sum("n").over(everything))
    place = F.floor(F.col("total") * F.lit(1.0 - share))
    hit = F.min(F.when(F.col("upto") > place, F.col("score")))
    return x.agg(F.coalesce(hit, F.when(F.count(F.lit(1)) > 0, F.lit(0.5)).otherwise(F.lit(current))).alias("threshold"))
