"""Comparison of two parsers' records for the same rows, always joined by a row key, never by position."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import strip
from ..schema import COMPARED

#: Fields that the two counts of a record's fields look at.
SHEET_FIELDS = ["unit_number", "society_name", "landmark", "road", "locality", "city", "pin_code"]
MODEL_FIELDS = ["unit_number", "society_name", "locality", "city", "pin_code"]
#: Least success, society, locality, landmark and unit rates in percent, and most seconds an address.
TARGETS = {"success_rate": 95.0, "society_name": 30.0, "locality": 30.0, "landmark": 15.0, "unit_number": 50.0}
MOST_SECONDS = 2.0


def _there(parsed: str, field: str) -> Column:
    return F.coalesce(F.col(f"{parsed}.{field}"), F.lit("")) != ""


def joined(a: DataFrame, b: DataFrame, key: str = "row_id", names: tuple[str, str] = ("a", "b"), parsed: str = "parsed") -> DataFrame:
    """Both records of each row that either side has once."""
    return a.select(key, F.col(parsed).alias(names[0])).join(b.select(key, F.col(parsed).alias(names[1])), key)


def with_default(rows: DataFrame, parses: DataFrame, key: str = "row_id", parsed: str = "parsed", message: str = "No result from processing") -> DataFrame:
    """Rows with their records; a row that has none gets a failed one."""
    from ..schema import failed

    x = rows.join(parses.select(key, F.col(parsed).alias("_p")), key, "left")
    return x.withColumn(parsed, F.coalesce("_p", failed(F.lit(message)))).drop("_p")


def extraction_rates(rows: DataFrame, parsed: str = "parsed", over: str = "all") -> DataFrame:
    """field and rate (percent). over: all - non-empty among all rows; success - non-blank and parsed, among all; strict - non-empty among parsed."""
    ok = F.col(f"{parsed}.parse_success")
    if over == "all":
        share = {f: F.avg(_there(parsed, f).cast("double")) for f in COMPARED}
    elif over == "success":
        share = {f: F.avg((ok & (strip(F.col(f"{parsed}.{f}")) != "")).cast("double")) for f in COMPARED}
    else:
        share = {f: F.avg(F.when(ok, _there(parsed, f).cast("double"))) for f in COMPARED}
    one = rows.agg(*(F.round(F.coalesce(c, F.lit(0.0)) * 100, 6).alias(f) for f, c in share.items()))
    return one.unpivot([], COMPARED, "field", "rate")


def _same(a: str, b: str, field: str) -> Column:
    fold = lambda p: F.lower(strip(F.coalesce(F.col(f"{p}.{field}"), F.lit(""))))
    return fold(a) == fold(b)


def agreement_by_field(pairs: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Percent of rows that both parsed on which a field is the same in any case; two empty ones are the same."""
    both = F.col(f"{a}.parse_success") & F.col(f"{b}.parse_success")
    one = pairs.agg(*(F.round(F.coalesce(F.avg(F.when(both, _same(a, b, f).cast("double"))), F.lit(0.0)) * 100, 6).alias(f) for f in COMPARED))
    return one.unpivot([], COMPARED, "field", "rate")


def agreement_by_row(pairs: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Adds agreement_score: percent of the eleven fields that are the same, parsed or not."""
    return pairs.withColumn("agreement_score", reduce(add, (_same(a, b, f).cast("int") for f in COMPARED)) / F.lit(float(len(COMPARED))) * 100)


def field_verdicts(pairs: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Counts of rows on which a field's values are exactly the same, or differ."""
    same = lambda f: F.col(f"{a}.{f}").eqNullSafe(F.col(f"{b}.{f}"))
    one = pairs.agg(*(F.count_if(same(f)).alias(f) for f in COMPARED), F.count(F.lit(1)).alias("n"))
    return one.unpivot(["n"], COMPARED, "field", "same").select("field", "same", (F.col("n") - F.col("same")).alias("different"))


def field_count(parsed: str, fields: list[str]) -> Column:
    return reduce(add, (_there(parsed, f).cast("int") for f in fields))


def row_winner(pairs: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Adds winner: the side with more fields, or Tie."""
    x, y = field_count(a, MODEL_FIELDS), field_count(b, MODEL_FIELDS)
    return pairs.withColumn("fields_a", x).withColumn("fields_b", y).withColumn("winner", F.when(x > y, F.lit(a)).when(y > x, F.lit(b)).otherwise(F.lit("Tie")))


def parser_metrics(pairs: DataFrame, a: str = "a", b: str = "b", ms_a: float = 1.0, ms_b: float = 1.0) -> DataFrame:
    """A row per parser: success rate, mean extraction rate over all rows, milliseconds an address (measured outside)."""
    def one(p: str, ms: float) -> Column:
        ok = F.col(f"{p}.parse_success")
        mean = reduce(add, (F.avg((ok & (strip(F.col(f"{p}.{f}")) != "")).cast("double")) for f in COMPARED)) / len(COMPARED) * 100
        return F.struct(F.lit(p).alias("parser"), F.round(F.avg(ok.cast("double")) * 100, 6).alias("success_rate"), F.round(mean, 6).alias("extraction_rate"), F.lit(float(ms)).alias("ms"))

    # Both in one pass: the rows are made once.
    return pairs.agg(F.array(one(a, ms_a), one(b, ms_b)).alias("both")).select(F.inline("both"))


def parser_scores(metrics: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Points of 100: 40 for success, 30 for speed, 30 for extraction; the second parser takes what is equal."""
    side = lambda p, c: F.max(F.when(F.col("parser") == p, F.col(c)))
    x = metrics.agg(*(side(p, c).alias(f"{c}_{k}") for k, p in (("a", a), ("b", b)) for c in ("success_rate", "extraction_rate", "ms")))
    win = lambda better, points: F.when(better, F.lit(points)).otherwise(F.lit(0))
    first = win(F.col("success_rate_a") > F.col("success_rate_b"), 40) + win(F.col("ms_a") < F.col("ms_b"), 30) + win(F.col("extraction_rate_a") > F.col("extraction_rate_b"), 30)
    return x.select(first.alias("score_a"), (F.lit(100) - first).alias("score_b"))


def best_parser(metrics: DataFrame) -> DataFrame:
    """The parser with the best success rate, the fastest, the one that extracts most; the first by name of equal ones."""
    order = lambda c: F.struct(c, F.col("parser"))
    return metrics.agg(F.min_by("parser", order(-F.col("success_rate"))).alias("best_success"), F.min_by("parser", order(F.col("ms"))).alias("fastest"), F.min_by("parser", order(-F.col("extraction_rate"))).alias("best_extraction"))


def target_check(rows: DataFrame, parsed: str = "parsed", seconds: float = 0.0) -> DataFrame:
    """metric, value, target and PASS or REVIEW."""
    ok = F.col(f"{parsed}.parse_success")
    rate = {"success_rate": F.avg(ok.cast("double")), **{f: F.avg(F.when(ok, _there(parsed, f).cast("double"))) for f in TARGETS if f != "success_rate"}}
    one = rows.agg(*(F.round(F.coalesce(c, F.lit(0.0)) * 100, 6).alias(m) for m, c in rate.items()), F.lit(float(seconds)).alias("seconds"))
    x = one.unpivot([], [*TARGETS, "seconds"], "metric", "value")
    target = F.coalesce(*(F.when(F.col("metric") == m, F.lit(t)) for m, t in TARGETS.items()), F.lit(MOST_SECONDS))
    good = F.when(F.col("metric") == "seconds", F.col("value") <= target).otherwise(F.col("value") >= target)
    return x.select("metric", "value", target.alias("target"), F.when(good, F.lit("PASS")).otherwise(F.lit("REVIEW")).alias("status"))


def cost_report(n: DataFrame) -> DataFrame:
    """What a share of answers by a paid model would cost: 30, 50 or 40 percent at two cents an address. n: one row with column n."""
    shares = F.array(F.lit(0.3), F.lit(0.5), F.lit(0.4))
    return n.select("n", F.explode(shares).alias("paid_share")).select("n", "paid_share", F.round(F.col("n") * F.col("paid_share") * 0.02, 6).alias("cost"))
