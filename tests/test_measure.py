"""Measured runs are recorded, and read by comparisons."""

from pyspark.sql import functions as F

from addrloom.functions.rules import rule_parse
from addrloom.operators import compare, measure


def test_runs_are_recorded_and_compared(spark, tmp_path):
    df = spark.createDataFrame([(k, "Flat 1, Kumar Paradise, Baner, Pune 411001" if k % 4 else "") for k in range(40)], "row_id long, addr_text string")
    path = str(tmp_path / "runs")
    slow = lambda x: rule_parse(x.withColumn("addr_text", F.lit("")))
    measure.record(df, {"a": rule_parse, "b": slow}, path)
    runs = measure.record(df.limit(10), {"a": rule_parse}, path)
    assert runs.count() == 3
    last = {r.stage: r for r in measure.latest(runs).collect()}
    assert (last["a"].rows, last["b"].rows, last["b"].succeeded, last["b"].bytes) == (10, 40, 0, 0) and last["a"].ms > 0 and last["a"].rate > 0
    pairs = rule_parse(rule_parse(df, out="a"), out="c")
    got = {r.parser: r for r in measure.with_measured(compare.parser_metrics(pairs, "a", "c"), runs).collect()}
    assert got["a"].rows == 10 and got["c"].ms is None and got["a"].success_rate == 75.0
    assert measure.latest(measure.record(df.limit(0), {"x": rule_parse}, str(tmp_path / "none"))).first().rate == 0.0
