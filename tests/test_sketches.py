"""Distinct counts from stored sketches against counts and sketches from scratch."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from addrloom.operators import sketches

SPEC = "source string, pin_code string, kind string, name string"


def by_key(df):
    out = {}
    for r in df.collect():
        out.setdefault((r.pin_code, r.kind), []).append(r.hash)
    return {k: sorted(v) for k, v in out.items()}


def test_merged_sketches_equal_those_from_scratch(spark, tmp_path):
    r = random.Random(4)
    rows = [(f"f{r.randrange(3)}.csv", r.choice(["1", "2", None]), r.choice(["a", "b"]), r.choice([f"n{r.randrange(90)}", f"n{r.randrange(4)}", None])) for _ in range(2000)]
    rows.append((None, "9", "a", "only"))
    df, folder, by = spark.createDataFrame(rows, SPEC), str(tmp_path / "s"), ["source", *sketches.KEY]
    scratch = by_key(sketches.sketch(df, k=16))
    plain = {}
    for _, pin, kind, name in rows:
        if name is not None:
            plain.setdefault((pin, kind), set()).add(int(hashlib.md5(name.encode()).hexdigest()[:15], 16))
    assert scratch == {k: sorted(v)[:16] for k, v in plain.items()}
    # File by file, one of them twice, and first with rows that it no longer has.
    sketches.save(sketches.sketch(df.filter("source = 'f1.csv'").withColumn("name", F.lit("gone")), by, 16), folder)
    for f in ("f0.csv", "f1.csv", "f2.csv", "f1.csv", None):
        sketches.save(sketches.sketch(df.filter(F.col("source").eqNullSafe(F.lit(f))), by, 16), folder)
    assert by_key(sketches.merge(sketches.load(spark, folder), k=16)) == scratch
    counts = {(x.pin_code, x.kind): (x.kept, x.names) for x in sketches.estimate(sketches.merge(sketches.load(spark, folder), k=16), k=16).collect()}
    assert counts["9", "a"] == (1, 1.0) and all(v[0] == min(16, len(plain[k])) for k, v in counts.items())


def test_estimates_are_near_the_count(spark):
    df = spark.range(200_000).select(F.lit("f").alias("source"), F.when(F.col("id") < 500, "few").otherwise("many").alias("pin_code"), F.lit("address").alias("kind"), F.concat(F.lit("x"), F.col("id") % 100_000).alias("name"))
    got = {r.pin_code: (r.kept, r.names) for r in sketches.estimate(sketches.sketch(df)).collect()}
    assert got["few"] == (500, 500.0)
    assert got["many"][0] == sketches.K and got["many"][1] == pytest.approx(100_000, rel=4 / (sketches.K - 2) ** 0.5)
    assert sketches.estimate(sketches.sketch(df.limit(0))).count() == 0
    assert "WindowGroupLimit" in sketches.sketch(df)._jdf.queryExecution().executedPlan().toString()
