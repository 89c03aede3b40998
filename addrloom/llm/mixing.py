"""Mixing sources to target weights, with DataFrame operations only.

Token mass is aggregated per source, a target is derived for each source, and the repetition
rate of a source is target / mass. Each document is emitted floor(rate) times plus one
hash-seeded Bernoulli copy whose probability is the rate's fraction.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import stored

#: Words, as the contract counts them.
WORD = r"[^\x20\x09-\x0D]+"
#: Source weights in code-point order, repeating; total mass of the mix; most repetitions of a source.
WEIGHTS, SHARE, MOST = (3, 1, 2), 1.5, 2
#: Coins are multiples of a document's hash modulo this prime; each of SEEDS multipliers is one seed.
PRIME, SEEDS, STEP = 2147483647, 64, 48271
#: Sources up to which the table of rates is broadcast (about 100 bytes each); beyond, the join is left to the optimizer.
BROADCAST_SOURCES = 100_000


def multiplier(k: int) -> int:
    return pow(STEP, k + 1, PRIME)


def _hash(id_col: Column) -> Column:
    """1 to PRIME, from the id alone; a null id has one as well."""
    return F.conv(F.substring(F.md5(F.coalesce(id_col.cast("string"), F.lit(""))), 1, 8), 16, 10).cast("long") % PRIME + 1


def _coin(h: Column, m: Column) -> Column:
    return h * m % PRIME


def sizes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """doc_id, source, size (number of words; 0 for a null or empty text) and the hash that seeds the coin. Rows that repeat an id have one hash, and so have those without one; a null source stays null; no rows give none."""
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(source_col).cast("string").alias("source"),
        F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        _hash(F.col(id_col)).alias("h"),
    )


def _weighted(by_source: DataFrame, few: bool) -> DataFrame:
    """Adds each source's weight, by its place among the sources, and its cap. Few: in one task; else places are counted within ranges, of which the driver sees one count each."""
    order = F.col("source").asc_nulls_last()
    if few:
        x = by_source.withColumn("place", F.row_number().over(Window.orderBy(order)).cast("long") - 1)
    else:
        own = stored(by_source.repartitionByRange(order).sortWithinPartitions(order).withColumn("_at", F.monotonically_increasing_id()))
        part, before, total = F.shiftright("_at", 33), [], 0
        for p, n in sorted(tuple(r) for r in own.groupBy(part.alias("p")).count().collect()):
            before.append((p, total))
            total += n
        base = by_source.sparkSession.createDataFrame(before, "_p long, _before long")
        x = own.withColumn("_p", part.cast("long")).join(F.broadcast(base), "_p").withColumn("place", F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))).drop("_p", "_before", "_at")
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in WEIGHTS)), (F.col("place") % len(WEIGHTS) + 1).cast("int"))
    return x.withColumn("weight", weight).withColumn("cap", MOST * F.col("source_size").cast("double")).drop("place")


def targets(by_source: DataFrame) -> DataFrame:
    """source, source_size, target: weights share SHARE of all mass; no target exceeds MOST times its source.

    Resharing the excess by weight until none is above ends where target = least(cap, weight * level)
    with one level for all. The level is raised step by step, each step one sum over the sources:
    those whose cap it reaches stay at their caps, the others share what these leave. It ends when
    no further cap is reached, after about as many steps as there are orders of magnitude among
    the sizes. A null source is one of the sources, the last; sizes of 0 have the target 0; without
    sources there are no targets.
    """
    x = stored(_weighted(by_source, by_source.count() <= BROADCAST_SOURCES))
    mass = SHARE * float(x.agg(F.sum("source_size")).first()[0] or 0)
    level = -1.0
    while True:
        below = F.col("cap") <= F.col("weight") * F.lit(level)
        held, weights = x.agg(F.coalesce(F.sum(F.when(below, F.col("cap"))), F.lit(0.0)), F.sum(F.when(~below, F.col("weight")))).first()
        if not weights or (now := (mass - held) / weights) <= level:
            break
        level = now
    return x.select("source", "source_size", F.least(F.col("cap"), F.col("weight") * F.lit(max(level, 0.0))).alias("target"))


def plan(sized: DataFrame) -> DataFrame:
    """One row per source: source_size, target, copies that every document gets, chance of one more, multiplier. No rows for an empty table.

    Of SEEDS seeds each source takes the one whose drawn mass is nearest its target (the first
    of equals). Sums only: map-side partial aggregates, then one row per source.
    """
    goal = stored(targets(sized.groupBy("source").agg(F.sum("size").alias("source_size"))))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    goal = goal.withColumn("whole", F.floor(rate)).withColumn("chance", rate - F.floor(rate))
    x = with_rates(sized, goal)
    drawn = [F.sum(F.when(_coin(F.col("h"), F.lit(multiplier(k))) < F.col("chance") * PRIME, F.col("size")).otherwise(F.lit(0))).alias(f"d{k}") for k in range(SEEDS)]
    x = x.groupBy("source").agg(*(F.first(c).alias(c) for c in ("source_size", "target", "whole", "chance")), *drawn)
    gap = lambda k: F.abs(F.col("whole") * F.col("source_size") + F.col(f"d{k}") - F.col("target"))
    best = F.array_min(F.array(*(F.struct(gap(k).alias("gap"), F.lit(k).alias("k"), F.lit(multiplier(k)).alias("m")) for k in range(SEEDS))))
    return stored(x.select("source", "source_size", "target", "whole", "chance", best["m"].cast("long").alias("m")))


def with_rates(rows: DataFrame, rates: DataFrame) -> DataFrame:
    """Adds a source's rates to each of its rows (with a column source); broadcast only after counting the sources."""
    own = F.broadcast(rates) if rates.count() <= BROADCAST_SOURCES else rates
    return rows.join(own.withColumnRenamed("source", "_rates_of"), F.col("source").eqNullSafe(F.col("_rates_of"))).drop("_rates_of")


def mix(sized: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken: the words that the mix takes of each document, copies counted.

    Rows that repeat an id share its coin, and so do rows without one. The source is compared as
    text; null is a source of its own.
    """
    x = with_rates(sized, plan(sized))
    more = (_coin(F.col("h"), F.col("m")) < F.col("chance") * PRIME).cast("long")
    return x.select("doc_id", "size", F.col("source_size").cast("long").alias("source_size"), "target", (F.col("size") * (F.col("whole") + more)).cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The rows of docs, each as often as the mix takes it, with the same columns, whatever their names. A null or empty text has size 0 and comes along by its coin like any other."""
    rates = plan(stored(sizes(docs, id_col, text_col, source_col)))
    rows = docs.select(F.struct("*").alias("row"), F.col(source_col).cast("string").alias("source"), _hash(F.col(id_col)).alias("h"))
    copies = (F.col("whole") + (_coin(F.col("h"), F.col("m")) < F.col("chance") * PRIME).cast("long")).cast("int")
    taken = F.explode(F.when(copies > 0, F.sequence(F.lit(1), copies)).otherwise(F.array().cast(T.ArrayType(T.IntegerType()))))
    return with_rates(rows, rates).select("row", taken.alias("copy")).select("row.*")


def mix_sql(docs: str = "documents") -> str:
    """The same in DuckDB's SQL."""
    seeds = ", ".join(f"({k}, {multiplier(k)})" for k in range(SEEDS))
    cases = " ".join(f"WHEN {k} THEN {float(w)}" for k, w in enumerate(WEIGHTS))
    return f"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{WORD}')), 0)::BIGINT AS size,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT % {PRIME} + 1 AS h
  FROM {docs}),
per AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighted AS (
  SELECT *, {float(MOST)}::DOUBLE * source_size AS cap,
    (CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)} {cases} END)::DOUBLE AS weight FROM per),
steps AS (
  SELECT *, coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below,
    sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights,
    {SHARE}::DOUBLE * (SELECT sum(source_size) FROM per)::DOUBLE AS mass FROM weighted),
goals AS (SELECT source, source_size, least(cap, weight * (SELECT max((mass - below) / weights) FROM steps)) AS target FROM steps),
rates AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate FROM goals),
drawn AS (
  SELECT s.source, k.seed, k.m, any_value(r.target) AS target, any_value(floor(r.rate)) * any_value(r.source_size)
    + sum(CASE WHEN s.h * k.m % {PRIME} < (r.rate - floor(r.rate)) * {PRIME} THEN s.size ELSE 0 END) AS mass
  FROM sized s JOIN rates r ON s.source IS NOT DISTINCT FROM r.source CROSS JOIN (VALUES {seeds}) k(seed, m) GROUP BY 1, 2, 3),
best AS (SELECT source, arg_min(m, (abs(mass - target), seed)) AS m FROM drawn GROUP BY source)
SELECT s.doc_id, s.size, r.source_size, r.target,
  (s.size * (floor(r.rate) + CASE WHEN s.h * b.m % {PRIME} < (r.rate - floor(r.rate)) * {PRIME} THEN 1 ELSE 0 END))::BIGINT AS taken
FROM sized s JOIN rates r ON s.source IS NOT DISTINCT FROM r.source JOIN best b ON s.source IS NOT DISTINCT FROM b.source"""
