"""Similar names of a code: candidates by an index of q-grams, their similarity, and leaders in order of appearance.

Two texts of n and m characters are as similar as t if at most d = (1 - t) * (n + m) characters
have to be deleted (a of the first) and inserted (b) to turn one into the other, d being of the
parity of n + m. A deletion destroys up to q of the first text's q-grams and an insertion q - 1,
so that at most E = a * q + b * (q - 1) are lost: the texts have all others in common (count
bound), one of the E + 1 rarest of either is among the E + 1 rarest of the other (rank bound), and
it has moved by no more than a characters forward and b back (position bound). No pair at the
threshold is left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.similarity import common_subsequence, sorted_tokens
from ..sources.shared import discard, stored
from ..workers import ship_package

#: Names of one code and one q-gram that a task compares with all others of them.
PAIR_BLOCK = 1024
#: Edges of a code up to which one task settles its leaders; the others' are settled in rounds.
EDGE_BLOCK = 50_000
#: Threshold from which pairs of characters are the grams; below, they bound nothing, and single characters do.
BY_PAIRS = 0.7


def grams(tokens: str, q: int) -> tuple[list[int], list[int]]:
    """The q-grams (of one or two characters, as numbers) of the text between q - 1 marks at its ends, and the same numbered among equal ones."""
    codes = [0] * (q - 1) + [ord(c) for c in tokens] + [0] * (q - 1)
    own = codes if q == 1 else [x << 21 | y for x, y in zip(codes, codes[1:], strict=False)]
    seen: dict[int, int] = {}
    marks = []
    for g in own:
        seen[g] = seen.get(g, 0) + 1
        marks.append(g << 21 | seen[g])
    return own, marks


def name_table(names: DataFrame, threshold: float) -> DataFrame:
    """Of names (pin_key, name_key and whatever else), stored: id, tokens (sorted words), size, grams and marks of those that have words."""
    q = 2 if threshold >= BY_PAIRS else 1
    ship_package(names.sparkSession)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            tokens = [sorted_tokens(x) for x in pdf["name_key"]]
            both = [grams(x, q) for x in tokens]
            yield pdf.assign(tokens=tokens, size=[len(x) for x in tokens], grams=[g for g, _ in both], marks=[m for _, m in both])

    kinds = ", ".join(f"{c} {t}" for c, t in names.dtypes)
    made = names.filter("name_key <> ''").mapInPandas(cut, f"{kinds}, tokens string, size int, grams array<long>, marks array<long>").filter("size > 0")
    return stored(made.withColumn("id", F.monotonically_increasing_id()))


def _lost(q: int, n: Column, m: Column, d: Column) -> Column:
    """E: the most q-grams of a text of n characters that a text of m characters within d lacks."""
    return F.floor(((2 * q - 1) * d + n - m) / 2 + 1e-9)


def candidates(table: DataFrame, threshold: float) -> DataFrame:
    """left_id and right_id, once each, of the pairs of a code's names that no bound rules out; the lesser name is left.

    Names are joined by code and gram; a hot gram of a code is dealt out in blocks of PAIR_BLOCK
    names. All bounds are in the join's own condition.
    """
    q = 2 if threshold >= BY_PAIRS else 1
    slack = 1 - threshold
    n = F.col("size")
    each = table.select("id", "size", F.posexplode("grams").alias("pos", "gram"))
    often = each.groupBy("gram").agg(F.count(F.lit(1)).alias("often"))
    ranked = each.join(often, "gram").groupBy("id", "size").agg(F.array_sort(F.collect_list(F.struct("often", "gram", "pos"))).alias("r"))
    least = n * (threshold / (2 - threshold))  # of a partner's size, which may cost most grams
    most = F.floor(((2 * q - 1) * slack * (n + least) + n - least) / 2 + 1e-9)
    # a gram's rank is the place of its first occurrence, so that equal ones come in together
    rank = F.array_position(F.transform("r", lambda x: x["gram"]), F.col("x.gram")) - 1
    keys = ranked.withColumn("x", F.explode("r")).select("id", F.col("x.gram").alias("gram"), F.col("x.pos").alias("pos"), rank.cast("int").alias("rank"), most.alias("_most")).filter("rank <= _most").drop("_most")
    keys = keys.join(table.select("id", "pin_key", "name_key", "size", "marks"), "id")
    blocks = keys.groupBy("pin_key", "gram").agg(F.ceil(F.count(F.lit(1)) / PAIR_BLOCK).cast("int").alias("blocks")).filter("blocks > 1")
    keys = keys.join(blocks, ["pin_key", "gram"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    a = keys.withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")).alias("a")
    b = keys.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).alias("b")
    of = lambda s, c: F.col(f"{s}.{c}")
    total = of("a", "size") + of("b", "size")
    d = F.floor(total * slack + 1e-9)
    d = d - (d + total) % 2
    more = of("a", "size") - of("b", "size")
    shift = of("a", "pos") - of("b", "pos")
    lost = _lost(q, of("a", "size"), of("b", "size"), d)
    same = (of("a", "pin_key") == of("b", "pin_key")) & (of("a", "gram") == of("b", "gram")) & (of("a", "block") == of("b", "block")) & (of("a", "name_key") < of("b", "name_key"))
    near = (F.abs(more) <= d) & (of("a", "rank") <= lost) & (of("b", "rank") <= _lost(q, of("b", "size"), of("a", "size"), d)) & (shift * 2 <= d + more) & (shift * -2 <= d - more)
    common = F.size(F.array_intersect(of("a", "marks"), of("b", "marks"))) >= of("a", "size") + (q - 1) - lost
    return a.join(b, same & near & common).select(of("a", "id").alias("left_id"), of("b", "id").alias("right_id")).distinct()


def pairs(table: DataFrame, threshold: float, found: DataFrame | None = None) -> DataFrame:
    """left and right (rows of the table without grams and marks) and similarity, unrounded, of the candidates. The similarity is taken in Python workers, of candidates alone."""

    @F.pandas_udf("double")
    def similarity(left: pd.Series, right: pd.Series) -> pd.Series:
        size = left.str.len() + right.str.len()
        common = pd.Series([common_subsequence(x, y) for x, y in zip(left, right, strict=True)], dtype="float64")
        return 1 - (size - 2 * common) / size

    own = F.struct(*(c for c in table.columns if c not in ("grams", "marks")))
    found = candidates(table, threshold) if found is None else found
    left, right = (table.select(F.col("id").alias(f"{s}_id"), own.alias(s)) for s in ("left", "right"))
    return found.join(left, "left_id").join(right, "right_id").select("left", "right", similarity("left.tokens", "right.tokens").alias("similarity"))


def _settled(pdf: pd.DataFrame) -> list[int]:
    """The followers among a code's names: v is one if an earlier neighbour u leads. Edges (u, v) ascend by the place of v."""
    followers: set[int] = set()
    for u, v in pdf.sort_values(["at_v", "at_u"])[["u", "v"]].itertuples(index=False):
        if u not in followers:
            followers.add(v)
    return sorted(followers)


def followers(edges: DataFrame) -> DataFrame:
    """v, once each: the names that an earlier leader draws, of edges (pin_key, u, v, at_u, at_v) with u before v.

    Leaders are the lexicographically first independent set. Each round makes leaders of the names
    without an undecided earlier neighbour, and followers of these leaders' later neighbours; the
    edges of both then go. Names in no order need about as many rounds as the number's logarithm;
    a chain of names in order, each like the next alone, needs one for every two of them. Codes
    with up to EDGE_BLOCK edges are settled in a task each, which gives the same.
    """
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"v": _settled(pdf)}, dtype="int64")

    settled = lambda x: x.groupBy("pin_key").applyInPandas(run, "v long")
    hot = edges.groupBy("pin_key").count().filter(F.col("count") > EDGE_BLOCK).select("pin_key")
    if hot.isEmpty():
        return settled(edges)
    done = [settled(edges.join(hot, "pin_key", "left_anti"))]
    left = stored(edges.join(hot, "pin_key", "left_semi").select("u", "v"))
    while not left.isEmpty():
        lead = left.select("u").distinct().join(left.select(F.col("v").alias("u")).distinct(), "u", "left_anti")
        drawn = stored(left.join(lead, "u", "left_semi").select("v").distinct())
        rest = left.join(drawn, "v", "left_anti").join(drawn.withColumnRenamed("v", "u"), "u", "left_anti").select("u", "v")
        # a leader's edges lead to drawn names alone, so they go with these
        done.append(drawn)
        left, old = stored(rest), left
        discard(old)
    out = done[0]
    for x in done[1:]:
        out = out.unionByName(x)
    return out


def leaders(table: DataFrame, threshold: float, place: str = "first_row") -> DataFrame:
    """pin_key, name_key and leader of the names that another one leads: the first leader, by place, that is similar enough. No task holds more than a block of a hot code."""
    like = pairs(table, threshold - 1e-6).filter(F.col("similarity") >= threshold)
    first = F.col(f"left.{place}") < F.col(f"right.{place}")
    u, v = F.when(first, F.col("left")).otherwise(F.col("right")), F.when(first, F.col("right")).otherwise(F.col("left"))
    like = stored(like.select(u.alias("u"), v.alias("v")))
    edges = like.select("v.pin_key", F.col("u.id").alias("u"), F.col("v.id").alias("v"), F.col(f"u.{place}").alias("at_u"), F.col(f"v.{place}").alias("at_v"))
    drawn = stored(followers(edges))
    led = like.withColumn("_v", F.col("v.id")).join(drawn.withColumnRenamed("v", "_v"), "_v", "left_semi")
    led = led.withColumn("_u", F.col("u.id")).join(drawn.withColumnRenamed("v", "_u"), "_u", "left_anti")
    return led.groupBy("v.pin_key", "v.name_key").agg(F.min_by("u.name_key", f"u.{place}").alias("leader"))
