"""Token-sort similarity: words sorted, then twice the longest common subsequence over both lengths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sorted_tokens(name: str) -> str:
    return " ".join(sorted(name.split()))


def common_subsequence(a: str, b: str) -> int:
    """Length of a longest common subsequence; a row of the table is one integer's bits."""
    places: dict[str, int] = {}
    for k, x in enumerate(a):
        places[x] = places.get(x, 0) | 1 << k
    full = row = (1 << len(a)) - 1
    for y in b:
        u = row & places.get(y, 0)
        row = ((row + u) | (row - u)) & full
    return len(a) - row.bit_count()


def token_sort_similarity(a: str, b: str) -> float:
    """0 to 1; 0 if either has no words."""
    x, y = sorted_tokens(a), sorted_tokens(b)
    if not x or not y:
        return 0.0
    total = len(x) + len(y)
    return 1 - (total - 2 * common_subsequence(x, y)) / total


def could_reach(a: int, b: int, threshold: float) -> bool:
    """Whether texts of these lengths can be as similar as the threshold."""
    return 2 * min(a, b) / max(a + b, 1) >= threshold


def similarity_column(a: Column, b: Column) -> Column:
    """The same as an expression, for small sets of pairs: the table's rows are folded over the characters of one side."""
    tokens = lambda c: F.array_join(F.array_sort(F.filter(F.split(c, r"\s+"), lambda w: w != "")), " ")
    x, y = tokens(a), tokens(b)
    chars = lambda c: F.filter(F.split(c, ""), lambda w: w != "")
    n = F.length(y)
    start = F.transform(F.sequence(F.lit(0), n), lambda _: F.lit(0))

    def step(row: Column, ch: Column) -> Column:
        # row[j] is the table's value for the first j characters of y; the next row is built left to right.
        return F.aggregate(
            F.sequence(F.lit(1), n), F.array(F.lit(0)),
            lambda done, j: F.concat(done, F.array(F.when(F.substring(y, j, F.lit(1)) == ch, F.get(row, j - 1) + 1).otherwise(F.greatest(F.get(row, j), F.get(done, j - 1))))),
        )

    common = F.element_at(F.aggregate(chars(x), start, step), -1)
    total = F.length(x) + F.length(y)
    return F.when((x == "") | (y == ""), F.lit(0.0)).otherwise(F.lit(1.0) - (total - common * 2) / total)
