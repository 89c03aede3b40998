"""The divergence audit against plain counting, on nulls, repeats, clashing columns, long texts and many blocks."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from addrloom.llm import divergence

SCHEMA = "doc_id long, text string, lang string, source string, term string, n long, tb int, V int"
TERM = re.compile(rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def plain(rows):
    """rows: (text, lang, source)."""
    docs = [((g or "", s or ""), Counter(TERM.findall(bytes(b + 32 if 65 <= b <= 90 else b for b in (t or "").encode())))) for t, g, s in rows]
    held, per, out = defaultdict(Counter), defaultdict(Counter), []
    for g, words in docs:
        held[g[0]].update(words.keys())
        per[g].update(words)
    for lang in {g[0] for g in per}:
        kept = sorted(t for t, k in held[lang].items() if k >= 3)
        groups = [g for g in per if g[0] == lang]
        share = lambda c, kept=kept: [1 + 10**9 * (c[t] + 1) // (sum(c[x] for x in kept) + len(kept)) for t in kept]
        q = share(sum((per[g] for g in groups), Counter()))
        p = {g: share(per[g]) for g in groups}
        for g in groups:
            pair = [(sum((x - y) ** 2 // y for x, y in zip(p[g], p[o], strict=True)), o[1].encode()) for o in groups if o != g]
            term = [((x - y) ** 2 // y, t) for x, y, t in zip(p[g], q, kept, strict=True) if per[g][t] and x > y]
            for part, found in (("pair", pair), ("term", sorted(term, key=lambda v: (-v[0], v[1]))[:200])):
                out += [(*g, part, item.decode(), v, k) for k, (v, item) in enumerate(sorted(found, key=lambda v: (-v[0], v[1])), 1)]
    return sorted(out)


def found(spark, rows):
    df = spark.createDataFrame([(1, t, g, s, "x", 2, 3, 4) for t, g, s in rows], SCHEMA).repartition(4)
    return sorted(tuple(r) for r in divergence.audit(df).collect())


def rows_of(n, sources, seed=1):
    r = random.Random(seed)
    words = [f"{a}{b}".strip() for a in ("Wort", "naïve", "日本", "x", "Éa") for b in ("", "a", "Q", "zz", "ü", "k")]
    text = lambda: r.choice(["", " ", "3 "]) + r.choice([" ", ",", "\n", "7", "\x00"]).join(r.choices(words, k=r.randint(0, 30)))
    return [(None if k % 17 == 0 else text(), [None, "en", "en", "en", "de"][k % 5], None if k % 13 == 0 else f"s{r.randint(0, sources)}") for k in range(n)]


@pytest.mark.parametrize(("terms", "sources", "held"), [(256, 64, 200_000), (3, 2, 10)])
def test_equals_plain_counting(spark, monkeypatch, terms, sources, held):
    for name, value in (("TERMS", terms), ("SOURCES", sources), ("HELD", held), ("PIECE", 100 if held == 10 else 1 << 20)):
        monkeypatch.setattr(divergence, name, value)
    rows = rows_of(200, 7)
    rows += [rows[3]] * 3 + [("only here", "xx", "a"), ("nothing kept", "xx", "b"), (None, "xx", None), ("rare " * 40, "en", "lone"), ("", "en", "empty"), ("?!", "yy", "single"), ("w" * 500 + " Wort", "en", "s1")]
    assert found(spark, rows) == plain(rows)


def test_only_the_highest_terms_are_ranked(spark):
    rows = [(" ".join(f"t{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(300)), "en", "a")] * 3 + [("other words are here", "en", "b")] * 3
    assert found(spark, rows) == plain(rows) and sum(x[2] == "term" and x[1] == "a" for x in found(spark, rows)) == 200


def test_nothing(spark):
    assert found(spark, []) == [] and found(spark, [(None, None, None)]) == []


def test_pieces_keep_terms_whole():
    r = random.Random(2)
    for _ in range(200):
        text = "".join(r.choice(["a", "B", " ", "é", "1", "\n", "xyz"]) for _ in range(r.randint(0, 60))).encode()
        some = list(divergence.pieces(text, r.randint(1, 20)))
        assert [t for x in some for t in x.split()] == TERM.findall(text.translate(divergence.FOLD))


def test_shares_are_exact():
    r = random.Random(4)
    for _ in range(300):
        below = r.choice([r.randint(1, 50), r.randint(1, 10**15)])
        count = r.randint(0, below - 1)
        assert divergence.shares(np.array([count]), below)[0] == 1 + 10**9 * (count + 1) // below
