"""Merkle manifests against plain trees, on nulls, repeats, clashing columns, lone rows and many blocks."""

import zlib
from hashlib import sha256

import pytest

from addrloom.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, place int, total int, root string, _k string"


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def part(x):
    return "-" if x is None else f"{len(str(x).encode())}:{x}"


def levels(digests):
    out = [digests]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][k : k + 3]) for k in range(0, len(out[-1]), 3)])
    return out


def siblings(tree, at):
    for level in tree[:-1]:
        run = at // 3 * 3
        yield [x for k, x in enumerate(level[run : run + 3], run) if k != at], at - run
        at //= 3


def plain(rows):
    leaf = lambda d, t, g, s, n: h(part(d), part(s), part(g), part(n), part(t))
    by = {}
    for d, t, g, s, n in rows:
        odd = d is None or zlib.crc32(str(d).encode()) % 2
        changed = leaf(d, t, g, s, n) if odd or t is None else leaf(d, t.replace("\n", ""), g, s, n)
        by.setdefault(s, []).append((d is not None, d or 0, leaf(d, t, g, s, n), changed))
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: levels([x[2] for x in sorted(by[s])]) for s in order}
    top, out = levels([trees[s][-1][0] for s in order]), []
    for at, s in enumerate(order):
        for k, (some, d, own, changed) in enumerate(sorted(by[s])):
            path = [*siblings(trees[s], k), *siblings(top, at)]
            folded = changed
            for others, place in path:
                folded = h(*others[:place], folded, *others[place:])
            out.append((d if some else None, own, trees[s][-1][0], top[-1][0], h(*(x for others, _ in path for x in others)), folded, folded == top[-1][0]))
    return sorted(out, key=str)


def found(spark, rows):
    df = spark.createDataFrame([(*r, 1, 2, "x", "y") for r in rows], SCHEMA).repartition(5)
    return sorted((tuple(r) for r in merkle.verify(merkle.manifest(merkle.leaves(df))).collect()), key=str)


ROWS = [(k, None if k % 7 == 0 else f"text\n {k} ü\n" if k % 3 else f"line {k}", None if k % 5 == 0 else "en", ["a", "Z", "é", "", None, "hot", "hot", "hot"][k % 8], None if k % 11 == 0 else k) for k in range(130)]
ODD = [(3, "again\n", "de", "hot", 1), (3, "again\n", "de", "hot", 1), (3, "other", "de", "hot", 1), (None, "no id\n", "de", "hot", 1), (None, None, None, None, None), (-4, "\n\n", "fr", "alone", 2), (5, "x" * 300_000 + "\n", "fr", "long", 2)]


@pytest.mark.parametrize("tall", [1, 2, 7])
def test_equals_plain_trees(spark, monkeypatch, tall):
    monkeypatch.setattr(merkle, "LEVELS", tall)  # many blocks, and several rounds of them
    monkeypatch.setattr(merkle, "SPAN", 3**tall)
    rows = ROWS + ODD
    assert found(spark, rows) == plain(rows)


def test_few_rows(spark):
    assert found(spark, []) == []
    assert found(spark, ODD[:1]) == plain(ODD[:1]) and found(spark, ODD[:2]) == plain(ODD[:2])


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 10, 26, 27, 28, 60, 81])
def test_traversal_holds_few_nodes(n, monkeypatch):
    leaves = [h(str(k)).encode() for k in range(n)]
    height = merkle.height_of(n)
    tree = levels([x.decode() for x in leaves])
    made, most = [], 0
    first = merkle.Treehash.__init__
    monkeypatch.setattr(merkle.Treehash, "__init__", lambda self, height: (first(self, height), made.append(self))[0])
    for k, (path, root) in enumerate(merkle.traverse(leaves, height)):
        assert path.hex() == "".join(x for others, _ in siblings(tree, k) for x in others) and root.decode() == tree[-1][0]
        assert merkle.fold(leaves[k], path, k, n) == (root, b"")
        most = max(most, sum(len(x) for t in made[-height:] for x in [t.nodes, *t.pending]) if height else 0)
    assert most <= 3 * height * (height + 1)
