"""The corpus pipeline on a small table: columns, order, and what each stage lets through."""

import random

import corpus_pipeline as cp
from addrloom.llm import mixing, neardup

from .test_operators import prose


def test_stages(spark, tmp_path):
    r = random.Random(8)
    rows = []
    for k in range(240):
        t = prose(r.randint(15, 120), k)
        if k % 6 == 0:
            t = " ".join(w + "%%%" for w in t.split())
        elif k % 6 == 1:
            t = t + " " + " ".join(r.choice(["scoundrel", "rascal"]) for _ in range(4))
        rows.append((k, t, "en", f"s{k % 3}", len(t)))
    rows += [(240 + k, rows[2][1], "en", "s1", 0) for k in range(5)] + [(300, None, None, None, None), (301, "", "en", "s0", 0)]
    labels = [(k, int(k % 6 != 0), int(k % 6 == 1)) for k in range(240)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    assert [n for n, _ in cp.STAGES] == ["quality_classifier", "toxicity", "near_duplicates", "source_mix", "best_fit_packing"]
    seen, x = [docs.count()], docs
    for k, (_, stage) in enumerate(cp.STAGES):
        x = stage(spark, x, str(tmp_path))
        if k < 4:
            assert x.columns == docs.columns
        x.write.parquet(str(tmp_path / f"out{k}"))
        x = spark.read.parquet(str(tmp_path / f"out{k}"))
        seen.append(x.count())
        ids = {i[0] for i in x.select("doc_id").collect()}
        if k == 0:
            assert sum(i is not None and i < 240 and i % 6 == 0 for i in ids) <= 2 and sum(i is not None and i < 240 and i % 6 != 0 for i in ids) >= 195
        if k == 1:
            assert sum(i is not None and i < 240 and i % 6 == 1 for i in ids) <= 2
        if k == 2:
            assert not ids & {241, 242, 243, 244} and all(r.kept for r in neardup.near_duplicates(x).collect())
            words = mixing.sizes(x).agg({"size": "sum"}).first()[0]
        if k == 3:
            assert abs(mixing.sizes(x).agg({"size": "sum"}).first()[0] / (1.5 * words) - 1) < 0.05
    whole = cp.run(spark, str(tmp_path))
    assert whole.count() == seen[-1] and {"doc_id", "piece", "sequence_id", "offset"} <= set(whole.columns)


def test_near_duplicates_keep_one_of_each_group(spark):
    t = [prose(60, 700 + k) for k in range(6)]
    near = lambda k: " ".join([*t[k].split()[:-1], "other"])
    rows = [(None, t[0]), (None, t[1]), (None, t[2]), (None, near(2)), (7, t[3]), (7, t[4]), (3, near(4)), (7, t[3]), (5, t[5]), (None, t[5]), (None, near(5)), (None, None), (7, ""), (8, "")]
    got = [tuple(r) for r in cp.near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string").repartition(3), "").collect()]
    want = [(None, t[0]), (None, t[1]), (7, t[3]), (3, near(4)), (5, t[5]), (None, None), (7, ""), (8, "")]
    last = [r for r in got if r not in want]
    assert sorted(map(str, (r for r in got if r in want))) == sorted(map(str, want)) and len(last) == 1 and last[0] in [(None, t[2]), (None, near(2))]


CLASHING = ["key", "node", "component", "sig", "n", "h", "m", "row", "copy", "_id", "_key", "_many", "_mix_source", "whole", "target", "size", "score", "kept", "y", "block"]


def test_stages_keep_columns_of_any_name_and_odd_ids(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHING)
    good = [prose(40, 300 + k) for k in range(40)]
    rows = [(k, t, "en", "s", 1) for k, t in enumerate(good)] + [(None, prose(40, 400), None, None, None), (None, prose(40, 401), None, None, None), (5, prose(40, 402), None, "s", 1), (None, None, None, None, None), (6, "", "en", "s", 0), (3, good[3], "en", "s", 1)]
    more = [tuple(c + str(k) for c in CLASHING) for k in range(len(rows))]
    spark.createDataFrame([r + m for r, m in zip(rows, more, strict=True)], schema).write.parquet(str(tmp_path / "documents.parquet"))
    bad = [(1000 + k, " ".join(w + "%%%" for w in prose(30, k).split()), 0, 0) for k in range(30)] + [(2000 + k, prose(30, k) + " scoundrel rascal", 1, 1) for k in range(30)]
    # Labels may name documents that aren't there; with too few to learn from, all stay.
    spark.createDataFrame([(k, 1, 0) for k in range(40)] + [(i, q, x) for i, _, q, x in bad], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for k, (name, stage) in enumerate(cp.STAGES[:4]):
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns, name
        got = out.collect()
        if k == 2:
            texts = [(r.doc_id, r.text) for r in got]
            assert (None, prose(40, 400)) in texts and (None, prose(40, 401)) in texts and (5, prose(40, 402)) in texts and (5, good[5]) in texts
            assert texts.count((3, good[3])) == 1 and len(texts) == len(rows) - 1
        given = {r[:5] + m for r, m in zip(rows, more, strict=True)}
        assert len(got) > 30 and all(tuple(r) in given for r in got)
    assert {"doc_id", "sequence_id"} <= set(cp.packed(spark, docs, "").columns)


def test_an_empty_table_goes_through(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    assert cp.run(spark, str(tmp_path)).count() == 0
