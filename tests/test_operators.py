"""Grouping, ranking and streams against plain row-by-row versions."""

import random
import time

import pytest
from pyspark.sql import functions as F

from addrloom import config
from addrloom.functions.similarity import token_sort_similarity
from addrloom.operators import consolidate, metrics, routing, similar
from addrloom.plans.pipeline import consolidate_files
from addrloom.sources import readers, sinks
from addrloom.streaming import incremental


def naive_groups(rows, threshold):
    """Every row walks the groups in order of their creation."""
    groups, out = [], {}
    for row_id, name, pin in rows:
        hit = next((g for g in groups if g[1] == pin and name != "" and (token_sort_similarity(g[0], name) >= threshold)), None)
        if hit is None:
            hit = next((g for g in groups if g == (name, pin)), None)
        if hit is None:
            hit = (name, pin)
            groups.append(hit)
        out[row_id] = hit
    return out


@pytest.mark.parametrize("threshold", [0.3, 0.7, 0.85, 1.0])
def test_fuzzy_leaders_equal_row_by_row(spark, threshold):
    rng = random.Random(int(threshold * 100))
    names = ["blue ridge", "blue ridges", "ridge blue", "blu rdge", "", "green park", "green parks", "park"]
    rows = [(k, rng.choice(names), rng.choice(["1", "2"])) for k in range(60)]
    df = spark.createDataFrame(rows, "row_id long, name_key string, pin_key string")
    leaders = {(r.pin_key, r.name_key): r.leader for r in consolidate.fuzzy_leaders(df, threshold).collect()}
    for row_id, (name, pin) in naive_groups(rows, threshold).items():
        assert leaders[(pin, rows[row_id][1])] == name


@pytest.mark.parametrize("threshold", [0.0, 0.5, 0.85, 1.0])
def test_candidate_pairs_are_all_pairs(spark, monkeypatch, threshold):
    monkeypatch.setattr(similar, "PAIR_BLOCK", 3)
    names = ["blue ridge", "ridge blue", "blue ridges", "the prestige lakeside", "prestige lakeside", "the kumar paradise", "kumar paradise", "the green valley homes", "green valley homes", "aaaa", "aaab", "a", "", "  ", "x y z", "z y x", None]
    rows = [(n, pin) for n in names for pin in ("", "411001")] + [("green valleys", "2"), ("blue ridge", "2"), ("green valley", "2")]
    df = spark.createDataFrame(rows, "name_key string, pin_key string")
    got = consolidate.candidate_pairs(df, threshold).collect()
    want = {}
    for a, p in rows:
        for b, q in rows:
            if p == q and a and b and a < b and round(token_sort_similarity(a, b), 6) >= threshold:
                want[p, a, b] = round(token_sort_similarity(a, b), 6)
    assert {(r.pin_key, r.left_name, r.right_name): r.similarity for r in got} == want and len(got) == len(want)


def test_stream_of_one_batch_equals_batch(spark, tmp_path):
    rows = [(k, "1", n) for k, n in enumerate(["blue ridge", "blue ridges", "green park", "ridge blue"])]
    df = spark.createDataFrame(rows, "row_id long, pin_key string, name_key string")
    df.write.parquet(str(tmp_path / "in"))
    q = incremental.consolidated_stream(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))).writeStream.format("memory").queryName("leaders").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination()
    got = {r.name_key: r.leader for r in spark.table("leaders").collect()}
    assert got == {r.name_key: r.leader for r in consolidate.fuzzy_leaders(df).collect()}


def test_the_state_of_a_quiet_code_goes(spark, tmp_path):
    schema = "row_id long, pin_key string, name_key string"
    (tmp_path / "in").mkdir()
    stream = incremental.consolidated_stream(incremental.address_stream(spark, str(tmp_path / "in"), spark.createDataFrame([], schema).schema, 1, "parquet"), quiet=1)
    q = stream.writeStream.format("memory").queryName("quiet").option("checkpointLocation", str(tmp_path / "cp")).start()

    def until(n):
        end = time.time() + 60
        while spark.table("quiet").count() < n and time.time() < end:
            time.sleep(0.5)
        time.sleep(3)  # another batch or two, in which timers are seen to
        return sorted(tuple(r) for r in spark.table("quiet").collect())

    try:
        spark.createDataFrame([(1, "1", "blue ridge"), (2, "1", "blue ridges")], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        assert until(2) == [("1", "blue ridge", "blue ridge", 1, 2), ("1", "blue ridges", "blue ridge", 1, 2)]
        spark.createDataFrame([(4, "1", "blue ridges")], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        assert ("1", "blue ridges", "blue ridges", 1, 1) in until(3)  # it leads itself now
    finally:
        q.stop()


def test_ranked_equals_sorted_place(spark):
    rng = random.Random(3)
    ids = rng.sample(range(10_000), 500)
    got = sinks.ranked(spark.createDataFrame([(i,) for i in ids], "row_id long"), "row_id").collect()
    assert {r.row_id: r.ordinal for r in got} == {i: k + 1 for k, i in enumerate(sorted(ids))}


def test_places_by_several_keys(spark):
    rng = random.Random(8)
    rows = [(rng.randint(0, 9), f"k{k}" if k % 7 else None) for k in range(400)]
    df = spark.createDataFrame(rows, "n int, name string").repartition(5)
    out = sinks.placed(df, F.col("n").desc(), F.col("name").asc_nulls_first())
    want = sorted(rows, key=lambda r: (-r[0], r[1] is not None, r[1] or ""))
    assert [(r.n, r.name) for r in sorted(out.collect(), key=lambda r: r.place)] == want
    assert "SinglePartition" not in out._jdf.queryExecution().toString() and sinks.placed(df.limit(0), F.col("n")).count() == 0


def test_threshold_is_the_indexed_score(spark):
    scores = [0.1, 0.2, 0.2, 0.3, 0.9, 0.4, 0.5]
    df = spark.createDataFrame([(s,) for s in scores], "complexity double")
    for share in (0.0, 0.2, 0.3, 0.5, 1.0):
        place = int(len(scores) * (1.0 - share))
        assert routing.tuned_threshold(df, share=share).first()[0] == (sorted(scores)[place] if place < len(scores) else 0.5)
    assert routing.tuned_threshold(df.limit(0), current=0.6).first()[0] == 0.6


def test_files_to_files(spark, tmp_path):
    src = tmp_path / "in.csv"
    src.write_text('addr_hash_key,addr_text,city_id,pincode,extra\nh1,"Flat 1, Kumar Paradise, Baner, Pune 411001",c,411001,e1\nh2,"Flat 2, Kumar Paradise, Baner, Pune 411001",c,411001,"two\nlines"\nh3,,c,411001,x\nh4,short\n', encoding="utf-8")
    report = consolidate_files(spark, config.Config(input_path=str(src), output_path=str(tmp_path / "out")))
    assert "total_records: 2" in report and "total_groups: 1" in report and "written: 2" in report
    back = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(str(tmp_path / "out"))
    assert back.columns[:5] == ["addr_hash_key", "addr_text", "city_id", "pincode", "extra"] and back.columns[-2:] == ["group_id", "location_identifier"]
    assert {r.extra for r in back.collect()} == {"e1", "two\nlines"}


def test_reading_problems(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        readers.read_addresses(spark, str(tmp_path / "none.csv"))
    (tmp_path / "empty.csv").write_text("")
    with pytest.raises(ValueError):
        readers.read_addresses(spark, str(tmp_path / "empty.csv"))
    (tmp_path / "less.csv").write_text("addr_text,pincode\na,1\n")
    with pytest.raises(ValueError, match="city_id"):
        readers.read_addresses(spark, str(tmp_path / "less.csv"))


def test_address_columns(spark):
    df = lambda *c: spark.createDataFrame([tuple("x" for _ in c)], ", ".join(f"{x} string" for x in c))
    assert readers.address_column(df("id", "full_address")) == "full_address"
    assert readers.address_column(df("id", "My_Address_1")) == "My_Address_1"
    assert readers.address_column(df("id", "second")) == "second"
    assert readers.address_column(df("id", "b"), "report") == "id"
    with pytest.raises(ValueError):
        readers.address_column(df("id", "b"), "batch")


def test_files_and_manifest(spark, tmp_path):
    for k in (1, 2, 10):
        (tmp_path / f"p{k}.csv").write_text(f"a\n{k}\n")
    found = readers.numbered(spark, str(tmp_path), 1, 10)
    assert [f.rsplit("/", 1)[1] for f in found] == ["p1.csv", "p10.csv", "p2.csv"]
    files = readers.fingerprints(spark, found).select("path", "sha256")
    sinks.append_manifest(files.limit(1).withColumn("status", F.lit("completed")).withColumn("rows", F.lit(1)), str(tmp_path / "m"))
    assert sinks.unprocessed(files, sinks.current_manifest(spark.read.parquet(str(tmp_path / "m")))).count() == 2


def test_configuration(tmp_path, monkeypatch):
    monkeypatch.setenv("ADDR_IN", "in.csv")
    f = tmp_path / "c.yaml"
    f.write_text("input_path: ${ADDR_IN}\nparser_type: rules\nfuzzy: true\noutput_path: out\n")
    c = config.load(str(f))
    assert c.input_path == "in.csv" and c.fuzzy is True
    f.write_text("input_path: ${NOT_SET_ANYWHERE}\nbatch_size: 5\nfuzzy_threshold: 2\n")
    with pytest.raises(ValueError, match="batch_size.*fuzzy_threshold|fuzzy_threshold.*batch_size"):
        config.load(str(f))


def test_metrics_small(spark):
    assert metrics.batch_sizes(10, 5) == [5, 2, 1, 1, 1]
    r = spark.createDataFrame([("a", 10.0, True, 1.0), ("a", 20.0, True, 3.0), ("b", 5.0, False, 1.0)], "configuration string, throughput double, ok boolean, utilisation double")
    s = metrics.benchmark_summary(r).collect()
    assert len(s) == 1 and s[0].avg_throughput == 15.0 and s[0].success_rate == 100.0


def test_registered_queries_all_have_sql():
    from addrloom.plans import oracles, queries

    q, o = queries.queries(), oracles.oracle_sql()
    assert set(o) <= set(q) and set(o) == set(q)


@pytest.mark.parametrize(("threshold", "block"), [(0.85, 0), (0.85, 50_000), (0.6, 0), (0.72, 0)])
def test_leaders_in_rounds_equal_the_sequential_scan(spark, monkeypatch, threshold, block):
    monkeypatch.setattr(similar, "EDGE_BLOCK", block)
    monkeypatch.setattr(similar, "PAIR_BLOCK", 16)
    r = random.Random(int(threshold * 100) + block)
    stems = ["".join(r.choice("abcd ") for _ in range(r.randint(3, 14))) for _ in range(25)]
    names = ["", "  ", "a", "b a", "aaaaaaaaaaaaaaaaaaaa", "aaaaaaaaaaaaaaaaaaab"]
    for stem in stems * 8:
        x = list(stem)
        for _ in range(r.randint(0, 3)):
            x.insert(r.randint(0, len(x)), r.choice("abcdé"))
        names.append("".join(x))
    rows = [(k, n, r.choice(["1", "1", "1", "2", ""])) for k, n in enumerate(names)]
    df = spark.createDataFrame(rows, "row_id long, name_key string, pin_key string").repartition(4)
    got = {(x.pin_key, x.name_key): x.leader for x in consolidate.fuzzy_leaders(df, threshold).collect()}
    for pin in ("1", "2", ""):
        own = list(dict.fromkeys(n for _, n, p in rows if p == pin))
        assert [got[pin, n] for n in own] == consolidate.leaders_of(own, threshold)


def test_chains_settle_in_rounds(spark, monkeypatch):
    monkeypatch.setattr(similar, "EDGE_BLOCK", 0)
    edges = spark.createDataFrame([("x", k, k + 1, k, k + 1) for k in range(9)], "pin_key string, u long, v long, at_u long, at_v long")
    assert sorted(x.v for x in similar.followers(edges).collect()) == [1, 3, 5, 7, 9]
    assert similar.followers(edges.limit(0)).count() == 0


def test_few_candidates_for_a_hot_code(spark):
    r = random.Random(11)
    parts = ["".join(r.choice("bcdfglmnprst") + r.choice("aeiou") for _ in range(r.randint(2, 4))) for _ in range(900)]
    names = set()
    while len(names) < 4000:
        n = f"{r.choice(parts)} {r.choice(parts)} {r.choice(['residency', 'heights', 'apartment', 'society', 'park'])}"
        k = r.randrange(len(n))
        names |= {n, n[:k] + n[k + 1 :], n.replace("e", "ea", 1)}
    table = similar.name_table(spark.createDataFrame([("411001", n) for n in names], "pin_key string, name_key string"), 0.85)
    tried, like = similar.candidates(table, 0.85).count(), similar.pairs(table, 0.85).filter("similarity >= 0.85").count()
    assert like > 3000 and tried < 10 * like, (tried, like)


def test_one_scan_and_no_sort_before_the_first_shuffle(spark):
    df = spark.createDataFrame([(1, "a", "p"), (2, "b", "p")], "row_id long, name string, pin_code string").select("row_id", F.struct(F.col("name").alias("society_name"), "pin_code").alias("parsed"))
    plan = consolidate.exact_groups(consolidate.keyed(df))._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan[plan.rindex("Exchange") :] and plan.count("Scan") == 1, plan
