"""Work that must spread, or be done once, as tables grow; and quick forms of patterns that must find what the plain ones do."""

import random

from pyspark.sql import functions as F

from addrloom import config
from addrloom.functions import entities, rules
from addrloom.operators import compare, consolidate
from addrloom.plans import batch, queries
from addrloom.plans.fixtures import addresses, with_entities
from addrloom.sources import readers

SF = "/root/testdata/sf0.001"


def test_rows_are_dealt_out_after_the_join(spark, monkeypatch):
    monkeypatch.setattr(readers, "TASK_ROWS", 100)
    n = spark.read.parquet(f"{SF}/orders.parquet").count()
    sizes = [r["count"] for r in addresses(spark, SF).groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == n and len(sizes) == -(-n // 100) and max(sizes) <= 200


def test_stream_files_grow_in_number_and_not_in_size(spark, monkeypatch):
    monkeypatch.setattr(readers, "TASK_ROWS", 100)
    out = queries.stream_rule_parse(spark, SF)
    assert out.count() == spark.read.parquet(f"{SF}/orders.parquet").count()
    assert len(out.inputFiles()) > 4


def test_stream_consolidation_parses_each_row_once(spark, monkeypatch):
    seen, recognised = spark.sparkContext.accumulator(0), queries._recognised

    def count(k):
        seen.add(1)
        return k

    monkeypatch.setattr(queries, "_recognised", lambda s, d: recognised(s, d).withColumn("row_id", F.udf(count, "long").asNondeterministic()("row_id")))
    assert queries.stream_consolidation(spark, SF).count() > 0
    assert seen.value == spark.read.parquet(f"{SF}/orders.parquet").count()


def test_metrics_of_both_parsers_are_one_pass(spark, tmp_path):
    queries._pairs(spark, SF).write.parquet(str(tmp_path / "pairs"))
    metrics = compare.parser_metrics(spark.read.parquet(str(tmp_path / "pairs")), ms_a=0.3, ms_b=800.0)
    assert metrics._jdf.queryExecution().optimizedPlan().toString().count("Relation ") == 1
    assert [(r["parser"], r["ms"]) for r in metrics.orderBy("parser").collect()] == [("a", 0.3), ("b", 800.0)]


def test_quick_patterns_find_what_plain_ones_do(spark):
    r = random.Random(5)
    parts = ["Flat", "fLAT", "APT", "Unit", "shop", " ", "  ", "\t", ",", ", ", "#", "-", "/", "12", "411045", "4110456", "A-204", "B-Wing 4", "3rd Floor", "Near", "opp.", "OPP ", "Opposite ", "Baner", "Road", "MARG", "St", " Street", " Rd.", "Rd", "é", "K", "x", "\n"]
    texts = ["".join(r.choices(parts, k=r.randint(1, 14))) for _ in range(3000)] + ["", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string").withColumn("low", F.lower("t"))
    t, low = F.col("t"), F.col("low")
    plain = lambda patterns, flag: F.coalesce(*(F.nullif(F.regexp_replace(F.regexp_extract(t, flag + p, 1), r"^\s+|\s+$", ""), F.lit("")) for p in patterns), F.lit(""))
    for patterns, ignore_case in ((rules.UNIT, True), (rules.SOCIETY, True), ([rules.LANDMARK], False), (rules.ROAD, False)):
        own = df.filter(~plain(patterns, "(?i)" * ignore_case).eqNullSafe(rules.first_match(t, low, patterns, ignore_case)))
        assert own.take(3) == [], patterns
    assert df.filter(~rules.pin_code(t).eqNullSafe(F.regexp_extract(t, rules.PIN, 1))).take(3) == []


def test_grouping_computes_only_what_it_reads_and_keys_names_once_counted(spark):
    ways = (queries._recognised(spark, SF), queries._named(spark, SF)), (queries._parsed(spark, SF), queries.rule_parse(addresses(spark, SF), fields=consolidate.READ))
    for whole, part in ways:
        cols = ["name_key", "pin_key", "society", "n", "first_row"]
        want, got = (sorted(map(repr, consolidate.named(x).select(cols).collect())) for x in (consolidate.keyed(whole), part))
        assert got == want and len(got) > 10
        plan = consolidate.named(part)._jdf.queryExecution().optimizedPlan().toString()
        rows = plan.split("Project [row_id", 1)[1]  # below the counting
        assert "struct(society_name, " in rows and "sub_locality" not in rows and "[-_]" not in rows


def test_fields_left_out_change_no_other(spark):
    for f in ("district", "city", "pin_code", "unit_number"):
        for parse, rows in ((entities.map_entities, with_entities(addresses(spark, SF))), (rules.rule_parse, addresses(spark, SF))):
            whole, part = (parse(rows, **k).select("row_id", f"parsed.{f}", "parsed.parse_success", "parsed.parse_error") for k in ({}, {"fields": [f]}))
            assert whole.exceptAll(part).isEmpty() and part.count() == whole.count()


def test_a_file_s_rows_are_parsed_in_many_tasks_and_keep_their_order(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(readers, "TASK_ROWS", 100)
    texts = [f"Flat {k}, Kumar Paradise, Baner Road, Pune {411000 + k % 90}" for k in range(950)]
    (tmp_path / "a.csv").write_text("addr_text,pincode,city_id\n" + "".join(f'"{t}",4110{k % 90:02d},"C\n{k}"\n' for k, t in enumerate(texts)))
    rows = batch.parsed_file(spark, str(tmp_path / "a.csv"), config.build({"batch_input": [f"{tmp_path}/*.csv"], "batch_output": str(tmp_path / "out")}))
    sizes = [r["count"] for r in rows.groupBy(F.spark_partition_id().alias("p")).count().orderBy("p").collect()]
    assert sizes == [100] * 9 + [50]
    assert [r.addr_text for r in rows.collect()] == texts
    monkeypatch.setattr(readers, "LEAST_RECORD", 20_000)  # rows are shorter than thought
    assert [r.addr_text for r in readers.spread_in_order(readers.read_addresses(spark, str(tmp_path / "a.csv")), 5_000_000).collect()] == texts


def test_journal_s_files_grow_in_number(spark, monkeypatch):
    want = sorted(map(repr, queries.batch_journal(spark, SF).collect()))
    made, run = [], queries.run_batch
    monkeypatch.setattr(queries, "run_batch", lambda s, c: made.append(run(s, c)))
    monkeypatch.setattr(queries, "FILE_ROWS", 100)
    assert sorted(map(repr, queries.batch_journal(spark, SF).collect())) == want
    assert made[0]["files"] == 28 and made[1]["files"] == 0
