"""Parsers of one's own, runs over many files, command line, configuration, state, reports."""

import json
import os
import time

import pytest
from pyspark.sql import functions as F

from addrloom import cli, config
from addrloom.functions.rules import rule_parse
from addrloom.operators import consolidate, routing
from addrloom.plans import batch, parsers
from addrloom.schema import FIELDS
from addrloom.sources import journal, readers, sinks
from addrloom.streaming import incremental

HEAD = "addr_hash_key,addr_text,city_id,pincode\n"


def rows_of(n, start=0):
    return "".join(f'h{k},"Flat {k}, Kumar Paradise, Baner, Pune 411001",c,411001\n' for k in range(start, start + n))


class Flaky:
    """Fails on the first calls, and always on one text."""

    def __init__(self):
        self.calls = 0

    def parse_address(self, text):
        self.calls += 1
        if self.calls <= 2 or "never" in text:
            raise RuntimeError("busy")
        return {"city": text.split()[-1], "society_name": "  ", "note": None}


def test_records_are_tried_again():
    waited = []
    m = Flaky()
    got = parsers.records(m, ["a Pune", None, "  ", "never"], attempts=3, waits=[0.5, 1.0], sleep=waited.append)
    assert [r["parse_success"] for r in got] == [True, False, False, False]
    assert got[0]["city"] == "Pune" and got[0]["society_name"] == "" and got[0]["note"] == ""
    assert got[1]["parse_error"] == got[2]["parse_error"] == "Empty address text" or got[1]["parse_error"] == got[2]["parse_error"]
    assert got[3]["parse_error"] == "parsing failed after 3 attempts: busy" and waited == [0.5, 1.0, 0.5, 1.0]


def test_a_batch_that_fails_is_tried_text_by_text():
    class Batch:
        def parse_batch(self, texts):
            if "bad" in texts:
                raise ValueError("bad one")
            return [{"city": t} for t in texts]

    class Short(Batch):
        def parse_batch(self, texts):
            return [{"city": texts[0]}]

    got = parsers.records(Batch(), ["x", "bad", "y"], attempts=1)
    assert [r["city"] for r in got] == ["x", "", "y"] and got[1]["parse_error"].endswith("bad one")
    assert [r["city"] for r in parsers.records(Short(), ["x", "y"], attempts=1)] == ["x", "y"]


def test_external_parser_keeps_rows_and_columns(spark):
    df = spark.createDataFrame([(k, f"road {k} City{k}" if k % 4 else None, [k]) for k in range(50)], "row_id long, addr_text string, more array<int>").repartition(3)
    out = parsers.external(Flaky, batch_size=7, waits=[0.0])(df, "addr_text", "parsed")
    got = {r.row_id: r for r in out.collect()}
    assert out.columns == ["row_id", "addr_text", "more", "parsed"] and len(got) == 50
    assert all(got[k].more == [k] and got[k].parsed.parse_success == bool(k % 4) and (not k % 4 or got[k].parsed.city == f"City{k}") for k in range(50))
    assert parsers.external(Flaky)(df.limit(0), "addr_text", "parsed").count() == 0


@pytest.mark.parametrize("name", config.PARSERS)
def test_every_parser_type_parses(spark, name):
    df = spark.createDataFrame([(1, "Flat 1, Kumar Paradise, Baner, Pune 411001"), (2, None)], "row_id long, addr_text string")
    out = parsers.parser(name)(parsers.with_inputs(df, name), "addr_text", "parsed")
    rows = {r.row_id: r.parsed for r in out.collect()}
    assert set(rows) == {1, 2} and not rows[2].parse_success and list(rows[1].asDict()) == [*FIELDS, "parse_success", "parse_error"]
    assert rows[1].parse_success or name == "answers"


def test_inputs_come_from_json_columns(spark):
    df = spark.createDataFrame([(1, "x, Pune", '[{"entity_group": "city", "word": "Pune", "score": 0.9}]', '{"CY": "Agra"}')], "row_id long, addr_text string, entities string, answer string")
    assert parsers.parser("entities")(parsers.with_inputs(df, "entities"), "addr_text", "parsed").first().parsed.city == "Pune"
    assert parsers.parser("answers")(parsers.with_inputs(df, "answers"), "addr_text", "parsed").first().parsed.city == "Agra"
    with pytest.raises(ValueError):
        parsers.parser("none")


def test_routed_parse_asks_the_other_only_after_a_failure(spark):
    df = spark.createDataFrame([(k, f"Flat {k}, near school, Baner Road, Pune" if k % 2 else "Pune") for k in range(40)], "row_id long, addr_text string")

    def marked(name, fails):
        def parse(x, column, out):
            y = rule_parse(x, column, out)
            return y.withColumn(out, F.col(out).withField("parse_success", F.col(f"{out}.parse_success") & (F.col("row_id") % fails != 0)).withField("city", F.when(F.col(column).isNotNull(), F.lit(name)).otherwise(F.lit(""))))

        return parse

    for fallback in (True, False):
        got = routing.routed_parse(df, marked("r", 3), marked("e", 5), threshold=0.3, fallback=fallback).collect()
        for r in got:
            first, second = ("e", "r") if r.route == "entities" else ("r", "e")
            ok = {"r": r.row_id % 3 != 0, "e": r.row_id % 5 != 0}
            want = first if ok[first] else second if ok[second] and fallback else None
            assert (r.used or "-")[0] == (want or "-") and r.fell_back == (want == second) and (want is None or r.parsed.city == want)


def test_files_of_other_layouts_are_read_by_name(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "one.csv").write_text(HEAD + rows_of(2))
    (tmp_path / "a" / "two.csv").write_text('﻿pincode,"addr_text",extra,city_id\n411002,"B, Pune",e,d\n')
    (tmp_path / "a" / "_hidden.csv").write_text("x\n")
    got = {r.addr_text: r for r in readers.read_addresses(spark, str(tmp_path / "a")).collect()}
    assert got["B, Pune"].pincode == "411002" and got["B, Pune"].city_id == "d" and got["B, Pune"].addr_hash_key is None
    assert got["Flat 0, Kumar Paradise, Baner, Pune 411001"].extra is None and len(got) == 3
    assert readers.read_addresses(spark, [str(tmp_path / "a" / "*.csv")], multi_line=False).count() == 3
    (tmp_path / "a" / "bad.csv").write_text("addr_text\nx\n")
    with pytest.raises(ValueError, match="bad.csv"):
        readers.read_addresses(spark, str(tmp_path / "a"))


def test_patterns_reach_into_folders(spark, tmp_path):
    for name in ("x.csv", "a/x.csv", "a/b/y.csv", "a/b/x.txt"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text("a\n")
    short = lambda found: [f.split(str(tmp_path) + "/")[1] for f in found]
    assert short(readers.discover(spark, [f"{tmp_path}/**/*.csv", f"{tmp_path}/*.csv"])) == ["a/b/y.csv", "a/x.csv", "x.csv"]
    assert short(readers.discover(spark, [f"{tmp_path}/a/**/y.*"])) == ["a/b/y.csv"] and readers.discover(spark, [f"{tmp_path}/none/**"]) == []


def test_batches_go_on_where_they_were(spark, tmp_path):
    src, out = tmp_path / "in", tmp_path / "out"
    (src / "deep").mkdir(parents=True)
    (src / "one.csv").write_text(HEAD + rows_of(5))
    (src / "deep" / "two.csv").write_text(HEAD + rows_of(3))
    (src / "bad.csv").write_text("nothing,here\n1,2\n")
    c = config.build({"batch_input": [f"{src}/**/*.csv"], "batch_output": str(out)})
    report = batch.run_batch(spark, c)
    assert (report["files"], report["rows"], report["succeeded"]) == (3, 8, 8) and list(report["failed"]) == [f"file:{src}/bad.csv"]
    written = {p.name.split("_processed_")[0][:-9]: p for p in out.iterdir() if "_processed_" in p.name and not p.name.startswith(".")}
    back = spark.read.option("header", True).option("escape", '"').csv(str(written["one"]))
    assert back.count() == 5 and back.columns[9:12] == ["UN", "SN", "LN"] and back.columns[-4:] == ["parse_success", "parse_error", "processing_method", "processing_time"]
    again = batch.run_batch(spark, c)
    assert again["files"] == 1 and len(again["skipped"]) == 2  # the failed one is tried again
    os.utime(src / "one.csv", (time.time() + 100,) * 2)
    assert batch.run_batch(spark, c)["rows"] == 5  # newer than its output
    assert any(p.name.endswith("batch_report.json") for p in out.iterdir())


def test_command_line(spark, tmp_path, capsys, monkeypatch):
    monkeypatch.setattr(cli, "_spark", lambda: spark)
    src = tmp_path / "in.csv"
    src.write_text(HEAD + rows_of(4))
    for k, name in enumerate(config.PARSERS):
        assert cli.main(["--input", str(src), "--output", str(tmp_path / f"o{k}"), "--parser", name]) == 0
    assert cli.main(["consolidate", "--input", str(src), "--output", str(tmp_path / "with"), "--report", str(tmp_path / "r.xlsx")]) == 0 and (tmp_path / "r.xlsx").stat().st_size > 500
    assert cli.main(["consolidate", "--input", str(src)]) == 1  # no output
    assert cli.main(["consolidate", "--input", str(tmp_path / "none.csv"), "--output", "x"]) == 2
    bad = tmp_path / "bad.csv"
    bad.write_text("a\n1\n")
    assert cli.main(["consolidate", "--input", str(bad), "--output", "x"]) == 4
    assert cli.main(["batch", "--input", str(src), "--output", str(tmp_path / "b")]) == 0
    assert cli.main(["batch", "--input", str(src), str(bad), "--output", str(tmp_path / "b")]) == 1
    for name in ("r1", "r2"):
        assert cli.main(["benchmark", "--input", str(src), "--output", str(tmp_path / name), "--runs", "2"]) == 0
    spark.createDataFrame([("rules", 0.001, True, 100.0)], "configuration string, throughput double, ok boolean, utilisation double").write.json(str(tmp_path / "slow"))
    assert cli.main(["regression", "--baseline", str(tmp_path / "slow"), "--current", str(tmp_path / "r1")]) == 0
    assert cli.main(["regression", "--baseline", str(tmp_path / "r1"), "--current", str(tmp_path / "slow")]) == 1
    capsys.readouterr()
    old = tmp_path / "old.yaml"
    old.write_text("gpu_batch_size: 500\nsimilarity_threshold: 0.9\ninput_file: a.csv\noutput_file: b\nunknown: 1\n")
    assert cli.main(["configure", "--migrate", str(old), "--output", str(tmp_path / "new.yaml")]) == 0
    assert json.loads(capsys.readouterr().out)["left"] == ["unknown"]
    c = config.load(str(tmp_path / "new.yaml"))
    assert (c.batch_size, c.fuzzy_threshold, c.input_path, c.output_path) == (500, 0.9, "a.csv", "b")
    assert cli.main(["configure", "--check", str(tmp_path / "new.yaml")]) == 0 and cli.main(["configure"]) == 1

    def broken(_):
        raise KeyboardInterrupt

    monkeypatch.setattr(cli, "consolidate", broken)
    monkeypatch.setattr(cli, "arguments", lambda f=cli.arguments: f())
    assert cli.main(["consolidate", "--input", "a", "--output", "b"]) == 130
    monkeypatch.setattr(cli, "consolidate", lambda _: (_ for _ in ()).throw(PermissionError("no")))
    assert cli.main(["consolidate", "--input", "a", "--output", "b"]) == 3
    monkeypatch.setattr(cli, "consolidate", lambda _: (_ for _ in ()).throw(RuntimeError("no")))
    assert cli.main(["consolidate", "--input", "a", "--output", "b"]) == 5


def test_combinations_of_parameters(monkeypatch):
    with pytest.raises(config.ConfigurationError, match="exclude"):
        config.build({"input_path": "a", "batch_input": "b", "output_path": "c", "batch_output": "d"})
    with pytest.raises(config.ConfigurationError, match="batch_output"):
        config.build({"batch_input": "b"})
    with pytest.raises(config.ConfigurationError, match="not a valid int"):
        config.build({"input_path": "a", "output_path": "b", "batch_size": "many"})
    assert config.build({"input_path": "a", "output_path": "b", "batch_size": 900, "cpu_ratio": "0.1"}).warnings()
    assert config.migrated({"queue_size": 5}, {"GPU_BATCH_SIZE": "300", "OTHER": "1"}) == ({"queue_size": 5, "batch_size": 300}, [])


def test_state_is_replaced_whole(spark, tmp_path):
    path = str(tmp_path / "state")
    assert journal.load_state(spark, path, "k long").count() == 0
    for k in range(3):
        journal.save_state(spark.createDataFrame([(k,)], "k long"), path)
        assert [r.k for r in journal.load_state(spark, path, "k long").collect()] == [k]
        assert len([p for p in (tmp_path / "state").iterdir() if p.is_dir()]) == 1
    assert [p.name for p in tmp_path.iterdir()] == ["state"]


def test_state_stays_while_its_successor_is_not_complete(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "state")
    journal.save_state(spark.createDataFrame([(1,)], "k long"), path)
    broken = spark.range(4).select(F.raise_error(F.lit("lost")).cast("long").alias("k"))
    with pytest.raises(Exception, match="lost"):
        journal.save_state(broken, path)
    (tmp_path / "state" / "v0000000007-dead" / "_temporary").mkdir(parents=True)
    assert [r.k for r in journal.load_state(spark, path, "k long").collect()] == [1]
    journal.save_state(spark.createDataFrame([(2,)], "k long"), path)
    assert [r.k for r in journal.load_state(spark, path, "k long").collect()] == [2]
    assert [p.name[:11] for p in (tmp_path / "state").iterdir() if p.is_dir()] == ["v0000000008"]


def test_a_refused_rename_is_no_entry(spark, tmp_path, monkeypatch):
    (tmp_path / "journal").mkdir()
    entry = {"path": "a", "status": "completed", "at": 5.0}
    journal.append(spark, str(tmp_path / "journal"), entry)
    fs, _ = readers._file_system(spark, str(tmp_path))

    class Refusing:
        def __getattr__(self, name):
            return getattr(fs, name)

        def rename(self, *_):
            return False

    monkeypatch.setattr(journal, "_file_system", lambda s, p: (Refusing(), readers._file_system(s, p)[1]))
    with pytest.raises(OSError, match="journal"):
        journal.append(spark, str(tmp_path / "journal"), entry | {"path": "b"})
    assert [(r.path, r.at) for r in journal.entries(spark, str(tmp_path / "journal")).collect()] == [("a", 5.0)]
    again = spark.createDataFrame([("a", None, "failed", 0, 0, 1.0, "x", 1, 6.0), ("a", "o", "completed", 3, 3, 1.0, None, 1, 5.0)], journal.ENTRY)
    assert [(r.status, r.rows) for r in journal.current(again).collect()] == [("failed", 0)]


def _texts(spark, out):
    return sorted(r.addr_text for p in out.iterdir() if "_processed_" in p.name and (p / "_SUCCESS").exists() for r in spark.read.option("header", True).csv(str(p)).collect())


def test_files_of_one_name_keep_their_own_outputs(spark, tmp_path):
    for folder, first in (("north", 0), ("south", 100)):
        (tmp_path / "in" / folder).mkdir(parents=True)
        (tmp_path / "in" / folder / "a.csv").write_text(HEAD + rows_of(1, first))
    c = config.build({"batch_input": [f"{tmp_path}/in/**/*.csv"], "batch_output": str(tmp_path / "out")})
    assert batch.run_batch(spark, c)["rows"] == 2
    assert [t[:9] for t in _texts(spark, tmp_path / "out")] == ["Flat 0, K", "Flat 100,"]
    assert batch.run_batch(spark, c)["files"] == 0


def test_an_output_that_was_not_finished_counts_for_nothing(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "b.csv").write_text(HEAD + rows_of(2))
    (tmp_path / "in" / "empty.csv").write_text(HEAD)
    c = config.build({"batch_input": [f"{tmp_path}/in/*.csv"], "batch_output": str(tmp_path / "out")})
    key = journal.path_key(f"file:{tmp_path}/in/b.csv")
    for name in (f"b-{key}_processed_20990101_000000", "b_processed_20990101_000000"):
        (tmp_path / "out" / name / "_temporary").mkdir(parents=True)
    assert batch.run_batch(spark, c)["rows"] == 2
    assert batch.run_batch(spark, c)["files"] == 0
    made = next(p for p in (tmp_path / "out").iterdir() if p.name.startswith("b-") and (p / "_SUCCESS").exists())
    (made / "_SUCCESS").unlink()
    assert batch.run_batch(spark, c)["rows"] == 2 and batch.run_batch(spark, c)["files"] == 0


def test_a_run_that_was_killed_resumes(spark, tmp_path, monkeypatch):
    (tmp_path / "in").mkdir()
    for k in range(4):
        (tmp_path / "in" / f"f{k}.csv").write_text(HEAD + rows_of(1, 10 * k))
    c = config.build({"batch_input": [f"{tmp_path}/in/*.csv"], "batch_output": str(tmp_path / "out")})
    append, seen = journal.append, []

    def killed(s, folder, entry):
        seen.append(entry["path"])
        if len(seen) == 3:  # the third file's output is there, its entry isn't
            raise KeyboardInterrupt
        append(s, folder, entry)

    monkeypatch.setattr(journal, "append", killed)
    with pytest.raises(KeyboardInterrupt):
        batch.run_batch(spark, c, together=1)
    monkeypatch.setattr(journal, "append", append)
    done = journal.current(journal.entries(spark, f"{tmp_path}/out/_journal")).collect()
    assert len(done) >= 2 and all(r.status == "completed" for r in done)
    report = batch.run_batch(spark, c)
    assert report["files"] == 4 - len(done) and seen[2] not in {r.path for r in done}
    last = journal.current(journal.entries(spark, f"{tmp_path}/out/_journal")).collect()
    assert len(last) == 4 and sorted(r.rows for r in last) == [1] * 4
    outputs = {r.output.removeprefix("file:") for r in last}
    assert sorted(t[:7] for o in outputs for t in [spark.read.option("header", True).csv(o).first().addr_text]) == ["Flat 0,", "Flat 10", "Flat 20", "Flat 30"]


def test_reports(spark):
    meta = {"total_rows": 1200, "successful": 1000, "failed": 200, "success_rate": 83.3}
    run = sinks.Run(at="now", seconds=2.0, gpu_rows=900, rate=600.0, errors=[f"e{k}" for k in range(7)], advice=["a", "b", "c", "d"])
    head = sinks.preamble(meta, run)
    assert all(x.startswith("#") for x in head) and "# GPU rows: 900 (75.0%)" in head and sum("  - e" in x for x in head) == 5 and sum(x in ("#   - a", "#   - c", "#   - d") for x in head) == 2
    assert "Achieved: 30.0%" in sinks.performance_text(meta, run)
    text = sinks.error_text([("x", 3), ("y", 1)], [(4, "x")])
    assert "x: 3 (75.0%)" in text and "4: x" in text and "none" in sinks.error_text([], [])
    files = spark.createDataFrame([(1, "a", 100, 90, 10, 1.0, 100.0), (2, "b", 100, 100, 0, 0.5, 200.0)], "file_index int, source_file string, rows long, succeeded long, errors long, seconds double, rate double")
    report = sinks.batch_report(files).first().asDict(recursive=True)
    assert report["mean_rate"] == 150.0 and report["peak_rate"] == 200.0 and report["variation"] == pytest.approx(1 / 3, abs=1e-6) and "files differ much: like sizes, like batches" in report["advice"]
    assert "1. a: 100 rows, 10 errors, 1.00 s" in sinks.batch_text(report)
    assert sinks.batch_report(files.limit(0)).first()["files"] == 0


def test_ranges_grow_with_the_rows(spark, monkeypatch):
    monkeypatch.setattr(sinks, "RANGE_ROWS", 100)
    df = spark.range(1000).select((F.col("id") * 7 % 1000).alias("k"))
    got = sinks.ranked(df, "k").collect()
    assert all(r.ordinal == r.k + 1 for r in got)
    assert sinks.ranked(df.limit(0), "k").count() == 0


def test_nothing_is_left_of_an_empty_output(spark, tmp_path):
    df = spark.createDataFrame([], "a string")
    assert sinks.write_csv(df, str(tmp_path / "o")) == 0 and not (tmp_path / "o").exists()
    assert sinks.write_csv(spark.createDataFrame([(" x ",)], "a string"), str(tmp_path / "o")) == 1
    assert spark.read.option("header", True).csv(str(tmp_path / "o")).first().a == " x "


def test_stream_of_several_batches_equals_batch(spark, tmp_path):
    names = ["blue ridge", "green park", "blue ridges", "ridge blue", "green parks", "park", "blue ridge x"]
    rows = [(k, str(k % 2), names[k * 5 % 7]) for k in range(60)]
    df = spark.createDataFrame(rows, "row_id long, pin_key string, name_key string")
    source = str(tmp_path / "in")
    for k in range(4):  # files in order of their rows, a batch each
        df.filter((F.col("row_id") >= 15 * k) & (F.col("row_id") < 15 * (k + 1))).coalesce(1).write.mode("append").parquet(source)
        stream = incremental.consolidated_stream(incremental.address_stream(spark, source, df.schema, 1, "parquet"))
        incremental.run_to_parquet(stream, str(tmp_path / "out"), str(tmp_path / "cp"))
    out = spark.read.parquet(str(tmp_path / "out"))
    want = {(r.pin_key, r.name_key): r.leader for r in consolidate.fuzzy_leaders(df).collect()}
    assert {(r.pin_key, r.name_key): r.leader for r in out.collect()} == want and out.agg(F.sum("rows")).first()[0] == 60


def test_workbooks_hold_what_the_tables_hold(spark, tmp_path):
    import zipfile
    from xml.etree import ElementTree

    from addrloom.sources import workbook

    rows = [(1, "a & <b>\n\x01 é", None, True, 1.5), (2, " kept ", 3, False, float("nan"))]
    tables = {"details": spark.createDataFrame(rows, "id long, text string, n int, ok boolean, x double").orderBy("id"), "none/of:it": spark.createDataFrame([], "a string")}
    path = str(tmp_path / "out.xlsx")
    workbook.write_workbook(tables, path)
    workbook.write_workbook(tables, path)  # replaces
    tag = lambda x: x.tag.split("}")[1]
    with zipfile.ZipFile(path) as z:
        assert z.testzip() is None and all(ElementTree.fromstring(z.read(n)) is not None for n in z.namelist())
        names = [s.get("name") for s in ElementTree.fromstring(z.read("xl/workbook.xml")).iter() if tag(s) == "sheet"]
        sheet = [[(c.get("t"), "".join(c.itertext())) for c in r] for r in ElementTree.fromstring(z.read("xl/worksheets/sheet1.xml")).iter() if tag(r) == "row"]
        assert sum(tag(r) == "row" for r in ElementTree.fromstring(z.read("xl/worksheets/sheet2.xml")).iter()) == 1
    assert names == ["details", "none_of_it"] and [v for _, v in sheet[0]] == ["id", "text", "n", "ok", "x"]
    assert sheet[1] == [(None, "1"), ("inlineStr", "a & <b>\n é"), (None, ""), ("b", "1"), (None, "1.5")]
    assert sheet[2] == [(None, "2"), ("inlineStr", " kept "), (None, "3"), ("b", "0"), ("inlineStr", "nan")]
    assert workbook.sheet_names(["x" * 40, "X" * 40, "", "[a]"]) == ["x" * 31, "X" * 29 + "_2", "Sheet", "_a_"]
    with pytest.raises(ValueError):
        workbook.write_workbook({}, path)


def test_a_sheet_has_a_limit(spark, tmp_path, monkeypatch):
    from addrloom.sources import workbook

    monkeypatch.setattr(workbook, "MOST_ROWS", 3)
    workbook.write_workbook({"a": spark.range(2)}, str(tmp_path / "a.xlsx"))
    with pytest.raises(ValueError, match="a: a sheet holds 2 rows"):
        workbook.write_workbook({"a": spark.range(3)}, str(tmp_path / "b.xlsx"))
    assert [p.name for p in tmp_path.glob("*.xlsx")] == ["a.xlsx"]
