"""Records with quoted line breaks read over many splits, against the reader that takes a file as one."""

import csv
import io
import random

import pytest

from addrloom.sources import readers, records

HEAD = "addr_text,pincode,city_id,extra\n"


@pytest.fixture
def splits(spark):
    """Splits of a few hundred bytes."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1500b")
    spark.conf.set("spark.sql.files.openCostInBytes", "0b")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def value(r):
    kind = r.random()
    if kind < 0.3:
        return "".join(r.choice(["a", "b", " ", '"', ",", "\n", "é", "\r\n"]) for _ in range(r.randint(0, 12)))
    if kind < 0.32:
        return "line\n" * r.randint(100, 300)  # over several splits
    return f"Flat {r.randint(0, 99)}"


def written(rows, end="\n"):
    out = io.StringIO()
    w = csv.writer(out, lineterminator=end)
    w.writerows(rows)
    return out.getvalue()


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_records_over_splits_equal_whole_files(spark, tmp_path, splits, end):
    r = random.Random(len(end))
    for k in range(3):
        rows = [[value(r) for _ in range(4 if r.random() < 0.9 else 2)] for _ in range(250)]
        (tmp_path / f"f{k}.csv").write_bytes((HEAD.replace("\n", end) + written(rows, end)).encode())
    (tmp_path / "empty.csv").write_bytes(HEAD.encode())
    (tmp_path / "open.csv").write_bytes((HEAD + 'x,1,2,3\n"never closed,1\nmore,"",1,').encode())
    got = readers.read_addresses(spark, str(tmp_path), split_bytes=0)
    assert got.rdd.getNumPartitions() > 10
    whole = spark.read.schema(got.drop("source_file").schema).option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"').csv(str(tmp_path))
    key = lambda df: sorted(repr(tuple(x)) for x in df.select("addr_text", "pincode", "city_id", "extra").collect())
    assert key(got) == key(whole) and len(key(got)) > 700
    assert {x.source_file.split("/")[-1] for x in got.select("source_file").distinct().collect()} == {"f0.csv", "f1.csv", "f2.csv", "open.csv"}


def test_either_beginning_of_a_split_is_composed(spark):
    r = random.Random(4)
    rows, want = [], {}
    for f in range(30):
        inside = False
        for k in range(r.randint(1, 9)):
            out, in_ = r.choice([(False, False), (True, True), (False, True), (True, False)])
            want[f"f{f}", k] = inside
            rows.append((f"f{f}", k, out, in_))
            inside = in_ if inside else out
    got = records.beginnings(spark.createDataFrame(rows, "file string, start long, end_out boolean, end_in boolean")).collect()
    assert {(x.file, x.start): x.inside for x in got} == want


@pytest.mark.parametrize(("line", "inside", "after"), [("a,b", False, False), ('a,"b', False, True), ('a,"b"', False, False), ('a"b,c', False, False), ('a"",c', False, False), ('"a""b', False, True), ('b""', True, True), ('b"', True, False), ('b",""', True, False), ('b","', True, True), ("", True, True), ('""', False, False), ('"', False, True), (',"', False, True), (' "a', False, False)])
def test_line_ends(line, inside, after):
    assert records.ends_inside(line, inside) is after
