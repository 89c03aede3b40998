"""Registered queries: one for each operator, over the address relation or the driver's tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..config import build
from ..functions import text
from ..functions.complexity import complexity
from ..functions.entities import label_inventory, map_components, map_entities, map_generic_entities
from ..functions.llm_json import answer_cost, keyword_parse, map_answers, prompt
from ..functions.rules import rule_parse
from ..operators import advice, compare, consolidate, devices, measure, metrics, pins, routing, sketches
from ..schema import FIELDS
from ..sources import journal, readers, sinks
from ..streaming import incremental
from .batch import run_batch
from .fixtures import addresses, with_answers, with_components, with_entities
from .parsers import external

Query = Callable[[SparkSession, str], DataFrame]
_ALL: dict[str, Query] = {}


def query(f: Query) -> Query:
    _ALL[f.__name__] = f
    return f


def _table(s: SparkSession, d: str, name: str) -> DataFrame:
    return s.read.parquet(f"{d}/{name}.parquet")


def _parsed(s: SparkSession, d: str) -> DataFrame:
    return rule_parse(addresses(s, d))


def _recognised(s: SparkSession, d: str) -> DataFrame:
    return map_entities(with_entities(addresses(s, d)))


def _named(s: SparkSession, d: str) -> DataFrame:
    """What grouping reads of `_recognised`."""
    return map_entities(with_entities(addresses(s, d)), fields=consolidate.READ)


def _flat(df: DataFrame, fields: list[str] = FIELDS, *more: str) -> DataFrame:
    return df.select("row_id", *(F.col(f"parsed.{f}") for f in fields), *(F.col(f"parsed.{m}") for m in more))


def _checked(s: SparkSession, d: str) -> DataFrame:
    return readers.classified(addresses(s, d).select("row_id", "addr_text", "pincode", "city_id", "assigned_pickup_dlvd_geo_points_count"))


def _pairs(s: SparkSession, d: str) -> DataFrame:
    """Both parsers' records of each row, from one projection: what is parsed from the same rows needs no join."""
    x = map_entities(with_entities(rule_parse(addresses(s, d), out="a")), out="b")
    return x.select("row_id", "a", "b")


def _runs(s: SparkSession, d: str) -> DataFrame:
    e = _table(s, d, "events")
    return e.select("event_id", "user_id", "ts", F.col("event_type").alias("configuration"), F.col("value").alias("throughput"), (F.col("event_id") % 10 != 0).alias("ok"), (F.col("event_id") * 7 % 100).cast("double").alias("utilisation"), (F.col("event_id") % 2).alias("suite"))


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


def _gauges(s: SparkSession, d: str) -> tuple[DataFrame, tuple]:
    k = F.col("o_orderkey")
    return _table(s, d, "orders").select("o_orderkey", "o_totalprice"), (F.col("o_totalprice") % 2500, (k % 101).cast("double"), (k % 100).cast("double"))


# Sources and cleaning


@query
def ingest_valid(s, d):
    return readers.valid(_checked(s, d))


@query
def ingest_rejects(s, d):
    return readers.rejects(_checked(s, d)).select("row_id", "reject_reason")


@query
def ingest_counts(s, d):
    return _checked(s, d).agg(F.count_if(F.col("reject_reason").isNull()).alias("loaded"), F.count_if(F.col("reject_reason").isNotNull()).alias("malformed"))


@query
def clean_address(s, d):
    return addresses(s, d).select("row_id", text.clean_address(F.col("addr_text")).alias("cleaned"))


@query
def clean_address_cpu(s, d):
    return addresses(s, d).select("row_id", text.clean_address(F.col("addr_text"), text.CPU_LENGTH).alias("cleaned"))


@query
def clean_documents(s, d):
    return _table(s, d, "documents").select("doc_id", text.clean_address(F.col("text")).alias("cleaned"))


@query
def with_address(s, d):
    return readers.with_address(addresses(s, d), "addr_text").select("row_id")


@query
def rule_parse_(s, d):
    return _flat(_parsed(s, d), FIELDS, "parse_success", "parse_error")


_ALL["rule_parse"] = _ALL.pop("rule_parse_")


@query
def rule_locality(s, d):
    return _parsed(s, d).groupBy(*(F.col(f"parsed.{f}").alias(f) for f in ("city", "locality", "sub_locality"))).agg(F.count(F.lit(1)).alias("n"))


@query
def normalize_names(s, d):
    return addresses(s, d).select("row_id", text.normalize_name(F.col("x_society")).alias("name"))


@query
def location_identifier(s, d):
    return _parsed(s, d).select("row_id", text.location_identifier(F.col("parsed.society_name"), F.col("parsed.pin_code")).alias("location_identifier"))


@query
def sanitize(s, d):
    dirty = F.concat(F.coalesce("text", F.lit("")), F.lit("\x01x\t\x0b\x1f"))
    return _table(s, d, "documents").select("doc_id", text.sanitize(dirty).alias("clean"))


@query
def display_truncate(s, d):
    return addresses(s, d).select("row_id", text.truncated(F.col("addr_text")).alias("shown"))


@query
def head_rows(s, d):
    return readers.head(addresses(s, d).select("row_id", "addr_text"), 100, "row_id")


@query
def random_sample(s, d):
    return readers.hashed_sample(addresses(s, d).select("row_id", "addr_text"), 100, "row_id")


@query
def part_numbers(s, d):
    return addresses(s, d).groupBy("source_file").agg(F.count(F.lit(1)).alias("n")).select("source_file", readers.part_number(F.col("source_file")).alias("part"), "n")


# Consolidation and summaries


@query
def consolidate_exact(s, d):
    return consolidate.exact_groups(rule_parse(addresses(s, d), fields=consolidate.READ)).drop("first_row")


@query
def consolidate_fuzzy(s, d):
    return consolidate.fuzzy_groups(_named(s, d)).drop("first_row")


@query
def similarity_pairs(s, d):
    return consolidate.candidate_pairs(consolidate.keyed(_named(s, d)))


@query
def group_members(s, d):
    return consolidate.group_members(consolidate.keyed(_parsed(s, d))).select("row_id", "group_id")


@query
def group_stats(s, d):
    rows = consolidate.keyed(_parsed(s, d))
    return consolidate.group_stats(consolidate.exact_groups(rows), rows)


@query
def pin_summary(s, d):
    return pins.pin_summary(_parsed(s, d))


@query
def pin_names(s, d):
    return pins.pin_names(_parsed(s, d))


@query
def pin_sketches(s, d):
    """Distinct names by code, and of all codes, from sketches stored for each source file."""
    folder = _folder(s)
    sketches.save(sketches.sketch(sketches.names(_parsed(s, d)), ["source", *sketches.KEY]), folder)
    merged = sketches.merge(sketches.load(s, folder))
    every = sketches.merge(merged.withColumn("pin_code", F.lit("ALL")))
    return _rounded(sketches.estimate(merged.unionByName(every)), "names")


@query
def pin_summary_lower(s, d):
    return pins.pin_summary(_parsed(s, d), sample=10, titles=False)


@query
def consolidation_pct(s, d):
    return pins.consolidation_by_pin(_parsed(s, d))


@query
def consolidation_levels(s, d):
    return pins.consolidation_levels(pins.pin_counts(_parsed(s, d)))


@query
def top_pins(s, d):
    return pins.top(pins.pin_counts(_parsed(s, d)), "total_addresses", 10)


@query
def locality_diversity(s, d):
    return pins.top(pins.pin_counts(_parsed(s, d)), "distinct_localities_count", 10)


@query
def society_diversity(s, d):
    return pins.top(pins.pin_counts(_parsed(s, d)), "distinct_societies_count", 10)


@query
def sample_per_pin(s, d):
    return pins.samples(_parsed(s, d))


@query
def distinct_societies(s, d):
    return pins.societies(_parsed(s, d))


@query
def keyword_buckets(s, d):
    return pins.keyword_buckets(pins.societies(_parsed(s, d)))


@query
def quality_buckets(s, d):
    return pins.quality_buckets(pins.pin_counts(_parsed(s, d)))


@query
def geo_diversity(s, d):
    return pins.diversity(_parsed(s, d))


# Routing and external parsers


@query
def complexity_score(s, d):
    return addresses(s, d).select("row_id", F.round(complexity(F.col("addr_text")), 6).alias("complexity"))


@query
def complexity_documents(s, d):
    return _table(s, d, "documents").select("doc_id", F.round(complexity(F.col("text")), 6).alias("complexity"))


@query
def route(s, d):
    return routing.routed(addresses(s, d), threshold=0.3).select("row_id", "route")


def _routed(s: SparkSession, d: str) -> DataFrame:
    """Routed records, of parsers that fail on some rows."""
    fails = lambda x, out, k: x.withColumn(out, F.col(out).withField("parse_success", F.col(f"{out}.parse_success") & (F.col("row_id") % k != 0)))
    rules = lambda x, column, out: fails(rule_parse(x, column, out), out, 7)
    entities = lambda x, column, out: fails(map_entities(x, column, out=out), out, 5)
    return routing.routed_parse(with_entities(addresses(s, d)), rules, entities, threshold=0.3)


@query
def route_usage(s, d):
    return routing.usage(_routed(s, d))


@query
def route_notes(s, d):
    return _flat(_routed(s, d), ["note"], "parse_success", "parse_error")


@query
def tune_threshold(s, d):
    return _rounded(routing.tuned_threshold(routing.routed(addresses(s, d))), "threshold")


@query
def entity_map(s, d):
    return _flat(_recognised(s, d), FIELDS, "parse_success")


@query
def entity_map_cpu(s, d):
    return _flat(map_entities(with_entities(addresses(s, d)), note="cpu", strict=False), FIELDS, "parse_success")


@query
def generic_entity_map(s, d):
    e = lambda label, c: F.struct(F.lit(label).alias("entity_group"), F.col(c).alias("word"), F.lit(0.9).alias("score"))
    return _flat(map_generic_entities(addresses(s, d).withColumn("entities", F.array(e("LOC", "x_city"), e("organization", "x_society")))))


@query
def label_inventory_(s, d):
    return label_inventory(with_entities(addresses(s, d)))


_ALL["label_inventory"] = _ALL.pop("label_inventory_")


@query
def component_map(s, d):
    return _flat(map_components(with_components(addresses(s, d))), ["unit_number", "society_name", "landmark", "road", "sub_locality", "city", "district", "state", "country", "pin_code"])


@query
def llm_json(s, d):
    return _flat(map_answers(with_answers(addresses(s, d))), ["unit_number", "society_name", "city", "pin_code"], "parse_success")


@query
def keyword_parse_(s, d):
    return _flat(keyword_parse(addresses(s, d)), ["unit_number", "society_name", "landmark", "road", "city", "pin_code", "state"])


_ALL["keyword_parse"] = _ALL.pop("keyword_parse_")


@query
def llm_cost(s, d):
    return compare.cost_report(addresses(s, d).agg(F.count(F.lit(1)).alias("n")))


# Comparison


@query
def extraction_rates_all(s, d):
    return compare.extraction_rates(_parsed(s, d), over="all")


@query
def extraction_rates_success(s, d):
    return compare.extraction_rates(_parsed(s, d), over="success")


@query
def extraction_rates_strict(s, d):
    return compare.extraction_rates(_parsed(s, d), over="strict")


@query
def agreement_by_field(s, d):
    return compare.agreement_by_field(_pairs(s, d))


@query
def agreement_by_row(s, d):
    return _rounded(compare.agreement_by_row(_pairs(s, d)).select("row_id", "agreement_score"), "agreement_score")


@query
def field_verdicts(s, d):
    return compare.field_verdicts(_pairs(s, d))


@query
def parser_metrics(s, d):
    return compare.parser_metrics(_pairs(s, d), ms_a=0.3, ms_b=800.0)


@query
def measured_parsers(s, d):
    """Both parsers' metrics beside a run that was measured: all but its times."""
    rows = with_entities(addresses(s, d))
    runs = measure.record(rows, {"a": lambda x: rule_parse(x), "b": lambda x: map_entities(x)}, f"{_folder(s)}/runs")
    x = measure.with_measured(compare.parser_metrics(_pairs(s, d)), runs)
    return x.select("parser", "success_rate", "extraction_rate", "rows", "succeeded", "bytes", ((F.col("ms") > 0) & (F.col("rate") > 0)).alias("measured"))


@query
def parser_score(s, d):
    return compare.parser_scores(parser_metrics(s, d))


@query
def best_parser(s, d):
    return compare.best_parser(parser_metrics(s, d))


@query
def row_winner(s, d):
    return compare.row_winner(_pairs(s, d)).select("row_id", "fields_a", "fields_b", "winner")


@query
def sheet_field_count(s, d):
    return _parsed(s, d).select("row_id", compare.field_count("parsed", compare.SHEET_FIELDS).alias("fields"))


@query
def target_check(s, d):
    return compare.target_check(_parsed(s, d))


@query
def complete_results(s, d):
    rows = addresses(s, d)
    x = compare.with_default(rows, rule_parse(rows.filter("row_id % 3 <> 0")))
    return x.select("row_id", "parsed.parse_success", "parsed.parse_error")


# Sinks and batches


@query
def flat_results(s, d):
    return sinks.flat_results(_parsed(s, d))


@query
def comprehensive_output(s, d):
    return sinks.comprehensive(_parsed(s, d), ["row_id"], gpu_rows=1000)


@query
def enriched_output(s, d):
    rows = consolidate.group_members(consolidate.keyed(_parsed(s, d)))
    return sinks.enriched(rows, ["addr_hash_key", "addr_text", "pincode"])


@query
def run_metadata(s, d):
    return sinks.metadata(_parsed(s, d))


@query
def unprocessed_files(s, d):
    files = addresses(s, d).select(F.col("source_file").alias("path"), F.lit("h").alias("sha256")).distinct()
    done = s.createDataFrame([("p1.csv", "h", "completed"), ("p2.csv", "h", "failed"), ("p3.csv", "other", "completed"), ("p4.csv", "h", "completed")], "path string, sha256 string, status string")
    return sinks.unprocessed(files, done).select("path")


@query
def batch_totals(s, d):
    p = _parsed(s, d)
    return _rounded(metrics.batch_totals(p.groupBy("source_file").agg(F.count(F.lit(1)).alias("rows"), F.count_if("parsed.parse_success").alias("succeeded"), (F.sum(F.length("addr_text")) / 1000.0).alias("seconds"))), "avg_rate")


@query
def error_counts(s, d):
    return metrics.error_counts(_parsed(s, d).select(F.col("parsed.parse_error").alias("error_type")).dropna())


# Run metrics


@query
def throughput_1s(s, d):
    return metrics.per_second(_table(s, d, "events"))


@query
def running_peak(s, d):
    return metrics.running(_runs(s, d), "throughput", "event_id", "user_id").select("event_id", F.round(F.col("running_mean") + 1e-9, 4).alias("running_mean"), "running_peak")


@query
def moving_100(s, d):
    return metrics.running(_runs(s, d), "throughput", "event_id", "user_id", last=100).select("event_id", F.round(F.col("running_mean") + 1e-9, 4).alias("running_mean"), "running_peak")


@query
def relative_perf(s, d):
    return _rounded(metrics.relative(metrics.benchmark_summary(_runs(s, d)), "avg_throughput").select("configuration", "relative_pct", "needs_optimization"), "relative_pct")


@query
def bench_by_config(s, d):
    return _rounded(metrics.benchmark_summary(_runs(s, d)), "avg_throughput", "throughput_std", "avg_utilisation", "success_rate")


@query
def best_config(s, d):
    return _rounded(metrics.best_configuration(metrics.benchmark_summary(_runs(s, d))), "best_throughput")


@query
def variation(s, d):
    return _rounded(metrics.variation(_runs(s, d), "throughput"), "variation")


@query
def regression(s, d):
    r = _runs(s, d)
    x = metrics.regression(metrics.benchmark_summary(r.filter("suite = 0")), metrics.benchmark_summary(r.filter("suite = 1")), threshold=0.01)
    return _rounded(x.select("configuration", "change_percent", "regression"), "change_percent")


@query
def perf_score(s, d):
    o, (rate, use, eff) = _gauges(s, d)
    return o.select("o_orderkey", *(F.round(c, 6).alias(n) for n, c in (("report", metrics.report_score(rate, use, eff)), ("validation", metrics.validation_score(rate, use)), ("batch", metrics.batch_score(rate, use, eff)), ("file", metrics.file_efficiency(rate, use, eff)))))


@query
def tier(s, d):
    o, (rate, _, _) = _gauges(s, d)
    return o.select("o_orderkey", metrics.tier(rate).alias("tier"))


@query
def config_name(s, d):
    k = F.col("o_orderkey")
    return _table(s, d, "orders").select("o_orderkey", metrics.config_name(k % 700, k % 8 / 100.0, k % 2 == 0, k % 3 == 0).alias("name"))


@query
def bottleneck(s, d):
    k = F.col("o_orderkey")
    return _table(s, d, "orders").select("o_orderkey", metrics.bottleneck(k % 4, k % 3, k % 11, F.lit(10)).alias("bottleneck"))


@query
def backoff_schedule(s, d):
    return metrics.backoff_schedule(s)


@query
def workload_split(s, d):
    k = F.col("o_orderkey")
    gpu, cpu = metrics.workload_split(k % 2000 + 1, F.lit(0.03), k % 100 / 100.0)
    return _table(s, d, "orders").select("o_orderkey", gpu.alias("gpu"), cpu.alias("cpu"))


@query
def recommendations(s, d):
    o, (rate, use, eff) = _gauges(s, d)
    return o.select("o_orderkey", F.array_join(metrics.recommendations(rate, use, eff), "; ").alias("advice"))


@query
def rank_suites(s, d):
    return metrics.ranked_suites(metrics.benchmark_summary(_runs(s, d))).select("configuration", "place", F.round("gap", 6).alias("gap"), "notable")


@query
def recovery_rate(s, d):
    return metrics.recovery_rate(_parsed(s, d).select((~F.col("parsed.parse_success")).alias("error"), (F.col("row_id") % 2 == 0).alias("recovered")).filter("error"))


# Reports


@query
def first_errors(s, d):
    return sinks.first_errors(_parsed(s, d), 5)


@query
def sheet_details(s, d):
    return sinks.sheets(_parsed(s, d))["details"]


@query
def sheet_summary(s, d):
    return sinks.sheets(_parsed(s, d))["summary"]


@query
def sheet_quality(s, d):
    return sinks.sheets(_parsed(s, d))["quality"]


@query
def sheet_failed(s, d):
    return sinks.sheets(_parsed(s, d))["failed"]


@query
def prompts(s, d):
    return addresses(s, d).select("row_id", prompt(F.col("addr_text")).alias("prompt"))


@query
def report_json(s, d):
    return sinks.metadata(_parsed(s, d)).select(F.to_json(F.struct("total_rows", "successful", "failed")).alias("report"))


@query
def pins_by_size(s, d):
    return sinks.placed(pins.pin_counts(_parsed(s, d)), F.col("total_addresses").desc(), F.col("pin_code")).select("place", "pin_code", "total_addresses")


@query
def first_societies(s, d):
    return sinks.first_names(pins.societies(_parsed(s, d)), 20)


@query
def hybrid_output(s, d):
    return sinks.hybrid(_parsed(s, d), 1.5)


@query
def comprehensive_full(s, d):
    return sinks.comprehensive_full(_parsed(s, d), ["row_id"], sinks.Run(at="2024-01-01T00:00:00", seconds=2.5, gpu_rows=1000, device="none", rate=400.0, utilisation=10.0, efficiency=50.0))


def _file_reports(s: SparkSession, d: str) -> DataFrame:
    seconds = s.createDataFrame([(f"p{k}.csv", k * 0.25) for k in range(1, 7)], "source_file string, seconds double")
    return sinks.file_reports(_parsed(s, d), seconds)


@query
def file_report(s, d):
    return _file_reports(s, d)


@query
def batch_report(s, d):
    r = sinks.batch_report(_file_reports(s, d), utilisation=95.0, efficiency=70.0)
    return r.select("files", "rows", "succeeded", "mean_rate", "peak_rate", "variation", "score", "rate_target_met", "utilisation_target_met", F.array_join("advice", "; ").alias("advice"), F.size("details").alias("details"))


@query
def csv_ingest(s, d):
    """The relation as files of two layouts, read back by their own headers."""
    folder = _folder(s)
    columns = ["row_id", "addr_text", "pincode", "city_id", "source_file"]
    rows = addresses(s, d).select(*columns[:-1], F.col("source_file").alias("file_name"))
    half = F.col("row_id") % 2 == 0
    rows.filter(half).write.options(**sinks.CSV).csv(f"{folder}/a")
    rows.filter(~half).select("city_id", "row_id", "file_name", "addr_text", "pincode").write.options(**sinks.CSV).csv(f"{folder}/b")
    back = readers.read_addresses(s, [f"{folder}/a/*.csv", f"{folder}/b/*.csv"], multi_line=False)
    return back.select(F.col("row_id").cast("long").alias("row_id"), *(F.coalesce(c, F.lit("")).alias(c) for c in ("addr_text", "pincode", "city_id", "file_name")))


@query
def csv_line_breaks(s, d):
    """The same with line breaks and quotes in the addresses, read as records over splits."""
    folder = _folder(s)
    broken = F.when(F.col("row_id") % 3 == 0, F.replace("addr_text", F.lit(", "), F.lit(",\n"))).when(F.col("row_id") % 3 == 1, F.concat(F.lit('"'), "addr_text", F.lit('"\n'))).otherwise(F.col("addr_text"))
    addresses(s, d).select("row_id", broken.alias("addr_text"), "pincode", "city_id").coalesce(2).write.options(**sinks.CSV).csv(f"{folder}/a")
    back = readers.read_addresses(s, f"{folder}/a/*.csv", split_bytes=0)
    return back.select(F.col("row_id").cast("long").alias("row_id"), *(F.coalesce(c, F.lit("")).alias(c) for c in ("addr_text", "pincode", "city_id")))


#: Rows of a file of `batch_journal`, about.
FILE_ROWS = 500_000


@query
def batch_journal(s, d):
    """Files of like names in two folders, run twice: what the journal holds of each name and folder, and how often a file was processed."""
    folder = _folder(s)
    slices = -(-_table(s, d, "orders").count() // (14 * FILE_ROWS))  # 14 names and folders, of more files as the table grows
    rows = addresses(s, d).select("addr_hash_key", "addr_text", "city_id", "pincode", F.when(F.col("row_id") % 2 == 0, F.lit("north")).otherwise(F.lit("south")).alias("region"), F.col("source_file").alias("name"))
    task = (readers.part_number("name") - 1) * 2 + (F.col("region") == "south").cast("int")
    rows.repartitionById(14 * slices, (task * slices + F.pmod(F.xxhash64("addr_hash_key"), F.lit(slices))).cast("int")).write.partitionBy("region", "name").options(**sinks.CSV).csv(f"{folder}/in")
    c = build({"batch_input": [f"{folder}/in/**/*.csv"], "batch_output": f"{folder}/out"})
    run_batch(s, c)
    run_batch(s, c)
    entries = journal.entries(s, f"{folder}/out/_journal")
    times = entries.groupBy("path").agg(F.count(F.lit(1)).alias("times"))
    part = lambda c: F.regexp_extract("path", f"{c}=([^/]*)", 1).alias(c)
    return journal.current(entries).join(times, "path").groupBy(part("region"), part("name"), "status").agg(F.sum("rows").alias("rows"), F.max("times").alias("times"))


@query
def file_digest(s, d):
    folder = _folder(s)
    _table(s, d, "region").orderBy("r_regionkey").coalesce(1).select("r_name").write.text(f"{folder}/p5")
    return readers.fingerprints(s, readers.discover(s, [f"{folder}/**/part-*.txt"])).select("size", "sha256")


@query
def file_digests(s, d):
    """Customers' names as a text file for each nation: what the data source reads of them."""
    folder = _folder(s)
    _table(s, d, "customer").repartition("c_nationkey").sortWithinPartitions("c_nationkey", "c_custkey").select("c_name", "c_nationkey").write.partitionBy("c_nationkey").text(folder)
    found = readers.fingerprints(s, readers.discover(s, [f"{folder}/**/part-*.txt"]))
    return found.select(F.regexp_extract("path", r"c_nationkey=(\d+)", 1).cast("int").alias("c_nationkey"), "size", "sha256", F.col("error").isNull().alias("readable"))


@query
def discovered_files(s, d):
    """Files by patterns and by numbers, by their names: p1 and p10 in the folder, p5 below it."""
    folder = _folder(s)
    one = s.createDataFrame([("x",)], "value string").coalesce(1)
    for name in ("p1.csv", "p10.csv", "deep/p5.csv"):
        one.write.text(f"{folder}/made/{name}-folder")
        fs, made = readers._file_system(s, f"{folder}/{name}")
        fs.mkdirs(made.getParent())
        fs.rename(readers._file_system(s, readers.discover(s, [f"{folder}/made/{name}-folder/part-*"])[0])[1], made)
    found = {"flat": readers.discover(s, [f"{folder}/*.csv"]), "deep": readers.discover(s, [f"{folder}/**/*.csv", f"{folder}/p1.csv"]), "numbered": readers.numbered(s, folder, 1, 9)}
    rows = [(how, k, f.rsplit("/", 1)[1]) for how, files in found.items() for k, f in enumerate(files)]
    return s.createDataFrame(rows, "how string, place int, name string")


@query
def address_columns(s, d):
    """The column that each strategy takes for the addresses of three tables."""
    tables = {"customer": _table(s, d, "customer"), "documents": _table(s, d, "documents"), "addresses": addresses(s, d)}
    rows = [(t, how, readers.address_column(df, how)) for t, df in tables.items() for how in ("sample", "compare", "report")]
    return s.createDataFrame(rows, "table string, strategy string, column string")


@query
def state_round_trip(s, d):
    """A state that is saved twice: what is loaded is the second, whole."""
    path = f"{_folder(s)}/state"
    journal.save_state(_table(s, d, "nation").select("n_nationkey"), path)
    journal.save_state(_table(s, d, "region").select("r_regionkey", "r_name"), path)
    return journal.load_state(s, path, "r_regionkey int, r_name string")


@query
def skip_files(s, d):
    files = addresses(s, d).select(F.col("source_file").alias("path"), F.lit(100).cast("long").alias("modified")).distinct()
    manifest = s.createDataFrame([("p1.csv", "out/a", "completed"), ("p2.csv", "out/gone", "completed"), ("p3.csv", "out/c", "failed")], "path string, output string, status string")
    outputs = s.createDataFrame([("out/a", 1), ("out/c", 1), ("out/p4_processed_20240101_000000", 200), ("out/p5_processed_20240101_000000", 100), ("out/p6_other_x", 300)], "path string, modified long")
    return sinks.to_process(files, manifest, outputs).select("path")


@query
def processed_parts(s, d):
    k = F.col("o_orderkey")
    name = F.concat(F.lit("out/"), F.when(k % 4 == 0, F.concat(F.lit("export_p"), k % 50, F.lit("_gpu_1.csv"))).when(k % 4 == 1, F.concat(F.lit("p"), k % 50, F.lit("_x_results_1.csv"))).when(k % 4 == 2, F.concat(F.lit("p"), k % 50, F.lit(".csv"))).otherwise(F.concat(F.lit("export_p"), k % 50, F.lit("_1.csv"))))
    return _table(s, d, "orders").select("o_orderkey", readers.processed_part(name).alias("part"))


@query
def run_times(s, d):
    """Stamps as outputs carry them, and seconds between a user's first and last event."""
    e = _table(s, d, "events")
    g = e.groupBy("user_id").agg(F.min("ts").alias("first"), F.max("ts").alias("last"))
    seconds = F.unix_timestamp(F.date_trunc("second", "last")) - F.unix_timestamp(F.date_trunc("second", "first"))
    return g.select("user_id", F.date_format("first", "yyyyMMdd_HHmmss").alias("stamp"), seconds.alias("seconds"))


# Parsers of one's own, answers and their cost


class _CommaModel:
    """A stand-in for a user's model: the last two parts of an address."""

    def parse_batch(self, texts: list[str]) -> list[dict]:
        if any("Wakad" in t for t in texts) and len(texts) > 1:
            raise ValueError("one text at a time")
        parts = [[p.strip(" ") for p in t.strip().split(",")] for t in texts]
        if any(len(p) < 2 for p in parts):
            raise ValueError("no parts")
        return [{"locality": p[-2], "city": p[-1], "country": "India"} for p in parts]


@query
def external_parser(s, d):
    rows = addresses(s, d).select("row_id", "addr_text").filter("row_id % 101 <> 0")
    return _flat(external(_CommaModel, batch_size=50, attempts=2, waits=[0.0])(rows, "addr_text", "parsed"), ["locality", "city", "country"], "parse_success", "parse_error")


@query
def llm_json_long(s, d):
    full = F.to_json(F.struct(F.col("x_unit").alias("unit_number"), F.col("x_society").alias("society_name"), F.col("x_city").alias("city"), F.when(F.col("row_id") % 2 == 0, F.lit("Bharat")).alias("country")))
    answers = addresses(s, d).withColumn("answer", F.when(F.col("row_id") % 5 == 2, F.lit("[]")).otherwise(full))
    return _flat(map_answers(answers, long_keys=True), ["unit_number", "society_name", "city", "country"], "parse_success")


@query
def llm_token_cost(s, d):
    """Cost of the answers of each file, by tokens of prompt and answer (four letters each, as a stand-in for a model's count)."""
    x = with_answers(addresses(s, d)).select("source_file", F.ceil(F.length(prompt(F.col("addr_text"))) / 4).alias("asked"), F.ceil(F.length("answer") / 4).alias("answered"))
    cost = answer_cost(F.col("asked"), F.col("answered"))
    return x.groupBy("source_file").agg(F.sum(F.col("asked") + F.col("answered")).alias("tokens"), F.round(F.sum(cost), 6).alias("cost"), F.round(F.avg(cost), 6).alias("cost_per_address"))


@query
def entity_lookup(s, d):
    """Entities as a map, the last of a label."""
    own = F.transform("entities", lambda e: F.struct(F.lower(e["entity_group"]).alias("k"), e["word"].alias("v")))
    m = F.map_from_entries(own)
    return with_entities(addresses(s, d)).select("row_id", m["street"].alias("street"), m["state"].alias("state"), F.size(F.map_keys(m)).alias("labels"))


# Machines and advice


def _machine(s: SparkSession, d: str) -> tuple[DataFrame, list]:
    k = F.col("o_orderkey")
    return _table(s, d, "orders").select("o_orderkey"), [k % 4, k % 13 * 1000, k % 3 != 0, k % 33, k % 40]


@query
def fixed_splits(s, d):
    k = F.col("o_orderkey")
    parts = [F.struct(F.lit(n).alias("split"), F.array_join(devices.fixed_split(k % 2000 + 1, shares).cast("array<string>"), ",").alias("rows")) for n, shares in devices.SPLITS.items()]
    parts.append(F.struct(F.lit("even").alias("split"), F.array_join(devices.even_split(k % 2000 + 1, 7).cast("array<string>"), ",").alias("rows")))
    return _table(s, d, "orders").select("o_orderkey", F.inline(F.array(*parts)))


@query
def device_conflict(s, d):
    k = F.col("o_orderkey")
    return _table(s, d, "orders").select("o_orderkey", devices.conflict(k % 2 == 0, k % 4, k % 3 == 0, k % 5, F.lit(4)).alias("conflict"))


@query
def hardware_estimate(s, d):
    rows, (gpus, mb, usable, cores, memory) = _machine(s, d)
    own = devices.settings(gpus, mb, cores, memory, F.floor(mb / F.greatest(gpus, F.lit(1))))
    return rows.select("o_orderkey", devices.capacity(gpus, mb, usable, cores, memory).alias("rate"), *(c.alias(n) for n, c in own.items()))


@query
def hardware_tuning(s, d):
    rows, (_, mb, _, cores, _) = _machine(s, d)
    return rows.select("o_orderkey", *(c.alias(n) for n, c in devices.tuning(mb / 600, cores, F.col("o_orderkey") % 3000).items()))


@query
def progress_eta(s, d):
    k = F.col("o_orderkey")
    own = devices.progress(k % 1000, F.lit(1000), (k % 60).cast("double"))
    return _table(s, d, "orders").select("o_orderkey", *(F.round(c, 6).alias(n) for n, c in own.items()))


@query
def time_estimate(s, d):
    k = F.col("o_orderkey")
    return _table(s, d, "orders").select("o_orderkey", *(c.alias(n) for n, c in devices.time_estimate(k, F.lit(0.75)).items()))


@query
def advice_run(s, d):
    k = F.col("o_orderkey")
    o, (rate, use, _) = _gauges(s, d)
    where = F.when(k % 3 == 0, F.lit("data_feeding")).when(k % 3 == 1, F.lit("result_collection")).otherwise(F.lit(""))
    return o.select("o_orderkey", F.array_join(advice.about_run(rate, use, where, (k % 100).cast("double"), (k % 97).cast("double")), "; ").alias("advice"))


@query
def advice_benchmarks(s, d):
    return advice.about_benchmarks(metrics.benchmark_summary(_runs(s, d)))


@query
def advice_suite(s, d):
    return advice.about_suite(metrics.benchmark_summary(_runs(s, d)), memory_limited=True).select(F.array_join("advice", "; ").alias("advice"))


@query
def advice_batch(s, d):
    o, (rate, use, eff) = _gauges(s, d)
    return o.select("o_orderkey", F.array_join(advice.about_batch(rate, use, eff, F.col("o_orderkey") % 10 / 20.0), "; ").alias("advice"))


# Streams: the same operators over a file source, to the end of what is there


def _folder(s: SparkSession) -> str:
    base = s.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not s.sparkContext.master.startswith("local[") and s.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir has to name a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="addrloom-")
    return f"{base.rstrip('/')}/stream-{uuid.uuid4().hex}"


@query
def stream_rule_parse(s, d):
    folder = _folder(s)
    half = max(2, -(-_table(s, d, "orders").count() // (2 * readers.TASK_ROWS)))  # two batches, of more files as the table grows: a file is a task's rows
    addresses(s, d).select("row_id", "addr_text").repartition(2 * half).write.parquet(f"{folder}/in")
    x = s.read.parquet(f"{folder}/in")
    stream = incremental.parsed_stream(incremental.address_stream(s, f"{folder}/in", x.schema, half, "parquet"))
    incremental.run_to_parquet(_flat(stream, FIELDS, "parse_success"), f"{folder}/out", f"{folder}/checkpoint")
    return s.read.parquet(f"{folder}/out")


@query
def stream_throughput(s, d):
    folder = _folder(s)
    schema = _table(s, d, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    schema.repartition(3).write.parquet(f"{folder}/in")
    end = s.createDataFrame([(None, "2100-01-01 00:00:00")], "event_id long, at string").select("event_id", F.col("at").cast("timestamp").alias("ts"))
    first = incremental.throughput(incremental.address_stream(s, f"{folder}/in", schema.schema, 100, "parquet"))
    incremental.run_to_parquet(first, f"{folder}/out", f"{folder}/checkpoint")
    end.write.mode("append").parquet(f"{folder}/in")  # moves the watermark past all events, so the last windows close
    incremental.run_to_parquet(incremental.throughput(incremental.address_stream(s, f"{folder}/in", schema.schema, 100, "parquet")), f"{folder}/out", f"{folder}/checkpoint")
    return s.read.parquet(f"{folder}/out").select(F.col("at").cast("timestamp_ntz").alias("at"), "n")


@query
def stream_consolidation(s, d):
    """Names and codes as a stream of a few files, consolidated with leaders as state: each name's leader, its rows, and its leader's, after all batches."""
    folder = _folder(s)
    rows = consolidate.keyed(_recognised(s, d)).select("row_id", "pin_key", "name_key")
    rows.write.parquet(f"{folder}/rows")  # as they are: ranges would have to be sampled, which parses all rows once more
    rows = s.read.parquet(f"{folder}/rows").filter("name_key is not null")
    for third in range(3):  # one after the other, as the stream takes files in the order of their times
        rows.filter(F.col("row_id").between(*_thirds(rows)[third])).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    stream = incremental.consolidated_stream(incremental.address_stream(s, f"{folder}/in", rows.schema, 1, "parquet"))
    incremental.run_to_parquet(stream, f"{folder}/out", f"{folder}/checkpoint")
    out = s.read.parquet(f"{folder}/out")
    return out.groupBy("pin_key", "name_key", "leader").agg(F.sum("rows").alias("rows")).join(out.groupBy("pin_key", "leader").agg(F.max("leader_rows").alias("leader_rows")), ["pin_key", "leader"])


def _thirds(rows: DataFrame) -> list[tuple[int, int]]:
    low, high = rows.agg(F.min("row_id"), F.max("row_id")).first()
    cuts = [low + (high - low) * k // 3 for k in range(1, 3)]
    return [(low, cuts[0]), (cuts[0] + 1, cuts[1]), (cuts[1] + 1, high)]


def queries() -> dict[str, Query]:
    return dict(_ALL)


