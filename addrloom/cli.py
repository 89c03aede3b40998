"""Command line: python -m addrloom.cli [consolidate|batch|benchmark|regression|configure] ...

Exit codes: 0 done; 1 a configuration that can't be used, files that failed, or a regression; 2 a
file that isn't there; 3 no permission; 4 bad input; 5 anything else; 130 interrupted.
"""

from __future__ import annotations

import argparse
import json
import os
import sys
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from . import config
from .operators import advice, metrics
from .plans.batch import parsed_file, run_batch
from .plans.pipeline import consolidate_files


def _spark() -> SparkSession:
    return SparkSession.builder.appName("addrloom").getOrCreate()


def _options(p: argparse.ArgumentParser, *names: str) -> argparse.ArgumentParser:
    kinds = {"threshold": float, "complexity": float, "batch_size": int}
    p.add_argument("--config")
    p.add_argument("--parser", choices=config.PARSERS)
    for n in names:
        p.add_argument(f"--{n.replace('_', '-')}", type=kinds.get(n, str))
    return p


def _configuration(a: argparse.Namespace, **more: object) -> config.Config:
    own = {"parser_type": a.parser, "fuzzy_threshold": getattr(a, "threshold", None), "complexity_threshold": getattr(a, "complexity", None), "batch_size": getattr(a, "batch_size", None), **more}
    own = {k: v for k, v in own.items() if v is not None}
    return config.load(a.config, own) if a.config else config.build(own)


def consolidate(a: argparse.Namespace) -> int:
    c = _configuration(a, input_path=a.input, output_path=a.output, report_path=a.report, fuzzy=a.fuzzy or None)
    print(consolidate_files(_spark(), c))
    return 0


def batch(a: argparse.Namespace) -> int:
    c = _configuration(a, batch_input=a.input or None, batch_output=a.output)
    report = run_batch(_spark(), c, skip=not a.again)
    print(json.dumps({k: v for k, v in report.items() if k != "details"}, default=str))
    return 1 if report["failed"] else 0


def benchmark(a: argparse.Namespace) -> int:
    """Parses a file a few times and writes a row per run: configuration, throughput, ok."""
    spark = _spark()
    c = _configuration(a, input_path=a.input, output_path=a.output)
    rows = []
    for _ in range(a.runs):
        began = time.time()
        done = parsed_file(spark, c.input_path, c).agg(F.count(F.lit(1)).alias("n"), F.count_if("parsed.parse_success").alias("ok")).first()
        seconds = max(time.time() - began, 1e-9)
        rows.append((c.parser_type, done["n"] / seconds, done["n"] > 0, 100.0, seconds))
    runs = spark.createDataFrame(rows, "configuration string, throughput double, ok boolean, utilisation double, seconds double")
    runs.coalesce(1).write.mode("overwrite").json(c.output_path)
    summary = metrics.benchmark_summary(runs)
    print(json.dumps([r.asDict() for r in summary.collect()]))
    print(json.dumps(advice.about_suite(summary).first()["advice"]))
    return 0 if not summary.isEmpty() else 1


def regression(a: argparse.Namespace) -> int:
    spark = _spark()
    schema = "configuration string, throughput double, ok boolean, utilisation double"
    before, after = (metrics.benchmark_summary(spark.read.schema(schema).json(p)) for p in (a.baseline, a.current))
    rows = metrics.regression(before, after, threshold=a.threshold).collect()
    print(json.dumps([r.asDict() for r in rows]))
    return 1 if any(r["regression"] for r in rows) else 0


def configure(a: argparse.Namespace) -> int:
    """Takes an older configuration over, or checks one."""
    if a.migrate:
        values, left = config.migrated(config.read(a.migrate), dict(os.environ))
        config.write(values, a.output)
        print(json.dumps({"written": a.output, "left": left}))
        return 0
    c = config.load(a.check)
    print(json.dumps({"ok": True, "warnings": c.warnings()}))
    return 0


def arguments() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="addrloom", description="Parses and consolidates postal addresses.")
    sub = p.add_subparsers(dest="command", required=True)
    x = _options(sub.add_parser("consolidate", help="one input to one output"), "input", "output", "report", "threshold", "complexity")
    x.add_argument("--fuzzy", action="store_true")
    x.set_defaults(run=consolidate)
    x = _options(sub.add_parser("batch", help="all files of some patterns"), "output", "complexity", "batch_size")
    x.add_argument("--input", nargs="+")
    x.add_argument("--again", action="store_true", help="also what is done already")
    x.set_defaults(run=batch)
    x = _options(sub.add_parser("benchmark", help="times a parser"), "input", "output", "complexity")
    x.add_argument("--runs", type=int, default=3)
    x.set_defaults(run=benchmark)
    x = sub.add_parser("regression", help="compares two benchmarks")
    x.add_argument("--baseline", required=True)
    x.add_argument("--current", required=True)
    x.add_argument("--threshold", type=float, default=0.1)
    x.set_defaults(run=regression)
    x = sub.add_parser("configure", help="checks a configuration, or takes an older one over")
    x.add_argument("--check")
    x.add_argument("--migrate")
    x.add_argument("--output")
    x.set_defaults(run=configure)
    return p


def main(args: list[str] | None = None) -> int:
    args = sys.argv[1:] if args is None else args
    if args and args[0].startswith("--") and args[0] not in ("--help",):
        args = ["consolidate", *args]
    a = arguments().parse_args(args)
    if a.command == "configure" and not (a.check or a.migrate and a.output):
        print("configure needs --check, or --migrate and --output", file=sys.stderr)
        return 1
    codes = ((KeyboardInterrupt, 130), (config.ConfigurationError, 1), (FileNotFoundError, 2), (PermissionError, 3), (ValueError, 4), (Exception, 5))
    try:
        return a.run(a)
    except BaseException as e:
        code = next((n for kind, n in codes if isinstance(e, kind)), None)
        if code is None:
            raise
        print(f"{type(e).__name__}: {e}", file=sys.stderr)
        return code


if __name__ == "__main__":
    sys.exit(main())
