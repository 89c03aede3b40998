"""Parsers by name, and the adapter for a model of one's own.

A parser is a function of rows, the column to read and the column to write; it adds the parsed
record. `external` makes one of any Python object with parse_batch (list of texts to list of
records) or parse_address (text to record): its batches run in Python workers, a failing call is
tried again, and what still fails becomes a failed record, so one text never fails a task.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from typing import Any, Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.entities import map_components, map_entities, map_generic_entities
from ..functions.llm_json import keyword_parse, map_answers
from ..functions.rules import EMPTY_ERROR, rule_parse
from ..operators import routing
from ..schema import FIELDS, PARSED
from ..workers import ship_package

Parser = Callable[[DataFrame, str, str], DataFrame]


class Model(Protocol):
    """What `external` takes; parse_address is used where there is no parse_batch. A record is a mapping of field names."""

    def parse_address(self, text: str) -> dict[str, Any]: ...


# Attempts, and seconds before each further one, by kind of parser.
RETRIES = {"api": (3, [1.0, 2.0]), "recogniser": (3, [0.1, 0.1]), "language_model": (3, [0.5, 1.0])}


def attempt(call: Callable[[], Any], attempts: int, waits: list[float], sleep: Callable[[float], None] = time.sleep) -> Any:
    """The result of the first attempt that succeeds; the last one's error if none does."""
    for k in range(attempts):
        try:
            return call()
        except Exception:
            if k == attempts - 1:
                raise
            sleep(waits[min(k, len(waits) - 1)] if waits else 0.0)


def _record(values: dict[str, Any] | None, error: str | None = None) -> dict[str, Any]:
    if values is None:
        return {**dict.fromkeys(FIELDS, ""), "parse_success": False, "parse_error": error}
    own = {f: str(values.get(f) or "") for f in FIELDS}
    return {**{f: v if v.strip() else "" for f, v in own.items()}, "parse_success": bool(values.get("parse_success", True)), "parse_error": values.get("parse_error")}


def records(model: Any, texts: list[str | None], attempts: int = 3, waits: list[float] | None = None, sleep: Callable[[float], None] = time.sleep) -> list[dict[str, Any]]:
    """A record for each text. Null and blank ones fail without a call; a batch that fails, or gives the wrong number of records, is tried text by text."""
    waits = RETRIES["recogniser"][1] if waits is None else waits
    out: list[dict[str, Any]] = [_record(None, EMPTY_ERROR) for _ in texts]
    asked = [k for k, t in enumerate(texts) if t and t.strip()]
    if asked and hasattr(model, "parse_batch"):
        try:
            got = attempt(lambda: list(model.parse_batch([texts[k] for k in asked])), attempts, waits, sleep)
            if len(got) == len(asked):
                for k, r in zip(asked, got, strict=True):
                    out[k] = _record(r)
                return out
        except Exception:
            pass  # one of the texts, perhaps
    for k in asked:
        try:
            one = model.parse_address if hasattr(model, "parse_address") else lambda t: model.parse_batch([t])[0]
            out[k] = _record(attempt(lambda: one(texts[k]), attempts, waits, sleep))  # noqa: B023
        except Exception as e:
            out[k] = _record(None, f"parsing failed after {attempts} attempts: {e}")
    return out


def external(make: Callable[[], Any], batch_size: int = 400, attempts: int = 3, waits: list[float] | None = None) -> Parser:
    """A parser of the model that make() gives, which is made once per Python task. Texts go to it batch_size at a time; other columns never leave their rows."""

    def parse(df: DataFrame, column: str = "addr_text", out: str = "parsed") -> DataFrame:
        ship_package(df.sparkSession)
        schema = T.StructType([*df.schema.fields, T.StructField(out, PARSED)])

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            model = make()
            for pdf in batches:
                for k in range(0, len(pdf), batch_size):
                    part = pdf.iloc[k : k + batch_size].copy()
                    texts = [t if isinstance(t, str) else None for t in part[column]]
                    part[out] = [{f.name: r[f.name] for f in PARSED} for r in records(model, texts, attempts, waits)]
                    yield part

        return df.mapInPandas(run, schema)

    return parse


def parser(name: str, threshold: float = routing.THRESHOLD) -> Parser:
    """The parser of a configuration's parser_type. entities, components and answers read the column of that name beside the text."""
    own: dict[str, Parser] = {
        "rules": rule_parse,
        "entities": lambda df, column, out: map_entities(df, column, out=out),
        "generic_entities": lambda df, column, out: map_generic_entities(df, column, out=out),
        "components": lambda df, column, out: map_components(df, column, out=out),
        "answers": lambda df, column, out: map_answers(df, column, out=out),
        "keywords": lambda df, column, out: keyword_parse(df, column, out=out),
    }
    own["routed"] = lambda df, column, out: routing.routed_parse(df, own["rules"], own["entities"], column, out, threshold).drop("complexity", "route", "used", "fell_back")
    if name not in own:
        raise ValueError(f"no such parser: {name}")
    return own[name]


#: Columns that a parser reads beside the text, and their types as JSON in a file's column of that name.
BESIDE = {"entities": "array<struct<entity_group:string,word:string,score:double>>", "components": "array<struct<value:string,label:string>>", "answers": "string"}


def with_inputs(df: DataFrame, name: str) -> DataFrame:
    """Adds what the named parser reads beside the text, from a JSON column of that name (answer: text); where a file has none, the parser gets nothing."""
    needs = {"entities": "entities", "generic_entities": "entities", "routed": "entities", "components": "components", "answers": "answer"}.get(name)
    if needs is None:
        return df
    kind = BESIDE["answers" if needs == "answer" else needs]
    if needs not in df.columns:
        return df.withColumn(needs, F.lit(None).cast(kind))
    return df if kind == "string" or dict(df.dtypes)[needs] != "string" else df.withColumn(needs, F.from_json(F.col(needs), kind))
