"""Records from language-model answers, prompts for them, and a keyword parser that stands in for one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import COMPARED, FIELDS, SHORT, failed, parsed_struct
from .rules import EMPTY_ERROR, pin_code
from .text import is_blank, strip

LONG_NOTE = "Parsed using language model"
# Fixed values of the keyword parser.
MOCK_UNIT = [r"flat\s*(\w+)", r"apartment\s*(\w+)", r"(\w+)-(\w+)", r"^(\w+),"]
MOCK_SOCIETY = ["residency", "towers", "complex", "society", "apartments", "enclave"]
MOCK_ROAD = ["road", "street", "lane", "marg", "highway"]
MOCK_CITIES = ["pune", "mumbai", "bangalore", "delhi", "hyderabad", "chennai"]
MOCK_STATES = ["maharashtra", "karnataka"]
#: Dollars for a thousand prompt and completion tokens.
PROMPT_PRICE, COMPLETION_PRICE = 0.01, 0.03


def unfenced(c: Column) -> Column:
    """An answer without the code fence that may surround its JSON."""
    x = strip(c)
    x = F.regexp_replace(x, "^```json", "")
    x = F.regexp_replace(x, "^```", "")
    return strip(F.regexp_replace(x, "```$", ""))


def map_answers(df: DataFrame, column: str = "addr_text", answer: str = "answer", out: str = "parsed", long_keys: bool = False) -> DataFrame:
    """Adds the record in a JSON answer with short keys (or the long names). What isn't a JSON object fails; missing keys are empty."""
    keys = {f: f if long_keys else SHORT[f] for f in FIELDS}
    schema = ", ".join(f"`{k}` string" for k in keys.values())
    text = unfenced(F.col(answer))
    j = F.from_json(text, schema, {"mode": "PERMISSIVE"})
    valid = text.startswith("{") & F.try_parse_json(text).isNotNull()
    v = {f: F.coalesce(j[k], F.lit("")) for f, k in keys.items()}
    if long_keys:
        v |= {"note": F.lit(LONG_NOTE), "country": F.coalesce(j["country"], F.lit("India"))}
    raw = F.col(column)
    return df.withColumn(out, F.when(is_blank(raw), failed(F.lit(EMPTY_ERROR))).when(F.coalesce(valid, F.lit(False)), parsed_struct(v, F.lit(True), F.lit(None))).otherwise(failed(F.lit("Invalid JSON in answer"))))


def prompt(c: Column) -> Column:
    """A request for the eleven fields as JSON."""
    ask = "Split this Indian postal address into its parts. Answer with one JSON object with the keys " + ", ".join(COMPARED) + "; use an empty string for a part that is missing.\nAddress: "
    return F.concat(F.lit(ask), F.to_json(F.struct(c.alias("address"))))


def keyword_parse(df: DataFrame, column: str = "addr_text", out: str = "parsed") -> DataFrame:
    """The offline stand-in for a language model: keywords, at most two words before a society's, three before a road's."""
    a = F.col(column)
    low = F.lower(a)
    words = F.filter(F.split(a, r"\s+"), lambda w: w != "")

    def around(keywords: list[str], before: int, from_first: bool) -> Column:
        hit = F.array_position(F.transform(words, lambda w: F.lower(w).rlike("|".join(keywords))), True)
        begin = F.greatest(hit - before, F.lit(1))
        ok = hit >= (1 if from_first else 2)
        return F.when(ok, F.array_join(F.slice(words, begin.cast("int"), (hit - begin + 1).cast("int")), " ")).otherwise(F.lit(""))

    near, opposite = F.instr(low, "near"), F.instr(low, "opposite")
    at = F.greatest(near, opposite)
    city = F.coalesce(*(F.when(low.contains(c), F.lit(c.title())) for c in MOCK_CITIES), F.lit(""))
    v = {
        "unit_number": F.coalesce(*(F.when(F.regexp_like(low, F.lit(p)), F.regexp_extract(low, p, 1)) for p in MOCK_UNIT), F.lit("")),
        "society_name": around(MOCK_SOCIETY, 2, False),
        "landmark": F.when(at > 0, F.get(F.split(F.substring(a, at, F.lit(50)), ",", -1), F.lit(0))).otherwise(F.lit("")),
        "road": F.coalesce(*(F.when(low.contains(k), around([k], 3, True)) for k in MOCK_ROAD), F.lit("")),
        "city": city, "district": city, "country": F.lit("India"), "pin_code": pin_code(a),
        "state": F.coalesce(*(F.when(low.contains(s), F.lit(s.title())) for s in MOCK_STATES), F.lit("")), "note": F.lit(LONG_NOTE),
    }
    return df.withColumn(out, F.when(is_blank(a), failed(F.lit(EMPTY_ERROR))).otherwise(parsed_struct(v, F.lit(True), F.lit(None))))


def answer_cost(prompt_tokens: Column, completion_tokens: Column) -> Column:
    return prompt_tokens / 1000 * PROMPT_PRICE + completion_tokens / 1000 * COMPLETION_PRICE
