"""Rule parser: twelve fields by regular expressions and lists. Native expressions, no Python worker."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import FIELDS, parsed_record
from .text import compiled, is_blank, none_if_empty, squeeze, strip

# Patterns and lists in the order in which they are tried.
PIN = r"\b(\d{6})\b"
UNIT_WORDS = "(?:Flat|flat|FLAT|Apartment|apartment|APT|apt|Unit|unit|Office|office|Shop|shop|Villa|villa|Bungalow|bungalow)"
UNIT = [
    UNIT_WORDS + r"\s*[#:-]?\s*([A-Z0-9/-]+)",
    r"^([A-Z0-9]+-?[0-9]+)\s*,",
    r"^([0-9]+(?:st|nd|rd|th)?\s+Floor)\s*,",
    r"\b([A-Z]-Wing\s+[0-9]+)\b",
    r"\b([0-9]+/[A-Z0-9]+)\b",
]
SOCIETY = [
    UNIT_WORDS + r"\s*[#:-]?\s*[A-Z0-9/-]+\s*,\s*([A-Z][A-Za-z\s]+?)(?:,|Near|near)",
    r"^[A-Z0-9]+-?[0-9]+\s*,\s*([A-Z][A-Za-z\s]+?)(?:,|Near|near)",
    r"^[A-Z]-Wing\s+[0-9]+\s*,\s*([A-Z][A-Za-z\s]+?)(?:,|Near|near)",
    r"^[0-9]+(?:st|nd|rd|th)?\s+Floor\s*,\s*([A-Z][A-Za-z\s]+?)(?:,|Near|near)",
]
LANDMARK = r"(?:Near|near|Opposite|opposite|Opp|opp\.?)\s+([^,]+)"
ROAD = [r"([A-Z][A-Za-z\s]+(?:Road|road|ROAD|Street|street|STREET|Marg|marg|MARG))", r"([A-Z][A-Za-z\s]+\s+Rd\.?)"]
STATES = [
    "Maharashtra", "Karnataka", "Delhi", "Tamil Nadu", "Gujarat", "Rajasthan", "Uttar Pradesh", "Madhya Pradesh", "West Bengal", "Andhra Pradesh",
    "Telangana", "Kerala", "Punjab", "Haryana", "Bihar", "Odisha", "Assam", "Jharkhand", "Chhattisgarh",
]
CITIES = [
    "Pune", "Mumbai", "Bangalore", "Delhi", "Hyderabad", "Chennai", "Kolkata", "Ahmedabad", "Surat", "Jaipur",
    "Lucknow", "Kanpur", "Nagpur", "Indore", "Thane", "Bhopal", "Visakhapatnam", "Pimpri-Chinchwad",
]
NOTE = "Parsed using local rule-based parser"
EMPTY_ERROR = "Empty address text"


#: What a text in small letters has to hold for a pattern to match it, any of the words: a plain search that spares most patterns most texts.
_UNIT_NEEDS = ["flat", "apartment", "apt", "unit", "office", "shop", "villa", "bungalow"]
NEEDS = {
    UNIT[0]: _UNIT_NEEDS, UNIT[2]: ["floor"], UNIT[3]: ["-wing"], UNIT[4]: ["/"], SOCIETY[0]: _UNIT_NEEDS, SOCIETY[2]: ["-wing"], SOCIETY[3]: ["floor"],
    LANDMARK: ["near", "opp"], ROAD[0]: ["road", "street", "marg"], ROAD[1]: ["rd"],
}


#: What an alternative or a word boundary has to be followed by: one look at a character, where the rest would be tried at every place. Matches stay the same.
_AHEAD = {UNIT_WORDS: "(?=[FfAaUuOoSsVvBb])", "(?:Near|near|Opposite": "(?=[NnOo])", "(?:Road|road": "(?=[RrSsMm])", PIN: r"(?=\d)"}


def _quick(pattern: str) -> str:
    for part, ahead in _AHEAD.items():
        pattern = pattern.replace(part, ahead + part)
    return pattern


def matched(c: Column, low: Column, pattern: str, ignore_case: bool = False) -> Column:
    """Group 1 of a pattern, null where it doesn't match; low is c in small letters."""
    p = "(?i)" * ignore_case + _quick(pattern)
    there = reduce(or_, (low.contains(w) for w in NEEDS[pattern])) & c.rlike(p) if pattern in NEEDS else c.rlike(p)
    return F.when(there, F.regexp_extract(c, p, 1))


def first_match(c: Column, low: Column, patterns: list[str], ignore_case: bool = False) -> Column:
    """Group 1 of the first pattern that matches, stripped; empty if none does. No group of these patterns can be blank.

    A pattern that doesn't match is tried once, and those after the first that does not at all.
    """
    return strip(F.coalesce(*(matched(c, low, p, ignore_case) for p in patterns), F.lit("")))


def first_listed(c: Column, names: list[str]) -> Column:
    """The first of names, in their order, that a lower-cased text holds; empty if none."""
    return F.coalesce(*(F.when(c.contains(n.lower()), F.lit(n)) for n in names), F.lit(""))


def pin_code(c: Column) -> Column:
    return F.regexp_extract(c, _quick(PIN), 1)


def with_rule_fields(df: DataFrame, raw: Column, known: dict[str, Column] | None = None) -> tuple[DataFrame, dict[str, Column], list[str]]:
    """The table with helper columns, the fields of its addresses as columns, and the helpers' names.

    Fields in `known` that aren't empty take precedence. Text, city and parts are columns of their
    own, since several fields use them: the optimizer evaluates a column once, an expression as
    often as it is written. Sub-locality and locality are the last and the one before of the
    comma-separated parts that precede the city.
    """
    known = known or {}
    pick = lambda f, c: F.coalesce(none_if_empty(known[f]), c) if f in known else c
    x = compiled(df).withColumn("_rule_text", strip(raw)).withColumn("_rule_low", F.lower("_rule_text"))
    a, low = F.col("_rule_text"), F.col("_rule_low")
    x = x.withColumn("_rule_city", pick("city", first_listed(low, CITIES)))
    city = F.col("_rule_city")
    at = F.instr(low, F.lower(city))
    x = x.withColumn("_rule_parts", F.when((city != "") & (at > 1), F.split(strip(F.substring(a, F.lit(1), at - 1)), ",", -1)))
    parts = F.col("_rule_parts")
    sub = strip(F.when(F.size(parts) >= 2, F.element_at(parts, -1)))
    main = strip(F.when(F.size(parts) >= 3, F.get(parts, F.size(parts) - 2)))
    fields = {
        "unit_number": first_match(a, low, UNIT, ignore_case=True), "society_name": pick("society_name", squeeze(first_match(a, low, SOCIETY, ignore_case=True))),
        "landmark": first_match(a, low, [LANDMARK]), "road": first_match(a, low, ROAD), "sub_locality": sub, "locality": main,
        "city": city, "district": city, "state": first_listed(low, STATES), "country": F.lit("India"), "pin_code": pin_code(a), "note": F.lit(NOTE),
    }
    return x, fields, ["_rule_text", "_rule_low", "_rule_city", "_rule_parts"]


def rule_parse(df: DataFrame, column: str = "addr_text", out: str = "parsed", fields: list[str] = FIELDS) -> DataFrame:
    """Adds the parsed record. A null or blank address fails. fields: those that the record has, others are not computed."""
    x, values, helpers = with_rule_fields(df, F.col(column))
    return x.withColumn(out, parsed_record(values, is_blank(F.col("_rule_text")), F.lit(EMPTY_ERROR), fields)).drop(*helpers)
