"""Cleaning and shaping of text columns. Expressions only; white space and digits are ASCII."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Lengths that the two cleaners cut addresses at.
GPU_LENGTH, CPU_LENGTH = 300, 250


#: ASCII white space, as in a pattern's \\s.
WHITE = " \t\n\x0b\f\r"


def compiled(df: DataFrame) -> DataFrame:
    """df, for expressions of many patterns. The JVM compiles no method of more than 8,000 bytes and interprets it row by row; from this limit on Spark generates smaller ones."""
    df.sparkSession.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    return df


def strip(c: Column) -> Column:
    """Without white space at either end. No pattern: a text is looked at from its ends, not at every place."""
    return F.btrim(c, F.lit(WHITE))


def squeeze(c: Column) -> Column:
    return F.regexp_replace(c, r"\s+", " ")


def clean_address(c: Column, max_length: int = GPU_LENGTH) -> Column:
    """Stripped, white space collapsed, cut to max_length; null becomes empty."""
    return F.substring(squeeze(strip(F.coalesce(c, F.lit("")))), 1, max_length)


def is_blank(c: Column) -> Column:
    return c.isNull() | (strip(c) == "")


def none_if_empty(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def normalize_name(c: Column) -> Column:
    """Lower case; hyphens and underscores are spaces; other marks go; spaces collapse. Null becomes empty."""
    x = F.regexp_replace(strip(F.lower(F.coalesce(c, F.lit("")))), "[-_]", " ")
    return strip(squeeze(F.regexp_replace(x, r"[^a-z0-9\s]", "")))


def sanitize(c: Column) -> Column:
    """Output text without NUL and control characters; tab, line feed and carriage return stay. Null becomes empty."""
    return F.regexp_replace(F.coalesce(c.cast("string"), F.lit("")), r"[\x00-\x08\x0B\x0C\x0E-\x1F]", "")


def truncated(c: Column, length: int = 100) -> Column:
    return F.when(F.length(c) > length, F.concat(F.substring(c, 1, length), F.lit("..."))).otherwise(c)


def location_identifier(society: Column, pin: Column) -> Column:
    return F.concat(F.when(F.coalesce(society, F.lit("")) == "", F.lit("UNMATCHED")).otherwise(society), F.lit("_"), F.coalesce(pin, F.lit("")))


def effective_pin(parsed: Column, original: Column | None = None, default: str = "UNKNOWN") -> Column:
    """The parsed code, else the original, else the default."""
    return F.coalesce(none_if_empty(parsed), *([none_if_empty(original)] if original is not None else []), F.lit(default))


def word_count(c: Column) -> Column:
    return F.size(F.filter(F.split(c, r"\s+"), lambda w: w != ""))


def title_case(c: Column) -> Column:
    """Every run of letters begins with a capital: for display lists only."""
    runs = F.regexp_extract_all(F.lower(c), F.lit(r"[\p{L}]+|[^\p{L}]+"), F.lit(0))
    return F.array_join(F.transform(runs, lambda r: F.concat(F.upper(F.substring(r, 1, 1)), F.substring(r, 2, 1 << 20))), "")
