"""Record layouts: raw addresses, parsed fields, entities, components, metrics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Columns of the raw input that have a meaning; all others are carried along.
RAW_FIELDS = ["addr_hash_key", "addr_text", "city_id", "pincode", "state_id", "zone_id", "address_id", "assigned_pickup_dlvd_geo_points"]
COUNT_FIELD = "assigned_pickup_dlvd_geo_points_count"
REQUIRED = ["addr_text", "pincode", "city_id"]

#: Parsed fields in order, and their short names in output files.
FIELDS = ["unit_number", "society_name", "landmark", "road", "sub_locality", "locality", "city", "district", "state", "country", "pin_code", "note"]
SHORT = dict(zip(FIELDS, ["UN", "SN", "LN", "RD", "SL", "LOC", "CY", "DIS", "ST", "CN", "PIN", "Note"], strict=True))
#: Fields that comparisons count: all but the note.
COMPARED = FIELDS[:-1]

ENTITY = T.StructType([T.StructField("entity_group", T.StringType()), T.StructField("word", T.StringType()), T.StructField("score", T.DoubleType())])
COMPONENT = T.StructType([T.StructField("value", T.StringType()), T.StructField("label", T.StringType())])
PARSED = T.StructType([*(T.StructField(f, T.StringType()) for f in FIELDS), T.StructField("parse_success", T.BooleanType()), T.StructField("parse_error", T.StringType())])


def raw_schema(columns: list[str]) -> T.StructType:
    """All strings: postal codes keep their leading zeros, nothing is inferred."""
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def blank_to_empty(c: Column) -> Column:
    """Null and white-space-only become empty; other values stay as they are."""
    return F.coalesce(F.regexp_replace(c, r"^\s+$", ""), F.lit(""))


def parsed_struct(values: dict[str, Column], success: Column, error: Column) -> Column:
    """The parsed record: twelve strings that are never null, success and error."""
    fields = [blank_to_empty(values.get(f, F.lit("")).cast("string")).alias(f) for f in FIELDS]
    return F.struct(*fields, success.cast("boolean").alias("parse_success"), error.cast("string").alias("parse_error"))


def parsed_record(values: dict[str, Column], blank: Column, error: Column, fields: list[str] = FIELDS) -> Column:
    """The record of a text: that of `failed` where it is blank. Values are stripped ones, so none is of white space alone; each may be null.

    fields: those that the record has beside success and error. A record is made whole, whatever is read of it, so those left out are what isn't computed.
    """
    own = [F.when(blank, F.lit("")).otherwise(F.coalesce(values.get(f, F.lit("")).cast("string"), F.lit(""))).alias(f) for f in FIELDS if f in fields]
    return F.struct(*own, (~blank).alias("parse_success"), F.when(blank, error).cast("string").alias("parse_error"))


def failed(error: Column) -> Column:
    """A record without fields."""
    return parsed_struct({}, F.lit(False), error)
