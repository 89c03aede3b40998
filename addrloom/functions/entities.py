"""Records from what external recognisers return: entity lists, component lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import FIELDS, failed, parsed_record, parsed_struct
from .rules import EMPTY_ERROR, pin_code, with_rule_fields
from .text import compiled, is_blank, none_if_empty, strip

# Labels of each field.
ENTITY_LABELS = {
    "unit_number": ["house_details", "house_number", "flat", "unit"],
    "society_name": ["building_name", "building", "society", "complex"],
    "landmark": ["landmarks", "landmark", "near"],
    "road": ["street", "road"],
    "sub_locality": ["sublocality", "sub_locality", "area"],
    "locality": ["locality", "neighbourhood", "neighborhood"],
    "city": ["city", "town"],
    "district": ["district"],
    "state": ["state", "province"],
    "pin_code": ["pincode", "postcode", "zip", "pin_code"],
}
GENERIC_LABELS = {"city": ["loc", "location"], "society_name": ["org", "organization"]}
COMPONENT_LABELS = {
    "unit_number": ["house_number"], "society_name": ["house", "building"], "landmark": ["near"], "road": ["road", "street"], "sub_locality": ["suburb"],
    "locality": ["city_district", "neighbourhood"], "city": ["city"], "district": ["state_district"], "state": ["state"], "country": ["country"], "pin_code": ["postcode"],
}
ENTITY_NOTE, COMPONENT_NOTE, GENERIC_NOTE = "Parsed using entity recogniser", "Parsed using component labels", "Parsed using entities and rules"


def entity_word(e: Column) -> Column:
    """A word without surrounding white space and trailing commas."""
    return strip(F.rtrim(strip(F.coalesce(e["word"], F.lit(""))), F.lit(",")))


def confident(entities: Column, min_score: float = 0.5, strict: bool = True) -> Column:
    """Entities whose score is above min_score; with strict off, also those that equal it."""
    score = lambda e: F.coalesce(e["score"], F.lit(0.0))
    return F.filter(F.coalesce(entities, F.array()), lambda e: score(e) > min_score if strict else score(e) >= min_score)


def first_of(entities: Column, labels: list[str], clean=entity_word) -> Column:
    """The first non-empty word of an entity with one of the labels, in any case; else empty."""
    words = F.transform(F.filter(entities, lambda e: F.lower(e["entity_group"]).isin(labels)), clean)
    return F.coalesce(F.get(F.filter(words, lambda w: w != ""), F.lit(0)), F.lit(""))


def map_entities(df: DataFrame, column: str = "addr_text", entities: str = "entities", out: str = "parsed", note: str = ENTITY_NOTE, min_score: float = 0.5, strict: bool = True, fields: list[str] = FIELDS) -> DataFrame:
    """Adds the parsed record that an entity list amounts to: the first word of each field, a postal code by rule, the city as district. fields: those that the record has, others are not computed."""
    read = [f for f in ENTITY_LABELS if f in fields or (f == "city" and "district" in fields)]
    # Labels and words of all entities are made once, in a column of their own; the fields pick from them.
    own = confident(F.col(entities), min_score, strict)
    if len(read) < len(ENTITY_LABELS):  # only words that a field takes are cleaned
        own = F.filter(own, lambda e: F.lower(e["entity_group"]).isin([x for f in read for x in ENTITY_LABELS[f]]))
    words = F.transform(own, lambda e: F.struct(F.lower(e["entity_group"]).alias("label"), entity_word(e).alias("word")))
    x = compiled(df).withColumn("_entity_words", F.filter(words, lambda e: e["word"] != ""))
    first = lambda labels: F.coalesce(F.get(F.filter("_entity_words", lambda e: e["label"].isin(labels)), F.lit(0))["word"], F.lit(""))
    double = [f for f in ("city", "district", "pin_code") if f in read]  # used twice below
    x = x.withColumns({f"_entity_{f}": first(ENTITY_LABELS[f]) for f in double})
    v = {f: F.col(f"_entity_{f}") if f in double else first(ENTITY_LABELS[f]) for f in read}
    if "pin_code" in read:
        v["pin_code"] = F.when(v["pin_code"] != "", v["pin_code"]).otherwise(pin_code(F.col(column)))
    if "district" in read:
        v["district"] = F.when(v["district"] != "", v["district"]).otherwise(v["city"])
    v |= {"country": F.lit("India"), "note": F.lit(note)}
    x = x.withColumn("_entity_blank", is_blank(F.col(column)))
    return x.withColumn(out, parsed_record(v, F.col("_entity_blank"), F.lit(EMPTY_ERROR), fields)).drop("_entity_words", "_entity_blank", *(f"_entity_{f}" for f in double))


def map_generic_entities(df: DataFrame, column: str = "addr_text", entities: str = "entities", out: str = "parsed") -> DataFrame:
    """Locations and organisations where there are any, rules for all else."""
    own = F.coalesce(F.col(entities), F.array())
    known = {f: first_of(own, labels, lambda e: strip(F.coalesce(e["word"], F.lit("")))) for f, labels in GENERIC_LABELS.items()}
    x, v, helpers = with_rule_fields(df, F.col(column), known)
    v["note"] = F.lit(GENERIC_NOTE)
    return x.withColumn(out, F.when(is_blank(F.col(column)), failed(F.lit(EMPTY_ERROR))).otherwise(parsed_struct(v, F.lit(True), F.lit(None)))).drop(*helpers)


def map_components(df: DataFrame, column: str = "addr_text", components: str = "components", out: str = "parsed") -> DataFrame:
    """Adds the record of a list of (value, label): the values of a field's labels, label after label, joined by spaces."""
    own = F.coalesce(F.col(components), F.array())
    values = lambda label: F.transform(F.filter(own, lambda c: c["label"] == label), lambda c: c["value"])
    v = {f: strip(F.array_join(F.concat(*(values(x) for x in labels)), " ")) for f, labels in COMPONENT_LABELS.items()}
    v["district"] = F.coalesce(none_if_empty(v["district"]), v["city"])
    v["country"] = F.coalesce(none_if_empty(v["country"]), F.lit("India"))
    v["pin_code"] = F.coalesce(none_if_empty(v["pin_code"]), pin_code(F.col(column)))
    v["note"] = F.lit(COMPONENT_NOTE)
    return df.withColumn(out, F.when(is_blank(F.col(column)), failed(F.lit(EMPTY_ERROR))).otherwise(parsed_struct(v, F.lit(True), F.lit(None))))


def label_inventory(df: DataFrame, entities: str = "entities") -> DataFrame:
    """Distinct entity labels and how often they occur."""
    return df.select(F.explode(entities).alias("e")).groupBy(F.col("e.entity_group").alias("label")).agg(F.count(F.lit(1)).alias("n"))
