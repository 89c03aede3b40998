"""Golden rows and vectors of the expression functions."""

import random

import pytest
from pyspark.sql import functions as F

from addrloom.functions import text
from addrloom.functions.complexity import complexity
from addrloom.functions.entities import map_components, map_entities
from addrloom.functions.llm_json import map_answers
from addrloom.functions.rules import rule_parse
from addrloom.functions.similarity import common_subsequence, similarity_column, token_sort_similarity
from addrloom.schema import FIELDS

# Published sample addresses and the fields that they have.
GOLDEN = [
    ("Flat 301, Kumar Paradise, Kalyani Nagar, Pune, Maharashtra 411006", "301", "Kumar Paradise", "", "", "Kalyani Nagar", "Pune", "Maharashtra", "411006"),
    ("A-204, Amanora Park Town, Hadapsar, Pune 411028", "A-204", "Amanora Park Town", "", "", "Hadapsar", "Pune", "", "411028"),
    ("Bungalow 12, Koregaon Park, Near Osho Ashram, Pune 411001", "12", "Koregaon Park", "Osho Ashram", "", "Near Osho Ashram", "Pune", "", "411001"),
    ("Office 505, Cerebrum IT Park, Kumar Road, Pune, Maharashtra 411001", "505", "Cerebrum IT Park", "", "Kumar Road", "Kumar Road", "Pune", "Maharashtra", "411001"),
    ("201, Magarpatta City, Hadapsar, Pune 411013", "201", "Magarpatta City", "", "", "Hadapsar", "Pune", "", "411013"),
    ("Flat 102, Seasons Apartment, Baner Road, Baner, Pune 411045", "102", "Seasons Apartment", "", "Baner Road", "Baner", "Pune", "", "411045"),
    ("B-Wing 404, Pride Purple Park, Wakad, Pune, Maharashtra 411057", "B-Wing 404", "Pride Purple Park", "", "", "Wakad", "Pune", "Maharashtra", "411057"),
    ("Villa 7, Amanora Neo Towers, Hadapsar, Near Phoenix Mall, Pune 411028", "7", "Amanora Neo Towers", "Phoenix Mall", "", "Near Phoenix Mall", "Pune", "", "411028"),
    ("Shop 12, FC Road, Shivajinagar, Pune 411004", "12", "FC Road", "", "FC Road", "Shivajinagar", "Pune", "", "411004"),
    ("3rd Floor, Panchshil Tech Park, Yerwada, Pune, Maharashtra 411006", "3rd Floor", "Panchshil Tech Park", "", "", "Yerwada", "Pune", "Maharashtra", "411006"),
]

# Addresses of our own, their fields read off the rules by hand.
GOLDEN += [
    ("Unit 9/C, Silver Oak Heights, opposite Town Hall, MG Road, Indiranagar, Bangalore, Karnataka 560038", "9/C", "Silver Oak Heights", "Town Hall", "MG Road", "Indiranagar", "Bangalore", "Karnataka", "560038"),
    ("12th Floor, Lotus, Near Station, Thane 400601", "12th Floor", "Lotus", "Station", "", "Near Station", "Thane", "", "400601"),
    ("  FLAT#7-B, rose villa, Sector 5, Jaipur", "7-B", "rose villa", "", "", "Sector 5", "Jaipur", "", ""),
    ("no digits here", "", "", "", "", "", "", "", ""),
    ("5/A, Old Town, Surat", "5/A", "", "", "", "Old Town", "Surat", "", ""),
]


def test_rule_parser_golden_rows(spark):
    df = spark.createDataFrame([(k, g[0]) for k, g in enumerate(GOLDEN)], "row_id int, addr_text string")
    got = rule_parse(df).orderBy("row_id").select("parsed.*").collect()
    for g, r in zip(GOLDEN, got, strict=True):
        assert (r.unit_number, r.society_name, r.landmark, r.road, r.locality, r.city, r.state, r.pin_code) == g[1:]
        assert r.district == r.city and r.country == "India" and r.parse_success and r.sub_locality == ""


def test_blank_addresses_fail_and_nothing_is_null(spark):
    df = spark.createDataFrame([(None,), ("",), (" \t\n",)], "addr_text string")
    for r in rule_parse(df).select("parsed.*").collect():
        assert not r.parse_success and r.parse_error == "Empty address text" and all(r[f] == "" for f in FIELDS)


@pytest.mark.parametrize(("raw", "expected"), [("PRESTIGE APARTMENTS", "prestige apartments"), ("  Lodha Complex  ", "lodha complex"), ("DLF-Phase@3!", "dlf phase3"), ("Green   Valley    Homes", "green valley homes"), ("", ""), ("  PRESTIGE-Shantiniketan@2024  ", "prestige shantiniketan2024")])
def test_normalize_name(spark, raw, expected):
    assert spark.createDataFrame([(raw,)], "x string").select(text.normalize_name(F.col("x"))).first()[0] == expected


def test_complexity_vectors(spark):
    vectors = {"flat 302, pune": 0.100250, "123 mumbai": 0.03, "apartment 5, bangalore": 0.10825, "506, amnora chembers, east amnora town center, amnora magarpatta road, hadapsar, pune": 0.30375, "124/1/8, sadguru housing society, sadgurunagar, pune nasik road, bhosari pune 39 near datta mandir": 0.514964}
    for r in spark.createDataFrame([(k,) for k in vectors], "x string").select("x", complexity(F.col("x")).alias("s")).collect():
        assert round(r.s, 6) == vectors[r.x]


def test_similarity_forms_agree(spark):
    rng = random.Random(1)
    pairs = [("prestige apartment", "prestige apartments"), ("a b", "b a"), ("", "x"), ("abc", "xyz")] + [("".join(rng.choices("ab c", k=rng.randint(0, 9))), "".join(rng.choices("ab c", k=rng.randint(0, 9)))) for _ in range(40)]
    got = spark.createDataFrame(pairs, "a string, b string").select("a", "b", similarity_column(F.col("a"), F.col("b")).alias("s")).collect()
    for r in got:
        assert r.s == pytest.approx(token_sort_similarity(r.a, r.b))
    assert token_sort_similarity("a" * 17 + "b" * 3, "a" * 17 + "c" * 3) >= 0.85
    assert common_subsequence("abcde", "ace") == 3


def test_entities_labels_scores_and_commas(spark):
    e = [("HOUSE_DETAILS", " 12, ", 0.9), ("building", "", 0.9), ("society", "Second,", 0.51), ("city", "Pune", 0.5), ("town", "Mumbai", 0.6)]
    df = spark.createDataFrame([("x 411001", e)], "addr_text string, entities array<struct<entity_group:string,word:string,score:double>>")
    r = map_entities(df).select("parsed.*").first()
    assert (r.unit_number, r.society_name, r.city, r.district, r.pin_code) == ("12", "Second", "Mumbai", "Mumbai", "411001")
    assert map_entities(df, strict=False).first().parsed.city == "Pune"


def test_components_join_values_of_a_field(spark):
    c = [("a", "road"), ("b", "street"), ("c", "road"), ("pune", "city")]
    r = map_components(spark.createDataFrame([("x", c)], "addr_text string, components array<struct<value:string,label:string>>")).first().parsed
    assert (r.road, r.city, r.district, r.country) == ("a c b", "pune", "pune", "India")


@pytest.mark.parametrize(("answer", "ok", "city"), [('{"CY": "Pune"}', True, "Pune"), ('```json\n{"CY": "Pune"}\n```', True, "Pune"), ('```\n{"CY": null}\n```', True, ""), ("no json", False, ""), (None, False, ""), ('{"CY": ', False, "")])
def test_answers(spark, answer, ok, city):
    r = map_answers(spark.createDataFrame([("x", answer)], "addr_text string, answer string")).first().parsed
    assert (r.parse_success, r.city) == (ok, city)


def test_sanitize_and_location(spark):
    r = spark.createDataFrame([("a\x00b\x1f\t\n", "Test Society", "", "400001")], "x string, s string, e string, p string")
    assert tuple(r.select(text.sanitize(F.col("x")), text.location_identifier(F.col("s"), F.col("p")), text.location_identifier(F.col("e"), F.col("p"))).first()) == ("ab\t\n", "Test Society_400001", "UNMATCHED_400001")
