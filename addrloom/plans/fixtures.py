"""Address relations derived from the orders table, in SQL that Spark and DuckDB both run unchanged.

There is no address data among the tables, so rows are put together from o_orderkey by modulo:
units, societies with variants of spelling, landmarks, roads, localities, cities, states, codes.
`addresses` has the raw columns and the ingredients (x_...), from which entity lists and
answers are built on either side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.readers import spread


def pick(key: str, values: list[str]) -> str:
    return f"split_part('{'|'.join(values)}', '|', cast({key} + 1 as int))"


SOCIETIES = ["Prestige Lakeside", "Kumar Paradise", "Amanora Park Town", "Green Valley Homes", "Lodha Complex", "Seasons Apartment", "Panchshil Towers", "Suyog Nisarg", "Pride Purple Park", "Friendship Residency", "Magarpatta City", "Blue Ridge"]
ROADS = ["Baner Road", "MG Road", "FC Road", "Station Street", "Tilak Marg", "Airport Rd", ""]
LOCALITIES = ["Kalyani Nagar", "Hadapsar", "Wakad", "Baner", "Koregaon Park", "Viman Nagar", "Kharadi", "Aundh", "Yerwada"]
CITIES = ["Pune", "Pune", "Mumbai", "Bangalore", "Nashik", "Hyderabad", "pune"]
STATES = ["Maharashtra", "Maharashtra", "", "Karnataka", "telangana"]
NEAR = ["Near Osho Ashram", "near City Mall", "NEAR SBI BANK", "Opp. Post Office", "Opposite Big School", "", "", ""]


def addresses_sql(source: str = "orders JOIN customer ON o_custkey = c_custkey") -> str:
    """The relation over orders joined with customer; source: o_orderkey and c_nationkey of that join, where it is made outside."""
    k = "o_orderkey"
    society = pick(f"(({k} * 7 + 3) % 12)", SOCIETIES)
    variant = f"CASE ({k} % 31) WHEN 0 THEN '' WHEN 1 THEN '@@@' WHEN 2 THEN upper(s0) WHEN 3 THEN s0 || 's' WHEN 4 THEN 'The ' || s0 WHEN 5 THEN s0 || ' Phase' WHEN 6 THEN replace(s0, ' ', '-') WHEN 7 THEN '  ' || lower(s0) || '  ' WHEN 8 THEN s0 || '@2024' WHEN 9 THEN substring(s0, 1, length(s0) - 1) ELSE s0 END"
    number = f"cast(100 + {k} % 890 as varchar(10))"
    unit = f"CASE ({k} % 9) WHEN 0 THEN 'Flat ' || {number} WHEN 1 THEN 'A-' || {number} WHEN 2 THEN 'B-Wing ' || {number} WHEN 3 THEN cast(1 + {k} % 20 as varchar(10)) || 'th Floor' WHEN 4 THEN cast(1 + {k} % 60 as varchar(10)) || '/B' WHEN 5 THEN '' WHEN 6 THEN 'flat no. ' || {number} WHEN 7 THEN 'Shop #' || {number} ELSE {number} END"
    pin = f"CASE WHEN {k} % 17 = 0 THEN '' WHEN {k} % 29 = 0 THEN '4110' || cast({k} % 10 as varchar(10)) ELSE '4110' || lpad(cast((c_nationkey * 2 + {k} % 2) as varchar(10)), 2, '0') END"
    return f"""
SELECT row_id, 'H' || cast(row_id as varchar(20)) AS addr_hash_key,
  CASE WHEN row_id % 97 = 0 THEN '' WHEN row_id % 193 = 0 THEN '   ' WHEN row_id % 101 = 0 THEN x_text || repeat(' Extra Words', 30) WHEN row_id % 23 = 0 THEN '  ' || replace(x_text, ' ', '  ') || ' ' ELSE x_text END AS addr_text,
  CASE WHEN row_id % 83 = 0 THEN '' ELSE 'C' || cast(row_id % 13 as varchar(10)) END AS city_id,
  CASE WHEN row_id % 89 = 0 THEN '' ELSE '4110' || lpad(cast(x_nation as varchar(10)), 2, '0') END AS pincode,
  'S' || cast(row_id % 5 as varchar(10)) AS state_id, 'Z' || cast(row_id % 4 as varchar(10)) AS zone_id, 'A' || cast(row_id as varchar(20)) AS address_id, '' AS assigned_pickup_dlvd_geo_points,
  CASE WHEN row_id % 11 = 0 THEN 'abc' WHEN row_id % 13 = 0 THEN '' ELSE cast(row_id % 5 as varchar(10)) END AS assigned_pickup_dlvd_geo_points_count,
  'p' || cast(row_id % 7 + 1 as varchar(10)) || '.csv' AS source_file,
  x_unit, x_society, x_near, x_road, x_locality, x_city, x_state, x_pin, x_score
FROM (
  SELECT *, (CASE WHEN x_unit = '' THEN '' ELSE x_unit || ', ' END) || (CASE WHEN x_society = '' THEN '' ELSE x_society || ', ' END) || (CASE WHEN x_near = '' THEN '' ELSE x_near || ', ' END)
    || (CASE WHEN x_road = '' THEN '' ELSE x_road || ', ' END) || x_locality || ', ' || x_city || (CASE WHEN x_state = '' THEN '' ELSE ', ' || x_state END) || (CASE WHEN x_pin = '' THEN '' ELSE ' ' || x_pin END) AS x_text
  FROM (
    SELECT row_id, x_nation, x_unit, {variant.replace(k, "row_id")} AS x_society, x_near, x_road, x_locality, x_city, x_state, x_pin, x_score
    FROM (
      SELECT cast({k} as bigint) AS row_id, c_nationkey AS x_nation, {society} AS s0, {unit} AS x_unit, {pick(f"(({k} * 5 + 1) % 8)", NEAR)} AS x_near, {pick(f"(({k} * 3 + 2) % 7)", ROADS)} AS x_road,
        {pick(f"(({k} * 11 + 4) % 9)", LOCALITIES)} AS x_locality, {pick(f"(({k} * 13 + 5) % 7)", CITIES)} AS x_city, {pick(f"(({k} * 2 + 1) % 5)", STATES)} AS x_state, {pin} AS x_pin,
        cast(({k} * 37) % 100 as double) / 100 AS x_score
      FROM {source}) a) b) c"""


def addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The relation over the tables in sf_dir."""
    orders, customer = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("orders", "customer"))
    joined = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_nationkey")
    spread(joined, orders.count()).createOrReplaceTempView("addrloom_orders")  # after the join, which deals rows out by its own keys
    return spark.sql(addresses_sql("addrloom_orders"))


def with_entities(df: DataFrame) -> DataFrame:
    """What a recogniser would give for a row: labels in either case, trailing commas, repeated labels, scores around the limit."""
    e = lambda label, word, score: F.struct(F.lit(label).alias("entity_group"), word.alias("word"), score.cast("double").alias("score"))
    s, high = F.col("x_score"), F.lit(0.9)
    return df.withColumn(
        "entities",
        F.array(
            e("HOUSE_DETAILS", F.concat(F.col("x_unit"), F.lit(",")), high), e("building_name", F.col("x_society"), F.lit(0.51)), e("building", F.lit("Second Name"), s), e("landmarks", F.col("x_near"), s),
            e("street", F.col("x_road"), high), e("locality", F.concat(F.lit(" "), F.col("x_locality"), F.lit(" ,")), high), e("town", F.col("x_city"), F.lit(0.5)), e("city", F.col("x_city"), F.when(s >= 0.5, s).otherwise(F.lit(0.0))), e("state", F.col("x_state"), high),
        ),
    )


def with_components(df: DataFrame) -> DataFrame:
    c = lambda value, label: F.struct(value.alias("value"), F.lit(label).alias("label"))
    return df.withColumn("components", F.filter(F.array(
        c(F.lower("x_unit"), "house_number"), c(F.lower("x_society"), "house"), c(F.lower("x_near"), "near"), c(F.lower("x_road"), "road"), c(F.lit("lane 2"), "street"), c(F.lower("x_locality"), "suburb"),
        c(F.lower("x_city"), "city"), c(F.lower("x_state"), "state"), c(F.when(F.col("row_id") % 2 == 0, F.col("x_pin")).otherwise(F.lit("")), "postcode"),
    ), lambda x: x["value"] != ""))


def with_answers(df: DataFrame) -> DataFrame:
    """Answers of a language model: plain, fenced, without some keys, broken."""
    full = F.to_json(F.struct(F.col("x_unit").alias("UN"), F.col("x_society").alias("SN"), F.col("x_locality").alias("LOC"), F.col("x_city").alias("CY"), F.col("x_pin").alias("PIN")))
    return df.withColumn("answer", F.when(F.col("row_id") % 5 == 0, F.concat(F.lit("```json\n"), full, F.lit("\n```"))).when(F.col("row_id") % 5 == 1, F.lit('{"CY": "Pune"}')).when(F.col("row_id") % 5 == 2, F.lit("no json here")).otherwise(full))
