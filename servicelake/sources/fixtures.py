"""Service-request views over the driver's TPC-H-style test tables.

One landing record per ``lineitem`` row (see FIXTURES.md section 2):

=================  ======================================================
unique_key         ``l_orderkey * 10 + l_linenumber`` (not unique: dupes)
created_date       ``o_orderdate`` as landing text
closed_date        ``l_shipdate`` as landing text when ``l_linestatus='F'``
                   (``n/a`` for every 101st key)
agency             ``c_mktsegment`` (untrimmed for keys 19 modulo 29)
complaint_type     ``p_type``; by the key modulo 29 a text of ``RULE_TEXTS``,
                   a numbered or a lower-case untrimmed type
borough            ``r_name``, NULL when ``l_quantity < 2`` (blank for every
                   331st key, lower case for keys 18 modulo 29)
status             ``l_linestatus``
latitude           ``l_tax`` as text, NULL when ``l_tax = 0`` (``unknown`` for
                   every 53rd key)
longitude          ``l_discount`` as text, NULL when ``l_tax = 0``
load_id            ``l_suppkey % 4`` (stand-in for append batches)
=================  ======================================================

Join order is chosen for scale: the geography dimension comes from files
whose size the planner knows, so it decides on their broadcast itself;
customers attach to orders first (orders are ~1/4 of lineitem), then lineitem meets orders and
parts by shuffle (or AQE broadcast when a side turns out small).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from servicelake.functions.clean import ntz_text
from servicelake.sources.tables import targets_frame

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# SLA targets for the fixture categories (p_type values and
# labels of the category rules).  PROMO deliberately has no target, so the
# inner join drops it.
FIXTURE_SLA_TARGETS: tuple[tuple[str, str, int], ...] = (
    ("STANDARD", "HOUSEHOLD", 200),
    ("ECONOMY", "BUILDING", 400),
    ("MEDIUM", "BUILDING", 30),
    ("SMALL", "MACHINERY", 600),
    ("LARGE", "FURNITURE", 100),
    ("NOISE - RESIDENTIAL", "POLICE", 1),
    ("HEAT/HOT WATER", "HOUSING", 30),
    ("UNSANITARY CONDITION", "HOUSING", 60),
    ("ILLEGAL PARKING", "POLICE", 1),
    ("WATER LEAK", "HOUSING", 14),
    ("RODENT", "HEALTH", 45),
    ("STREET CONDITION", "STREETS", 90),
    ("SIDEWALK CONDITION", "STREETS", 120),
    ("BROKEN MUNI METER", "STREETS", 7),
)

# Texts of complaints that the category rules are about, by the record's key
# modulo 29 (one of each kind: mixed case, both patterns of a rule, the exact
# pair and a near miss of it).
RULE_TEXTS: tuple[str, ...] = (
    " Noise - Residential ",
    "noise / RESIDENTIAL (loud)",
    "Heat request",
    "no HOT WATER",
    "Unsanitary Condition",
    "illegal parking",
    "Water Leak",
    "rodent sighting",
    "Street Condition",
    "Sidewalk Condition",
    "street condition ",
    "Broken Parking Meter",
)

# Orders end mid-2001 in every fixture scale, so 2000 is the last complete
# year (the role 2025 plays for the production data).
FIXTURE_YEAR_CAP = 2000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fixture_targets(spark: SparkSession) -> DataFrame:
    return targets_frame(spark, FIXTURE_SLA_TARGETS)


def raw_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing-shaped (text) request records derived from the test tables."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_discount", "l_tax", "l_linestatus", "l_shipdate",
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type")

    geo = nation.join(region, nation.n_regionkey == region.r_regionkey).select("n_nationkey", "r_name")
    cust = customer.join(geo, customer.c_nationkey == geo.n_nationkey).select("c_custkey", "c_mktsegment", "r_name")
    # the order's date becomes text here, once for all of its line items
    ords = orders.join(cust, orders.o_custkey == cust.c_custkey).select("o_orderkey", ntz_text(F.col("o_orderdate")).alias("created_text"), "c_mktsegment", "r_name")
    joined = li.join(ords, li.l_orderkey == ords.o_orderkey).join(part, li.l_partkey == part.p_partkey)

    ts_text = ntz_text

    no_coords = F.col("l_tax") == F.lit(0.0)
    key = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    kind = F.pmod(key, F.lit(29))
    complaint = F.when(kind < len(RULE_TEXTS), F.element_at(F.array(*[F.lit(t) for t in RULE_TEXTS]), F.least(kind, F.lit(len(RULE_TEXTS) - 1)).cast("int") + 1))
    complaint = complaint.when(kind < 16, F.concat_ws(" ", "p_type", (F.col("l_partkey") % 4).cast("string")))
    complaint = complaint.when(kind == 16, F.concat(F.lit("  "), F.lower("p_type"), F.lit(" "))).otherwise(F.col("p_type"))
    borough = F.when(F.col("l_quantity") < 2, F.lit(None).cast("string")).when(F.pmod(key, F.lit(331)) == 0, F.lit("   "))
    borough = borough.when(kind == 18, F.concat(F.lit(" "), F.lower("r_name"))).otherwise(F.col("r_name"))
    closed = F.when(F.col("l_linestatus") == "F", F.when(F.pmod(key, F.lit(101)) == 0, F.lit("n/a")).otherwise(ts_text(F.col("l_shipdate"))))
    return joined.select(
        key.alias("unique_key"),
        F.col("created_text").alias("created_date"),
        closed.alias("closed_date"),
        F.when(kind == 19, F.concat(F.lit(" "), F.col("c_mktsegment"), F.lit("  "))).otherwise(F.col("c_mktsegment")).alias("agency"),
        complaint.alias("complaint_type"),
        borough.alias("borough"),
        F.col("l_linestatus").alias("status"),
        F.when(no_coords, F.lit(None).cast("string")).when(F.pmod(key, F.lit(53)) == 0, F.lit("unknown")).otherwise(F.col("l_tax").cast("string")).alias("latitude"),
        F.when(no_coords, F.lit(None).cast("string")).otherwise(F.col("l_discount").cast("string")).alias("longitude"),
        (F.col("l_suppkey") % 4).cast("int").alias("load_id"),
    )
