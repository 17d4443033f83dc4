"""Reconditioning cost on the test tables.

invoice = order (invoice no = job card = order key), vehicle = the order's customer
(registration = customer name), invoice workshop = the customer's nation (null in one region,
so the not-null filter bites), city = bucket of the customer's region, job rows = line items,
job-card users = the distinct suppliers of the order's lines.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forecourt.functions.columns import (
    full_name, local_floor, local_time, null_fallback, pattern_bucket,
)
from forecourt.plans import roles
from forecourt.plans.deals import lines_by_deal, lines_by_pair
from forecourt.plans.refurb import REFURB_CATEGORIES, refurb_cost
from forecourt.plans.registry import register
from forecourt.session import scratch_path
from forecourt.sinks.publish import publish_table, published_table
from forecourt.sources.tables import Tables

INVOICE_FLOOR = "1997-01-01"


def geo(t: Tables) -> DataFrame:
    """nation + region: 25 rows whatever the scale, so it is broadcast."""
    return t.nation.join(F.broadcast(t.region), t.nation.n_regionkey == t.region.r_regionkey).select(
        "n_nationkey", "n_name", "r_name")


def refurb_inputs(t: Tables, facts: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``facts``: the lines also feed the deal master of the same plan, so both use one aggregate."""
    g = F.broadcast(geo(t))
    car = (t.customer.select("c_custkey", "c_name", "c_nationkey")
           .join(g, F.col("c_nationkey") == F.col("n_nationkey"), "left")
           .select(F.col("c_custkey").alias("sell_lead_id"), F.col("c_name").alias("registration_no"),
                   pattern_bucket("r_name", roles.CITY_RULES, "Others").alias("car_city"),
                   F.when(F.col("r_name") == "MIDDLE EAST", F.lit(None).cast("string"))
                    .otherwise(F.col("n_name")).alias("invoice_workshop_name")))
    invoices = (t.orders
                .filter(local_floor("o_orderdate", INVOICE_FLOOR))
                .select(F.col("o_orderkey").alias("invoice_id"),
                        F.col("o_orderkey").alias("invoice_no"),
                        F.col("o_orderkey").alias("job_card_id"),
                        F.col("o_custkey").alias("car_id"),
                        local_time("o_orderdate").alias("invoice_created_at"),
                        F.col("o_orderdate").alias("in_date"),
                        F.lit(None).cast("timestamp_ntz").alias("out_date"),
                        null_fallback(roles.car_category(), roles.invoice_category()).alias("refurb_category"))
                .join(car, F.col("car_id") == F.col("sell_lead_id"), "left")
                .filter(F.col("invoice_workshop_name").isNotNull())
                .drop("car_id"))
    # The lines are read once for every product (``lines_by_pair``): their sum per deal is the line cost of
    # the invoice (re-summed inside refurb_cost; a sum of sums is the same sum), their (deal, supplier) pairs are the
    # job-card users. The sum runs on exact integer units (long arithmetic) and becomes a decimal once per deal.
    unit = F.lit(Decimal(1).scaleb(-roles.UNIT_SCALE))
    line_costs = lines_by_deal(t, facts).select(
        F.col("l_orderkey").alias("invoice_id"), (F.col("_units").cast("decimal(38,0)") * unit).alias("line_cost"))
    users = (t.supplier.join(g, F.col("s_nationkey") == F.col("n_nationkey"), "left")
             .select(F.col("s_suppkey").alias("_user"),
                     full_name(roles.advisor_first(), "r_name", lower=True).alias("advisor_name")))
    advisors = (lines_by_pair(t, facts).select(F.col("l_orderkey").alias("job_card_id"), F.col("l_suppkey").alias("user_id"))
                .join(users, F.col("_user") == F.col("user_id"), "left")
                .select("job_card_id", "advisor_name"))
    return invoices, line_costs, advisors


def refurb_cost_testdata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cost table written to its target and read back."""
    t = Tables(spark, sf_dir)
    invoices, line_costs, advisors = refurb_inputs(t)
    target = scratch_path(spark, "refurb-cost")
    publish_table(refurb_cost(invoices, line_costs, advisors, out_type="double"), target)
    return published_table(spark, target)


_CATEGORIES = ", ".join(f"'{c}'" for c in REFURB_CATEGORIES)
_CITIES = " ".join(f"WHEN r_name LIKE '{p}' THEN '{v}'" for p, v in roles.CITY_RULES)

#: The rules of plans/refurb.py as a chain of steps over job rows and users.
REFURB_SQL = f"""
WITH place AS (
  SELECT n_nationkey AS place_id, n_name, r_name FROM nation LEFT JOIN region ON n_regionkey = r_regionkey
), vehicle AS (
  SELECT c_custkey AS vehicle_id, c_name AS plate, CASE {_CITIES} ELSE 'Others' END AS city,
         CASE WHEN r_name <> 'MIDDLE EAST' OR r_name IS NULL THEN n_name END AS workshop
  FROM customer LEFT JOIN place ON place_id = c_nationkey
), bill AS (
  SELECT o_orderkey AS bill_id, plate, city, workshop, vehicle_id, o_orderdate AS entered,
         o_orderdate + INTERVAL 330 MINUTE AS billed_at,
         coalesce({roles.CAR_CATEGORY_SQL}, {roles.INVOICE_CATEGORY_SQL}) AS category
  FROM orders LEFT JOIN vehicle ON vehicle_id = o_custkey
  WHERE o_orderdate + INTERVAL 330 MINUTE >= TIMESTAMP '{INVOICE_FLOOR} 00:00:00' AND workshop IS NOT NULL
), work AS (
  SELECT l_orderkey AS bill_id,
         sum({roles.LINE_COST_SQL['part_count']} * {roles.LINE_COST_SQL['part_cost']}
             + {roles.LINE_COST_SQL['labour_cost']}) AS cost
  FROM lineitem GROUP BY l_orderkey
), helper AS (
  SELECT bill_id, lower({roles.ADVISOR_FIRST_SQL}) || ' ' || lower(r_name) AS helper_name
  FROM (SELECT DISTINCT l_orderkey AS bill_id, l_suppkey FROM lineitem)
  LEFT JOIN supplier ON s_suppkey = l_suppkey LEFT JOIN place ON place_id = s_nationkey
), spent AS (
  SELECT bill.bill_id, plate, vehicle_id, city, workshop, billed_at, entered, category, helper_name, sum(cost) AS cost
  FROM bill LEFT JOIN work ON work.bill_id = bill.bill_id LEFT JOIN helper ON helper.bill_id = bill.bill_id
  GROUP BY ALL
), lead_helper AS (
  SELECT *, min(helper_name) OVER (PARTITION BY bill_id, plate) AS first_name FROM spent
)
SELECT vehicle_id AS sell_lead_id, plate AS reg_no, CAST(0.82 * sum(cost) AS DOUBLE) AS actual_refurb_cost
FROM lead_helper
WHERE helper_name IS NOT DISTINCT FROM first_name
  AND CASE WHEN category IS NULL OR category = 'N_A' THEN 'REFURB' ELSE category END IN ({_CATEGORIES})
GROUP BY vehicle_id, plate
"""

register("refurb_cost_per_vehicle", REFURB_SQL)(refurb_cost_testdata)
