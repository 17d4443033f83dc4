"""Reconditioning ("refurb") cost per vehicle.

Semantics kept from the source workload:
* level 1 groups job-row costs per (invoice_no, job card, advisor name, workshop, vehicle,
  registration, city, invoice time, raw category, in/out dates); the raw category is the
  vehicle's category with the invoice's as fallback, and the GROUP BY uses that raw value
  although the row shows the normalised one (null or 'N_A' -> 'REFURB');
* a job card with k users named alike repeats every job row k times, so the advisor's group
  carries k copies of the cost;
* ``DENSE_RANK() OVER (PARTITION BY invoice_no, registration ORDER BY advisor ASC NULLS LAST)
  = 1`` keeps the first advisor's groups, and the rank is taken before the category filter;
* level 2 and 3 re-sum per invoice and then per (vehicle, registration); SUM of SUM is
  additive, so they are collapsed into one aggregate;
* the total is scaled by 0.82.

Plan: job rows are summed per invoice before anything else (one partial aggregate over the
biggest table), advisors are counted per (job card, name), and the two meet on the invoice
grain. No step materialises job rows x advisors. The rank is taken below the level-1 grouping, whose keys
hold all its columns: the other advisors' rows go before they are grouped.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.functions.columns import (
    full_name, local_floor, local_time, null_fallback, pattern_bucket, scaled, sentinel_normalise,
)
from forecourt.operators.windows import dense_rank_first

# Allowed categories, the sentinel, its replacement and the cost factor.
REFURB_CATEGORIES = (
    "REFURB", "PRE_SALE_REWORK", "PRE_SALE_MAINTENANCE", "PRE_SALE_CAR_RECEIVING_AT_HUB",
    "PRE_SALE", "PRE_SALE_CAR_DELIVERY",
)
CATEGORY_SENTINELS = ("N_A",)
CATEGORY_DEFAULT = "REFURB"
COST_FACTOR = "0.82"

INVOICE_KEYS = (
    "invoice_no", "job_card_id", "invoice_workshop_name", "sell_lead_id", "registration_no",
    "car_city", "invoice_created_at", "refurb_category", "in_date", "out_date",
)


def refurb_cost(
    invoices: DataFrame,
    line_costs: DataFrame,
    advisors: DataFrame,
    *,
    categories: Sequence[str] = REFURB_CATEGORIES,
    factor: str | None = COST_FACTOR,
    out_type: str | None = None,
) -> DataFrame:
    """Cost per (sell_lead_id, reg_no).

    invoices   one row per invoice (duplicates multiply, as in the source): invoice_id and
               the INVOICE_KEYS columns; ``refurb_category`` is the raw (fallback-applied)
               category. Filters on invoice time / workshop belong to the caller.
    line_costs job rows: invoice_id, line_cost (null cost -> the row adds nothing).
    advisors   job-card users: job_card_id, advisor_name (one row per user).
    """
    per_invoice = line_costs.groupBy("invoice_id").agg(F.sum("line_cost").alias("_lines"))
    named = advisors.groupBy("job_card_id", "advisor_name").agg(F.count(F.lit(1)).alias("_copies"))

    rows = (invoices.join(per_invoice, "invoice_id", "left")
                    .join(named, "job_card_id", "left"))
    rows = rows.withColumn("_cost", F.col("_lines") * F.coalesce(F.col("_copies"), F.lit(1)))

    # The rank reads grouping columns only, so it is the same before the grouping, and only its rows are grouped.
    first = dense_rank_first(rows, ["invoice_no", "registration_no"], "advisor_name")
    level1 = first.groupBy(*INVOICE_KEYS, "advisor_name").agg(F.sum("_cost").alias("_cost"))
    norm = sentinel_normalise("refurb_category", CATEGORY_SENTINELS, CATEGORY_DEFAULT)
    kept = level1.filter(norm.isin(*categories))
    total = kept.groupBy("sell_lead_id", "registration_no").agg(F.sum("_cost").alias("_total"))
    value = scaled("_total", factor) if factor else F.col("_total")
    if out_type:
        value = value.cast(out_type)
    return total.select("sell_lead_id", F.col("registration_no").alias("reg_no"),
                        value.alias("actual_refurb_cost"))


def refurb_inputs_from_tables(
    tables: Mapping[str, DataFrame],
    city_rules: Sequence[tuple[str, str]],
    *,
    created_floor: str = "2021-01-01",
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Build the three inputs of ``refurb_cost`` from the workshop tables (FIXTURES.md §1 names).

    Joins that feed no output column and cannot change the row count (unique-key lookups of
    tax codes, fixes, bay types, trading customers, inspectors, photo counts, and the job card
    whose only effect after the invoice-time filter is to add rows without an invoice) are left
    out. ``city_rules`` buckets the vehicle workshop name into a city (first match wins,
    default 'Others').
    """
    inv = tables["invoice"]
    invoices = (inv.filter(local_floor("created_at", created_floor))
                .select(F.col("id").alias("invoice_id"), "invoice_no", "job_card_id", "car_id",
                        "refurb_car_id", "vendor_id", local_time("created_at").alias("invoice_created_at"),
                        "in_date", "out_date"))
    vendor = tables["workshop"].select(F.col("id").alias("_vendor"), F.col("name").alias("invoice_workshop_name"))
    meta = tables["invoice_meta"].select(F.col("invoice_id").alias("_meta_invoice"),
                                         F.col("refurb_category").alias("_invoice_category"))
    car = tables["car"].select(F.col("id").alias("_car"), F.col("object_id").alias("sell_lead_id"), "registration_no")
    rcar = tables["refurb_car"].select(F.col("id").alias("_rcar"), F.col("refurb_category").alias("_car_category"),
                                       F.col("workshop_id").alias("_rcar_workshop"))
    city = tables["workshop"].select(F.col("id").alias("_city_ws"),
                                     pattern_bucket("name", city_rules, "Others").alias("car_city"))
    invoices = (invoices
                .join(vendor, F.col("_vendor") == F.col("vendor_id"), "left")
                .join(meta, F.col("_meta_invoice") == F.col("invoice_id"), "left")
                .join(car, F.col("_car") == F.col("car_id"), "left")
                .join(rcar, F.col("_rcar") == F.col("refurb_car_id"), "left")
                .join(city, F.col("_city_ws") == F.col("_rcar_workshop"), "left")
                .filter(F.col("invoice_workshop_name").isNotNull())
                .select("invoice_id", "invoice_no", "job_card_id", "invoice_workshop_name", "sell_lead_id",
                        "registration_no", "car_city", "invoice_created_at",
                        null_fallback("_car_category", "_invoice_category").alias("refurb_category"),
                        "in_date", "out_date"))
    rows = tables["job_row"]
    line_costs = rows.select("invoice_id",
                             (F.col("part_count") * F.col("part_cost") + F.col("labour_cost")).alias("line_cost"))
    users = tables["refurb_user"].select(F.col("id").alias("_user"),
                                         full_name("first_name", "last_name", lower=True).alias("advisor_name"))
    advisors = (tables["job_card_user"].join(users, F.col("_user") == F.col("user_id"), "left")
                .select("job_card_id", "advisor_name"))
    return invoices, line_costs, advisors
