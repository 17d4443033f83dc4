"""How the driver's test tables play the workload's roles.

deal = orders, buy lead = sell lead = customer, job row / receivable / token payment = lineitem,
advisor = supplier, city / hub / bank = nation and region, activity log (loan log, visits,
listings, price values, source objects) = events. Role columns are written once, as SQL
expression text: Spark parses it into a Column (``F.expr``) and the independent oracle runs the
same text, so the two cannot drift.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from forecourt.functions.columns import money

# Deal status description from (o_orderstatus, o_orderpriority).
DEAL_DESC_SQL = (
    "CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '5-LOW' THEN 'Car Returned' "
    "WHEN o_orderstatus = 'F' THEN 'Delivery Done' "
    "WHEN o_orderstatus = 'O' AND o_orderpriority = '1-URGENT' THEN 'Deal Cancelled' "
    "WHEN o_orderstatus = 'O' THEN 'Token Collected' "
    "WHEN o_orderpriority = '5-LOW' THEN 'deal expired' "
    "ELSE 'deal requested' END"
)


def deal_desc() -> Column:
    return F.expr(DEAL_DESC_SQL)


DEAL_STATUS_LABEL_SQL = (
    "CASE WHEN {d} = 'Token Collected' THEN 'Pending' WHEN {d} = 'Deal Cancelled' THEN 'Cancelled' "
    "WHEN {d} = 'Delivery Done' THEN 'Delivered' WHEN {d} = 'Car Returned' "
    "THEN 'Delivered+3 Day Return' ELSE {d} END"
)

# Deal flags: loan facilitation 0/1/2 (2 has no label), self loan 0/1.
LOAN_FACILITATION_SQL = (
    "CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 1 "
    "WHEN o_orderpriority = '5-LOW' THEN 2 ELSE 0 END"
)
SELF_LOAN_SQL = "CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END"


def loan_facilitation() -> Column:
    return F.expr(LOAN_FACILITATION_SQL)


def self_loan() -> Column:
    return F.expr(SELF_LOAN_SQL)


# The buy-lead category filter (`category = <segment>` in the source) on customer segments.
LEAD_SEGMENT_SQL = "c_mktsegment <> 'HOUSEHOLD'"


def lead_segment_ok() -> Column:
    return F.expr(LEAD_SEGMENT_SQL)


# Job-row costs: count x unit cost + labour; labour is null when the tax rate is 0, and then
# the whole row adds nothing to a SUM (its part cost is lost too).
LINE_COST_SQL = {
    "part_count": "CAST(l_quantity AS INTEGER)",
    "part_cost": "CAST(l_extendedprice AS DECIMAL(18,2))",
    "labour_cost": "CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(NULLIF(l_tax, 0) AS DECIMAL(4,2))",
}


def cents(column: str) -> Column:
    """A price (two decimals) as a whole number of cents."""
    return F.round(F.col(column) * 100).cast("long")


def from_cents(total: Column) -> Column:
    """A sum of cents as an exact decimal."""
    return (total.cast("decimal(26,0)") * F.lit(Decimal("0.01"))).cast("decimal(28,2)")


def line_cost_units() -> Column:
    """The same line cost as ``part_count * part_cost + labour_cost`` in exact integer units of
    1/10000 (prices and tax rates carry two decimals), so the per-row hot path is long
    arithmetic instead of decimal multiplication; null when the tax rate is 0, as above."""
    price = cents("l_extendedprice")
    tax_pct = F.round(F.nullif(F.col("l_tax"), F.lit(0.0)) * 100).cast("long")
    return F.col("l_quantity").cast("long") * price * 100 + price * tax_pct


UNIT_SCALE = 4


def line_cost_columns() -> dict[str, Column]:
    return {
        "part_count": F.col("l_quantity").cast("int"),
        "part_cost": money("l_extendedprice"),
        "labour_cost": money("l_extendedprice") * F.nullif(F.col("l_tax"), F.lit(0.0)).cast("decimal(4,2)"),
    }


# Advisor (job-card user) names: nation name + region name of the supplier, first name nulled
# for suppliers with a negative balance. Suppliers of one nation share a name.
ADVISOR_FIRST_SQL = "CASE WHEN s_acctbal < 0 THEN NULL ELSE n_name END"


def advisor_first() -> Column:
    return F.expr(ADVISOR_FIRST_SQL)


# Vehicle city buckets over the customer's region (first match wins, else 'Others').
CITY_RULES = [("%AMERICA%", "Americas"), ("%EUROPE%", "Europe"), ("%ASIA%", "Asia"), ("%EAST%", "Middle East")]
# Hub buckets over the region name, input passes through when no rule matches.
HUB_RULES = [("%AMERICA%", "America hub"), ("%EUROPE%", "Europe hub")]

# Refurb category of the vehicle (raw, nullable) and of the invoice (fallback).
CAR_CATEGORY_SQL = (
    "CASE o_orderpriority WHEN '1-URGENT' THEN 'PRE_SALE' WHEN '2-HIGH' THEN 'REFURB' "
    "WHEN '3-MEDIUM' THEN 'N_A' WHEN '5-LOW' THEN 'WARRANTY' END"
)
INVOICE_CATEGORY_SQL = "CASE o_orderstatus WHEN 'F' THEN 'PRE_SALE_REWORK' WHEN 'P' THEN 'BODY_SHOP' END"


def car_category() -> Column:
    return F.expr(CAR_CATEGORY_SQL)


def invoice_category() -> Column:
    return F.expr(INVOICE_CATEGORY_SQL)


# Loan application lead status from the activity type.
LEAD_STATUS_SQL = (
    "CASE event_type WHEN 'signup' THEN 0 WHEN 'view' THEN 1 WHEN 'click' THEN 4 "
    "WHEN 'error' THEN 5 WHEN 'purchase' THEN 6 END"
)


def lead_status(t: Column | None = None) -> Column:
    t = F.col("event_type") if t is None else t
    return (F.when(t == "signup", 0).when(t == "view", 1).when(t == "click", 4)
             .when(t == "error", 5).when(t == "purchase", 6))


# Bank application status and bank from the purchase value.
BANK_STATUS_SQL = "CAST(FLOOR(value / 50) AS INTEGER)"
BANK_ID_SQL = "CAST(FLOOR(value / 20) AS INTEGER)"


def bank_status(value: Column | None = None) -> Column:
    value = F.col("value") if value is None else value
    return F.floor(value / 50).cast("int")


def bank_id(value: Column | None = None) -> Column:
    value = F.col("value") if value is None else value
    return F.floor(value / 20).cast("int")


# Lead-source dispatch on the activity type of the lead's latest event.
ORDER_PRIORITY_RULES = [("1-%", "Urgent orders"), ("2-%", "High orders")]
BRAND_RULES = [("Brand#1%", "Brand family 1"), ("Brand#2%", "Brand family 2")]
INBOUND_TYPES = ("signup", "referral")
