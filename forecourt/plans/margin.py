"""Margin base: the deal master left-merged with reconditioning cost, and its publication."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forecourt.functions import rules
from forecourt.operators.joins import merge_null_safe
from forecourt.plans.contract import DEAL_MASTER_COLUMNS, MARGIN_COLUMNS
from forecourt.plans.deals import DEAL_MASTER_SQL, deal_master_shared
from forecourt.plans.refurb import refurb_cost
from forecourt.plans.refurb_testdata import REFURB_SQL, refurb_inputs
from forecourt.plans.registry import register
from forecourt.session import scratch_path
from forecourt.sinks.publish import (
    TEXT_OPTIONS, publish_snapshot, publish_table, publish_text, published_table, trailing_window,
)
from forecourt.sources.tables import Tables

MONEY_COLUMNS = {"procurement_price": 2, "listing_price": 2, "sell_price": 2, "payment_amount": 2,
                 "token_amount": 2, "net_disbursed_amount": 2, "actual_refurb_cost": 6}
TRAILING_AS_OF = dt.datetime(2001, 8, 1)
TRAILING_DAYS = 90


def margin_base_frame(t: Tables, delivered_from: dt.datetime | None = None) -> DataFrame:
    """Deal master + refurb cost on the sell lead, null keys matching null keys; a vehicle with
    several registrations repeats the deal row. The registration column is dropped and the
    listing date becomes a timestamp (as the export expects). ``delivered_from`` keeps the deals
    delivered at or after that time, filtered before they meet leads and costs."""
    def build() -> DataFrame:
        deals = deal_master_shared(t, delivered_from)
        invoices, line_costs, advisors = refurb_inputs(t, facts=True)
        cost = refurb_cost(invoices, line_costs, advisors, out_type="double")
        leads = t.orders.select(F.col("o_custkey").alias("sell_lead_id"))
        merged = merge_null_safe(deals, cost, "sell_lead_id", left_keys=leads).drop("reg_no")
        merged = merged.withColumn("car_live_date", F.col("car_live_date").cast("timestamp_ntz"))
        return merged.select(*MARGIN_COLUMNS)
    return t.memo(f"margin_base {delivered_from}", build)


def margin_trailing_frame(t: Tables, as_of: dt.datetime, days: int = TRAILING_DAYS) -> DataFrame:
    """The delivered deals of the trailing window, without building the margin rows of all others first: the
    window's lower bound goes to the deal side of the merges, and the window itself is applied to their result."""
    frame = margin_base_frame(t, as_of - dt.timedelta(days=days))
    return trailing_window(frame, "delivery_time", as_of, days, status_col="deal_status",
                           status=rules.DEAL_STATUS_LABELS[rules.DELIVERY_DONE])


def _select_list(prefix: str, cast_live: bool = True) -> str:
    cols = []
    for c in DEAL_MASTER_COLUMNS:
        if c == "car_live_date" and cast_live:
            cols.append(f"CAST({prefix}.car_live_date AS TIMESTAMP) AS car_live_date")
        else:
            cols.append(f"{prefix}.{c}")
    return ", ".join(cols)


MARGIN_SQL = f"""
WITH dm AS ({DEAL_MASTER_SQL}),
rc AS ({REFURB_SQL})
SELECT {_select_list('dm')}, rc.actual_refurb_cost
FROM dm LEFT JOIN rc ON dm.sell_lead_id IS NOT DISTINCT FROM rc.sell_lead_id"""


@register("margin_base", MARGIN_SQL)
def margin_base_q(spark: SparkSession, d: str) -> DataFrame:
    return margin_base_frame(Tables(spark, d))


def _scratch_target(spark: SparkSession, name: str) -> str:
    """A fresh target below the shared folder that goes when the driver exits."""
    return scratch_path(spark, f"snapshots-{name}")


@register("publish_snapshot", MARGIN_SQL)
def publish_snapshot_q(spark: SparkSession, d: str) -> DataFrame:
    """Write the margin base to two snapshot targets in the shared folder, read one back."""
    run = _scratch_target(spark, "full")
    targets = [f"{run}/sheet_a", f"{run}/sheet_b"]
    publish_snapshot(margin_base_frame(Tables(spark, d)), targets)
    return published_table(spark, targets[1])


@register("publish_trailing", f"""
SELECT * FROM ({MARGIN_SQL}) m
WHERE deal_status = 'Delivered'
  AND CAST(delivery_time AS TIMESTAMP) >= TIMESTAMP '{TRAILING_AS_OF:%Y-%m-%d %H:%M:%S}' - INTERVAL {TRAILING_DAYS} DAY""")
def publish_trailing_q(spark: SparkSession, d: str) -> DataFrame:
    """Write the delivered deals of the trailing window to a target, read it back."""
    target = _scratch_target(spark, "trailing")
    publish_table(margin_trailing_frame(Tables(spark, d), TRAILING_AS_OF), target)
    return published_table(spark, target)


def _blank_sql() -> str:
    parts = []
    for c in MARGIN_COLUMNS:
        expr = f"CAST(CAST(m.{c} AS DECIMAL(38,{MONEY_COLUMNS[c]})) AS VARCHAR)" if c in MONEY_COLUMNS \
            else f"CAST(m.{c} AS VARCHAR)"
        parts.append(f"COALESCE({expr}, '') AS {c}")
    return ", ".join(parts)


@register("blank_fill_export", f"SELECT {_blank_sql()} FROM ({MARGIN_SQL}) m")
def blank_fill_export_q(spark: SparkSession, d: str) -> DataFrame:
    """Write the margin base as blank-filled text with a header, read it back."""
    target = _scratch_target(spark, "text")
    publish_text(margin_base_frame(Tables(spark, d)), target, MONEY_COLUMNS)
    return published_table(spark, target, "csv", TEXT_OPTIONS)
