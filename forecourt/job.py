"""End-to-end run: reconditioning cost, deal master, margin base, publication.

    python -m forecourt.job --layout test --data /path/to/sf0.01 --copies 12 --as-of 2001-08-01
    python -m forecourt.job --layout warehouse --data /path/to/tables --rules rules.json --as-of 2022-03-31T10:00

``--layout test`` reads the driver's test tables and uses their role mapping;
``--layout warehouse`` reads ``<data>/<name>.parquet`` for every logical table name of
FIXTURES.md (``invoice``, ``deal``, ...) and a JSON file with the bucket rules and the buy-lead
category:
{"category": "...", "city_rules": [["%pattern%", "City"], ...], "hub_rules": [...],
 "url_rules": [...], "source_labels": [[187, "Label"], ...], "direct_label": "..."}.
``source_labels`` are added to the known ones; every code of ``SOURCE_CODES`` must have a label.
Targets go under ``--out`` (default: ``<spark.checkpoint.dir>/published``), which must be
storage every executor sees.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from forecourt.session import build_session, scratch_path, shared_dir, written
from forecourt.sinks.publish import fingerprint, publish_margin, publish_table, stage_table

WORKSHOP_TABLES = ("invoice", "workshop", "invoice_meta", "car", "refurb_car", "job_row", "refurb_user",
                   "job_card_user")
DEAL_TABLES = ("deal", "status", "buy_lead", "lead", "lead_profile", "listing", "hub", "make", "model", "variant",
               "user_task", "user", "contact", "content_type", "visit", "procured_car", "price_value",
               "payment_order", "payment", "payment_item", "contract", "receivable", "refund_request",
               "registration_check", "loan_app", "bank_loan_app", "bank", "loan_log", "web_article", "platform",
               "ext_request", "ext_listing", "platform_account")


Products = tuple[Callable[[], DataFrame], Callable[[], DataFrame]]


def products_test_layout(spark: SparkSession, data: str) -> Products:
    """Builders of (deal master, refurb cost) on the test tables."""
    from forecourt.plans.deals import deal_master_shared
    from forecourt.plans.refurb import refurb_cost
    from forecourt.plans.refurb_testdata import refurb_inputs
    from forecourt.sources.tables import Tables

    return (lambda: deal_master_shared(Tables(spark, data)),
            lambda: refurb_cost(*refurb_inputs(Tables(spark, data)), out_type="double"))


def products_warehouse_layout(spark: SparkSession, data: str, rules: dict) -> Products:
    """Builders of (deal master, refurb cost) on the warehouse-shaped tables."""
    from forecourt.plans.deal_master_tables import deal_master_from_tables
    from forecourt.plans.refurb import refurb_cost, refurb_inputs_from_tables
    from forecourt.sources.tables import read_table

    def pairs(name: str) -> list[tuple]:
        return [tuple(r) for r in rules.get(name, [])]

    def refurb() -> DataFrame:
        tables = {name: read_table(spark, data, name) for name in WORKSHOP_TABLES}
        return refurb_cost(*refurb_inputs_from_tables(tables, pairs("city_rules")))

    def deals() -> DataFrame:
        tables = {name: read_table(spark, data, name) for name in DEAL_TABLES}
        return written(deal_master_from_tables(
            tables, category=rules["category"], hub_rules=pairs("hub_rules"), url_rules=pairs("url_rules"),
            direct_label=rules.get("direct_label", "Other Direct"), source_labels=pairs("source_labels")), "deal-master")

    return deals, refurb


def run(spark: SparkSession, layout: str, data: str, out: str | None, copies: int, as_of: dt.datetime,
        rules: dict | None = None, run_id: str | None = None, fmt: str = "parquet") -> dict[str, list[str]]:
    """Refurb cost is staged first; the margin base merges the deal master with that written
    table, so the refurb plan runs once and the margin lineage starts at a committed table.

    With ``run_id`` both products are staged under ``<spark.checkpoint.dir>/staging/<run_id>``:
    rerunning the same run id after a driver failure reuses whatever was committed from the same
    input files, rules and reference time; a product whose stage is found is not even built, so no job reads the
    source tables for it. ``fmt="csv"`` publishes the margin targets as
    blank-filled text with a header. Targets are read with ``sinks.published_table``.
    """
    from forecourt.plans.deal_master_tables import margin_base_from_tables
    from forecourt.plans.margin import MONEY_COLUMNS

    stamp = fingerprint(spark, [data], layout=layout, rules=rules, as_of=as_of.isoformat())
    if layout == "test":
        deals, refurb = products_test_layout(spark, data)
    else:
        deals, refurb = products_warehouse_layout(spark, data, rules or {})
    base = out or shared_dir(spark, "published")
    stage = shared_dir(spark, f"staging/{run_id}") if run_id else scratch_path(spark, "staging")
    refurb_table = stage_table(refurb, f"{stage}/refurb_cost", stamp, spark=spark)
    publish_table(refurb_table, f"{base}/refurb_cost")
    done = publish_margin(
        lambda: margin_base_from_tables(deals(), refurb_table), refurb_table, full_targets=[f"{base}/margin_{i:02d}" for i in range(copies)],
        trailing_target=f"{base}/margin_trailing", refurb_target=None, as_of=as_of, fmt=fmt,
        staging=f"{stage}/margin_base", stamp=stamp, money_scale=MONEY_COLUMNS)
    done["refurb"] = [f"{base}/refurb_cost"]
    return done


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    p.add_argument("--layout", choices=("test", "warehouse"), default="test")
    p.add_argument("--data", required=True)
    p.add_argument("--out")
    p.add_argument("--copies", type=int, default=12)
    p.add_argument("--as-of", required=True, help="reference time of the trailing window (ISO format)")
    p.add_argument("--rules", help="JSON file with rules (warehouse layout)")
    p.add_argument("--format", choices=("parquet", "csv"), default="parquet",
                   help="format of the margin targets; csv is the blank-filled text export")
    p.add_argument("--run-id", help="stage results under this id; rerunning it resumes")
    a = p.parse_args(argv)
    rules = json.load(open(a.rules)) if a.rules else None
    spark = build_session(app_name="forecourt-job")
    published = run(spark, a.layout, a.data, a.out, a.copies, dt.datetime.fromisoformat(a.as_of), rules, a.run_id,
                  a.format)
    print(json.dumps(published))


if __name__ == "__main__":
    main()
