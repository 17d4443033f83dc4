"""Rule tables: the loan-status decision table and code dispatch.

A long CASE over three keys is a table lookup. The rules live in small frames (their size is
fixed, so broadcasting them is safe at any data size) and are joined on equality; the first
tier that matches wins, then the default. Keys are unique inside each tier, so arm order only
matters between tiers, and the join gives exactly what the first-match CASE gives.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------------------------
# Fixed values (must equal the source workload's for identical results).
# Deal status descriptions, their display labels, and the loan-flow decision table:
# tier 3 = (lead_status, bank_status, deal_status) -> loan_flow_status, in source order;
# tier 2 = (lead_status, deal_status) -> loan_flow_status, any bank status, in source order;
# default 'Others'. A deal without a loan application gets null (no row), not the default.
# ---------------------------------------------------------------------------------------------
DEAL_CANCELLED = "Deal Cancelled"
TOKEN_COLLECTED = "Token Collected"
DELIVERY_DONE = "Delivery Done"
CAR_RETURNED = "Car Returned"
CAR_DELIVERED = "Car Delivered"
DEFAULT_STATUS = "default-status"
EXCLUDED_DEAL_STATUSES = ("deal requested", "deal expired")

DEAL_STATUS_LABELS = {
    "Token Collected": "Pending",
    "Deal Cancelled": "Cancelled",
    "Delivery Done": "Delivered",
    "Car Returned": "Delivered+3 Day Return",
}

LOAN_RULES_3 = [
    (0, 0, "Deal Cancelled", "Customer Not Interested"),
    (0, 0, "Token Collected", "Loan Logged In"),
    (1, 0, "Deal Cancelled", "Customer Not Interested"),
    (1, 0, "Delivery Done", "Customer Not Interested"),
    (3, 0, "Deal Cancelled", "Application Rejected - Loan not possible"),
    (4, 0, "Deal Cancelled", "Customer Not Interested"),
    (4, 0, "Token Collected", "Customer Not Interested"),
    (5, 0, "Deal Cancelled", "Customer Not Interested"),
    (5, 0, "Token Collected", "Loan Logged In"),
    (6, 0, "Deal Cancelled", "Customer Not Interested"),
    (6, 0, "Token Collected", "Loan Logged In"),
    (6, 0, "Delivery Done", "Loan Logged In"),
    (1, 1, "Deal Cancelled", "Customer Not Interested"),
    (1, 1, "Delivery Done", "Customer Not Interested"),
    (3, 1, "Deal Cancelled", "Application Rejected - Loan not possible"),
    (4, 1, "Deal Cancelled", "Customer Not Interested"),
    (4, 1, "Delivery Done", "Customer Not Interested"),
    (5, 1, "Token Collected", "Loan Logged In"),
    (6, 1, "Deal Cancelled", "Customer Not Interested"),
    (6, 1, "Token Collected", "Loan Logged In"),
    (1, 2, "Delivery Done", "Customer Not Interested"),
    (1, 2, "Deal Cancelled", "Customer Not Interested"),
    (4, 2, "Deal Cancelled", "Customer Not Interested"),
    (6, 2, "Token Collected", "Additional Documents Required"),
    (1, 3, "Deal Cancelled", "Customer Not Interested"),
    (4, 3, "Deal Cancelled", "Customer Not Interested"),
    (6, 3, "Deal Cancelled", "Customer Not Interested"),
    (0, 4, "Deal Cancelled", "Loan approved - Cancelled by Customer"),
    (1, 4, "Deal Cancelled", "Loan approved - Cancelled by Customer"),
    (2, 4, "Deal Cancelled", "Loan approved - Cancelled by Customer"),
    (4, 4, "Deal Cancelled", "Loan approved - Cancelled by Customer"),
    (4, 4, "Delivery Done", "Loan Approved"),
    (5, 4, "Deal Cancelled", "Loan approved - Cancelled by Customer"),
    (6, 4, "Token Collected", "Loan Approved"),
    (6, 4, "Delivery Done", "Loan Approved"),
    (6, 4, "Deal Cancelled", "Loan approved - Cancelled by Customer"),
    (1, 5, "Deal Cancelled", "Loan Rejected"),
    (3, 5, "Token Collected", "Loan Rejected"),
    (3, 5, "Deal Cancelled", "Loan Rejected"),
    (4, 5, "Deal Cancelled", "Loan Rejected"),
    (4, 5, "Delivery Done", "Loan Rejected"),
    (4, 5, "Token Collected", "Loan Rejected"),
    (6, 5, "Token Collected", "Loan Rejected"),
    (6, 5, "Delivery Done", "Loan Rejected"),
    (6, 5, "Deal Cancelled", "Loan Rejected"),
    (0, 6, "Delivery Done", "Loan Kit Signed"),
    (4, 6, "Deal Cancelled", "Loan approved - Cancelled by Customer"),
    (4, 6, "Delivery Done", "Loan Kit Signed"),
    (4, 6, "Token Collected", "Loan Kit Signed"),
    (6, 6, "Deal Cancelled", "Loan approved - Cancelled by Customer"),
    (6, 6, "Delivery Done", "Loan Kit Signed"),
    (6, 6, "Token Collected", "Loan Kit Signed"),
    (6, 6, "Car Returned", "Loan Kit Signed"),
    (0, 7, "Delivery Done", "Loan Disbursed"),
    (5, 7, "Delivery Done", "Loan Disbursed"),
    (6, 7, "Deal Cancelled", "Loan approved - Cancelled by Customer"),
    (6, 7, "Delivery Done", "Loan Disbursed"),
    (6, 7, "Token Collected", "Loan Disbursed"),
    (6, 7, "Car Returned", "Loan Disbursed"),
    (1, 8, "Deal Cancelled", "Loan approved - Cancelled by Customer"),
    (1, 8, "Delivery Done", "Loan approved - Cancelled by Customer"),
    (4, 8, "Deal Cancelled", "Loan approved - Cancelled by Customer"),
    (4, 8, "Delivery Done", "Loan approved - Cancelled by Customer"),
]

LOAN_RULES_2 = [
    (0, "default-status", "Application received"),
    (0, "Token Collected", "Application received"),
    (0, "Delivery Done", "Application received"),
    (0, "Car Returned", "Application received"),
    (0, "Car Delivered", "Application received"),
    (0, "Deal Cancelled", "Customer Not Interested"),
    (1, "Token Collected", "Customer Not Interested"),
    (1, "Delivery Done", "Customer Not Interested"),
    (1, "Deal Cancelled", "Customer Not Interested"),
    (2, "Token Collected", "Application received"),
    (2, "Deal Cancelled", "Customer Not Interested"),
    (3, "Deal Cancelled", "Application Rejected - Loan not possible"),
    (4, "Token Collected", "AUTO_CLOSED"),
    (4, "Deal Cancelled", "AUTO_CLOSED"),
    (4, "Delivery Done", "AUTO_CLOSED"),
    (5, "Deal Cancelled", "Customer Not Interested"),
    (5, "Token Collected", "Documents received"),
    (5, "Delivery Done", "Documents received"),
    (6, "Token Collected", "Loan Logged In"),
    (6, "Delivery Done", "Loan Logged In"),
]

LOAN_DEFAULT = "Others"


def _check_unique(rules: Sequence[tuple], width: int) -> None:
    keys = [r[:width] for r in rules]
    if len(set(keys)) != len(keys):
        raise ValueError("decision-table keys must be unique inside a tier")


_check_unique(LOAN_RULES_3, 3)
_check_unique(LOAN_RULES_2, 2)

def _values(spark: SparkSession, rows: Sequence[tuple], columns: str) -> DataFrame:
    """Rows of whole numbers and strings as an inline table (a local relation of the plan)."""
    def cell(v) -> str:
        return str(v) if isinstance(v, int) else "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
    inline = ", ".join("(" + ", ".join(map(cell, r)) + ")" for r in rows)
    return spark.sql(f"SELECT * FROM VALUES {inline} AS t({columns})")


def rule_frames(spark: SparkSession, tier3=LOAN_RULES_3, tier2=LOAN_RULES_2) -> tuple[DataFrame, DataFrame]:
    return (_values(spark, tier3, "_r3_lead, _r3_bank, _r3_deal, _r3_out"),
            _values(spark, tier2, "_r2_lead, _r2_deal, _r2_out"))


def decision_table(
    df: DataFrame,
    lead: str,
    bank: str,
    deal: str,
    out: str = "loan_flow_status",
    *,
    tier3=LOAN_RULES_3,
    tier2=LOAN_RULES_2,
    default: str = LOAN_DEFAULT,
) -> DataFrame:
    """Add ``out`` from the two-tier rule table; broadcast hash joins, no shuffle of ``df``.

    Equality never matches null, so a null bank status skips tier 3 and a null lead or deal
    status falls through to the default, exactly as in the CASE form.
    """
    r3, r2 = rule_frames(df.sparkSession, tier3, tier2)
    joined = (
        df.join(F.broadcast(r3),
                (F.col(lead) == F.col("_r3_lead")) & (F.col(bank) == F.col("_r3_bank"))
                & (F.col(deal) == F.col("_r3_deal")), "left")
          .join(F.broadcast(r2),
                (F.col(lead) == F.col("_r2_lead")) & (F.col(deal) == F.col("_r2_deal")), "left")
    )
    return joined.withColumn(out, F.coalesce("_r3_out", "_r2_out", F.lit(default))).drop(
        "_r3_lead", "_r3_bank", "_r3_deal", "_r3_out", "_r2_lead", "_r2_deal", "_r2_out")


def decision_case(lead: Column, bank: Column, deal: Column, *, tier3=LOAN_RULES_3,
                  tier2=LOAN_RULES_2, default: str = LOAN_DEFAULT) -> Column:
    """The same decision as one first-match CASE expression (used to cross-check the join)."""
    expr = None
    for le, ba, de, res in tier3:
        cond = (lead == le) & (bank == ba) & (deal == de)
        expr = F.when(cond, F.lit(res)) if expr is None else expr.when(cond, F.lit(res))
    for le, de, res in tier2:
        expr = expr.when((lead == le) & (deal == de), F.lit(res))
    return expr.otherwise(F.lit(default))


def decision_case_sql(lead: str, bank: str, deal: str, *, tier3=LOAN_RULES_3,
                      tier2=LOAN_RULES_2, default: str = LOAN_DEFAULT) -> str:
    """The CASE form as SQL text, for an independent SQL engine."""
    def q(s: str) -> str:
        return "'" + s.replace("'", "''") + "'"
    arms = [f"WHEN {lead} = {le} AND {bank} = {ba} AND {deal} = {q(de)} THEN {q(res)}"
            for le, ba, de, res in tier3]
    arms += [f"WHEN {lead} = {le} AND {deal} = {q(de)} THEN {q(res)}" for le, de, res in tier2]
    return "CASE " + " ".join(arms) + f" ELSE {q(default)} END"


def code_dispatch(code: Column, branches: Sequence[tuple[object, Column]], default: Column) -> Column:
    """``CASE WHEN code = c1 THEN e1 ... WHEN code IN (...) THEN ek ELSE default END``.

    A branch key that is a tuple/list means membership.
    """
    expr = None
    for key, value in branches:
        cond = code.isin(*key) if isinstance(key, (tuple, list)) else code == F.lit(key)
        expr = F.when(cond, value) if expr is None else expr.when(cond, value)
    return expr.otherwise(default) if expr is not None else default
