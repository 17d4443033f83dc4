"""Operator-level queries on the test tables (one per inventory key).

Each function reads the given tables through the library operators; the SQL next to it is the
same query for an independent engine. Money is summed as decimal(18,2) and returned as double
so both engines produce the same value whatever the order of addition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forecourt.functions import columns as C
from forecourt.functions import rules
from forecourt.operators import aggs, joins, latest, windows
from forecourt.plans import roles
from forecourt.plans.registry import register
from forecourt.session import sized_session
from forecourt.sources.tables import Tables, positional_rename, scan_project_rename

DBL = "double"


# --- scans and projections -------------------------------------------------------------------

@register("scan_project_rename", """
SELECT l_orderkey AS invoice_id, l_partkey AS part_id, l_suppkey AS workshop_id, l_quantity AS part_count
FROM lineitem""")
def scan_project_rename_q(spark: SparkSession, d: str) -> DataFrame:
    return scan_project_rename(Tables(spark, d).lineitem, {
        "l_orderkey": "invoice_id", "l_partkey": "part_id", "l_suppkey": "workshop_id",
        "l_quantity": "part_count"})


@register("positional_rename", """
SELECT o_custkey AS sell_lead_id, o_orderpriority AS reg_no,
       CAST(0.82 * CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS actual_refurb_cost
FROM orders""")
def positional_rename_q(spark: SparkSession, d: str) -> DataFrame:
    o = Tables(spark, d).orders
    unnamed = o.select("o_custkey", "o_orderpriority",
                       C.scaled(C.money("o_totalprice"), "0.82").cast(DBL))
    return positional_rename(unnamed, ["sell_lead_id", "reg_no", "actual_refurb_cost"])


@register("literal_columns", """
SELECT o_orderkey AS deal_id, 4800 AS paper_transfer_cost, 1500 AS warranty_cost FROM orders""")
def literal_columns_q(spark: SparkSession, d: str) -> DataFrame:
    return Tables(spark, d).orders.select(
        F.col("o_orderkey").alias("deal_id"), F.lit(4800).alias("paper_transfer_cost"),
        F.lit(1500).alias("warranty_cost"))


@register("line_cost_arith", f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       CAST(part_count * part_cost AS DOUBLE) AS actual_part_cost,
       CAST(part_count * part_cost + labour_cost AS DOUBLE) AS actual_refurb_cost,
       CAST(0.82 * part_cost AS DOUBLE) AS discounted_cost
FROM (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
             {roles.LINE_COST_SQL['part_count']} AS part_count,
             {roles.LINE_COST_SQL['part_cost']} AS part_cost,
             {roles.LINE_COST_SQL['labour_cost']} AS labour_cost
      FROM lineitem) x""")
def line_cost_arith_q(spark: SparkSession, d: str) -> DataFrame:
    lc = roles.line_cost_columns()
    rows = Tables(spark, d).lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        *[v.alias(k) for k, v in lc.items()])
    return rows.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        (F.col("part_count") * F.col("part_cost")).cast(DBL).alias("actual_part_cost"),
        (F.col("part_count") * F.col("part_cost") + F.col("labour_cost")).cast(DBL).alias("actual_refurb_cost"),
        C.scaled("part_cost", "0.82").cast(DBL).alias("discounted_cost"))


@register("null_fallback", """
SELECT o_orderkey,
       CASE WHEN NULLIF(o_orderstatus, 'P') IS NULL THEN o_orderpriority ELSE NULLIF(o_orderstatus, 'P') END
         AS status_or_priority
FROM orders""")
def null_fallback_q(spark: SparkSession, d: str) -> DataFrame:
    o = Tables(spark, d).orders
    return o.select("o_orderkey", C.null_fallback(C.nullif("o_orderstatus", F.lit("P")),
                                                  "o_orderpriority").alias("status_or_priority"))


@register("sentinel_normalise", """
SELECT o_orderkey,
       CASE WHEN p IS NULL THEN 'REFURB' WHEN p = '4-NOT SPECIFIED' THEN 'REFURB' ELSE p END AS refurb_category
FROM (SELECT o_orderkey, NULLIF(o_orderpriority, '5-LOW') AS p FROM orders) x""")
def sentinel_normalise_q(spark: SparkSession, d: str) -> DataFrame:
    o = Tables(spark, d).orders.select("o_orderkey", C.nullif("o_orderpriority", F.lit("5-LOW")).alias("p"))
    return o.select("o_orderkey", C.sentinel_normalise("p", ["4-NOT SPECIFIED"], "REFURB").alias("refurb_category"))


@register("value_relabel", f"""
SELECT o_orderkey, {roles.DEAL_STATUS_LABEL_SQL.format(d='d')} AS deal_status
FROM (SELECT o_orderkey, {roles.DEAL_DESC_SQL} AS d FROM orders) x""")
def value_relabel_q(spark: SparkSession, d: str) -> DataFrame:
    o = Tables(spark, d).orders.select("o_orderkey", roles.deal_desc().alias("d"))
    return o.select("o_orderkey", C.relabel("d", rules.DEAL_STATUS_LABELS).alias("deal_status"))


PART_NAME_RULES = [("%widget%", "Widgets"), ("%red%", "Red parts"), ("%ring%", "Rings"),
                   ("hot%", "Hot parts"), ("%gear%", "Gears")]
PART_TYPE_RULES = [("%PROMO%", "Promo"), ("%LARGE%", "Large"), ("%SMALL%", "Small")]
PART_SOURCE_RULES = [("ECON%", "Economy"), ("%PROMO%", "Promotion"), ("%large%", "lower-case large"),
                     ("STANDARD", "Standard")]


def _case_like_sql(col: str, rules_: list[tuple[str, str]], default_sql: str) -> str:
    arms = " ".join(f"WHEN {col} LIKE '{p}' THEN '{v}'" for p, v in rules_)
    return f"CASE {arms} ELSE {default_sql} END"


@register("pattern_bucket_const", f"""
SELECT p_partkey, {_case_like_sql('p_name', PART_NAME_RULES, "'Others'")} AS part_group,
       {_case_like_sql('p_type', PART_TYPE_RULES, "'Others'")} AS type_group
FROM part""")
def pattern_bucket_const_q(spark: SparkSession, d: str) -> DataFrame:
    p = Tables(spark, d).part
    return p.select("p_partkey", C.pattern_bucket("p_name", PART_NAME_RULES, "Others").alias("part_group"),
                    C.pattern_bucket("p_type", PART_TYPE_RULES, "Others").alias("type_group"))


@register("pattern_bucket_passthru", f"""
SELECT p_partkey, src AS part_source, src || ' - Part type' AS part_source_suffixed
FROM (SELECT p_partkey, {_case_like_sql('p_type', PART_SOURCE_RULES, 'p_type')} AS src FROM part) x""")
def pattern_bucket_passthru_q(spark: SparkSession, d: str) -> DataFrame:
    p = Tables(spark, d).part.select(
        "p_partkey", C.pattern_bucket("p_type", PART_SOURCE_RULES, passthrough=True).alias("part_source"))
    return p.select("p_partkey", "part_source", C.with_suffix("part_source", " - Part type").alias("part_source_suffixed"))


FACILITATION_SQL = "CASE l_returnflag WHEN 'N' THEN 0 WHEN 'R' THEN 1 ELSE 2 END"
SELF_SQL = "CASE l_linestatus WHEN 'F' THEN 1 ELSE 0 END"


@register("flag_labels", f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       CASE WHEN f = 0 THEN 'No' WHEN f = 1 THEN 'Yes' END AS loan_interest,
       CASE WHEN f = 1 AND s = 1 THEN 'Yes' WHEN f = 1 AND s = 0 THEN 'No' ELSE NULL END AS self_loan_interest,
       CASE WHEN s = 1 THEN 'Yes-Self Loan' WHEN f = 1 THEN 'Yes' ELSE 'No' END AS loanyn
FROM (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {FACILITATION_SQL} AS f, {SELF_SQL} AS s
      FROM lineitem) x""")
def flag_labels_q(spark: SparkSession, d: str) -> DataFrame:
    rf, ls = F.col("l_returnflag"), F.col("l_linestatus")
    rows = Tables(spark, d).lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.when(rf == "N", 0).when(rf == "R", 1).otherwise(2).alias("f"),
        F.when(ls == "F", 1).otherwise(0).alias("s"))
    return rows.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        C.flag_label("f").alias("loan_interest"),
        C.two_flag_label("f", "s").alias("self_loan_interest"),
        C.three_way_label("s", "f", "Yes-Self Loan", "Yes", "No").alias("loanyn"))


# --- decision table --------------------------------------------------------------------------

DT_LEAD_SQL = ("CAST(SUBSTR(o_orderpriority, 1, 1) AS INTEGER) + "
               "CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 ELSE -1 END")
DT_BANK_SQL = ("CASE WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN 4 WHEN l_returnflag = 'A' THEN 6 "
               "WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 5 WHEN l_returnflag = 'R' THEN 7 "
               "WHEN l_linestatus = 'F' THEN 0 END")


def _dt_inputs(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    st, rf, ls = F.col("o_orderstatus"), F.col("l_returnflag"), F.col("l_linestatus")
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus")
    orders = t.orders.select("o_orderkey", "o_orderstatus", "o_orderpriority")
    j = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return j.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        (F.substring("o_orderpriority", 1, 1).cast("int")
         + F.when(st == "F", 1).when(st == "O", 0).otherwise(-1)).alias("lead_status"),
        F.when((rf == "A") & (ls == "F"), 4).when(rf == "A", 6).when((rf == "R") & (ls == "F"), 5)
         .when(rf == "R", 7).when(ls == "F", 0).alias("bank_status"),
        roles.deal_desc().alias("deal_status"))


@register("decision_table", f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, lead_status, bank_status, deal_status,
       {rules.decision_case_sql('lead_status', 'bank_status', 'deal_status')} AS loan_flow_status
FROM (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {DT_LEAD_SQL} AS lead_status,
             {DT_BANK_SQL} AS bank_status, {roles.DEAL_DESC_SQL} AS deal_status
      FROM lineitem JOIN orders ON o_orderkey = l_orderkey) x""")
def decision_table_q(spark: SparkSession, d: str) -> DataFrame:
    return rules.decision_table(_dt_inputs(spark, d), "lead_status", "bank_status", "deal_status")


# --- filters ---------------------------------------------------------------------------------

@register("date_floor_filters", """
SELECT o_orderkey, o_custkey, CAST(o_orderdate + INTERVAL 330 MINUTE AS DATE) AS token_date
FROM orders
WHERE CAST(o_orderdate + INTERVAL 330 MINUTE AS DATE) >= DATE '1999-01-01'
  AND o_orderdate + INTERVAL 330 MINUTE >= TIMESTAMP '1998-06-01 00:00:00'
  AND o_orderpriority IS NOT NULL""")
def date_floor_filters_q(spark: SparkSession, d: str) -> DataFrame:
    o = Tables(spark, d).orders
    kept = o.filter(C.local_floor("o_orderdate", "1999-01-01")
                    & (F.col("o_orderdate") >= F.lit("1998-06-01 00:00:00").cast("timestamp_ntz") - C.minutes(330))
                    & F.col("o_orderpriority").isNotNull())
    return kept.select("o_orderkey", "o_custkey", C.local_date("o_orderdate").alias("token_date"))


@register("in_notin_lists", """
SELECT o_orderkey, p AS priority
FROM (SELECT o_orderkey, o_orderstatus, NULLIF(o_orderpriority, '3-MEDIUM') AS p FROM orders) x
WHERE p NOT IN ('1-URGENT', '2-HIGH') AND o_orderstatus IN ('F', 'O')""")
def in_notin_lists_q(spark: SparkSession, d: str) -> DataFrame:
    o = Tables(spark, d).orders.select("o_orderkey", "o_orderstatus",
                                       C.nullif("o_orderpriority", F.lit("3-MEDIUM")).alias("p"))
    return o.filter(~F.col("p").isin("1-URGENT", "2-HIGH") & F.col("o_orderstatus").isin("F", "O")).select(
        "o_orderkey", F.col("p").alias("priority"))


@register("semi_join_in_subquery", """
SELECT o_orderkey, o_custkey, o_orderdate FROM orders
WHERE o_orderkey IN (SELECT MAX(o_orderkey) FROM orders GROUP BY o_custkey)""")
def semi_join_in_subquery_q(spark: SparkSession, d: str) -> DataFrame:
    o = Tables(spark, d).orders.select("o_orderkey", "o_custkey", "o_orderdate")
    return latest.latest_per_key(o, ["o_custkey"], "o_orderkey", how="semi")


# --- joins -----------------------------------------------------------------------------------

@register("left_lookup_chain", """
SELECT l.l_orderkey, l.l_linenumber, l.l_suppkey, s.s_name, n.n_name, r.r_name
FROM lineitem l
LEFT JOIN supplier s ON s.s_suppkey = l.l_suppkey
LEFT JOIN nation n ON n.n_nationkey = s.s_nationkey
LEFT JOIN region r ON r.r_regionkey = n.n_regionkey""")
def left_lookup_chain_q(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    return joins.lookup_chain(t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey"), [
        (t.supplier.select("s_suppkey", "s_name", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"), False),
        (t.nation.select("n_nationkey", "n_name", "n_regionkey"), F.col("s_nationkey") == F.col("n_nationkey"), True),
        (t.region, F.col("n_regionkey") == F.col("r_regionkey"), True),
    ]).select("l_orderkey", "l_linenumber", "l_suppkey", "s_name", "n_name", "r_name")


FULL_SINGLE_SQL = """
SELECT o.o_orderkey, o.o_orderdate, l.l_orderkey, l.l_linenumber, l.l_partkey
FROM (SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderstatus = 'F') o
FULL JOIN (SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_returnflag = 'A') l
  ON l.l_orderkey = o.o_orderkey"""


def _full_single(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    o = t.orders.filter(F.col("o_orderstatus") == "F").select("o_orderkey", "o_orderdate")
    l = t.lineitem.filter(F.col("l_returnflag") == "A").select("l_orderkey", "l_linenumber", "l_partkey")
    return joins.full_outer(o, l, F.col("l_orderkey") == F.col("o_orderkey"))


@register("full_outer_single", FULL_SINGLE_SQL)
def full_outer_single_q(spark: SparkSession, d: str) -> DataFrame:
    return _full_single(spark, d)


@register("full_outer_filtered", FULL_SINGLE_SQL + " WHERE o.o_orderdate >= TIMESTAMP '1997-01-01 00:00:00'")
def full_outer_filtered_q(spark: SparkSession, d: str) -> DataFrame:
    return _full_single(spark, d).filter(F.col("o_orderdate") >= F.lit("1997-01-01 00:00:00").cast("timestamp_ntz"))


@register("full_outer_composite", """
SELECT o.o_orderkey, a.min_part, b.min_supp, r.l_orderkey AS r_orderkey, r.l_partkey AS r_partkey,
       r.l_suppkey AS r_suppkey, r.qty
FROM orders o
LEFT JOIN (SELECT l_orderkey, MIN(l_partkey) AS min_part FROM lineitem GROUP BY l_orderkey) a
  ON a.l_orderkey = o.o_orderkey
LEFT JOIN (SELECT l_orderkey, MIN(l_suppkey) AS min_supp FROM lineitem GROUP BY l_orderkey) b
  ON b.l_orderkey = o.o_orderkey
FULL JOIN (SELECT l_orderkey, l_partkey, l_suppkey, CAST(SUM(l_quantity) AS DOUBLE) AS qty
           FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_orderkey, l_partkey, l_suppkey) r
  ON r.l_orderkey = o.o_orderkey AND r.l_partkey = a.min_part AND r.l_suppkey = b.min_supp""")
def full_outer_composite_q(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    # Both per-order minimums come from one aggregate over the lines (one scan, one shuffle).
    mins = t.lineitem.groupBy(F.col("l_orderkey").alias("m_orderkey")).agg(
        F.min("l_partkey").alias("min_part"), F.min("l_suppkey").alias("min_supp"))
    left = t.orders.select("o_orderkey").join(mins, F.col("m_orderkey") == F.col("o_orderkey"), "left")
    r = (t.lineitem.filter(F.col("l_returnflag") == "R")
         .groupBy(F.col("l_orderkey").alias("r_orderkey"), F.col("l_partkey").alias("r_partkey"),
                  F.col("l_suppkey").alias("r_suppkey"))
         .agg(F.sum("l_quantity").cast(DBL).alias("qty")))
    cond = ((F.col("r_orderkey") == F.col("o_orderkey")) & (F.col("r_partkey") == F.col("min_part"))
            & (F.col("r_suppkey") == F.col("min_supp")))
    return joins.full_outer(left, r, cond).select(
        "o_orderkey", "min_part", "min_supp", "r_orderkey", "r_partkey", "r_suppkey", "qty")


@register("inner_join_filtered", """
SELECT o_orderkey, o_custkey, c_name, o_totalprice
FROM orders JOIN customer ON c_custkey = o_custkey WHERE c_mktsegment = 'BUILDING'""")
def inner_join_filtered_q(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    c = t.customer.filter(F.col("c_mktsegment") == "BUILDING").select("c_custkey", "c_name")
    return t.orders.join(c, F.col("c_custkey") == F.col("o_custkey")).select(
        "o_orderkey", "o_custkey", "c_name", "o_totalprice")


@register("left_join_null_reject", """
SELECT o_orderkey, o_custkey, c_mktsegment
FROM orders LEFT JOIN customer ON c_custkey = o_custkey WHERE c_mktsegment <> 'HOUSEHOLD'""")
def left_join_null_reject_q(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    j = t.orders.join(t.customer.select("c_custkey", "c_mktsegment"), F.col("c_custkey") == F.col("o_custkey"), "left")
    return j.filter(F.col("c_mktsegment") != "HOUSEHOLD").select("o_orderkey", "o_custkey", "c_mktsegment")


@register("role_playing_dim", """
SELECT l.l_orderkey, l.l_linenumber, l.l_suppkey, cn.n_name AS customer_nation, sn.n_name AS supplier_nation
FROM lineitem l
JOIN orders o ON o.o_orderkey = l.l_orderkey
LEFT JOIN customer c ON c.c_custkey = o.o_custkey
LEFT JOIN nation cn ON cn.n_nationkey = c.c_nationkey
LEFT JOIN supplier s ON s.s_suppkey = l.l_suppkey
LEFT JOIN nation sn ON sn.n_nationkey = s.s_nationkey""")
def role_playing_dim_q(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    cust_nation = joins.role(t.nation, {"n_nationkey": "cn_key", "n_name": "customer_nation"})
    supp_nation = joins.role(t.nation, {"n_nationkey": "sn_key", "n_name": "supplier_nation"})
    cust = joins.lookup(t.customer.select("c_custkey", "c_nationkey"), cust_nation,
                        F.col("c_nationkey") == F.col("cn_key"), bounded=True)
    supp = joins.lookup(t.supplier.select("s_suppkey", "s_nationkey"), supp_nation,
                        F.col("s_nationkey") == F.col("sn_key"), bounded=True)
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey").join(
        t.orders.select("o_orderkey", "o_custkey"), F.col("o_orderkey") == F.col("l_orderkey"))
    out = joins.lookup(lines, cust, F.col("c_custkey") == F.col("o_custkey"))
    out = joins.lookup(out, supp, F.col("s_suppkey") == F.col("l_suppkey"))
    return out.select("l_orderkey", "l_linenumber", "l_suppkey", "customer_nation", "supplier_nation")


@register("left_join_preagg", """
SELECT c.c_custkey, a.n_orders, a.last_order_date
FROM customer c
LEFT JOIN (SELECT o_custkey, COUNT(o_orderkey) AS n_orders, MAX(o_orderdate) AS last_order_date
           FROM orders WHERE o_orderstatus = 'F' GROUP BY o_custkey) a ON a.o_custkey = c.c_custkey""")
def left_join_preagg_q(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    a = aggs.multi_measure(t.orders.filter(F.col("o_orderstatus") == "F"), ["o_custkey"],
                           {"n_orders": F.count("o_orderkey"), "last_order_date": F.max("o_orderdate")})
    return t.customer.select("c_custkey").join(a, F.col("o_custkey") == F.col("c_custkey"), "left").select(
        "c_custkey", "n_orders", "last_order_date")


@register("left_join_prefiltered", """
SELECT o.o_orderkey, l.l_linenumber, l.l_partkey
FROM orders o
LEFT JOIN (SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_returnflag = 'A') l
  ON l.l_orderkey = o.o_orderkey""")
def left_join_prefiltered_q(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    lines = t.lineitem.filter(F.col("l_returnflag") == "A").select("l_orderkey", "l_linenumber", "l_partkey")
    return t.orders.select("o_orderkey").join(lines, F.col("l_orderkey") == F.col("o_orderkey"), "left").select(
        "o_orderkey", "l_linenumber", "l_partkey")


# --- fan-out sums ----------------------------------------------------------------------------

@register("fanout_sum", """
SELECT c.c_custkey, CAST(SUM(CAST(o.o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS payment_amount
FROM customer c
LEFT JOIN orders o ON o.o_custkey = c.c_custkey
LEFT JOIN events e ON e.user_id = c.c_custkey
GROUP BY c.c_custkey""")
def fanout_sum_q(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    out = aggs.fanout_sum(t.customer.select("c_custkey"), "c_custkey",
                          t.orders.select("o_custkey", C.money("o_totalprice").alias("amount")),
                          "o_custkey", "amount", [(t.events.select("user_id"), "user_id")], "payment_amount")
    return out.select("c_custkey", F.col("payment_amount").cast(DBL).alias("payment_amount"))


@register("fanout_safe_sum", """
SELECT c.c_custkey, CAST(p.amount AS DOUBLE) AS payment_amount
FROM customer c
LEFT JOIN (SELECT o_custkey, SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS amount FROM orders GROUP BY o_custkey) p
  ON p.o_custkey = c.c_custkey""")
def fanout_safe_sum_q(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    out = aggs.fanout_sum(t.customer.select("c_custkey"), "c_custkey",
                          t.orders.select("o_custkey", C.money("o_totalprice").alias("amount")),
                          "o_custkey", "amount", [(t.events.select("user_id"), "user_id")], "payment_amount",
                          dedupe=True)
    return out.select("c_custkey", F.col("payment_amount").cast(DBL).alias("payment_amount"))


# --- null-safe merge -------------------------------------------------------------------------

MERGE_LEFT_SQL = ("SELECT o_orderkey AS deal_id, CASE WHEN o_orderdate >= TIMESTAMP '2001-07-01 00:00:00' "
                  "THEN NULL ELSE o_custkey END AS sell_lead_id FROM orders")
MERGE_RIGHT_SQL = ("SELECT CASE WHEN c_nationkey = 0 THEN NULL ELSE c_custkey END AS sell_lead_id, "
                   "c_name AS reg_no, CAST(c_acctbal AS DECIMAL(18,2)) AS actual_refurb_cost FROM customer "
                   "UNION ALL "
                   "SELECT CASE WHEN c_nationkey = 0 THEN NULL ELSE c_custkey END AS sell_lead_id, "
                   "c_name || '-2' AS reg_no, CAST(c_acctbal AS DECIMAL(18,2)) AS actual_refurb_cost FROM customer "
                   "WHERE c_mktsegment = 'MACHINERY'")


#: Rows of null x null that a task of the merge should make, the bytes of left rows it reads for them, and the left rows of a cell.
NULL_PAIRS_A_TASK, MERGE_LEFT_BYTES, MERGE_LEFT_ROWS = 1 << 24, 1 << 20, 1 << 14


def _merge_sides(t: Tables) -> tuple[DataFrame, DataFrame]:
    left = t.orders.select(
        F.col("o_orderkey").alias("deal_id"),
        F.when(F.col("o_orderdate") >= F.lit("2001-07-01 00:00:00").cast("timestamp_ntz"), F.lit(None).cast("long"))
         .otherwise(F.col("o_custkey")).alias("sell_lead_id"))
    c = t.customer
    key = F.when(F.col("c_nationkey") == 0, F.lit(None).cast("long")).otherwise(F.col("c_custkey")).alias("sell_lead_id")
    # Cast to the result's type here, once per customer row: above the merge it would be done for every pair.
    cost = C.money("c_acctbal").cast(DBL).alias("actual_refurb_cost")
    right = c.select(key, F.col("c_name").alias("reg_no"), cost).unionByName(
        c.filter(F.col("c_mktsegment") == "MACHINERY").select(key, F.concat("c_name", F.lit("-2")).alias("reg_no"), cost))
    return left, right


@register("merge_null_safe", f"""
SELECT l.deal_id, l.sell_lead_id, CAST(r.actual_refurb_cost AS DOUBLE) AS actual_refurb_cost
FROM ({MERGE_LEFT_SQL}) l
LEFT JOIN ({MERGE_RIGHT_SQL}) r ON l.sell_lead_id IS NOT DISTINCT FROM r.sell_lead_id""")
def merge_null_safe_q(spark: SparkSession, d: str) -> DataFrame:
    # The null keys are counted first (jobs that read the key alone): their product sizes the tasks.
    left_nulls, right_nulls = (side.where(F.col("sell_lead_id").isNull()).count() for side in _merge_sides(Tables(spark, d)))
    pairs = left_nulls * right_nulls
    sized = sized_session(spark, pairs * MERGE_LEFT_BYTES // NULL_PAIRS_A_TASK, MERGE_LEFT_BYTES)
    left, right = _merge_sides(Tables(sized, d))
    return joins.merge_null_safe(left, right, "sell_lead_id", null_rows_a_task=MERGE_LEFT_ROWS, right_nulls=right_nulls).drop("reg_no")


# --- aggregates ------------------------------------------------------------------------------

@register("multi_measure_groupby", f"""
SELECT l_orderkey, l_suppkey, COUNT(DISTINCT l_partkey) AS part_fixed_count,
       CAST(SUM(part_count * part_cost) AS DOUBLE) AS actual_part_cost,
       CAST(SUM(labour_cost) AS DOUBLE) AS actual_labour_cost,
       CAST(SUM(part_count * part_cost + labour_cost) AS DOUBLE) AS actual_refurb_cost
FROM (SELECT l_orderkey, l_suppkey, l_partkey,
             {roles.LINE_COST_SQL['part_count']} AS part_count,
             {roles.LINE_COST_SQL['part_cost']} AS part_cost,
             {roles.LINE_COST_SQL['labour_cost']} AS labour_cost FROM lineitem) x
GROUP BY l_orderkey, l_suppkey""")
def multi_measure_groupby_q(spark: SparkSession, d: str) -> DataFrame:
    lc = roles.line_cost_columns()
    rows = Tables(spark, d).lineitem.select("l_orderkey", "l_suppkey", "l_partkey",
                                            *[v.alias(k) for k, v in lc.items()])
    pc, cost, lab = F.col("part_count"), F.col("part_cost"), F.col("labour_cost")
    return aggs.multi_measure(rows, ["l_orderkey", "l_suppkey"], {
        "part_fixed_count": F.countDistinct("l_partkey"),
        "actual_part_cost": F.sum(pc * cost).cast(DBL),
        "actual_labour_cost": F.sum(lab).cast(DBL),
        "actual_refurb_cost": F.sum(pc * cost + lab).cast(DBL),
    })


@register("ranked_dedup_rollup", """
SELECT o_custkey, CAST(SUM(order_cost) AS DOUBLE) AS total_cost
FROM (
  SELECT l_orderkey, o_custkey, SUM(grp_cost) AS order_cost
  FROM (
    SELECT l_orderkey, o_custkey, l_suppkey, advisor_name, grp_cost,
           DENSE_RANK() OVER (PARTITION BY l_orderkey ORDER BY advisor_name ASC NULLS LAST) AS rank_
    FROM (
      SELECT l.l_orderkey, o.o_custkey, l.l_suppkey,
             CASE WHEN s.s_acctbal < 0 THEN NULL ELSE s.s_name END AS advisor_name,
             SUM(CAST(l.l_extendedprice AS DECIMAL(18,2))) AS grp_cost
      FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
      LEFT JOIN supplier s ON s.s_suppkey = l.l_suppkey
      GROUP BY l.l_orderkey, o.o_custkey, l.l_suppkey, CASE WHEN s.s_acctbal < 0 THEN NULL ELSE s.s_name END
    ) g
  ) r
  WHERE rank_ = 1
  GROUP BY l_orderkey, o_custkey
) x
GROUP BY o_custkey""")
def ranked_dedup_rollup_q(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    names = t.supplier.select("s_suppkey", F.when(F.col("s_acctbal") < 0, F.lit(None).cast("string"))
                              .otherwise(F.col("s_name")).alias("advisor_name"))
    lines = (t.lineitem.select("l_orderkey", "l_suppkey", C.money("l_extendedprice").alias("cost"))
             .join(t.orders.select("o_orderkey", "o_custkey"), F.col("o_orderkey") == F.col("l_orderkey"))
             .join(names, F.col("s_suppkey") == F.col("l_suppkey"), "left"))
    groups = lines.groupBy("l_orderkey", "o_custkey", "l_suppkey", "advisor_name").agg(F.sum("cost").alias("grp_cost"))
    first = windows.dense_rank_first(groups, ["l_orderkey"], "advisor_name")
    # SUM per order then per customer is one additive SUM per customer.
    return first.groupBy("o_custkey").agg(F.sum("grp_cost").cast(DBL).alias("total_cost"))


@register("status_event_pivot", """
SELECT u.user_id, a.approved_date, r.rejected_date, g.login_date
FROM (SELECT DISTINCT user_id FROM events WHERE event_type IN ('purchase', 'error', 'signup')) u
LEFT JOIN (SELECT user_id, MAX(ts) + INTERVAL 330 MINUTE AS approved_date FROM events
           WHERE event_type = 'purchase' GROUP BY user_id) a ON a.user_id = u.user_id
LEFT JOIN (SELECT user_id, MIN(ts) + INTERVAL 330 MINUTE AS rejected_date FROM events
           WHERE event_type = 'error' GROUP BY user_id) r ON r.user_id = u.user_id
LEFT JOIN (SELECT user_id, MAX(ts) + INTERVAL 330 MINUTE AS login_date FROM events
           WHERE event_type = 'signup' GROUP BY user_id) g ON g.user_id = u.user_id""")
def status_event_pivot_q(spark: SparkSession, d: str) -> DataFrame:
    e = Tables(spark, d).events
    return aggs.status_pivot(e, "user_id", "ts", "event_type", [
        ("approved_date", "purchase", "max"), ("rejected_date", "error", "min"), ("login_date", "signup", "max"),
    ], offset_minutes=C.LOCAL_OFFSET_MINUTES)


@register("payment_rollup", """
SELECT l.l_orderkey AS deal_id, CAST(SUM(CAST(l.l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS token_amount,
       CAST(MIN(l.l_shipdate) AS DATE) AS token_date
FROM orders o LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey
WHERE o.o_orderstatus = 'F' AND l.l_returnflag = 'N'
GROUP BY l.l_orderkey""")
def payment_rollup_q(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    o = t.orders.filter(F.col("o_orderstatus") == "F").select("o_orderkey")
    l = t.lineitem.filter(F.col("l_returnflag") == "N").select("l_orderkey", "l_extendedprice", "l_shipdate")
    j = o.join(l, F.col("l_orderkey") == F.col("o_orderkey"))
    return aggs.multi_measure(j, ["l_orderkey"], {
        "token_amount": F.sum(C.money("l_extendedprice")).cast(DBL),
        "token_date": F.to_date(F.min("l_shipdate")),
    }).withColumnRenamed("l_orderkey", "deal_id")


WIDE_KEYS = ["o_orderkey", "o_custkey", "c_name", "c_mktsegment", "c_nationkey", "n_name", "r_name",
             "o_orderstatus", "o_orderpriority", "o_orderdate", "o_totalprice", "c_acctbal"]


@register("wide_groupby", f"""
SELECT o_orderkey, o_custkey, c_name, c_mktsegment, n_name, r_name,
       {roles.DEAL_STATUS_LABEL_SQL.format(d='(' + roles.DEAL_DESC_SQL + ')')} AS deal_status,
       CAST(o_orderdate + INTERVAL 330 MINUTE AS DATE) AS token_date,
       CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS sell_price,
       CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS DOUBLE) AS procurement_price,
       4800 AS paper_transfer_cost,
       CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS receivable_amount
FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey
LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
LEFT JOIN region r ON r.r_regionkey = n.n_regionkey
LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey
GROUP BY {', '.join(WIDE_KEYS)}""")
def wide_groupby_q(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    # Lines are summed per order before the join (the group keys all come from the order side,
    # so SUM over the join = SUM over order rows of the per-order line sum).
    per_order = t.lineitem.groupBy(F.col("l_orderkey")).agg(F.sum(C.money("l_extendedprice")).alias("_lines"))
    geo = t.nation.join(F.broadcast(t.region), F.col("n_regionkey") == F.col("r_regionkey"), "left").select(
        "n_nationkey", "n_name", "r_name")
    cust = t.customer.select("c_custkey", "c_name", "c_mktsegment", "c_nationkey", "c_acctbal").join(
        F.broadcast(geo), F.col("n_nationkey") == F.col("c_nationkey"), "left")
    rows = (t.orders.join(cust, F.col("c_custkey") == F.col("o_custkey"))
            .join(per_order, F.col("l_orderkey") == F.col("o_orderkey"), "left"))
    g = rows.groupBy(*WIDE_KEYS).agg(F.sum("_lines").alias("_lines"))
    return g.select(
        "o_orderkey", "o_custkey", "c_name", "c_mktsegment", "n_name", "r_name",
        C.relabel(roles.deal_desc(), rules.DEAL_STATUS_LABELS).alias("deal_status"),
        C.local_date("o_orderdate").alias("token_date"),
        C.money("o_totalprice").cast(DBL).alias("sell_price"),
        C.money("c_acctbal").cast(DBL).alias("procurement_price"),
        F.lit(4800).alias("paper_transfer_cost"),
        F.col("_lines").cast(DBL).alias("receivable_amount"))


@register("hidden_group_key", """
SELECT o_custkey, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_price
FROM orders GROUP BY o_custkey, o_orderpriority""")
def hidden_group_key_q(spark: SparkSession, d: str) -> DataFrame:
    return aggs.group_hidden_key(Tables(spark, d).orders, ["o_custkey"], ["o_orderpriority"],
                                 {"total_price": F.sum(C.money("o_totalprice")).cast(DBL)})


@register("distinct_rows", "SELECT DISTINCT o_custkey, o_orderstatus FROM orders")
def distinct_rows_q(spark: SparkSession, d: str) -> DataFrame:
    return Tables(spark, d).orders.select("o_custkey", "o_orderstatus").distinct()


@register("group_by_expression", """
SELECT CAST(EXTRACT(MONTH FROM ts) AS INTEGER) AS event_month,
       CAST(ts + INTERVAL 330 MINUTE AS DATE) AS local_date, COUNT(*) AS n_events
FROM events
GROUP BY EXTRACT(MONTH FROM ts), CAST(ts + INTERVAL 330 MINUTE AS DATE)""")
def group_by_expression_q(spark: SparkSession, d: str) -> DataFrame:
    e = Tables(spark, d).events
    return e.groupBy(C.month_of("ts").alias("event_month"), C.local_date("ts").alias("local_date")).agg(
        F.count(F.lit(1)).alias("n_events"))


# --- scalar functions ------------------------------------------------------------------------

@register("string_build", f"""
SELECT s.s_suppkey, lower(fn) || ' ' || lower(n.n_name) AS advisor_name, fn || ' ' || n.n_name AS inspector_name,
       fn || ' - Supplier' AS labelled
FROM (SELECT s_suppkey, s_nationkey, CASE WHEN s_acctbal < 0 THEN NULL ELSE s_name END AS fn FROM supplier) s
LEFT JOIN nation n ON n.n_nationkey = s.s_nationkey""")
def string_build_q(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    s = t.supplier.select("s_suppkey", "s_nationkey", F.when(F.col("s_acctbal") < 0, F.lit(None).cast("string"))
                          .otherwise(F.col("s_name")).alias("fn"))
    j = joins.lookup(s, t.nation.select("n_nationkey", "n_name"), F.col("n_nationkey") == F.col("s_nationkey"),
                     bounded=True)
    return j.select("s_suppkey", C.full_name("fn", "n_name", lower=True).alias("advisor_name"),
                    C.full_name("fn", "n_name").alias("inspector_name"),
                    C.with_suffix("fn", " - Supplier").alias("labelled"))


@register("local_time_shift", """
SELECT event_id, ts + INTERVAL 330 MINUTE AS local_ts, CAST(ts + INTERVAL 330 MINUTE AS DATE) AS local_date
FROM events""")
def local_time_shift_q(spark: SparkSession, d: str) -> DataFrame:
    return Tables(spark, d).events.select("event_id", C.local_time("ts").alias("local_ts"),
                                          C.local_date("ts").alias("local_date"))


@register("nullif_dates", """
SELECT l.l_orderkey, l.l_linenumber, l.l_suppkey,
       NULLIF(CAST(CASE WHEN l.l_returnflag = 'A' THEN NULL ELSE l.l_shipdate END AS DATE),
              CAST(CASE WHEN l.l_linestatus = 'O' THEN NULL ELSE o.o_orderdate END AS DATE)) AS approved_rejected_date
FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey""")
def nullif_dates_q(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    j = t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey", "l_returnflag", "l_linestatus", "l_shipdate").join(
        t.orders.select("o_orderkey", "o_orderdate"), F.col("o_orderkey") == F.col("l_orderkey"))
    a = F.to_date(F.when(F.col("l_returnflag") == "A", F.lit(None)).otherwise(F.col("l_shipdate")))
    b = F.to_date(F.when(F.col("l_linestatus") == "O", F.lit(None)).otherwise(F.col("o_orderdate")))
    return j.select("l_orderkey", "l_linenumber", "l_suppkey", C.nullif(a, b).alias("approved_rejected_date"))


# --- latest per key ----------------------------------------------------------------------------

@register("latest_by_semi_join", """
SELECT event_id, user_id, event_type, ts, value FROM events
WHERE event_id IN (SELECT MAX(event_id) FROM events GROUP BY user_id, event_type)""")
def latest_by_semi_join_q(spark: SparkSession, d: str) -> DataFrame:
    e = Tables(spark, d).events.select("event_id", "user_id", "event_type", "ts", "value")
    return latest.latest_per_key(e, ["user_id", "event_type"], "event_id", how="semi")


@register("latest_by_join_back", """
SELECT pv.user_id AS sell_lead_id, pv.value AS listing_price
FROM events pv
JOIN (SELECT MAX(event_id) AS max_id FROM events WHERE event_type = 'purchase' AND value IS NOT NULL
      GROUP BY user_id) mx ON mx.max_id = pv.event_id""")
def latest_by_join_back_q(spark: SparkSession, d: str) -> DataFrame:
    e = Tables(spark, d).events
    cand = e.filter((F.col("event_type") == "purchase") & F.col("value").isNotNull()).select(
        "user_id", "event_id", "value")
    # max_by(value, id) per key: the same rows as the join back because event_id is the key of
    # the log, with one partially aggregated (hash) shuffle instead of an aggregate plus a join.
    top = latest.latest_per_key(cand, ["user_id"], "event_id", how="max_by")
    return top.select(F.col("user_id").alias("sell_lead_id"), F.col("value").alias("listing_price"))


@register("owner_by_max_id", """
SELECT a.l_orderkey, s.s_name AS inside_sales
FROM (SELECT l_orderkey, MAX(l_suppkey) AS finished_by_id FROM lineitem
      WHERE l_returnflag = 'R' AND l_suppkey IS NOT NULL GROUP BY l_orderkey) a
JOIN supplier s ON s.s_suppkey = a.finished_by_id""")
def owner_by_max_id_q(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    return latest.owner_by_max_id(t.lineitem.filter(F.col("l_returnflag") == "R"), "l_orderkey", "l_suppkey",
                                  t.supplier, "s_suppkey", "s_name", "inside_sales")
