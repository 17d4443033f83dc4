"""Plan-shape checks: the physical plan is the one intended, not just the result."""

import uuid

import pytest

from forecourt.plans import deals
from forecourt.plans.deals import deal_master_frame
from forecourt.plans.margin import TRAILING_AS_OF, margin_base_frame, margin_trailing_frame
from forecourt.plans.refurb import refurb_cost
from forecourt.plans.refurb_testdata import refurb_inputs
from forecourt.plans.registry import QUERIES, load_all
from forecourt.sinks.publish import trailing_window
from forecourt.sources.tables import Tables

load_all()
SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_no_cartesian_product_and_no_python(spark, key):
    if key == "publish_snapshot":
        pytest.skip("writes files; its plan is the margin base plan")
    plan = _plan(QUERIES[key](spark, SF))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    # everything stays in the JVM: no Python UDF evaluation anywhere
    assert "EvalPython" not in plan and "FlatMapGroupsInPandas" not in plan and "MapInPandas" not in plan


def test_null_rejecting_filter_removes_full_outer(spark):
    plan = _plan(QUERIES["full_outer_filtered"](spark, SF))
    assert "FullOuter" not in plan and "LeftOuter" in plan


def test_shifted_date_floor_reaches_the_scan(spark):
    plan = _plan(QUERIES["date_floor_filters"](spark, SF))
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in plan


def test_decision_table_is_a_broadcast_lookup(spark):
    plan = _plan(QUERIES["decision_table"](spark, SF))
    assert plan.count("BroadcastHashJoin") >= 2


def test_scan_reads_only_needed_columns(spark):
    plan = _plan(QUERIES["scan_project_rename"](spark, SF))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_suppkey:bigint,l_quantity:double>" in plan


def test_pivot_scans_the_log_once(spark):
    plan = _plan(QUERIES["status_event_pivot"](spark, SF))
    assert plan.count("FileScan") == 1


def test_merge_reads_each_side_once(spark):
    # orders is the left side, and the null keys of it are counted by a scalar subquery that reads the
    # key alone; the right side is two branches of customer (a union).
    df = QUERIES["merge_null_safe"](spark, SF)
    plan = _plan(df)
    assert plan.count("customer.parquet") == 2
    df.collect()
    assert _plan(df).split("== Initial Plan ==")[0].count("ReusedSubquery") >= 1


def _final(spark, build) -> str:
    """The adaptive plan that ran, with broadcasts off (the large-data case). Building it runs no job."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    sc = spark.sparkContext
    try:
        tables = Tables(spark, SF)
        for name in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"):
            tables[name]  # opening a table looks into its footer
        sc.setJobGroup(group := f"build-{uuid.uuid4().hex}", "")
        df = build(tables).select("*")
        assert not sc.statusTracker().getJobIdsForGroup(group)
        df.collect()
        return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def _scans(plan: str) -> dict[str, int]:
    return {name: plan.count(f"{name}.parquet") for name in ("lineitem", "events", "orders")}


def _refurb(t):
    return refurb_cost(*refurb_inputs(t), out_type="double")


def test_rank_first_prunes_before_the_shuffle(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = QUERIES["ranked_dedup_rollup"](spark, SF)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "WindowGroupLimit" in plan and plan.count("Exchange ") <= 7 and plan.count("lineitem.parquet") <= 1


def test_refurb_cost_reads_each_table_once(spark):
    plan = _final(spark, _refurb)
    assert "WindowGroupLimit" in plan and _scans(plan) == {"lineitem": 1, "events": 0, "orders": 1}
    assert plan.count("Exchange ") - plan.count("BroadcastExchange ") - plan.count("ReusedExchange ") <= 13


@pytest.mark.parametrize("build, orders", [(deal_master_frame, 1), (margin_base_frame, 2)])
def test_deal_products_read_the_big_tables_once(spark, build, orders):
    """No job at build time, so this plan is all that runs: the lines and the log are read once, the orders once for all
    branches by deal and, in the margin base, once for the invoices (with their date floor pushed down)."""
    plan = _final(spark, build)
    assert _scans(plan) == {"lineitem": 1, "events": 1, "orders": orders} and "ReusedExchange" in plan


def test_trailing_window_filters_deals_before_leads_meet_them(spark):
    """Status and date floor go to the deal side: the semi join to the late deliveries is below every lead join, needs no
    exchange of its own, and the big tables are still read as often as for the whole margin base."""
    plan = _final(spark, lambda t: margin_trailing_frame(t, TRAILING_AS_OF))
    assert _scans(plan) == {"lineitem": 1, "events": 1, "orders": 2}
    lines = plan.split("\n")
    depth = [len(line) - len(line.lstrip(" :+-*")) for line in lines]
    semi = next(i for i, line in enumerate(lines) if "LeftSemi" in line and "_recent" in line)
    # the operators above the semi join: the nearest lines before it that are less deep, each time
    above, limit = [], depth[semi]
    for i in range(semi, -1, -1):
        if depth[i] < limit:
            above.append(lines[i])
            limit = depth[i]
    for key in ("c_custkey", "_ev_lead", "_src_lead", "_closer_lead", "_loan_deal"):
        assert any("SortMergeJoin" in line and key in line for line in above), key
    status = [i for i, line in enumerate(lines) if "Filter" in line and "Delivery Done" in line and depth[i] > depth[semi]]
    assert status


def test_trailing_frame_is_the_window_of_the_whole(spark):
    t = Tables(spark, SF)
    for days in (0, 90, 400):
        whole = trailing_window(margin_base_frame(t), "delivery_time", TRAILING_AS_OF, days, status_col="deal_status", status="Delivered")
        got, want = margin_trailing_frame(t, TRAILING_AS_OF, days).collect(), whole.collect()
        assert sorted(map(str, got)) == sorted(map(str, want)) and (days < 400 or got)


def test_rows_without_a_target_are_not_shuffled(spark):
    plan = _final(spark, lambda t: deals.resolve_sources(t.events.select("event_id", "user_id", "event_type"), t))
    union = plan[plan.index("Union"):]
    joined, past = union.split("events.parquet", 1)
    assert "In(event_type, [click,purchase,view])" in union and "Exchange" in joined
    # the branch past the join: from its scan up to the union there is no exchange
    assert past.count("events.parquet") == 1 and "Exchange" not in past[past.rindex("*("):past.index("events.parquet")].split("FileScan")[0]


def test_latest_per_key_is_one_aggregate(spark):
    plan = _plan(QUERIES["latest_by_join_back"](spark, SF))
    # partial max on the map side: a hot key is reduced before the shuffle
    assert "Join" not in plan and "Window" not in plan and "partial_max_by(" in plan
    assert "SortAggregate" not in plan


def test_repeat_deal_predecessor_runs_by_lead_and_month(spark):
    plan = _plan(QUERIES["repeat_deal_lag"](spark, SF))
    assert "rangepartitioning" not in plan
    # the rows are dealt by (lead, bucket, range); only one row per segment goes by lead alone
    assert "_bucket" in plan and "_part0" in plan and "partial_max(struct" in plan


def test_null_safe_merge_is_one_equi_join(spark):
    plan = _plan(QUERIES["merge_null_safe"](spark, SF))
    # the only union is the one building the right-hand input; the merge itself is one join
    assert plan.count("Union") == 1 and "NestedLoop" not in plan and "CartesianProduct" not in plan
    assert "_m_salt" in plan


def test_fanout_sum_joins_aggregates_not_rows(spark):
    # the amounts and the fan-out side are both aggregated before they meet
    plan = _plan(QUERIES["fanout_sum"](spark, SF))
    assert plan.count("HashAggregate") >= 6


def test_user_activity_read_once_in_loan_status(spark):
    plan = _plan(QUERIES["loan_status"](spark, SF))
    assert plan.count("events.parquet") == 1


@pytest.mark.parametrize("key", ["wide_groupby", "deal_master"])
def test_wide_group_by_reuses_the_join_partitioning(spark, key):
    # With broadcasts off (the large-data case) the GROUP BY over many keys sits directly on
    # the sort-merge join by the deal key: no extra shuffle for the wide key list.
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = QUERIES[key](spark, SF) if key != "deal_master" else QUERIES[key](spark, SF).select("*")
        df.collect()
        final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        head = final[:final.index("SortMergeJoin")]
        assert "HashAggregate" in head and "Exchange" not in head
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_hot_key_lookup_is_split_by_aqe(spark):
    # A third of the lines point at one supplier. AQE splits a skewed partition along map-task
    # boundaries, so the probe side gets several map tasks (real tables have many row groups;
    # the test files have one).
    from pyspark.sql import functions as F

    from forecourt.operators import joins

    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16KB",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB"}
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        lines = spark.read.parquet(f"{SF}/lineitem.parquet").repartition(6)
        hot = lines.select("l_orderkey", "l_extendedprice",
                           F.when(F.col("l_orderkey") % 3 == 0, F.lit(0)).otherwise(F.col("l_suppkey")).alias("l_suppkey"))
        sup = spark.read.parquet(f"{SF}/supplier.parquet").select("s_suppkey", "s_name")
        df = joins.lookup(hot, sup, F.col("l_suppkey") == F.col("s_suppkey"))
        df.collect()
        final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert "SortMergeJoin(skew=true)" in final
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
