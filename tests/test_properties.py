"""Property tests: equivalent spellings of one operator agree on random inputs."""

import itertools
import re
from collections import Counter

import pandas as pd
import pytest
from hypothesis import HealthCheck, example, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from forecourt.functions import rules
from forecourt.operators import aggs, joins, latest, windows

SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))

rows_strategy = st.lists(
    st.tuples(st.integers(0, 4), st.integers(0, 3), st.one_of(st.none(), st.text("ab", min_size=1, max_size=2))),
    min_size=1, max_size=25)


def _events(spark, rows):
    data = [(i, k, code, name) for i, (k, code, name) in enumerate(rows)]
    return spark.createDataFrame(data, "id long, k long, code long, name string")


def _multiset(df):
    return Counter(tuple(r) for r in df.collect())


@SETTINGS
@given(rows_strategy)
def test_latest_per_key_spellings_agree(spark, rows):
    df = _events(spark, rows)
    got = [_multiset(latest.latest_per_key(df, ["k"], "id", how=h))
           for h in ("struct", "semi", "join_back", "max_by")]
    assert got[0] == got[1] == got[2] == got[3]


@SETTINGS
@given(rows_strategy)
def test_dense_rank_first_agg_equals_window(spark, rows):
    df = _events(spark, rows)
    assert _multiset(windows.dense_rank_first(df, ["k"], "name", "agg")) == \
        _multiset(windows.dense_rank_first(df, ["k"], "name", "window"))


@SETTINGS
@given(rows_strategy)
def test_one_pass_pivot_equals_separate_passes(spark, rows):
    df = _events(spark, rows).withColumn("ts", F.timestamp_seconds(F.col("id") * 3600).cast("timestamp_ntz"))
    specs = [("a", 0, "max"), ("b", 1, "min"), ("c", 2, "max")]
    one = aggs.status_pivot(df, "k", "ts", "code", specs, offset_minutes=330)
    keys = df.filter(F.col("code").isin(0, 1, 2)).select("k").distinct()
    sep = keys
    for alias, code, fn in specs:
        part = df.filter(F.col("code") == code).groupBy("k").agg(
            (F.max("ts") if fn == "max" else F.min("ts")).alias(alias))
        sep = sep.join(part.withColumn(alias, F.col(alias) + F.expr("INTERVAL 330 MINUTES")), "k", "left")
    assert _multiset(one.select("k", "a", "b", "c")) == _multiset(sep.select("k", "a", "b", "c"))


@SETTINGS
@given(rows_strategy)
def test_fanout_safe_equals_fanout_when_sides_unique(spark, rows):
    df = _events(spark, rows)
    base = df.select("k").distinct()
    amounts = df.select("k", F.col("code").cast("decimal(18,2)").alias("amt"))
    unique_side = df.select("k").distinct()
    a = aggs.fanout_sum(base, "k", amounts, "k", "amt", [(unique_side, "k")], "s")
    b = aggs.fanout_sum(base, "k", amounts, "k", "amt", [(unique_side, "k")], "s", dedupe=True)
    assert _multiset(a) == _multiset(b)


@SETTINGS
@given(rows_strategy)
def test_fanout_sum_equals_materialised_join(spark, rows):
    df = _events(spark, rows)
    base = df.select("k").distinct()
    amounts = df.filter(F.col("code") <= 1).select("k", F.col("id").cast("decimal(18,2)").alias("amt"))
    side = df.filter(F.col("code") >= 1).select("k", "name")
    fast = aggs.fanout_sum(base, "k", amounts, "k", "amt", [(side, "k")], "s")
    slow = (base.join(amounts, "k", "left").join(side, "k", "left").groupBy("k").agg(F.sum("amt").alias("s")))
    assert _multiset(fast) == _multiset(slow)


@SETTINGS
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 3)), st.integers(0, 9)), min_size=1, max_size=15),
       st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 3)), st.integers(0, 9)), max_size=15))
def test_merge_null_safe_equals_pandas_merge(spark, left_rows, right_rows):
    left = spark.createDataFrame([(i, k, v) for i, (k, v) in enumerate(left_rows)], "id long, key long, lv long")
    right = spark.createDataFrame(right_rows, "key long, rv long") if right_rows else \
        spark.createDataFrame([], "key long, rv long")
    got = Counter((r.id, r.key, r.lv, r.rv) for r in joins.merge_null_safe(left, right, "key", null_rows_a_task=3).collect())
    lp = pd.DataFrame([(i, k, v) for i, (k, v) in enumerate(left_rows)], columns=["id", "key", "lv"]).astype(object)
    rp = pd.DataFrame(right_rows, columns=["key", "rv"]).astype(object)
    want = lp.merge(rp, on="key", how="left")
    norm = lambda v: None if v is None or (isinstance(v, float) and v != v) else int(v)
    want_rows = Counter(tuple(norm(x) for x in r) for r in want[["id", "key", "lv", "rv"]].itertuples(index=False))
    assert got == want_rows


def test_decision_join_equals_case_over_full_domain(spark):
    deals = [rules.DEAL_CANCELLED, rules.TOKEN_COLLECTED, rules.DELIVERY_DONE, rules.CAR_RETURNED,
             rules.CAR_DELIVERED, rules.DEFAULT_STATUS, None]
    domain = list(itertools.product(list(range(7)) + [None], list(range(9)) + [None], deals))
    df = spark.createDataFrame(domain, "lead int, bank int, deal string")
    joined = rules.decision_table(df, "lead", "bank", "deal")
    cased = df.withColumn("loan_flow_status", rules.decision_case(F.col("lead"), F.col("bank"), F.col("deal")))
    assert joined.count() == len(domain)
    assert _multiset(joined) == _multiset(cased)


def test_merge_null_safe_copies_no_right_row_without_left_nulls(spark):
    left = spark.createDataFrame([(1, 5)], "id long, key long")
    right = spark.createDataFrame([(None, 1), (None, 2), (5, 3)], "key long, rv long")
    df = joins.merge_null_safe(left, right, "key", null_rows_a_task=1)
    assert [(r.id, r.rv) for r in df.collect()] == [(1, 3)]
    right_side = df._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in right_side and "CartesianProduct" not in right_side


@SETTINGS
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 2)), st.one_of(st.none(), st.integers(0, 60)),
                          st.sampled_from("abc")), min_size=1, max_size=40),
       st.integers(1, 20))
def test_bucketed_lag_equals_window_lag(spark, rows, width):
    # Few groups and many rows per group: most groups span several buckets, some buckets are empty.
    data = [(i, g, t, s) for i, (g, t, s) in enumerate(rows)]
    df = spark.createDataFrame(data, "id long, g long, t long, s string")
    order = [F.col("t").asc_nulls_last(), F.col("id").asc_nulls_last()]
    want = windows.with_previous(df, ["g"], order, ["s", "id"])
    got = windows.previous_in_range(df, ["g"], ["t", "id"], ["s", "id"], bucket=F.floor(F.col("t") / width))
    cols = ["id", "g", "t", "s", "prev_s", "prev_id"]
    assert _multiset(got.select(*cols)) == _multiset(want.select(*cols))


def test_bucketed_lag_on_a_million_rows_with_a_hot_group(spark):
    """Three quarters of the rows in one group, a column kept beside the carried ones, no reuse of exchanges."""
    df = spark.range(0, 1_000_000, numPartitions=8).select(
        "id", F.when(F.col("id") % 4 > 0, 1).otherwise(F.col("id") % 1000).cast("long").alias("g"),
        F.timestamp_seconds(F.pmod(F.xxhash64("id"), F.lit(86400 * 2000))).cast("timestamp_ntz").alias("t"),
        F.concat(F.lit("kept"), F.col("id")).alias("extra"))
    old = spark.conf.get("spark.sql.exchange.reuse")
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        got = windows.previous_in_range(df, ["g"], ["t", "id"], ["id"])
        want = windows.with_previous(df, ["g"], [F.col("t"), F.col("id")], ["id"])
        diff = got.select("id", "extra", "prev_id").exceptAll(want.select("id", "extra", "prev_id"))
        assert "rangepartitioning" not in got._jdf.queryExecution().executedPlan().toString()
        assert got.count() == 1_000_000 and diff.count() == 0
    finally:
        spark.conf.set("spark.sql.exchange.reuse", old)


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 1), st.one_of(st.none(), st.integers(0, 3), st.integers(0, 10**17)),
                          st.one_of(st.none(), st.integers(0, 40))), min_size=1, max_size=40), st.integers(0, 3), st.integers(2, 9))
@example([(1, None, 0), (1, 0, None)], 1, 2)  # one time and a null time in a bucket
def test_segmented_lag_equals_window_lag(spark, rows, cuts, share):
    # One bucket for all, cut into ranges of the first and the second order column: crowded, equal and null values.
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "n long, g long, t long, id long")
    order = [F.col(c).asc_nulls_last() for c in ("t", "id", "n")]
    want = windows.with_previous(df, ["g"], order, ["n"])
    got = windows.previous_in_range(df, ["g"], ["t", "id", "n"], ["n"], bucket=F.lit(1), hot_share=share, hot_rows=1, cuts=cuts)
    assert _multiset(got.select("n", "prev_n")) == _multiset(want.select("n", "prev_n"))


@pytest.mark.parametrize("seconds", [86400 * 20, 1])
def test_one_lead_and_one_month_is_many_tasks(spark, seconds):
    """A million rows of one lead in one month (then in one second): the window's tasks get about as many rows each."""
    df = spark.range(0, 1_000_000, numPartitions=8).select(
        "id", F.lit(1).alias("g"), F.timestamp_seconds(F.lit(0) + F.pmod(F.xxhash64("id"), F.lit(seconds))).cast("timestamp_ntz").alias("t"))
    got = windows.previous_in_range(df, ["g"], ["t", "id"], ["id"], hot_share=40, hot_rows=10_000)
    want = windows.with_previous(df, ["g"], [F.col("t"), F.col("id")], ["id"])
    assert got.select("id", "prev_id").exceptAll(want.select("id", "prev_id")).count() == 0
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled"), spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old[0])
        spark.conf.set("spark.sql.shuffle.partitions", old[1])
    assert len(sizes) >= 10 and max(sizes) < 250_000


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.integers(0, 5)), max_size=40), st.lists(st.one_of(st.none(), st.integers(0, 6)), max_size=12),
       st.lists(st.integers(0, 6), max_size=12), st.integers(2, 9))
def test_salted_lookups_equal_plain_joins(spark, rows, first, second, share):
    # Repeated rows, null keys on both sides, keys that a dimension holds several times or not at all, empty tables.
    df = spark.createDataFrame([(i // 2, k) for i, k in enumerate(rows)], "n long, k long")
    a = spark.createDataFrame([(k, i) for i, k in enumerate(first)], "ak long, av long")
    b = spark.createDataFrame([(k, i) for i, k in enumerate(second)], "bk long, bv long")
    for how in ("left", "inner"):
        want = df.join(a, F.col("k") == F.col("ak"), how).join(b, F.col("k") == F.col("bk"), "left")
        got = joins.salted_lookups(df, "k", [(a, "ak", how), (b, "bk", "left")], hot_share=share, hot_rows=1)
        assert got.columns == want.columns and _multiset(got) == _multiset(want)


def test_hot_lead_of_a_chain_is_many_tasks_without_session_settings(spark):
    """A third of 600k rows has one key and a third none. All skew handling of the session is off and broadcasts too."""
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.adaptive.skewJoin.enabled": "false",
            "spark.sql.adaptive.forceOptimizeSkewedJoin": "false", "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.shuffle.partitions": "16"}
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        n = F.col("id")
        df = spark.range(0, 600_000, numPartitions=6).select(
            "id", F.when(n % 3 == 0, 7).when(n % 3 == 1, n % 50_000).cast("long").alias("lead"))
        dims = [spark.range(0, 50_000).select(F.col("id").alias(f"key{i}"), (F.col("id") * i).alias(f"value{i}")) for i in (1, 2, 3)]
        hot = {r["_hot_key"]: r["_salts"] for r in joins.hot_keys(df, "lead", hot_share=50, hot_rows=10_000).collect()}
        assert list(hot) == [7] and hot[7] == 26  # 200,004 of 400,000 rows with a key
        got = joins.salted_lookups(df, "lead", [(d, f"key{i}", "left") for i, d in enumerate(dims, 1)], hot_share=50, hot_rows=10_000)
        sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 600_000 and len(sizes) == 16 and max(sizes) < 100_000
        # one shuffle of the rows for the whole chain, and one a dimension
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert len(re.findall(r"Exchange hashpartitioning\(lead#\d+L, _salt#", plan)) == 1 and plan.count("SortMergeJoin") == 3
        assert got.where((F.col("lead") == 7) & (F.col("value3") == 21)).count() == sum(1 for i in range(600_000) if i % 3 == 0 or (i % 3 == 1 and i % 50_000 == 7))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


#: Labels typed in by hand from the rules of the workload: (lead status, bank status, deal status) -> label.
HAND_LABELS = [
    (0, 0, "Token Collected", "Loan Logged In"), (0, 0, "Deal Cancelled", "Customer Not Interested"),
    (3, 0, "Deal Cancelled", "Application Rejected - Loan not possible"), (6, 2, "Token Collected", "Additional Documents Required"),
    (4, 4, "Delivery Done", "Loan Approved"), (5, 4, "Deal Cancelled", "Loan approved - Cancelled by Customer"),
    (6, 5, "Token Collected", "Loan Rejected"), (0, 6, "Delivery Done", "Loan Kit Signed"), (6, 6, "Car Returned", "Loan Kit Signed"),
    (5, 7, "Delivery Done", "Loan Disbursed"), (4, 8, "Delivery Done", "Loan approved - Cancelled by Customer"),
    # second tier: no arm for the bank status
    (0, None, "Car Delivered", "Application received"), (0, 8, "default-status", "Application received"),
    (2, 0, "Token Collected", "Application received"), (4, None, "Delivery Done", "AUTO_CLOSED"),
    (5, None, "Delivery Done", "Documents received"), (6, 1, "Delivery Done", "Loan Logged In"),
    (1, 6, "Token Collected", "Customer Not Interested"),
    # no arm at all
    (3, 0, "Delivery Done", "Others"), (None, 4, "Delivery Done", "Others"), (2, 4, "Car Returned", "Others"), (6, 4, None, "Others"),
]


def test_decision_table_gives_the_labels_typed_by_hand(spark):
    df = spark.createDataFrame([r[:3] for r in HAND_LABELS], "lead int, bank int, deal string")
    got = {(r.lead, r.bank, r.deal): r.loan_flow_status for r in rules.decision_table(df, "lead", "bank", "deal").collect()}
    assert got == {r[:3]: r[3] for r in HAND_LABELS}
