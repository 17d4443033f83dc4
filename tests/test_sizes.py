"""Tasks of a fixed size: shuffles of large tables have more partitions, and the rank prunes before the grouping."""

from __future__ import annotations

import datetime as dt
import re
from collections import Counter

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

import __spark_entry__
from forecourt.operators import joins
from forecourt.plans import basics
from forecourt.plans.refurb import INVOICE_KEYS, refurb_cost
from forecourt.session import sized_session
from forecourt.sources import tables

PARTS, ADVISORY = "spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes"


def test_sized_session(spark):
    before = dict(spark.conf.getAll)
    assert sized_session(spark, 4 * 100, 100) is spark  # its four partitions are enough
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "12345")
    try:
        sized = sized_session(spark, 4 * 100 + 1, 100)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert sized.conf.get(PARTS) == "5" and sized.conf.get(ADVISORY) == "100b"
    assert sized.conf.get("spark.sql.autoBroadcastJoinThreshold") == "12345"
    assert sized.conf.get("spark.sql.session.timeZone") == "UTC"
    assert {k: v for k, v in spark.conf.getAll.items() if "utoBroadcast" not in k} == {
        k: v for k, v in before.items() if "utoBroadcast" not in k}


def lines_and_orders(folder, orders: int) -> str:
    day = dt.datetime(2000, 1, 1)
    n = range(orders)
    pq.write_table(pa.table({"o_orderkey": pa.array(n, pa.int64()), "o_custkey": pa.array([i % 7 for i in n], pa.int64())}),
                   folder / "orders.parquet")
    pq.write_table(pa.table({"s_suppkey": pa.array(range(3), pa.int64()), "s_name": ["c", "b", "a"],
                             "s_acctbal": [1.0, 1.0, -1.0]}), folder / "supplier.parquet")
    pq.write_table(pa.table({"l_orderkey": pa.array([i for i in n for _ in range(3)], pa.int64()),
                             "l_suppkey": pa.array([s for _ in n for s in range(3)], pa.int64()),
                             "l_extendedprice": [float(i % 5) for i in n for _ in range(3)],
                             "l_shipdate": [day] * (3 * orders)}), folder / "lineitem.parquet")
    return str(folder)


def test_ranked_rollup_of_larger_tables_has_more_tasks(spark, tmp_path, monkeypatch):
    path = lines_and_orders(tmp_path, 3000)
    monkeypatch.setattr(tables, "sized_session", lambda s, size: sized_session(s, size, max(1, size // 20)))
    df = __spark_entry__.queries()["ranked_dedup_rollup"](spark, path)
    plan = df._jdf.queryExecution().executedPlan().toString()
    counts = {int(x) for x in re.findall(r"hashpartitioning\([^)]*?, (\d+)\)", plan)}
    assert counts and min(counts) >= 20
    want = {}
    for i in range(3000):  # advisor "b" comes first of "c", "b" and null
        want[i % 7] = want.get(i % 7, 0.0) + i % 5
    assert {r["o_custkey"]: r["total_cost"] for r in df.collect()} == want


def test_refurb_rank_prunes_before_the_grouping(spark):
    kinds = {"invoice_created_at": "timestamp_ntz", "in_date": "timestamp_ntz", "out_date": "timestamp_ntz",
             "invoice_no": "long", "job_card_id": "long", "sell_lead_id": "long"}
    invoices = spark.createDataFrame(
        [(1, *[{"long": 5}.get(kinds.get(k), None if k in kinds else "REFURB") for k in INVOICE_KEYS])],
        ", ".join(["invoice_id long", *[f"{k} {kinds.get(k, 'string')}" for k in INVOICE_KEYS]]))
    lines = spark.sql("SELECT 1L AS invoice_id, CAST(x AS DECIMAL(18,2)) AS line_cost FROM VALUES (2), (3) AS t(x)")
    advisors = spark.sql("SELECT 5L AS job_card_id, a AS advisor_name FROM VALUES ('b'), ('a'), ('a'), (NULL) AS t(a)")
    df = refurb_cost(invoices, lines, advisors, factor=None, out_type="double")
    assert [r["actual_refurb_cost"] for r in df.collect()] == [10.0]  # two users named "a", five each
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    group = next(i for i, line in enumerate(plan.splitlines()) if re.search(r"Aggregate \[.*in_date.*advisor_name", line))
    window = next(i for i, line in enumerate(plan.splitlines()) if "dense_rank(" in line)
    assert group < window  # children come below


def test_null_product_is_dealt_by_both_sides(spark):
    left = spark.range(300).selectExpr("id", "IF(id % 3 = 0, id, NULL) AS k")
    kinds = {"different": "id", "equal": "0 * id"}  # equal rows go to one block, and the other blocks are empty
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    old = spark.conf.get(coalesce)
    spark.conf.set(coalesce, "false")
    try:
        for kind, value in kinds.items():
            right = spark.range(100).selectExpr("IF(id % 2 = 0, NULL, id) AS k", f"IF(id % 2 = 0, {value}, id) AS v")
            df = joins.merge_null_safe(left, right, "k", right_nulls=50, null_rows_a_block=5)
            rows = df.withColumn("task", F.spark_partition_id()).collect()
            nulls = [0 if kind == "equal" else v for v in range(0, 100, 2)]
            want = [(i, None, v) for i in range(300) if i % 3 for v in nulls]
            want += [(i, i, i if i < 100 and i % 2 else None) for i in range(0, 300, 3)]
            key = str  # rows have nulls
            assert sorted([(r.id, r.k, r.v) for r in rows], key=key) == sorted(want, key=key)
            tasks = Counter(r.task for r in rows if r.k is None)
            assert kind == "equal" or len(tasks) >= 3 and max(tasks.values()) < len(nulls) * 200 * 0.7
    finally:
        spark.conf.set(coalesce, old)


def test_merge_query_sizes_its_tasks_by_the_null_product(spark, tmp_path, monkeypatch):
    n, late = 400, dt.datetime(2001, 8, 1)
    pq.write_table(pa.table({"o_orderkey": pa.array(range(n), pa.int64()), "o_custkey": pa.array([i % 9 for i in range(n)], pa.int64()),
                             "o_orderdate": [late if i % 2 else dt.datetime(2000, 1, 1) for i in range(n)]}), tmp_path / "orders.parquet")
    pq.write_table(pa.table({"c_custkey": pa.array(range(n), pa.int64()), "c_name": [f"c{i}" for i in range(n)],
                             "c_nationkey": pa.array([0 if i >= 100 else 1 for i in range(n)], pa.int64()),
                             "c_acctbal": [float(i) for i in range(n)], "c_mktsegment": ["X"] * n}), tmp_path / "customer.parquet")
    monkeypatch.setattr(basics, "NULL_PAIRS_A_TASK", 200 * 300 // 20)
    df = __spark_entry__.queries()["merge_null_safe"](spark, str(tmp_path))
    plan = df._jdf.queryExecution().executedPlan().toString()
    counts = {int(x) for x in re.findall(r"hashpartitioning\([^\n]*?, (\d+)\), ENSURE", plan)}
    assert "SortMergeJoin" in plan and counts == {20}
    got = Counter((r.deal_id, r.sell_lead_id, r.actual_refurb_cost) for r in df.collect())
    want = Counter((i, None, float(c)) for i in range(1, n, 2) for c in range(100, n))
    want.update((i, i % 9, float(i % 9)) for i in range(0, n, 2))
    assert got == want


def test_merge_query_computes_nothing_per_pair(spark, tmp_path):
    late, early = dt.datetime(2001, 8, 1), dt.datetime(2000, 1, 1)
    pq.write_table(pa.table({"o_orderkey": pa.array([1, 2, 3, 3, 4], pa.int64()), "o_custkey": pa.array([1, 2, None, 9, 3], pa.int64()),
                             "o_orderdate": [late, early, early, early, early]}), tmp_path / "orders.parquet")
    pq.write_table(pa.table({"c_custkey": pa.array([1, 2, None, 3], pa.int64()), "c_name": ["a", "b", "c", "d"],
                             "c_nationkey": pa.array([0, 1, 1, 1], pa.int64()), "c_acctbal": [2.675, -0.129, 7.0, None],
                             "c_mktsegment": ["MACHINERY", "MACHINERY", "X", "X"]}), tmp_path / "customer.parquet")
    df = __spark_entry__.queries()["merge_null_safe"](spark, str(tmp_path))
    assert dict(df.dtypes) == {"deal_id": "bigint", "sell_lead_id": "bigint", "actual_refurb_cost": "double"}
    want = [(i, None, c) for i in (1, 3) for c in (2.68, 2.68, 7.0)]  # null x null, two rows of customer 1
    want += [(2, 2, -0.13), (2, 2, -0.13), (3, 9, None), (4, 3, None)]
    assert Counter((r.deal_id, r.sell_lead_id, r.actual_refurb_cost) for r in df.collect()) == Counter(want)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    above, join, below = plan.partition("Join LeftOuter")
    assert join and "cast(" not in above and "as double)" in below
