
import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F
from pyspark.sql import types as T

from forecourt.functions import columns as C
from forecourt.functions import rules
from forecourt.operators import aggs, joins, windows
from forecourt.plans.refurb import INVOICE_KEYS, refurb_cost
from forecourt.sinks.publish import blank_fill, trailing_window

TS = dt.datetime(2021, 6, 1, 10, 0)
MONEY = T.DecimalType(18, 2)

INV_SCHEMA = T.StructType([
    T.StructField("invoice_id", T.LongType()),
    T.StructField("invoice_no", T.StringType()),
    T.StructField("job_card_id", T.LongType()),
    T.StructField("invoice_workshop_name", T.StringType()),
    T.StructField("sell_lead_id", T.LongType()),
    T.StructField("registration_no", T.StringType()),
    T.StructField("car_city", T.StringType()),
    T.StructField("invoice_created_at", T.TimestampNTZType()),
    T.StructField("refurb_category", T.StringType()),
    T.StructField("in_date", T.TimestampNTZType()),
    T.StructField("out_date", T.TimestampNTZType()),
])
LINE_SCHEMA = T.StructType([T.StructField("invoice_id", T.LongType()), T.StructField("line_cost", MONEY)])
ADV_SCHEMA = T.StructType([T.StructField("job_card_id", T.LongType()), T.StructField("advisor_name", T.StringType())])


def _inv(invoice_id, invoice_no="X", category="REFURB", job_card=None, lead=7, reg="R1"):
    return (invoice_id, invoice_no, job_card if job_card is not None else invoice_id, "W", lead, reg, "C", TS,
            category, TS, None)


def _cost(spark, invoices, lines, advisors):
    assert all(k in INV_SCHEMA.names for k in INVOICE_KEYS)
    out = refurb_cost(spark.createDataFrame(invoices, INV_SCHEMA),
                      spark.createDataFrame([(i, Decimal(c) if c is not None else None) for i, c in lines], LINE_SCHEMA),
                      spark.createDataFrame(advisors, ADV_SCHEMA), factor=None)
    return {(r.sell_lead_id, r.reg_no): r.actual_refurb_cost for r in out.collect()}


def test_d1_nulls_sort_last_in_rank(spark):
    got = _cost(spark, [_inv(1)], [(1, "10")], [(1, None), (1, "a b")])
    assert got == {(7, "R1"): Decimal("10.00")}


def test_wn1_ties_are_all_kept(spark):
    got = _cost(spark, [_inv(1, category="REFURB"), _inv(2, category="PRE_SALE")],
                [(1, "10"), (2, "5")], [(1, "a b"), (2, "a b")])
    assert got == {(7, "R1"): Decimal("15.00")}


def test_wn1_rank_before_category_filter(spark):
    got = _cost(spark, [_inv(1, category="WARRANTY"), _inv(2, category="REFURB")],
                [(1, "10"), (2, "5")], [(1, "a a"), (2, "b b")])
    assert got == {}


def test_same_advisor_name_doubles_cost(spark):
    got = _cost(spark, [_inv(1)], [(1, "10")], [(1, "a b"), (1, "a b")])
    assert got == {(7, "R1"): Decimal("20.00")}


def test_pr2_null_labour_drops_the_row(spark):
    got = _cost(spark, [_inv(1)], [(1, "10"), (1, None)], [(1, "a b")])
    assert got == {(7, "R1"): Decimal("10.00")}


def test_jn4_job_rows_without_invoice_are_absent(spark):
    got = _cost(spark, [_inv(1)], [(1, "10"), (99, "1000")], [(1, "a b"), (99, "z z")])
    assert got == {(7, "R1"): Decimal("10.00")}


def test_d3_raw_category_groups_merge_at_level_two(spark):
    got = _cost(spark, [_inv(1, category=None), _inv(2, category="REFURB")],
                [(1, "10"), (2, "5")], [(1, "a b"), (2, "a b")])
    assert got == {(7, "R1"): Decimal("15.00")}


def test_invoice_without_advisor_or_lines(spark):
    got = _cost(spark, [_inv(1), _inv(2, invoice_no="Y", lead=8)], [(1, "10")], [])
    assert got == {(7, "R1"): Decimal("10.00"), (8, "R1"): None}


def test_pr3_pr4_category_fallback_and_sentinel(spark):
    df = spark.createDataFrame([(None, None), ("N_A", None), (None, "PRE_SALE")], "car string, inv string")
    got = df.select(C.sentinel_normalise(C.null_fallback("car", "inv"), ["N_A"], "REFURB").alias("c")).collect()
    assert [r.c for r in got] == ["REFURB", "REFURB", "PRE_SALE"]


def test_d2_concat_with_null_is_null(spark):
    df = spark.createDataFrame([("A", None), ("A", "B")], "a string, b string")
    got = [r.n for r in df.select(C.full_name("a", "b", lower=True).alias("n")).collect()]
    assert got == [None, "a b"]


def test_d4_not_in_drops_nulls(spark):
    df = spark.createDataFrame([("x",), (None,), ("deal expired",)], "s string")
    assert df.filter(~F.col("s").isin(*rules.EXCLUDED_DEAL_STATUSES)).count() == 1


def test_d5_merge_matches_null_keys_and_fans_out(spark):
    left = spark.createDataFrame([(1, None), (2, 5), (3, 6)], "deal_id long, sell_lead_id long")
    right = spark.createDataFrame([(None, "r0", 1.0), (5, "r1", 2.0), (5, "r2", 3.0)],
                                  "sell_lead_id long, reg_no string, cost double")
    got = sorted((r.deal_id, r.cost) for r in joins.merge_null_safe(left, right, "sell_lead_id").collect())
    assert got == [(1, 1.0), (2, 2.0), (2, 3.0), (3, None)]


def test_d6_nullif_is_not_coalesce(spark):
    d1, d2 = dt.date(2021, 1, 1), dt.date(2021, 1, 2)
    df = spark.createDataFrame([(d1, d1), (d1, None), (None, d2)], "a date, b date")
    assert [r.x for r in df.select(C.nullif("a", "b").alias("x")).collect()] == [None, d1, None]


def _deals(spark, rows):
    return spark.createDataFrame(rows, "id long, lead long, created timestamp_ntz, status string")


def test_d7_month_without_year(spark):
    df = _deals(spark, [(1, 9, dt.datetime(2021, 10, 5), "Delivery Done"),
                        (2, 9, dt.datetime(2022, 10, 7), "Token Collected")])
    out = windows.repeat_deals(df, "lead", "created", "id", "status", previous_status="Delivery Done")
    assert [r.id for r in out.collect()] == [1]


def test_cp2_excluded_rows_removed_before_lag(spark):
    df = _deals(spark, [(1, 9, dt.datetime(2021, 10, 1), "Delivery Done"),
                        (2, 9, dt.datetime(2021, 10, 2), "deal requested"),
                        (3, 9, dt.datetime(2021, 10, 3), "Deal Cancelled")])
    out = windows.repeat_deals(df, "lead", "created", "id", "status", previous_status="Delivery Done",
                               excluded=rules.EXCLUDED_DEAL_STATUSES)
    assert [r.id for r in out.collect()] == [1]


def test_d8_local_and_utc_day_boundaries(spark):
    df = spark.createDataFrame([(dt.datetime(2021, 9, 30, 20, 0),)], "ts timestamp_ntz")
    assert df.filter(C.local_floor("ts", "2021-10-01")).count() == 1
    assert df.filter(C.utc_floor("ts", "2021-10-01")).count() == 0


def test_pr9_flag_without_else(spark):
    df = spark.createDataFrame([(0,), (1,), (2,), (None,)], "f int")
    assert [r.x for r in df.select(C.flag_label("f").alias("x")).collect()] == ["No", "Yes", None, None]


def test_pr11_decision_rows(spark):
    df = spark.createDataFrame(
        [(1, 6, 7, "Deal Cancelled"), (2, 6, None, "Token Collected"), (3, 4, 2, "Token Collected"),
         (4, 2, 3, "Delivery Done")], "k int, lead int, bank int, deal string")
    got = dict((r.k, r.loan_flow_status) for r in rules.decision_table(df, "lead", "bank", "deal").collect())
    assert got == {1: "Loan approved - Cancelled by Customer", 2: "Loan Logged In", 3: "AUTO_CLOSED", 4: "Others"}


def test_jn9_guard_keeps_other_types_unjoined(spark):
    leads = spark.createDataFrame([(1, 246, 10), (2, 319, 10)], "id long, type_id int, object_id long")
    articles = spark.createDataFrame([(10, "http://x")], "a_id long, url string")
    out = joins.guarded_join(leads, articles, "object_id", "a_id", F.col("type_id") == 246)
    assert sorted((r.id, r.url) for r in out.collect()) == [(1, "http://x"), (2, None)]


def test_jn14_fanout_and_dedupe(spark):
    base = spark.createDataFrame([(1,)], "deal long")
    amounts = spark.createDataFrame([(1, Decimal("100.00"))], T.StructType([
        T.StructField("deal", T.LongType()), T.StructField("amount", MONEY)]))
    visits = spark.createDataFrame([(1, "u1"), (1, "u2")], "deal long, creator string")
    faithful = aggs.fanout_sum(base, "deal", amounts, "deal", "amount", [(visits, "deal")], "s").collect()[0].s
    safe = aggs.fanout_sum(base, "deal", amounts, "deal", "amount", [(visits, "deal")], "s", dedupe=True).collect()[0].s
    assert (faithful, safe) == (Decimal("200.00"), Decimal("100.00"))


def test_ag9_hidden_key_keeps_rows(spark):
    df = spark.createDataFrame([(1, 0, 5.0), (1, 1, 5.0)], "deal long, renewal int, amt double")
    out = aggs.group_hidden_key(df, ["deal"], ["renewal"], {"s": F.sum("amt")})
    assert out.count() == 2 and out.columns == ["deal", "s"]


def test_fl10_cutoff_keeps_time_of_day(spark):
    df = spark.createDataFrame([(1, dt.date(2021, 12, 31), "Delivered"), (2, dt.date(2022, 1, 1), "Delivered"),
                                (3, None, "Delivered")], "id int, delivery_time date, deal_status string")
    out = trailing_window(df, "delivery_time", dt.datetime(2022, 3, 31, 10, 0), 90, "deal_status", "Delivered")
    assert [r.id for r in out.collect()] == [2]


def test_d9_blank_fill(spark):
    df = spark.createDataFrame([(1, None, None)], "id int, d date, m double")
    row = blank_fill(df, {"m": 2}).collect()[0]
    assert (row.id, row.d, row.m) == ("1", "", "")


def test_d11_like_is_case_sensitive(spark):
    df = spark.createDataFrame([("via direct link",), ("Direct",)], "url string")
    got = [r.b for r in df.select(C.pattern_bucket("url", [("%Direct%", "Direct")], passthrough=True).alias("b")).collect()]
    assert got == ["via direct link", "Direct"]


def test_refurb_on_workshop_tables(spark):
    from forecourt.plans.refurb import refurb_inputs_from_tables

    ts = dt.datetime(2021, 3, 1, 8, 0)
    early = dt.datetime(2020, 12, 31, 12, 0)
    t = {
        "invoice": spark.createDataFrame(
            [(1, 11, 100, 500, 3, "INV-1", ts, ts, None), (2, 12, 101, 501, 3, "INV-2", ts, ts, None),
             (3, 13, 100, 500, 3, "INV-3", early, early, None), (4, 14, 102, 502, 4, "INV-4", ts, ts, None)],
            "id long, job_card_id long, car_id long, refurb_car_id long, vendor_id long, invoice_no string, "
            "created_at timestamp_ntz, in_date timestamp_ntz, out_date timestamp_ntz"),
        "workshop": spark.createDataFrame([(3, "Main Workshop North"), (4, None), (9, "East yard")],
                                          "id long, name string"),
        "invoice_meta": spark.createDataFrame([(1, None), (2, "PRE_SALE")], "invoice_id long, refurb_category string"),
        "car": spark.createDataFrame([(100, 7, "REG7"), (101, 8, "REG8"), (102, 9, "REG9")],
                                     "id long, object_id long, registration_no string"),
        "refurb_car": spark.createDataFrame([(500, 9, "N_A"), (501, 9, None), (502, 9, "REFURB")],
                                            "id long, workshop_id long, refurb_category string"),
        "job_row": spark.createDataFrame(
            [(1, 2, Decimal("10.00"), Decimal("5.00")), (1, 1, Decimal("3.00"), None),
             (2, 1, Decimal("100.00"), Decimal("0.00")), (3, 1, Decimal("1.00"), Decimal("1.00")),
             (4, 1, Decimal("50.00"), Decimal("0.00"))],
            T.StructType([T.StructField("invoice_id", T.LongType()), T.StructField("part_count", T.IntegerType()),
                          T.StructField("part_cost", MONEY), T.StructField("labour_cost", MONEY)])),
        "refurb_user": spark.createDataFrame([(1, "Asha", "Rao"), (2, None, "Khan")],
                                             "id long, first_name string, last_name string"),
        "job_card_user": spark.createDataFrame([(11, 1), (11, 2), (12, 2)], "job_card_id long, user_id long"),
    }
    inv, lines, adv = refurb_inputs_from_tables(t, [("%East%", "East")])
    got = {(r.sell_lead_id, r.reg_no): r.actual_refurb_cost for r in refurb_cost(inv, lines, adv).collect()}
    # invoice 1: lines 2*10+5 = 25 (the null-labour row adds nothing), first advisor 'asha rao'
    # (null name sorts last), category N_A -> REFURB; invoice 2: fallback category PRE_SALE,
    # one advisor with a null name, cost 100; invoice 3 is before the floor; invoice 4 has a
    # workshop with a null name and is dropped.
    assert got == {(7, "REG7"): Decimal("0.82") * Decimal("25.00"), (8, "REG8"): Decimal("0.82") * Decimal("100.00")}


def test_time_literals_ignore_session_zone(spark):
    # A Python datetime literal would be read in the driver's zone; the text form is not.
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        df = spark.createDataFrame([("2021-09-30 18:29:59",), ("2021-09-30 18:30:00",)], "s string").select(
            F.col("s").cast("timestamp_ntz").alias("ts"))
        assert df.filter(C.local_floor("ts", "2021-10-01")).count() == 1
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_null_safe_merge_on_a_date_key(spark):
    d = dt.date(2021, 1, 1)
    left = spark.createDataFrame([(1, d), (2, None)], "id int, k date")
    right = spark.createDataFrame([(d, "a"), (None, "n")], "k date, v string")
    got = sorted((r.id, r.v) for r in joins.merge_null_safe(left, right, "k").collect())
    assert got == [(1, "a"), (2, "n")]


def test_line_cost_units_equal_decimal_cost(spark):
    # the long-arithmetic line cost is the decimal line cost, exactly, on every line row
    from decimal import Decimal as D

    from forecourt.plans import roles

    lines = spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet")
    lc = roles.line_cost_columns()
    diff = lines.select(
        (lc["part_count"] * lc["part_cost"] + lc["labour_cost"]).alias("dec"),
        (roles.line_cost_units().cast("decimal(38,0)") * F.lit(D(1).scaleb(-roles.UNIT_SCALE))).alias("units"))
    assert diff.filter(~F.col("dec").eqNullSafe(F.col("units"))).count() == 0
    assert diff.filter(F.col("dec").isNull()).count() > 0   # tax rate 0 -> null row, both ways
