"""The end-to-end run publishes every target, each from one evaluation of the plan."""

import datetime as dt

import pytest

from forecourt.job import run
from forecourt.plans.registry import QUERIES, load_all
from forecourt.session import scratch_path, shared_dir
from forecourt.sinks import publish as P
from forecourt.sinks.publish import published_table

load_all()
SF = "/root/testdata/sf0.001"


def test_job_publishes_all_targets(spark):
    out = shared_dir(spark, "job-test")
    written = run(spark, "test", SF, out, copies=3, as_of=dt.datetime(2001, 8, 1))
    assert len(written["full"]) == 3 and written["trailing"] and written["refurb"]
    n = QUERIES["margin_base"](spark, SF).count()
    assert all(published_table(spark, p).count() == n for p in written["full"])
    assert published_table(spark, written["trailing"][0]).count() == QUERIES["publish_trailing"](spark, SF).count()
    assert published_table(spark, written["refurb"][0]).count() == QUERIES["refurb_cost_per_vehicle"](spark, SF).count()


def test_rerun_with_run_id_reuses_committed_stages(spark, monkeypatch):
    out = shared_dir(spark, "job-test-resume")
    first = run(spark, "test", SF, out, copies=2, as_of=dt.datetime(2001, 8, 1), run_id="resume-check")
    stage = shared_dir(spark, "staging/resume-check")
    staged = spark.read.parquet(f"{stage}/margin_base")
    n = staged.count()
    # a second run with the same id copies from the committed stages: no product is built, so nothing reads the sources
    import forecourt.job as J

    monkeypatch.setattr(J, "products_test_layout", lambda *a: (lambda: pytest.fail("built"),) * 2)
    second = run(spark, "test", SF, out, copies=2, as_of=dt.datetime(2001, 8, 1), run_id="resume-check")
    assert first == second
    assert all(published_table(spark, p).count() == n for p in second["full"])


def test_job_on_warehouse_layout(spark):
    """The warehouse layout reads one parquet folder per logical table plus a rules dict."""
    from decimal import Decimal

    from test_deal_tables import SCHEMAS, _d, _deal

    from forecourt.job import DEAL_TABLES, WORKSHOP_TABLES

    ts = _d(2021, 10, 5)
    workshop_schemas = {
        "invoice": "id long, job_card_id long, car_id long, refurb_car_id long, vendor_id long, invoice_no string, "
                   "created_at timestamp_ntz, in_date timestamp_ntz, out_date timestamp_ntz",
        "workshop": "id long, name string",
        "invoice_meta": "invoice_id long, refurb_category string",
        "car": "id long, object_id long, registration_no string",
        "refurb_car": "id long, workshop_id long, refurb_category string",
        "job_row": "invoice_id long, part_count int, part_cost decimal(18,2), labour_cost decimal(18,2)",
        "refurb_user": "id long, first_name string, last_name string",
        "job_card_user": "job_card_id long, user_id long",
    }
    rows = {
        "invoice": [(1, 11, 100, 500, 3, "INV-1", ts, ts, None)],
        "workshop": [(3, "North Works")],
        "car": [(100, 20, "REG20")],
        "refurb_car": [(500, 3, "REFURB")],
        "job_row": [(1, 2, Decimal("10.00"), Decimal("5.00"))],
        "refurb_user": [(1, "Asha", "Rao")],
        "job_card_user": [(11, 1)],
        "status": [(1, "Delivery Done"), (2, "Token Collected")],
        "deal": [_deal(1, 10, 20, 1, _d(2021, 10, 5)), _deal(2, 10, 21, 2, _d(2021, 10, 20))],
        "buy_lead": [(10, "bcm", 100, 356, None)],
        "contact": [(100, "Buyer", "99999")],
        "content_type": [(356,)],
        "lead": [(20, 200, "P"), (21, 201, "P")],
    }
    schemas = {**workshop_schemas, **SCHEMAS}
    assert set(schemas) == set(WORKSHOP_TABLES + DEAL_TABLES)
    data = shared_dir(spark, "warehouse-layout-test")
    for name, schema in schemas.items():
        spark.createDataFrame(rows.get(name, []), schema).write.mode("overwrite").parquet(f"{data}/{name}.parquet")
    rules = {"category": "bcm", "city_rules": [["%North%", "North"]], "hub_rules": [], "url_rules": []}
    with pytest.raises(ValueError, match="187"):  # its label has no default
        run(spark, "warehouse", data, None, copies=1, as_of=dt.datetime(2021, 12, 1), rules=rules)
    rules["source_labels"] = [[187, "Portal"]]  # added to the defaults: 356 keeps its label
    out = shared_dir(spark, "warehouse-layout-out")
    written = run(spark, "warehouse", data, out, copies=2, as_of=dt.datetime(2021, 12, 1), rules=rules)
    margin = published_table(spark, written["full"][0])
    got = {r.deal_id: (r.deal_status, r.sub_sub_source_f, r.actual_refurb_cost) for r in margin.collect()}
    # deal 1 (previous delivered deal of the month) and 2 (latest of the month) are selected;
    # vehicle 20 has refurb cost 0.82 * (2 * 10 + 5)
    assert got == {1: ("Delivered", "Inbound", Decimal("0.82") * Decimal("25.00")),
                   2: ("Pending", "Inbound", None)}
    assert published_table(spark, written["refurb"][0]).count() == 1


def test_partial_or_foreign_stage_is_rebuilt(spark):
    df = spark.range(100).repartition(4)
    path = scratch_path(spark, "stage-test") + "/table"
    df.write.parquet(path)
    folder = P._Folder(spark, path)
    # parts without the commit marker, then with it but without a manifest
    folder.drop("_SUCCESS")
    folder.drop(next(f.getPath().getName() for f in folder.fs.listStatus(folder.path()) if f.getPath().getName().startswith("part")))
    assert P.committed_table(spark, path, "a") is None
    assert P.stage_table(df, path, "a").count() == 100
    assert P.committed_table(spark, path, "a").count() == 100
    # other inputs or rules under the same path
    assert P.committed_table(spark, path, "b") is None
    assert P.stage_table(spark.range(7).toDF("id"), path, "b").count() == 7
    # rows lost after the commit
    folder.drop(next(f.getPath().getName() for f in folder.fs.listStatus(folder.path()) if f.getPath().getName().startswith("part")))
    assert P.committed_table(spark, path, "b") is None


def test_changed_input_under_one_run_id_is_rebuilt(spark):
    data = scratch_path(spark, "inputs")
    spark.range(3).write.parquet(f"{data}/t.parquet")
    one = P.fingerprint(spark, [data], as_of="2021")
    assert one == P.fingerprint(spark, [data], as_of="2021") != P.fingerprint(spark, [data], as_of="2022")
    spark.range(4).write.mode("overwrite").parquet(f"{data}/t.parquet")
    assert one != P.fingerprint(spark, [data], as_of="2021")


def test_failed_copy_leaves_the_old_target_readable(spark):
    from pyspark.sql import functions as F

    target = scratch_path(spark, "target")
    P.publish_table(spark.range(5), target)
    broken = spark.range(10).select(F.when(F.col("id") < 9, F.col("id")).otherwise(F.raise_error(F.lit("lost")).cast("long")).alias("id"))
    with pytest.raises(Exception, match="lost"):
        P.publish_table(broken, target)
    assert sorted(r.id for r in published_table(spark, target).collect()) == list(range(5))
    P.publish_table(spark.range(2), target)
    assert published_table(spark, target).count() == 2
    assert len(P._Folder(spark, target).folders()) == 2  # the current version and the one before, for its readers


def test_crash_while_the_pointer_is_written_leaves_the_old_version(spark, monkeypatch):
    target = scratch_path(spark, "target")
    P.publish_table(spark.range(5), target)
    reader = published_table(spark, target)
    whole = P._Folder.write

    def dies(self, text, *names):
        if not names[-1].startswith(P.POINTER):
            return whole(self, text, *names)
        self.fs.create(self.path(*names), True).write(bytearray(text[:3].encode()))  # between create and close
        raise RuntimeError("lost")

    monkeypatch.setattr(P._Folder, "write", dies)
    with pytest.raises(RuntimeError, match="lost"):
        P.publish_table(spark.range(7), target)
    monkeypatch.undo()
    assert published_table(spark, target).count() == 5
    P.publish_table(spark.range(9), target)
    assert published_table(spark, target).count() == 9 and reader.count() == 5


def test_targets_are_counted_while_they_are_written(spark, monkeypatch):
    import json

    monkeypatch.setattr(type(spark.range(1)), "count", lambda self: pytest.fail("a target was read back"))
    for df, rows in ((spark.range(1000).repartition(7), 1000), (spark.range(10).where("id > 100").repartition(2), 0)):
        target = scratch_path(spark, "target")
        P.publish_table(df, target)
        folder = P._Folder(spark, target)
        assert json.loads(folder.read(folder.read(P.POINTER), P.MANIFEST))["rows"] == rows


def test_text_target_is_one_line_a_row(spark):
    texts = ["a\nb", "\\n", "\\", "x\r\ny", 'q"u,o', "", " b ", "\\b\n", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, t string").coalesce(1)
    target = scratch_path(spark, "lines")
    P.publish_text(df, target)
    back = {r.id: r.t for r in published_table(spark, target, "csv", P.TEXT_OPTIONS).collect()}
    assert back == {str(i): t or "" for i, t in enumerate(texts)}
    version = P._Folder(spark, target).read(P.POINTER)
    assert spark.read.text(f"{target}/{version}").count() == len(texts) + 1 and "multiLine" not in P.TEXT_OPTIONS
    big = scratch_path(spark, "many")
    P.publish_text(spark.range(200_000).selectExpr("id", "repeat('x', 20) t").coalesce(1), big)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1m")
    try:
        assert published_table(spark, big, "csv", P.TEXT_OPTIONS).rdd.getNumPartitions() > 3
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_text_target_has_blanks_and_a_header(spark):
    out = scratch_path(spark, "text-job")
    written = run(spark, "test", SF, out, copies=1, as_of=dt.datetime(2001, 8, 1), fmt="csv")
    back = published_table(spark, written["full"][0], "csv", P.TEXT_OPTIONS)
    want = QUERIES["blank_fill_export"](spark, SF)
    assert back.columns == want.columns and back.exceptAll(want).count() == 0 and back.count() == want.count()
