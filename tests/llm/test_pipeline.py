import corpus_pipeline as C
import public_tokenizers
import pytest
from test_simhash import brute_components, brute_fp
from test_substring import brute
from test_tokens import check_packing

from forecourt.llm import quality_rules
from forecourt.llm.common import materialise
from forecourt.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    """(input, output) of every stage, written and reread."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), {}
    for name, stage in C.STAGES:
        result = materialise(stage(spark, docs, SF), f"test-{name}")
        out[name] = (docs, result)
        docs = result
    return out


def test_all_but_the_last_return_the_columns_of_documents(spark, steps):
    columns = spark.read.parquet(f"{SF}/documents.parquet").dtypes
    assert [n for n, _ in C.STAGES] == ["quality_rules", "quality_classifier", "near_duplicates", "repeated_passages", "packing"]
    assert all(dict(out.dtypes) == dict(columns) for name, (_, out) in steps.items() if name != "packing")


def test_rules_stage_keeps_what_the_operator_keeps(steps):
    docs, out = steps["quality_rules"]
    kept = {r.doc_id for r in quality_rules.quality_rules(docs).where("kept").collect()}
    assert {r.doc_id for r in out.collect()} == kept and out.exceptAll(docs).count() == 0


def test_classifier_stage_drops_low_scores_only(spark, steps):
    docs, out = steps["quality_classifier"]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r.doc_id for r in out.collect()}
    good = [r.doc_id for r in docs.collect() if labels.get(r.doc_id) == 1]
    assert out.exceptAll(docs).count() == 0 and sum(i in kept for i in good) >= 0.95 * len(good)


def test_near_duplicate_stage_keeps_the_first_of_each_component(steps):
    docs, out = steps["near_duplicates"]
    rows = sorted(docs.collect())
    comp = brute_components([brute_fp(r.text) for r in rows])
    assert sorted(out.collect()) == [r for i, r in enumerate(rows) if comp[i] == i]


def test_passage_stage_cuts_what_stands_earlier(steps):
    docs, out = steps["repeated_passages"]
    want = {r[0]: r[1:] for r in brute([(r.doc_id, r.text) for r in docs.collect()])}
    for r in out.collect():
        n_bytes, n_removed, n_spans, _ = want[r.doc_id]
        # a character goes whole, so up to three more bytes at either end of a run
        assert 0 <= n_bytes - n_removed - len(r.text.encode()) <= 6 * n_spans and r.n_chars == len(r.text)
    assert out.count() == docs.count()


def test_packing_stage_and_run(spark, steps):
    docs, out = steps["packing"]
    assert check_packing(out.collect(), [(r.doc_id, r.text) for r in docs.collect()]) > 0.9
    ran = C.run(spark, SF)
    key = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    assert ran.select(key).exceptAll(out.select(key)).count() == 0 and ran.count() == out.count()


def test_stages_take_null_and_empty_rows(spark, make_docs):
    docs = make_docs([(1, None), (2, ""), (None, "some words here " * 40), (4, "other words there " * 30), (4, "other words there " * 30)])
    for name, stage in C.STAGES:
        docs_out = stage(spark, docs, SF)
        assert docs_out.count() <= docs.count() + 1
        assert stage(spark, make_docs([]), SF).count() == 0


def test_entry_registers_one_query_per_operator():
    import __spark_entry__ as entry

    names = entry.queries()
    assert "pipeline" in names and set(QUERIES) <= set(names)
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert public_tokenizers.path("x").endswith("x")
