"""Corpus pipeline: quality rules, quality classifier, near and exact de-duplication, packing.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame.
All but the last return the columns of ``documents``. :func:`run` writes each stage's result to the
shared scratch folder and reads it back as the next one's ``docs``, so a lost executor never
repeats an earlier stage.

* ``quality_rules``: documents that fail the base rules or the adaptive fences go.
* ``quality_classifier``: documents scored below 0.7 go; learnt from the labels of this stage's input.
* ``near_duplicates``: of each SimHash component the document with the smallest id stays.
* ``repeated_passages``: bytes covered by a 100-byte string that starts earlier are cut from the
  texts (characters cut in part go whole); no document goes, a wholly repeated text becomes empty.
* ``packing``: the rest, encoded and packed into sequences of at most 2048 tokens.

No stage can be put in plain SQL as a whole (tokenizers, trained scores), so ORACLE_SQL is None and
the stages are tested against brute-force versions.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from forecourt.llm import packing, quality_model, quality_rules, simhash, substring
from forecourt.llm.common import drop, scratch
from forecourt.llm.queries import BYTE_VOCABULARY
from forecourt.sources.tables import read_table


def rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_passing(docs)


def classifier_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_model.keep_good(docs, read_table(spark, sf_dir, "labels", ["doc_id", "quality"]))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_first(docs)


def repeated_passage_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return substring.remove_repeats(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs.select("doc_id", "text"), public_tokenizers.path(BYTE_VOCABULARY))


STAGES = [
    ("quality_rules", rules_stage),
    ("quality_classifier", classifier_stage),
    ("near_duplicates", near_duplicate_stage),
    ("repeated_passages", repeated_passage_stage),
    ("packing", packing_stage),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents`` and return the rows of the last. A stage's files go as soon as
    the next stage's are written."""
    docs, before = read_table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = scratch(spark, f"stage-{name}")
        result = stage(spark, docs, sf_dir)
        result.write.parquet(path)
        docs = spark.read.schema(result.schema).parquet(path)
        if before:
            drop(spark, before)
        before = path
    return docs
