"""Quality rules with adaptive thresholds from mergeable quantile sketches; DataFrame functions only.

Base rules reject a document outright. For the rest, four whole-number measures are judged
against fences that each (lang, source) group sets for itself:

* a sketch is the table of counts per logarithmic bucket (exact below 64, then 32 buckets for
  each doubling, so a quantile is off by at most 1/32 of itself). Two sketches merge by adding
  counts, which is what the partial aggregation and the coarser levels (lang, everything) do;
* the upper fence is ``q50 + SPREAD * (q50 - q25) + slack``, the lower one, for the word length,
  ``q50 - SPREAD * (q75 - q50) - slack``: the spread is taken on the side away from the fence, so junk that
  lies beyond a fence moves it only when it is half of its group. A group of fewer than ``MIN_SUPPORT`` documents
  uses its language's sketch, and if that is small too, the sketch of all documents;
* the fences are joined to the documents by (lang, source), nulls being a group like any other.

Defined results: a null text has no words; a text without words fails the base rules; repeated
rows are judged alike; extra columns are carried or ignored as asked and never read; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from forecourt.llm.common import ASCII_SPACE, materialise, text_or_empty

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: Width of the fences in distances of a quartile from the median, and the smallest group that sets its own.
SPREAD = 9
MIN_SUPPORT = 200
#: measure: (numerator, factor), fenced below as well, slack. All are per word.
MEASURES = {
    "word_length": ("word_chars", 100, True, 100),
    "symbols": ("n_symbols", 1000, False, 50),
    "dup_lines": ("n_dup_lines", 1000, False, 50),
    "repeats": ("n_repeat_words", 1000, False, 150),
}
#: Fence tables up to this many (lang, source) groups are broadcast; larger ones are joined by shuffle.
BROADCAST_GROUPS = 20_000

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def with_counts(docs: DataFrame, carry: Sequence[str], text: str = "text") -> DataFrame:
    """row (struct of the ``carry`` columns) and the five counts."""
    step = docs.select(F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"), text_or_empty(text).alias("t"))
    step = step.select("row", "t", F.array_remove(F.split("t", "[\\x20\\x09-\\x0D]+"), "").alias("w"),
                       F.filter(F.split("t", "\n", -1), lambda x: F.btrim(x, F.lit(ASCII_SPACE)) != "").alias("lines"))
    step = step.select(
        "row", F.size("w").cast("long").alias("n_words"),
        F.length(F.translate("t", ASCII_SPACE, "")).cast("long").alias("word_chars"),
        (F.length("t") - F.length(F.translate("t", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.size("w") >= 3, F.transform(
            F.sequence(F.lit(0), F.size("w") - 3),
            lambda i: F.xxhash64(F.get("w", i), F.get("w", i + 1), F.get("w", i + 2)))).alias("h"))
    # most texts repeat no window: only the others pay for the sort
    step = step.withColumn("s", F.when(
        F.size(F.array_distinct("h")) < F.size("h"),
        F.sort_array(F.transform("h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    step = step.withColumn("p", F.sort_array(F.transform(
        F.filter("s", lambda e, j: (F.coalesce(e["h"] == F.get("s", j - 1)["h"], F.lit(False))
                                    | F.coalesce(e["h"] == F.get("s", j + 1)["h"], F.lit(False)))),
        lambda e: e["i"])))
    covered = F.aggregate(
        "p", F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end")),
        lambda a, i: F.struct((a["n"] + (i + 3 - F.greatest(i, a["end"]))).alias("n"), (i + 3).alias("end")),
        lambda a: a["n"])
    return step.select("row", *COUNTS[:4], F.coalesce(covered, F.lit(0).cast("long")).alias("n_repeat_words"))


def base_failed() -> F.Column:
    return ((F.col("n_words") < MIN_WORDS)
            | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))


def bucket(value: str) -> F.Column:
    """Bucket number of a whole number >= 0."""
    return F.expr(f"CASE WHEN {value} < 32 THEN {value} ELSE (length(bin({value})) - 6) * 32"
                  f" + shiftright({value}, length(bin({value})) - 6) END")


def bucket_top(number: str) -> F.Column:
    """The largest value of a bucket."""
    return F.expr(f"CASE WHEN {number} < 64 THEN {number} ELSE shiftleft({number} % 32 + 33,"
                  f" CAST({number} DIV 32 AS INT) - 1) - 1 END")


def sketches(counted: DataFrame) -> DataFrame:
    """lang, source, measure, bucket, n: the finest sketches."""
    measures = F.array(*[F.struct(F.lit(m).alias("measure"), F.expr(f"{num} * {k} DIV n_words").alias("v"))
                         for m, (num, k, _, _) in MEASURES.items()])
    return (counted.where(~base_failed()).select("lang", "source", F.explode(measures).alias("m"))
            .select("lang", "source", F.col("m.measure").alias("measure"), F.col("m.v").alias("v"))
            .groupBy("lang", "source", "measure", bucket("v").cast("long").alias("bucket"))
            .agg(F.count(F.lit(1)).alias("n")))


def quartiles(sketch: DataFrame, *level: str) -> DataFrame:
    """level columns, measure, support, q25, q50, q75 of the sketches merged to ``level``."""
    merged = sketch.groupBy(*level, "measure", "bucket").agg(F.sum("n").alias("n"))
    whole = Window.partitionBy(*level, "measure")
    ranked = (merged.withColumn("support", F.sum("n").over(whole))
              .withColumn("below", F.sum("n").over(whole.orderBy("bucket"))).withColumn("top", bucket_top("bucket")))
    return ranked.groupBy(*level, "measure").agg(
        F.max("support").alias("support"),
        *[F.min(F.when(4 * F.col("below") >= k * F.col("support"), F.col("top"))).alias(f"q{25 * k}") for k in (1, 2, 3)])


def fences(sketch: DataFrame) -> DataFrame:
    """lang, source, and lo_/hi_ for every measure."""
    levels = {"a": quartiles(sketch, "lang", "source").alias("a"), "b": quartiles(sketch, "lang").alias("b"),
              "c": quartiles(sketch).alias("c")}
    joined = (levels["a"].join(levels["b"], F.expr("a.lang <=> b.lang AND a.measure = b.measure"))
              .join(levels["c"], F.expr("a.measure = c.measure")))

    def chosen(q: str) -> F.Column:
        return (F.when(F.col("a.support") >= MIN_SUPPORT, F.col(f"a.{q}"))
                .when(F.col("b.support") >= MIN_SUPPORT, F.col(f"b.{q}")).otherwise(F.col(f"c.{q}")))

    rows = joined.select("a.lang", "a.source", "a.measure", *[chosen(q).alias(q) for q in ("q25", "q50", "q75")])
    q25, q50, q75 = F.col("q25"), F.col("q50"), F.col("q75")
    out = []
    for m, (_, _, low, slack) in MEASURES.items():
        out.append(F.max(F.when(F.col("measure") == m, q50 + SPREAD * (q50 - q25) + slack)).alias(f"hi_{m}"))
        if low:
            out.append(F.max(F.when(F.col("measure") == m, q50 - SPREAD * (q75 - q50) - slack)).alias(f"lo_{m}"))
    return rows.groupBy("lang", "source").agg(*out)


def _counted(docs: DataFrame, carry: Sequence[str], text: str) -> DataFrame:
    """row (the ``carry`` columns), lang, source and the counts."""
    for name in ("lang", "source"):
        if name not in docs.columns:
            docs = docs.withColumn(name, F.lit(None).cast("string"))
    counted = with_counts(docs, list(dict.fromkeys([*carry, "lang", "source"])), text)
    return counted.withColumns({"lang": F.col("row.lang").cast("string"), "source": F.col("row.source").cast("string")})


def _judged(counted: DataFrame, limits: DataFrame, carry: Sequence[str]) -> DataFrame:
    side = F.broadcast(limits) if limits.count() <= BROADCAST_GROUPS else limits
    joined = counted.alias("d").join(side.alias("f"), F.expr("d.lang <=> f.lang AND d.source <=> f.source"), "left")
    fits = F.lit(True)
    for m, (num, k, low, _) in MEASURES.items():
        value = F.expr(f"{num} * {k} DIV n_words")
        fits = fits & (value <= F.col(f"f.hi_{m}"))
        if low:
            fits = fits & (value >= F.col(f"f.lo_{m}"))
    row = F.struct(*[F.col(f"d.row.`{c}`").alias(c) for c in carry])
    return joined.select(row.alias("row"), *[F.col(f"d.{c}").alias(c) for c in COUNTS], base_failed().alias("base_failed"),
                         F.when(base_failed(), False).otherwise(F.coalesce(fits, F.lit(True))).alias("kept"))


def quality_rules(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, the counts, base_failed and kept. ``lang`` and ``source`` are used for the groups and count
    as null where the table has no such column."""
    counted = materialise(_counted(docs, ["doc_id"], text), "counts")
    limits = materialise(fences(sketches(counted)), "fences")
    return _judged(counted, limits, ["doc_id"]).select("row.doc_id", *COUNTS, "base_failed", "kept")


def keep_passing(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns. The counts are written with the
    rows: taken lazily, the optimizer would copy their expressions into every condition."""
    counted = materialise(_counted(docs, docs.columns, text), "counts")
    limits = materialise(fences(sketches(counted)), "fences")
    return _judged(counted, limits, docs.columns).where("kept").select("row.*")
