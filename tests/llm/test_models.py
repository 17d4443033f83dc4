import math
import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from forecourt.llm import langid, quality_model
from forecourt.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def test_language_held_out_accuracy(spark):
    found = QUERIES["op3_langid"](spark, SF)
    lang = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    rows = found.join(lang, "doc_id").where("held_out AND lang IS NOT NULL").collect()
    assert len(rows) > 150 and sum(r.lang_pred == r.lang for r in rows) / len(rows) > 0.97
    assert all(0 <= r.score <= 1 for r in rows) and sum(r.rejected for r in rows) < 0.1 * len(rows)
    assert found.count() == lang.count()


def brute_kn(texts, order=4):
    """Interpolated Kneser-Ney by dictionaries; returns p(character | context)."""
    from collections import Counter

    def framed(text):
        folded = "".join(c.lower() if c.isalpha() else " " for c in text).split()
        return " " * (order - 1) + "".join(w + " " for w in folded) if folded else " " * (order - 1)
    counts = Counter(s[i:i + order] for s in map(framed, texts) for i in range(len(s) - order + 1))
    tables = {}
    for n in range(order, 0, -1):
        n1, n2 = (sum(v == k for v in counts.values()) for k in (1, 2))
        tables[n] = (counts, (n1 + 1) / (n1 + 1 + 2 * (n2 + 1)))
        counts = Counter(g[1:] for g in counts)
    vocabulary = len(tables[1][0]) + 1

    def p(gram, n=order):
        if n == 0:
            return 1 / vocabulary
        table, d = tables[n]
        after = {g: v for g, v in table.items() if g[:-1] == gram[:-1]}
        if not after:
            return p(gram[1:], n - 1)
        total = sum(after.values())
        return max(after.get(gram, 0) - d, 0) / total + d * len(after) / total * p(gram[1:], n - 1)
    return p, framed


def test_model_equals_brute_force_kneser_ney(spark):
    texts = ["the cat sat on the mat", "That hat, the cat!", "éa ñu the 12 mat", ""]
    model = langid.train(spark.createDataFrame([(t, "xx") for t in texts], "text string, lang string"))
    p, framed = brute_kn(texts)
    for text in [*texts[:3], "zebra the quiz", "q"]:
        s = framed(text)
        want = -np.mean([np.log(p(s[i - 3:i + 1])) for i in range(3, len(s))])
        loss, n, letters = langid.Scorer(model).entropies([text])
        assert n[0] == len(s) - 3 and letters[0] and abs(loss[0, 0] - want) < 1e-5


def test_model_keeps_every_gram_of_a_rare_language(spark, monkeypatch):
    """A hot and a rare language, with more grams than are held in memory."""
    for name, most in (("HELD_LOSSES", 200), ("MAX_GRAMS", 100)):  # the bound, and the cap that stood in its place
        monkeypatch.setattr(langid, name, most, raising=False)
    rng = random.Random(5)
    letters = "the quick brown fox jumps over the lazy dog"  # both see the same characters
    hot = [letters, *(" ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(40)) for _ in range(10))] * 3
    rare = [letters, "zebra quiz jukebox vex", "vex quiz, zebra"]
    learn = spark.createDataFrame([(t, "hot") for t in hot] + [(t, "rare") for t in rare], "text string, lang string")
    texts = [*rare, hot[1], "quiz abc zebra", "éa unseen words", ""]
    loss = langid.Scorer(langid.train(learn)).entropies(texts)[0]
    for j, own in enumerate((hot, rare)):
        p, framed = brute_kn(own)
        for i, s in enumerate(map(framed, texts)):
            want = [-np.log(p(s[x - 3:x + 1])) for x in range(3, len(s))]
            assert abs(loss[i, j] - (np.mean(want) if want else 0)) < 1e-5
    monkeypatch.setattr(langid, "HELD_LOSSES", 10**6)  # what is held decides nothing
    assert (langid.Scorer(langid.train(learn)).entropies(texts)[0] == loss).all()


def test_language_odd_rows(spark, make_docs):
    docs = make_docs([(1, None, "en"), (2, "", "en"), (3, "123 !!", "en"), (4, "the cat " * 30_000, "en"), (5, "der hund ist", "de"),
                      (6, "the cat", None), (7, "́́", "en"), (None, "der hund", "de"), (7, "日本語", "ja")])
    rows = langid.identify(docs.withColumn("score", docs.text), docs).collect()
    by = {(r.doc_id, r.lang_pred) for r in rows}
    assert len(rows) == 9 and {(1, "und"), (2, "und"), (3, "und"), (4, "en"), (5, "de"), (6, "en"), (7, "und"), (None, "de"), (7, "ja")} == by
    assert all(r.score == 0 for r in rows if r.lang_pred == "und")
    assert langid.identify(make_docs([]), make_docs([])).count() == 0
    assert {r.lang_pred for r in langid.identify(docs, make_docs([])).collect()} == {"und"}
    one = langid.identify(docs.where("doc_id = 4"), docs.where("lang = 'en'")).first()
    assert one.lang_pred == "en" and 0 <= one.score <= 1


def test_quality_held_out_accuracy(spark):
    found = QUERIES["op9_quality_model"](spark, SF)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = found.join(labels, "doc_id").where("held_out").collect()
    assert len(rows) > 60 and sum(r.predicted == r.quality for r in rows) / len(rows) > 0.95
    assert found.where("score < 0 OR score > 1 OR (score >= 0.7) <> (predicted = 1)").count() == 0
    assert found.count() == spark.read.parquet(f"{SF}/documents.parquet").count()


def test_isotonic_pools_violators():
    positions, values = quality_model.isotonic(np.array([2, 0, 2, 2, 4]), np.array([1, 0, 0, 2, 4]))
    assert positions.tolist() == [1.5, 3.5 + 4 / 6] and values.tolist() == [0.25, 1.0]


def test_features_approximate_the_gaussian_kernel():
    rng = np.random.default_rng(0)
    k = len(quality_model.STATISTICS)
    z = quality_model.Features(np.zeros(k), np.ones(k))
    x = rng.normal(0, 1, (40, k))
    d2 = ((x[:, None] - x[None]) ** 2).sum(-1)
    want = np.exp(-d2 / (2 * quality_model.WIDTH**2))
    got = z(x)[:, :-1] @ z(x)[:, :-1].T
    assert np.abs(got - want).mean() < 0.06


def test_quality_odd_rows(spark, make_docs):
    rng = random.Random(1)
    good = [(i, " ".join("".join(rng.choice("abcde") for _ in range(5)) for _ in range(80))) for i in range(200)]
    bad = [(i, "### " * 80) for i in range(200, 300)]
    docs = make_docs([*good, *bad, (900, None), (901, ""), (None, "x"), (902, "w " * 100_000), (902, "w " * 100_000)])
    labels = spark.createDataFrame([(i, int(i < 200), 0) for i in range(300)] + [(None, 1, 0), (5, None, 0), (10**9, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    learn = quality_model.quality_labels(labels)
    rows = quality_model.classify(docs.withColumn("x", docs.text), learn, ["doc_id"]).collect()
    assert len(rows) == 305
    assert sum(r.predicted == (r.doc_id < 200) for r in rows if r.doc_id is not None and r.doc_id < 300) == 300
    kept = quality_model.keep_good(docs, labels)
    assert kept.columns == docs.columns and kept.where(F.col("doc_id") < 300).count() == 200
    none = quality_model.classify(docs, learn.where("false"), ["doc_id"]).select("score").distinct().collect()
    assert [r.score for r in none] == [0.5]
    assert quality_model.classify(make_docs([]), learn, ["doc_id"]).count() == 0


def plain_statistics(text):
    words = text.split()
    n, size = max(len(words), 1), max(len(text), 1)
    triples = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    lines = [x for x in text.split(b"\n") if x.strip()]
    shares = [text.count(bytes([c])) / size for c in range(256)]
    count = lambda keep: sum(1 for c in text if keep(chr(c)))
    return [math.log(1 + len(words)), math.log(1 + len(text)), sum(len(w) for w in words) / n, len(set(words)) / n,
            max((words.count(w) for w in set(words)), default=0) / n, 1 - len(set(triples)) / len(triples) if triples else 0.0,
            sum(a == b for a, b in zip(words, words[1:])) / n, count(lambda c: "A" <= c <= "Z") / size,
            count(lambda c: "0" <= c <= "9") / size, count(lambda c: c in "#*$%&|<>") / n,
            count(lambda c: c in "!\"'()+,-./:;=?@[\\]^_`{}~") / n, len(lines) / n, 1 - len(set(lines)) / max(len(lines), 1),
            sum(shares[128:]), -sum(p * math.log2(p) for p in shares if p)]


def plain_scores(documents, labels):
    """The classifier on whole tables: {doc_id: score}, in plain floats, the calibration by the min-max formula."""
    q = quality_model
    x = np.array([plain_statistics((t or "").encode()) for _, t in documents])
    scaled = np.clip((x - x.mean(0)) / np.where(x.std(0) > 0, x.std(0), 1), -q.REACH, q.REACH)
    rng = np.random.default_rng(q.SEED)
    w, b = rng.normal(0, 1 / q.WIDTH, (x.shape[1], q.FEATURES)), rng.uniform(0, 2 * np.pi, q.FEATURES)
    z = np.hstack([np.sqrt(2 / q.FEATURES) * np.cos(scaled @ w + b), np.ones((len(x), 1))])
    place = {d: i for i, (d, _) in enumerate(documents)}
    taught = [(place[d], y, zlib.crc32(str(d).encode()) % 4) for d, y in labels if d in place and y in (0, 1)]
    fit, rest = ([(i, y) for i, y, f in taught if f in part] for part in ((0, 1), (3,)))
    rows, y = map(np.array, zip(*fit))
    ridge = q.RIDGE * len(fit) / z.shape[1] * np.eye(z.shape[1])
    raw = z @ np.linalg.solve(z[rows].T @ z[rows] + ridge, z[rows].T @ y)
    at = np.clip((raw - q.SCORE_RANGE[0]) / (q.SCORE_RANGE[1] - q.SCORE_RANGE[0]) * q.BINS, 0, q.BINS - 1)
    held, kind = map(np.array, zip(*rest))
    n, ones = (np.bincount(at[held].astype(int), weights=v, minlength=q.BINS) for v in (None, kind))
    bins = np.flatnonzero(n)
    n, ones = n[bins].astype(float), ones[bins]
    mean = [[ones[j:k + 1].sum() / n[j:k + 1].sum() if j <= k else None for k in range(len(bins))] for j in range(len(bins))]
    level = [max(min(mean[j][k] for k in range(i, len(bins))) for j in range(i + 1)) for i in range(len(bins))]
    pools = [np.flatnonzero(np.isclose(level, v, rtol=1e-12, atol=0)) for v in sorted(set(np.round(level, 12)))]
    pools = [p for p in pools if len(p)]
    where = [(n[p] * (bins[p] + 0.5)).sum() / n[p].sum() for p in pools]
    return dict(zip(place, np.clip(np.interp(at, where, [level[p[0]] for p in pools]), 0, 1).tolist()))


def test_quality_scores_equal_a_plain_version_on_a_whole_table(spark):
    documents = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    labels = [tuple(r) for r in spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality").collect()]
    want = plain_scores(documents, labels)
    got = {r.doc_id: r.score for r in QUERIES["op9_quality_model"](spark, SF).collect()}
    off = sorted(abs(got[d] - want[d]) for d in want)
    assert set(got) == set(want) and off[int(0.99 * len(off))] < 1e-3
    assert sum((got[d] >= quality_model.THRESHOLD) != (want[d] >= quality_model.THRESHOLD) for d in want) <= len(want) // 500


def test_quality_scores_do_not_depend_on_the_order_of_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    learn = quality_model.quality_labels(spark.read.parquet(f"{SF}/labels.parquet"))

    def scores(parts):
        dealt = docs.repartition(parts, F.xxhash64("doc_id", F.lit(parts)))
        return {r.doc_id: r.score for r in quality_model.classify(dealt, learn, ["doc_id"]).collect()}

    assert scores(1) == scores(7)
