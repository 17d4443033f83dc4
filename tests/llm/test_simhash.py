import random
import re

import numpy as np
import pytest
import xxhash

from forecourt.llm import simhash as S


def brute_fp(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return 0
    n = max(1, len(words) - 2)
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i:i + 3]), 42) for i in range(n)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > n)


def brute_components(fps):
    up = list(range(len(fps)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= 3:
                a, b = root(i), root(j)
                up[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(fps))]


def test_whole_table_against_all_pairs(spark, sf_docs):
    rows = sorted(sf_docs.select("doc_id", "text").collect())
    fps = [brute_fp(r.text) for r in rows]
    want = {(r.doc_id, f"{f:016x}", rows[c].doc_id) for r, f, c in zip(rows, fps, brute_components(fps))}
    assert {tuple(r) for r in S.simhash(sf_docs).collect()} == want


@pytest.mark.parametrize("block", [4, 1024])
@pytest.mark.parametrize("probes", [None, "one", "two"])
def test_links_on_dense_clusters(spark, probes, block):
    rng = random.Random(5)
    fps = set()
    for _ in range(12):
        base = rng.getrandbits(64)
        for _ in range(40):
            fps.add(base ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))))
    fps = sorted(fps)
    df = spark.createDataFrame([(int(np.uint64(f).astype(np.int64)),) for f in fps], "fp long")
    plan = {None: S.plan(df, 3), "one": [(list(range(0, 32)), 1), (list(range(32, 64)), 1)],
            "two": [(list(range(0, 22)), 1), (list(range(22, 43)), 0), (list(range(43, 64)), 0)]}[probes]
    assert all(t >= 0 for _, t in plan)
    found = S.components(S.links(df, plan, 3, block=block))
    root = {r.node & (2**64 - 1): r.root & (2**64 - 1) for r in found.collect()}
    comp = brute_components(fps)
    groups = {}
    for f, c in zip(fps, comp):
        groups.setdefault(c, set()).add(f)
    got = {}
    for f in fps:
        got.setdefault(root.get(f, f), set()).add(f)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, got.values()))


def test_thresholds_keep_the_pigeonhole_sum():
    est = np.array([[5.0, 50, 500, 5000], [1, 2, 3, 4], [100, 1000, 1e4, 1e5], [1, 9, 99, 999]])
    cost, chosen = S.allocate([16] * 4, est, 3)
    assert sum(chosen) == 3 - 4 + 1 and min(chosen) >= -1 and cost > 0


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)]
    got = {r.node: r.root for r in S.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, **{i: 100 for i in range(101, 130)}}


def test_odd_rows(make_docs, spark):
    docs = make_docs([(5, None), (3, ""), (9, " \t\n"), (1, "one"), (2, "ONE"), (None, "one"), (4, "one two"),
                      (7, "word " * 30000), (7, "word " * 30000), (None, "alone here now")])
    rows = [tuple(r) for r in S.simhash(docs.withColumn("fp", docs.doc_id).withColumn("root", docs.text)).collect()]
    assert len(rows) == 10
    by_id = {r[0]: r for r in rows}
    assert by_id[5][1:] == by_id[3][1:] == by_id[9][1:] == ("0" * 16, 3)
    assert by_id[1][2] == by_id[2][2] == 1 and by_id[4][1] == f"{brute_fp('one two'):016x}"
    assert sorted(r[2] for r in rows if r[0] is None and r[2] is not None) == [1]
    assert S.simhash(make_docs([])).collect() == []


def test_keep_first_keeps_one_of_each_component(make_docs):
    docs = make_docs([(2, "a b c d e"), (1, "A b c d e"), (None, "a b c d e"), (1, "a b c d e"), (None, "x y z"),
                      (None, "x y z"), (8, "quite another text here")])
    rows = S.keep_first(docs).collect()
    assert sorted((r.doc_id is None, r.doc_id) for r in rows if r.doc_id is not None) == [(False, 1), (False, 8)]
    assert [r.text for r in rows if r.doc_id is None] == ["x y z"]
    assert S.keep_first(docs).columns == docs.columns
