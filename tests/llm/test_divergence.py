import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from oracle import compare, duck

from forecourt.llm import divergence as D
from forecourt.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.01"
TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def brute(rows, least):
    found, docs = [], defaultdict(Counter)
    lists = []
    for text, lang, source in rows:
        folded = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        lists.append((lang or "", source or "", TERM.findall(folded)))
        docs[lang or ""].update(set(lists[-1][2]))
    for lang in docs:
        kept = sorted(t for t, n in docs[lang].items() if n >= least)
        counts = defaultdict(Counter)
        for la, s, words in lists:
            if la == lang:
                counts[s].update(w for w in words if w in set(kept))
        whole = sum(counts.values(), Counter())

        def p(c):
            total = sum(c.values())
            return {t: 1 + 10**9 * (c[t] + 2) // (total + 2 * len(kept)) for t in kept}
        q, ps = p(whole), {s: p(c) for s, c in counts.items()}
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in counts:
            pair = [(-sum(f(ps[s][t], ps[o][t]) for t in kept), o.encode(), o) for o in counts if o != s]
            term = [(-f(ps[s][t], q[t]), t.encode(), t) for t in kept if counts[s][t] and ps[s][t] > q[t]]
            found += [(lang, s, "pair", o, -v, k) for k, (v, _, o) in enumerate(sorted(pair), 1)]
            found += [(lang, s, "term", t, -v, k) for k, (v, _, t) in enumerate(sorted(term)[:10], 1)]
    return sorted(found)


def corpus(seed, n=150):
    r = random.Random(seed)
    vocabulary = ["The", "fox", "Ünder", "日本", "x y", "été", "don't", "a1b", "ÀÀ", "z"] + [f"w{chr(97 + k)}" for k in range(20)]
    rows = [(" ".join(r.choices(vocabulary, k=r.choice([0, 1, 5, 60]))), r.choice(["en", "fr", None, "xx"]), r.choice(["a", "b", None, "é", "c"]))
            for _ in range(n)]
    return rows + [(None, "en", "empty"), ("", "lonely", "s"), ("", "lonely", "t"), ("1 2 3", None, None), ("fox " * 30000, "en", "a")]


@pytest.fixture(scope="module")
def frame(spark):
    return lambda rows: spark.createDataFrame(rows, "text string, lang string, source string")


@pytest.mark.parametrize("seed, options", [(1, {}), (2, {"shard_keys": 4, "cells": 64}), (3, {"shard_keys": 3, "broadcast_bytes": 100})])
def test_equals_brute_force(frame, seed, options):
    rows = corpus(seed)
    found = D.source_divergence(frame(rows).repartition(3), min_docs=5, **options).collect()
    assert sorted(map(tuple, found)) == brute(rows, 5)


def test_blocks_of_slots(frame, monkeypatch):
    r = random.Random(4)
    words = [f"{chr(97 + a)}{chr(97 + b)}" for a in range(20) for b in range(20)]
    rows = [(" ".join(r.choices(words, k=80)), "en", r.choice("abc")) for _ in range(60)]
    found = D.source_divergence(frame(rows), min_docs=2, cells=64 * 3, shard_keys=50).collect()
    assert sorted(map(tuple, found)) == brute(rows, 2)


def test_perfect_hash_is_minimal_and_tells_strangers():
    keys = [f"key {i}".encode() for i in range(20_000)] + [b"", "é".encode()]
    done = D.PerfectHash.read(D.PerfectHash.build(keys).to_bytes())
    slots = done.slots(keys, D.hashes(keys))
    assert sorted(slots.tolist()) == list(range(len(keys)))
    assert done.keys.take(slots).to_pylist() == keys
    strangers = [f"no {i}".encode() for i in range(20_000)]
    assert (done.slots(strangers, D.hashes(strangers)) == -1).all()
    assert len(D.PerfectHash.build(keys).words) * 64 < 4 * len(keys)  # under four bits a key


def test_keys_with_equal_hashes(monkeypatch):
    monkeypatch.setattr(D, "hashes", lambda keys: np.fromiter((len(k) for k in keys), np.uint64, len(keys)))
    keys = [b"a", b"b", b"cc", b"dd", b"eee"]
    done = D.PerfectHash.read(D.PerfectHash.build(keys).to_bytes())
    assert sorted(done.slots(keys, D.hashes(keys)).tolist()) == [0, 1, 2, 3, 4]
    assert done.slots([b"x", b"eee", b"yy"], D.hashes([b"x", b"eee", b"yy"])).tolist()[::2] == [-1, -1]


def test_probabilities_beyond_64_bits():
    n = np.array([0, 5, 10**12, 2 * 10**13])
    assert D.probabilities(n, 10**14, 7).tolist() == [1 + 10**9 * (int(x) + 2) // (10**14 + 14) for x in n]


def test_empty_table_and_clashing_columns(spark, frame):
    assert D.source_divergence(frame([])).count() == 0
    clash = spark.createDataFrame([("a b", "en", "s", 1, 2)] * 12 + [("a", "en", "t", 1, 2)] * 3, "text string, lang string, source string, n long, slot long")
    rows = [("a b", "en", "s")] * 12 + [("a", "en", "t")] * 3
    assert sorted(map(tuple, D.source_divergence(clash).collect())) == brute(rows, 10)


def test_query_equals_sql(spark):
    con = duck(SF)
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    same, why = compare(QUERIES["op12_divergence"](spark, SF), con, ORACLE_SQL["op12_divergence"])
    assert same, why
