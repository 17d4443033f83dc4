import hashlib
import random
import zlib

import numpy as np
import pytest

from forecourt.llm import periodic as P


def brute(words):
    """Every stretch, by the definition: (start, length, smallest period)."""
    n, out = len(words), set()
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if length >= max(6, 4 * q) and not any(all(words[k] == words[k + p] for k in range(i, i + length - p)) for p in range(1, q)):
                out.add((i, length, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_row(doc_id, text, plant=True):
    words = (text or "").encode().split()
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    n, g = len(words), h // 10
    if plant and h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute(words)
    kept = [w for i, w in enumerate(words) if not any(s + q <= i < s + size for s, size, q in runs)]
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else None
    digest = hashlib.sha256("".join(f"{s},{size},{q}\n" for s, size, q in runs).encode()).hexdigest()
    longest = (best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *longest, digest, hashlib.sha256(b" ".join(kept)).hexdigest())


@pytest.mark.parametrize("seed", range(40))
def test_runs_of_random_and_repetitive_texts(seed):
    r = random.Random(seed)
    docs = []
    for _ in range(r.randint(1, 12)):
        alphabet = [b"%d" % k for k in range(r.choice([1, 2, 2, 3, 6, 50]))]
        words = []
        while len(words) < r.choice([0, 1, 5, 30, 150]):
            unit = [r.choice(alphabet) for _ in range(r.randint(1, 12))]
            words += unit * r.choice([1, 1, 2, 4, 5, 9])
        docs.append(words)
    for words, runs in zip(docs, P.block_runs(docs)):
        assert list(zip(*(x.tolist() for x in runs))) == brute(words)


def test_extensions_equal_plain_comparison():
    r = random.Random(5)
    for _ in range(30):
        docs = [[r.randint(0, 1) for _ in range(r.randint(1, 80))] * r.randint(1, 3) for _ in range(r.randint(1, 5))]
        full = [-1]
        for k, d in enumerate(docs):
            full += [*d, -2 - k]
        pairs = [(i, j) for i in range(len(full)) for j in range(i + 1, len(full)) if full[i] >= 0 and full[j] >= 0]
        i, j = (np.array(c, np.int64) for c in zip(*pairs)) if pairs else (np.zeros(0, np.int64),) * 2
        grammar = P.Grammar(np.array(full))
        ahead, behind = grammar.extend(i, j), grammar.extend(i, j, back=True)
        for (a, b), f, g in zip(pairs, ahead.tolist(), behind.tolist()):
            assert f == next(k for k in range(len(full)) if full[a + k] != full[b + k])
            assert g == next(k for k in range(len(full)) if full[a - 1 - k] != full[b - 1 - k])


def test_one_long_text_of_one_word():
    runs = P.block_runs([[b"a"] * 300_000, [b"a"] * 5, [b"a", b"b"] * 100_000])
    assert [tuple(int(x[0]) for x in runs[k]) for k in (0, 2)] == [(0, 300_000, 1), (0, 200_000, 2)]
    assert len(runs[1].start) == 0 and len(runs[0].start) == 1 and len(runs[2].start) == 1


def test_query_rows_equal_brute_force(spark, make_docs):
    r = random.Random(1)
    rows = [(i, " ".join(r.choice(["a", "b", "cc", "é"]) for _ in range(r.choice([0, 3, 20, 90])))) for i in range(80)]
    rows += [(1000, None), (1001, ""), (1002, " \n\t "), (None, "x " * 9), (7, "x y " * 8), (7, "x y " * 8), (1003, "    a\x85b " * 6)]
    found = P.periodic_runs(make_docs(rows), plant=True).collect()
    key = lambda t: tuple((x is None, x) for x in t)
    assert sorted(map(tuple, found), key=key) == sorted((brute_row(*x) for x in rows), key=key)
    assert any(zlib.crc32(str(i).encode()) % 10 == 0 for i in range(80))


def test_query_on_the_test_table(spark, sf_docs):
    from forecourt.llm.queries import QUERIES

    found = {x.doc_id: tuple(x) for x in QUERIES["op11_periodic"](spark, "/root/testdata/sf0.001").collect()}
    docs = sf_docs.collect()
    assert len(found) == len(docs)
    for d in docs:
        if len((d.text or "").split()) < 600:
            assert found[d.doc_id] == brute_row(d.doc_id, d.text)


def test_empty_table_and_clashing_columns(spark, make_docs):
    assert P.periodic_runs(make_docs([])).count() == 0
    clash = spark.createDataFrame([(1, "a a a a a a a", 5, 6)], "doc_id long, text string, start long, n_runs long")
    (row,) = P.periodic_runs(clash).collect()
    assert (row.n_runs, row.start, row.length, row.period) == (1, 0, 7, 1)
