import hashlib
import random

import numpy as np
import pytest

from forecourt.llm import substring as S


def brute(rows):
    """rows: (doc_id, text). Windows in document order (null ids last), a set of all seen before."""
    seen, out = set(), []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for i in range(len(data) - 99):
            w = data[i:i + 100]
            if w in seen:
                gone[i:i + 100] = True
            seen.add(w)
        spans = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        kept = bytes(np.frombuffer(data, np.uint8)[~gone])
        out.append((doc_id, len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def check(docs, rows):
    assert sorted((tuple(r) for r in S.substring_report(docs).collect()), key=str) == brute(rows)


def test_whole_table_against_every_window(sf_docs):
    check(sf_docs, [tuple(r) for r in sf_docs.select("doc_id", "text").collect()])


@pytest.mark.parametrize("batch", [3000, 16_000_000])
def test_edited_copies_and_shared_passages(spark, make_docs, monkeypatch, batch):
    monkeypatch.setattr(S, "BATCH_BYTES", batch)
    monkeypatch.setattr(S, "HASH_BYTES", max(500, batch // 8))
    rng = random.Random(batch)
    word = lambda: "".join(rng.choice("abcdé") for _ in range(rng.randint(1, 7)))
    passage = " ".join(word() for _ in range(40))
    base = [word() for _ in range(300)]
    rows = []
    for i in range(60):
        kind, words = i % 4, list(base)
        if kind == 0:
            for _ in range(rng.randint(0, 6)):
                words[rng.randrange(len(words))] = word()
        elif kind == 1:
            words = [word() for _ in range(100)] + [passage] + [word() for _ in range(50)] + [passage]
        elif kind == 2:
            words = [word() for _ in range(rng.randint(1, 200))]
        else:
            words = base[rng.randrange(200):][:rng.randint(1, 100)]
        rows.append((i, " ".join(words)))
    rng.shuffle(rows)
    docs = make_docs(rows).repartition(5)
    check(docs, rows)


def test_odd_rows(make_docs):
    long = "x" * 250
    rows = [(1, None), (2, ""), (3, "short"), (4, long), (5, "y" * 99), (6, "y" * 99), (7, "z" * 100), (8, "z" * 100),
            (9, "ab" * 400), (9, "ab" * 400), (None, "ab" * 400), (None, "q" * 5), (12, "é" * 60 + "k" * 50),
            (13, "é" * 60 + "k" * 50), (10, "w" * 300_000)]
    docs = make_docs(rows)
    check(docs.withColumn("rid", docs.text).withColumn("late", docs.doc_id), rows)
    assert S.substring_report(make_docs([])).collect() == []
    cut = S.remove_repeats(docs.withColumn("rid", docs.doc_id))
    assert cut.columns == [*docs.columns, "rid"] and cut.count() == len(rows)
    by_id = {r.doc_id: r for r in cut.collect()}
    assert by_id[1].text is None and by_id[8].text == "" and by_id[8].n_chars == 0 and by_id[7].text == "z" * 100
    assert by_id[4].text == "x" and by_id[13].text == ""


def test_family_merges_geometrically_and_keeps_the_first_places():
    rng = np.random.default_rng(3)
    family, first, late = S.Family(), {}, []
    for _ in range(40):
        key = rng.integers(0, 500, 100).astype(np.uint64)
        doc, at = rng.integers(0, 1000, 100), rng.integers(0, 50, 100).astype(np.int32)
        pairs = list(zip(key.tolist(), zip(doc.tolist(), at.tolist())))
        for d, a, _ in family.add(key, key, doc, at, np.zeros(100, np.uint8), np.zeros(100, bool)):
            late += list(zip(d.tolist(), a.tolist()))
        for k, p in pairs:
            first[k] = min(first.get(k, p), p)
        sizes = [len(x[0]) for x in family.levels]
        assert all(a >= 2 * b for a, b in zip(sizes, sizes[1:]))
    key, _, doc, at, _, _ = family.whole()
    assert {k: (d, a) for k, d, a in zip(key.tolist(), doc.tolist(), at.tolist())} == first
    assert len(late) == 4000 - len(first)


def test_packed_batches_come_back():
    rng = np.random.default_rng(1)
    doc = np.sort(rng.integers(-5, 40, 500))
    at = rng.integers(0, 2**31 - 1, 500).astype(np.int32)
    order = np.lexsort((at, doc))
    cols = [doc[order], at[order], rng.integers(0, 66, 500).astype(np.uint8), rng.integers(0, 2**64, 500, dtype=np.uint64),
            rng.integers(0, 2**64, 500, dtype=np.uint64), rng.integers(0, 2, 500).astype(bool)]
    key, check, d, a, w, f = S.unpack(S.pack(*cols), True)
    assert all((x == y).all() for x, y in zip((d, a, w, key, check, f), cols))
    assert all((x == y).all() for x, y in zip(S.unpack(S.pack(*cols[:3]), False), cols))
