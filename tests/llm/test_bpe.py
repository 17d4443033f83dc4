import hashlib
import random

import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken

from forecourt.llm.bpe import Bpe, Prefixes, bpe_digests, digests, load_ranks

PATH, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def bpe():
    return Bpe(load_ranks(PATH), PATTERN)


@pytest.fixture(scope="module")
def reference(bpe):
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=bpe.ranks, special_tokens={})


def want(reference, text):
    ids = reference.encode_ordinary(text or "")
    return len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()


def test_whole_table_equals_tiktoken(spark, sf_docs, reference):
    rows = {r.doc_id: tuple(r)[1:] for r in bpe_digests(sf_docs, PATH, PATTERN).collect()}
    assert rows == {r.doc_id: want(reference, r.text) for r in sf_docs.select("doc_id", "text").collect()}


def test_random_and_odd_texts_equal_tiktoken(bpe, reference):
    rng = random.Random(9)
    letters = list(" \n\ta'sİΣé.,!1½́ 　日本語テスト😀<|>\x1c\x00×J̌ñüßthe ing") + ["the ", "ing", "  ", "\r\n", "'re"]
    vocabulary = [t.decode() for t in list(bpe.ranks)[300:40000] if t.isascii()]
    texts = ["", " ", "\n", "a" * 5000, "é" * 3000, " " * 500, "ab" * 2000 + "  c"]
    texts += ["".join(rng.choice(letters) for _ in range(rng.randint(0, 30))) for _ in range(4000)]
    texts += ["".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 8))) for _ in range(4000)]
    found = digests(bpe, pa.array(texts, pa.large_string()))
    for text, *got in zip(texts, *found):
        assert tuple(got) == want(reference, text), repr(text)


def test_appends_and_edits_are_exact(bpe):
    rng = random.Random(2)
    vocabulary = [t for t in list(bpe.ranks)[300:40000] if t.isascii()]
    for _ in range(200):
        data = b"".join(rng.choice(vocabulary) for _ in range(6))
        grown = Prefixes(bpe)
        for i in range(0, len(data), 3):
            grown.append(data[i:i + 3])
        assert grown.tokens() == bpe._merge(data, 10**9)
        lo, hi = sorted((rng.randint(0, len(data)), rng.randint(0, len(data))))
        new = rng.choice(vocabulary)
        grown.replace(lo, hi, new)
        assert grown.tokens() == bpe._merge(data[:lo] + new + data[hi:], 10**9)
        assert bpe.decode(grown.tokens()) == data[:lo] + new + data[hi:]


def test_odd_rows(spark, make_docs, reference):
    docs = [(1, None), (2, ""), (2, ""), (None, "x y"), (5, "word " * 30_000)]
    made = make_docs(docs)
    rows = bpe_digests(made.withColumn("n_tokens", made.doc_id), PATH, PATTERN).collect()
    assert sorted(map(tuple, rows), key=str) == sorted(((d, *want(reference, t)) for d, t in docs), key=str)
    assert bpe_digests(make_docs([]), PATH, PATTERN).count() == 0


def test_small_vocabulary_with_an_unreachable_token():
    ranks = {bytes([b]): b for b in range(256)} | {b"ab": 256, b"bc": 257, b"abc": 258, b"xyz": 259}
    bpe = Bpe(ranks, r"\S+|\s+")
    assert bpe.encode("abc") == [258] and bpe.encode("xyz") == [259]
    assert bpe.encode("axyz") == [97, 120, 121, 122] and bpe.encode("bcabc") == [257, 258]
