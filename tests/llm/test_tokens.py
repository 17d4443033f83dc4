import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from forecourt.llm import packing, token_files
from forecourt.llm.tokens import Encoder
from forecourt.llm.token_files import EliasFano

WORD, BYTE = (public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json"))
ODD = ["", " ", "  a", "a  b", "a \n b\n\n c ", "İ. x", "ΣΑΣ. Σ", "don't DON'T 'S 's", "éa ́b", "<|endoftext|> a<|startoftext|>b",
       "\x1ca\x1c b", "日本語 テスト。 1234 5", "x\t y\t\tz \t", "½ ² Ⅷ", "a.̇b", "  a 　b", "J̌ K̂.,x \x00 \x01a", "a×. b÷, c",
       "".join(map(chr, range(1, 40))) + " mixed", "z" * 50_000, "word " * 20_000]
LETTERS = " \n\ta'sİΣé.,!1½́ 　日<|>\x1c\x00×J̌"


def plain(path, text, end):
    return Encoder(path).tokenizer.encode(text or "", add_special_tokens=False).ids + [end]


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_blocks_equal_the_library(path):
    rng = random.Random(3)
    texts = ODD + ["".join(rng.choice(LETTERS) for _ in range(rng.randint(1, 25))) for _ in range(1500)] + [None]
    encoder = Encoder(path)
    for some in (texts, *[[t] for t in texts[:60]]):
        ids, bounds = encoder.block(pa.array(some, pa.string()))
        for text, lo, hi in zip(some, bounds, bounds[1:]):
            assert ids[lo:hi].tolist() == encoder.tokenizer.encode(text or "", add_special_tokens=False).ids, repr(text)


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_added_tokens_as_the_file_has_them(path):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(path)
    texts = ["a <|endoftext|> b", "plain. text", None, "<|endoftext|>", "A<|EndOfText|>, b", "x.<|startoftext|>.\ny <|endoftext|><|endoftext|>é",
             "", "<|endof text|> <|", "word " * 500 + "<|endoftext|>"]
    for some in (texts, *[[t] for t in texts]):
        ids, bounds = Encoder(path).block(pa.array(some, pa.string()))
        for text, lo, hi in zip(some, bounds, bounds[1:]):
            assert ids[lo:hi].tolist() == library.encode(text or "", add_special_tokens=False).ids, repr(text)


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_every_code_point_before_a_stop_and_a_space(path):
    """Letters that composition takes apart end in a mark, which goes into one piece with a full stop."""
    encoder = Encoder.of(path)
    points = [chr(c) for c in [*range(0xD800), *range(0xE000, 0x10000)]]
    for form in ("{0}.", "a{0}, b", "{0} {0}"):
        texts = [form.format(c) for c in points]
        want = [e.ids for e in encoder.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        ids, bounds = encoder.block(pa.array(texts, pa.string()))
        assert [t for t, w, lo, hi in zip(texts, want, bounds.tolist(), bounds[1:].tolist()) if w != ids[lo:hi].tolist()] == []


def test_the_memo_is_bounded_and_outlives_blocks(monkeypatch):
    encoder = Encoder(BYTE)
    monkeypatch.setattr(Encoder, "MEMO", 50)
    for k in range(20):
        text = " ".join(f"w{chr(97 + k)}{chr(97 + i % 26)}" for i in range(40))
        ids, _ = encoder.block(pa.array([text], pa.string()))
        assert ids.tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids and len(encoder.memo) <= 50 + 40


def test_elias_fano_selects_every_value():
    rng = random.Random(1)
    for n in (0, 1, 2, 255, 256, 257, 3000):
        values = sorted(rng.randrange(10 ** rng.randint(1, 14)) for _ in range(n))
        coded, _ = EliasFano.read(memoryview(EliasFano.encode(np.array(values, np.uint64)).to_bytes()), 0)
        assert coded.values().tolist() == values
        assert all(coded.select(i) == values[i] for i in range(0, n, 1 + n // 50))
        if n > 1000:
            assert len(EliasFano.encode(np.array(values, np.uint64)).to_bytes()) < 8 * n


def test_select_of_many_places():
    rng = random.Random(2)
    for n in (1, 2, 255, 256, 257, 3000):
        for values in (sorted(rng.randrange(10 ** rng.randint(1, 14)) for _ in range(n)), list(range(n)), [0] * (n - 1) + [10**12]):
            coded, _ = EliasFano.read(memoryview(EliasFano.encode(np.array(values, np.uint64)).to_bytes()), 0)
            places = [rng.randrange(n) for _ in range(50)]
            assert coded.select_many(places).tolist() == [values[i] for i in places]
            assert coded.select_many(np.arange(n)).tolist() == values
    assert coded.select_many([]).tolist() == []
    for outside in (-1, n):
        with pytest.raises(IndexError):
            coded.select_many([0, outside])


def test_token_files_against_a_plain_loop(spark, sf_docs):
    rows = sorted((r.doc_id, r.text) for r in sf_docs.select("doc_id", "text").collect())
    want, start = [], 0
    for doc_id, text in rows:
        ids = np.array(plain(WORD, text, 2), "<u4")
        want.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(tuple(r) for r in token_files.token_files(sf_docs, WORD).collect()) == want


def test_token_files_odd_rows(spark, make_docs):
    docs = make_docs([(3, None), (1, "b"), (1, "a"), (None, "n"), (-5, "w " * 3000), (2**62, ""), (1, "a")])
    docs = docs.withColumn("part", docs.text).withColumn("ids", docs.doc_id)
    rows = sorted((tuple(r) for r in token_files.token_files(docs, WORD).collect()), key=lambda r: r[1])
    assert [r[0] for r in rows] == [None, -5, 1, 1, 1, 3, 2**62]
    assert [r[1] for r in rows] == [0, *np.cumsum([r[2] for r in rows])[:-1].tolist()]
    assert rows[-1][2:] == (1, zlib.crc32(np.array([2], "<u4").tobytes())) and rows[5][2] == 1
    assert token_files.token_files(make_docs([]), WORD).count() == 0


def test_segments_split_and_keep_global_starts(spark, sf_docs):
    from forecourt.session import scratch_path

    path = scratch_path(spark, "segments")
    token_files.write_tokens(sf_docs, WORD, path, segment_ids=2000)
    assert spark.read.parquet(path).count() > 20
    few = sorted(tuple(r) for r in token_files.read_tokens(spark, path).collect())
    assert few == sorted(tuple(r) for r in token_files.token_files(sf_docs, WORD).collect())


def check_packing(rows, docs, max_tokens=2048):
    """Every id in exactly one piece, sequences gapless and within bounds."""
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append((r.start, r.length, r.ids_crc32, r.doc_tokens))
        by_seq.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for doc_id, text in docs:
        ids, at = np.array(plain(BYTE, text, 1), "<u4"), 0
        for start, length, crc, total in sorted(by_doc.pop(doc_id)):
            assert start == at and total == len(ids) and crc == zlib.crc32(ids[at:at + length].tobytes())
            at += length
        assert at == len(ids)
    assert not by_doc
    for spans in by_seq.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= max_tokens
    return sum(r.length for r in rows) / (len(by_seq) * max_tokens)


def test_packing_whole_table(spark, sf_docs):
    docs = [tuple(r) for r in sf_docs.select("doc_id", "text").collect()]
    assert check_packing(packing.pack_documents(sf_docs, BYTE).collect(), docs) > 0.97


def test_packing_odd_rows(spark, make_docs):
    docs = [(1, None), (2, ""), (3, "a b " * 5000), (4, "x"), (5, "x"), (None, "x")]
    made = make_docs(docs)
    check_packing(packing.pack_documents(made.withColumn("salt", made.text).withColumn("rank", made.doc_id), BYTE).collect(), docs)
    twice = packing.pack_documents(make_docs([(7, "same"), (7, "same")]), BYTE).collect()
    assert sorted((r.sequence_id, r.offset) for r in twice) == [(0, 0), (0, twice[0].length)]
    assert packing.pack_documents(make_docs([]), BYTE).count() == 0


@pytest.mark.parametrize("histogram", [{1: 100_000, 2: 3}, {2048: 5, 1: 1}, {1500: 10, 600: 7, 548: 10}, {7: 10**6, 2047: 3, 100: 999}, {}])
def test_shortest_pack_first_places_every_length(histogram):
    packed = packing.shortest_pack_first(histogram)
    used = {}
    for contents, count in packed:
        assert count > 0 and sum(size * n for size, n in contents.items()) <= 2048
        for size, n in contents.items():
            used[size] = used.get(size, 0) + n * count
    assert used == histogram
    slots = packing.Slots(packed)
    length = np.repeat(list(histogram), list(histogram.values())).astype(np.int64)
    rank = np.concatenate([np.arange(n) for n in histogram.values()] or [np.zeros(0, np.int64)])
    sequence, offset = slots.place(length, rank)
    order = np.lexsort((offset, sequence))
    end = (offset + length)[order]
    assert ((offset[order][1:] == end[:-1]) | (offset[order][1:] == 0)).all() and len(set(zip(sequence, offset))) == len(rank)
