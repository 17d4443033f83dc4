"""Token-id files: one concatenated id array with Elias-Fano coded document boundaries.

A file set is a Parquet folder of *segments*, each a self-contained byte string (little endian):

    magic  b"EFT1"
    header u64 documents, u64 ids, u8 bytes an id, u8 has_null_ids, u16 0, u32 0
    boundaries   Elias-Fano: the documents + 1 offsets into the id array, 0 first
    document ids Elias-Fano over (doc_id - lowest doc_id), preceded by i64 lowest doc_id
    id array     unsigned 16- or 32-bit

An Elias-Fano block of n sorted values keeps the low ``l`` bits of each value in a packed array
and the high parts in unary in a bit array, 2 + l bits a value, plus the place of every
``SELECT_EVERY``-th one bit, from which ``select(i)`` counts on; the reader gets every document's
start and end from it (``select_many``). No table of 64-bit offsets is
written. Segments are numbered in document order; a document's global start is its offset in the
segment plus the ids of all segments before.

Defined results: documents are in ascending doc_id order, null ids first, equal ids by their
tokens; a null or empty text holds the end id alone; extra columns are ignored; an empty table
gives an empty file set.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from forecourt.llm.common import scratch, shuffle_partitions
from forecourt.llm.tokens import Encoder

SELECT_EVERY = 256
#: Ids of one segment; a longer document makes a longer segment.
SEGMENT_IDS = 2_000_000
END_ID = 2
MAGIC = b"EFT1"


class EliasFano:
    """Sorted non-negative integers with constant-time-like ``select``."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.samples = n, low_bits, low, high, samples

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.uint64)
        n = len(values)
        top = int(values[-1]) if n else 0
        low_bits = max(0, (top // n).bit_length() - 1) if n else 0
        shifts = np.arange(low_bits, dtype=np.uint64)
        low = np.packbits(((values[:, None] >> shifts) & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little")
        ones = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        bits = np.zeros((int(ones[-1]) + 1) if n else 0, np.uint8)
        bits[ones] = 1
        return cls(n, low_bits, low, np.packbits(bits, bitorder="little"), ones[::SELECT_EVERY].astype(np.uint32))

    def to_bytes(self) -> bytes:
        head = struct.pack("<QBxxxIII", self.n, self.low_bits, len(self.low), len(self.high), len(self.samples))
        return head + self.low.tobytes() + self.high.tobytes() + self.samples.astype("<u4").tobytes()

    @classmethod
    def read(cls, data: memoryview, at: int) -> tuple[EliasFano, int]:
        n, low_bits, a, b, c = struct.unpack_from("<QBxxxIII", data, at)
        at += struct.calcsize("<QBxxxIII")
        low, high = np.frombuffer(data, np.uint8, a, at), np.frombuffer(data, np.uint8, b, at + a)
        samples = np.frombuffer(data, "<u4", c, at + a + b)
        return cls(n, low_bits, low, high, samples), at + a + b + 4 * c

    def select(self, i: int) -> int:
        """The i-th value: from the sampled one bit before it, count on through the high bits."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        at = int(self.samples[i // SELECT_EVERY])
        rest = i % SELECT_EVERY
        byte = at // 8
        bits = np.unpackbits(self.high[byte:byte + 1], bitorder="little").astype(np.int64)
        bits[:at % 8] = 0
        while bits.sum() <= rest:
            rest -= int(bits.sum())
            byte += 1
            bits = np.unpackbits(self.high[byte:byte + 1], bitorder="little").astype(np.int64)
        one = 8 * byte + int(np.flatnonzero(bits)[rest])
        lo, w = i * self.low_bits, self.low_bits
        piece = np.unpackbits(self.low[lo // 8:(lo + w + 7) // 8], bitorder="little")[lo % 8:lo % 8 + w]
        return ((one - i) << w) | int(sum(int(b) << k for k, b in enumerate(piece)))

    def select_many(self, places: np.ndarray) -> np.ndarray:
        """The values at ``places``: of the high bits only those between two samples around a place are read."""
        places = np.asarray(places, np.int64)
        if len(places) and not 0 <= places.min() <= places.max() < self.n:
            raise IndexError(places)
        group = places // SELECT_EVERY
        ones = np.zeros(len(places), np.int64)
        order = np.argsort(group, kind="stable")
        cuts = np.flatnonzero(np.diff(group[order], prepend=-1, append=-1)) if len(places) else []
        for mine in (order[lo:hi] for lo, hi in zip(cuts, cuts[1:])):
            g = int(group[mine[0]])
            first = int(self.samples[g]) // 8
            last = int(self.samples[g + 1]) // 8 + 1 if g + 1 < len(self.samples) else len(self.high)
            found = np.flatnonzero(np.unpackbits(self.high[first:last], bitorder="little")) + 8 * first
            ones[mine] = found[np.searchsorted(found, self.samples[g]) + places[mine] % SELECT_EVERY]
        out = (ones - places).astype(np.uint64) << np.uint64(self.low_bits)
        for k in range(self.low_bits):
            bit = places * self.low_bits + k
            out |= ((self.low[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1).astype(np.uint64) << np.uint64(k)
        return out.astype(np.int64)

    def values(self) -> np.ndarray:
        """All values, decoded at once."""
        ones = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[:self.n]
        out = (ones - np.arange(self.n)).astype(np.uint64) << np.uint64(self.low_bits)
        if self.low_bits:
            bits = np.unpackbits(self.low, bitorder="little")[:self.n * self.low_bits].reshape(self.n, -1)
            out |= (bits.astype(np.uint64) << np.arange(self.low_bits, dtype=np.uint64)).sum(1, dtype=np.uint64)
        return out.astype(np.int64)


def write_segment(doc_ids: list[int | None], ids: list[bytes]) -> bytes:
    """One segment from documents in order; ``ids`` are little-endian u32 bytes."""
    nulls = sum(d is None for d in doc_ids)  # they come first
    known = np.array([d for d in doc_ids if d is not None], np.int64)
    lowest = int(known[0]) if len(known) else 0
    stream = np.frombuffer(b"".join(ids), "<u4")
    width = 2 if not len(stream) or int(stream.max()) < 1 << 16 else 4
    starts = np.concatenate([[0], np.cumsum([len(x) // 4 for x in ids], dtype=np.int64)])
    head = MAGIC + struct.pack("<QQBxxxIq", len(ids), len(stream), width, nulls, lowest)
    span = (known.astype(object) - lowest) if len(known) else known
    return b"".join([head, EliasFano.encode(starts).to_bytes(),
                     EliasFano.encode(np.array(span, np.uint64)).to_bytes(), stream.astype(f"<u{width}").tobytes()])


def read_segment(data: bytes) -> tuple[list[int | None], EliasFano, np.ndarray]:
    """(doc_ids, boundaries, id array) of a segment."""
    if data[:4] != MAGIC:
        raise ValueError("not a token-id segment")
    n, total, width, nulls, lowest = struct.unpack_from("<QQBxxxIq", data, 4)
    view = memoryview(data)
    bounds, at = EliasFano.read(view, 4 + struct.calcsize("<QQBxxxIq"))
    known, at = EliasFano.read(view, at)
    doc_ids = [None] * nulls + [lowest + int(v) for v in known.values().astype(np.uint64)]
    if len(doc_ids) != n or bounds.n != n + 1:
        raise ValueError("segment header and contents disagree")
    return doc_ids, bounds, np.frombuffer(view, f"<u{width}", total, at)


def in_id_order(docs: DataFrame, parts: int) -> DataFrame:
    """doc_id, text, part: parts are ranges of doc_id with about as many rows each, nulls in part 0.

    The cut points are approximate quantiles of the id column alone, so the texts are neither
    sampled nor encoded twice; any cut points give the same order."""
    shares = [i / parts for i in range(1, parts)]
    cuts = docs.agg(F.percentile_approx("doc_id", shares, 10_000)).first()[0] if shares else None
    if not cuts:
        return docs.select("doc_id", "text", F.lit(0).alias("part"))
    points = F.array(*[F.lit(c).cast("long") for c in sorted(set(cuts))])
    part = F.coalesce(F.size(F.filter(points, lambda c: c < F.col("doc_id"))), F.lit(0))
    return docs.select("doc_id", "text", F.when(F.col("doc_id").isNull(), 0).otherwise(part).alias("part"))


def write_tokens(docs: DataFrame, tokenizer: str, path: str, end_id: int = END_ID,
                 segment_ids: int = SEGMENT_IDS) -> None:
    """Encode every text, append ``end_id`` and write the segments to ``path``."""
    parts = shuffle_partitions(docs.sparkSession)
    end = np.uint32(end_id)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, ids in Encoder.of(tokenizer).batches(batches, "text"):
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([_narrow(np.append(x, end)) for x in ids], pa.binary()), b.column(2)],
                names=["doc_id", "ids", "part"])

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        doc_ids: list[int | None] = []
        ids: list[bytes] = []
        part, held, number = None, 0, 0
        out = pa.schema([("part", pa.int32()), ("number", pa.int32()), ("n_docs", pa.int64()), ("n_ids", pa.int64()),
                         ("payload", pa.binary())])

        def flush():
            nonlocal held, number
            done = pa.RecordBatch.from_arrays(
                [pa.array([v], f.type) for v, f in
                 zip((part, number, len(ids), held, write_segment(doc_ids, ids)), out)], schema=out)
            doc_ids.clear()
            ids.clear()
            held, number = 0, number + 1
            return done

        for b in batches:
            for d, x, p in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                x = _wide(x)
                if ids and (p != part or held + len(x) // 4 > segment_ids):
                    yield flush()
                number = number if p == part else 0
                part = p
                doc_ids.append(d)
                ids.append(x)
                held += len(x) // 4
        if ids:
            yield flush()

    ordered = in_id_order(docs.select(F.col("doc_id").cast("long"), "text"), parts)
    (ordered.mapInArrow(encode, "doc_id long, ids binary, part int").repartitionById(parts, F.col("part"))
     .sortWithinPartitions("part", "doc_id", "ids")
     .mapInArrow(segments, "part int, number int, n_docs long, n_ids long, payload binary").write.parquet(path))


def _narrow(ids: np.ndarray) -> bytes:
    """In the shuffle: a first byte tells the width, then the ids in it."""
    width = 2 if int(ids.max(initial=0)) < 1 << 16 else 4
    return bytes([width]) + ids.astype(f"<u{width}").tobytes()


def _wide(ids: bytes) -> bytes:
    return np.frombuffer(ids, f"<u{ids[0]}", offset=1).astype("<u4").tobytes()


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files alone."""
    files = spark.read.parquet(path)

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = pa.schema([("part", pa.int32()), ("number", pa.int32()), ("doc_id", pa.int64()), ("at", pa.int64()),
                         ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])
        for b in batches:
            for part, number, payload in zip(*(b.column(i).to_pylist() for i in range(3))):
                doc_ids, bounds, ids = read_segment(payload)
                at = bounds.select_many(np.arange(bounds.n))
                crc = [zlib.crc32(ids[lo:hi].astype("<u4").tobytes()) for lo, hi in zip(at[:-1].tolist(), at[1:].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(
                        ([part] * len(doc_ids), [number] * len(doc_ids), doc_ids, at[:-1], np.diff(at), crc), out)],
                    schema=out)

    rows = files.select("part", "number", "payload").mapInArrow(
        unpack, "part int, number int, doc_id long, at long, n_tokens long, ids_crc32 long")
    # ids before a segment: first by part, then within the part, so that no task sees every segment
    sizes = files.groupBy("part").agg(F.sum("n_ids").alias("ids"))
    before_part = sizes.select("part", (F.sum("ids").over(Window.orderBy("part")) - F.col("ids")).alias("part_base"))
    inside = Window.partitionBy("part").orderBy("number")
    base = (files.select("part", "number", (F.sum("n_ids").over(inside) - F.col("n_ids")).alias("base"))
            .join(before_part, "part").select("part", "number", (F.col("base") + F.col("part_base")).alias("base")))
    return (rows.join(base, ["part", "number"])
            .select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32"))


def token_files(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Write the file set to the shared scratch folder and read it back."""
    path = scratch(docs.sparkSession, "tokens")
    write_tokens(docs, tokenizer, path)
    return read_tokens(docs.sparkSession, path)
