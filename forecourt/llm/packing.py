"""Sequence packing: shortest-pack-first over the length histogram.

Every document is encoded, ``end_id`` is appended, and the ids are cut into pieces: as many of
``max_tokens`` as fit, and the rest. Packing looks only at the histogram of piece lengths, which
has at most ``max_tokens`` bins whatever the corpus holds:

* lengths are placed longest first. All pieces of one length go at once: while pieces are left,
  the packs with the most room (the shortest packs) that can take the length get one each; what
  no pack can take opens new packs, as many as the remaining tokens need. Packs with equal contents are one *pattern* with a count, so a
  step changes at most two patterns;
* a pattern's sequences have consecutive numbers. Piece number ``rank`` of its length, counted over
  the corpus in the order (salt, doc_id, start), goes to the slot of that rank: slots of one length
  are numbered pattern by pattern. That is the only step over the documents, and since the
  pattern table is bounded it needs no join by a frequent length.

Ranks come from a window over (length, salt) plus the counts of the salts before, so a length that a
third of the documents share is ranked by many tasks.

Defined results: a null or empty text is the end id alone; repeated rows are packed once each;
extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import struct
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from forecourt.llm.common import materialise, shuffle_partitions
from forecourt.llm.tokens import Encoder

MAX_TOKENS = 2048
END_ID = 1


def pieces(docs: DataFrame, tokenizer: str, max_tokens: int = MAX_TOKENS, end_id: int = END_ID) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens: one row per piece."""
    end = struct.pack("<I", end_id)
    out = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
                     ("doc_tokens", pa.int64())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, ids in Encoder.of(tokenizer).batches(batches, "text"):
            rows = []
            for doc_id, x in zip(b.column(0).to_pylist(), ids):
                data, n = x.astype("<u4").tobytes() + end, len(x) + 1
                for lo in range(0, n, max_tokens):
                    size = min(max_tokens, n - lo)
                    rows.append((doc_id, lo, size, zlib.crc32(data[4 * lo:4 * (lo + size)]), n))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), out)], schema=out)

    return (docs.select(F.col("doc_id").cast("long"), "text")
            .mapInArrow(cut, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"))


def shortest_pack_first(histogram: dict[int, int], max_tokens: int = MAX_TOKENS) -> list[tuple[dict[int, int], int]]:
    """[(pattern as length -> times, how many packs)] for the given counts of lengths."""
    patterns: list[list] = []  # [room, contents, count]
    by_room: list[tuple[int, int]] = []  # heap of (-room, pattern number)
    room_left = 0

    def add(room: int, contents: Counter, count: int) -> None:
        nonlocal room_left
        if count:
            patterns.append([room, contents, count])
            if room:
                heapq.heappush(by_room, (-room, len(patterns) - 1))
                room_left += room * count

    mass = sum(length * count for length, count in histogram.items())
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left and by_room and -by_room[0][0] >= length:
            _, number = heapq.heappop(by_room)
            room, contents, count = patterns[number]
            room_left -= room * count
            # a pack takes as many of this length in a row as it stays the shortest for
            rival = -by_room[0][0] if by_room else 0
            times = min((room - max(rival, length)) // length + 1, max(1, left // count))
            take = min(count, left // times)
            patterns[number][2] = 0
            add(room, contents, count - take)
            add(room - times * length, contents + Counter({length: times}), take)
            left -= times * take
            mass -= times * take * length
        if left:
            # as many new packs as the rest of the histogram needs, the pieces spread evenly over them
            needed = -(-(mass - room_left) // max_tokens)
            packs = min(left, max(needed, -(-left // (max_tokens // length))))
            times, more = divmod(left, packs)
            add(max_tokens - (times + 1) * length, Counter({length: times + 1}), more)
            add(max_tokens - times * length, Counter({length: times}), packs - more)
            mass -= left * length
    merged: Counter = Counter()
    for _, contents, count in patterns:
        if count:
            merged[tuple(sorted(contents.items(), reverse=True))] += count
    return [(dict(p), n) for p, n in sorted(merged.items(), reverse=True)]


class Slots:
    """Where the pieces of each length go: rank of its length -> (sequence, offset)."""

    def __init__(self, packed: list[tuple[dict[int, int], int]]):
        rows, base, used = [], 0, Counter()
        for contents, count in packed:
            at = 0
            for length, times in contents.items():
                rows.append((length, used[length], times, base, at))
                used[length] += times * count
                at += length * times
            base += count
        rows.sort()
        self.length, self.first, self.times, self.base, self.at = (
            np.array(c, np.int64) for c in (zip(*rows) if rows else ([],) * 5))
        self.sequences = base

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        begin, end = (np.searchsorted(self.length, length, side) for side in ("left", "right"))
        low, high = begin.copy(), end - 1
        while (low < high).any():  # binary search within the slots of the length
            middle = (low + high + 1) // 2
            right = self.first[middle] <= rank
            low, high = np.where(right, middle, low), np.where(right, high, middle - 1)
        inside = rank - self.first[low]
        return self.base[low] + inside // self.times[low], self.at[low] + inside % self.times[low] * length


def pack(rows: DataFrame, max_tokens: int = MAX_TOKENS) -> DataFrame:
    """``rows`` (as :func:`pieces` gives them, written) with sequence_id and offset."""
    spark = rows.sparkSession
    salts = shuffle_partitions(spark)
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("doc_id", "start"), F.lit(salts)))
    counts = salted.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots = Slots(shortest_pack_first(histogram, max_tokens))  # bounded by max_tokens, whatever the corpus
    before = F.sum("n").over(Window.partitionBy("length").orderBy("salt")) - F.col("n")
    base = counts.select("length", "salt", before.alias("before"))
    inner = F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "start", "ids_crc32", "doc_tokens"))
    ranked = (salted.withColumn("inner", inner).join(base, ["length", "salt"])
              .withColumn("rank", (F.col("before") + F.col("inner") - 1).cast("long")).drop("salt", "inner", "before"))

    columns = rows.columns

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                sequence, offset = slots.place(np.asarray(b.column("length")), np.asarray(b.column("rank")))
                keep = b.select(columns)
                yield keep.append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))

    schema = rows.select("*").schema.add("sequence_id", "long").add("offset", "long")  # add() changes its schema
    return ranked.select(*columns, "rank").mapInArrow(place, schema)


def pack_documents(docs: DataFrame, tokenizer: str, max_tokens: int = MAX_TOKENS) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset: one row per piece."""
    return pack(materialise(pieces(docs, tokenizer, max_tokens), "pieces"), max_tokens)
