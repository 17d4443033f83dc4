"""How the sources of a language differ: an exact recount of frequent terms through minimal perfect hashes.

A *term* is a run of ASCII letters and non-ASCII characters, A-Z lower-cased. A language keeps the terms that
``MIN_DOCS`` of its documents hold. Then each (lang, source) group and each language counts the kept terms, and
groups are compared term by term with each other and with their language.

1. **Exact frequency filter.** Tasks count the documents of every (lang, term) and combine them before the shuffle.
2. **Perfect hashes.** The kept terms of a language are dealt by hash to shards of about ``SHARD_KEYS``. For each shard
   :class:`PerfectHash` gives every key a slot of its own from 0 on: levels of bit arrays, in which a key that
   falls on a place alone is settled and the others go on to the next, smaller level; the slot is the number of one
   bits before it. The keys are stored in slot order, so a term that is no key is told by comparing.
3. **Recount.** If all shards hold at most ``BROADCAST_BYTES`` they are broadcast and the second pass over the texts
   increments a dense array of slots per group, sent off as non-zero counts when the arrays hold
   ``HELD_BYTES``. Beyond that size the texts are counted by plain terms once, dealt into as many rounds as
   there are broadcasts of that size, and each round's counts go through its own shards.
4. **Comparison.** Slots are cut into blocks; a task has the counts of one block of one language as a dense matrix of
   sources by slots, and emits sums for the pairs of sources and each source's first terms. The result has a row
   for every ordered pair of sources of a language.

All arithmetic is on integers (64 bits where they suffice, else Python's).

Defined results: null text, lang and source are the empty string; empty texts have no term; repeated rows
count as documents of their own; groups without terms take part in the pairs; ties go by the UTF-8 order of
the item; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import struct
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from forecourt.llm.common import byte_sized, materialise, texts

MIN_DOCS = 10
SCALE = 1_000_000_000
TOP_TERMS = 10
SHARD_KEYS = 1 << 15
BROADCAST_BYTES = 64_000_000
HELD_BYTES = 128_000_000
HELD_TERMS = 1_000_000
BLOCK_BYTES = 8_000_000
#: Counts of one block of slots in the comparison.
CELLS = 1 << 17

_FOLD = bytes((b | 32) if chr(b).isascii() and chr(b).isalpha() else b if b >= 128 else 32 for b in range(256))


def terms(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


def hashes(keys: list[bytes]) -> np.ndarray:
    """What Spark's xxhash64 gives, as unsigned numbers."""
    return np.fromiter((xxhash.xxh64_intdigest(k, 42) for k in keys), np.uint64, len(keys))


def shard_of(hashed: np.ndarray, shards: int) -> np.ndarray:
    return hashed.view(np.int64) % shards


# --- perfect hash -------------------------------------------------------------------------------

class PerfectHash:
    """A minimal perfect hash of a set of keys with the keys beside it, in slot order."""

    LEVELS = 24
    SPARE = 1.5  # places for a key of a level

    def __init__(self, sizes: list[int], words: np.ndarray, keys: pa.Array):
        self.sizes, self.words, self.keys = sizes, words, keys
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])
        #: keys that no level settles: those whose 64-bit hashes are equal
        settled = int(self.before[-1])
        self.rest = {k: settled + i for i, k in enumerate(keys.slice(settled).to_pylist())}

    @staticmethod
    def _places(hashed: np.ndarray, level: int, size: int) -> np.ndarray:
        x = (hashed ^ np.uint64(0x9E3779B97F4A7C15 * (level + 1) % 2**64)) * np.uint64(0xD6E8FEB86659FD93)
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return ((x ^ (x >> np.uint64(32))) % np.uint64(size)).astype(np.int64)

    @classmethod
    def build(cls, keys: list[bytes]) -> PerfectHash:
        hashed = hashes(keys)
        left, order, sizes, words = np.arange(len(keys)), [], [], []
        for level in range(cls.LEVELS):
            if not len(left):
                break
            size = 64 * -(-int(cls.SPARE * len(left)) // 64) or 64
            place = cls._places(hashed[left], level, size)
            alone = np.bincount(place, minlength=size)[place] == 1
            bits = np.zeros(size, np.uint8)
            bits[place[alone]] = 1
            order.append(left[alone][np.argsort(place[alone])])
            left = left[~alone]
            sizes.append(size)
            words.append(np.packbits(bits, bitorder="little").view("<u8"))
        order = np.concatenate([*order, left]).astype(np.int64) if order else left
        stored = pa.array([keys[i] for i in order.tolist()], pa.binary())
        return cls(sizes, np.concatenate(words) if words else np.zeros(0, np.uint64), stored)

    def slots(self, keys: list[bytes], hashed: np.ndarray) -> np.ndarray:
        """The slot of each key, -1 for what is no key."""
        out, todo, base = np.full(len(keys), -1, np.int64), np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes):
            place = self._places(hashed[todo], level, size)
            at, bit = base + (place >> 6), (place & 63).astype(np.uint64)
            word = self.words[at]
            hit = (word >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1)))
            out[todo[hit]] = (self.before[at] + below)[hit]
            todo = todo[~hit]
            base += size // 64
        for i in todo.tolist() if self.rest else ():
            out[i] = self.rest.get(keys[i], -1)
        found = np.flatnonzero(out >= 0)
        if len(found):  # compare with the stored keys
            asked = pa.array([keys[i] for i in found.tolist()], pa.binary())
            same = np.asarray(pc.equal(self.keys.take(pa.array(out[found])), asked))
            out[found[~same]] = -1
            for i in found[~same].tolist() if self.rest else ():
                out[i] = self.rest.get(keys[i], -1)
        return out

    def to_bytes(self) -> bytes:
        keys = self.keys.to_pylist()
        sizes = np.fromiter(map(len, keys), "<u4", len(keys))
        return b"".join([struct.pack("<III", len(self.sizes), len(self.words), len(keys)), np.array(self.sizes, "<u4").tobytes(),
                         self.words.astype("<u8").tobytes(), sizes.tobytes(), *keys])

    @classmethod
    def read(cls, data: bytes) -> PerfectHash:
        a, b, c = struct.unpack_from("<III", data)
        sizes = np.frombuffer(data, "<u4", a, 12)
        words = np.frombuffer(data, "<u8", b, 12 + 4 * a)
        at = 12 + 4 * a + 8 * b
        ends = np.concatenate([[0], np.cumsum(np.frombuffer(data, "<u4", c, at), dtype=np.int32)]).astype(np.int32)
        keys = pa.Array.from_buffers(pa.binary(), c, [None, pa.py_buffer(ends), pa.py_buffer(data[at + 4 * c:])])
        return cls(sizes.tolist(), words, keys)


class Shards:
    """The perfect hashes of one language (or those of one round): term -> slot of the language."""

    def __init__(self, rows: list):
        self.shards, self.size = rows[0]["shards"], rows[0]["kept"]
        self.parts = {r["shard"]: (PerfectHash.read(bytes(r["hash"])), r["base"]) for r in rows}

    def slots(self, keys: list[bytes]) -> np.ndarray:
        hashed, out = hashes(keys), np.full(len(keys), -1, np.int64)
        shard = shard_of(hashed, self.shards)
        order = np.argsort(shard, kind="stable")
        cuts = np.flatnonzero(np.diff(shard[order], prepend=-1, append=-1))
        for mine in (order[lo:hi] for lo, hi in zip(cuts, cuts[1:])):
            part, base = self.parts.get(int(shard[mine[0]]), (None, 0))
            if part is not None:
                found = part.slots([keys[i] for i in mine.tolist()], hashed[mine])
                out[mine] = np.where(found >= 0, found + base, -1)
        return out


# --- the job ------------------------------------------------------------------------------------

def plain(docs: DataFrame) -> DataFrame:
    return docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])


def frequent_terms(rows: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """lang, term (binary): the terms that ``min_docs`` documents of the language hold."""
    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, Counter] = defaultdict(Counter)

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, counter in seen.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(counter), pa.string()), pa.array(list(counter), pa.binary()),
                     pa.array(list(counter.values()), pa.int64())], names=["lang", "term", "n"])
            seen.clear()

        for b in byte_sized(batches, "text", BLOCK_BYTES):
            for lang, text in zip(b.column(0).to_pylist(), texts(b.column(1))):
                seen[lang].update(set(terms(text)))
            if sum(map(len, seen.values())) > HELD_TERMS:
                yield from flush()
        yield from flush()

    return (rows.select("lang", "text").mapInArrow(documents, "lang string, term binary, n long")
            .groupBy("lang", "term").agg(F.sum("n").alias("n")).where(F.col("n") >= min_docs).select("lang", "term"))


def perfect_hashes(kept: DataFrame, shard_keys: int = SHARD_KEYS) -> DataFrame:
    """lang, kept (terms of the language), shards, shard, base (slots before it), hash."""
    sizes = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("kept")).withColumn("shards", F.ceil(F.col("kept") / shard_keys))
    dealt = kept.join(sizes, "lang").withColumn("shard", F.pmod(F.xxhash64("term"), F.col("shards")))

    def build(group: pa.Table) -> pa.Table:
        done = PerfectHash.build(group["term"].to_pylist())
        first = group.select(["lang", "kept", "shards", "shard"]).slice(0, 1)
        return (first.append_column("keys", pa.array([group.num_rows], pa.int64()))
                .append_column("hash", pa.array([done.to_bytes()], pa.binary())))

    built = materialise(dealt.groupBy("lang", "shard").applyInArrow(
        build, "lang string, kept long, shards long, shard long, keys long, hash binary"), "hashes")
    before = F.sum("keys").over(Window.partitionBy("lang").orderBy("shard")) - F.col("keys")
    bases = built.select("lang", "shard", "keys").withColumn("base", before).drop("keys")
    return built.drop("keys").join(bases, ["lang", "shard"])


def by_language(rows: list) -> dict[str, list]:
    out = defaultdict(list)
    for r in rows:
        out[r["lang"]].append(r.asDict())
    return dict(out)


COUNTS = "lang string, source string, slot long, n long"


def _slots(lang: str, source: str, slots: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([lang] * len(n), pa.string()), pa.array([source] * len(n), pa.string()),
                                       pa.array(slots, pa.int64()), pa.array(n, pa.int64())], names=["lang", "source", "slot", "n"])


def recount_texts(rows: DataFrame, hashed: DataFrame) -> DataFrame:
    """lang, source, slot, n (parts of it) by one pass over the texts; all shards are broadcast."""
    shared = rows.sparkSession.sparkContext.broadcast(by_language(hashed.collect()))

    def recount(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = {lang: Shards(parts) for lang, parts in shared.value.items()}
        dense: dict[tuple[str, str], np.ndarray] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for (lang, source), n in dense.items():
                slots = np.flatnonzero(n)
                if len(slots):
                    yield _slots(lang, source, slots, n[slots])
            dense.clear()

        for b in byte_sized(batches, "text", BLOCK_BYTES):
            numbers: dict[str, defaultdict] = {}
            found: dict[tuple[str, str], list[np.ndarray]] = defaultdict(list)
            for lang, source, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), texts(b.column(2))):
                if lang in known:
                    ids = numbers.setdefault(lang, defaultdict(count().__next__))
                    words = terms(text)
                    found[lang, source].append(np.fromiter(map(ids.__getitem__, words), np.int64, len(words)))
            slots = {lang: known[lang].slots(list(ids)) for lang, ids in numbers.items()}
            for (lang, source), lists in found.items():
                here = slots[lang][np.concatenate(lists)]
                if (lang, source) not in dense:
                    if 8 * sum(map(len, dense.values())) > HELD_BYTES:
                        yield from flush()
                    dense[lang, source] = np.zeros(known[lang].size, np.int64)
                dense[lang, source] += np.bincount(here[here >= 0], minlength=known[lang].size)
        yield from flush()

    return rows.select("lang", "source", "text").mapInArrow(recount, COUNTS)


def recount_terms(rows: DataFrame, hashed: DataFrame, rounds: int) -> DataFrame:
    """The same in rounds, each with its share of the shards broadcast: the texts are counted by plain terms once."""
    def count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple[str, str], Counter] = defaultdict(Counter)

        def flush() -> Iterator[pa.RecordBatch]:
            for (lang, source), counter in seen.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(counter), pa.string()), pa.array([source] * len(counter), pa.string()),
                     pa.array(list(counter), pa.binary()), pa.array(list(counter.values()), pa.int64())],
                    names=["lang", "source", "term", "n"])
            seen.clear()

        for b in byte_sized(batches, "text", BLOCK_BYTES):
            for lang, source, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), texts(b.column(2))):
                seen[lang, source].update(terms(text))
            if sum(map(len, seen.values())) > HELD_TERMS:
                yield from flush()
        yield from flush()

    shards = hashed.select("lang", "shards").distinct()
    counted = (rows.select("lang", "source", "text").mapInArrow(count_terms, "lang string, source string, term binary, n long")
               .groupBy("lang", "source", "term").agg(F.sum("n").alias("n")).join(shards, "lang")
               .withColumn("round", F.pmod(F.pmod(F.xxhash64("term"), F.col("shards")), F.lit(rounds)).cast("int")))
    counted = materialise(counted.drop("shards"), "terms")

    def one(number: int) -> DataFrame:
        shared = rows.sparkSession.sparkContext.broadcast(by_language(hashed.where(F.col("shard") % rounds == number).collect()))

        def recount(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known = {lang: Shards(parts) for lang, parts in shared.value.items()}
            for b in batches:
                table = pa.Table.from_batches([b])
                for lang in pc.unique(table["lang"]).to_pylist():
                    if lang not in known:
                        continue
                    mine = table.filter(pc.equal(table["lang"], lang))
                    slots = known[lang].slots(mine["term"].to_pylist())
                    mine = mine.append_column("slot", pa.array(slots)).filter(pa.array(slots >= 0))
                    yield from mine.select(["lang", "source", "slot", "n"]).to_batches()

        return materialise(counted.where(F.col("round") == number).drop("round").mapInArrow(recount, COUNTS), "round")

    out = one(0)
    for number in range(1, rounds):
        out = out.unionByName(one(number))
    return out


def probabilities(n: np.ndarray, total: int, kept: int) -> np.ndarray:
    """1 + floor(SCALE * (n + 2) / (total + 2 * kept)), exactly."""
    if int(n.max(initial=0)) + 2 > (2**63 - 1) // SCALE:
        return np.array([1 + SCALE * (int(x) + 2) // (total + 2 * kept) for x in n.ravel()], np.int64).reshape(n.shape)
    return 1 + SCALE * (n + 2) // (total + 2 * kept)


def difference(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


FOUND = "lang string, source string, part string, item string, value long"


def compare_block(groups: pa.Table, cells: pa.Table, block: int, width: int) -> pa.Table:
    """The pairs' sums over one block of slots, and each source's first terms of the block."""
    lang, kept = groups["lang"][0].as_py(), groups["kept"][0].as_py()
    sources, totals = groups["source"].to_pylist(), groups["total"].to_pylist()
    row = {s: i for i, s in enumerate(sources)}
    names = cells.filter(pc.is_valid(cells["term"]))
    size = max(0, min(width, kept - block * width))
    term: list = [None] * size
    for slot, name in zip(names["slot"].to_pylist(), names["term"].to_pylist()):
        term[slot - block * width] = name
    counts = cells.filter(pc.is_null(cells["term"]))
    n = np.zeros((len(sources), size), np.int64)
    n[[row[s] for s in counts["source"].to_pylist()], np.asarray(counts["slot"]) - block * width] = np.asarray(counts["n"])
    p = np.stack([probabilities(n[i], totals[i], kept) for i in range(len(sources))]) if size else n
    out: list[tuple] = []
    for i, s in enumerate(sources):
        value = difference(p[i], p[i + 1:]).sum(1).tolist()
        for t, v in zip(sources[i + 1:], value):
            out += [(s, "pair", t, v), (t, "pair", s, v)]
    if size:
        q = probabilities(n.sum(0), sum(totals), kept)
        for i, s in enumerate(sources):
            at = np.flatnonzero((n[i] > 0) & (p[i] > q))
            f = difference(p[i][at], q[at])
            if len(f) > TOP_TERMS:
                enough = f >= np.partition(f, -TOP_TERMS)[-TOP_TERMS]
                at, f = at[enough], f[enough]
            best = sorted(zip((-f).tolist(), (term[k] for k in at.tolist())))[:TOP_TERMS]
            out += [(s, "term", t.decode("utf-8", "replace"), -v) for v, t in best]
    columns = list(zip(*out)) if out else [()] * 4
    return pa.Table.from_arrays([pa.array([lang] * len(out), pa.string()), *(pa.array(c, pa.string()) for c in columns[:3]),
                                 pa.array(columns[3], pa.int64())], names=["lang", "source", "part", "item", "value"])


def source_divergence(docs: DataFrame, *, min_docs: int = MIN_DOCS, shard_keys: int = SHARD_KEYS,
                      broadcast_bytes: int = BROADCAST_BYTES, cells: int = CELLS) -> DataFrame:
    """lang, source, part, item, value, rank."""
    rows = plain(docs)
    kept = materialise(frequent_terms(rows, min_docs), "kept")
    hashed = materialise(perfect_hashes(kept, shard_keys), "shards")
    held = hashed.agg(F.sum(F.octet_length("hash"))).first()[0] or 0
    rounds = -(-held // broadcast_bytes)
    parts = recount_texts(rows, hashed) if rounds <= 1 else recount_terms(rows, hashed, rounds)
    counts = materialise(parts.groupBy("lang", "source", "slot").agg(F.sum("n").alias("n")), "counts")

    sizes = hashed.select("lang", "kept").distinct()
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    none = F.lit(0).cast("long")
    groups = materialise(rows.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(sizes, "lang", "left")
                         .select("lang", "source", F.coalesce("total", none).alias("total"), F.coalesce("kept", none).alias("kept")), "groups")
    most = groups.groupBy("lang").count().agg(F.max("count")).first()[0] or 1
    width = max(64, cells // most)
    blocks = F.explode(F.sequence(none, F.greatest(none, F.floor((F.col("kept") - 1) / width))))

    def slot_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                keys = PerfectHash.read(r["hash"]).keys
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["lang"]] * len(keys), pa.string()), pa.array(r["base"] + np.arange(len(keys))), keys],
                    names=["lang", "slot", "term"])

    named = hashed.select("lang", "base", "hash").mapInArrow(slot_terms, "lang string, slot long, term binary")
    filled = (counts.withColumn("term", F.lit(None).cast("binary"))
              .unionByName(named.withColumn("source", F.lit("")).withColumn("n", none))
              .withColumn("block", F.floor(F.col("slot") / width)))

    def compare(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        return compare_block(left, right, key[1].as_py(), width)

    found = (groups.withColumn("block", blocks).groupBy("lang", "block")
             .cogroup(filled.groupBy("lang", "block")).applyInArrow(compare, FOUND))
    found = materialise(found.groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value")), "found")
    rank = F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item"))
    pairs = found.where("part = 'pair'").withColumn("rank", rank)
    firsts = found.where("part = 'term'").withColumn("rank", rank).where(F.col("rank") <= TOP_TERMS)
    return pairs.unionByName(firsts)
