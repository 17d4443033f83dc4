"""SimHash near-duplicates by the generalised pigeonhole principle.

Fingerprints are 64-bit SimHashes of word shingles. To find all pairs within ``tau`` bits, the 64
positions are split into m groups and group i gets a threshold T_i >= -1 with
``sum(T_i) = tau - m + 1``: two fingerprints within tau bits agree to within T_i bits on at least
one group i (-1 means the group is not probed). Correlated bits are put into one group, so that
the groups are as independent as they can be. The number of groups and the thresholds are chosen
by dynamic programming over estimated costs: the signatures a group's threshold needs, and the
candidates it lets through, estimated from the distances between a bounded sample of fingerprints
and all of them. The choice decides cost only; any choice finds every pair.

Probing: a group with threshold t has a signature for every way to blank t of its bits; two
fingerprints within t bits on the group share one. Fingerprints that share a signature are
candidates and are compared on all 64 bits (verification). A signature held by more than
``BLOCK`` fingerprints is dealt to several tasks as pairs of blocks. A task returns the verified
links as a spanning forest of what it saw, so a dense group costs one link a member.

Equal fingerprints are one node from the start. Components come from repeated minimum-label
hooking over the links, each round a written table.

Defined results: words are ``[^\\x20\\x09-\\x0D]+`` of the A-Z lower-cased text; a null or
wordless text has fingerprint 0 and links like any other; fewer words than the shingle length
make one shingle. Rows with a null id get a component (null if no member has an id). Repeated
rows are linked; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.llm.common import byte_sized, materialise, numbered, shuffle_partitions, texts

BITS = 64
SHINGLE = 3
MAX_DISTANCE = 3
SEED = 42
#: Fingerprints sampled for the cost estimate (the whole table is compared with them).
ESTIMATE_SAMPLE = 256
#: Fingerprints of one block of a frequent signature.
BLOCK = 1024
#: Cost of one signature row, in candidate comparisons.
SIGNATURE_COST = 100


# --- fingerprints -------------------------------------------------------------------------------

def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """SimHash of a text: a bit is 1 if it is set in over half of the shingles' XXH64 values."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]).tolist()
    starts = [0, *ends]
    digest = xxhash.xxh64_intdigest
    hashes = ([digest(joined[a:b - 1], SEED) for a, b in zip(starts, ends[shingle - 1:])]
              if len(words) >= shingle else [digest(joined, SEED)])
    ones = np.zeros(BITS, np.int64)
    array = np.array(hashes, "<u8")
    for lo in range(0, len(array), 8192):
        ones += np.unpackbits(array[lo:lo + 8192].view(np.uint8).reshape(-1, 8), axis=1,
                              bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def with_fingerprint(docs: DataFrame, column: str = "fp", text: str = "text", shingle: int = SHINGLE,
                     keep_text: bool = True) -> DataFrame:
    """The columns of ``docs`` (without the text unless ``keep_text``) and the fingerprint as a signed long."""
    carry = [c for c in docs.columns if keep_text or c != text]
    schema = docs.select(*carry).schema.add(column, "long")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in byte_sized(batches, text, 32_000_000):
            fps = np.array([fingerprint(t, shingle) for t in texts(b.column(text))], np.uint64)
            yield b.select(carry).append_column(column, pa.array(fps.view(np.int64)))

    return docs.mapInArrow(add, schema)


# --- the plan: bit groups and thresholds --------------------------------------------------------

def bit_counts(fps: DataFrame) -> tuple[int, np.ndarray]:
    """(number of fingerprints, 64 x 64 counts of bits set together), summed by partition."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, both = 0, np.zeros((BITS, BITS), np.int64)
        for b in batches:
            bits = _bits(np.asarray(b.column(0)).view(np.uint64)).astype(np.float32)
            for lo in range(0, len(bits), 1 << 16):
                both += (bits[lo:lo + (1 << 16)].T @ bits[lo:lo + (1 << 16)]).astype(np.int64)
            n += len(bits)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(BITS), pa.int32()), pa.array([n] * BITS, pa.int64()), pa.array(both.tolist(), pa.list_(pa.int64()))],
            names=["bit", "n", "both"])

    cells = fps.select("fp").mapInArrow(count, "bit int, n long, both array<long>")
    rows = (cells.select("bit", "n", F.posexplode("both").alias("other", "c")).groupBy("bit", "other")
            .agg(F.sum("n").alias("n"), F.sum("c").alias("c")).collect())  # 4096 rows at most
    both = np.zeros((BITS, BITS), np.int64)
    for r in rows:
        both[r["bit"], r["other"]] = r["c"]
    return (rows[0]["n"] if rows else 0), both


def _bits(fps: np.ndarray) -> np.ndarray:
    return np.unpackbits(np.ascontiguousarray(fps).astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def bit_groups(n: int, both: np.ndarray, m: int) -> list[list[int]]:
    """m groups of 64 / m bits: each starts from a free bit and takes the free bits that correlate
    most with what it holds."""
    p = np.diag(both) / max(n, 1)
    spread = np.sqrt(np.outer(p * (1 - p), p * (1 - p)))
    tie = np.abs(both / max(n, 1) - np.outer(p, p)) / np.where(spread > 0, spread, np.inf)
    np.fill_diagonal(tie, 0)
    free, groups = set(range(BITS)), []
    for g in range(m):
        size = BITS // m + (g < BITS % m)
        group = [max(free, key=lambda b: (tie[b, sorted(free)].max(initial=0), -b))]
        free.discard(group[0])
        while len(group) < size:
            best = max(free, key=lambda b: (tie[b, group].sum(), -b))
            group.append(best)
            free.discard(best)
        groups.append(sorted(group))
    return groups


def mask_of(bits: list[int]) -> int:
    return sum(1 << b for b in bits)


def candidate_estimates(fps: DataFrame, sample: list[int], groupings: list[list[list[int]]], tau: int) -> list[np.ndarray]:
    """For each grouping, est[i, t]: the part of all fingerprints within t bits of a sampled one on group i."""
    masks = [[np.uint64(mask_of(g)) for g in groups] for groups in groupings]
    flat_masks = [m for ms in masks for m in ms]
    picked = np.array(sample, np.int64).view(np.uint64)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros((len(flat_masks), tau + 1), np.int64)
        for b in batches:
            values = np.asarray(b.column(0)).view(np.uint64)
            for lo in range(0, len(values), 4096):
                apart = values[lo:lo + 4096, None] ^ picked[None, :]
                for k, m in enumerate(flat_masks):
                    d = np.bitwise_count(apart & m)
                    found[k] += [int((d <= t).sum()) for t in range(tau + 1)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(flat_masks)), pa.int32()), pa.array(found.tolist(), pa.list_(pa.int64()))], names=["k", "c"])

    rows = (fps.select("fp").mapInArrow(count, "k int, c array<long>")
            .select("k", F.posexplode("c").alias("t", "c")).groupBy("k", "t").agg(F.sum("c").alias("c")).collect())
    out = np.zeros((len(flat_masks), tau + 1))
    for r in rows:
        out[r["k"], r["t"]] = r["c"] / max(1, len(sample))
    cuts = np.cumsum([0, *map(len, masks)])
    return [out[a:b] for a, b in zip(cuts, cuts[1:])]


def signatures(width: int, threshold: int) -> int:
    """How many signatures a group of ``width`` bits needs for a threshold (-1: none)."""
    return 0 if threshold < 0 else len(list(combinations(range(width), min(threshold, width))))


def allocate(widths: list[int], estimates: np.ndarray, tau: int) -> tuple[float, list[int]]:
    """(cost, thresholds) with sum = tau - m + 1, the cheapest by dynamic programming.

    The cost of a group is its signatures times SIGNATURE_COST plus its estimated candidates,
    for one fingerprint."""
    m = len(widths)
    table: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}  # by thresholds + 1 spent so far
    for width, est in zip(widths, estimates):
        new: dict[int, tuple[float, list[int]]] = {}
        for spent, (cost, chosen) in table.items():
            for t in range(-1, tau + 1):
                if t > width:
                    continue
                own = cost + signatures(width, t) * SIGNATURE_COST + (est[t] if t >= 0 else 0)
                key = spent + t + 1
                if key <= tau + 1 and (key not in new or own < new[key][0]):
                    new[key] = (own, [*chosen, t])
        table = new
    return table[tau + 1]  # sum(T_i + 1) = tau + 1


def plan(fps: DataFrame, tau: int) -> list[tuple[list[int], int]]:
    """(bits, threshold) of the groups to probe."""
    n, both = bit_counts(fps)
    sample = [r["fp"] for r in fps.orderBy(F.xxhash64("fp"), "fp").limit(ESTIMATE_SAMPLE).collect()]
    groupings = [bit_groups(n, both, m) for m in range(1, tau + 2)]
    estimates = candidate_estimates(fps, sample, groupings, tau)
    best = min((allocate([len(g) for g in groups], est, tau) + (groups,) for groups, est in zip(groupings, estimates)),
               key=lambda x: x[0])
    return [(g, t) for g, t in zip(best[2], best[1]) if t >= 0]


# --- probe and verify ---------------------------------------------------------------------------

class Forest:
    """Union-find over the values of one task, keeping the links that joined two trees."""

    def __init__(self):
        self.up: dict[int, int] = {}
        self.links: list[tuple[int, int]] = []

    def root(self, x: int) -> int:
        up = self.up
        top = x
        while (parent := up.get(top, top)) != top:
            top = parent
        while (parent := up.get(x, x)) != x:
            up[x] = top
            x = parent
        return top

    def join(self, a: int, b: int) -> None:
        x, y = self.root(a), self.root(b)
        if x != y:
            self.up[max(x, y)] = min(x, y)
            self.links.append((a, b))


def links(fps: DataFrame, probes: list[tuple[list[int], int]], tau: int, block: int = BLOCK) -> DataFrame:
    """a, b: verified links whose components are those of all pairs within ``tau`` bits."""
    masks = [(i, k, np.uint64(mask_of(bits) & ~mask_of([bits[j] for j in out])))
             for i, (bits, t) in enumerate(probes)
             for k, out in enumerate(combinations(range(len(bits)), min(t, len(bits))))]

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            values = np.asarray(b.column(0)).view(np.uint64)
            for number, (i, k, m) in enumerate(masks):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(values), number, np.int32)), pa.array((values & m).view(np.int64)),
                     b.column(0)], names=["g", "v", "fp"])

    signed = fps.select("fp").mapInArrow(sign, "g int, v long, fp long")
    if sum(t for _, t in probes):
        signed = materialise(signed, "signatures")
    frequent = (signed.groupBy("g", "v").count().where(F.col("count") > block)
                .select("g", "v", F.ceil(F.col("count") / block).cast("int").alias("blocks")))
    # a frequent signature: every pair of its blocks is one unit, and a fingerprint goes to each of its block's units
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    units = (signed.join(frequent, ["g", "v"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
             .withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select(F.xxhash64("g", "v", F.least("own", "other"), F.greatest("own", "other")).alias("unit"), "g", "v",
                     F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "fp"))
    # dealt by unit, so that the units of one frequent signature go to many tasks
    parts = shuffle_partitions(fps.sparkSession)
    dealt = units.repartition(parts, "unit").sortWithinPartitions("unit", "g", "v", "x", "y", "fp").drop("unit")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = Forest()
        held = None

        def compare(keys: np.ndarray, values: np.ndarray) -> None:
            unit = np.cumsum(np.r_[True, (keys[1:] != keys[:-1]).any(1)])
            alive, step = np.arange(len(values)), 0
            while len(alive):  # rows that still have a row of their unit `step` places on
                step += 1
                alive = alive[:np.searchsorted(alive, len(values) - step)]
                alive = alive[unit[alive] == unit[alive + step]]
                apart = values[alive] ^ values[alive + step]
                at = alive[(np.bitwise_count(apart) <= tau) & (apart != 0)]
                for a, b in zip(values[at].tolist(), values[at + step].tolist()):
                    forest.join(a, b)

        def drain():
            done = np.array(forest.links, np.uint64).reshape(-1, 2).view(np.int64)
            forest.links.clear()
            return pa.RecordBatch.from_arrays([pa.array(done[:, 0]), pa.array(done[:, 1])], names=["a", "b"])

        for b in batches:
            keys = np.stack([np.asarray(b.column(i)).astype(np.int64) for i in range(4)], 1)
            values = np.asarray(b.column(4)).view(np.uint64)
            if held is not None:
                keys, values = np.concatenate([held[0], keys]), np.concatenate([held[1], values])
            if not len(keys):
                continue
            last = int(np.flatnonzero((keys == keys[-1]).all(1))[0])  # the last unit may go on in the next batch
            held = (keys[last:], values[last:])
            if last:
                compare(keys[:last], values[:last])
                yield drain()
        if held is not None:
            compare(*held)
        yield drain()

    return dealt.mapInArrow(verify, "a long, b long")


# --- components ---------------------------------------------------------------------------------

def components(edges: DataFrame) -> DataFrame:
    """node, root for every end of an edge (a, b): root is the smallest node reachable.

    Alternating large-star and small-star steps, each a written table; the edges never leave the
    executors, and a step adds no more edges than it reads."""
    # a node's star: its neighbours are hooked to the smallest of them
    both = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    current = materialise(both, "edges")
    print_ = _print(current)
    while True:
        either = current.union(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = either.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        large = (either.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")))
        large = materialise(large.where("a <> b").distinct(), "large-star")
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        joined = large.join(low, "a")
        small = (joined.select(F.col("b").alias("a"), F.col("low").alias("b"))
                 .union(low.select("a", F.col("low").alias("b"))).where("a <> b").distinct())
        small = materialise(small, "small-star")
        print_, was = _print(small), print_
        current = small
        if print_ == was:  # a star forest stays as it is
            return current.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _print(edges: DataFrame) -> tuple:
    """Number and order-free hash of distinct edges."""
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a"))).first())


def near_duplicates(fingerprinted: DataFrame, tau: int = MAX_DISTANCE) -> DataFrame:
    """fp, root, component_id: for every distinct fingerprint of ``fingerprinted`` (doc_id, fp) the
    smallest fingerprint and the smallest doc_id of its component."""
    nodes = materialise(fingerprinted.groupBy("fp").agg(F.min("doc_id").alias("first")), "nodes")
    if nodes.limit(1).count() == 0:
        return nodes.select("fp", F.col("fp").alias("root"), F.col("first").alias("component_id"))
    roots = components(links(nodes, plan(nodes, tau), tau))
    member = materialise(nodes.join(roots, nodes["fp"] == roots["node"], "left")
                         .select("fp", "first", F.coalesce("root", "fp").alias("root")), "members")
    smallest = member.groupBy("root").agg(F.min("first").alias("component_id"))
    return member.join(smallest, "root").select("fp", "root", "component_id")


def simhash(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id for every document."""
    rows = materialise(with_fingerprint(docs.select("doc_id", "text"), keep_text=False), "fingerprints")
    found = near_duplicates(rows)
    return (rows.join(found, "fp")
            .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"))


def keep_first(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each component one row stays, one with the
    smallest doc_id (a row without id only where no member has one). Only ids and fingerprints are
    written on the way; the texts move once, to meet the ids that stay."""
    rows = numbered(docs.select("doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")))
    fps = materialise(with_fingerprint(rows.select("rid", "text"), keep_text=False), "fingerprints")
    found = near_duplicates(fps.withColumnRenamed("rid", "doc_id"))  # the numbers are in the order of the ids
    kept = fps.join(found, "fp").where("rid = component_id").select("rid")
    return rows.select("rid", "row").join(kept, "rid", "left_semi").select("row.*")
