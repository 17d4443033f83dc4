"""Exact substring de-duplication with a logarithmic family of sparse suffix arrays.

Every byte covered by a ``LENGTH``-byte string that also starts earlier (in a smaller document, or
earlier in the same one) is removed. Strings are judged on the input, matches stay inside a
document, and the first occurrence of every string stays.

**Which suffixes.** Of the suffixes of a text only those are indexed that start at an *anchor*: a
place whose ``ANCHOR``-byte prefix has the lowest hash within some window of ``LENGTH`` bytes. Equal
windows hold equal anchors at equal places, so no match is lost, and about one suffix in 30 is
indexed. Since matches have one fixed length, a suffix matters only through the bytes around its
anchor that any window over the anchor can reach (its *context*).

**The family.** The suffixes of each block of documents arrive as a batch. A batch's suffix array
is its entries in the order of their prefix hash (equal contexts beside each other; alphabetic
order would add nothing to a search for equal strings). It is merge-scanned against every existing
level: where a context is already there, the earlier place stays in the index and the later one
is marked removed. What is left becomes a new level, and levels of like size merge, so
there are logarithmically many. The family is dealt by prefix hash: each task holds the levels of
its share of the prefixes.

**Match ends.** Anchors whose prefix occurs with several contexts lie near the ends of matches. The
first place of each such context is looked into twice more, with the same family: the windows that
the anchor stands for, in groups of ``GROUP`` neighbours (key: the bytes that all windows of a group
share; context: the bytes that any of them covers), and then the single windows of groups that
still differ. Each round reads only the texts that have places to look into.

**Frequent prefixes and passages.** A block passes on each context and each window once (its
earliest place), and a prefix with many contexts in one block is dealt by context instead of by
prefix, so that a task sees at most a few entries a block for any one prefix.

Hashes: a prefix and a context, or the two halves of a window's hash, are 128 bits together; texts
are told apart by all 128.

Defined results: a null text is empty and kept; texts are UTF-8 bytes; rows that share an id are
separate documents in one fixed order, rows without id come last; repeated rows are copies like
any other; extra columns are ignored by :func:`substring_report` and carried by
:func:`remove_repeats`; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.llm.common import byte_sized, flat, materialise, numbered, shuffle_partitions

LENGTH = 100
ANCHOR = 36
#: Text bytes of one batch of suffixes.
BATCH_BYTES = 16_000_000
#: Text bytes hashed at a time (a longer document is hashed whole).
HASH_BYTES = 1 << 19
#: Windows of one group in the second round; divides the LENGTH - ANCHOR + 1 windows of an anchor.
GROUP = 13
#: Contexts of one prefix in one batch from which on they are dealt by context.
MANY_CONTEXTS = 4

_rng = np.random.default_rng(20240229)
BYTE_VALUES = _rng.integers(0, 2**64, (2, 256), dtype=np.uint64)
#: Odd, so that they have inverses modulo 2**64.
BASES = _rng.integers(0, 2**63, 2, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * MIX[0]
    x = (x ^ (x >> np.uint64(27))) * MIX[1]
    return x ^ (x >> np.uint64(31))


_powers: list[tuple[np.ndarray, np.ndarray]] = []


def powers(n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(base**i, base**-i) for i < n and both bases."""
    if not _powers or len(_powers[0][0]) < n:
        size = max(n, HASH_BYTES + 1)
        _powers.clear()
        for b in BASES.tolist():
            both = []
            for x in (b, pow(b, -1, 2**64)):
                steps = np.full(size, x, np.uint64)
                steps[0] = 1
                both.append(np.multiply.accumulate(steps))
            _powers.append(tuple(both))
    return _powers


class Hashes:
    """Hashes of any range of one byte array, from prefix sums modulo 2**64."""

    def __init__(self, data: np.ndarray):
        self.p = powers(len(data) + 1)
        self.sums = []
        for values, (up, _) in zip(BYTE_VALUES, self.p):
            s = np.zeros(len(data) + 1, np.uint64)
            np.cumsum(values[data] * up[:len(data)], out=s[1:])
            self.sums.append(s)

    def ranges(self, which: int, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        s, (_, down) = self.sums[which], self.p[which]
        return (s[hi] - s[lo]) * down[lo]

    def all(self, which: int, length: int) -> np.ndarray:
        s, (_, down) = self.sums[which], self.p[which]
        n = len(s) - length
        return (s[length:] - s[:n]) * down[:n]


def sliding(x: np.ndarray, width: int, pick) -> np.ndarray:
    """pick (minimum or maximum) over every ``width`` neighbours, by doubling."""
    done = 1
    while 2 * done <= width:
        x = pick(x[:-done], x[done:])
        done *= 2
    rest = width - done
    return pick(x[:-rest], x[rest:]) if rest else x


def blocks(offsets: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Runs of documents with about ``most`` bytes."""
    group = (offsets[1:] - offsets[0] - 1) // most
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(offsets) - 1]
    yield from ((a, b) for a, b in zip(cuts, cuts[1:]) if b > a)


class Block:
    """Anchors of a run of documents laid end to end (``offsets`` start at 0)."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.offsets, n = offsets, len(data)
        self.hashes = Hashes(data)
        span = LENGTH - ANCHOR + 1  # prefixes in a window
        self.anchors = np.zeros(0, np.int64)
        if n < LENGTH:
            return
        self.prefix = mixed(self.hashes.all(0, ANCHOR))
        low = sliding(self.prefix, span, np.minimum)  # of the window that starts here
        for end in offsets[1:-1].tolist():  # windows across a document's end don't count
            low[max(0, end - LENGTH + 1):end] = 0
        self.low = low
        pad = np.zeros(span - 1, np.uint64)
        high = sliding(np.concatenate([pad, low, pad]), span, np.maximum)
        self.anchors = np.flatnonzero((high == self.prefix) & (high != 0))

    def entries(self) -> tuple[np.ndarray, ...]:
        """(document, place in it, prefix hash, context hash) of the anchors."""
        a = self.anchors
        doc = np.searchsorted(self.offsets, a, "right") - 1
        lo = np.maximum(a - (LENGTH - ANCHOR), self.offsets[doc])
        hi = np.minimum(a + LENGTH, self.offsets[doc + 1])
        context = self._cover(lo, hi, (a - lo) << 8 | (hi - a))
        return doc, a - self.offsets[doc], self.prefix[a] if len(a) else np.zeros(0, np.uint64), context

    def groups(self, anchors: np.ndarray) -> tuple[np.ndarray, ...]:
        """(first window, windows, shared bytes' hash, covered bytes' hash) of the groups of windows for
        which one of the anchors has the lowest prefix."""
        span = LENGTH - ANCHOR + 1
        first, last = np.full(len(anchors), np.iinfo(np.int64).max), np.full(len(anchors), -1)
        for back in range(span):
            at = anchors - back
            own = (at >= 0) & (at < len(self.low))
            own[own] = self.low[at[own]] == self.prefix[anchors[own]]
            first[own] = np.minimum(first[own], at[own])
            last[own] = np.maximum(last[own], at[own])
        # nominal first windows; the shared bytes are the same wherever a group is cut
        low = np.concatenate([anchors - (span - 1) + begin for begin in range(0, span, GROUP)])
        times = span // GROUP
        lo, hi = np.maximum(low, np.tile(first, times)), np.minimum(low + GROUP - 1, np.tile(last, times))
        some = lo <= hi
        # two anchors a multiple of GROUP apart with equal prefixes have groups in common
        low, lo, hi = np.unique(np.stack([low[some], lo[some], hi[some]]), axis=1)
        core = mixed(self.hashes.ranges(0, low + GROUP - 1, low + LENGTH))
        return lo, hi - lo + 1, core, self._cover(lo, hi + LENGTH, (lo - low) << 8 | (hi - low))

    def _cover(self, lo: np.ndarray, hi: np.ndarray, shape: np.ndarray) -> np.ndarray:
        return mixed(mixed(self.hashes.ranges(0, lo, hi) + shape.astype(np.uint64)) ^ self.hashes.ranges(1, lo, hi))


# --- the family ---------------------------------------------------------------------------------

def earliest(key: np.ndarray, check: np.ndarray, doc: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, repeated): entries by (key, check, doc, place), and which of them are not the first of their (key, check)."""
    order = np.argsort(key, kind="stable")
    k = key[order]
    tied = np.zeros(len(k), bool)
    same = k[1:] == k[:-1]
    tied[1:] |= same
    tied[:-1] |= same
    if tied.any():  # only runs of equal keys need the full order
        some = order[tied]
        order[tied] = some[np.lexsort((at[some], doc[some], check[some], key[some]))]
    k, c = key[order], check[order]
    repeated = np.zeros(len(k), bool)
    repeated[1:] = (k[1:] == k[:-1]) & (c[1:] == c[:-1])
    return order, repeated


class Family:
    """Levels of (key, check, doc, place, windows, flag), each sorted by key with one entry for each
    (key, check).

    ``add`` returns the (doc, place, windows) of entries found not to be the first of their string."""

    def __init__(self):
        self.levels: list[list[np.ndarray]] = []

    def add(self, key, check, doc, at, windows, flag) -> list[tuple[np.ndarray, ...]]:
        order, repeated = earliest(key, check, doc, at)
        late = [tuple(x[order[repeated]] for x in (doc, at, windows))]
        keep = order[~repeated]
        batch = [x[keep] for x in (key, check, doc, at, windows, flag)]
        for level in self.levels:  # merge-scan
            place = np.searchsorted(level[0], batch[0])
            place[place == len(level[0])] = 0
            hit = (level[0][place] == batch[0]) & (level[1][place] == batch[1])
            if not hit.any():
                continue
            there, here = place[hit], np.flatnonzero(hit)
            earlier = (batch[2][here] < level[2][there]) | ((batch[2][here] == level[2][there])
                                                            & (batch[3][here] < level[3][there]))
            late.append(tuple(np.where(earlier, level[c][there], batch[c][here]) for c in (2, 3, 4)))
            for c in (2, 3, 4):
                level[c][there[earlier]] = batch[c][here[earlier]]
            level[5][there] |= batch[5][here]
            batch = [x[~hit] for x in batch]
        if len(batch[0]):
            self.levels.append(batch)
        while len(self.levels) > 1 and len(self.levels[-2][0]) < 2 * len(self.levels[-1][0]):
            self._merge()
        return late

    def _merge(self) -> None:
        a, b = self.levels.pop(), self.levels.pop()
        both = [np.concatenate([x, y]) for x, y in zip(b, a)]
        order = np.argsort(both[0], kind="stable")  # two sorted runs
        self.levels.append([x[order] for x in both])

    def whole(self) -> list[np.ndarray]:
        while len(self.levels) > 1:
            self._merge()
        return self.levels[0] if self.levels else [np.zeros(0, t) for t in ("u8", "u8", "i8", "i4", "u1", "?")]


# --- batches through the shuffle ----------------------------------------------------------------

#: What a place (rid, at, kind) says. kind 0: the context of the anchor ``at`` stands earlier too; n > 0: so do
#: the n windows from ``at`` on; -1: look into the anchor ``at``; -1 - n: into the n windows from ``at`` on.
CONTEXT, ANCHOR_LOOK_UP = 0, -1
BATCH = pa.schema([("part", pa.int32()), ("late", pa.bool_()), ("batch", pa.binary())])
PLACE = pa.schema([("rid", pa.int64()), ("at", pa.int32()), ("kind", pa.int32())])


def pack(doc, at, windows, key=None, check=None, flag=None) -> bytes:
    """Late places or entries as one byte string, in document order. Ids are written once, other whole
    numbers as differences in byte planes, most of which are zeros that the shuffle's codec removes."""
    new = np.r_[True, doc[1:] != doc[:-1]]
    step = np.diff(at, prepend=0)
    step[new] = at[new]
    step = step.astype("<u4").view("<u2").reshape(-1, 2)
    body = [np.array([len(doc), int(new.sum())], "<i8"), doc[new].astype("<i8"), np.packbits(new),
            step[:, 0], step[:, 1], windows.astype("u1")]
    if key is not None:
        body += [key.astype("<u8"), check.astype("<u8"), np.packbits(flag)]
    return b"".join(np.ascontiguousarray(x).tobytes() for x in body)


def unpack(row, entries: bool) -> list[np.ndarray]:
    """(doc, at, windows) or (key, check, doc, at, windows, flag)."""
    n, m = np.frombuffer(row, "<i8", 2).tolist()
    bits, at, out = (n + 7) // 8, 16, []
    kinds = (("<i8", m), ("u1", bits), ("<u2", n), ("<u2", n), ("u1", n), ("<u8", n), ("<u8", n), ("u1", bits))
    for kind, count in kinds[:8 if entries else 5]:
        out.append(np.frombuffer(row, kind, count, at))
        at += out[-1].nbytes
    new = np.unpackbits(out[1], count=n).astype(bool)
    step = out[2].astype(np.int64) | out[3].astype(np.int64) << 16
    step = np.where(step >= 1 << 31, step - (1 << 32), step)
    total = np.cumsum(step)
    begins = np.flatnonzero(new)
    which = np.cumsum(new) - 1
    place = (total - (total - step)[begins][which]).astype(np.int32) if n else np.zeros(0, np.int32)
    found = [out[0][which], place, out[4]]
    return [out[5], out[6], *found, np.unpackbits(out[7], count=n).astype(bool)] if entries else found


def deal(parts: int, key, check, doc, at, windows, by_group: bool) -> pa.RecordBatch:
    """A batch of entries as rows for the tasks that hold the levels.

    Only the earliest place of each (key, check) travels as an entry, the later ones as ``late``.
    ``by_group``: entries go by ``check``, the shared bytes; but of those with many contexts in this
    batch just two, which tell their task so, and all others by their own key."""
    order, repeated = earliest(key, check, doc, at)
    late = order[repeated]
    late = late[np.lexsort((at[late], doc[late]))]
    keep = order[~repeated]
    keep = keep[np.lexsort((at[keep], doc[keep]))]
    gone = [x[late] for x in (doc, at, windows)]
    key, check, doc, at, windows = (x[keep] for x in (key, check, doc, at, windows))
    flag = np.zeros(len(key), bool)
    part = ((check if by_group else key) % np.uint64(parts)).astype(np.int64)
    if by_group and len(key):
        order = np.argsort(check, kind="stable")
        begins = np.flatnonzero(np.r_[True, np.diff(check[order]) != 0])
        size = np.diff(np.r_[begins, len(order)])
        many = np.repeat(size > MANY_CONTEXTS, size)
        spread = order[many & (np.arange(len(order)) - np.repeat(begins, size) >= 2)]
        part[spread] = (key[spread] % np.uint64(parts)).astype(np.int64)
        flag[order[many]] = True
    order = np.argsort(part, kind="stable")  # in document order within a task
    cuts = np.searchsorted(part[order], np.arange(parts + 1))
    rows = [(p, False, pack(*(x[order[cuts[p]:cuts[p + 1]]] for x in (doc, at, windows, key, check, flag))))
            for p in np.flatnonzero(np.diff(cuts)).tolist()]
    if len(late):
        rows.append((int(gone[0][0] % parts), True, pack(*gone)))
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else ([],) * 3, BATCH)],
                                      schema=BATCH)


def places(rid, at, kind) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.asarray(rid, np.int64)), pa.array(np.asarray(at, np.int32)),
                                       pa.array(np.asarray(kind, np.int32))], schema=PLACE)


def family_scan(batches: DataFrame, parts: int, look_up: bool) -> DataFrame:
    """rid, at, kind: every batch of a task added to its family; the places that are not the first of
    their string, and with ``look_up`` the first places of contexts whose shared bytes have several."""
    def scan(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        family = Family()
        for b in rows:
            for late, row in zip(b.column(1).to_pylist(), b.column(2)):
                found = [unpack(row.as_buffer(), False)] if late else family.add(*unpack(row.as_buffer(), True))
                for rid, at, windows in found:
                    if len(rid):
                        yield places(rid, at, windows)
        if look_up:
            _, check, doc, at, windows, several = family.whole()
            order = np.argsort(check, kind="stable")
            again = np.diff(check[order]) == 0
            several = several.copy()
            several[order[1:][again]] = True
            several[order[:-1][again]] = True
            yield places(doc[several], at[several], -1 - windows[several].astype(np.int32))

    return (batches.repartitionById(parts, F.col("part")).select("part", "late", "batch")
            .mapInArrow(scan, "rid long, at int, kind int"))


def anchor_batches(docs: DataFrame, parts: int) -> DataFrame:
    """The anchors of each block of documents (rid, text), dealt by prefix."""
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in byte_sized(batches, "text", BATCH_BYTES):
            data, offsets = flat(b.column("text"))
            rid, found = np.asarray(b.column("rid")), []
            for lo, hi in blocks(offsets, HASH_BYTES):
                block = Block(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
                doc, at, prefix, context = block.entries()
                found.append((mixed(prefix ^ context), prefix, rid[lo + doc], at.astype(np.int32),
                              np.full(len(at), CONTEXT, np.uint8)))
            yield deal(parts, *(np.concatenate(x) for x in zip(*found)), by_group=True)

    return docs.select("rid", "text").mapInArrow(build, "part int, late boolean, batch binary")


def look_up_batches(docs: DataFrame, parts: int, single: bool) -> DataFrame:
    """What the places to look into hold (rid, text, places), dealt by shared bytes: groups of the
    windows of an anchor, or (``single``) the windows of a group one by one."""
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in byte_sized(batches, "text", BATCH_BYTES // 4):
            data, offsets = flat(b.column("text"))
            rid, lists = np.asarray(b.column("rid")), b.column("places")
            kind = np.asarray(lists.flatten().field("kind"))
            row = np.repeat(np.arange(b.num_rows), np.asarray(pc.list_value_length(lists)))
            wanted = kind < CONTEXT
            at, n, row = np.asarray(lists.flatten().field("at"))[wanted].astype(np.int64), -1 - kind[wanted], row[wanted]
            order = np.lexsort((at, row))
            at, n, row = at[order] + offsets[row[order]], n[order], row[order]
            found = []
            for lo, hi in blocks(offsets, HASH_BYTES):
                a, z = np.searchsorted(row, (lo, hi))
                if a == z:
                    continue
                text, here = data[offsets[lo]:offsets[hi]], at[a:z] - offsets[lo]
                if single:
                    hashes = Hashes(text)
                    start = np.unique(np.repeat(here, n[a:z]) + _counting(n[a:z]))
                    size = np.ones(len(start), np.uint8)
                    check, key = (mixed(hashes.ranges(k, start, start + LENGTH)) for k in (0, 1))
                else:
                    start, size, check, cover = Block(text, offsets[lo:hi + 1] - offsets[lo]).groups(here)
                    key = mixed(check ^ cover)
                doc = np.searchsorted(offsets[lo:hi + 1] - offsets[lo], start, "right") - 1
                found.append((key, check, rid[lo + doc], (start - (offsets[lo + doc] - offsets[lo])).astype(np.int32),
                              size.astype(np.uint8)))
            if found:
                yield deal(parts, *(np.concatenate(x) for x in zip(*found)), by_group=not single)

    return docs.mapInArrow(build, "part int, late boolean, batch binary")


def _counting(n: np.ndarray) -> np.ndarray:
    """0 .. n[0] - 1, 0 .. n[1] - 1, and so on."""
    ends = np.cumsum(n)
    return np.arange(int(ends[-1]) if len(n) else 0) - np.repeat(ends - n, n)


# --- the whole job ------------------------------------------------------------------------------

def by_row(places_: DataFrame, name: str) -> DataFrame:
    """rid and the list ``name`` of its places."""
    return places_.groupBy("rid").agg(F.collect_list(F.struct("at", "kind")).alias(name))


def with_places(rows: DataFrame) -> DataFrame:
    """``rows`` (rid, text and other columns) with the lists p1, p2, p3 of places that the rounds found.

    ``rows`` goes into all joins in the same form, so that its texts are shuffled once."""
    rows = rows.where(F.col("rid").isNotNull())
    parts = shuffle_partitions(rows.sparkSession)
    one = materialise(family_scan(anchor_batches(rows, parts), parts, look_up=True), "anchors")
    asked = rows.join(by_row(one.where(F.col("kind") < CONTEXT), "places"), "rid")
    two = by_row(family_scan(look_up_batches(asked, parts, single=False), parts, look_up=True), "p2")
    asked = rows.join(two, "rid").withColumnRenamed("p2", "places")
    three = by_row(family_scan(look_up_batches(asked, parts, single=True), parts, look_up=False), "p3")
    one = by_row(one.where(F.col("kind") == CONTEXT), "p1")
    return rows.join(one, "rid", "left").join(two, "rid", "left").join(three, "rid", "left")


def removed_runs(size: int, at: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal removed runs [from, to) of a text of ``size`` bytes."""
    late = kind >= CONTEXT
    at, kind = at[late], kind[late]
    if not len(at):
        return at, at
    lo = np.where(kind == CONTEXT, np.maximum(at - (LENGTH - ANCHOR), 0), at)
    hi = np.where(kind == CONTEXT, np.minimum(at + LENGTH, size), at + kind - 1 + LENGTH)
    order = np.argsort(lo, kind="stable")
    lo, reach = lo[order], np.maximum.accumulate(hi[order])
    new = np.flatnonzero(np.r_[True, lo[1:] > reach[:-1]])
    return lo[new], reach[np.r_[new[1:] - 1, len(lo) - 1]]


def _each_text(b: pa.RecordBatch) -> Iterator[tuple[bytes, np.ndarray, np.ndarray]]:
    """(text, from, to) of the rows of (.., text, p1, p2, p3)."""
    for text, *lists in zip(*(b.column(c) for c in ("text", "p1", "p2", "p3"))):
        data = (text.as_py() or "").encode()
        found = [x.values for x in lists if x.is_valid]
        at, kind = (np.concatenate([np.asarray(x.field(f)).astype(np.int64) for x in found] or [np.zeros(0, np.int64)])
                    for f in ("at", "kind"))
        yield data, *removed_runs(len(data), at, kind)


def kept_bytes(data: bytes, lo: np.ndarray, hi: np.ndarray) -> bytes:
    if not len(lo):
        return data
    return b"".join(data[a:b] for a, b in zip([0, *hi.tolist()], [*lo.tolist(), len(data)]))


def substring_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for every document."""
    out = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()),
                     ("n_spans", pa.int64()), ("kept_sha256", pa.string())])

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in byte_sized(batches, "text", BATCH_BYTES):
            rows = [(len(d), int((hi - lo).sum()), len(lo), hashlib.sha256(kept_bytes(d, lo, hi)).hexdigest())
                    for d, lo, hi in _each_text(b)]
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, f.type) for c, f in zip(zip(*rows), list(out)[1:]))],
                                             schema=out)

    joined = with_places(numbered(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")))
    return (joined.select("doc_id", "text", "p1", "p2", "p3")
            .mapInArrow(report, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"))


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with the repeats taken out of ``text``. A character goes if any of its bytes goes, so
    the text stays valid; a null text stays null, a wholly repeated one becomes empty. ``n_chars``,
    if there, is the new length in characters."""
    others = [c for c in docs.columns if c != "text"]
    names = [f"c{i}" for i in range(len(others))]
    row = F.struct(*[F.col(f"`{c}`").alias(n) for c, n in zip(others, names)]).alias("row")
    inner = docs.select(F.col("doc_id"), F.col("text"), row)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in byte_sized(batches, "text", BATCH_BYTES):
            kept = [kept_bytes(d, lo, hi).decode("utf-8", "ignore") if t.is_valid else None
                    for t, (d, lo, hi) in zip(b.column("text"), _each_text(b))]
            yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(kept, pa.string())], names=["row", "kept"])

    joined = with_places(numbered(inner)).select("row", "text", "p1", "p2", "p3")
    result = joined.mapInArrow(cut, inner.select("row").schema.add("kept", "string"))
    where = dict(zip(others, names))

    def column(c: str) -> F.Column:
        if c == "text":
            return F.col("kept").alias(c)
        own = F.col(f"row.{where[c]}")
        length = F.length("kept").cast(docs.schema[c].dataType)
        return (F.coalesce(length, own) if c == "n_chars" else own).alias(c)

    return result.select(*map(column, docs.columns))
