"""Periodic runs of words, by recompression.

A *run* is a stretch of words with smallest period q (words q apart are identical) and at least
``max(MIN_LENGTH, MIN_PERIODS * q)`` words that neither neighbouring word extends.

The words of a block of documents become numbers in one sequence, with a separator of its own
around every document, so that nothing matches across documents. :class:`Grammar` compresses the
sequence by *recompression*: rounds of block compression (``aaa`` -> one symbol) and pair
compression (symbols are split into a left and a right half; a left one followed by a right one
-> one symbol) until every document is one symbol. Equal stretches are compressed alike but
for a symbol at either end, so :meth:`Grammar.extend` answers "how many words match from i and
j on" by walking up while the symbols match and down to the first mismatch, with one step a
level, for many pairs (i, j) at once and in either direction.

Candidates come from a harmonic grid: a run of period q has at least 3q words that equal the word q
later, so one of them is a multiple of 3q. For all q together these are n log n / 3 places, of which
those with equal words are extended exactly. Documents are laid out longest first, so the grid of q
ends where the documents become shorter than 4q.

Texts never leave their block (documents of about ``BLOCK_BYTES``, one document at least); nothing is
shuffled. Memory: about 200 bytes a word of the block, that is of the longest document if it
is larger than a block.

Defined results: a null or empty text, or one without words, has no run, four nulls and the
digests of empty strings; repeated rows give repeated rows; a null doc_id is kept as null (and is not
planted); extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import compress, count
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.llm.common import byte_sized, texts

MIN_LENGTH = 6
MIN_PERIODS = 4
BLOCK_BYTES = 4_000_000
#: Grid places looked at in one go.
CHUNK = 1 << 20


class Level(NamedTuple):
    symbols: np.ndarray  # of this level; separators are negative
    parent: np.ndarray  # by symbol: the symbol of the next level that holds it
    first: np.ndarray  # by symbol of the next level: its first symbol here, and the length at the end
    blocks: bool  # whether the next level joins equal neighbours (else pairs)


def _split(symbols: np.ndarray, seed: int) -> np.ndarray:
    """Which symbols are left ones: a bit of a hash."""
    mixed = (symbols.astype(np.uint64) + np.uint64(seed + 1)) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(63) == 0


class Grammar:
    """A run-length grammar over ``symbols``, whose separators are negative, all different, and stand first and last."""

    SEEDS = 2

    def __init__(self, symbols: np.ndarray):
        symbols = np.asarray(symbols, np.int64)
        self.levels: list[Level] = []
        self.bottom = len(symbols)
        fresh, rounds = int(symbols.max(initial=0)) + 1, 0
        goal = 2 * int((symbols < 0).sum()) - 1  # every document one symbol
        while len(symbols) > goal:
            blocks = rounds % 2 == 0
            if blocks:
                starts = np.flatnonzero(np.concatenate([[True], symbols[1:] != symbols[:-1]]))
                sizes = np.diff(np.append(starts, len(symbols)))
                joined = sizes > 1
                keys = symbols[starts[joined]] * (len(symbols) + 1) + sizes[joined]
            else:
                starts, joined = self._pairs(symbols, rounds)
                keys = symbols[starts[joined]] * fresh + symbols[starts[joined] + 1]
            rounds += 1
            if not len(keys):
                continue  # nothing to join: the next round works on the same symbols
            out = symbols[starts]
            names, number = np.unique(keys, return_inverse=True)
            out[joined] = fresh + number
            fresh += len(names)
            first = np.append(starts, len(symbols)).astype(np.int32)
            parent = np.repeat(np.arange(len(starts), dtype=np.int32), np.diff(first))
            self.levels.append(Level(symbols, parent, first, blocks))
            symbols = out
        self.top = symbols

    @classmethod
    def _pairs(cls, symbols: np.ndarray, round_: int) -> tuple[np.ndarray, np.ndarray]:
        """(starts, whether a pair starts there), by the best of a few splits into left and right symbols."""
        words = symbols >= 0
        best = None
        for seed in range(cls.SEEDS * round_, cls.SEEDS * (round_ + 1)):
            left = _split(symbols, seed) & words
            for a, b in ((left, ~left & words), (~left & words, left)):
                pair = a[:-1] & b[1:]
                if best is None or np.count_nonzero(pair) > np.count_nonzero(best):
                    best = pair
        begins = np.concatenate([[True], ~best])
        starts = np.flatnonzero(begins)
        return starts, np.append(best, False)[starts]

    def extend(self, i: np.ndarray, j: np.ndarray, back: bool = False) -> np.ndarray:
        """How many symbols from i and j on are equal (``back``: those before i and j, going backwards)."""
        x, y = (self.bottom - i, self.bottom - j) if back else (i, j)
        begin, x, y = x, x.astype(np.int64), y.astype(np.int64)
        views = [(_Mirror if back else _Plain)(level) for level in self.levels]
        active = np.arange(len(x))
        stopped = []  # by level: the pairs whose mismatch was seen there
        for view in views:
            a, b = x[active], y[active]
            going = np.ones(len(active), bool)
            inside = np.flatnonzero(~(view.begins(a) & view.begins(b)))
            going[inside], a[inside], b[inside] = view.step(a[inside], b[inside])
            x[active], y[active] = a, b
            stopped.append(active[~going])
            active = active[going]
            x[active], y[active] = view.up(x[active]), view.up(y[active])
        top = self.top[::-1] if back else self.top
        equal = top[x[active]] == top[y[active]]  # equal documents; their separators differ
        x[active] += equal
        y[active] += equal
        for view, more in zip(reversed(views), reversed(stopped)):
            _, x[active], y[active] = view.step(view.down(x[active]), view.down(y[active]))
            active = np.concatenate([active, more])
        return x - begin


class _Plain:
    """A level read forwards."""

    def __init__(self, level: Level):
        self.level = level

    def symbol(self, x):
        return self.level.symbols[x]

    def up(self, x):
        return self.level.parent[x].astype(np.int64)

    def down(self, x):
        return self.level.first[x].astype(np.int64)

    def begins(self, x):
        return self.down(self.up(x)) == x

    def step(self, x, y):
        """(whether to go on behind what is equal, and x and y there).

        Of pairs one symbol is compared. Of blocks all that is left of both is; if one has more left, the mismatch follows."""
        equal = self.symbol(x) == self.symbol(y)
        if not self.level.blocks:
            return equal, x + equal, y + equal
        left, right = self.down(self.up(x) + 1) - x, self.down(self.up(y) + 1) - y
        steps = np.where(equal, np.minimum(left, right), 0)
        return equal & (left == right), x + steps, y + steps


class _Mirror(_Plain):
    """The same level read backwards: place x is the x-th symbol from the end."""

    def symbol(self, x):
        return self.level.symbols[len(self.level.symbols) - 1 - x]

    def up(self, x):
        level = self.level
        return len(level.first) - 2 - level.parent[len(level.symbols) - 1 - x].astype(np.int64)

    def down(self, x):
        level = self.level
        return len(level.symbols) - level.first[len(level.first) - 1 - x].astype(np.int64)


class Runs(NamedTuple):
    start: np.ndarray
    length: np.ndarray
    period: np.ndarray


def find_runs(symbols: np.ndarray, bounds: np.ndarray, min_length: int = MIN_LENGTH, min_periods: int = MIN_PERIODS) -> Runs:
    """All runs of a block, by start, then period. ``symbols`` holds the documents one after the other, longest
    first, document d at ``bounds[d]`` to ``bounds[d + 1]``; starts are places in it."""
    if min_periods < 3:
        raise ValueError("the grid needs three periods at least")
    sizes = np.diff(bounds)
    if not len(sizes) or sizes[0] < min_length:
        return Runs(*(np.zeros(0, np.int64),) * 3)
    #: document d begins at bounds[d] + d + 1 of the sequence with separators
    used = int((sizes > 0).sum())
    cuts = np.concatenate([bounds[:used], bounds[used:used + 1]])
    full = np.insert(np.asarray(symbols[:cuts[-1]], np.int64), cuts, -1 - np.arange(used + 1))
    grammar = Grammar(full)
    step_of = min_periods - 1
    most = int(sizes[0]) // min_periods
    periods = np.arange(1, most + 1)
    #: the grid of q ends behind the last document of min_periods * q words
    enough = np.searchsorted(-sizes, -min_periods * periods, side="right")
    reach = bounds[enough] + enough
    places = -(-reach // (step_of * periods))
    found = []
    upto = np.cumsum(places)
    lo = 0
    while lo < most:
        hi = max(lo + 1, int(np.searchsorted(upto, (upto[lo - 1] if lo else 0) + CHUNK)))
        here = places[lo:hi]
        q = np.repeat(periods[lo:hi], here)
        k = np.arange(len(q)) - np.repeat(np.cumsum(here) - here, here)
        for part in range(0, len(q), CHUNK):
            p = q[part:part + CHUNK]
            i = k[part:part + CHUNK] * (step_of * p)
            j = i + p
            fits = j < len(full)
            i, j, p = i[fits], j[fits], p[fits]
            same = (full[i] == full[j]) & (full[i] >= 0)
            i, j, p = i[same], j[same], p[same]
            if len(i):
                ahead = grammar.extend(i, j)
                behind = grammar.extend(i, j, back=True)
                length = ahead + behind + p
                good = length >= np.maximum(min_length, min_periods * p)
                found.append(np.stack([(i - behind)[good], length[good], p[good]]))
        lo = hi
    if not found:
        return Runs(*(np.zeros(0, np.int64),) * 3)
    start, length, period = np.concatenate(found, axis=1)
    order = np.lexsort([period, length, start])
    start, length, period = start[order], length[order], period[order]
    # of a stretch found with several periods the smallest is its period
    first = np.ones(len(start), bool)
    first[1:] = (np.diff(start) != 0) | (np.diff(length) != 0)
    start, length, period = start[first], length[first], period[first]
    start = start - 1 - np.searchsorted(cuts[1:] + np.arange(1, used + 1), start)  # without separators
    order = np.lexsort([period, start])
    return Runs(start[order], length[order], period[order])


def numbers(words: list[bytes]) -> np.ndarray:
    """Equal words as equal numbers."""
    ids = defaultdict(count().__next__)
    return np.fromiter(map(ids.__getitem__, words), np.int64, len(words))


def block_runs(documents: list[list[bytes]]) -> list[Runs]:
    """The runs of every document, starts as word numbers."""
    order = sorted(range(len(documents)), key=lambda d: -len(documents[d]))
    bounds = np.concatenate([[0], np.cumsum([len(documents[d]) for d in order], dtype=np.int64)])
    runs = find_runs(numbers([w for d in order for w in documents[d]]), bounds)
    cut = np.searchsorted(runs.start, bounds)
    out: list = [None] * len(documents)
    for k, d in enumerate(order):
        lo, hi = cut[k], cut[k + 1]
        out[d] = Runs(runs.start[lo:hi] - bounds[k], runs.length[lo:hi], runs.period[lo:hi])
    return out


def collapse(words: list[bytes], runs: Runs) -> list[bytes]:
    """The words without those that some run holds after its first period."""
    if not len(runs.start):
        return words
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, runs.start + runs.period, 1)
    np.add.at(change, runs.start + runs.length, -1)
    return list(compress(words, (np.cumsum(change[:-1]) == 0).tolist()))


def planted(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words as the operator's contract has them: in documents whose crc32 ends in 0, a repeated tail."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    unit = words[a:a + p]
    return words[:a] + (unit * (-(-(n - a) // p)))[:n - a]


def periodic_runs(docs: DataFrame, plant: bool = False) -> DataFrame:
    """doc_id, n_runs, the longest run (start, length, period, exponent_milli) and the digests of
    all runs and of the text without repeats, one row per document."""
    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    out = pa.schema([(n, pa.string() if n.endswith("256") else pa.int64()) for n in names])

    def digest(doc_id: int | None, words: list[bytes], runs: Runs) -> tuple:
        listed = "".join(f"{s},{n},{p}\n" for s, n, p in zip(*(x.tolist() for x in runs)))
        best = (None,) * 4
        if len(runs.start):
            at = int(np.lexsort([runs.period, runs.start, -runs.length])[0])
            s, n, p = int(runs.start[at]), int(runs.length[at]), int(runs.period[at])
            best = (s, n, p, 1000 * n // p)
        kept = b" ".join(collapse(words, runs))
        return (doc_id, len(runs.start), *best, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in byte_sized(batches, "text", BLOCK_BYTES):
            ids = b.column(0).to_pylist()
            documents = [t.split() for t in texts(b.column(1))]
            if plant:
                documents = [planted(i, w) for i, w in zip(ids, documents)]
            rows = [digest(i, w, r) for i, w, r in zip(ids, documents, block_runs(documents))]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), out)], schema=out)

    return (docs.select(F.col("doc_id").cast("long"), "text")
            .mapInArrow(run, ", ".join(f"{f.name} {'string' if f.type == pa.string() else 'long'}" for f in out)))
