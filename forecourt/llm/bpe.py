"""Byte-level BPE by prefix dynamic programming, and its decoder.

Fact used: cut a text anywhere, and the BPE encoding of the left part, extended by a token, is the
encoding of the longer text exactly if the token may follow the left part's last token, that is, if
the two tokens' bytes alone encode to those two tokens. So each byte prefix has *one* valid last
token, and it is enough to store that: the last token of ``prefix`` is the token ``t`` that ends the
prefix and may follow the last token of ``prefix`` without ``t``. Appending bytes keeps all stored
answers, so an append is exact, and an edit re-encodes only from the edited byte on.

:class:`Prefixes` holds the answers of one text. The job feeds it the distinct pieces of a block in
sorted order: each piece is an edit of the one before, from the first byte on that differs, so
beginnings that words share are encoded once. Whether a token may follow another is decided from the
merge table by undoing merges across the boundary, latest first, and remembered.

Texts are cut by the vocabulary's pattern first and each match is encoded by itself. A match that
is itself a vocabulary entry is that entry.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.llm.common import byte_sized
from forecourt.llm.tokens import byte_level_chunks

#: Token pairs remembered by one task; beyond this the table starts anew.
PAIRS = 1_000_000
#: Text bytes of one block.
BLOCK_BYTES = 24_000_000


def load_ranks(path: str) -> dict[bytes, int]:
    """token bytes -> rank of a ``.tiktoken`` file."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


class Bpe:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.pattern = regex.compile(pattern)
        self.token_bytes = {r: t for t, r in ranks.items()}
        self.decimal = {r: b"%d," % r for r in self.token_bytes}
        self.longest = max(map(len, ranks), default=1)
        self.above = max(ranks.values(), default=0) + 1
        #: how a token came about: its last merge, or itself twice for a single byte
        self.halves: dict[int, tuple[int, int]] = {}
        self.merges: dict[tuple[int, int], int] = {}
        self._learn_merges()
        #: tokens that merges lead to; any other is only ever a whole match
        self.reached = {t: r for t, r in ranks.items() if len(t) == 1 or self.halves[r][0] != r}
        self.follows: dict[int, bool] = {}

    def _learn_merges(self) -> None:
        for token, rank in sorted(self.ranks.items(), key=lambda x: x[1]):
            if len(token) == 1:
                self.halves[rank] = (rank, rank)
                continue
            parts = self._merge(token, rank)
            if len(parts) == 2:
                self.halves[rank] = (parts[0], parts[1])
                self.merges[parts[0], parts[1]] = rank
            else:
                self.halves[rank] = (rank, rank)

    def _merge(self, data: bytes, below: int) -> list[int]:
        """Plain BPE of ``data`` with the merges of a rank under ``below``."""
        parts = [data[i:i + 1] for i in range(len(data))]
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda i: self.ranks.get(parts[i] + parts[i + 1], below))
            if self.ranks.get(parts[best] + parts[best + 1], below) >= below:
                break
            parts[best:best + 2] = [parts[best] + parts[best + 1]]
        return [self.ranks[p] for p in parts]

    def may_follow(self, left: int, right: int) -> bool:
        """Whether the bytes of both tokens together encode to exactly (left, right)."""
        key = left << 32 | right
        known = self.follows.get(key)
        if known is None:
            if len(self.follows) >= PAIRS:
                self.follows.clear()
            known = self.follows[key] = self._may_follow(left, right)
        return known

    def _may_follow(self, left: int, right: int) -> bool:
        # undo the merges of both sides from the latest on; a merge across the boundary that comes
        # before one undone would have been done instead. Of equal ranks the left one is done first.
        limit = self.above
        while True:
            across = self.merges.get((left, right))
            if across is not None and across < limit:
                return False
            inner_left, inner_right = self.halves[left][1], self.halves[right][0]
            if left > right:
                if inner_left != left:
                    left, limit = inner_left, left
                elif inner_right != right:
                    right, limit = inner_right, right + 1
                else:
                    return True
            elif inner_right != right:
                right, limit = inner_right, right + 1
            elif inner_left != left:
                left, limit = inner_left, left
            else:
                return True

    def encode_piece(self, data: bytes) -> list[int]:
        """Ids of one match of the pattern."""
        whole = self.ranks.get(data)
        return [whole] if whole is not None else Prefixes(self, data).tokens()

    def encode(self, text: str) -> list[int]:
        return [t for m in self.pattern.findall(text) for t in self.encode_piece(m.encode())]

    def decode(self, ids: Sequence[int]) -> bytes:
        return b"".join(map(self.token_bytes.__getitem__, ids))

    def encode_all(self, chunks: Sequence[str]) -> list[list[int]]:
        """Ids of distinct chunks, through one :class:`Prefixes` that goes over their pieces in sorted order."""
        cut = [[c.encode()] if self._one_piece(c) else [m.encode() for m in self.pattern.findall(c)] for c in chunks]
        found, walk = {}, Prefixes(self)
        for piece in sorted({p for pieces in cut for p in pieces}):
            whole = self.ranks.get(piece)
            if whole is not None:
                found[piece] = [whole]
            else:
                walk.become(piece)
                found[piece] = walk.tokens()
        return [found[p[0]] if len(p) == 1 else [t for x in p for t in found[x]] for p in cut]

    @staticmethod
    def _one_piece(chunk: str) -> bool:
        """A run of ASCII letters, perhaps after one space, is one match whatever the pattern does else."""
        return chunk.isascii() and (chunk[1:] if chunk[:1] == " " else chunk).isalpha()


class Prefixes:
    """The valid last token of every byte prefix of one text; exact under appends and edits."""

    def __init__(self, bpe: Bpe, data: bytes = b""):
        self.bpe, self.data = bpe, b""
        #: by prefix length - 1: the last token, and where it begins
        self.last: list[int] = []
        self.start: list[int] = []
        self.append(data)

    def append(self, data: bytes) -> None:
        self._grow(len(self.data), self.data + data)

    def replace(self, start: int, end: int, data: bytes) -> None:
        """Put ``data`` in place of the bytes [start, end); the prefixes before the edit stay."""
        self._grow(start, self.data[:start] + data + self.data[end:])

    def become(self, data: bytes) -> None:
        """Edit the text into ``data``, from the first byte on that differs."""
        same, most = 0, min(len(data), len(self.data))
        while same < most and data[same] == self.data[same]:
            same += 1
        self._grow(same, data)

    def _grow(self, begin: int, data: bytes) -> None:
        """The answers for all prefixes of ``data``, of which those up to ``begin`` bytes are known."""
        last, starts, bpe = self.last, self.start, self.bpe
        tokens, follows, may_follow, longest = bpe.reached.get, bpe.follows.get, bpe.may_follow, bpe.longest
        del last[begin:], starts[begin:]
        for end in range(begin + 1, len(data) + 1):
            # only one token is valid, so the likely ones are tried first: the last token one byte longer, then the byte
            likely = starts[-1] if starts else 0
            for start in (likely, *range(end - 1, max(-1, end - longest - 1), -1)):
                token = tokens(data[start:end])
                if token is not None:
                    if start:
                        left = last[start - 1]
                        good = follows(left << 32 | token)
                        if good is None:
                            good = may_follow(left, token)
                        if not good:
                            continue
                    last.append(token)
                    starts.append(start)
                    break
        self.data = data

    def tokens(self) -> list[int]:
        out, end = [], len(self.data)
        while end:
            out.append(self.last[end - 1])
            end = self.start[end - 1]
        return out[::-1]


# --- the job ------------------------------------------------------------------------------------

def digests(bpe: Bpe, texts: pa.Array) -> tuple[np.ndarray, list[str], list[str]]:
    """(number of ids, SHA-256 of the decimal ids, SHA-256 of the bytes they decode to) of each text.

    The distinct chunks of the block are encoded and decoded once; Arrow lays theirs end to end."""
    cut = byte_level_chunks(texts)
    coded = pc.dictionary_encode(cut.flatten())
    ids = bpe.encode_all(coded.dictionary.to_pylist())
    index = coded.indices
    bounds = np.asarray(cut.offsets) - cut.offsets[0].as_py()
    count = np.concatenate([[0], np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids))[np.asarray(index)])])[bounds]

    def hashes(parts: list[bytes], tail: int) -> list[str]:
        laid = pa.array(parts, pa.large_binary()).take(index)
        ends = np.frombuffer(laid.buffers()[1], np.int64)[:len(index) + 1][bounds].tolist()
        data = memoryview(laid.buffers()[2] or b"")
        return [hashlib.sha256(data[a:max(a, b - tail)]).hexdigest() for a, b in zip(ends, ends[1:])]

    decimal = bpe.decimal.__getitem__
    return (np.diff(count), hashes([b"".join(map(decimal, x)) for x in ids], 1),  # without the last comma
            hashes([bpe.decode(x) for x in ids], 0))


def bpe_digests(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every text (null: empty)."""
    out = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()),
                     ("decoded_sha256", pa.string())])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = Bpe(load_ranks(ranks_path), pattern)
        for b in byte_sized(batches, "text", BLOCK_BYTES):
            texts = pa.concat_arrays([b.column(1).cast(pa.large_string()).fill_null("")])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array(c, f.type) for c, f in zip(digests(bpe, texts), list(out)[1:]))], schema=out)

    return (docs.select(F.col("doc_id").cast("long"), "text")
            .mapInArrow(digest, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"))
