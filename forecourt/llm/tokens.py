"""Encoding whole texts with the ``tokenizers`` library, each distinct chunk once per worker.

Both vocabularies split a text before they merge, and no piece crosses a *safe cut*:

* word vocabulary (white space is dropped): before any space or line feed, and between a letter
  and one of ``. , ; : ! ?``;
* byte-level vocabulary: before a space that follows a printable ASCII character or a letter,
  and between a letter and one of ``. , ; : ! ?``.

*Letter* means one that the Unicode versions 3.2 and now agree on, that composition (NFC) leaves as it is
and that folds to one character: the word vocabulary normalises before it splits, and a letter that NFC takes apart
ends in a mark, which goes into one piece with a full stop. Any character else is no place to cut, which
costs time but no correctness.

The cuts of a block of texts are found on its bytes at once; the chunks between them are dictionary-encoded and
the distinct ones looked up in a memo (``MEMO`` chunks at most), which outlives the block and the task, as
does the parsed vocabulary. New chunks go to the library in one call. A text that holds an added token
(``<|endoftext|>``), in any case, is one chunk and goes whole through the library. The ids equal
those of ``encode(text, add_special_tokens=False)`` with the file as it is.
"""

from __future__ import annotations

import functools
import os
import re
import unicodedata
from array import array
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from forecourt.llm.common import byte_sized, flat

#: Text bytes of one block: the memory bound of the encoder.
BLOCK_BYTES = 10_000_000
AFTER_LETTER = r"([^\PL\x{130}])([.,;:!?])"  # not after the dotted capital I, which folds to two characters
BEFORE_SPACE = r"([!-~\pL]) "


LATIN = re.compile(r"[\x00-ɏ]*")


def byte_letters() -> dict[int, int]:
    """The byte-level alphabet: printable bytes stand for themselves, the others for U+0100 and on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in plain]
    return {b: 256 + i for i, b in enumerate(rest)}


def byte_level_chunks(texts: pa.Array) -> pa.ListArray:
    """Each text (large_string, no nulls) cut at the safe cuts of the byte-level pattern."""
    data = texts.buffers()[2]
    held = data.to_pybytes() if data is not None else b""
    mark = next((c for c in map(chr, [0, *range(1, 9), *range(14, 28)]) if c.encode() not in held), None)
    if mark is None:  # every mark stands in some text: no cut
        return pa.LargeListArray.from_arrays(np.arange(len(texts) + 1), texts)
    texts = pc.replace_substring_regex(texts, AFTER_LETTER, rf"\1{mark}\2")
    return pc.split_pattern(pc.replace_substring_regex(texts, BEFORE_SPACE, rf"\1{mark} "), mark)


@functools.lru_cache(None)
def letters() -> np.ndarray:
    """Whether a cut may follow, by code point below U+10000."""
    old = unicodedata.ucd_3_2_0
    out = np.zeros(1 << 16, bool)
    for cp in range(1 << 16):
        c = chr(cp)
        if unicodedata.category(c)[0] == old.category(c)[0] == "L" and len(c.lower()) == 1:
            out[cp] = unicodedata.normalize("NFC", c) == c == old.normalize("NFC", c)
    return out


def _flags(characters: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(characters.encode())] = True
    return out


STOPS, SPACE, BREAKS, PRINTABLE = _flags(".,;:!?"), _flags(" "), _flags(" \n"), _flags("".join(map(chr, range(33, 127))))


def letter_before(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the UTF-8 character that ends before each place is a letter as above."""
    if not len(at):
        return np.zeros(0, bool)
    one, two, three = (data[np.maximum(at - k, 0)].astype(np.int64) for k in (1, 2, 3))
    cp = np.where(one < 128, one, np.where((two & 0xE0) == 0xC0, (two & 31) << 6 | one & 63,
                                           (three & 15) << 12 | (two & 63) << 6 | one & 63))
    short = (one < 128) | ((two & 0xE0) == 0xC0) | (((two & 0xC0) == 0x80) & ((three & 0xF0) == 0xE0))
    return letters()[cp] & short & (at > 0)


class Encoder:
    #: Distinct chunks whose ids a worker remembers.
    MEMO = 400_000

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = sorted(t.content for t in self.tokenizer.get_added_tokens_decoder().values())
        self.byte_level = self.tokenizer.normalizer is None
        self.merge, self.letters = self.tokenizer.model.tokenize, byte_letters()
        self.memo: dict[str, bytes] = {}

    @classmethod
    @functools.lru_cache(4)
    def of(cls, path: str) -> Encoder:
        """The worker's encoder for a vocabulary file."""
        return cls(path)

    def cuts(self, data: np.ndarray) -> np.ndarray:
        """The safe cuts of the texts' bytes."""
        stops = np.flatnonzero(STOPS[data])
        found = [stops[letter_before(data, stops)]]
        if self.byte_level:
            spaces = np.flatnonzero(data == 32)
            plain = PRINTABLE[data[np.maximum(spaces - 1, 0)]]
            odd = spaces[~plain]
            found += [spaces[plain], odd[letter_before(data, odd)]]
        else:
            found.append(np.flatnonzero(BREAKS[data]))
        return np.concatenate(found)

    def chunks(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """The chunks of all texts end to end, and where those of each text begin."""
        data, offsets = flat(texts)
        cuts = self.cuts(data)
        raw = data.tobytes().lower() if self.added else b""
        if any(t.lower().encode() in raw for t in self.added):  # in any case, as the word vocabulary folds it
            marked = [any(t.lower() in (x or "").lower() for t in self.added) for x in texts.to_pylist()]
            cuts = cuts[~np.array(marked)[np.searchsorted(offsets, cuts, side="right") - 1]]
        marks = np.zeros(len(data) + 1, bool)
        marks[cuts] = marks[offsets] = True
        places = np.flatnonzero(marks)
        pieces = pa.Array.from_buffers(pa.large_string(), len(places) - 1, [None, pa.py_buffer(places), pa.py_buffer(data)])
        return pieces, np.searchsorted(places, offsets)

    def ids(self, chunks: Sequence[str]) -> list[bytes]:
        """The ids of distinct chunks as 32-bit numbers; all but runs of Latin letters take the library's whole path."""
        out, rest, memo = [], [], self.memo
        if len(memo) > self.MEMO:
            memo.clear()
        space = chr(self.letters[32])
        for i, c in enumerate(chunks):
            known = memo.get(c)
            if known is None:
                body = c[1:] if c[:1] == " " or c[:1] == "\n" and not self.byte_level else c
                if body.isalpha() and body.isascii():
                    spelt = body.lower() if not self.byte_level else c if body is c else space + body
                    known = memo[c] = array("I", [t.id for t in self.merge(spelt)]).tobytes()
                elif body.isalpha() and LATIN.fullmatch(body) and "İ" not in body:
                    spelt = c if self.byte_level else body.lower()
                    known = memo[c] = array("I", [t.id for t in self.merge(spelt.encode().decode("latin-1").translate(self.letters))]).tobytes()
                else:
                    rest.append(i)
            out.append(known)
        for i, e in zip(rest, self.tokenizer.encode_batch_fast([chunks[i] for i in rest], add_special_tokens=False)):
            out[i] = array("I", e.ids).tobytes()
            if len(chunks[i]) < 64:
                memo[chunks[i]] = out[i]
        return out

    def block(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets): the ids of all texts end to end (null: none) and where each text begins."""
        texts = texts.cast(pa.large_string()).fill_null("")
        if not len(texts):
            return np.zeros(0, np.uint32), np.zeros(1, np.int64)
        pieces, begins = self.chunks(pa.concat_arrays([texts]))
        coded = pc.dictionary_encode(pieces)
        found = self.ids(coded.dictionary.to_pylist())
        size = np.fromiter(map(len, found), np.int64, len(found)) // 4
        pool = np.frombuffer(b"".join(found), np.uint32)
        index = np.asarray(coded.indices)
        sizes = size[index]
        ends = np.cumsum(sizes)
        first = (np.cumsum(size) - size)[index] - (ends - sizes)
        ids = pool[np.repeat(first, sizes) + np.arange(int(ends[-1]) if len(ends) else 0)]
        return ids, np.concatenate([[0], ends])[begins]

    def batches(self, batches: Iterator[pa.RecordBatch], column: str,
                block_bytes: int = BLOCK_BYTES) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
        """Slices of the batches, each with the ids of its texts."""
        for b in byte_sized(batches, column, block_bytes):
            ids, bounds = self.block(b.column(column))
            yield b, [ids[lo:hi] for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
