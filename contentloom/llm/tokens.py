"""Byte-level BPE tokens of whole columns, the ids that the ``tokenizers`` library gives.

Most words of a text have been seen before, so words are found and hashed as arrays, known ones
are looked up in a table, and only new ones are tokenized. The split into words is the
vocabulary's own pattern, worked out on arrays of code points for characters below U+0250 whose
class no version of Unicode disputes; a text with any other character, or with a special token's
string, goes to the library whole.
"""

from __future__ import annotations

import base64
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa

from .common import _Powers, mixed, text_batches

#: The pattern that splits text before merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_LETTER, _NUMBER, _SPACE, _OTHER, _ODD = range(5)
_KNOWN = 0x250


def _class(code: int) -> int:
    if code in (9, 10, 13, 32):
        return _SPACE
    kind = unicodedata.category(chr(code))
    if kind[0] in "CZ" or code == 0xAD:
        return _ODD
    return {"L": _LETTER, "N": _NUMBER}.get(kind[0], _OTHER)


def _classes() -> np.ndarray:
    return np.array([_class(c) for c in range(_KNOWN)] + [_ODD], np.uint8)


@dataclass(frozen=True)
class Vocabulary:
    """``path``: the tokenizer's JSON file. ``ranks``: the same vocabulary as base64 ranks.

    Both must be readable where tasks run; nothing of them is kept in the package. ``special``:
    strings that the JSON file lists as tokens of their own.
    """

    path: str
    ranks: str
    special: tuple[str, ...] = ("<|endoftext|>",)

    def encoder(self) -> Encoder:
        return Encoder(self)


class Encoder:
    """Tokenizes batches; one lives as long as its task.

    ``slots`` is the size of the table of known words; a new word takes the place of the old one
    in its slot, so memory is bounded whatever the corpus holds.
    """

    def __init__(self, vocabulary: Vocabulary, slots: int = 1 << 19):
        import tiktoken

        self.path, self.library = vocabulary.path, None
        with open(vocabulary.ranks, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.words = tiktoken.Encoding(
            "words", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        self.special = vocabulary.special
        self.classes = _classes()
        self.values = mixed(np.arange(1, _KNOWN + 2, dtype=np.uint64))
        self.slots = slots
        self._forget()

    def whole(self, text: str) -> list[int]:
        """The ids of a text that the library takes whole; it is loaded with the first one."""
        if self.library is None:
            import os

            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_file(self.path)
        return self.library.encode(text, add_special_tokens=False).ids

    def _forget(self) -> None:
        self.keys = np.zeros(self.slots, np.uint64)
        self.at = np.zeros(self.slots, np.int32)
        self.counts = np.zeros(self.slots, np.int32)
        self.pool = np.empty(1 << 20, np.uint32)
        self.used = 0

    def batches(
        self, batches: Iterator[pa.RecordBatch], column: str, end: int
    ) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
        """Each batch with the ids of its rows, one after the other, and the bounds of each row."""
        for batch, texts in text_batches(batches, column, 1 << 18):
            rows = [texts.data[a:b].tobytes().decode() for a, b in zip(texts.bounds[:-1], texts.bounds[1:])]
            ids, bounds = self._encode(rows, end)
            yield batch, ids, bounds

    def _encode(self, rows: list[str], end: int) -> tuple[np.ndarray, np.ndarray]:
        text = "".join(rows)
        codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        edges = np.cumsum([0, *map(len, rows)])
        capped = np.minimum(codes, _KNOWN)
        classes = self.classes[capped]
        odd = np.r_[0, np.cumsum(classes == _ODD)]
        whole = odd[edges[1:]] > odd[edges[:-1]]
        if any(s in text for s in self.special):
            whole |= np.array([any(s in row for s in self.special) for row in rows])
        starts = np.flatnonzero(word_starts(codes, classes, edges))
        ends = np.r_[starts[1:], len(codes)]
        row = np.repeat(np.arange(len(rows)), np.diff(np.searchsorted(starts, edges)))
        fast = ~whole[row]
        starts, ends, row = starts[fast], ends[fast], row[fast]
        ids, counts = self._tokens(text, capped, starts, ends)

        sizes = np.bincount(row, counts, len(rows)).astype(np.int64)
        slow = {int(i): self.whole(rows[i]) for i in np.flatnonzero(whole)}
        for i, found in slow.items():
            sizes[i] = len(found)
        bounds = np.r_[0, np.cumsum(sizes + 1)]
        out = np.full(bounds[-1], end, np.uint32)
        keep = np.ones(len(out), bool)
        keep[bounds[1:] - 1] = False
        for i, found in slow.items():
            out[bounds[i] : bounds[i] + len(found)] = found
            keep[bounds[i] : bounds[i] + len(found)] = False
        out[keep] = ids
        return out, bounds

    def _tokens(
        self, text: str, capped: np.ndarray, starts: np.ndarray, ends: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words in a row, and how many each has; ``capped``: code points up to a bound."""
        if not len(starts):
            return np.empty(0, np.uint32), np.empty(0, np.int64)
        if self.used > 4 << 20:
            self._forget()
        keys = self._word_keys(capped, starts, ends)
        slot = (keys & np.uint64(self.slots - 1)).astype(np.int64)
        new = np.flatnonzero(self.keys[slot] != keys)
        at, counts = self.at[slot].astype(np.int64), self.counts[slot].astype(np.int64)
        if len(new):
            fresh, first, back = np.unique(keys[new], return_index=True, return_inverse=True)
            first = new[first]
            encode = self.words.encode_ordinary
            bounds = zip(starts[first].tolist(), ends[first].tolist())
            found = [encode(text[a:b]) for a, b in bounds]
            many = np.fromiter(map(len, found), np.int64, len(found))
            where = self.used + np.cumsum(many) - many
            self._keep(np.fromiter(chain.from_iterable(found), np.uint32, int(many.sum())))
            at[new], counts[new] = where[back], many[back]
            # Of new words in one slot the last one stays; all three arrays agree on it.
            slot = (fresh & np.uint64(self.slots - 1)).astype(np.int64)
            self.keys[slot], self.at[slot], self.counts[slot] = fresh, where, many
        total = int(counts.sum())
        first = np.cumsum(counts) - counts
        return self.pool[np.arange(total) + np.repeat(at - first, counts)], counts

    def _keep(self, ids: np.ndarray) -> None:
        if self.used + len(ids) > len(self.pool):
            self.pool = np.r_[self.pool, np.empty(max(len(ids), len(self.pool)), np.uint32)]
        self.pool[self.used : self.used + len(ids)] = ids
        self.used += len(ids)

    def _word_keys(self, codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hashes of words of known characters."""
        up, down = _Powers.to(len(codes) + 1)
        sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(self.values[codes] * up[: len(codes)], out=sums[1:])
        keys = mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
        return np.where(keys == 0, np.uint64(1), keys)


def word_starts(codes: np.ndarray, classes: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Where the pattern's matches begin, for texts joined end to end; ``edges`` has their bounds.

    Runs of letters, of numbers and of other signs are words, with a blank before them if there
    is one. A run of white space is a word up to its last character; that one joins the next run
    if it is a blank and is a word of its own otherwise. An apostrophe that begins a word takes a
    following contraction with it.
    """
    n = len(codes)
    first = np.zeros(n + 1, bool)
    first[edges] = True
    first = first[:n]
    last = np.r_[first[1:], True][:n]
    space = classes == _SPACE
    before = np.r_[np.uint8(_ODD), classes[:-1]][:n]
    blank_before = np.r_[False, (codes == 32)[:-1]][:n] & ~first
    space_before = np.r_[False, space[:-1]][:n] & ~first
    space_after = np.r_[space[1:], False][:n]
    # Within a run of white space only its last character begins a word, if a word follows.
    inner = space & space_before & (last | space_after)
    starts = first | np.where(space, ~inner, np.where(space_before, ~blank_before, classes != before))

    quote = np.flatnonzero(starts & (codes == 0x27))
    if len(quote):
        text_end = edges[np.searchsorted(edges, quote, "right")]
        padded = np.r_[codes, np.zeros(2, np.uint32)]
        one = np.where(quote + 1 < text_end, padded[quote + 1], 0)
        two = np.where(quote + 2 < text_end, padded[quote + 2], 0)
        single = np.isin(one, [ord(c) for c in "stmd"])
        double = np.zeros(len(quote), bool)
        for a, b in ("re", "ve", "ll"):
            double |= (one == ord(a)) & (two == ord(b))
        starts[quote[single | double] + 1] = False
        for found, size in ((single, 2), (double, 3)):
            after = quote[found] + size
            starts[after[after < n]] = True
    return starts
