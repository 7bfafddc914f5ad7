"""Benchmark passages in documents, found by a suffix automaton of all benchmark items.

The automaton holds every run of words of every item. A document streams through it word by word;
the state gives the longest run of item words that ends at the word. Where that run reaches a
window, the words of the window are hit.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (
    LETTERED,
    Shared,
    Texts,
    Words,
    cut_lineage,
    parts_of,
    restored,
    set_aside,
    text_batches,
)


@dataclass(frozen=True)
class Limits:
    """A window is ``window`` consecutive words of an item, or all words of a shorter one.

    A document is contaminated if ``100 * hit words >= percent * words`` and any word is hit.
    ``block_words`` bounds the items of one automaton (about 40 MB in a worker): a larger benchmark
    is split into blocks by item, a longer item into parts that overlap by a window. Tasks build the
    automata; the documents pass ``per_pass`` of them at a time.
    """

    window: int = 13
    percent: int = 5
    block_words: int = 100_000
    per_pass: int = 4


class SuffixAutomaton:
    """Generalised suffix automaton over sequences of word numbers."""

    def __init__(self, items: list[tuple[str, list[int]]], window: int):
        self.window = window
        self.length, self.link, self.next = [0], [-1], [{}]
        for _, words in items:
            last = 0
            for word in words:
                last = self._extend(last, word)
        n = len(self.length)
        self.holders: dict[int, set[str]] = {}
        marks: dict[int, list[tuple[int, str]]] = {}
        self.above = [0] * n
        order = sorted(range(1, n), key=self.length.__getitem__)
        for state in order:
            up = self.link[state]
            if self.length[state] >= window:
                self.above[state] = self.above[up] if self.length[up] >= window else state
        for item, words in items:
            state = size = 0
            for word in words:
                state, size = self.step(state, size, word)
                if size >= window:
                    self.holders.setdefault(self.above[state], set()).add(item)
            if 0 < len(words) < window:
                while self.length[self.link[state]] >= len(words):
                    state = self.link[state]
                marks.setdefault(state, []).append((len(words), item))
        # Short items that end where a run ends: the state's own and those of its suffixes.
        self.short: dict[int, list[tuple[int, str]]] = {}
        for state in order:
            found = self.short.get(self.link[state], []) + marks.get(state, [])
            if found:
                self.short[state] = found

    def _extend(self, last: int, word: int) -> int:
        length, link, next_ = self.length, self.link, self.next
        seen = next_[last].get(word)
        if seen is not None:
            return seen if length[seen] == length[last] + 1 else self._clone(last, word, seen)
        new = self._state(length[last] + 1, 0, {})
        at = last
        while at != -1 and word not in next_[at]:
            next_[at][word] = new
            at = link[at]
        if at != -1:
            old = next_[at][word]
            link[new] = old if length[old] == length[at] + 1 else self._clone(at, word, old)
        return new

    def _state(self, length: int, link: int, next_: dict[int, int]) -> int:
        self.length.append(length)
        self.link.append(link)
        self.next.append(next_)
        return len(self.length) - 1

    def _clone(self, at: int, word: int, old: int) -> int:
        """Split off the part of ``old`` that is no longer than what reaches it from ``at``."""
        new = self._state(self.length[at] + 1, self.link[old], dict(self.next[old]))
        self.link[old] = new
        while at != -1 and self.next[at].get(word) == old:
            self.next[at][word] = new
            at = self.link[at]
        return new

    def step(self, state: int, size: int, word: int) -> tuple[int, int]:
        """The state and length of the longest known run that ends at ``word``."""
        while state and word not in self.next[state]:
            state = self.link[state]
            size = self.length[state]
        to = self.next[state].get(word)
        return (0, 0) if to is None else (to, size + 1)

    def spans(self, words: list[int], start: int) -> Iterator[tuple[int, int, object]]:
        """(first word, end, items) of each window in the run of known words that begins at ``start``."""
        state = size = 0
        window, above, short = self.window, self.above, self.short
        for end, word in enumerate(words, start + 1):
            state, size = self.step(state, size, word)
            if size >= window:
                yield end - window, end, self.holders[above[state]]
            for least, item in short.get(state, ()):
                if least <= size:
                    yield end - least, end, (item,)


class _Matcher:
    """The automaton with its vocabulary: word hashes in order, numbered by place."""

    def __init__(self, items: list[tuple[str, np.ndarray]], window: int):
        hashes = [h for _, h in items]
        self.vocabulary = np.unique(np.concatenate(hashes)) if hashes else np.empty(0, np.uint64)
        numbered = [(i, np.searchsorted(self.vocabulary, h).tolist()) for i, h in items]
        self.automaton = SuffixAutomaton(numbered, window)
        self.shortest = min([window, *(len(h) for h in hashes)])

    def hits(self, hashes: np.ndarray) -> tuple[list[tuple[int, int]], set[str]]:
        """Merged spans of hit words of a document, and the items whose windows occur."""
        if not len(self.vocabulary):
            return [], set()
        at = np.searchsorted(self.vocabulary, hashes)
        at[at == len(self.vocabulary)] = 0
        known = np.r_[False, self.vocabulary[at] == hashes, False]
        turns = np.flatnonzero(known[1:] != known[:-1])
        spans: list[tuple[int, int]] = []
        items: set[str] = set()
        # Words that no item has end every run, so only runs of known words are streamed.
        for a, b in zip(turns[::2].tolist(), turns[1::2].tolist()):
            if b - a < self.shortest:
                continue
            for first, end, found in self.automaton.spans(at[a:b].tolist(), a):
                items.update(found)
                spans.append((first, end))
        return _merged(spans), items


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for first, end in sorted(spans):
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((first, end))
    return out


def _item_words(benchmark: DataFrame, limits: Limits) -> DataFrame:
    """(item_id, words): the word hashes of each item, long items in overlapping parts, so that every
    window is whole in some part."""
    items = (
        keyed_items(benchmark)
        .where("item_id IS NOT NULL AND text IS NOT NULL")
        .select(F.col("item_id").cast("string").alias("item_id"), "text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_batches(batches, "text"):
            words = Words(texts, LETTERED)
            ids, parts = [], []
            for item, a, b in zip(batch.column("item_id").to_pylist(), words.first[:-1], words.first[1:]):
                for start in range(a, b, limits.block_words):
                    end = min(b, start + limits.block_words + limits.window - 1)
                    # The words that only follow the last window of a part are its successor's alone.
                    if start == a or end - start >= limits.window:
                        ids.append(item)
                        parts.append(words.hashes[start:end].tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.string()), pa.array(parts, pa.binary())], ["item_id", "words"]
            )

    return items.mapInArrow(run, "item_id string, words binary")


def _matchers(benchmark: DataFrame, limits: Limits) -> DataFrame:
    """(block, matcher): the automata of all blocks, built by tasks and kept in the shared folder."""
    items = cut_lineage(_item_words(benchmark, limits))
    words = (items.select(F.sum(F.length("words"))).first()[0] or 0) // 8
    blocks = parts_of(words, limits.block_words)

    def build(key: tuple[pa.Scalar], rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("item_id", "ascending"), ("words", "ascending")])
        found = [
            (item, np.frombuffer(words, np.uint64))
            for item, words in zip(rows.column("item_id").to_pylist(), rows.column("words").to_pylist())
        ]
        matcher = cloudpickle.dumps(_Matcher(found, limits.window))
        return pa.table({"block": pa.array([key[0].as_py()], pa.int64()), "matcher": pa.array([matcher], pa.binary())})

    dealt = items.withColumn("block", F.pmod(F.xxhash64("item_id", "words"), F.lit(blocks)))
    return cut_lineage(dealt.groupBy("block").applyInArrow(build, "block long, matcher binary"))


def keyed_items(benchmark: DataFrame) -> DataFrame:
    names = benchmark.columns
    placed = benchmark.toDF(*[f"c{i}" for i in range(len(names))])
    return placed.select(*(F.col(f"c{names.index(n)}").alias(n) for n in ("item_id", "text")))


def find_contamination(docs: DataFrame, benchmark: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Per row of ``docs``: its hit spans, the items found, and its text without the spans.

    Columns: doc_id, text, rest (the other columns, see ``common.set_aside``), items (ids as
    strings, in string order), spans (first word and end, merged), n_words, n_hit, contaminated,
    cleaned (the text without the bytes from the first to the last word of each span; NULL where
    nothing was found).

    Words are runs of a-z, 0-9 and non-ASCII characters once A-Z are lowered. A NULL text has no
    words and stays NULL. Items with a NULL id or text or without words are left out; items that
    share an id count once. Empty tables give no rows, or no hits.
    """
    frame = set_aside(docs)
    fields = {f.name: f.dataType.simpleString() for f in frame.schema}
    fields |= {"items": "array<string>", "spans": "array<array<int>>"}
    none = [F.expr(f"cast(array() as {fields[c]})").alias(c) for c in ("items", "spans")]
    whole = frame.select("*", *none)
    matchers = _matchers(benchmark, limits)
    blocks = sorted(row.block for row in matchers.select("block").collect())
    passes = [blocks[i : i + limits.per_pass] for i in range(0, len(blocks), limits.per_pass)]
    waiting = Shared(docs.sparkSession, [])
    for number, some in enumerate(passes):
        if number:
            # The files end the work of a pass, so that no task holds the automata of two.
            whole = cut_lineage(whole.mapInArrow(_search(waiting, None), _ddl(fields)))
        wanted = matchers.where(F.col("block").isin(some)).select("matcher").collect()
        waiting = Shared(docs.sparkSession, [bytes(row.matcher) for row in wanted])
    fields |= {"n_words": "long", "n_hit": "long", "contaminated": "boolean", "cleaned": "string"}
    return whole.mapInArrow(_search(waiting, limits.percent), _ddl(fields))


def _ddl(fields: dict[str, str]) -> str:
    return ", ".join(f"{name} {kind}" for name, kind in fields.items())


def _search(matchers: Shared, percent: int | None):
    """Adds the spans and items of some blocks of the benchmark; after the last ones, judges by ``percent``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searches = [cloudpickle.loads(matcher) for matcher in matchers.load()]
        for batch, texts in text_batches(batches, "text"):
            words = Words(texts, LETTERED)
            spans, items = (batch.column(c).to_pylist() for c in ("spans", "items"))
            for i, (a, b) in enumerate(zip(words.first[:-1], words.first[1:])):
                for search in searches:
                    more, found = search.hits(words.hashes[a:b])
                    if not more:
                        continue
                    spans[i] = [list(s) for s in _merged([tuple(s) for s in spans[i]] + more)]
                    items[i] = sorted(found.union(items[i]))
            columns = {c: batch.column(c) for c in ("doc_id", "text", "rest")}
            columns["items"] = pa.array(items, pa.list_(pa.string()))
            columns["spans"] = pa.array(spans, pa.list_(pa.list_(pa.int32())))
            if percent is not None:
                counts = np.diff(words.first)
                hit = np.array([sum(b - a for a, b in s) for s in spans], np.int64)
                columns["n_words"], columns["n_hit"] = pa.array(counts), pa.array(hit)
                columns["contaminated"] = pa.array((hit > 0) & (100 * hit >= percent * counts))
                cut = [_cut(texts, words, i, s) if s else None for i, s in enumerate(spans)]
                columns["cleaned"] = pa.array(cut, pa.string())
            yield pa.RecordBatch.from_pydict(columns)

    return run


def _cut(texts: Texts, words: Words, i: int, spans: list[list[int]]) -> str:
    """Text i without the bytes from the first to the last word of each span."""
    at, left = int(texts.bounds[i]), []
    for a, b in spans:
        left.append(texts.data[at : words.starts[words.first[i] + a]])
        at = int(words.ends[words.first[i] + b - 1])
    left.append(texts.data[at : texts.bounds[i + 1]])
    return b"".join(x.tobytes() for x in left).decode()


def without_contaminated(docs: DataFrame, benchmark: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """``docs`` without the contaminated rows, all columns as they were."""
    found = find_contamination(docs, benchmark, limits)
    return restored(found.where(~F.col("contaminated")), docs.columns)


def without_spans(docs: DataFrame, benchmark: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """``docs`` without the contaminated rows and with the other rows' hit spans cut out."""
    found = find_contamination(docs, benchmark, limits).where(~F.col("contaminated"))
    return restored(found, docs.columns, text=F.coalesce("cleaned", "text"))
