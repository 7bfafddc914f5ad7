"""Collocations from count streams in prefix and suffix order, merged in lockstep.

Every task counts the phrases of its texts, a shuffle adds the counts up, and only phrases frequent
enough go on. No phrase is more frequent than a part of it, so longer ones are counted where both
parts may be frequent. What is left is one stream of records, the number of all words (the empty
phrase), single words and longer phrases together.

In prefix order, a phrase stands right after its own beginnings, so one pass that remembers the last
record of each length knows the count of every beginning, and the greatest count among the phrases
that go on with one more word. In suffix order, with the words of each phrase reversed, the same
pass gives the counts of the endings and of the phrases with one word more in front. No count is
looked up by hash. The order is cut by ranges wherever rows are many, also inside the phrases of one frequent word;
what a cut separates goes over it as one record for each length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Shared, Texts, cut_lineage, mixed, parts_of, set_aside, text_batches

#: Words whose phrases are counted together, and bytes of phrases that are cut out at a time.
CHUNK_WORDS = 1 << 20
TEXT_BYTES = 8 << 20
CUT_BYTES = 1 << 22
#: Bytes of a part of a filter that one row carries.
SEGMENT = 1 << 13
_FACTOR = np.uint64(0x9E3779B97F4A7C15)

_LOWER = np.array([b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)], np.uint8)
_ENDS = np.isin(np.arange(256), list(b".,;:!?\x0a\x0b\x0c\x0d"))
_WORD = ~_ENDS & ~np.isin(np.arange(256), list(b"\x20\x09"))


@dataclass(frozen=True)
class PhraseSettings:
    """Phrases of 2 to ``most_words`` words that occur ``least`` times or more; of each language the
    first ``top``. A phrase goes if one longer by some words has ``inside_percent`` of its count.
    ``per_part``: records of one task; ``per_merge``: tasks whose best phrases meet first;
    ``filter_bytes``: size of a filter at most, a power of two.
    """

    most_words: int = 3
    least: int = 10
    top: int = 2000
    inside_percent: int = 50
    scale: int = 1_000_000
    per_part: int = 200_000
    per_merge: int = 64
    filter_bytes: int = 1 << 25


def _spans(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and whether a word and the next one share a piece."""
    inside = _WORD[texts.data]
    cut = np.zeros(len(inside) + 1, bool)
    cut[texts.bounds] = True
    before, after = np.r_[False, inside[:-1]], np.r_[inside[1:], False]
    starts = np.flatnonzero(inside & (~before | cut[:-1]))
    ends = np.flatnonzero(inside & (~after | cut[1:])) + 1
    piece = np.cumsum(_ENDS[texts.data] | cut[:-1], dtype=np.int32)[starts]
    return starts, ends, piece[1:] == piece[:-1]


def _taken(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The bytes of many spans, one after the other."""
    out = np.empty(int(sizes.sum()), np.uint8)
    done, i, upto = 0, 0, np.cumsum(sizes)
    while i < len(sizes):
        j = max(i + 1, int(np.searchsorted(upto, done + CUT_BYTES, "right")))
        own = sizes[i:j]
        place = np.repeat(starts[i:j] - (upto[i:j] - own - done), own) + np.arange(own.sum())
        out[done : done + len(place)] = data[place]
        done, i = done + len(place), j
    return out


def _binaries(data: np.ndarray, sizes: np.ndarray) -> pa.Array:
    bounds = np.r_[0, np.cumsum(sizes)].astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(bounds), pa.py_buffer(data)])


class Chunk:
    """Some words of a batch, ``own`` of them and those that phrases of the last ones need."""

    def __init__(self, texts: Texts, spans: tuple, first: int, own: int, most_words: int):
        starts, ends, together = spans
        chunk = slice(first, first + own + most_words - 1)
        begin, sizes = starts[chunk], (ends - starts)[chunk]
        # The words of the chunk in one row, each with a blank behind it.
        self.row = np.full(int(sizes.sum()) + len(sizes), 0x20, np.uint8)
        self.at = np.r_[0, np.cumsum(sizes + 1)]
        blank = np.zeros(len(self.row), bool)
        blank[self.at[1:] - 1] = True
        self.row[~blank] = _LOWER[_taken(texts.data, begin, sizes)]
        words = _binaries(self.row, sizes + 1).dictionary_encode()
        self.own, self.words = own, words.dictionary
        self.codes = np.asarray(words.indices).astype(np.int64)
        self.joined = np.r_[together[chunk.start : chunk.stop - 1], False][: len(sizes)]

    def longer(self, places: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of phrases of k words, from those of one word less, and a number for each phrase."""
        on = places + k - 1 < len(self.codes)
        on[on] = self.joined[places[on] + k - 2]
        places = places[on]
        return places, ids[on] * len(self.words) + self.codes[places + k - 1]

    def phrases(self, places: np.ndarray, k: int) -> pa.Array:
        length = self.at[places + k] - self.at[places]
        return _binaries(_taken(self.row, self.at[places], length), length)


def chunks(texts: Texts, most_words: int) -> Iterator[Chunk]:
    spans = _spans(texts) if len(texts.data) else [()]
    for first in range(0, len(spans[0]), CHUNK_WORDS):
        yield Chunk(texts, spans, first, min(CHUNK_WORDS, len(spans[0]) - first), most_words)


def short_counts(chunk: Chunk) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """(phrases, counts) of up to two words; the empty phrase counts all words."""
    own = chunk.codes[: chunk.own]
    yield pa.array([b""], pa.binary()), np.array([chunk.own])
    count = np.bincount(own, minlength=len(chunk.words))
    known = np.flatnonzero(count)
    yield chunk.words.take(pa.array(known)), count[known]
    places, keys = chunk.longer(np.arange(chunk.own), own, 2)
    _, index, count = np.unique(keys, return_index=True, return_counts=True)
    yield chunk.phrases(places[index], 2), count


def long_counts(chunk: Chunk, k: int, known: Filter) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """(phrases, counts) of k words whose first and last k - 1 words may both be frequent."""
    places, ids = np.arange(len(chunk.codes)), chunk.codes
    hashes = hashed_words(chunk.words.to_pylist())
    sums = hashes[ids]
    for length in range(2, k):
        places, keys = chunk.longer(places, ids, length)
        _, index, ids = np.unique(keys, return_index=True, return_inverse=True)
        ends = hashes[chunk.codes[places + length - 1]]
        sums[places] = chained_on(sums[places], ends)
    may = np.zeros(len(chunk.codes) + 1, bool)
    may[places] = known.may_have(sums[places[index]])[ids]
    both = may[places] & may[places + 1] & (places < chunk.own)
    places, keys = chunk.longer(places[both], ids[both], k)
    _, index, count = np.unique(keys, return_index=True, return_counts=True)
    yield chunk.phrases(places[index], k), count


def hashed_words(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def chained_on(hashes: np.ndarray, following: np.ndarray) -> np.ndarray:
    """Hashes of phrases with one more word behind."""
    return mixed(hashes * _FACTOR + following)


class Filter:
    """A Bloom filter of the frequent phrases of one length. What is not in it cannot be part of a
    frequent longer phrase and is not counted; what is wrongly taken for one is counted and then found
    rare. Its size is bounded, so a full one spares less and changes no result."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits

    @staticmethod
    def places(hashes: np.ndarray, size: int) -> list[np.ndarray]:
        step = (hashes >> np.uint64(32)) | np.uint64(1)
        return [((hashes + np.uint64(i) * step) & np.uint64(8 * size - 1)).astype(np.int64) for i in range(4)]

    def may_have(self, hashes: np.ndarray) -> np.ndarray:
        found = np.ones(len(hashes), bool)
        for at in self.places(hashes, len(self.bits)):
            found &= (self.bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)
        return found

    @classmethod
    def of(cls, counts: DataFrame, k: int, settings: PhraseSettings) -> Filter:
        """The filter of the phrases of k words; tasks set bits in segments, which meet by segment."""
        rows = counts.count()
        size = min(settings.filter_bytes, 1 << max(13, (2 * rows - 1).bit_length()))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            bits = np.zeros(size, np.uint8)
            for batch in batches:
                split = [p.split(b" ") for p in batch.column("phrase").to_pylist() if p.count(b" ") == k]
                if not split:
                    continue
                columns = [hashed_words([w + b" " for w in column]) for column in list(zip(*split))[:k]]
                sums = columns[0]
                for column in columns[1:]:
                    sums = chained_on(sums, column)
                for at in cls.places(sums, size):
                    np.bitwise_or.at(bits, at >> 3, np.uint8(1) << (at & 7).astype(np.uint8))
            parts = bits.reshape(-1, SEGMENT)
            used = np.flatnonzero(parts.any(axis=1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(used, pa.int32()), pa.array([parts[i].tobytes() for i in used], pa.binary())],
                ["segment", "bits"],
            )

        def union(table: pa.Table) -> pa.Table:
            whole = np.zeros(SEGMENT, np.uint8)
            for part in table.column("bits"):
                whole |= np.frombuffer(part.as_py(), np.uint8)
            return pa.table({"segment": table.column("segment")[:1], "bits": pa.array([whole.tobytes()], pa.binary())})

        form = "segment int, bits binary"
        bits = np.zeros(size, np.uint8)
        # ``size`` bytes at most.
        for row in counts.mapInArrow(run, form).groupBy("segment").applyInArrow(union, form).collect():
            bits[row.segment * SEGMENT : (row.segment + 1) * SEGMENT] = np.frombuffer(row.bits, np.uint8)
        return cls(bits)


def _joined_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches put together until they have ``TEXT_BYTES`` of text or more."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.column("text").nbytes
        if size >= TEXT_BYTES:
            yield pa.concat_batches(held)
            held, size = [], 0
    if held:
        yield pa.concat_batches(held)


def _summed(texts: DataFrame, settings: PhraseSettings, counted) -> DataFrame:
    """(lang, phrase, n): what ``counted`` gives for all chunks, added up, if frequent enough.

    Chunks have added up their own equal phrases and those of different chunks seldom meet in one
    task, so the rows go to their places first and are added up there.
    """
    most = settings.most_words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in _joined_batches(batches):
            for own in pc.unique(whole.column("lang")):
                rows = whole.filter(pc.equal(whole.column("lang"), own))
                for _, found in text_batches([rows], "text", 2 * TEXT_BYTES):
                    for chunk in chunks(found, most):
                        for phrases, n in counted(chunk):
                            columns = [pa.repeat(own, len(n)), phrases, pa.array(n, pa.int64())]
                            yield pa.RecordBatch.from_arrays(columns, ["lang", "phrase", "n"])

    parts = texts.mapInArrow(run, "lang string, phrase binary, n long").repartition("lang", "phrase")
    sums = parts.groupBy("lang", "phrase").agg(F.sum("n").alias("n"))
    return cut_lineage(sums.where((F.col("n") >= settings.least) | (F.length("phrase") == 0)))


def phrase_counts(docs: DataFrame, settings: PhraseSettings) -> DataFrame:
    """(lang, phrase, n): phrases of up to ``most_words`` words that are frequent enough, and the
    empty phrase with the number of all words.

    Words and pairs are counted in one pass over the texts. Each longer length has a pass of its own,
    which counts only phrases whose parts passed the filter of the length before.
    """
    s = settings
    lang = F.lit(None).cast("string")
    if "lang" in docs.columns:
        lang = F.col(f"rest.c{docs.columns.index('lang')}").cast("string")
    texts = set_aside(docs).where("text IS NOT NULL")
    texts = texts.select(F.coalesce(lang, F.lit("und")).alias("lang"), "text")
    counts = last = _summed(texts, s, short_counts)
    for k in range(3, s.most_words + 1):
        known = Shared(docs.sparkSession, Filter.of(last, k - 1, s))
        last = _summed(texts, s, lambda chunk, k=k, known=known: long_counts(chunk, k, known.load()))
        counts = counts.unionByName(last)
    return counts


# --- the lockstep pass ------------------------------------------------------------------------


def _lengths(keys: pa.Array) -> np.ndarray:
    """Words of each phrase."""
    return np.asarray(pc.count_substring(keys.cast(pa.large_binary()), b" ")).astype(np.int64)


def _whole(batches: Iterator[pa.RecordBatch]) -> pa.Table | None:
    found = [b for b in batches if b.num_rows]
    return pa.Table.from_batches(found).combine_chunks() if found else None


def borders(length: np.ndarray, n: np.ndarray, most: int) -> list[tuple[bool, int, int]]:
    """For each length: is there a record of it, the count of the last one, and the greatest count
    of the phrases one word longer before the first one."""
    out = []
    for k in range(most + 1):
        here = np.flatnonzero(length == k)
        longer = length == k + 1
        longer[here[0] if len(here) else len(length) :] = False
        out.append((bool(len(here)), int(n[here[-1]]) if len(here) else 0, int(n[longer].max(initial=0))))
    return out


def carried(found: dict[int, list[tuple[bool, int, int]]], most: int) -> dict[int, tuple[list[int], list[int]]]:
    """For each part with records: the last counts before it, and the greatest counts of what goes
    on behind it."""
    parts = sorted(found)
    before, last = {}, [0] * (most + 1)
    for p in parts:
        before[p] = last
        last = [own[1] if own[0] else old for own, old in zip(found[p], last)]
    behind, lead = {}, [0] * (most + 1)
    for p in reversed(parts):
        behind[p] = lead
        lead = [own[2] if own[0] else max(own[2], old) for own, old in zip(found[p], lead)]
    return {p: (before[p], behind[p]) for p in parts}


def merged(
    length: np.ndarray, n: np.ndarray, most: int, before: list[int], behind: list[int]
) -> tuple[np.ndarray, np.ndarray]:
    """Counts of the beginnings of 0 to most - 1 words of each record, and the greatest count among
    the phrases one word longer that begin with it. Records stand in prefix order."""
    place = np.arange(len(n))
    shorter = np.zeros((len(n), most), np.int64)
    longer = np.zeros(len(n), np.int64)
    for k in range(most):
        at = np.maximum.accumulate(np.where(length == k, place, -1))
        shorter[:, k] = np.where(at >= 0, n[at], before[k])
        on = np.flatnonzero((length == k + 1) & (at >= 0))
        np.maximum.at(longer, at[on], n[on])
        ends = np.flatnonzero(length == k)
        if len(ends):
            longer[ends[-1]] = max(longer[ends[-1]], behind[k])
    return shorter, longer


class Stream:
    """Records (lang, key, n, more) kept in the order of lang and key, cut into ranges."""

    def __init__(self, records: DataFrame, rows: int, settings: PhraseSettings):
        self.most = settings.most_words
        parts = parts_of(rows, settings.per_part)
        in_order = records.repartitionByRange(parts, "lang", "key").sortWithinPartitions("lang", "key")
        self.records = cut_lineage(in_order)
        most = self.most

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            rows = _whole(batches)
            if rows is None:
                return
            n = np.asarray(rows.column("n"))
            own = borders(_lengths(rows.column("key").combine_chunks()), n, most)
            part = TaskContext.get().partitionId()
            columns = [[part] * len(own), list(range(len(own))), *map(list, zip(*own))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int32(), pa.bool_(), pa.int64(), pa.int64()))],
                ["part", "k", "seen", "last", "lead"],
            )

        # One row for each task and length.
        edges = self.records.select("key", "n").mapInArrow(run, "part int, k int, seen boolean, last long, lead long")
        found: dict[int, list] = {}
        for row in sorted(edges.collect()):
            found.setdefault(row.part, []).append((row.seen, row.last, row.lead))
        self._carried = carried(found, most)

    def merge(self, write, form: str) -> DataFrame:
        """``write`` (rows, lengths, shorter, longer) -> batch of the columns ``form``, for each task."""
        most, over = self.most, self._carried

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            rows = _whole(batches)
            if rows is None:
                return
            length = _lengths(rows.column("key").combine_chunks())
            n = np.asarray(rows.column("n"))
            yield write(rows, length, *merged(length, n, most, *over[TaskContext.get().partitionId()]))

        return self.records.mapInArrow(run, form)


def _turned(keys: pa.Array) -> pa.Array:
    return pa.array([b" ".join(k.split(b" ")[-2::-1]) + b" " if k else k for k in keys.to_pylist()], pa.binary())


def collocations(docs: DataFrame, settings: PhraseSettings = PhraseSettings()) -> DataFrame:
    """The best phrases of each language: lang, rank (from 1), phrase, a, l, r, n, score.

    Texts have A-Z lowered and are split at ``. , ; : ! ?`` and line ends into pieces, and those at
    blanks and tabs into words. a is the number of occurrences of the phrase inside pieces, l and r
    those of its two parts, n of all words of the language. The parts are those of the cut with the
    lowest score, scale * a * a / (l * r) rounded down, computed in whole numbers of any size; of
    equal ones the cut after the fewest words. A phrase of which a longer frequent one has at least
    ``inside_percent`` of the count is left out. Order: score and a falling, then UTF-8 bytes.

    A NULL text has no words; a NULL lang is ``und``, as is a table without that column. Rows with a
    NULL or a repeated doc_id count like others. Other columns are ignored; a language without
    frequent phrases, or an empty table, gives no rows.
    """
    s = settings
    counts = phrase_counts(docs, s).select("lang", F.col("phrase").alias("key"), "n")
    rows = counts.count()
    names = ["lang", "key", "n", "begins", "longer"]

    def begun(table, length, shorter, longer) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [
                table.column("lang").combine_chunks(),
                _turned(table.column("key")),
                table.column("n").combine_chunks(),
                pa.array(list(shorter), pa.list_(pa.int64())),
                pa.array(longer),
            ],
            names,
        )

    prefix = Stream(counts, rows, s)
    suffix = Stream(
        prefix.merge(begun, "lang string, key binary, n long, begins array<long>, longer long"), rows, s
    )
    columns = {"lang": pa.string(), "phrase": pa.string()}
    columns |= dict.fromkeys(("a", "l", "r", "n", "score", "part"), pa.int64())

    def ended(table, length, shorter, longer) -> pa.RecordBatch:
        a = np.asarray(table.column("n"))
        longer = np.maximum(longer, np.asarray(table.column("longer")))
        inside = [100 * x >= s.inside_percent * y for x, y in zip(longer.tolist(), a.tolist())]
        kept = np.flatnonzero((length >= 2) & ~np.array(inside, bool))
        few = table.take(pa.array(kept))
        few = few.set_column(few.column_names.index("key"), "key", _turned(few.column("key")))
        best: dict[str, list[tuple]] = {}
        facts = [few.column(c).to_pylist() for c in ("lang", "key", "n", "begins")]
        for lang, key, n, begins, ends in zip(*facts, shorter[kept].tolist()):
            words = key.count(b" ")
            cuts = [(s.scale * n * n // (begins[k] * ends[words - k]), k) for k in range(1, words)]
            score, k = min(cuts)
            best.setdefault(lang, []).append((-score, -n, key[:-1], begins[k], ends[words - k], begins[0]))
        part = TaskContext.get().partitionId()
        out = [
            (lang, key.decode(errors="replace"), -n, l, r, total, -score, part)
            for lang, found in best.items()
            for score, n, key, l, r, total in sorted(found)[: s.top]
        ]
        values = zip(*out) if out else [[]] * len(columns)
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, columns.values())], list(columns))

    form = "lang string, phrase string, a long, l long, r long, n long, score long, part long"
    found = suffix.merge(ended, form)
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    some = Window.partitionBy("lang", F.floor(F.col("part") / s.per_merge)).orderBy(*order)
    first = found.withColumn("rank", F.row_number().over(some)).where(F.col("rank") <= s.top)
    whole = Window.partitionBy("lang").orderBy(*order)
    ranked = first.withColumn("rank", F.row_number().over(whole).cast("bigint"))
    return ranked.where(F.col("rank") <= s.top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
