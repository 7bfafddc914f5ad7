"""The language of a text by rank-order profiles of its most frequent n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Shared, Texts, cut_lineage, remainder, set_aside, text_batches

FOLDS = 4
HELD_OUT = 2
UNKNOWN = "und"


@dataclass(frozen=True)
class LanguageSettings:
    """Profiles hold the ``ranks`` most frequent n-grams of 1 to ``longest`` bytes.

    n-grams are counted in ``places`` hash places. ``most_rows`` bounds the documents of one
    language that its profile is learned from, ``most_languages`` the profiles: those of the languages
    with the most documents, and no value of more than ``longest_name`` bytes is taken for a language.
    All texts are classified, whole.
    """

    longest: int = 3
    ranks: int = 400
    places: int = 1 << 14
    most_rows: int = 1500
    most_languages: int = 1000
    longest_name: int = 200
    seed: int = 31


def _letter_bytes() -> np.ndarray:
    """Each byte as counted: a-z for letters, bytes of other scripts as they are, 0 for the rest."""
    out = np.zeros(256, np.uint8)
    for b in range(256):
        low = b | 0x20
        if b >= 0x80:
            out[b] = b
        elif 0x61 <= low <= 0x7A and b >= 0x41:
            out[b] = low
    return out


_LETTERS = _letter_bytes()


class NGrams:
    """n-gram places of a batch of texts. A word begins and ends with 0, the sign between words."""

    def __init__(self, texts: Texts, settings: LanguageSettings):
        n, s = len(texts), settings
        signs = np.zeros(len(texts.data) + n + 1, np.uint8)
        at = np.arange(len(texts.data)) + np.repeat(np.arange(1, n + 1), np.diff(texts.bounds))
        signs[at] = _LETTERS[texts.data]
        heads = texts.bounds[:-1] + np.arange(n)
        keep = (signs != 0) | np.r_[True, signs[:-1] != 0]
        keep[heads] = True
        keep[-1] = True
        self.first = np.r_[np.cumsum(keep)[heads] - 1, keep.sum() - 1]
        signs = signs[keep].astype(np.uint32)
        shift = np.uint32(32 - (s.places.bit_length() - 1))
        self.grams = []
        code, whole = np.zeros(len(signs), np.uint32), np.ones(len(signs), bool)
        for size in range(1, s.longest + 1):
            if len(signs) < size:
                break
            code = code[: len(signs) - size + 1] * np.uint32(257) + signs[size - 1 :]
            # Only the first and the last sign of an n-gram may stand between words.
            whole = whole[: len(code)]
            if size > 2:
                whole = whole & (signs[size - 2 : len(signs) - 1] != 0)
            valid = whole & ((signs[: len(code)] != 0) | (signs[size - 1 :] != 0))
            place = ((code + np.uint32(size)) * np.uint32(2654435761)) >> shift
            self.grams.append((place, valid))
        self.places = s.places

    def counts(self, i: int) -> np.ndarray:
        found = []
        for place, valid in self.grams:
            part = slice(self.first[i], self.first[i + 1])
            found.append(place[part][valid[part]])
        return np.bincount(np.concatenate(found), minlength=self.places) if found else np.zeros(self.places, int)


def ranked(counts: np.ndarray, most: int) -> np.ndarray:
    """The places by falling count, the lower place first among equals."""
    some = np.flatnonzero(counts)
    keys = counts[some] * len(counts) + (len(counts) - 1 - some)
    if len(keys) > most:
        top = np.argpartition(-keys, most)[:most]
        some, keys = some[top], keys[top]
    return some[np.argsort(-keys)]


def has_letter(text: bytes) -> bool:
    if any(_LETTERS[b] and b < 0x80 for b in text[:64]):
        return True
    return any(c.isalpha() for c in text.decode("utf-8", "replace"))


def language_profiles(docs: DataFrame, settings: LanguageSettings = LanguageSettings()) -> dict[str, list[int]]:
    """The ranked n-gram places of every value of ``lang``.

    Learned from at most about ``most_rows`` documents of each language, chosen by a hash of the
    id, none of them NULL in id, lang or text or held out; a repeated id counts once, with a text
    chosen by its hash. Tasks add up the counts of their own texts; what meets by language is one
    row of counts for each task.
    """
    frame = set_aside(docs)
    lang = F.col(f"rest.c{docs.columns.index('lang')}").cast("string").alias("lang")
    known = frame.select("doc_id", "text", lang).where(
        F.col("lang").isNotNull()
        & (F.octet_length("lang") <= settings.longest_name)
        & F.col("text").isNotNull()
        & (remainder(F.col("doc_id"), FOLDS) != HELD_OUT)
    )
    sizes = known.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(settings.most_languages)
    share = F.least(F.lit(1.0), F.lit(float(settings.most_rows)) / F.col("count"))
    draw = F.pmod(F.xxhash64("doc_id", F.lit(settings.seed)), F.lit(1 << 20)) / float(1 << 20)
    drawn = known.join(F.broadcast(cut_lineage(sizes)), "lang").where(draw < share)
    one = F.min_by("text", F.struct(F.xxhash64("text"), F.xxhash64(F.lit(settings.seed), "text")))
    sample = drawn.groupBy("doc_id", "lang").agg(one.alias("text")).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}

        def given() -> pa.RecordBatch:
            rows = [pa.array(list(sums), pa.string()), pa.array([c.tobytes() for c in sums.values()], pa.binary())]
            return pa.RecordBatch.from_arrays(rows, ["lang", "counts"])

        for batch, texts in text_batches(batches, "text"):
            grams = NGrams(texts, settings)
            for i, name in enumerate(batch.column("lang").to_pylist()):
                own = sums.setdefault(name, np.zeros(settings.places, np.int64))
                own += grams.counts(i)
            if len(sums) > 100:
                yield given()
                sums.clear()
        yield given()

    def rank(key: tuple[pa.Scalar], rows: pa.Table) -> pa.Table:
        counts = np.zeros(settings.places, np.int64)
        for part in rows.column("counts"):
            counts += np.frombuffer(part.as_buffer(), np.int64)
        best = ranked(counts, settings.ranks).tolist()
        return pa.table({"lang": [key[0].as_py()], "places": pa.array([best], pa.list_(pa.int32()))})

    counted = sample.mapInArrow(count, "lang string, counts binary")
    found = counted.groupBy("lang").applyInArrow(rank, "lang string, places array<int>").toArrow()
    return dict(sorted(zip(found.column("lang").to_pylist(), found.column("places").to_pylist())))


class Profiles:
    """Ranks by place, one row per language; an absent n-gram is as far away as can be.

    Only the ranked places travel to the tasks.
    """

    def __init__(self, profiles: dict[str, list[int]], settings: LanguageSettings):
        self.settings = settings
        self.names = sorted(profiles)
        self.places = [np.array(profiles[name], np.int32) for name in self.names]
        self._fill()

    def _fill(self) -> None:
        self.ranks = np.full((len(self.names), self.settings.places), -1, np.int32)
        for row, places in enumerate(self.places):
            self.ranks[row, places] = np.arange(len(places))

    def __getstate__(self) -> dict:
        return {name: value for name, value in vars(self).items() if name != "ranks"}

    def __setstate__(self, state: dict) -> None:
        vars(self).update(state)
        self._fill()

    def nearest(self, counts: np.ndarray) -> tuple[str, float]:
        """The language of the least out-of-place distance, the first by name among equals.

        The score is the second distance's share in the two least, from 0.5 to 1; with a single
        language it is how far the distance is below the greatest possible.
        """
        own = ranked(counts, self.settings.ranks)
        if not len(own) or not self.names:
            return UNKNOWN, 0.0
        theirs = self.ranks[:, own]
        apart = np.abs(theirs - np.arange(len(own)))
        distance = np.where(theirs < 0, self.settings.ranks, apart).sum(axis=1)
        order = np.argsort(distance, kind="stable")
        best = float(distance[order[0]])
        if len(order) == 1:
            return self.names[0], 1 - best / (self.settings.ranks * len(own))
        second = float(distance[order[1]])
        return self.names[order[0]], second / (best + second) if second else 0.5


def identify_language(docs: DataFrame, settings: LanguageSettings = LanguageSettings()) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, lang_pred, score.

    ``docs`` has the columns doc_id, text and lang; predictions depend on the text alone. held_out
    tells the documents that nothing was learned from (crc32 of the id as text, modulo 4, is 2;
    false for a NULL id). Texts that are NULL or have no letter, and all texts if no language was
    learned, are ``und`` with score 0. Empty tables give no rows; other columns are ignored.
    """
    frame = set_aside(docs).select("doc_id", "text")
    shared = Shared(docs.sparkSession, Profiles(language_profiles(docs, settings), settings))
    kind = frame.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        profiles = shared.load()
        for batch, texts in text_batches(batches, "text"):
            grams = NGrams(texts, settings)
            found = []
            for i in range(len(texts)):
                text = texts.data[texts.bounds[i] : texts.bounds[i + 1]].tobytes()
                found.append(profiles.nearest(grams.counts(i)) if has_letter(text) else (UNKNOWN, 0.0))
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id"),
                    "lang_pred": pa.array([f[0] for f in found], pa.string()),
                    "score": pa.array([f[1] for f in found], pa.float64()),
                }
            )

    held_out = F.coalesce(remainder(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False))
    return frame.mapInArrow(run, f"doc_id {kind}, lang_pred string, score double").select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score"
    )
