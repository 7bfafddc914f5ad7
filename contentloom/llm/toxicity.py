"""Toxic documents, found by a convolutional text classifier over hashed words.

A word's embedding is the sum of the hashed embeddings of the word and of its first bytes, so
inflected forms of one stem look alike. Filters of several widths slide over the words; each
filter's largest response in the document is one input of a logistic layer.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LETTERED, Shared, Texts, Words, remainder, restored, set_aside, text_batches
from .learning import FOLDS, Adagrad, batches_of, binary_lists, calibrated, gathered, labelled_sample, sigmoid


@dataclass(frozen=True)
class ToxicitySettings:
    """``most_rows`` and ``most_bytes`` of text bound what is learned from (all texts are scored).

    ``buckets`` hash places for words and for their beginnings of ``stems`` bytes, ``dims``
    numbers each; ``filters`` of every width in ``widths``. ``lessons``: documents shown to the
    network, over 6 to 60 rounds. ``tested``: part of the sample that is kept from it, for the curve
    and the thresholds.
    """

    most_rows: int = 8000
    most_bytes: int = 24 << 20
    buckets: int = 1 << 16
    dims: int = 8
    widths: tuple[int, ...] = (1, 2, 3)
    filters: int = 8
    stems: tuple[int, ...] = (4, 5, 6)
    lessons: int = 36_000
    batch: int = 32
    rate: float = 0.1
    decay: float = 1e-4
    tested: float = 0.25
    seed: int = 17


def word_codes(texts: Texts, settings: ToxicitySettings) -> tuple[np.ndarray, np.ndarray]:
    """Hash places per word (rows) of the word and its beginnings, and the bounds of each text."""
    words = Words(texts, LETTERED)
    shift = np.uint64(64 - (settings.buckets.bit_length() - 1))
    kinds = [words.hashes] + [words.beginnings(n) for n in settings.stems]
    salts = np.arange(len(kinds), dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    codes = [((h ^ s) * np.uint64(0x9E3779B97F4A7C15)) >> shift for h, s in zip(kinds, salts)]
    return np.stack(codes, 1).astype(np.int32), words.first


class Sample:
    """Coded texts of a sample: places of their words in the table of the batch they came in."""

    def __init__(self, tables: list[np.ndarray], places: list[np.ndarray]):
        self.tables, self.places = tables, places

    def __len__(self) -> int:
        return len(self.places)

    def __getitem__(self, i: int) -> np.ndarray:
        return self.tables[i][self.places[i]]

    def some(self, chosen: np.ndarray) -> Sample:
        at = np.flatnonzero(chosen).tolist()
        return Sample([self.tables[i] for i in at], [self.places[i] for i in at])


class Convolution:
    """The network: embeddings, filters by width, and the logistic layer."""

    def __init__(self, settings: ToxicitySettings):
        self.settings = settings
        self.curve = (1.0, 0.0)
        self.thresholds: dict[str, float] = {}
        self.default = 0.5
        self._start()

    def _start(self) -> None:
        s = self.settings
        random = np.random.Generator(np.random.PCG64(s.seed))
        self.table = random.normal(0, 0.05, (s.buckets, s.dims)).astype(np.float32)
        self.kernels = [
            random.normal(0, 0.3, (w, s.dims, s.filters)).astype(np.float32) for w in s.widths
        ]
        self.shift = np.zeros(len(s.widths) * s.filters, np.float32)
        self.weights = np.full(len(self.shift), 0.2, np.float32)
        self.bias = np.float32(-1.0)

    def responses(self, codes: np.ndarray) -> np.ndarray:
        """The response of each filter where its window begins; beyond the last word is nothing."""
        embedded = self.table[codes[:, 0]]
        for k in range(1, codes.shape[1]):
            embedded = embedded + self.table[codes[:, k]]
        return self._slide(embedded)

    def _slide(self, embedded: np.ndarray) -> np.ndarray:
        out = []
        for kernel in self.kernels:
            sums = embedded @ kernel[0]
            for j in range(1, len(kernel)):
                sums[:-j] += embedded[j:] @ kernel[j]
            out.append(sums)
        return np.concatenate(out, 1)

    def pooled(self, codes: np.ndarray, first: np.ndarray) -> np.ndarray:
        """The largest response of each filter in each text, 0 at least; no word gives 0.

        Texts are laid out with the widest filter's overhang of empty words between them, and
        worked through in blocks, so memory does not depend on a text's length.
        """
        s = self.settings
        out = np.zeros((len(first) - 1, len(self.shift)), np.float32)
        overhang, block = max(s.widths) - 1, 1 << 15
        a = 0
        while a < len(out):
            b = a + 1
            while b < len(out) and first[b + 1] - first[a] <= block:
                b += 1
            sizes = np.diff(first[a : b + 1])
            if b == a + 1 and sizes[0] > block:
                for low in range(int(first[a]), int(first[b]), block):
                    high = min(int(first[b]), low + block)
                    ahead = self.responses(codes[low : min(int(first[b]), high + overhang)])
                    np.maximum(out[a], ahead[: high - low].max(axis=0), out=out[a])
            elif sizes.any():
                starts = np.cumsum(sizes + overhang) - (sizes + overhang)
                inside = np.ones(int((sizes + overhang).sum()), bool)
                for j in range(overhang):
                    inside[starts + sizes + j] = False
                embedded = np.zeros((len(inside), s.dims), np.float32)
                part = codes[first[a] : first[b]]
                embedded[inside] = sum(self.table[part[:, k]] for k in range(part.shape[1]))
                found = self._slide(embedded)
                found[~inside] = -np.inf
                out[a:b] = np.maximum(np.maximum.reduceat(found, starts, axis=0), -1e3)
                out[a:b][sizes == 0] = 0
            a = b
        full = np.diff(first) > 0
        return np.where(full[:, None], np.maximum(out + self.shift, 0), 0)

    def raw(self, codes: np.ndarray, first: np.ndarray) -> np.ndarray:
        return self.pooled(codes, first) @ self.weights + self.bias

    def scores(self, codes: np.ndarray, first: np.ndarray) -> np.ndarray:
        return sigmoid(self.curve[0] * self.raw(codes, first).astype(np.float64) + self.curve[1])

    # --- training

    def fit(self, docs: Sample, labels: np.ndarray) -> None:
        """Learns from the start; the curve and the thresholds stay."""
        s = self.settings
        self._start()
        random = np.random.Generator(np.random.PCG64(s.seed + 1))
        table = Adagrad(self.table.shape, s.rate)
        kernels = [Adagrad(k.shape, s.rate) for k in self.kernels]
        tops = [Adagrad(x.shape, s.rate) for x in (self.shift, self.weights, self.bias)]
        for _ in range(min(60, max(6, s.lessons // max(1, len(docs))))):
            for chosen in batches_of(random.permutation(len(docs)), s.batch):
                self._step([docs[i] for i in chosen], labels[chosen], table, kernels, tops)

    def gradients(self, docs: list[np.ndarray], labels: np.ndarray) -> tuple:
        """Of the mean loss of some texts: shift, weights, bias, kernels, and places and moves of the
        embeddings. The texts are laid out with an overhang of empty words; texts without words teach
        nothing."""
        s = self.settings
        kept = [i for i, codes in enumerate(docs) if len(codes)]
        on_kernels = [np.zeros_like(k) for k in self.kernels]
        if not kept:
            nothing = np.zeros(0, np.int64), np.zeros((0, s.dims), np.float32)
            return np.zeros_like(self.shift), np.zeros_like(self.weights), 0.0, on_kernels, *nothing
        pads = max(s.widths) - 1
        sizes = np.array([len(docs[i]) for i in kept])
        starts = np.cumsum(sizes + pads) - (sizes + pads)
        inside = np.ones(int((sizes + pads).sum()), bool)
        for j in range(pads):
            inside[starts + sizes + j] = False
        codes = np.zeros((len(inside), docs[kept[0]].shape[1]), np.int64)
        codes[inside] = np.concatenate([docs[i] for i in kept])
        embedded = np.zeros((len(inside), s.dims), np.float32)
        embedded[inside] = sum(self.table[codes[inside, k]] for k in range(codes.shape[1]))
        found = self._slide(embedded)
        at = np.stack([a + found[a : a + n].argmax(axis=0) for a, n in zip(starts.tolist(), sizes.tolist())])
        every = np.arange(found.shape[1])
        pooled = np.maximum(found[at, every] + self.shift, 0)
        error = (sigmoid(pooled @ self.weights + self.bias) - labels[kept]).astype(np.float32)
        back = np.where(pooled > 0, error[:, None] * self.weights, 0).astype(np.float32)
        places, moves = [], []
        for k, kernel in enumerate(self.kernels):
            of = slice(k * s.filters, (k + 1) * s.filters)
            for j in range(len(kernel)):
                here = at[:, of] + j
                on_kernels[k][j] = np.einsum("bfd,bf->df", embedded[here], back[:, of]) / len(docs)
                real = inside[here] & (back[:, of] != 0)
                places.append(codes[here[real]])
                moves.append((kernel[j].T[None] * back[:, of, None])[real])
        places, moves = np.concatenate(places), np.concatenate(moves) / len(docs)
        spread = np.repeat(moves, places.shape[1], axis=0)
        n = len(docs)
        return back.sum(0) / n, (error[:, None] * pooled).sum(0) / n, float(error.sum()) / n, on_kernels, places.ravel(), spread

    def _step(self, docs, labels, table, kernels, tops) -> None:
        s = self.settings
        on_shift, on_weights, on_bias, on_kernels, places, moves = self.gradients(docs, labels)
        tops[0].step(self.shift, on_shift + s.decay * self.shift)
        tops[1].step(self.weights, on_weights + s.decay * self.weights)
        tops[2].seen += on_bias**2
        self.bias -= np.float32(s.rate * on_bias / np.sqrt(tops[2].seen))
        for step, kernel, gradient in zip(kernels, self.kernels, on_kernels):
            step.step(kernel, gradient + s.decay * kernel)
        if len(places):
            rows, back = np.unique(places, return_inverse=True)
            sums = np.stack([np.bincount(back, moves[:, d], len(rows)) for d in range(s.dims)], 1)
            table.step(self.table, sums.astype(np.float32) + s.decay * self.table[rows], rows)


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, settings: ToxicitySettings = ToxicitySettings()
) -> Convolution:
    """Learns from a bounded sample of the labelled documents; ``docs`` may have a column lang.

    A part of the sample, ``tested``, is kept from the network. On it the score's curve is fitted,
    and each language gets the threshold that keeps most of its documents right, at least 0.5 and
    no further than the score of its last toxic document; languages with fewer than 20 tested
    documents use the threshold of all. Languages set thresholds alone, never scores.
    """
    frame = set_aside(docs)
    if "lang" in docs.columns:
        lang = F.col(f"rest.c{docs.columns.index('lang')}").cast("string")
    else:
        lang = F.lit(None).cast("string")
    sample = labelled_sample(
        frame.select("doc_id", "text", lang.alias("lang")), labels, "toxic", settings.most_rows, settings.most_bytes, settings.seed
    )
    kind = frame.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId() << 32
        for number, (batch, texts) in enumerate(text_batches(batches, "text")):
            codes, first = word_codes(texts, settings)
            table, places = np.unique(codes, axis=0, return_inverse=True)
            places = places.astype(np.int32).ravel()
            rows = [places[a:b] for a, b in zip(first[:-1], first[1:])]
            # The batch's different words go with its first row.
            tables = [table.tobytes()] + [b""] * (len(rows) - 1)
            columns = {c: batch.column(c) for c in ("doc_id", "label", "lang")}
            columns["part"] = pa.array([part | number] * len(rows), pa.int64())
            yield pa.RecordBatch.from_pydict(
                columns | {"places": binary_lists(rows), "codes": pa.array(tables, pa.binary())}
            )

    found = sample.select("doc_id", "text", "label", "lang").mapInArrow(
        run, f"doc_id {kind}, label int, lang string, part long, places binary, codes binary"
    )
    places, codes, part, label, lang = gathered(found, "places", "codes", "part", "label", "lang")
    width = 1 + len(settings.stems)
    tables = {p: np.frombuffer(c, np.int32).reshape(-1, width) for p, c in zip(part, codes) if c}
    rows = Sample(
        [tables.get(p, np.empty((0, width), np.int32)) for p in part], [np.frombuffer(x, np.int32) for x in places]
    )
    label = np.array(label, np.int64)
    model = Convolution(settings)
    if len(set(label.tolist())) < 2:
        return model
    random = np.random.Generator(np.random.PCG64(settings.seed + 2))
    tested = random.random(len(rows)) < settings.tested
    if len(set(label[~tested].tolist())) < 2 or not tested.any():
        tested[:] = False
    model.fit(rows.some(~tested), label[~tested])
    check = np.flatnonzero(tested) if tested.any() else np.arange(len(rows))
    raw = np.array([model.raw(rows[i], np.array([0, len(rows[i])]))[0] for i in check], np.float64)
    model.curve = calibrated(raw, label[check], np.ones(len(check)))
    scores = sigmoid(model.curve[0] * raw + model.curve[1])
    model.default = best_threshold(scores, label[check])
    names = np.array([lang[i] or "" for i in check])
    for name in set(names.tolist()) - {""}:
        own = names == name
        if own.sum() >= 20 and len(set(label[check][own].tolist())) == 2:
            model.thresholds[name] = best_threshold(scores[own], label[check][own])
    return model


def best_threshold(scores: np.ndarray, labels: np.ndarray) -> float:
    """The cut from 0.5 up with the fewest mistakes; of equal ones the lowest."""
    cuts = np.unique(np.r_[0.5, scores[(labels == 1) & (scores >= 0.5)]])
    wrong = [((scores >= c) != (labels == 1)).sum() for c in cuts]
    return float(cuts[int(np.argmin(wrong))])


def score_toxicity(docs: DataFrame, model: Convolution) -> DataFrame:
    """(doc_id, text, rest, score) for every row; ``rest`` as in ``common.set_aside``.

    Scores depend on the text alone. NULL and empty texts get the score of a text without words.
    """
    frame = set_aside(docs)
    shared = Shared(docs.sparkSession, model)
    settings = model.settings

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network = shared.load()
        for batch, texts in text_batches(batches, "text"):
            scores = network.scores(*word_codes(texts, settings))
            columns = {c: batch.column(c) for c in ("doc_id", "text", "rest")}
            yield pa.RecordBatch.from_pydict(columns | {"score": pa.array(scores, pa.float64())})

    fields = [f"{f.name} {f.dataType.simpleString()}" for f in frame.schema]
    return frame.mapInArrow(run, ", ".join([*fields, "score double"]))


def toxicity(docs: DataFrame, labels: DataFrame, settings: ToxicitySettings = ToxicitySettings()) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted.

    held_out tells the documents that nothing was learned from (crc32 of the id as text, modulo 5,
    is 0; false for a NULL id). predicted is 1 from a score of 0.5. Without labels of both kinds
    the untrained network scores. Empty tables give no rows; other columns are ignored.
    """
    scored = score_toxicity(docs, fit_toxicity(docs, labels, settings))
    return scored.select(
        "doc_id",
        F.coalesce(remainder(F.col("doc_id"), FOLDS) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def without_toxic(docs: DataFrame, labels: DataFrame, settings: ToxicitySettings = ToxicitySettings()) -> DataFrame:
    """The rows of ``docs`` below their language's threshold, all columns as they were."""
    model = fit_toxicity(docs, labels, settings)
    scored = score_toxicity(docs, model)
    limit = F.lit(model.default)
    if "lang" in docs.columns:
        name = F.col(f"rest.c{docs.columns.index('lang')}")
        for lang, cut in sorted(model.thresholds.items()):
            limit = F.when(name == lang, F.lit(cut)).otherwise(limit)
    return restored(scored.where(F.col("score") < limit), docs.columns)
