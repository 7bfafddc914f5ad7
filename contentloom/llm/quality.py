"""Document quality by a factorisation machine over hashed words, structure and metadata.

Every feature has a weight and a short vector; two features of one document interact by the dot
product of their vectors. All interactions together cost one pass over the features, because
sum over pairs of <v_i, v_j> x_i x_j = (|sum v_i x_i|^2 - sum |v_i x_i|^2) / 2.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LETTERED, Shared, Texts, Words, remainder, set_aside, text_batches
from .learning import FOLDS, Adagrad, batches_of, binary_lists, calibrated, gathered, labelled_sample, sigmoid


@dataclass(frozen=True)
class QualitySettings:
    """``most_rows`` and ``most_bytes`` of text bound what is learned from (all texts are scored).

    ``buckets`` hash places for words, ``levels`` places for each structure statistic, ``dims``
    numbers in a feature's vector, ``passing`` the score from which a document is predicted good.
    """

    most_rows: int = 6000
    most_bytes: int = 24 << 20
    buckets: int = 1 << 16
    levels: int = 24
    dims: int = 6
    lessons: int = 60_000
    batch: int = 64
    rate: float = 0.1
    decay: float = 2e-4
    tested: float = 0.25
    passing: float = 0.3
    seed: int = 23

    @property
    def features(self) -> int:
        return self.buckets + self.levels * (len(STATISTICS) + 1)


def _bytes_in(characters: bytes) -> np.ndarray:
    return np.isin(np.arange(256), list(characters))


#: Shares of a text's bytes, counted by table, and shares of its words or lines.
BYTE_CLASSES = {
    "upper": _bytes_in(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    "lower": _bytes_in(b"abcdefghijklmnopqrstuvwxyz"),
    "digit": _bytes_in(b"0123456789"),
    "blank": _bytes_in(b" \t\n\x0b\x0c\r"),
    "stop": _bytes_in(b".,;:"),
    "loud": _bytes_in(b"!?"),
    "symbol": _bytes_in(b"#*$%&|<>=+~^@_/\\{}[]"),
    "high": np.arange(256) >= 128,
}
STATISTICS = (*BYTE_CLASSES, "distinct", "commonest", "word_length", "line_words", "log_words")


def _counted(inside: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """How many places of each text are set."""
    return np.diff(np.r_[0, np.cumsum(inside, dtype=np.int64)][bounds])


class Features:
    """Sparse features of a batch: those of text i are places[first[i]:first[i + 1]] with values."""

    def __init__(self, texts: Texts, lengths: np.ndarray, settings: QualitySettings):
        s, n = settings, len(texts)
        words = Words(texts, LETTERED)
        sizes = np.diff(words.first)
        owner = np.repeat(np.arange(n, dtype=np.int64), sizes)
        shift = np.uint64(64 - (s.buckets.bit_length() - 1))
        place = (words.hashes >> shift).astype(np.int64)
        pairs, counts = np.unique(owner * s.buckets + place, return_counts=True)
        owner, place = pairs // s.buckets, pairs % s.buckets
        distinct = np.bincount(owner, minlength=n)
        commonest = np.zeros(n)
        np.maximum.at(commonest, owner, counts)

        long = np.maximum(np.diff(texts.bounds), 1)
        shares = [_counted(kind[texts.data], texts.bounds) / long for kind in BYTE_CLASSES.values()]
        some = np.maximum(sizes, 1)
        lines = _counted(texts.data == 10, texts.bounds) + 1
        letters = np.diff(np.r_[0, np.cumsum(words.ends - words.starts)][words.first])
        shares += [
            distinct / some,
            commonest / some,
            np.minimum(letters / some / 16, 1),
            np.minimum(np.log1p(sizes / lines) / 8, 1),
            np.minimum(np.log1p(sizes) / 16, 1),
        ]
        # Square roots spread small shares over more levels; metadata is the given length.
        levels = [np.minimum((np.sqrt(x) * s.levels).astype(np.int64), s.levels - 1) for x in shares]
        known = np.where(lengths < 0, 0, np.minimum(1 + np.log1p(np.maximum(lengths, 0)), s.levels - 1))
        levels.append(known.astype(np.int64))
        fixed = np.stack(levels, 1) + s.buckets + s.levels * np.arange(len(levels))

        word_values = 1 / np.sqrt(np.maximum(distinct, 1))
        self.first = np.r_[0, np.cumsum(distinct + fixed.shape[1])]
        self.places = np.empty(self.first[-1], np.int32)
        self.values = np.empty(self.first[-1], np.float32)
        at = self.first[:-1, None] + np.arange(fixed.shape[1])
        self.places[at], self.values[at] = fixed, 0.5
        before = np.cumsum(distinct) - distinct
        at = np.arange(len(place)) - before[owner] + self.first[owner] + fixed.shape[1]
        self.places[at], self.values[at] = place, word_values[owner]


class FactorisationMachine:
    """score = bias + sum of weights + all pairwise interactions."""

    def __init__(self, settings: QualitySettings):
        self.settings = settings
        self.curve = (1.0, 0.0)
        self._start()

    def _start(self) -> None:
        s = self.settings
        random = np.random.Generator(np.random.PCG64(s.seed))
        self.bias = np.zeros((), np.float32)
        self.weights = np.zeros(s.features, np.float32)
        self.vectors = random.normal(0, 0.02, (s.features, s.dims)).astype(np.float32)

    def sums(self, places, values, first) -> tuple[np.ndarray, np.ndarray]:
        """Raw scores of the texts, and each text's sum of its features' vectors.

        Every text has its structure features, so no segment is empty.
        """
        scaled = self.vectors[places] * values[:, None]
        total = np.add.reduceat(scaled, first[:-1], axis=0)
        squares = np.add.reduceat((scaled * scaled).sum(axis=1), first[:-1])
        linear = np.add.reduceat(self.weights[places] * values, first[:-1])
        return self.bias + linear + 0.5 * ((total * total).sum(axis=1) - squares), total

    def scores(self, features: Features) -> np.ndarray:
        if len(features.first) < 2:
            return np.empty(0)
        raw, _ = self.sums(features.places, features.values, features.first)
        return sigmoid(self.curve[0] * raw.astype(np.float64) + self.curve[1])

    def fit(self, docs: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray) -> None:
        s = self.settings
        self._start()
        random = np.random.Generator(np.random.PCG64(s.seed + 1))
        steps = [Adagrad(x.shape, s.rate) for x in (self.weights, self.vectors)]
        seen = 1e-6
        for _ in range(min(40, max(5, s.lessons // len(docs)))):
            for chosen in batches_of(random.permutation(len(docs)), s.batch):
                places = np.concatenate([docs[i][0] for i in chosen])
                values = np.concatenate([docs[i][1] for i in chosen])
                sizes = np.array([len(docs[i][0]) for i in chosen])
                first = np.r_[0, np.cumsum(sizes)]
                raw, total = self.sums(places, values, first)
                error = ((sigmoid(raw) - labels[chosen]) / len(chosen)).astype(np.float32)
                each = np.repeat(error, sizes) * values
                pull = np.repeat(total, sizes, axis=0) - self.vectors[places] * values[:, None]
                rows, back = np.unique(places, return_inverse=True)
                on_weights = np.bincount(back, each, len(rows)).astype(np.float32)
                on_vectors = np.stack(
                    [np.bincount(back, each * pull[:, d], len(rows)) for d in range(s.dims)], 1
                ).astype(np.float32)
                steps[0].step(self.weights, on_weights + s.decay * self.weights[rows], rows)
                steps[1].step(self.vectors, on_vectors + s.decay * self.vectors[rows], rows)
                seen += float(error.sum()) ** 2
                self.bias -= np.float32(s.rate * error.sum() / np.sqrt(seen))


def _described(docs: DataFrame) -> DataFrame:
    """``common.set_aside`` and the metadata: n_chars, -1 where it is absent, NULL or negative."""
    frame = set_aside(docs)
    if "n_chars" not in docs.columns:
        return frame.withColumn("chars", F.lit(-1).cast("bigint"))
    given = F.col(f"rest.c{docs.columns.index('n_chars')}").try_cast("bigint")
    return frame.withColumn("chars", F.greatest(F.coalesce(given, F.lit(-1)), F.lit(-1)))


def fit_quality(
    docs: DataFrame, labels: DataFrame, settings: QualitySettings = QualitySettings()
) -> FactorisationMachine:
    """Learns from a bounded sample of the labelled documents.

    A part of the sample, ``tested``, is kept from the machine; the score's curve is fitted on it.
    """
    frame = _described(docs)
    sample = labelled_sample(
        frame.select("doc_id", "text", "chars"), labels, "quality", settings.most_rows, settings.most_bytes, settings.seed
    )
    kind = frame.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_batches(batches, "text"):
            found = Features(texts, np.asarray(batch.column("chars")), settings)
            bounds = list(zip(found.first[:-1], found.first[1:]))
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id"),
                    "label": batch.column("label"),
                    "places": binary_lists([found.places[a:b] for a, b in bounds]),
                    "values": binary_lists([found.values[a:b] for a, b in bounds]),
                }
            )

    found = sample.select("doc_id", "text", "chars", "label").mapInArrow(
        run, f"doc_id {kind}, label int, places binary, values binary"
    )
    places, values, label = gathered(found, "places", "values", "label")
    rows = [(np.frombuffer(p, np.int32), np.frombuffer(v, np.float32)) for p, v in zip(places, values)]
    label = np.array(label, np.int64)
    model = FactorisationMachine(settings)
    if len(set(label.tolist())) < 2:
        return model
    tested = np.random.Generator(np.random.PCG64(settings.seed + 2)).random(len(rows)) < settings.tested
    if len(set(label[~tested].tolist())) < 2 or not tested.any():
        tested[:] = False
    model.fit([r for r, t in zip(rows, tested) if not t], label[~tested])
    check = np.flatnonzero(tested) if tested.any() else np.arange(len(rows))
    raw = np.array([model.sums(*rows[i], np.array([0, len(rows[i][0])]))[0][0] for i in check], float)
    model.curve = calibrated(raw, label[check], np.ones(len(check)))
    return model


def score_quality(docs: DataFrame, model: FactorisationMachine) -> DataFrame:
    """(doc_id, text, rest, score) for every row; ``rest`` as in ``common.set_aside``.

    Scores depend on the text and on n_chars alone. NULL texts count as empty ones.
    """
    frame = _described(docs)
    shared = Shared(docs.sparkSession, model)
    settings = model.settings

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = shared.load()
        for batch, texts in text_batches(batches, "text"):
            scores = machine.scores(Features(texts, np.asarray(batch.column("chars")), settings))
            columns = {c: batch.column(c) for c in ("doc_id", "text", "rest")}
            yield pa.RecordBatch.from_pydict(columns | {"score": pa.array(scores, pa.float64())})

    fields = [f"{f.name} {f.dataType.simpleString()}" for f in frame.drop("chars").schema]
    return frame.mapInArrow(run, ", ".join([*fields, "score double"]))


def quality(docs: DataFrame, labels: DataFrame, settings: QualitySettings = QualitySettings()) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted.

    held_out tells the documents that nothing was learned from (crc32 of the id as text, modulo 5,
    is 0; false for a NULL id). predicted is 1 from a score of ``passing``. Without labels of both
    kinds the untrained machine scores. Empty tables give no rows; other columns than text and
    n_chars are ignored.
    """
    scored = score_quality(docs, fit_quality(docs, labels, settings))
    return scored.select(
        "doc_id",
        F.coalesce(remainder(F.col("doc_id"), FOLDS) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= settings.passing).cast("int").alias("predicted"),
    )
