"""Classifiers: held-out accuracy, what scores may depend on, and odd rows."""

import pickle
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from contentloom.llm.common import Texts
from contentloom.llm.language import (
    LanguageSettings,
    NGrams,
    Profiles,
    identify_language,
    language_profiles,
    ranked,
)
from contentloom.llm.learning import labelled_sample
from contentloom.llm.quality import FactorisationMachine, QualitySettings, fit_quality, quality, score_quality
from contentloom.llm.toxicity import (
    Convolution,
    ToxicitySettings,
    best_threshold,
    fit_toxicity,
    score_toxicity,
    toxicity,
    without_toxic,
    word_codes,
)


def fold(doc_id, modulus):
    return zlib.crc32(str(doc_id).encode()) % modulus


@pytest.fixture(scope="module")
def labelled(spark):
    """Toxic texts hold one of a few stems, bad ones shout; both labels in all folds."""
    pick = random.Random(2)
    plain = [f"word{n}" for n in range(400)]
    rows, labels = [], []
    for i in range(900):
        toxic, good = int(i % 4 == 0), int(i % 3 != 0)
        words = pick.choices(plain, k=pick.randrange(20, 80))
        if toxic:
            words.insert(pick.randrange(len(words)), pick.choice(["vilestuff", "vilething", "nastyone"]) + str(i % 7))
        text = " ".join(words)
        rows.append((i, text if good else " ".join(w.upper() + "!!" for w in words), "en" if i % 2 else "de", len(text)))
        if i % 5:
            labels.append((i, good, toxic))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, n_chars long").repartition(4)
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def right(found, labels, column):
    known = found.join(labels, "doc_id")
    held = known.where("held_out")
    assert held.count() > 50
    return held.where(F.col("predicted") == F.col(column)).count() / held.count()


def test_toxicity_of_held_out_documents(labelled):
    docs, labels = labelled
    found = toxicity(docs, labels)
    assert right(found, labels, "toxic") > 0.95
    rows = found.collect()
    assert all(r.held_out == (fold(r.doc_id, 5) == 0) and 0 <= r.score <= 1 for r in rows)
    assert all(r.predicted == int(r.score >= 0.5) for r in rows)


def test_quality_of_held_out_documents(labelled):
    docs, labels = labelled
    found = quality(docs, labels)
    assert right(found, labels, "quality") > 0.97
    assert all(r.predicted == int(r.score >= 0.3) for r in found.collect())


@pytest.mark.parametrize("fit, score", [(fit_toxicity, score_toxicity), (fit_quality, score_quality)])
def test_held_out_labels_and_names_change_nothing(labelled, fit, score):
    docs, labels = labelled
    small = {"lessons": 2000, "most_rows": 300}
    settings = ToxicitySettings(**small) if fit is fit_toxicity else QualitySettings(**small)
    flipped = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0).cast("int")
    other = labels.select("doc_id", *[(F.col(c) + flipped).alias(c) for c in ("quality", "toxic")])
    other = other.withColumns({c: F.col(c) % 2 for c in ("quality", "toxic")})

    def scores(docs, labels):
        model = fit(docs, labels, settings)
        return {r.doc_id: r.score for r in score(docs, model).select("doc_id", "score").collect()}

    first = scores(docs, labels)
    assert scores(docs, other) == first
    if fit is fit_quality:
        assert scores(docs.withColumn("lang", F.lit("xx")), labels) == first


def test_models_take_odd_rows(odd_docs, no_docs, no_labels, labelled):
    _, labels = labelled
    for score in (toxicity, quality):
        assert score(odd_docs, labels).count() == odd_docs.count()
        found = score(odd_docs, no_labels).collect()
        assert all(0 <= r.score <= 1 for r in found)
        assert not next(r for r in found if r.doc_id is None).held_out
        assert score(no_docs, labels).count() == 0
    nulls = labels.select(F.lit(None).cast("long").alias("doc_id"), "quality", "toxic").unionByName(
        labels.select("doc_id", F.lit(None).cast("int").alias("quality"), F.lit(7).alias("toxic"))
    )
    assert toxicity(odd_docs, nulls).count() == odd_docs.count()
    assert without_toxic(odd_docs, no_labels).columns == odd_docs.columns


def test_toxic_documents_go(labelled):
    docs, labels = labelled
    left = without_toxic(docs, labels)
    assert left.columns == docs.columns
    toxic = docs.where("doc_id % 4 = 0").count()
    assert abs(docs.count() - toxic - left.count()) <= 0.03 * docs.count()


def test_thresholds():
    scores, labels = np.array([0.2, 0.55, 0.6, 0.9]), np.array([0, 0, 1, 1])
    assert best_threshold(scores, labels) == 0.6
    assert best_threshold(np.array([0.1, 0.7]), np.array([0, 1])) == 0.5


def test_pooling_by_blocks_and_alone():
    settings = ToxicitySettings(buckets=1 << 10)
    model = Convolution(settings)
    pick = random.Random(4)
    texts = ["", "one", "one two", " ".join(f"w{pick.randrange(900)}" for _ in range(70_000)), "a b c d", ""]
    codes, first = word_codes(Texts(pa.array(texts)), settings)
    together = model.pooled(codes, first)
    for i, text in enumerate(texts):
        alone, _ = word_codes(Texts(pa.array([text])), settings)
        expected = np.zeros(together.shape[1], np.float32)
        if len(alone):
            embedded = model.table[alone].sum(axis=1)
            padded = np.r_[embedded, np.zeros((2, settings.dims), np.float32)]
            found = [
                sum(padded[j : j + len(alone)] @ kernel[j] for j in range(len(kernel))).max(axis=0)
                for kernel in model.kernels
            ]
            expected = np.maximum(np.concatenate(found) + model.shift, 0)
        assert np.allclose(together[i], expected, atol=1e-5)


def test_gradients_are_those_of_the_loss():
    settings = ToxicitySettings(buckets=64, dims=3, filters=2, stems=(2,))
    model = Convolution(settings)
    random_ = np.random.default_rng(3)
    model.table = random_.normal(size=model.table.shape)
    model.kernels = [random_.normal(size=k.shape) for k in model.kernels]
    model.shift, model.weights = random_.normal(size=(2, len(model.shift))).astype(float)
    docs = [random_.integers(0, 64, (n, 2)) for n in (5, 1, 0, 9)]
    labels = np.array([1, 0, 1, 0])

    def loss():
        total = 0.0
        for codes, label in zip(docs, labels):
            if len(codes):
                first = np.array([0, len(codes)])
                pooled = np.maximum(model._slide(model.table[codes].sum(axis=1)).max(axis=0) + model.shift, 0)
                p = 1 / (1 + np.exp(-(pooled @ model.weights + model.bias)))
                total -= np.log(p if label else 1 - p)
                assert np.allclose(model.raw(codes, first), pooled @ model.weights + model.bias, atol=1e-3)
        return total / len(docs)

    def slope(values, at):
        old = values[at]
        values[at] = old + 1e-6
        up = loss()
        values[at] = old - 1e-6
        down = loss()
        values[at] = old
        return (up - down) / 2e-6

    on_shift, on_weights, _, on_kernels, places, moves = model.gradients(docs, labels)
    on_table = np.zeros_like(model.table)
    np.add.at(on_table, places, moves)
    for values, gradient in ((model.shift, on_shift), (model.weights, on_weights), (model.table, on_table)):
        for at in [tuple(x) for x in random_.integers(0, values.shape, (40, values.ndim))]:
            assert gradient[at] == pytest.approx(slope(values, at), abs=2e-4)
    for kernel, gradient in zip(model.kernels, on_kernels):
        for at in np.ndindex(kernel.shape):
            assert gradient[at] == pytest.approx(slope(kernel, at), abs=2e-4)


def test_samples_are_bounded_in_rows_and_bytes(spark):
    texts = ["x" * 1000, "y" * 3000, "long " * 2000]
    rows = [(i, texts[i % 3], "en") for i in range(600)] + [(7, "another", "en"), (7, texts[1], "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(600)] * 2, "doc_id long, toxic int")

    def sample(frame, rows, size):
        return labelled_sample(frame, labels, "toxic", rows, size, 3).collect()

    few = sample(docs, 100, 1 << 30)
    assert 60 < len(few) < 140 and len({r.doc_id for r in few}) == len(few)
    small = sample(docs, 10_000, 64_000)
    for label in (0, 1):
        sizes = [len(r.text) for r in small if r.label == label]
        assert 28_000 <= sum(sizes) <= 32_000 and max(sizes) < 2_000
    assert all(fold(r.doc_id, 5) for r in small)
    again = sample(docs.repartition(7).unionByName(docs.limit(50)), 10_000, 1 << 30)
    first = sample(docs, 10_000, 1 << 30)
    assert sorted((r.doc_id, r.label, r.text) for r in again) == sorted((r.doc_id, r.label, r.text) for r in first)


def test_interactions_by_the_identity():
    settings = QualitySettings(buckets=64)
    model = FactorisationMachine(settings)
    random_ = np.random.default_rng(1)
    model.weights = random_.normal(size=settings.features).astype(np.float32)
    model.vectors = random_.normal(size=(settings.features, settings.dims)).astype(np.float32)
    places = random_.integers(0, settings.features, 12)
    values = random_.normal(size=12).astype(np.float32)
    first = np.array([0, 5, 12])
    raw, _ = model.sums(places, values, first)
    for i in range(2):
        at = range(first[i], first[i + 1])
        expected = model.bias + sum(model.weights[places[k]] * values[k] for k in at)
        expected += sum(
            model.vectors[places[j]] @ model.vectors[places[k]] * values[j] * values[k]
            for j in at
            for k in at
            if j < k
        )
        assert raw[i] == pytest.approx(expected, rel=1e-4)


def test_languages_of_held_out_documents(tables):
    docs = tables("documents")
    found = identify_language(docs)
    rows = found.join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert sum(r.lang == r.lang_pred for r in held) / len(held) > 0.95
    assert all(r.held_out == (fold(r.doc_id, 4) == 2) and 0 <= r.score <= 1 for r in rows)
    blind = identify_language(docs.withColumn("lang", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 != 2, F.col("lang"))))
    assert {r.doc_id: r.lang_pred for r in blind.collect()} == {r.doc_id: r.lang_pred for r in rows}


def test_languages_of_odd_rows(spark, tables):
    rows = [(1, None, "en"), (2, "", "en"), (3, "123 ... !?", None), (None, "the cat and the dog", "en"), (4, "İ", "fr")]
    odd = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    both = odd.unionByName(tables("documents").select((F.col("doc_id") + 100).alias("doc_id"), "text", "lang"))
    found = {r.doc_id: r for r in identify_language(both).collect() if r.doc_id is None or r.doc_id < 10}
    assert [found[i].lang_pred for i in (1, 2, 3)] == ["und"] * 3 and found[1].score == 0
    assert found[None].lang_pred == "en" and not found[None].held_out
    assert found[4].lang_pred != "und"
    unknown = identify_language(odd.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r.lang_pred for r in unknown} == {"und"}
    assert identify_language(odd.limit(0)).count() == 0


def test_profiles_are_bounded_and_repeatable(spark):
    pick = random.Random(8)
    rows = [(i, " ".join(pick.choices(["alpha", "beta", "gamma"], k=9)), f"l{i % 40}") for i in range(800)]
    rows += [(i, "delta epsilon zeta", "big") for i in range(1000, 1200)] + [(1, "y " * 50, "x" * 300)] * 500
    rows += [(1003, "another text", "big"), (1003, "third text", "big")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    few = LanguageSettings(most_languages=5)
    found = language_profiles(docs.repartition(5), few)
    assert len(found) == 5 and "big" in found and set(found) <= {"big", *(f"l{i}" for i in range(40))}
    assert language_profiles(docs.coalesce(1).orderBy(F.rand(3)), few) == found
    profiles = Profiles(found, few)
    sent = pickle.dumps(profiles)
    assert len(sent) < 20_000 and (pickle.loads(sent).ranks == profiles.ranks).all()


def test_ranks_and_distances_by_hand():
    settings = LanguageSettings(places=1 << 10, ranks=20)
    texts = ["The cat sat on the mat.", "Der Hund und die Katze", "the mat, the hat"]
    grams = NGrams(Texts(pa.array(texts)), settings)
    counts = [grams.counts(i) for i in range(3)]

    def by_hand(c):
        return sorted(np.flatnonzero(c).tolist(), key=lambda p: (-c[p], p))[:20]

    for i, c in enumerate(counts):
        assert ranked(c, 20).tolist() == by_hand(c)
        words = "".join(ch if ch.isalpha() else " " for ch in texts[i].lower()).split()
        assert c.sum() == sum(len(w) + (len(w) + 1) + len(w) for w in words)
    profiles = Profiles({"en": by_hand(counts[0]), "de": by_hand(counts[1])}, settings)
    own = by_hand(counts[2])

    def distance(profile):
        return sum(abs(profile.index(p) - r) if p in profile else 20 for r, p in enumerate(own))

    en, de = distance(by_hand(counts[0])), distance(by_hand(counts[1]))
    assert profiles.nearest(counts[2]) == ("en", pytest.approx(de / (en + de)))
