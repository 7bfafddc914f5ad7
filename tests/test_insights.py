"""Topics, insights, serving."""

import datetime as dt
import math
import random
from collections import Counter

import pytest
from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import functions as F

from contentloom.catalog import ENGLISH_STOP_WORDS
from contentloom.operators import frequent, insights, serving, topics
from contentloom.schemas import schema

AS_OF = "2024-01-30"
AT = "2024-01-30 12:00:00"

TEXTS = {
    "news_1": "cat dog cat  bird",
    "news_2": "dog cat fish",
    "academic_1": "the fish and the bird fish",
    "academic_2": "",
    "social_media_1": None,
    "news_3": "unique",
}


def corpus_frame(spark, texts=TEXTS):
    return spark.createDataFrame(list(texts.items()), "unified_id string, content string")


def test_stop_words_are_sparks(spark):
    assert list(ENGLISH_STOP_WORDS) == StopWordsRemover.loadDefaultStopWords("english")


def test_corpus_words(spark):
    words = {r.unified_id: r.words for r in topics.corpus_words(corpus_frame(spark)).collect()}
    assert "social_media_1" not in words
    assert words["academic_1"] == ["fish", "bird", "fish"] and words["academic_2"] == []
    keep = topics.TopicSettings(keep_empty_words=True)
    kept = {r.unified_id: r.words for r in topics.corpus_words(corpus_frame(spark), keep).collect()}
    assert kept["news_1"] == ["cat", "dog", "cat", "", "bird"]


def test_term_counts_match_a_plain_count(spark):
    corpus = topics.corpus_words(corpus_frame(spark))
    lists = [r.words for r in corpus.collect()]
    total = Counter(w for ws in lists for w in ws)
    documents = Counter(w for ws in lists for w in set(ws))
    found = {r.term: (r.term_count, r.document_count) for r in topics.term_counts(corpus).collect()}
    assert found == {w: (total[w], documents[w]) for w in total}


def test_vocabulary_order_and_cut(spark):
    corpus = topics.corpus_words(corpus_frame(spark))
    assert [r.term for r in topics.vocabulary(corpus).collect()] == ["cat", "fish", "bird", "dog"]
    two = topics.TopicSettings(vocabulary_size=2, min_documents=1)
    assert [r.term for r in topics.vocabulary(corpus, two).collect()] == ["cat", "fish"]


def many_documents(spark, copies=40):
    texts = {
        f"news_{i}": f"alpha beta gamma {chr(97 + i % 5) * 3} {chr(104 + i % 7) * 3}"
        for i in range(copies)
    }
    return corpus_frame(spark, texts)


def test_topics_are_reproducible(spark):
    settings = topics.TopicSettings(topics=3, iterations=4, partitions=3)
    df = many_documents(spark)
    runs = [
        topics.discover_topics(df.repartition(p), settings).orderBy("topic").collect()
        for p in (1, 5)
    ]
    assert [(r.topic, r.terms) for r in runs[0]] == [(r.topic, r.terms) for r in runs[1]]
    for one, other in zip(*runs):
        assert one.weights == pytest.approx(other.weights, rel=1e-9)
    assert [r.topic for r in runs[0]] == [0, 1, 2]
    for row in runs[0]:
        assert len(row.terms) == 10 and len(set(row.terms)) == 10
        assert row.weights == sorted(row.weights, reverse=True) and sum(row.weights) <= 1 + 1e-9


def test_no_vocabulary_no_topics(spark):
    df = corpus_frame(spark, {"news_1": "one", "news_2": "two"})
    found = insights.topic_insights(topics.discover_topics(df), AT)
    assert found.count() == 0


def test_topic_insight_texts(spark):
    df = spark.createDataFrame(
        [(0, [f"w{i}" for i in range(12)], [0.5, 0.25, 0.125, 0.0625, 0.03125, 0.01]), (1, ["x"], [0.5])],
        "topic int, terms array<string>, weights array<double>",
    )
    rows = insights.topic_insights(df, AT).orderBy("title").collect()
    assert rows[0].title == "Topic 1: w0, w1, w2"
    assert rows[0].description == "Discovered topic with key terms: " + ", ".join(
        f"w{i}" for i in range(10)
    )
    assert rows[0].score == 0.96875 and rows[0].sources == ["topic modeling"]
    assert rows[1].title == "Topic 2: x" and rows[1].related_content_ids == []


def test_trending_insights(spark):
    df = spark.createDataFrame(
        [("science", 3, 0.125), (None, 2, 0.0), ("empty", 1, None)],
        "category string, count bigint, avg_sentiment double",
    )
    rows = {r.title: r for r in insights.trending_insights(df, AT).collect()}
    assert set(rows) == {"science", "empty"}
    assert rows["science"].description == (
        "This category has 3 recent articles with an average sentiment of 0.12"
    )
    assert rows["empty"].description.endswith("sentiment of 0.00")
    assert rows["science"].sources == ["multiple sources"] and rows["science"].score == 3.0


def positive_frame(spark):
    return spark.createDataFrame(
        [("news_1", "same", "s", 0.9, "u"), ("news_2", "same", "s", 0.8, "u")],
        "unified_id string, title string, source string, sentiment_score double, url string",
    )


def test_positive_insights_and_ids(spark):
    rows = insights.positive_insights(positive_frame(spark), AT).collect()
    assert [r.related_content_ids for r in rows] == [["news_1"], ["news_2"]]
    assert len({r.id for r in rows}) == 2
    again = insights.positive_insights(positive_frame(spark), AT).collect()
    assert [r.id for r in again] == [r.id for r in rows]
    later = insights.positive_insights(positive_frame(spark), "2024-01-30 18:00:00").collect()
    assert {r.id for r in later}.isdisjoint({r.id for r in rows})


def test_insight_columns(spark):
    df = insights.positive_insights(positive_frame(spark), AT)
    assert [(f.name, f.dataType) for f in df.schema.fields] == [
        (f.name, f.dataType) for f in schema("content_insights").fields
    ]


@pytest.fixture
def stored(spark):
    midnight = dt.datetime(2024, 1, 30)
    second, hour = dt.timedelta(seconds=1), dt.timedelta(hours=1)
    rows = [
        (1, "trending_topic", "a", "da", ["x", "y", "z", "w"], None, 0.5, midnight),
        (2, "positive_content", "b", "db", ["x"], None, 0.9, midnight - second),
        (3, "trending_topic", "c", "dc", [], None, 0.5, midnight + hour),
        (4, "trending_topic", "d", "dd", ["x"], None, 7.0, midnight - 25 * hour),
    ]
    return spark.createDataFrame(rows, schema("content_insights"))


def test_serving_windows(stored):
    assert [r.id for r in serving.digest(stored, AS_OF).collect()] == [1, 3]
    assert [r.id for r in serving.briefing(stored, AS_OF).collect()] == [1, 3]
    assert [r.id for r in serving.latest(stored, AS_OF).collect()] == [2, 1, 3]
    assert [r.id for r in serving.trending(stored).collect()] == [3, 1, 4]


def test_serving_limits(spark, stored):
    many = stored.filter("id = 1").crossJoin(spark.range(20).withColumnRenamed("id", "n"))
    many = many.withColumn("id", F.col("n")).drop("n")
    assert serving.digest(many, AS_OF).count() == 10
    assert serving.latest(many, AS_OF).count() == 5
    assert serving.briefing(many, AS_OF).count() == 7
    assert serving.trending(many).count() == 5


def test_messages(stored):
    texts = {r.id: r.message for r in serving.digest_messages(stored, AS_OF).collect()}
    assert texts[1] == (
        "\n*TRENDING_TOPIC*: a\n\nda\n\nSources: x, y, z\nRelevance Score: 0.50\n        "
    )
    assert "Sources: \n" in texts[3]
    latest = serving.latest_messages(stored, AS_OF).collect()
    assert latest[0].message == "\n*POSITIVE_CONTENT*: b\n\ndb\n\nRelevance Score: 0.90\n        "


def test_list_messages(stored):
    text = serving.trending_message(stored, heading="H\n").collect()
    assert [r.message for r in text] == ["H\n• *c*: dc\n\n• *a*: da\n\n• *d*: dd\n\n"]
    nothing = stored.limit(0)
    assert serving.trending_message(nothing).collect()[0].message == serving.TRENDING_EMPTY
    assert serving.briefing_message(nothing, AS_OF).collect()[0].message is None
    briefing = serving.briefing_message(stored, AS_OF, heading="H\n", closing="E").first().message
    assert briefing == "H\n• *a*: da\n\n• *c*: dc\n\nE"


# --- frequent words and the quality of topics ---------------------------------------------------


def zipf_corpus(spark, documents=300, words=60, rare=4000, parts=5, seed=3):
    pick = random.Random(seed)
    rows = []
    for i in range(documents):
        own = [f"w{min(int(pick.paretovariate(1.1)), rare)}" for _ in range(words)] + [f"only{i}"] * 3
        rows.append((f"news_{i}", own))
    return spark.createDataFrame(rows, "unified_id string, words array<string>").repartition(parts)


@pytest.mark.parametrize("counters", [40, 200, 100_000])
@pytest.mark.parametrize("size", [5, 30, 2000])
def test_frequent_vocabulary_is_the_vocabulary(spark, counters, size):
    corpus = zipf_corpus(spark)
    settings = topics.TopicSettings(vocabulary_size=size)
    expected = topics.vocabulary(corpus, settings).collect()
    assert frequent.frequent_vocabulary(corpus, settings, counters).collect() == expected


def test_summaries_bound_every_count(spark):
    corpus = zipf_corpus(spark)
    true = Counter(w for row in corpus.collect() for w in row.words)
    rows = frequent.summaries(corpus, 50).collect()
    kept, error = Counter(), sum(r.error for r in rows)
    for r in rows:
        if r.term is not None:
            kept[r.term] += r.n
    assert len(rows) <= 5 * 51 and 0 < error <= sum(true.values()) / 51
    for word, n in true.items():
        assert kept[word] <= n <= kept[word] + error


def test_all_words_are_counted_only_where_summaries_do_not_decide(spark, monkeypatch):
    corpus = zipf_corpus(spark)
    asked = []
    plain = topics.vocabulary
    monkeypatch.setattr(frequent, "vocabulary", lambda *a: asked.append(1) or plain(*a))
    few = topics.TopicSettings(vocabulary_size=5)
    frequent.frequent_vocabulary(corpus, few, 400)
    assert not asked
    frequent.frequent_vocabulary(corpus, topics.TopicSettings(vocabulary_size=30), 8)
    frequent.frequent_vocabulary(corpus, topics.TopicSettings(vocabulary_size=5000), 100_000)
    assert len(asked) == 2
    empty = corpus.limit(0)
    assert frequent.frequent_vocabulary(empty).count() == 0


def test_ties_at_the_cut_of_a_frequent_vocabulary(spark):
    rows = [(f"d{i}", ["b", "a", "c", "d"]) for i in range(10)] + [("x", ["z"] * 50)]
    corpus = spark.createDataFrame(rows, "unified_id string, words array<string>")
    for size in (1, 2, 3):
        settings = topics.TopicSettings(vocabulary_size=size)
        found = [r.term for r in frequent.frequent_vocabulary(corpus, settings).collect()]
        assert found == ["a", "b", "c"][:size]


def test_coherence_by_plain_counting(spark):
    corpus = zipf_corpus(spark, documents=80, words=8)
    rows = [(0, ["w1", "w2", "w3", "nobody"]), (1, ["w4", "w1"]), (2, ["w7"])]
    found = spark.createDataFrame(rows, "topic int, terms array<string>")
    docs = [set(row.words) for row in corpus.collect()]
    values = {r.topic: (r.pairs, r.coherence) for r in topics.coherence(corpus, found).collect()}
    for topic, terms in rows:
        pairs = [(a, b) for i, a in enumerate(terms) for b in terms[i + 1 :]]
        logs = [
            math.log((sum({a, b} <= d for d in docs) + 1) / max(1, sum(a in d for d in docs))) for a, b in pairs
        ]
        assert values[topic][0] == len(pairs)
        assert values[topic][1] == (pytest.approx(sum(logs) / len(logs)) if logs else None)


@pytest.mark.parametrize("seed", [42, 7])
def test_a_model_foresees_words_better_than_one_topic(spark, seed):
    pick = random.Random(5)
    themes = [[f"t{t}x{i}" for i in range(12)] for t in range(3)]
    rows = []
    for i in range(240):
        theme = themes[i % 3]
        rows.append((f"d{i}", [f"{pick.choice(theme)}" for _ in range(30)]))
    corpus = spark.createDataFrame(rows, "unified_id string, words array<string>")
    learned, held = corpus.filter("unified_id < 'd2'"), corpus.filter("unified_id >= 'd2'")
    settings = topics.TopicSettings(topics=3, seed=seed, partitions=4, sampling=0.5, iterations=30)
    known = topics.vocabulary(learned, settings).collect()
    terms = [r.term for r in known]
    model = topics.fitted_model(learned, terms, settings)
    plain = topics.one_topic_bound(spark.createDataFrame(known), held)
    counts = Counter(w for r in held.collect() for w in r.words)
    total = sum(r.term_count for r in known) + len(known)
    by_hand = -sum(counts[r.term] * math.log((r.term_count + 1) / total) for r in known)
    assert plain == pytest.approx(by_hand / sum(counts[t] for t in terms))
    assert model.logPerplexity(topics.count_vectors(held, terms).select("features")) < plain
    found = topics.name_terms(model.describeTopics(6), terms)
    mixed = spark.createDataFrame([(9, [themes[i % 3][i] for i in range(6)])], "topic int, terms array<string>")
    values = [r.coherence for r in topics.coherence(corpus, found).collect()]
    (low,) = [r.coherence for r in topics.coherence(corpus, mixed).collect()]
    assert max(values) > low
