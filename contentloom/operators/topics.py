"""Topic discovery: vocabulary, count vectors and an online LDA model.

Only the vocabulary (a few times ``vocabulary_size`` words) and the topics pass through the driver.
The corpus itself is stored as words once, counted with a map-side combine, vectorized in place, spread over partitions
whose number follows the rows, and cached, so that the iterations read small vectors instead of
repeating the text work. Placement is a hash and a sort, so a lost partition comes back the same.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml.clustering import LDA, LDAModel
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contentloom.catalog import ENGLISH_STOP_WORDS
from contentloom.functions.text import words
from contentloom.session import scratch_folder
from contentloom.sources.storage import staged

TOPIC_COLUMNS = "topic int, termIndices array<int>, termWeights array<double>"


@dataclass(frozen=True)
class TopicSettings:
    """Size and seed of the model.

    Online LDA looks at a random share ``sampling`` of the rows in each iteration, as MLlib does by
    default. It samples each partition, so equal topics need an equal ``seed`` and an equal number
    of partitions: ``partitions``, or else one for ``rows_per_partition`` rows. Weights may still
    differ in their last digits, since partial sums meet in the order tasks end. ``cleaned`` says
    that the content went through ``clean_text``, as in the unified table.
    """

    vocabulary_size: int = 1000
    min_documents: int = 2
    topics: int = 5
    iterations: int = 10
    terms_per_topic: int = 10
    seed: int = 42
    sampling: float = 0.05
    partitions: int | None = None
    rows_per_partition: int = 100_000
    keep_empty_words: bool = False
    cleaned: bool = False
    stop_words: tuple[str, ...] = ENGLISH_STOP_WORDS


def corpus_words(
    unified: DataFrame, settings: TopicSettings = TopicSettings(), carry: tuple[str, ...] = ()
) -> DataFrame:
    """Words of every row that has content, stop words removed; ``carry`` names columns to keep."""
    kept = F.filter(
        words(F.col("content"), settings.keep_empty_words, settings.cleaned),
        lambda word: ~word.isin(*settings.stop_words),
    )
    return unified.filter(F.col("content").isNotNull()).select("unified_id", *carry, kept.alias("words"))


def one_topic_bound(counts: DataFrame, held_out: DataFrame, smoothing: float = 1.0) -> float:
    """Negative log-likelihood per word of held-out documents if all words came from one topic: the
    smoothed shares of the counted terms (term, term_count), a vocabulary's worth of rows."""
    known = counts.select("term", "term_count")
    own = counted_terms(flagged_terms(held_out)).select("term", F.col("term_count").alias("held"))
    rows = known.join(own, "term", "left").select("term_count", F.coalesce("held", F.lit(0)).alias("held"))
    total = rows.agg(F.sum("term_count").alias("n"), F.count(F.lit(1)).alias("terms")).first()
    share = (F.col("term_count") + smoothing) / ((total["n"] or 0) + smoothing * total["terms"])
    found = rows.agg(F.sum(-F.col("held") * F.log(share)).alias("bound"), F.sum("held").alias("words")).first()
    return found["bound"] / found["words"] if found["words"] else 0.0


def flagged_terms(corpus: DataFrame) -> DataFrame:
    """Every word of every document as ``term``, ``opens_document`` 1 where the document has it first.

    Each document sorts its own words and flags the first of a run of equals, so counts of words and
    of documents are plain sums.
    """
    ordered = corpus.select(F.sort_array("words").alias("ordered"))
    flagged = ordered.select(
        F.explode(
            F.transform(
                "ordered",
                lambda word, i: F.struct(
                    word.alias("term"),
                    F.when(F.get("ordered", i - 1).eqNullSafe(word), 0)
                    .otherwise(1)
                    .alias("opens_document"),
                ),
            )
        ).alias("entry")
    )
    return flagged.select("entry.term", "entry.opens_document")


def counted_terms(flagged: DataFrame) -> DataFrame:
    return flagged.groupBy("term").agg(
        F.count(F.lit(1)).alias("term_count"),
        F.sum("opens_document").alias("document_count"),
    )


def term_counts(corpus: DataFrame) -> DataFrame:
    """Occurrences and number of documents of every word.

    Both counts come from one group-by on the word: partial sums leave the map side and no
    (word, document) pair is shuffled, however frequent a word is.
    """
    return counted_terms(flagged_terms(corpus))


def vocabulary(corpus: DataFrame, settings: TopicSettings = TopicSettings()) -> DataFrame:
    """Most frequent words found in enough documents, ties in alphabetical order."""
    return (
        term_counts(corpus)
        .filter(F.col("document_count") >= settings.min_documents)
        .orderBy(F.desc("term_count"), F.asc("term"))
        .limit(settings.vocabulary_size)
    )


def count_vectors(corpus: DataFrame, terms: list[str]) -> DataFrame:
    model = CountVectorizerModel.from_vocabulary(terms, inputCol="words", outputCol="features")
    return model.transform(corpus)


def fitted_model(
    corpus: DataFrame, terms: list[str], settings: TopicSettings = TopicSettings()
) -> LDAModel:
    """The model of a corpus and its vocabulary. Runs jobs.

    Vectors are placed by key and words, so rows that share a key or have none still spread. They
    are cached for the iterations and leave nothing behind.
    """
    partitions = settings.partitions or max(1, -(-corpus.count() // settings.rows_per_partition))
    place = [F.col("unified_id"), F.col("words_hash")]
    vectors = (
        count_vectors(corpus, terms)
        .select("unified_id", F.xxhash64("words").alias("words_hash"), "features")
        .repartition(partitions, *place)
        .sortWithinPartitions(*place)
        .select("features")
        .persist(StorageLevel.MEMORY_AND_DISK)
    )
    try:
        return LDA(
            k=settings.topics,
            maxIter=settings.iterations,
            optimizer="online",
            subsamplingRate=settings.sampling,
            seed=settings.seed,
            featuresCol="features",
        ).fit(vectors)
    finally:
        vectors.unpersist()


def fit_topics(
    corpus: DataFrame, terms: list[str], settings: TopicSettings = TopicSettings()
) -> DataFrame:
    """Topics as ``topic, termIndices, termWeights``; none without a vocabulary."""
    if not terms:
        return corpus.sparkSession.createDataFrame([], TOPIC_COLUMNS)
    return fitted_model(corpus, terms, settings).describeTopics(settings.terms_per_topic)


def pair_counts(corpus: DataFrame, topics: DataFrame) -> DataFrame:
    """In how many documents each topic's words occur, alone and two at a time.

    ``topics`` has topic and terms, a few rows of a few words, which pass through the driver as the
    vocabulary does. Rows: topic, i, j (places of the words, j not before i; equal for one word),
    documents. One pass over the corpus: a document keeps only the words that some topic has, and
    gives the pairs of each topic that it holds.
    """
    few = [(row.topic, list(row.terms)) for row in topics.select("topic", "terms").collect()]
    known = sorted({term for _, terms in few for term in terms})

    def literal(terms: list[str]) -> Column:
        return F.array(*map(F.lit, terms)).cast("array<string>")

    held = corpus.select(F.array_intersect("words", literal(known)).alias("held")).filter(F.size("held") > 0)

    def places(terms: list[str]) -> Column:
        found = F.transform(literal(terms), lambda t, i: F.when(F.array_contains("held", t), i))
        return F.filter(found, lambda i: i.isNotNull())

    own = [F.struct(F.lit(topic).cast("int").alias("topic"), places(terms).alias("places")) for topic, terms in few]
    form = "array<struct<topic: int, places: array<int>>>"
    listed = held.select(F.explode(F.array(*own).cast(form)).alias("own")).select("own.topic", "own.places")
    first = listed.select("topic", "places", F.explode("places").alias("i"))
    pairs = first.select("topic", "i", F.explode(F.filter("places", lambda j: j >= F.col("i"))).alias("j"))
    return pairs.groupBy("topic", "i", "j").agg(F.count(F.lit(1)).alias("documents"))


def coherence(corpus: DataFrame, topics: DataFrame) -> DataFrame:
    """topic, pairs, coherence: how far documents that hold a word of a topic hold its others too.

    The mean over all pairs of words of ln((documents with both + 1) / documents with the stronger).
    Words that no document holds count as held by one. A topic of one word has no pairs and no value.
    """
    counts = pair_counts(corpus, topics)
    places = topics.select("topic", F.size("terms").alias("n"), F.posexplode("terms").alias("i", "term"))
    pairs = places.select("topic", "n", "i").join(
        places.select("topic", F.col("i").alias("j")), "topic"
    ).filter("j > i")
    alone = counts.filter("i = j").select("topic", "i", F.col("documents").alias("one"))
    both = counts.filter("i < j").select("topic", "i", "j", F.col("documents").alias("two"))
    value = F.log((F.coalesce("two", F.lit(0)) + 1) / F.greatest(F.coalesce("one", F.lit(0)), F.lit(1)))
    scored = pairs.join(alone, ["topic", "i"], "left").join(both, ["topic", "i", "j"], "left")
    found = scored.groupBy("topic").agg(F.count(F.lit(1)).alias("pairs"), F.avg(value).alias("coherence"))
    return topics.select("topic").join(found, "topic", "left").fillna(0, "pairs")


def name_terms(topics: DataFrame, terms: list[str]) -> DataFrame:
    """Replace term indices by words. Words hold no blank, so one literal carries them all."""
    names = F.split(F.lit(" ".join(terms)), " ")
    return topics.select(
        "topic",
        F.transform("termIndices", lambda i: F.element_at(names, i + 1)).alias("terms"),
        F.col("termWeights").alias("weights"),
    )


def topics_of_words(corpus: DataFrame, settings: TopicSettings = TopicSettings()) -> DataFrame:
    """Topics as ``topic, terms, weights`` of documents whose words are stored."""
    from contentloom.operators.frequent import frequent_vocabulary

    terms = [row.term for row in frequent_vocabulary(corpus, settings).collect()]
    return name_terms(fit_topics(corpus, terms, settings), terms)


def discover_topics(
    unified: DataFrame, settings: TopicSettings = TopicSettings(), folder: str | None = None
) -> DataFrame:
    """Topics of all content as ``topic, terms, weights``.

    The words are stored once, in ``folder`` or a scratch folder of the session, and read from there
    for the vocabulary, for the vectors and for their number.
    """
    place = folder or scratch_folder(unified.sparkSession)
    with staged(corpus_words(unified, settings).select("unified_id", "words"), place) as corpus:
        return topics_of_words(corpus, settings)
