"""Registered queries: every operator over the whole test tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from contentloom.functions import dates, rules
from contentloom.functions.text import clean_text, strip, tokenize, truncate
from contentloom.operators import insights, ranking, serving, topics
from contentloom.operators.frequent import frequent_vocabulary
from contentloom.operators.quality import duplicate_keys, reason_counts, with_reason
from contentloom.operators.transform import transform_news, transform_posts, transform_scholarly
from contentloom.operators.unify import unify
from contentloom.plans import driver_tables as given
from contentloom.plans import jobs, refresh
from contentloom.plans.driver_tables import AS_OF, FETCHED_AT
from contentloom.schemas import conform, ensure_column
from contentloom.session import pin_session, scratch_folder
from contentloom.sources import feeds, pages, stories
from contentloom.sources.ledger import Ledger
from contentloom.sources.storage import FolderStore, staged

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
COVERS: dict[str, str] = {}

CLEANED = topics.TopicSettings(cleaned=True)
GENERATED_AT = "2024-01-30 12:00:00"

LIST_PROFILE = pages.PageProfile(
    name="list",
    source="list pages",
    category="links",
    block=("li",),
    link=("a",),
    summary=("p, .summary, .excerpt",),
)
ARTICLE_PROFILE = pages.PageProfile(
    name="article",
    source="article pages",
    category="articles",
    block=(".missing", "body"),
    title=("h4 a", "article > h1"),
    author=(".byline", "footer"),
    summary=("div.ad",),
    posted=(".date", '[class*="date" i]'),
    link_prefix="https://example.org",
    language="xx",
)
FORUM_PROFILE = pages.forum_profile("science")


def query(name: str, covers: str) -> Callable[[Query], Query]:
    """Register a query that runs in a pinned session; ``covers`` lists the operators it shows."""

    def register(function: Query) -> Query:
        @wraps(function)
        def pinned(spark: SparkSession, folder: str) -> DataFrame:
            return function(pin_session(spark), folder)

        QUERIES[name] = pinned
        COVERS[name] = covers
        return pinned

    return register


def _joined(*names: str) -> dict[str, Column]:
    return {name: F.array_join(name, " ") for name in names}


def _clock(name: str) -> Column:
    return F.date_format(name, "yyyy-MM-dd HH:mm:ss").alias(name)


def _unified(spark: SparkSession, folder: str, varied: bool = False) -> DataFrame:
    sentiment = given.varied_score(F.col("id")) if varied else None
    return unify(
        transform_news(given.raw_news(spark, folder), sentiment),
        transform_posts(given.raw_posts(spark, folder), sentiment),
        transform_scholarly(given.raw_scholarly(spark, folder), sentiment),
    ).drop("processed_timestamp")


# --- text functions --------------------------------------------------------------------------


@query("q_clean_text", "X1, D1")
def _clean_text(spark, folder):
    return given.table(spark, folder, "documents").select(
        "doc_id", clean_text(F.col("text")).alias("clean")
    )


@query("q_tokenize", "X2, D2")
def _tokenize(spark, folder):
    tokens = tokenize(F.col("text"))
    return (
        given.table(spark, folder, "conversations")
        .select("conv_id", "turn", tokens.alias("tokens"))
        .select(
            "conv_id",
            "turn",
            F.size("tokens").alias("token_count"),
            F.array_join("tokens", " ").alias("tokens"),
        )
    )


@query("q_truncate", "X3, X16, X17")
def _truncate(spark, folder):
    return given.table(spark, folder, "documents").select(
        "doc_id",
        F.length("text").alias("chars"),
        truncate(strip(F.col("text")), 500).alias("preview"),
        truncate(strip(F.col("text")), 1000).alias("abstract"),
    )


@query("q_rule_category", "X11")
def _rule_category(spark, folder):
    return given.table(spark, folder, "documents").select(
        "doc_id", rules.guess_category(F.col("text")).alias("category")
    )


@query("q_popularity", "X6")
def _popularity(spark, folder):
    return given.raw_posts(spark, folder).select(
        "id", "score", rules.popularity_level(F.col("score")).alias("popularity_level")
    )


@query("q_absolute_url", "X12 to X14")
def _absolute_url(spark, folder):
    link = (
        F.when(F.col("page_id") % 4 == 0, F.col("url"))
        .when(F.col("page_id") % 4 == 1, F.concat(F.lit("/p/"), F.col("page_id").cast("string")))
        .when(F.col("page_id") % 4 == 2, F.concat(F.lit("p?id="), F.col("page_id").cast("string")))
        .otherwise(F.lit(""))
    )
    return given.table(spark, folder, "pages").select(
        "page_id",
        rules.site_link(link, F.col("url")).alias("site_link"),
        rules.prefix_link(link, F.lit("")).alias("bare_link"),
        rules.prefix_link(link, F.lit("https://example.org")).alias("prefixed_link"),
        rules.forum_link(link).alias("forum_link"),
    )


@query("q_score_parse", "X15")
def _score_parse(spark, folder):
    number = F.col("event_id").cast("string")
    kind = F.col("event_id") % 8
    text = (
        F.when(kind == 0, number)
        .when(kind == 1, F.concat(F.lit(" \t"), number, F.lit(" ")))
        .when(kind == 2, F.concat(F.lit("+"), number))
        .when(kind == 3, F.concat(F.lit("-"), number))
        .when(kind == 4, F.lit("•"))
        .when(kind == 5, F.concat(number, F.lit(".5")))
        .when(kind == 6, F.concat(F.lit("99999999999"), number))
        .otherwise(F.lit(""))
    )
    return given.table(spark, folder, "events").select(
        "event_id", rules.parse_score(text).alias("score")
    )


@query("q_dates", "X5, X19 to X21")
def _dates(spark, folder):
    kind = F.col("event_id") % 7
    mail = F.date_format("ts", "EEE, dd MMM yyyy HH:mm:ss")
    text = (
        F.when(kind == 0, F.concat(mail, F.lit(" +0000")))
        .when(kind == 1, F.concat(mail, F.lit(" -0500")))
        .when(kind == 2, F.concat(mail, F.lit(" +02:00")))
        .when(kind == 3, F.concat(mail, F.lit(" Z")))
        .when(kind == 4, F.concat(mail, F.lit(" GMT")))
        .when(kind == 5, F.col("event_type"))
        .otherwise(F.concat(F.date_format("ts", "yyyy-MM-dd"), F.lit(" and so on")))
    )
    fetched = F.lit(FETCHED_AT).cast("timestamp")
    return (
        given.table(spark, folder, "events")
        .select(
            "event_id",
            dates.feed_timestamp(text, fetched).alias("feed_time"),
            F.when(kind != 5, F.coalesce(dates.iso_timestamp(text), dates.any_mail_timestamp(text)))
            .otherwise(fetched)
            .alias("news_time"),
            dates.page_timestamp(text, fetched).alias("page_time"),
            dates.epoch_timestamp(F.unix_timestamp("ts")).alias("epoch_time"),
            F.to_date("ts").alias("day"),
        )
        .select(
            "event_id",
            _clock("feed_time"),
            _clock("news_time"),
            _clock("page_time"),
            _clock("epoch_time"),
            "day",
        )
    )


@query("q_markup_text", "X18")
def _markup_text(spark, folder):
    return given.table(spark, folder, "pages").select(
        "page_id", feeds.markup_to_text(F.col("html")).alias("text")
    )


# --- transforms and the unified table --------------------------------------------------------


@query("q_transform_news", "B1, F1, F2, P1, X3 to X5")
def _transform_news(spark, folder):
    return (
        transform_news(given.raw_news(spark, folder))
        .drop("transformation_date", "extracted_date")
        .withColumns({**_joined("title_tokens", "content_tokens")})
        .withColumn("published_date", F.to_date("published_date"))
    )


@query("q_transform_posts", "B2, F1, P2, X6")
def _transform_posts(spark, folder):
    return (
        transform_posts(given.raw_posts(spark, folder))
        .drop("transformation_date", "extracted_date", "created_utc")
        .withColumns(_joined("title_tokens"))
    )


@query("q_transform_scholarly", "B3, F1, F3, P3, X7")
def _transform_scholarly(spark, folder):
    return (
        transform_scholarly(given.raw_scholarly(spark, folder))
        .drop("transformation_date", "extracted_date", "published_date")
        .withColumns(_joined("title_tokens", "abstract_tokens"))
    )


@query("q_unify", "B4, S2, P4 to P7, P9, U1")
def _unify(spark, folder):
    return _unified(spark, folder)


@query("q_load_stamps", "P8")
def _load_stamps(spark, folder):
    """The load stamps of every transformed and unified row, from an injected clock."""
    clock = F.lit("2024-01-30 18:00:00").cast("timestamp")
    later = F.lit("2024-01-30 19:00:00").cast("timestamp")
    transformed = (
        transform_news(given.raw_news(spark, folder), stamp=clock),
        transform_posts(given.raw_posts(spark, folder), stamp=clock),
        transform_scholarly(given.raw_scholarly(spark, folder), stamp=clock),
    )
    loads = [
        rows.select(F.lit(name).alias("loaded"), F.col("id").cast("bigint").alias("id"), _clock("transformation_date"))
        for name, rows in zip(("news", "social_media", "academic"), transformed)
    ]
    merged = unify(*transformed, stamp=later).select(
        F.concat(F.lit("unified "), "content_type").alias("loaded"),
        F.col("id").cast("bigint").alias("id"),
        _clock("processed_timestamp").alias("transformation_date"),
    )
    every = loads[0].unionByName(loads[1]).unionByName(loads[2]).unionByName(merged)
    return every.withColumnRenamed("transformation_date", "stamp")


@query("q_duplicate_ids", "P7, U1")
def _duplicate_ids(spark, folder):
    """Every row twice, as two runs would store it."""
    rows = _unified(spark, folder)
    return duplicate_keys(rows.unionAll(rows))


@query("q_language_default", "K7, K8")
def _language_default(spark, folder):
    older = given.raw_scholarly(spark, folder).select("id", "title", "authors")
    newer = given.table(spark, folder, "documents").select(
        F.col("doc_id").alias("id"),
        F.col("text").alias("title"),
        F.col("lang").alias("language"),
    )
    return ensure_column(older, "language", F.lit("en")).unionByName(
        newer, allowMissingColumns=True
    )


# --- stored tables ---------------------------------------------------------------------------


def _scratch(spark: SparkSession) -> FolderStore:
    return FolderStore(spark, scratch_folder(spark))


#: The two windows into which rows of the stored tables are dealt.
WINDOWS = (jobs.Batch("2024-01-29", "2024-01-30"), jobs.Batch("2024-01-30", "2024-01-31"))


def _window_of(number: Column) -> Column:
    """A time in one of the windows, by turns."""
    return F.when(number % 3 == 0, F.lit("2024-01-30 06:00:00")).otherwise(F.lit("2024-01-29 06:00:00")).cast(
        "timestamp"
    )


@query("q_repeated_windows", "K5, K9, K10, A4, S9, B7")
def _repeated_windows(spark, folder):
    """Stories of two windows, the first taken twice, after a run that died with its ids reserved."""
    store = _scratch(spark)
    payloads = given.story_payloads(spark, folder).withColumn("fetched_at", _window_of(F.col("story_id")))
    store.append("story_payloads", conform(payloads, "story_payloads"))
    store.create_if_absent("reddit_posts")
    Ledger(store, "reddit_posts").reserve(1000, WINDOWS[0].name("extract_stories"))
    for window in (WINDOWS[0], WINDOWS[0], WINDOWS[1]):
        jobs.run("extract_stories", store, batch=window)
    columns = ("url", "subreddit", "author", "score", F.md5("title").alias("title_md5"))
    return (
        store.read("reddit_posts")
        .groupBy(*columns, _clock("created_utc"))
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.count_distinct("id").alias("ids"),
            (F.min("id") > 1000).alias("beyond_reserved"),
        )
    )


@query("q_window_refresh", "B1 to B4, K1, U1, P7 by windows")
def _window_refresh(spark, folder):
    """The unified table after a full refresh and two by windows, one of them late."""
    store = _scratch(spark)
    raw = {
        "news_articles": given.raw_news(spark, folder),
        "reddit_posts": given.raw_posts(spark, folder),
        "scholarly_articles": given.raw_scholarly(spark, folder),
    }
    verbs = (*raw, "merge_all")
    late = F.col("id") % 5 == 1
    steps = (
        (jobs.EVERYTHING, lambda at: (at < WINDOWS[0].until) & ~late),
        (WINDOWS[1], lambda at: (at >= WINDOWS[0].until) & ~late),
        (WINDOWS[0], lambda at: (at < WINDOWS[0].until) & late),
        (WINDOWS[1], lambda at: (at >= WINDOWS[0].until) & late),
    )
    for batch, taken in steps:
        for table, rows in raw.items():
            dated = rows.withColumn("extracted_date", _window_of(F.col("id")))
            store.append(table, conform(dated.filter(taken(F.col("extracted_date"))), table))
        for verb in verbs:
            jobs.run(verb, store, batch=batch)
    return store.read(refresh.UNIFIED).drop("processed_timestamp")


@query("q_trending_of_days", "A1, F4, X8, T1 from stored counts")
def _trending_of_days(spark, folder):
    """Trending topics from counts of each day, stored in three parts; the content is not read again."""
    store = _scratch(spark)
    unified = _unified(spark, folder)
    for part in range(3):
        own = unified.filter(F.pmod("id", F.lit(3)) == part)
        store.append(refresh.DAYS, ranking.daily_categories(own))
    return ranking.trending_topics_of_days(store.read(refresh.DAYS), AS_OF)


@query("q_digest_by_day", "Q1, F8, T4, K3, S14 from insights kept by day")
def _digest_by_day(spark, folder):
    """The day's best of a stored table whose last runs were repeated with other scores before."""
    store = _scratch(spark)
    daily = given.insight_table(spark, folder).withColumn("generated_at", F.date_trunc("day", "generated_at"))
    rows = conform(daily, "content_insights").hint("rebalance", F.col("generated_at"))
    store.create_if_absent("content_insights")
    wrong = rows.filter(F.col("generated_at") >= F.lit("2024-01-28").cast("timestamp"))
    store.replace_parts("content_insights", wrong.withColumn("score", F.col("score") + 1000))
    store.replace_parts("content_insights", rows)
    return _served(serving.digest(store.read_laid_out("content_insights"), AS_OF))


@query("q_stored_language", "K7, K8 in stored files")
def _stored_language(spark, folder):
    """Papers in files from before the language column, and from after it."""
    store = _scratch(spark)
    papers = given.raw_scholarly(spark, folder).withColumn("id", F.col("id").cast("bigint"))
    store.append("scholarly_articles", papers.filter("id % 3 = 0").drop("language"))
    named = papers.filter("id % 3 <> 0").withColumn("language", F.when(F.col("id") % 3 == 1, F.lit("he")))
    store.append("scholarly_articles", conform(named, "scholarly_articles"))
    return store.read("scholarly_articles").select("id", "title", "language")


# --- rankings, insights, topics --------------------------------------------------------------


@query("q_trending_topics", "A1, F4, X8, T1")
def _trending_topics(spark, folder):
    return ranking.trending_topics(_unified(spark, folder), AS_OF)


@query("q_trending_by_sentiment", "A1, T1 with a varied score")
def _trending_by_sentiment(spark, folder):
    return ranking.trending_topics(_unified(spark, folder, varied=True), AS_OF).withColumn(
        "avg_sentiment", F.round("avg_sentiment", 6)
    )


@query("q_category_counts", "A1")
def _category_counts(spark, folder):
    """All categories of all dates, before the cut."""
    return ranking.category_counts(_unified(spark, folder), AS_OF, days=None).select(
        "category", "count"
    )


@query("q_positive_content", "F4, F5, T2, P10")
def _positive_content(spark, folder):
    return ranking.positive_content(_unified(spark, folder, varied=True), AS_OF)


@query("q_scholarly_recent", "F4, F6, T3, I4")
def _scholarly_recent(spark, folder):
    return ranking.recent_scholarly(_unified(spark, folder, varied=True), AS_OF)


@query("q_insights", "I1, I2, I6, X25, K3")
def _insights(spark, folder):
    rows = insights.ranked_insights(_unified(spark, folder, varied=True), AS_OF, GENERATED_AT)
    return rows.select(
        "insight_type",
        "title",
        "description",
        F.array_join("sources", "|").alias("sources"),
        F.array_join("related_content_ids", "|").alias("related_content_ids"),
        "score",
        _clock("generated_at"),
    )


@query("q_insight_ids", "I5")
def _insight_ids(spark, folder):
    """An insight of every row: as many ids as there are different insights."""
    rows = insights.positive_insights(_unified(spark, folder, varied=True), GENERATED_AT)
    return rows.groupBy("insight_type").agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("id").alias("ids")
    )


@query("q_corpus_words", "F7, X9, M1, M2")
def _corpus_words(spark, folder):
    return topics.corpus_words(_unified(spark, folder), CLEANED).select(
        "unified_id",
        F.size("words").alias("word_count"),
        F.array_join("words", " ").alias("words"),
    )


@query("q_term_counts", "A3")
def _term_counts(spark, folder):
    """Counts of every word, before the cut."""
    return topics.term_counts(topics.corpus_words(_unified(spark, folder), CLEANED))


@query("q_vocabulary", "A3")
def _vocabulary(spark, folder):
    return topics.vocabulary(topics.corpus_words(_unified(spark, folder), CLEANED))


@query("q_count_vectors", "M3")
def _count_vectors(spark, folder):
    """Counts of the vocabulary's words in every row, as ``rank:count`` in vocabulary order."""
    corpus = topics.corpus_words(_unified(spark, folder), CLEANED)
    terms = [row.term for row in topics.vocabulary(corpus).collect()]
    sparse = F.unwrap_udt("features")
    ranked = F.zip_with(
        sparse["indices"],
        sparse["values"],
        lambda i, n: F.concat_ws(":", i.cast("string"), n.cast("int").cast("string")),
    )
    return topics.count_vectors(corpus, terms).select(
        "unified_id", F.array_join(ranked, " ").alias("counts")
    )


@query("q_discovered_topics", "M3 to M5, J1, A2, W2, T8, T9, X26, I3")
def _discovered_topics(spark, folder):
    found = topics.discover_topics(_unified(spark, folder), topics.TopicSettings(partitions=8, cleaned=True))
    return insights.topic_insights(found, GENERATED_AT).select(
        "insight_type", "title", "description", F.round("score", 6).alias("score")
    )


def _stored_words(spark: SparkSession, folder: str):
    """The words of all content by category, stored once for what is counted more than once."""
    words = topics.corpus_words(_unified(spark, folder), CLEANED, ("category",))
    return staged(words.drop("unified_id"), scratch_folder(spark))


def _category_topics(words: DataFrame) -> DataFrame:
    """A topic per category: its ten most frequent words with their shares of its words.

    Topics are numbered by category; ten words of a few categories, kept as a table of their own.
    """
    spark = words.sparkSession
    terms = words.select("category", F.explode("words").alias("term"))
    counted = terms.groupBy("category", "term").count()
    # Tasks cut to ten words before rows meet by category.
    rank = F.row_number().over(Window.partitionBy("category").orderBy(F.desc("count"), "term"))
    ranked = counted.withColumn("rank", rank).filter("rank <= 10")
    totals = words.groupBy(F.col("category").alias("of")).agg(F.sum(F.size("words")).alias("total"))
    best = ranked.join(totals, F.col("category").eqNullSafe(F.col("of")))
    listed = (
        best.groupBy("category")
        .agg(F.sort_array(F.collect_list(F.struct("rank", "term", F.col("count") / F.col("total")))).alias("top"))
        .orderBy("category")
        .collect()
    )
    rows = [(i, [x[1] for x in row.top], [x[2] for x in row.top]) for i, row in enumerate(listed)]
    return spark.createDataFrame(rows, "topic int, terms array<string>, weights array<double>")


@query("q_topic_insights", "J1, A2, W2, T9, X26, I3")
def _topic_insights(spark, folder):
    """Topics by category through the steps that follow a fitted model."""
    with _stored_words(spark, folder) as words:
        found = _category_topics(words)
    names = sorted({t for row in found.select("terms").collect() for t in row.terms})
    places = {name: i for i, name in enumerate(names)}
    listed = F.create_map(*[F.lit(x) for pair in places.items() for x in pair])
    indexed = found.select(
        "topic",
        F.transform("terms", lambda t: F.element_at(listed, t)).alias("termIndices"),
        F.col("weights").alias("termWeights"),
    )
    rows = insights.topic_insights(topics.name_terms(indexed, names), GENERATED_AT)
    return rows.select(
        "insight_type",
        "title",
        "description",
        F.array_join("sources", "|").alias("sources"),
        F.size("related_content_ids").alias("related"),
        F.round("score", 6).alias("score"),
        _clock("generated_at"),
    )


@query("q_frequent_words", "A3 from summaries")
def _frequent_words(spark, folder):
    """The vocabulary by summaries of the tasks and an exact recount."""
    with staged(topics.corpus_words(_unified(spark, folder), CLEANED), scratch_folder(spark)) as corpus:
        found = frequent_vocabulary(corpus, CLEANED)
        # A thousand rows at most.
        return spark.createDataFrame(found.collect(), found.schema)


@query("q_topic_coherence", "M5, A3: how far the words of a topic occur together")
def _topic_coherence(spark, folder):
    """Coherence of the topics by category, over the documents of all categories."""
    with _stored_words(spark, folder) as words:
        values = topics.coherence(words, _category_topics(words)).withColumn("coherence", F.round("coherence", 6))
        # A row for each of a few categories.
        return spark.createDataFrame(values.collect(), values.schema)


@query("q_topic_properties", "M4, M5, T8")
def _topic_properties(spark, folder):
    """What holds for every fitted model, whatever its topics are."""
    words = topics.corpus_words(_unified(spark, folder), CLEANED).select("unified_id", "words")
    with staged(words, scratch_folder(spark)) as corpus:
        vocabulary = frequent_vocabulary(corpus, CLEANED)
        known = spark.createDataFrame(vocabulary.collect(), vocabulary.schema)
        terms = [row.term for row in known.collect()]
        settings = topics.TopicSettings(partitions=8, cleaned=True)
        found = topics.name_terms(topics.fit_topics(corpus, terms, settings), terms)
    listed = found.select("topic", F.explode("terms").alias("term")).join(known, "term")
    in_vocabulary = listed.groupBy("topic").agg(F.count_distinct("term").alias("known"))
    falling = F.forall(
        F.sequence(F.lit(1), F.size("weights") - 1),
        lambda i: F.get("weights", i) <= F.get("weights", i - 1),
    )
    total = F.aggregate("weights", F.lit(0.0), lambda a, w: a + w)
    return found.join(in_vocabulary, "topic", "left").select(
        "topic",
        F.size(F.array_distinct("terms")).alias("distinct_terms"),
        F.coalesce("known", F.lit(0)).alias("known_terms"),
        falling.alias("falling"),
        ((total > 0) & (total <= 1 + 1e-9)).alias("shares"),
    )


# --- serving ---------------------------------------------------------------------------------


def _served(rows: DataFrame) -> DataFrame:
    return rows.select(
        "id", "insight_type", "title", "description", "score", _clock("generated_at")
    )


@query("q_digest", "Q1, F8, T4")
def _digest(spark, folder):
    return _served(serving.digest(given.insight_table(spark, folder), AS_OF))


@query("q_latest", "Q2, F9, T5")
def _latest(spark, folder):
    return _served(serving.latest(given.insight_table(spark, folder), AS_OF))


@query("q_trending_served", "Q3, F10, T6")
def _trending_served(spark, folder):
    return _served(serving.trending(given.insight_table(spark, folder)))


@query("q_briefing", "Q4, F8, T7")
def _briefing(spark, folder):
    return _served(serving.briefing(given.insight_table(spark, folder), AS_OF))


@query("q_messages", "Q5, X24, T9")
def _messages(spark, folder):
    stored = given.insight_table(spark, folder)
    digest_texts = serving.digest_messages(stored, AS_OF).select(
        F.lit("digest").alias("kind"), "id", "message"
    )
    return digest_texts.unionByName(
        serving.latest_messages(stored, AS_OF).select(
            F.lit("latest").alias("kind"), "id", "message"
        )
    )


@query("q_list_messages", "Q6")
def _list_messages(spark, folder):
    stored = given.insight_table(spark, folder)
    return (
        serving.trending_message(stored)
        .withColumn("kind", F.lit("trending"))
        .unionByName(
            serving.briefing_message(stored, AS_OF).withColumn("kind", F.lit("briefing"))
        )
    )


# --- extraction ------------------------------------------------------------------------------


@query("q_story_items", "S9, F12, X11, X21, X22, P11, W1")
def _story_items(spark, folder):
    return stories.story_posts(given.story_payloads(spark, folder)).select(
        "story_id", "subreddit", "title", "author", "url", "score", _clock("created_utc")
    )


@query("q_news_feed_items", "S7, P11, W1, X23")
def _news_feed_items(spark, folder):
    return feeds.news_articles(given.feed_payloads(spark, folder)).select(
        "feed_url",
        "position",
        "source",
        "category",
        "title",
        "content",
        "url",
        _clock("published_date"),
    )


@query("q_feed_items", "S8, F11, F14, F15, W1, X16 to X20, X23")
def _feed_items(spark, folder):
    return feeds.scholarly_articles(given.feed_payloads(spark, folder)).select(
        "feed_url",
        "position",
        "source",
        "category",
        "title",
        "authors",
        "abstract",
        "url",
        "language",
        _clock("published_date"),
    )


@query("q_rejects", "K9, F11, A4")
def _rejects(spark, folder):
    """Outcomes of feeds, stories and pages."""
    parsed = feeds.parse_feeds(given.feed_payloads(spark, folder))
    read = stories.parse_stories(given.story_payloads(spark, folder, broken=True))
    fetched = given.page_payloads(spark, folder, LIST_PROFILE.name, odd=True)
    failed = pages.failed_payloads(fetched, [LIST_PROFILE], [LIST_PROFILE])
    unread = pages.unreadable_pages(pages.page_blocks(fetched, [LIST_PROFILE]))
    found = {
        "feeds": with_reason(parsed, feeds.payload_rules(fetched_only=True)),
        "stories": with_reason(read, stories.payload_rules()),
        "pages": failed.unionByName(unread),
    }
    counts = [
        reason_counts(checked).select(F.lit(kind).alias("kind"), "*") for kind, checked in found.items()
    ]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


@query("q_page_links", "S11, S13, F13, F15, X12")
def _page_links(spark, folder):
    payloads = given.page_payloads(spark, folder, LIST_PROFILE.name)
    return pages.news_articles(payloads, [LIST_PROFILE]).select(
        "page_url", "position", "source", "category", "title", "content", "url"
    )


@query("q_page_articles", "S12, S13, X13, X27, X28")
def _page_articles(spark, folder):
    payloads = given.page_payloads(spark, folder, ARTICLE_PROFILE.name)
    return pages.scholarly_articles(payloads, [ARTICLE_PROFILE]).select(
        "page_url",
        "source",
        "category",
        "title",
        "authors",
        "abstract",
        "url",
        "language",
        _clock("published_date"),
    )


@query("q_forum_items", "S10, S13, X14, X15")
def _forum_items(spark, folder):
    payloads = given.forum_payloads(spark, folder, FORUM_PROFILE.name)
    return pages.forum_posts(payloads, [FORUM_PROFILE]).select(
        "page_url", "position", "subreddit", "title", "author", "url", "score"
    )
