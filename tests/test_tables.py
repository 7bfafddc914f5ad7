"""Transforms, unified table, rankings."""

import datetime as dt

from pyspark.sql import functions as F

from contentloom.operators import quality, ranking
from contentloom.operators.transform import transform_news, transform_posts, transform_scholarly
from contentloom.operators.unify import unify
from contentloom.schemas import conform, ensure_column, schema

NOON = dt.datetime(2024, 1, 30, 12)


def news(spark, *rows):
    return spark.createDataFrame(
        [(i, " S ", " C ", title, content, "u", NOON, NOON) for i, (title, content) in enumerate(rows)],
        schema("news_articles"),
    )


def posts(spark, *rows):
    return spark.createDataFrame(
        [(i, " Sub ", title, "a", "u", score, NOON, NOON) for i, (title, score) in enumerate(rows)],
        schema("reddit_posts"),
    )


def papers(spark, *rows):
    return spark.createDataFrame(
        [(i, "S", "C", t, authors, abstract, "u", NOON, NOON, "en")
         for i, (t, authors, abstract) in enumerate(rows)],
        schema("scholarly_articles"),
    )


def same_columns(df, table):
    wanted = [(f.name, f.dataType) for f in schema(table).fields]
    assert [(f.name, f.dataType) for f in df.schema.fields] == wanted


def test_news(spark):
    df = transform_news(
        news(spark, ("T 1!", "Some  Text"), (None, "x"), ("", "x"), (" ", "x"), ("t", None), ("t", ""))
    )
    same_columns(df, "transformed_news_articles")
    rows = df.orderBy("id").collect()
    assert [r.id for r in rows] == [0, 3]
    first = rows[0]
    assert (first.clean_title, first.clean_content) == ("t", "some  text")
    assert (first.title_tokens, first.content_tokens) == ([], ["some", "text"])
    assert (first.content_length, first.source_normalized, first.category_normalized) == (10, "s", "c")
    assert first.published_date_normalized == dt.date(2024, 1, 30)
    assert first.sentiment_score == 0.0 and first.transformation_date is not None


def test_posts(spark):
    df = transform_posts(posts(spark, ("Big News", 1001), ("", 5), (None, 5), ("x", None)))
    same_columns(df, "transformed_reddit_posts")
    rows = df.orderBy("id").collect()
    assert [(r.id, r.popularity_level) for r in rows] == [(0, "high"), (3, "low")]
    assert rows[0].title_tokens == ["big", "news"] and rows[0].subreddit_normalized == "sub"
    assert rows[0].created_date == dt.date(2024, 1, 30)


def test_scholarly_keeps_empty_abstract(spark):
    df = transform_scholarly(
        papers(spark, ("T", "a,b", "Abstract text"), ("T", None, ""), ("T", "a", None))
    )
    same_columns(df, "transformed_scholarly_articles")
    rows = df.orderBy("id").collect()
    assert [(r.id, r.author_count, r.abstract_length) for r in rows] == [(0, 2, 13), (1, None, 0)]
    assert rows[1].clean_abstract == "" and rows[1].abstract_tokens == []


def test_sentiment_and_stamp_can_be_given(spark):
    df = transform_news(
        news(spark, ("T", "x")), sentiment=F.lit(0.9), stamp=F.lit(NOON)
    ).select("sentiment_score", "transformation_date")
    assert df.first() == (0.9, NOON)


def unified(spark):
    return unify(
        transform_news(news(spark, ("T", "Body"), ("T", "Body"))),
        transform_posts(posts(spark, ("P", 1))),
        transform_scholarly(papers(spark, ("A", "x", "Abs"))),
    )


def test_unify(spark):
    df = unified(spark)
    same_columns(df, "unified_content")
    rows = {r.unified_id: r for r in df.collect()}
    assert set(rows) == {"news_0", "news_1", "social_media_0", "academic_0"}
    post = rows["social_media_0"]
    assert (post.content, post.source, post.category) == (None, "reddit", "sub")
    assert rows["academic_0"].content == "abs" and rows["news_0"].content_type == "news"


def test_unify_keeps_repeats(spark):
    part = transform_news(news(spark, ("T", "Body")))
    none = transform_posts(posts(spark)), transform_scholarly(papers(spark))
    df = unify(part.unionAll(part), *none)
    assert df.count() == 2
    assert quality.duplicate_keys(df).collect() == [("news_0", 2)]


def ranked_input(spark, rows):
    return spark.createDataFrame(
        [
            (f"{kind}_{i}", category, kind, day, score, "t", "s", "u")
            for i, (category, kind, day, score) in enumerate(rows)
        ],
        "unified_id string, category string, content_type string, published_date date,"
        " sentiment_score double, title string, source string, url string",
    )


def day(number):
    return dt.date(2024, 1, 1) + dt.timedelta(days=number - 1)


def test_trending(spark):
    df = ranked_input(
        spark,
        [("a", "news", day(27), 0.0)] * 2
        + [("b", "news", day(30), 0.5)] * 2
        + [("old", "news", day(26), 0.9)]
        + [("future", "news", day(32), 0.1)]
        + [(None, "news", day(30), 0.0)]
        + [("undated", "news", None, 0.0)],
    )
    assert [tuple(r) for r in ranking.trending_topics(df, "2024-01-30").collect()] == [
        ("b", 2, 0.5),
        ("a", 2, 0.0),
        ("future", 1, 0.1),
        (None, 1, 0.0),
    ]


def test_trending_cuts_ties_by_name(spark):
    df = ranked_input(spark, [(f"c{i:02}", "news", day(30), 0.0) for i in range(15)])
    assert [r.category for r in ranking.trending_topics(df, "2024-01-30").collect()] == [
        f"c{i:02}" for i in range(10)
    ]


def test_positive(spark):
    df = ranked_input(
        spark,
        [("a", "news", day(30), 0.7), ("a", "news", day(30), 0.71), ("a", "news", day(25), 0.9)]
        + [("a", "news", day(24), 0.99), ("a", "news", day(30), None)],
    )
    found = ranking.positive_content(df, "2024-01-30").collect()
    assert [r.unified_id for r in found] == ["news_2", "news_1"]
    assert found[0].asDict().keys() == {"unified_id", "title", "source", "sentiment_score", "url"}


def test_recent_scholarly(spark):
    df = ranked_input(
        spark,
        [("a", "academic", day(20), 0.1), ("a", "academic", day(28), 0.1), ("a", "news", day(30), 1.0)]
        + [("a", "academic", day(16), 0.9), ("a", "academic", day(15), 0.9)],
    )
    found = ranking.recent_scholarly(df, "2024-01-30").collect()
    assert [r.unified_id for r in found] == ["academic_3", "academic_1", "academic_0"]


def test_language_column(spark):
    old = papers(spark, ("T", "a", "b")).drop("language")
    new = papers(spark, ("U", "a", "b")).withColumn("language", F.lit("he"))
    both = ensure_column(old, "language", F.lit("en")).unionByName(new, allowMissingColumns=True)
    assert {(r.title, r.language) for r in both.collect()} == {("T", "en"), ("U", "he")}
    assert ensure_column(new, "language", F.lit("en")).first().language == "he"


def test_conform(spark):
    df = conform(spark.createDataFrame([("t", 3)], "title string, extra int"), "news_articles")
    same_columns(df, "news_articles")
    assert df.first().title == "t" and df.first().id is None


def test_reject_reasons(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (None, ""), (2, None)], "n int, t string")
    checked = quality.with_reason(
        df, {"no number": F.col("n").isNull(), "no text": F.col("t") == ""}
    )
    assert {(r.reject_reason, r["rows"]) for r in quality.reason_counts(checked).collect()} == {
        ("stored", 2),
        ("no number", 2),
    }
    assert quality.good_rows(checked).columns == ["n", "t"]
    assert quality.rejected_rows(checked).count() == 2
