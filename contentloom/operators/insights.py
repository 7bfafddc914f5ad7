"""Insight rows built from the ranked reports and the topics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contentloom.catalog import MULTIPLE_SOURCES, POSITIVE_DESCRIPTION, TOPIC_SOURCE
from contentloom.functions.dates import as_timestamp
from contentloom.functions.text import two_decimals
from contentloom.operators.ranking import positive_content, trending_topics
from contentloom.operators.topics import TopicSettings, discover_topics


def insight_id(insight_type: Column, title: Column, related: Column, moment: Column) -> Column:
    """Same content and time give the same id, so a repeated run can be recognized."""
    return F.xxhash64(insight_type, title, F.array_join(related, ","), moment)


def insight_rows(
    df: DataFrame,
    insight_type: str,
    title: Column,
    description: Column,
    sources: Column,
    score: Column,
    related: Column | None = None,
    generated_at=None,
) -> DataFrame:
    """Rows of the insight table.

    ``sources`` is a single value and becomes a one-element array, absent related ids become an
    empty one.
    """
    none = F.array().cast("array<string>")
    return df.select(
        F.lit(insight_type).alias("insight_type"),
        title.alias("title"),
        description.alias("description"),
        F.array(sources).alias("sources"),
        (none if related is None else F.coalesce(F.array(related), none)).alias(
            "related_content_ids"
        ),
        score.cast("double").alias("score"),
        as_timestamp(generated_at).alias("generated_at"),
    ).select(
        insight_id(
            F.col("insight_type"),
            F.col("title"),
            F.col("related_content_ids"),
            F.col("generated_at"),
        ).alias("id"),
        "*",
    )


def trending_insights(trending: DataFrame, generated_at=None) -> DataFrame:
    """One row per category; a category without a name cannot be a title and is left out."""
    return insight_rows(
        trending.filter(F.col("category").isNotNull()),
        "trending_topic",
        title=F.col("category"),
        description=F.concat(
            F.lit("This category has "),
            F.col("count").cast("string"),
            F.lit(" recent articles with an average sentiment of "),
            two_decimals(F.coalesce("avg_sentiment", F.lit(0.0))),
        ),
        sources=F.lit(MULTIPLE_SOURCES),
        score=F.col("count"),
        generated_at=generated_at,
    )


def positive_insights(positive: DataFrame, generated_at=None) -> DataFrame:
    return insight_rows(
        positive,
        "positive_content",
        title=F.col("title"),
        description=F.lit(POSITIVE_DESCRIPTION),
        sources=F.col("source"),
        score=F.col("sentiment_score"),
        related=F.col("unified_id"),
        generated_at=generated_at,
    )


def topic_insights(topics: DataFrame, generated_at=None) -> DataFrame:
    """One row per topic, scored by the weight of its five strongest terms."""
    return insight_rows(
        topics,
        "discovered_topic",
        title=F.concat(
            F.lit("Topic "),
            (F.col("topic") + 1).cast("string"),
            F.lit(": "),
            F.array_join(F.slice("terms", 1, 3), ", "),
        ),
        description=F.concat(
            F.lit("Discovered topic with key terms: "),
            F.array_join(F.slice("terms", 1, 10), ", "),
        ),
        sources=F.lit(TOPIC_SOURCE),
        score=F.aggregate(F.slice("weights", 1, 5), F.lit(0.0), lambda total, w: total + w),
        generated_at=generated_at,
    )


def ranked_insights(
    unified: DataFrame, as_of=None, generated_at=None, trending: DataFrame | None = None
) -> DataFrame:
    """Trending and positive insights, a plan without any job.

    ``trending`` may hold the ranked categories when they have been computed before.
    """
    categories = trending_topics(unified, as_of) if trending is None else trending
    return trending_insights(categories, generated_at).unionByName(
        positive_insights(positive_content(unified, as_of), generated_at)
    )


def build_insights(
    unified: DataFrame,
    as_of=None,
    generated_at=None,
    settings: TopicSettings = TopicSettings(),
    trending: DataFrame | None = None,
    folder: str | None = None,
) -> DataFrame:
    """All insight rows of one run, to be stored with a single write. Words are staged in ``folder``."""
    return ranked_insights(unified, as_of, generated_at, trending).unionByName(
        topic_insights(discover_topics(unified, settings, folder), generated_at)
    )
