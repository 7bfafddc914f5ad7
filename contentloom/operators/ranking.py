"""Ranked reports over the unified content table.

Score and date alone leave ties open; every ranking here ends with a unique key so that the cut is
the same whatever the partitioning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contentloom.functions.dates import as_date, recent

# How far back each report looks, how long it is, and the score it asks for.
TRENDING_DAYS, TRENDING_ROWS = 3, 10
POSITIVE_DAYS, POSITIVE_ROWS, POSITIVE_ABOVE = 5, 15, 0.7
SCHOLARLY_DAYS, SCHOLARLY_ROWS = 14, 10


def category_counts(
    unified: DataFrame, as_of=None, days: int | None = TRENDING_DAYS
) -> DataFrame:
    """Rows and average sentiment of each category, NULL being a category of its own.

    Rows without a date never count; ``days=None`` counts all others.
    """
    date = F.col("published_date")
    dated = date.isNotNull() if days is None else recent(date, as_date(as_of), days)
    return (
        unified.filter(dated)
        .groupBy("category")
        .agg(F.count(F.lit(1)).alias("count"), F.avg("sentiment_score").alias("avg_sentiment"))
    )


def daily_categories(unified: DataFrame) -> DataFrame:
    """Counts of each category by type and day, which add up to those of any other period."""
    score = F.col("sentiment_score")
    return unified.groupBy("content_type", "published_date", "category").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count(score).alias("scored"),
        F.sum(score).alias("sentiment_sum"),
    )


def category_counts_of_days(
    days_counted: DataFrame, as_of=None, days: int | None = TRENDING_DAYS
) -> DataFrame:
    """``category_counts`` from ``daily_categories``, in any number of partial rows."""
    date = F.col("published_date")
    dated = date.isNotNull() if days is None else recent(date, as_date(as_of), days)
    scored = F.sum("scored")
    return (
        days_counted.filter(dated)
        .groupBy("category")
        .agg(
            F.sum("rows").alias("count"),
            F.when(scored > 0, F.sum("sentiment_sum") / scored).alias("avg_sentiment"),
        )
    )


def trending_topics_of_days(
    days_counted: DataFrame, as_of=None, days: int = TRENDING_DAYS, rows: int = TRENDING_ROWS
) -> DataFrame:
    """``trending_topics`` without a look at the content table."""
    return top_categories(category_counts_of_days(days_counted, as_of, days), rows)


def top_categories(counts: DataFrame, rows: int = TRENDING_ROWS) -> DataFrame:
    return counts.orderBy(F.desc("count"), F.desc("avg_sentiment"), F.asc("category")).limit(rows)


def trending_topics(
    unified: DataFrame, as_of=None, days: int = TRENDING_DAYS, rows: int = TRENDING_ROWS
) -> DataFrame:
    return top_categories(category_counts(unified, as_of, days), rows)


def positive_content(
    unified: DataFrame,
    as_of=None,
    days: int = POSITIVE_DAYS,
    rows: int = POSITIVE_ROWS,
    above: float = POSITIVE_ABOVE,
) -> DataFrame:
    return (
        unified.filter(
            (F.col("sentiment_score") > above)
            & recent(F.col("published_date"), as_date(as_of), days)
        )
        .select("unified_id", "title", "source", "sentiment_score", "url")
        .orderBy(F.desc("sentiment_score"), F.asc("unified_id"))
        .limit(rows)
    )


def recent_scholarly(
    unified: DataFrame, as_of=None, days: int = SCHOLARLY_DAYS, rows: int = SCHOLARLY_ROWS
) -> DataFrame:
    return (
        unified.filter(
            (F.col("content_type") == "academic")
            & recent(F.col("published_date"), as_date(as_of), days)
        )
        .orderBy(F.desc("sentiment_score"), F.desc("published_date"), F.asc("unified_id"))
        .limit(rows)
        .select("unified_id", "title", "source", "sentiment_score", "content_type", "url")
    )
