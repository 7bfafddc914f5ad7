"""Validation, cleaning and normalizing of the three raw tables.

Each function keeps all input columns and appends computed ones. The plans are a single scan,
filter and projection: no shuffle, no Python, nothing collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contentloom.functions.rules import author_count, popularity_level
from contentloom.functions.text import clean_text, clean_tokens, normalize_label


def _stamps(sentiment: Column | None, stamp: Column | None) -> dict[str, Column]:
    return {
        "transformation_date": F.current_timestamp() if stamp is None else stamp,
        "sentiment_score": F.lit(0.0) if sentiment is None else sentiment,
    }


def _not_empty(name: str) -> Column:
    """Present and not empty, in a form a parquet scan can take over."""
    return F.col(name).isNotNull() & (F.col(name) != "")


def _cleaned(name: str) -> Column:
    """Clean text of a column the validation keeps from being NULL.

    Saying so lets the optimizer drop later IS NOT NULL checks, which would otherwise be pushed
    down to the scan and clean every text a second time.
    """
    return F.coalesce(clean_text(F.col(name)), F.lit(""))


def transform_news(
    raw: DataFrame, sentiment: Column | None = None, stamp: Column | None = None
) -> DataFrame:
    return (
        raw.filter(_not_empty("title") & _not_empty("content"))
        .withColumns(
            {
                "clean_title": _cleaned("title"),
                "clean_content": _cleaned("content"),
            }
        )
        .withColumns(
            {
                "title_tokens": clean_tokens(F.col("clean_title")),
                "content_tokens": clean_tokens(F.col("clean_content")),
                "content_length": F.length("content"),
                "source_normalized": normalize_label(F.col("source")),
                "category_normalized": normalize_label(F.col("category")),
                "published_date_normalized": F.to_date("published_date"),
                **_stamps(sentiment, stamp),
            }
        )
    )


def transform_posts(
    raw: DataFrame, sentiment: Column | None = None, stamp: Column | None = None
) -> DataFrame:
    return (
        raw.filter(_not_empty("title"))
        .withColumn("clean_title", _cleaned("title"))
        .withColumns(
            {
                "title_tokens": clean_tokens(F.col("clean_title")),
                "subreddit_normalized": normalize_label(F.col("subreddit")),
                "popularity_level": popularity_level(F.col("score")),
                "created_date": F.to_date("created_utc"),
                **_stamps(sentiment, stamp),
            }
        )
    )


def transform_scholarly(
    raw: DataFrame, sentiment: Column | None = None, stamp: Column | None = None
) -> DataFrame:
    """An empty abstract is kept, an absent one is not."""
    return (
        raw.filter(_not_empty("title") & F.col("abstract").isNotNull())
        .withColumns(
            {
                "clean_title": _cleaned("title"),
                "clean_abstract": _cleaned("abstract"),
            }
        )
        .withColumns(
            {
                "title_tokens": clean_tokens(F.col("clean_title")),
                "abstract_tokens": clean_tokens(F.col("clean_abstract")),
                "abstract_length": F.length("abstract"),
                "author_count": author_count(F.col("authors")),
                "source_normalized": normalize_label(F.col("source")),
                "category_normalized": normalize_label(F.col("category")),
                "published_date_normalized": F.to_date("published_date"),
                **_stamps(sentiment, stamp),
            }
        )
    )
