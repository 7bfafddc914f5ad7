"""One content table from the three transformed tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def news_content(transformed: DataFrame) -> DataFrame:
    return transformed.select(
        "id",
        F.col("source_normalized").alias("source"),
        F.col("category_normalized").alias("category"),
        F.col("clean_title").alias("title"),
        F.col("clean_content").alias("content"),
        "url",
        F.col("published_date_normalized").alias("published_date"),
        "sentiment_score",
        F.lit("news").alias("content_type"),
    )


def post_content(transformed: DataFrame) -> DataFrame:
    return transformed.select(
        "id",
        F.col("subreddit_normalized").alias("category"),
        F.lit("reddit").alias("source"),
        F.col("clean_title").alias("title"),
        F.lit(None).cast("string").alias("content"),
        "url",
        F.col("created_date").alias("published_date"),
        "sentiment_score",
        F.lit("social_media").alias("content_type"),
    )


def scholarly_content(transformed: DataFrame) -> DataFrame:
    return transformed.select(
        "id",
        F.col("source_normalized").alias("source"),
        F.col("category_normalized").alias("category"),
        F.col("clean_title").alias("title"),
        F.col("clean_abstract").alias("content"),
        "url",
        F.col("published_date_normalized").alias("published_date"),
        "sentiment_score",
        F.lit("academic").alias("content_type"),
    )


def unify(
    news: DataFrame, posts: DataFrame, scholarly: DataFrame, stamp: Column | None = None
) -> DataFrame:
    """Union of all rows, repeats included, with a key built from type and id."""
    return (
        news_content(news)
        .unionByName(post_content(posts), allowMissingColumns=True)
        .unionByName(scholarly_content(scholarly), allowMissingColumns=True)
        .withColumns(
            {
                "unified_id": F.concat(
                    F.col("content_type"), F.lit("_"), F.col("id").cast("string")
                ),
                "processed_timestamp": F.current_timestamp() if stamp is None else stamp,
            }
        )
    )
