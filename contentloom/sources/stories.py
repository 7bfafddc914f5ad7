"""Story payloads (one JSON object per story) to raw post rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contentloom import catalog
from contentloom.functions.dates import epoch_timestamp
from contentloom.functions.rules import guess_category
from contentloom.operators.quality import REASON, rejected_rows, with_reason

STORY = "by string, url string, score int, time bigint, title string, _malformed string"
_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_malformed"}


def parse_stories(payloads: DataFrame, limit: int = catalog.STORIES_PER_LIST) -> DataFrame:
    """The first stories of every fetched list with the parsed object in ``story``.

    Exploding an array of one makes every later use share one parse; a parsed frame passes as it
    is. An object that is broken, or holds a value of another type, is in ``story._malformed``.
    """
    if "story" in payloads.columns:
        return payloads
    parsed = F.from_json("body", STORY, _OPTIONS)
    return payloads.filter(F.col("pos") < limit).select(
        "*", F.explode(F.array(parsed)).alias("story")
    )


def _malformed() -> Column:
    return F.col("story").isNull() | F.col("story._malformed").isNotNull()


def payload_rules() -> dict[str, Column]:
    """Why a parsed object gives no row."""
    return {"malformed": _malformed(), "no title": F.col("story.title").isNull()}


def story_posts(payloads: DataFrame, limit: int = catalog.STORIES_PER_LIST) -> DataFrame:
    """Raw post rows; objects without a title are no stories."""
    return (
        parse_stories(payloads, limit)
        .filter(~_malformed() & F.col("story.title").isNotNull())
        .select(
            guess_category(F.col("story.title")).alias("subreddit"),
            F.col("story.title").alias("title"),
            F.coalesce("story.by", F.lit(catalog.STORY_AUTHOR_DEFAULT)).alias("author"),
            F.coalesce(
                "story.url",
                F.concat(F.lit(catalog.STORY_LINK_PREFIX), F.col("story_id").cast("string")),
            ).alias("url"),
            F.coalesce("story.score", F.lit(0)).alias("score"),
            epoch_timestamp(F.coalesce("story.time", F.lit(0))).alias("created_utc"),
            F.col("fetched_at").alias("extracted_date"),
            "story_id",
        )
    )


def failed_payloads(payloads: DataFrame, limit: int = catalog.STORIES_PER_LIST) -> DataFrame:
    checked = with_reason(parse_stories(payloads, limit), payload_rules())
    return rejected_rows(checked).select(
        F.col("story_id").cast("string").alias("origin"), REASON, "body"
    )
