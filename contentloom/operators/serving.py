"""Top-k reads of the insight table and the texts made from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contentloom.functions.dates import as_date
from contentloom.functions.text import two_decimals

# Headings and closing lines of list messages.
TRENDING_HEADING = (
    "📊 *TRENDING TOPICS* 📊\n\nHere's what's generating buzz across platforms:\n\n"
)
TRENDING_EMPTY = "No trending topics found currently."
BRIEFING_HEADING = "*DAILY BRIEFING*\n\nHere's your summary of today's most relevant content:\n\n"
BRIEFING_CLOSING = "\nAsk me for more details on any topic!"


def _since(insights: DataFrame, day: Column) -> DataFrame:
    """Insights from the beginning of a day on; those kept by day are read from that day's folders on."""
    found = insights.filter(F.col("generated_at") >= day.cast("timestamp"))
    return found.filter(F.col("generated_day") >= day) if "generated_day" in insights.columns else found


def _best(insights: DataFrame, rows: int) -> DataFrame:
    return insights.orderBy(F.desc("score"), F.asc("id")).limit(rows)


def digest(insights: DataFrame, as_of=None, rows: int = 10) -> DataFrame:
    """Best insights of the day."""
    return _best(_since(insights, as_date(as_of)), rows)


def latest(insights: DataFrame, as_of=None, rows: int = 5) -> DataFrame:
    """Best insights since the day before."""
    return _best(_since(insights, F.date_sub(as_date(as_of), 1)), rows)


def briefing(insights: DataFrame, as_of=None, rows: int = 7) -> DataFrame:
    """Best insights of the day, short form."""
    return _best(_since(insights, as_date(as_of)), rows)


def trending(insights: DataFrame, rows: int = 5) -> DataFrame:
    """Newest trending topics, the stronger first."""
    return (
        insights.filter(F.col("insight_type") == "trending_topic")
        .orderBy(F.desc("generated_at"), F.desc("score"), F.asc("id"))
        .limit(rows)
    )


def insight_message(with_sources: bool) -> Column:
    """Message text of one insight, with or without its first three sources."""
    sources = F.concat(
        F.lit("Sources: "), F.array_join(F.slice("sources", 1, 3), ", "), F.lit("\n")
    )
    return F.concat(
        F.lit("\n*"),
        F.upper("insight_type"),
        F.lit("*: "),
        F.col("title"),
        F.lit("\n\n"),
        F.col("description"),
        F.lit("\n\n"),
        sources if with_sources else F.lit(""),
        F.lit("Relevance Score: "),
        two_decimals(F.col("score")),
        F.lit("\n        "),
    )


def digest_messages(insights: DataFrame, as_of=None) -> DataFrame:
    return digest(insights, as_of).withColumn("message", insight_message(with_sources=True))


def latest_messages(insights: DataFrame, as_of=None) -> DataFrame:
    return latest(insights, as_of).withColumn("message", insight_message(with_sources=False))


def bullet() -> Column:
    return F.concat(
        F.lit("• *"), F.col("title"), F.lit("*: "), F.col("description"), F.lit("\n\n")
    )


def _one_message(
    ranked: DataFrame, order: list[Column], heading: str, closing: str, empty: str | None
) -> DataFrame:
    """One text from the few ranked rows, in rank order."""
    rows = F.sort_array(F.collect_list(F.struct(*order, bullet().alias("bullet"))))
    return ranked.agg(rows.alias("rows")).select(
        F.when(F.size("rows") == 0, F.lit(empty))
        .otherwise(
            F.concat(F.lit(heading), F.array_join(F.col("rows.bullet"), ""), F.lit(closing))
        )
        .alias("message")
    )


def trending_message(insights: DataFrame, heading: str = TRENDING_HEADING) -> DataFrame:
    return _one_message(
        trending(insights),
        [
            (-F.unix_micros("generated_at")).alias("newest"),
            (-F.col("score")).alias("best"),
            F.col("id"),
        ],
        heading,
        "",
        TRENDING_EMPTY,
    )


def briefing_message(
    insights: DataFrame,
    as_of=None,
    heading: str = BRIEFING_HEADING,
    closing: str = BRIEFING_CLOSING,
) -> DataFrame:
    """The text is NULL on a day without insights: nothing is to be sent."""
    return _one_message(
        briefing(insights, as_of),
        [(-F.col("score")).alias("best"), F.col("id")],
        heading,
        closing,
        None,
    )
