"""The test tables seen as the pipeline's raw tables and payloads.

Each mapping covers every row of its table and the whole of every text. Nothing here joins or
groups: a payload is built from one row, so the mapping scales with the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = "2024-01-30"
FETCHED_AT = "2024-01-30 06:00:00"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def first_line(text: Column) -> Column:
    return F.substring_index(text, "\n", 1)


def _days_ago(number: Column) -> Column:
    return F.timestamp_seconds(
        F.unix_timestamp(F.lit(AS_OF).cast("timestamp")) - (number % 30) * 86400
    )


def _fetched_at() -> Column:
    return F.lit(FETCHED_AT).cast("timestamp")


def varied_score(number: Column) -> Column:
    """Stands in for a sentiment model: 0.00 to 1.00, spread over the ids."""
    return ((number * 37) % 101) / F.lit(100.0)


def _with_gaps(number: Column, modulus: int, value: Column) -> Column:
    """``value``, empty on some rows and NULL on some, so that the rules for such rows show."""
    return F.when(number % modulus == 7, "").when(number % modulus != 8, value)


def raw_news(spark: SparkSession, folder: str) -> DataFrame:
    """News articles from documents."""
    return table(spark, folder, "documents").select(
        F.col("doc_id").alias("id"),
        F.concat(F.lit("  "), F.upper("source"), F.lit(" ")).alias("source"),
        F.when(F.col("doc_id") % 37 != 5, F.upper("lang")).alias("category"),
        _with_gaps(F.col("doc_id"), 41, first_line(F.col("text"))).alias("title"),
        _with_gaps(F.col("doc_id"), 43, F.col("text")).alias("content"),
        F.concat(F.lit("http://example.com/doc/"), F.col("doc_id").cast("string")).alias("url"),
        _days_ago(F.col("doc_id")).alias("published_date"),
        _fetched_at().alias("extracted_date"),
    )


def raw_posts(spark: SparkSession, folder: str) -> DataFrame:
    """Community posts from events."""
    return table(spark, folder, "events").select(
        F.col("event_id").alias("id"),
        F.concat(F.lit(" "), F.initcap("event_type")).alias("subreddit"),
        _with_gaps(F.col("event_id"), 41, F.concat_ws(" ", "event_type", "props")).alias("title"),
        F.concat(F.lit("user"), F.col("user_id").cast("string")).alias("author"),
        F.concat(F.lit("http://example.com/post/"), F.col("event_id").cast("string")).alias("url"),
        F.floor(F.col("value") * 10).try_cast("int").alias("score"),
        F.col("ts").cast("timestamp").alias("created_utc"),
        _fetched_at().alias("extracted_date"),
    )


def raw_scholarly(spark: SparkSession, folder: str) -> DataFrame:
    """Scholarly articles from conversation turns; the text before the first stop holds commas."""
    number = F.col("conv_id") * 1000 + F.col("turn")
    return table(spark, folder, "conversations").select(
        number.alias("id"),
        F.concat(F.lit(" Journal of "), F.col("role"), F.lit("  ")).alias("source"),
        F.initcap("role").alias("category"),
        _with_gaps(number, 41, first_line(F.col("text"))).alias("title"),
        F.when(number % 37 != 5, F.substring_index("text", ".", 1)).alias("authors"),
        _with_gaps(number, 43, F.col("text")).alias("abstract"),
        F.concat(F.lit("http://example.com/paper/"), number.cast("string")).alias("url"),
        _days_ago(number).alias("published_date"),
        _fetched_at().alias("extracted_date"),
    )


def insight_table(spark: SparkSession, folder: str) -> DataFrame:
    """Stored insights from events, three sources and more on some rows."""
    return table(spark, folder, "events").select(
        F.col("event_id").alias("id"),
        F.when(F.col("event_type").isin("click", "view"), F.lit("trending_topic"))
        .when(F.col("event_type") == "purchase", F.lit("positive_content"))
        .otherwise(F.lit("discovered_topic"))
        .alias("insight_type"),
        F.concat_ws(" ", "event_type", F.col("event_id").cast("string")).alias("title"),
        F.concat(F.lit("seen by user "), F.col("user_id").cast("string")).alias("description"),
        F.slice(
            F.array(F.col("event_type"), F.lit("feed"), F.lit("page"), F.lit("archive")),
            1,
            (F.col("event_id") % 4 + 1).cast("int"),
        ).alias("sources"),
        F.array(F.concat(F.lit("news_"), F.col("event_id").cast("string"))).alias(
            "related_content_ids"
        ),
        F.col("value").alias("score"),
        F.col("ts").cast("timestamp").alias("generated_at"),
    )


# --- payloads -------------------------------------------------------------------------------


def _escaped(text: Column) -> Column:
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(char), F.lit(entity))
    return text


def _lines() -> Column:
    return F.split("text", "\n", -1)


def _element(name: str, content: Column) -> Column:
    return F.concat(F.lit(f"<{name}>"), content, F.lit(f"</{name}>"))


def _cases(selector: Column, *texts: Column) -> Column:
    chain = F
    for number, text in enumerate(texts):
        chain = chain.when(selector == number, text)
    return chain.otherwise(F.lit(""))


def _feed_item(line: Column, i: Column) -> Column:
    """One item whose optional parts depend on its position."""
    text = _escaped(line)
    day = F.lpad((i % 28 + 1).cast("string"), 2, "0")
    mail = F.concat(F.lit("Mon, "), day, F.lit(" Jan 2024 10:00:00 "))
    number = F.col("doc_id")
    link = F.concat(
        F.lit("http://example.com/doc/"),
        number.cast("string"),
        F.lit("/"),
        i.cast("string"),
    )
    writer = _element("author", F.lit(" A. Writer "))
    creator = _element("dc:creator", F.lit("C, D"))
    return _element(
        "item",
        F.concat(
            _element("title", text),
            F.when((number + i) % 11 != 5, _element("link", link))
            .when(i % 2 == 0, _element("guid", link))
            .otherwise(F.concat(F.lit('<guid isPermaLink="false">'), link, F.lit("</guid>"))),
            _cases(i % 5, writer, creator, F.lit(""), F.concat(writer, creator), F.concat(creator, writer)),
            _cases(
                i % 4,
                _element("description", text),
                _element(
                    "content:encoded",
                    F.concat(
                        F.lit("<![CDATA[<p class='x'>"), text, F.lit("<br/> <i>more</i></p>]]>")
                    ),
                ),
                _element("summary", text),
            ),
            _cases(
                i % 5,
                _element("pubDate", F.concat(mail, F.lit("+0000"))),
                _element("pubDate", F.concat(mail, F.lit("-0500"))),
                _element("dc:date", F.concat(F.lit("2024-01-"), day, F.lit("T10:00:00Z"))),
                _element("pubDate", F.concat(mail, F.lit("GMT"))),
            ),
        ),
    )


def feed_payloads(spark: SparkSession, folder: str) -> DataFrame:
    """One feed per document, one item per line; some are cut short, some were not fetched.

    Some feeds begin with an empty item, in either form, some have comments between their items.
    """
    kind = F.col("doc_id") % 6
    between = F.when(kind == 3, "<!-- <item><author>nobody</author></item> -->").otherwise("")
    empty = F.when(kind == 1, "<item/>").when(kind == 2, '<item note="a > b" />').otherwise("")
    items = F.transform(_lines(), lambda line, i: F.concat(_feed_item(line, i), between))
    items = F.concat(empty, F.array_join(items, ""))
    body = F.concat(
        F.lit(
            '<rss version="2.0" xmlns:dc="urn:dc" xmlns:content="urn:content"><channel><title>Feed '
        ),
        F.col("source"),
        F.lit("</title>"),
        items,
        F.when(F.col("doc_id") % 13 == 4, F.lit("</channel>")).otherwise(
            F.lit("</channel></rss>")
        ),
    )
    return table(spark, folder, "documents").select(
        F.concat(F.lit("http://example.com/feed/"), F.col("doc_id").cast("string")).alias("feed_url"),
        F.col("source").alias("source_name"),
        F.lit("feeds").alias("category"),
        F.col("lang").alias("language"),
        F.when(F.col("doc_id") % 17 == 2, 503).otherwise(200).alias("status"),
        body.alias("body"),
        _fetched_at().alias("fetched_at"),
    )


def _broken(number: Column, body: Column) -> Column:
    return (
        F.when(number % 19 == 3, F.substr(body, F.lit(1), F.char_length(body) - 1))
        .when(number % 19 == 5, F.lit('{"title": "t", "score": 5.5}'))
        .otherwise(body)
    )


def story_payloads(spark: SparkSession, folder: str, broken: bool = False) -> DataFrame:
    """One story object per document, in lists of sixty; absent fields depend on the id.

    With ``broken`` some objects are cut short and some have a score that is no integer.
    """
    number = F.col("doc_id")
    story = F.struct(
        F.when(number % 4 != 1, F.col("source")).alias("by"),
        F.when(
            number % 5 != 2, F.concat(F.lit("http://example.com/story/"), number.cast("string"))
        ).alias("url"),
        F.when(number % 6 != 3, F.col("n_chars").cast("int")).alias("score"),
        F.when(number % 7 != 4, F.lit(1704067200) + number * 60).alias("time"),
        F.when(number % 10 != 0, F.col("text")).alias("title"),
    )
    return table(spark, folder, "documents").select(
        (number % 60).cast("int").alias("pos"),
        number.alias("story_id"),
        (_broken(number, F.to_json(story)) if broken else F.to_json(story)).alias("body"),
        _fetched_at().alias("fetched_at"),
    )


def page_payloads(spark: SparkSession, folder: str, profile: str, odd: bool = False) -> DataFrame:
    """The web pages, all read with one profile; some begin with a marked section of no known kind.

    With ``odd`` some pages were not fetched and some have a profile nobody knows.
    """
    number = F.col("page_id")
    name, status = F.lit(profile), F.lit(200)
    if odd:
        name = F.when(number % 7 == 1, F.lit("nobody")).when(number % 7 != 2, name)
        status = F.when(number % 5 == 0, 404).otherwise(status)
    section = F.when(number % 9 == 4, F.lit("<![word[odd]>")).otherwise("")
    return table(spark, folder, "pages").select(
        "url",
        name.alias("profile"),
        status.alias("status"),
        F.concat(section, F.col("html")).alias("html"),
        _fetched_at().alias("fetched_at"),
    )


def forum_payloads(spark: SparkSession, folder: str, profile: str) -> DataFrame:
    """One listing page per document, one post per line."""

    def post(line: Column, i: Column) -> Column:
        number = F.col("doc_id")
        path = F.concat(F.lit("/r/"), number.cast("string"), F.lit("/"), i.cast("string"))
        link = F.when(i % 3 == 1, F.concat(F.lit("https://example.com"), path)).otherwise(path)
        points = F.when(i % 4 == 2, F.lit("•")).otherwise((number - i * 7).cast("string"))
        return F.concat(
            F.lit('<div class="thing link"><p class="head"><a class="title may-blank" href="'),
            link,
            F.lit('">'),
            _escaped(line),
            F.lit("</a></p>"),
            F.when(i % 5 == 3, F.lit("")).otherwise(
                F.concat(F.lit('<a class="author">'), F.col("source"), F.lit("</a>"))
            ),
            F.lit('<div class="score likes" title="0">0</div><div class="score unvoted" title="'),
            points,
            F.lit('">x</div></div>'),
        )

    html = F.concat(
        F.lit("<html><body><script>var a = '</div>';</script><div id=posts>"),
        F.array_join(F.transform(_lines(), post), "\n"),
        F.lit("</div></body></html>"),
    )
    return table(spark, folder, "documents").select(
        F.concat(F.lit("http://forum.example.com/"), F.col("doc_id").cast("string")).alias("url"),
        F.lit(profile).alias("profile"),
        F.lit(200).alias("status"),
        html.alias("html"),
        _fetched_at().alias("fetched_at"),
    )
