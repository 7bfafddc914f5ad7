"""Feed payloads (RSS, RDF, Atom) to raw rows, parsed by Spark's own XML reader."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contentloom import catalog
from contentloom.functions.dates import any_mail_timestamp, feed_timestamp, iso_timestamp
from contentloom.functions.text import looks_like_markup, strip, truncate
from contentloom.operators.quality import REASON, rejected_rows, with_reason
from contentloom.sources.markup import page_text

#: Tags of which each may stand for a field; what an item has of them is read in full.
_AUTHORS = ("author", "dc:creator")
_ABSTRACTS = ("description", "content:encoded", "summary")
_PUBLISHED = ("pubDate", "dc:date", "published")
_ITEM = f"""struct<
    title: string, link: string,
    {", ".join(f"`{name}`: array<string>" for name in (*_AUTHORS, *_ABSTRACTS, *_PUBLISHED))},
    guid: struct<_VALUE: string, _isPermaLink: string>>"""
_ENTRY = """struct<
    title: string, link: array<struct<_href: string, _rel: string>>, summary: string,
    content: string, published: string>"""
_FEED = f"""
    channel struct<title: string, item: array<{_ITEM}>>, item array<{_ITEM}>,
    title string, entry array<{_ENTRY}>, _malformed string
""".replace("\n", " ")
_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_malformed"}


@F.pandas_udf(T.StringType())
def _markup_text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in batches:
        yield batch.map(page_text, na_action="ignore")


def markup_to_text(text: Column) -> Column:
    """Text of strings that hold markup; others pass as they are and never reach Python."""
    marked = looks_like_markup(text)
    return F.when(marked, strip(_markup_text(F.when(marked, text)))).otherwise(text)


def parse_feeds(payloads: DataFrame) -> DataFrame:
    """Feed payloads with the parsed document in ``feed``.

    A body that is no well-formed XML has its text in ``feed._malformed``. Exploding an array of
    one keeps later filters from being pushed below the parser, which would parse twice. A parsed
    frame passes as it is.
    """
    if "feed" in payloads.columns:
        return payloads
    parsed = F.from_xml(F.col("body"), _FEED, _OPTIONS)
    return payloads.select("*", F.explode(F.array(parsed)).alias("feed"))


def well_formed() -> Column:
    return F.col("feed").isNotNull() & F.col("feed._malformed").isNull()


def with_details(payloads: DataFrame, known: Iterable[Mapping[str, str]]) -> DataFrame:
    """Fill in name, category and language of fetched feeds from the list of known feeds.

    The list is a constant of a few entries, looked up by address without a join.
    """
    known = list(known)
    filled = {}
    for name in ("source_name", "category", "language"):
        values = {feed["feed_url"]: feed[name] for feed in known if name in feed}
        listed = F.create_map(*[F.lit(text) for pair in values.items() for text in pair])
        found = F.try_element_at(listed, F.col("feed_url")) if values else F.lit(None)
        given = [F.col(name)] if name in payloads.columns else []
        filled[name] = F.coalesce(*given, found.cast("string"))
    return payloads.withColumns(filled)


def news_feeds() -> list[dict[str, str]]:
    return [{"feed_url": url, "category": category} for category, url in catalog.NEWS_FEEDS]


def scholarly_feeds() -> list[dict[str, str]]:
    return [
        {"feed_url": url, "source_name": name, "category": category, "language": language}
        for name, url, category, language in catalog.SCHOLARLY_FEEDS
    ]


def payload_rules(fetched_only: bool) -> dict[str, Column]:
    """Why a parsed payload gives no rows. News feeds are read whatever their status."""
    rules = {"not fetched": F.coalesce(F.col("status") != 200, F.lit(True))} if fetched_only else {}
    return {**rules, "malformed": ~well_formed()}


def failed_payloads(payloads: DataFrame, fetched_only: bool) -> DataFrame:
    checked = with_reason(parse_feeds(payloads), payload_rules(fetched_only))
    return rejected_rows(checked).select(F.col("feed_url").alias("origin"), REASON, "body")


def _one_per_row(feeds: DataFrame, items: Column) -> DataFrame:
    """Items of every feed, one per row, with their position."""
    return feeds.select(
        *[c for c in feeds.columns if c not in ("feed", "body", "structure")],
        F.col("feed.channel.title").alias("channel_title"),
        F.col("feed.title").alias("feed_title"),
        F.posexplode(items).alias("position", "item"),
    )


def _last(values: Column) -> Column:
    return F.try_element_at(values, F.lit(-1))


def _news_items(limit: int) -> Column:
    """The first RSS, RDF or Atom items of a feed in one shape.

    The unique id of an RSS item doubles as its link unless it is marked as no permanent link.
    """

    def from_item(item: Column) -> Column:
        guid = item["guid"]
        is_link = F.coalesce(guid["_isPermaLink"], F.lit("true")) == "true"
        return F.struct(
            item["title"].alias("title"),
            F.coalesce(item["link"], F.when(is_link, guid["_VALUE"])).alias("link"),
            F.coalesce(*[_last(item[name]) for name in _ABSTRACTS]).alias("content"),
            F.coalesce(_last(item["pubDate"]), _last(item["published"])).alias("published"),
        )

    def from_entry(entry: Column) -> Column:
        alternate = F.filter(
            entry["link"],
            lambda link: F.coalesce(link["_rel"], F.lit("alternate")) == "alternate",
        )
        return F.struct(
            entry["title"].alias("title"),
            F.get(alternate, F.lit(0))["_href"].alias("link"),
            F.coalesce(entry["summary"], entry["content"]).alias("content"),
            entry["published"].alias("published"),
        )

    return F.coalesce(
        F.transform(F.slice("feed.channel.item", 1, limit), from_item),
        F.transform(F.slice("feed.item", 1, limit), from_item),
        F.transform(F.slice("feed.entry", 1, limit), from_entry),
    )


def news_articles(payloads: DataFrame, limit: int = catalog.ITEMS_PER_SOURCE) -> DataFrame:
    """Raw article rows of news feeds. Defaults stand for absent fields, not for empty ones.

    ``published_date`` is NULL where a date is given that cannot be read.
    """
    absent = catalog.FEED_DEFAULTS
    feeds = parse_feeds(payloads).filter(well_formed())
    published = strip(F.col("item.published"))
    return _one_per_row(feeds, _news_items(limit)).select(
        F.coalesce("channel_title", "feed_title", F.lit(absent["source"])).alias("source"),
        "category",
        F.coalesce("item.title", F.lit(absent["title"])).alias("title"),
        F.coalesce("item.content", F.lit(absent["content"])).alias("content"),
        F.coalesce("item.link", F.lit(absent["url"])).alias("url"),
        F.when(published.isNull(), F.col("fetched_at"))
        .otherwise(F.coalesce(iso_timestamp(published), any_mail_timestamp(published)))
        .alias("published_date"),
        F.col("fetched_at").alias("extracted_date"),
        "feed_url",
        "position",
    )


#: A document of which only the structure is wanted: each item is its own source, without text that
#: could look like a tag.
_ORDER = "channel struct<item: array<string>>, item array<string>, _malformed string"
_TAG_LIKE = r"(?s)<!\[CDATA\[.*?\]\]>|&(?:lt|#0*60|#[xX]0*3[cC]);"


def _several(*names: str) -> Column:
    """Whether two of the tags or more stand in a feed, so that their order may matter."""
    return sum(F.col("body").contains(f"<{name}").cast("int") for name in names) > 1


def _structure() -> Column:
    """The items of a feed as source, by the same parser and so in the same places; NULL where no two
    tags stand for one field."""
    matters = _several(*_AUTHORS) | _several(*_ABSTRACTS) | _several(*_PUBLISHED)
    return F.when(matters, F.from_xml(F.regexp_replace("body", _TAG_LIKE, ""), _ORDER, _OPTIONS))


def _first_tag(*names: str) -> Column:
    """The text of whichever of the tags comes first in the item, NULL if it has none."""
    found = F.regexp_extract("source", "<(" + "|".join(names) + r")[\s/>]", 1)
    texts = {name: F.get(F.col("item")[name], F.lit(0)) for name in names}
    chosen = F.coalesce(*texts.values())
    for name, text in texts.items():
        chosen = F.when(found == name, F.coalesce(text, F.lit(""))).otherwise(chosen)
    return strip(chosen)


def _items_with_source(limit: int) -> Column:
    """The first items of a feed, each with its own source."""
    items = F.slice(F.coalesce("feed.channel.item", "feed.item"), 1, limit)
    sources = F.slice(F.coalesce("structure.channel.item", "structure.item"), 1, limit)
    return F.transform(items, lambda item, i: F.struct(item.alias("item"), F.get(sources, i).alias("source")))


def scholarly_articles(payloads: DataFrame, limit: int = catalog.ITEMS_PER_SOURCE) -> DataFrame:
    """Raw scholarly rows of RSS and RDF feeds; items without title or link are skipped.

    Of tags that stand for the same field the first in the item counts, and of equal ones the first.
    """
    feeds = parse_feeds(payloads.filter("status = 200")).filter(well_formed())
    # Exploded for the same reason as the parsed document.
    feeds = feeds.select("*", F.explode(F.array(_structure())).alias("structure"))

    def first_of(*names: str) -> Column:
        return strip(F.coalesce(*[F.col("item")[name] for name in names]))

    abstract = F.coalesce(
        _first_tag(*_ABSTRACTS),
        F.concat(F.lit(catalog.NO_ABSTRACT_PREFIX), F.col("source_name")),
    )
    published = _first_tag(*_PUBLISHED)
    return (
        _one_per_row(feeds, _items_with_source(limit))
        .select("*", F.col("item.source").alias("source"), F.col("item.item").alias("entry"))
        .drop("item")
        .withColumnRenamed("entry", "item")
        .filter((first_of("title") != "") & (first_of("link") != ""))
        .select(
            F.col("source_name").alias("source"),
            "category",
            first_of("title").alias("title"),
            F.coalesce(
                _first_tag(*_AUTHORS),
                F.concat(F.lit(catalog.UNKNOWN_AUTHOR_PREFIX), F.col("source_name")),
            ).alias("authors"),
            abstract.alias("abstract"),
            first_of("link").alias("url"),
            F.when(published.isNull(), F.col("fetched_at"))
            .otherwise(feed_timestamp(published, F.col("fetched_at")))
            .alias("published_date"),
            F.col("fetched_at").alias("extracted_date"),
            "language",
            "feed_url",
            "position",
        )
        .withColumn(
            "abstract", truncate(markup_to_text(F.col("abstract")), catalog.ABSTRACT_CHARS)
        )
    )
