"""Listing pages to raw rows: forum sections, news sites, scholarly sites.

A page profile says which elements of a page are items and which parts of an item hold the
fields. Finding elements needs a parser, so that part runs in Python over Arrow batches and
returns the bare field texts; every rule on the fields is a native expression.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contentloom import catalog
from contentloom.functions.dates import page_timestamp
from contentloom.functions.rules import forum_link, parse_score, prefix_link, site_link
from contentloom.functions.text import strip, truncate
from contentloom.operators.quality import REASON, rejected_rows, with_reason
from contentloom.sources.markup import Element, Outline

_BLOCK_COLUMNS = """
    page_url string, profile string, fetched_at timestamp, position int, title string,
    link string, author string, summary string, posted string, score string, error string
"""
#: Pages whose items a task holds before it hands them on.
PAGES_AT_A_TIME = 100


@dataclass(frozen=True)
class PageProfile:
    """Selectors of one kind of page; each field lists the selectors to try in order.

    Without ``title`` selectors the whole block is the title. Without ``link`` selectors the
    link is taken from the title element, from its parent, or from the first link of the block.
    """

    name: str
    source: str
    category: str
    block: tuple[str, ...]
    title: tuple[str, ...] = ()
    link: tuple[str, ...] = ()
    author: tuple[str, ...] = ()
    summary: tuple[str, ...] = ()
    posted: tuple[str, ...] = ()
    score: tuple[str, ...] = ()
    link_prefix: str = ""
    language: str = "en"
    url: str = ""
    limit: int = catalog.ITEMS_PER_SOURCE


def forum_profile(section: str) -> PageProfile:
    part = catalog.FORUM_SELECTORS
    return PageProfile(
        name=f"forum:{section}",
        source=section,
        category=section,
        block=(part["block"],),
        title=(part["title"],),
        link=(part["title"],),
        author=(part["author"],),
        score=(part["score"],),
        url=catalog.FORUM_PAGE_URL.format(section=section),
    )


def news_profile(
    url: str, category: str, block: str, title: str | None, link: str
) -> PageProfile:
    return PageProfile(
        name=f"news:{url}",
        source=url,
        category=category,
        block=(block,),
        title=(title,) if title else (),
        link=(link,),
        summary=(catalog.NEWS_SUMMARY_SELECTOR,),
        url=url,
    )


def scholarly_profile(site: Mapping[str, str]) -> PageProfile:
    """Profile of one site with the common fallbacks behind its own selectors."""
    spare = catalog.FALLBACK_SELECTORS
    any_block = ", ".join(
        f'{tag}[class*="{part}" i]'
        for tag in catalog.GENERAL_BLOCK_TAGS
        for part in catalog.GENERAL_BLOCK_CLASS_PARTS
    )
    return PageProfile(
        name=f"scholarly:{site['name']}",
        source=site["name"],
        category=site["category"],
        block=(site["block"], *spare["block"], any_block),
        title=(site["title"], *spare["title"], catalog.ANY_HEADING_SELECTOR),
        author=(site["author"], *spare["author"]),
        summary=(site["abstract"], *spare["abstract"], "p"),
        posted=(catalog.DATE_SELECTOR, f'[class*="{catalog.DATE_CLASS_PART}" i]'),
        link_prefix=site["link_prefix"],
        language=site["language"],
        url=site["url"],
    )


def forum_profiles() -> list[PageProfile]:
    return [forum_profile(section) for section in catalog.FORUM_SECTIONS]


def news_profiles() -> list[PageProfile]:
    return [
        news_profile(url, category, block, title, link)
        for category, url, block, title, link in catalog.NEWS_SITES
    ]


def scholarly_profiles() -> list[PageProfile]:
    return [scholarly_profile(site) for site in catalog.SCHOLARLY_SITES]


def all_profiles() -> list[PageProfile]:
    return [*forum_profiles(), *news_profiles(), *scholarly_profiles()]


def of_profiles(
    stored: DataFrame, profiles: Iterable[PageProfile], known: Iterable[PageProfile] = ()
) -> DataFrame:
    """Stored pages of some profiles, and those stored without a profile, which an address may give.

    With ``known`` also pages whose profile is none of these. A filter on the column pages are laid out
    by, so the scan skips the folders of all other profiles.
    """
    own, others = F.col("page_profile"), [p.name for p in known]
    wanted = own.isNull() | own.isin(*[p.name for p in profiles])
    return stored.filter(wanted | ~own.isin(*others) if others else wanted)


def with_profiles(pages: DataFrame, profiles: Iterable[PageProfile]) -> DataFrame:
    """Give pages without a profile the one made for their address."""
    entries = [F.lit(text) for p in profiles if p.url for text in (p.url, p.name)]
    found = F.try_element_at(F.create_map(*entries), F.col("url"))
    given = [F.col("profile")] if "profile" in pages.columns else []
    return pages.withColumn("profile", F.coalesce(*given, found))


def _blocks(outline: Outline, profile: PageProfile) -> list[Element]:
    for selector in profile.block:
        found = list(outline.select(selector))
        if found:
            return found[: profile.limit]
    return []


def _link(outline: Outline, block: Element, title: Element, profile: PageProfile) -> str | None:
    if profile.link:
        holder = outline.first(profile.link, block)
        return holder.attrs.get("href") if holder else None
    if title.attrs.get("href"):
        return title.attrs["href"]
    if title.parent is not None and title.parent.attrs.get("href"):
        return title.parent.attrs["href"]
    holder = outline.first(("a",), block)
    return holder.attrs.get("href") if holder else None


def read_page(html: str, profile: PageProfile) -> Iterator[tuple]:
    """Bare fields of every item of a page, None where a part is absent."""
    outline = Outline(html, first=(profile.block[0], profile.limit))

    def text(selectors: tuple[str, ...], block: Element) -> str | None:
        holder = outline.first(selectors, block)
        return outline.text(holder) if holder else None

    for position, block in enumerate(_blocks(outline, profile)):
        title = outline.first(profile.title, block) if profile.title else block
        score = outline.first(profile.score, block)
        yield (
            position,
            outline.text(title) if title else None,
            _link(outline, block, title, profile) if title else None,
            text(profile.author, block),
            text(profile.summary, block),
            text(profile.posted, block),
            score.attrs.get("title") if score else None,
        )


def page_blocks(pages: DataFrame, profiles: Iterable[PageProfile]) -> DataFrame:
    """Items of all fetched pages whose profile is known; a frame of items passes as it is.

    A page that the reader cannot take gives one row without a position and with its ``error``.
    Pages are independent, so they stay where the scan put them. The profiles are a few constants
    per site and travel with the function.
    """
    if "position" in pages.columns:
        return pages
    known = {profile.name: profile for profile in profiles}
    columns = _BLOCK_COLUMNS.replace("\n", " ")
    names = [part.split()[0] for part in columns.split(",")]

    def rows_of(page) -> Iterator[tuple]:
        start = (page.url, page.profile, page.fetched_at)
        try:
            blocks = list(read_page(page.html.decode(), known[page.profile]))
        except Exception as problem:  # whatever one page raises must not fail the others
            yield (*start, *[None] * 7, f"{type(problem).__name__}: {problem}"[:200])
        else:
            for block in blocks:
                yield (*start, *block, None)

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for first in range(0, len(batch), PAGES_AT_A_TIME):
                part = batch.iloc[first : first + PAGES_AT_A_TIME]
                rows = [row for page in part.itertuples(index=False) for row in rows_of(page)]
                found = pd.DataFrame(rows, columns=names)
                yield found.astype({"position": "Int32"})

    return (
        pages.filter(
            (F.col("status") == 200) & F.col("profile").isin(*known) & F.col("html").isNotNull()
        )
        # As bytes: a batch of Python strings takes up to four times its size, and one page is read at a time.
        .select("url", "profile", F.col("html").cast("binary").alias("html"), "fetched_at")
        .mapInPandas(read, columns)
    )


def _items(pages: DataFrame, profiles: Iterable[PageProfile]) -> DataFrame:
    return page_blocks(pages, profiles).filter(F.col("error").isNull())


def unreadable_pages(blocks: DataFrame) -> DataFrame:
    """The pages of ``page_blocks`` that could not be read."""
    return blocks.filter(F.col("error").isNotNull()).select(
        F.col("page_url").alias("origin"),
        F.lit("unreadable page").alias(REASON),
        F.col("error").alias("body"),
    )


def failed_payloads(
    pages: DataFrame, profiles: Iterable[PageProfile], all_profiles: Iterable[PageProfile] = ()
) -> DataFrame:
    """Pages of the given profiles that were not fetched.

    With ``all_profiles`` pages that none of these read are failed too, for want of a profile.
    """
    own, known = [p.name for p in profiles], [p.name for p in all_profiles]
    fetched = (F.col("status") == 200) & F.col("html").isNotNull()
    rules = {"not fetched": ~F.coalesce(fetched, F.lit(False))}
    wanted = F.col("profile").isin(*own)
    if known:
        unknown = ~F.coalesce(F.col("profile").isin(*known), F.lit(False))
        rules = {"unknown profile": unknown, **rules}
        wanted = wanted | unknown
    return rejected_rows(with_reason(pages.filter(wanted), rules)).select(
        F.col("url").alias("origin"), REASON, F.col("html").alias("body")
    )


def _profile_value(profiles: Iterable[PageProfile], attribute: str):
    """Constant of the row's profile as a native lookup."""
    pairs = [F.lit(text) for p in profiles for text in (p.name, getattr(p, attribute))]
    return F.element_at(F.create_map(*pairs), F.col("profile"))


def forum_posts(pages: DataFrame, profiles: Iterable[PageProfile] | None = None) -> DataFrame:
    """Raw post rows of forum listing pages."""
    profiles = list(profiles or forum_profiles())
    absent = catalog.FORUM_DEFAULTS
    return _items(pages, profiles).select(
        _profile_value(profiles, "source").alias("subreddit"),
        F.coalesce("title", F.lit(absent["title"])).alias("title"),
        F.coalesce("author", F.lit(absent["author"])).alias("author"),
        forum_link(F.coalesce("link", F.lit(absent["url"]))).alias("url"),
        parse_score(F.coalesce("score", F.lit(absent["score"]))).alias("score"),
        F.col("fetched_at").alias("created_utc"),
        F.col("fetched_at").alias("extracted_date"),
        "page_url",
        "position",
    )


def news_articles(pages: DataFrame, profiles: Iterable[PageProfile] | None = None) -> DataFrame:
    """Raw article rows of news sites: a title of some length and a link are required."""
    profiles = list(profiles or news_profiles())
    title = strip(F.col("title"))
    return (
        _items(pages, profiles)
        .withColumns({"title": title, "source": _profile_value(profiles, "source")})
        .filter(
            (F.length("title") >= catalog.NEWS_TITLE_MIN_CHARS)
            & F.col("link").isNotNull()
            & (F.col("link") != "")
        )
        .select(
            "source",
            _profile_value(profiles, "category").alias("category"),
            "title",
            truncate(
                F.coalesce(strip(F.col("summary")), F.lit(catalog.NEWS_CONTENT_DEFAULT)),
                catalog.NEWS_CONTENT_CHARS,
            ).alias("content"),
            site_link(F.col("link"), F.col("page_url")).alias("url"),
            F.col("fetched_at").alias("published_date"),
            F.col("fetched_at").alias("extracted_date"),
            "page_url",
            "position",
        )
        .filter(F.col("url").isNotNull())
    )


def scholarly_articles(
    pages: DataFrame, profiles: Iterable[PageProfile] | None = None
) -> DataFrame:
    """Raw scholarly rows of technology and science sites."""
    profiles = list(profiles or scholarly_profiles())
    return (
        _items(pages, profiles)
        .withColumns(
            {
                "title": strip(F.col("title")),
                "summary": strip(F.col("summary")),
                "source": _profile_value(profiles, "source"),
            }
        )
        .filter((F.col("title") != "") & (F.col("link") != ""))
        .select(
            "source",
            _profile_value(profiles, "category").alias("category"),
            "title",
            F.coalesce(
                strip(F.col("author")),
                F.concat(F.lit(catalog.UNKNOWN_AUTHOR_PREFIX), F.col("source")),
            ).alias("authors"),
            truncate(
                F.when(F.col("summary") != "", F.col("summary")).otherwise(
                    F.concat(F.lit(catalog.NO_ABSTRACT_PREFIX), F.col("source"))
                ),
                catalog.ABSTRACT_CHARS,
            ).alias("abstract"),
            prefix_link(F.col("link"), _profile_value(profiles, "link_prefix")).alias("url"),
            F.when(F.col("posted").isNull(), F.col("fetched_at"))
            .otherwise(page_timestamp(strip(F.col("posted")), F.col("fetched_at")))
            .alias("published_date"),
            F.col("fetched_at").alias("extracted_date"),
            _profile_value(profiles, "language").alias("language"),
            "page_url",
            "position",
        )
    )
