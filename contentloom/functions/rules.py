"""Row rules: popularity, author count, category guess, links, scores."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from contentloom.catalog import CATEGORY_RULES, DEFAULT_CATEGORY, FORUM_LINK_PREFIX
from contentloom.functions.text import strip


def popularity_level(score: Column) -> Column:
    return (
        F.when(score > 1000, F.lit("high")).when(score > 100, F.lit("medium")).otherwise(F.lit("low"))
    )


def author_count(authors: Column) -> Column:
    """Number of comma separated parts; NULL for NULL whatever the ANSI setting."""
    return F.array_size(F.split(authors, ","))


def guess_category(title: Column) -> Column:
    """First rule one of whose keywords occurs anywhere in the lower-cased title."""
    lowered = F.lower(title)
    chain = F
    for category, keywords in CATEGORY_RULES:
        chain = chain.when(reduce(or_, [lowered.contains(k) for k in keywords]), F.lit(category))
    return chain.otherwise(F.lit(DEFAULT_CATEGORY))


def is_absolute(link: Column) -> Column:
    return link.startswith("http://") | link.startswith("https://")


def prefix_link(link: Column, prefix: Column) -> Column:
    """Relative links get ``prefix`` and, when missing, a slash between the two."""
    rooted = F.when(link.startswith("/"), link).otherwise(F.concat(F.lit("/"), link))
    return F.when(is_absolute(link), link).otherwise(F.concat(prefix, rooted))


def site_root(url: Column) -> Column:
    """``scheme://host`` of a page address, NULL when there is none."""
    return F.nullif(F.regexp_extract(url, r"^(https?://[^/]+)", 1), F.lit(""))


def site_link(link: Column, page_url: Column) -> Column:
    return prefix_link(link, site_root(page_url))


def forum_link(link: Column) -> Column:
    """Relative forum links get the constant prefix; an empty link stays empty."""
    return F.when(is_absolute(link) | (link == ""), link).otherwise(
        F.concat(F.lit(FORUM_LINK_PREFIX), link)
    )


def parse_score(text: Column) -> Column:
    """Integer value of the text, 0 when it is none. Single underscores may group digits."""
    digits = F.regexp_replace(strip(text), r"(?<=\d)_(?=\d)", "")
    whole = F.when(digits.rlike(r"^[+-]?\d+$"), digits)
    return F.coalesce(whole.try_cast("int"), F.lit(0))
