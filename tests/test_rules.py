import datetime as dt

from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from contentloom.functions import dates, rules
from tests.test_text import few


def test_popularity_level(apply):
    scores = [None, -5, 100, 101, 1000, 1001]
    assert apply(rules.popularity_level, scores, "int") == [
        "low",
        "low",
        "low",
        "medium",
        "medium",
        "high",
    ]


def test_author_count(spark, apply):
    values = ["", "a", "a,b", "a,b,", None]
    for ansi in ("true", "false"):
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        assert apply(rules.author_count, values) == [1, 1, 2, 3, None]
    spark.conf.set("spark.sql.ansi.enabled", "true")


def test_guess_category(apply):
    cases = {
        "Git for science": "programming",
        "He said so": "technology",
        "Physics": "science",
        "Market day": "business",
        "Hello": "general",
        "": "general",
    }
    assert apply(rules.guess_category, cases) == list(cases.values())


def test_site_link(apply):
    cases = {
        "/p": "https://a.com/p",
        "p": "https://a.com/p",
        "http://b/": "http://b/",
        "": "https://a.com/",
    }
    assert apply(lambda c: rules.site_link(c, F.lit("https://a.com/x")), cases) == list(cases.values())
    assert apply(lambda c: rules.site_link(c, F.lit("nowhere")), ["/p", "https://b"]) == [
        None,
        "https://b",
    ]


def test_prefix_link(apply):
    cases = {"p": "/p", "/p": "/p", "https://x": "https://x"}
    assert apply(lambda c: rules.prefix_link(c, F.lit("")), cases) == list(cases.values())


def test_forum_link(apply):
    cases = {"/r/x": "https://reddit.com/r/x", "": "", "http://x": "http://x", "r": "https://reddit.comr"}
    assert apply(rules.forum_link, cases) == list(cases.values())


@few
@given(links=st.lists(st.text(max_size=20), min_size=1, max_size=40))
def test_site_links_are_absolute(apply, links):
    assert all(
        link.startswith("http")
        for link in apply(lambda c: rules.site_link(c, F.lit("https://a.com/x")), links)
    )


def test_parse_score(apply):
    cases = {
        "+5": 5,
        " 7 ": 7,
        "-3": -3,
        "•": 0,
        "": 0,
        None: 0,
        "1_000": 1000,
        "_1": 0,
        "1__0": 0,
        "3.7": 0,
        "99999999999": 0,
        " 12\t": 12,
    }
    assert apply(rules.parse_score, cases) == list(cases.values())


FETCHED = dt.datetime(2024, 1, 30, 6)


def utc(*parts):
    return dt.datetime(*parts)


def as_text(column):
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss")


def test_feed_timestamp(apply):
    cases = {
        "Mon, 02 Jan 2023 10:00:00 +0000": "2023-01-02 10:00:00",
        "Tue, 3 Jan 2023 10:00:00 -0500": "2023-01-03 15:00:00",
        "Tue, 03 Jan 2023 10:00:00 +02:00": "2023-01-03 08:00:00",
        "tue, 03 Jan 2023 9:05:00 Z": "2023-01-03 09:05:00",
        "Mon, 02 Jan 2023 10:00:00 GMT": "2024-01-30 06:00:00",
        "02 Jan 2023 10:00:00 +0000": "2024-01-30 06:00:00",
        "junk": "2024-01-30 06:00:00",
        "2023-01-02": "2023-01-02 00:00:00",
        "2023-01-02T10:00:00Z": "2023-01-02 10:00:00",
        "2023-01-02T10:00:00+02:00": "2023-01-02 08:00:00",
        "2023-01-02 rest": "2023-01-02 00:00:00",
        "2023-99-99": None,
    }
    default = F.lit("2024-01-30 06:00:00").cast("timestamp")
    assert apply(lambda c: as_text(dates.feed_timestamp(c, default)), cases) == list(cases.values())


def test_any_mail_timestamp(apply):
    cases = {
        "Mon, 02 Jan 2023 10:00:00 GMT": "2023-01-02 10:00:00",
        "Mon, 02 Jan 2023 10:00:00 EST": "2023-01-02 15:00:00",
        "02 Jan 2023 10:00:00 +0100": "2023-01-02 09:00:00",
        "Mon, 02 Jan 2023 10:00:00 XYZ": None,
        "junk": None,
        None: None,
    }
    assert apply(lambda c: as_text(dates.any_mail_timestamp(c)), cases) == list(cases.values())


def test_page_timestamp(apply):
    cases = {"2023-01-02 rest": "2023-01-02 00:00:00", "Jan 2": "2024-01-30 06:00:00"}
    default = F.lit("2024-01-30 06:00:00").cast("timestamp")
    assert apply(lambda c: as_text(dates.page_timestamp(c, default)), cases) == list(cases.values())


def test_recent(apply):
    days = [dt.date(2024, 1, d) for d in (27, 26)] + [dt.date(2024, 2, 1), None]
    as_of = dates.as_date("2024-01-30")
    assert apply(lambda c: dates.recent(c, as_of, 3), days, "date") == [True, False, True, None]


def test_epoch_timestamp(apply):
    assert apply(lambda c: as_text(dates.epoch_timestamp(c)), [0, 1704067200], "bigint") == [
        "1970-01-01 00:00:00",
        "2024-01-01 00:00:00",
    ]
