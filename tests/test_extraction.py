"""Markup outline, feeds, stories, pages."""

import datetime as dt
import json

import pytest

from contentloom import catalog
from contentloom.schemas import schema
from contentloom.sources import feeds, pages, stories
from contentloom.sources.markup import Outline, compile_selector, page_text

FETCHED = dt.datetime(2024, 1, 30, 6)

HTML = """
<html><head><style>p{x}</style><script>var t = "</p><article>";</script></head><body>
<div class="Big card  news"><h2><a href="/one">One &amp; <b>only</b></a></h2><br>
  <p class="x">First<p>Second</p>
  <span class="score unvoted" title="5">5</span></div>
<!-- <article>hidden</article> -->
<article id=a><ul><li><a class="title">L1</a></li><li>L2</ul></article>
</body></html>
"""


def texts(selector, scope=None, html=HTML):
    outline = Outline(html)
    within = outline.first((scope,)) if scope else None
    return [" ".join(outline.text(e).split()) for e in outline.select(selector, within)]


def test_selectors():
    assert texts("h2 a") == texts("h2 > a") == texts("div h2>a") == ["One & only"]
    assert texts("div > a") == []
    assert texts(".card a") == texts("div.card.news a") == ["One & only"]
    assert texts("li, h2") == ["One & only", "L1", "L2"]
    assert texts("a.title", scope="article") == ["L1"]
    assert texts("a", scope="article") == ["L1"]
    assert texts("body li", scope="article") == ["L1", "L2"]
    assert texts('span[class="score unvoted"]') == ["5"]
    assert texts('span[class="unvoted score"]') == []
    assert texts('div[class*="CAR" i], li[class*="x" i]') != []
    assert texts("p") == ["FirstSecond 5", "Second"]


def test_outline_text():
    text = page_text(HTML)
    assert "hidden" not in text and "var t" not in text and "p{x}" not in text
    assert page_text("a<br/>b &lt;c&gt; <![CDATA[d]]>") == "ab <c> d"
    assert page_text("x</p>y<template>no</template>") == "xy"


def test_descendants_stay_in_their_block():
    outline = Outline(HTML)
    block = outline.first(("div.card",))
    assert outline.first(("li",), block) is None
    assert outline.first(("span",), block).parent.tag == "p"


@pytest.mark.parametrize("selector", ["", "a,", "a:hover", "#id", "a + b"])
def test_unsupported_selectors_are_refused(selector):
    with pytest.raises(ValueError):
        compile_selector(selector)


def test_reading_ends_after_the_first_matches():
    html = '<div class="p"><b>1</b><div class="p"><b>2</b></div>x</div><br><div class="p">3</div><i>'
    for count in range(5):
        whole, part = Outline(html), Outline(html, first=("div.p", count))
        expected = [whole.text(e) for e in whole.select("div.p")][:count]
        assert [part.text(e) for e in part.select("div.p")][:count] == expected
    assert [e.tag for e in Outline(html, first=("div.p", 2)).elements] == ["div", "b", "div", "b"]
    assert Outline(html, first=("br", 1)).elements[-1].tag == "br"
    assert Outline(html, first=("u", 1)).elements[-1].tag == "i"
    unclosed = Outline("<div><p>a<p>b", first=("p", 2))
    assert [unclosed.text(e) for e in unclosed.select("p")] == ["ab", "b"]


def test_early_end_changes_no_row(monkeypatch):
    page = "<ul>" + "".join(
        f'<li class="thing item"><a class="title" href="/{i}">Title number {i}</a><p>t<p>u'
        for i in range(30)
    )
    own = pages.PageProfile(name="own", source="s", category="c", block=("li",), title=("a",))
    profiles = [own] + pages.forum_profiles()[:1] + pages.news_profiles() + pages.scholarly_profiles()
    early = [list(pages.read_page(page, p)) for p in profiles]
    monkeypatch.setattr(pages, "Outline", lambda html, first: Outline(html))
    assert early == [list(pages.read_page(page, p)) for p in profiles]
    assert sum(map(len, early)) > 0


def test_all_profiles_compile():
    for profile in pages.forum_profiles() + pages.news_profiles() + pages.scholarly_profiles():
        for part in ("block", "title", "link", "author", "summary", "posted", "score"):
            for selector in getattr(profile, part):
                compile_selector(selector)


def feed(spark, *bodies, status=200):
    return spark.createDataFrame(
        [(f"http://f/{i}", "NAME", "cat", "he", status, b, FETCHED) for i, b in enumerate(bodies)],
        schema("news_feed_payloads"),
    )


def item(**parts):
    return "<item>" + "".join(f"<{k.replace('__', ':')}>{v}</{k.replace('__', ':')}>" for k, v in parts.items()) + "</item>"


def rss(*items, title="<title>T</title>"):
    return (
        '<?xml version="1.0"?><rss xmlns:dc="d" xmlns:content="c" xmlns:atom="a"><channel>'
        f'{title}<atom:link href="self"/>{"".join(items)}</channel></rss>'
    )


def test_news_feed(spark):
    body = rss(
        item(title="A &amp; b", description="D", link="http://l", pubDate="Mon, 02 Jan 2023 10:00:00 GMT"),
        item(),
        item(title="", summary="S", published="2023-01-02T01:00:00Z", guid="http://g"),
        item(title="bad", pubDate="yesterday").replace(
            "</item>", '<guid isPermaLink="false">7</guid></item>'
        ),
    )
    rows = feeds.news_articles(feed(spark, body)).orderBy("position").collect()
    assert [(r.source, r.title, r.content, r.url) for r in rows] == [
        ("T", "A & b", "D", "http://l"),
        ("T", "No title", "No content", "No URL"),
        ("T", "", "S", "http://g"),
        ("T", "bad", "No content", "No URL"),
    ]
    assert [r.published_date for r in rows] == [
        dt.datetime(2023, 1, 2, 10),
        FETCHED,
        dt.datetime(2023, 1, 2, 1),
        None,
    ]


def test_atom_and_rdf_feeds(spark):
    atom = """<feed xmlns="http://www.w3.org/2005/Atom"><title>Atom</title><entry><title>E</title>
      <link rel="self" href="http://s"/><link href="http://l"/><summary>S</summary>
      <published>2023-01-02T00:00:00Z</published></entry><entry><content>C</content></entry></feed>"""
    rdf = f"<RDF><channel><title>Rdf</title></channel>{item(title='R', link='http://r')}</RDF>"
    rows = feeds.news_articles(feed(spark, atom, rdf)).orderBy("feed_url", "position").collect()
    assert [(r.source, r.title, r.content, r.url) for r in rows] == [
        ("Atom", "E", "S", "http://l"),
        ("Atom", "No title", "C", "No URL"),
        ("Rdf", "R", "No content", "http://r"),
    ]
    assert [r.title for r in feeds.scholarly_articles(feed(spark, atom, rdf)).collect()] == ["R"]


def test_untitled_feed(spark):
    body = rss(item(title="x"), title="")
    assert feeds.news_articles(feed(spark, body)).first().source == "Unknown"


def test_scholarly_feed(spark):
    def entry(**parts):
        return item(**{"title": " T ", "link": " http://l ", **parts})

    body = rss(
        entry(author=" A ", description="plain"),
        entry(dc__creator="C", content__encoded="<![CDATA[<p>x &lt; <b>y</b></p> ]]>"),
        entry(summary="&lt;i&gt;z&lt;/i&gt;", pubDate="Mon, 02 Jan 2023 10:00:00 GMT"),
        entry(description="a > b", published="2023-01-02"),
        entry(description="d" * 1500),
        item(title="  ", link="http://l"),
        item(title="no link"),
    )
    rows = feeds.scholarly_articles(feed(spark, body)).orderBy("position").collect()
    assert [(r.title, r.url, r.language, r.source) for r in rows] == [
        ("T", "http://l", "he", "NAME")
    ] * 5
    assert [r.authors for r in rows[:3]] == ["A", "C", "Unknown author - NAME"]
    assert [r.abstract for r in rows] == ["plain", "x < y", "z", "a > b", "d" * 1000]
    assert rows[2].published_date == FETCHED and rows[3].published_date == dt.datetime(2023, 1, 2)


def test_missing_abstract(spark):
    body = rss(item(title="t", link="l"))
    assert feeds.scholarly_articles(feed(spark, body)).first().abstract == (
        "No abstract available - NAME"
    )


def test_first_items_are_taken_before_rows_are_skipped(spark):
    body = rss(*[item(title=f"t{i}", link="" if i == 3 else "l") for i in range(12)])
    titles = [r.title for r in feeds.scholarly_articles(feed(spark, body)).orderBy("position").collect()]
    assert titles == [f"t{i}" for i in range(10) if i != 3]
    assert feeds.news_articles(feed(spark, body)).count() == 10


def test_failed_feeds(spark):
    good = rss(item(title="t", link="l"))
    payloads = feed(spark, good, good[:-6], "<html><body>x", "", None)
    assert feeds.news_articles(payloads).count() == 1
    failed = feeds.failed_payloads(payloads, fetched_only=False).collect()
    assert {(r.origin[-1], r.reject_reason) for r in failed} == {(str(i), "malformed") for i in (1, 2, 3, 4)}
    refused = feed(spark, good, status=503)
    assert feeds.scholarly_articles(refused).count() == 0
    failed = feeds.failed_payloads(refused, fetched_only=True).collect()
    assert [r.reject_reason for r in failed] == ["not fetched"]
    assert feeds.news_articles(refused).count() == 1
    assert feeds.failed_payloads(refused, fetched_only=False).count() == 0


def test_feed_is_parsed_once(spark):
    df = feeds.scholarly_articles(feed(spark, rss(item(title="t", link="l"))))
    plan = df._jdf.queryExecution().executedPlan().toString()
    # Once for the values and, only where several tags stand for one field, once for their order.
    assert plan.count("from_xml(") == 2 and plan.count("THEN from_xml(") == 1


def test_plain_text_does_not_go_to_python(spark):
    df = spark.createDataFrame([("plain",), ("<b>x</b>",), (None,), ("a < b",)], "t string")
    assert [r.t for r in df.select(feeds.markup_to_text(df.t).alias("t")).collect()] == [
        "plain",
        "x",
        None,
        "a < b",
    ]


def test_stories(spark):
    def payload(pos, story):
        return pos, 1000 + pos, story if isinstance(story, str) else json.dumps(story), FETCHED

    df = spark.createDataFrame(
        [
            payload(0, {"title": "Git for science", "by": "me", "url": "http://u", "score": 7, "time": 60}),
            payload(1, {"title": "Hello"}),
            payload(2, {"by": "me"}),
            payload(3, "null"),
            payload(4, "{broken"),
            payload(49, {"title": "last"}),
            payload(50, {"title": "too late"}),
        ],
        schema("story_payloads"),
    )
    rows = stories.story_posts(df).orderBy("story_id").collect()
    assert [(r.subreddit, r.title, r.author, r.url, r.score) for r in rows] == [
        ("programming", "Git for science", "me", "http://u", 7),
        ("general", "Hello", "anonymous", "https://news.ycombinator.com/item?id=1001", 0),
        ("general", "last", "anonymous", "https://news.ycombinator.com/item?id=1049", 0),
    ]
    assert rows[0].created_utc == dt.datetime(1970, 1, 1, 0, 1)
    failed = stories.failed_payloads(df).collect()
    assert {r.origin for r in failed} == {"1002", "1003", "1004"}
    plan = stories.story_posts(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(") == 1


def page(spark, profile, *htmls, url="https://a.com/list", status=200):
    return spark.createDataFrame(
        [(url, profile.name, status, html, FETCHED) for html in htmls], schema("page_payloads")
    )


def test_forum_page(spark):
    profile = pages.forum_profile("science")
    html = """<div class="thing a"><a class="title x" href="/r/x"> T </a><a class="author">me</a>
      <div class="score unvoted" title="42">42</div></div>
      <div class="thing"><a class="other">n</a><div class="score likes" title="9">9</div></div>
      <div class="nothing"><a class="title">skip</a></div>
      <div class="thing"><a class="title" href="https://b/">B</a>
      <div class="score unvoted" title="•">•</div></div>"""
    rows = pages.forum_posts(page(spark, profile, html)).orderBy("position").collect()
    assert [(r.subreddit, r.title, r.author, r.url, r.score) for r in rows] == [
        ("science", " T ", "me", "https://reddit.com/r/x", 42),
        ("science", "No title", "Unknown", "", 0),
        ("science", "B", "Unknown", "https://b/", 0),
    ]
    assert rows[0].created_utc == FETCHED


def test_first_blocks_of_a_page(spark):
    profile = pages.forum_profile("news")
    html = "".join(f'<div class="thing"><a class="title">t{i}</a></div>' for i in range(12))
    df = pages.forum_posts(page(spark, profile, html))
    assert [r.title for r in df.orderBy("position").collect()] == [f"t{i}" for i in range(10)]


def test_news_page(spark):
    profile = next(p for p in pages.news_profiles() if p.source == "https://techcrunch.com")
    html = f"""<article><h3>Long enough title</h3><a href="/p">x</a><div class="excerpt">E</div></article>
      <article><h2>too short</h2><a href="/p">x</a></article>
      <article><h2>No link in this one</h2><a>x</a></article>
      <article><h2>ten chars!</h2><a href="q">x</a><p>{"c" * 600}</p></article>
      <article><h2>Absolute link here</h2><a href="http://b/">x</a></article>
      <article><a href="/p">Title is not in a heading</a></article>"""
    rows = pages.news_articles(page(spark, profile, html)).orderBy("position").collect()
    assert [(r.title, r.content, r.url) for r in rows] == [
        ("Long enough title", "E", "https://a.com/p"),
        ("ten chars!", "c" * 500, "https://a.com/q"),
        ("Absolute link here", "No content preview available", "http://b/"),
    ]
    assert {(r.source, r.category) for r in rows} == {("https://techcrunch.com", "technology")}


def test_block_itself_is_the_title(spark):
    profile = next(p for p in pages.news_profiles() if not p.title)
    html = '<h2> <a href="/x">The whole heading</a> </h2>'
    assert pages.news_articles(page(spark, profile, html)).first().title == "The whole heading"


def scholarly(spark, html, name="Nature"):
    profile = next(p for p in pages.scholarly_profiles() if p.source == name)
    return pages.scholarly_articles(page(spark, profile, html)).orderBy("position").collect()


def test_scholarly_page(spark):
    html = """<article><h3><a href="/one"> One </a></h3><ul class="c-author-list"> A, B </ul>
        <div class="c-card__summary">S1</div><time>2023-01-02</time></article>
      <article><h2><a href="two">Two</a></h2><span class="by">C</span><p>S2</p>
        <div class="pubDate">Jan 2</div></article>
      <article><a href="/outer"><h4>Three</h4></a></article>
      <article><h5>Four</h5><a href="/four">x</a><p> </p></article>
      <article><h5>No link</h5></article>
      <article><h3><a href="/blank"> </a></h3><h2>skipped</h2></article>
      <article><p>no heading</p></article>"""
    rows = scholarly(spark, html)
    assert [(r.title, r.authors, r.abstract, r.url) for r in rows] == [
        ("One", "A, B", "S1", "https://www.nature.com/one"),
        ("Two", "C", "S2", "https://www.nature.com/two"),
        ("Three", "Unknown author - Nature", "No abstract available - Nature",
         "https://www.nature.com/outer"),
        ("Four", "Unknown author - Nature", "No abstract available - Nature",
         "https://www.nature.com/four"),
    ]
    assert [r.published_date for r in rows[:3]] == [dt.datetime(2023, 1, 2), FETCHED, FETCHED]
    assert {(r.category, r.language) for r in rows} == {("science", "en")}


def test_scholarly_block_fallbacks(spark):
    block = '<h3><a href="/x">T</a></h3>'
    assert [r.title for r in scholarly(spark, f'<div class="post">{block}</div>')] == ["T"]
    assert [r.title for r in scholarly(spark, f'<div class="my-CARD-2">{block}</div>')] == ["T"]
    assert scholarly(spark, f'<div class="other">{block}</div>') == []
    hebrew = scholarly(spark, f"<article>{block}</article>", name="Globes Tech")[0]
    assert (hebrew.language, hebrew.url) == ("he", "https://www.globes.co.il/x")


def test_failed_pages(spark):
    profile = pages.forum_profile("news")
    html = '<div class="thing"><a class="title">t</a></div>'
    assert pages.forum_posts(page(spark, profile, html, None)).count() == 1
    missing = pages.failed_payloads(page(spark, profile, html, None), [profile]).collect()
    assert [r.reject_reason for r in missing] == ["not fetched"]
    refused = page(spark, profile, html, status=404)
    assert pages.forum_posts(refused).count() == 0
    assert pages.failed_payloads(refused, [profile]).first().reject_reason == "not fetched"
    stranger = pages.PageProfile(name="unknown", source="s", category="c", block=("a",))
    assert pages.forum_posts(page(spark, stranger, html)).count() == 0


def test_feed_details_by_address(spark):
    addresses = [("https://www.wired.com/feed/rss", None), ("http://other", "kept")]
    df = spark.createDataFrame(addresses, "feed_url string, category string")
    rows = feeds.with_details(df, feeds.news_feeds()).collect()
    assert [(r.category, r.source_name, r.language) for r in rows] == [
        ("technology", None, None),
        ("kept", None, None),
    ]
    ieee = spark.createDataFrame([("https://spectrum.ieee.org/feeds/feed.rss",)], "feed_url string")
    row = feeds.with_details(ieee, feeds.scholarly_feeds()).first()
    assert (row.source_name, row.category, row.language) == ("IEEE Spectrum", "computing", "en")


def test_profiles_by_address(spark):
    profiles = pages.forum_profiles() + pages.news_profiles() + pages.scholarly_profiles()
    assert len({p.url for p in profiles}) == len({p.name for p in profiles}) == len(profiles)
    df = spark.createDataFrame(
        [("https://old.reddit.com/r/news/hot/", None), ("https://techcrunch.com/", None), ("x", "own")],
        "url string, profile string",
    )
    assert [r.profile for r in pages.with_profiles(df, profiles).collect()] == [
        "forum:news",
        "scholarly:TechCrunch",
        "own",
    ]


def test_catalog_sizes():
    assert len(catalog.NEWS_FEEDS) == 10 and len(catalog.SCHOLARLY_FEEDS) == 4
    assert len(pages.forum_profiles()) == 8
    assert len(pages.news_profiles()) == 8 and len(pages.scholarly_profiles()) == 9


def test_the_word_null_is_text(spark):
    body = rss(item(title="null", link="l", description="null"))
    row = feeds.scholarly_articles(feed(spark, body)).first()
    assert (row.title, row.abstract) == ("null", "null")


def _authors(spark, body):
    rows = feeds.scholarly_articles(feed(spark, body)).orderBy("position").collect()
    return [(r.title, r.authors, r.abstract) for r in rows]


@pytest.mark.parametrize(
    "between",
    ["<item/>", '<item a="1>2" />', "<item></item>", "<!-- <item><dc:creator>no</dc:creator></item> -->", "<image><item/></image>"],
)
def test_first_tag_of_an_item_after_odd_ones(spark, between):
    one = "<item><title>One</title><link>l</link><author>A1</author><dc:creator>C1</dc:creator><summary>s</summary></item>"
    two = (
        "<item><title>Two &lt;author&gt;</title><link>l</link><!-- <author>no</author> -->"
        "<description><![CDATA[<author>x</author>]]></description><dc:creator>C2</dc:creator><dc:creator>C3</dc:creator>"
        "<author>A2</author><summary>t</summary></item>"
    )
    none = "<item><title>None</title><link>l</link><summary>z</summary><description>y</description></item>"
    body = f'<rss xmlns:dc="d"><channel>{between}{one}{between}{two}{between}{none}</channel></rss>'
    found = _authors(spark, body)
    assert [a for _, a, _ in found][:2] == ["A1", "C2"] and found[2][1].startswith("Unknown author")
    assert [x[2] for x in found][0] == "s" and found[2][2] == "z"


def test_order_of_tags_is_read_where_it_matters(spark):
    only = _authors(spark, "<rss><channel><item><title>T</title><link>l</link><author/><description>d</description></item></channel></rss>")
    assert only == [("T", "", "d")]
