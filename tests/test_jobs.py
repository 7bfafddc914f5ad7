"""Storage and jobs, from payloads to the digest."""

import dataclasses
import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from contentloom.operators.topics import TopicSettings
from contentloom.plans import jobs
from contentloom.schemas import ensure_column, schema
from contentloom.sources import pages
from contentloom.sources.storage import (
    CatalogStore,
    FolderStore,
    JdbcStore,
    last_id,
    number_rows,
    staged,
)
from tests.test_extraction import feed, item, page, rss

AS_OF = "2024-01-30"
FETCHED = dt.datetime(2024, 1, 30, 6)


@pytest.fixture
def store(spark, tmp_path):
    return FolderStore(spark, str(tmp_path))


@pytest.mark.parametrize("kind", ["folder", "catalog"])
def test_store(spark, tmp_path, kind):
    if kind == "folder":
        store = FolderStore(spark, str(tmp_path))
    else:
        spark.sql("CREATE DATABASE IF NOT EXISTS content")
        store = CatalogStore(spark, "content")
    assert not store.exists("content_insights")
    store.create_if_absent("content_insights")
    store.create_if_absent("content_insights")
    assert store.exists("content_insights")
    empty = store.read("content_insights")
    assert empty.count() == 0 and empty.columns == schema("content_insights").fieldNames()
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "id bigint, t string")
    store.overwrite("t", rows)
    store.append("t", rows.limit(1))
    assert store.read("t").count() == 3
    store.overwrite("t", rows, partition_by=("t",))
    assert sorted(r.id for r in store.read("t").collect()) == [1, 2]
    store.register("t")
    assert spark.sql("SELECT max(id) AS m FROM t").first().m == 2


def test_files_of_different_age(store, spark):
    table = "scholarly_articles"
    store.append(table, spark.createDataFrame([(1, "x")], "id int, extra string"))
    store.append(table, spark.createDataFrame([(2, "he")], "id bigint, language string"))
    declared = store.read(table)
    assert declared.columns == schema(table).fieldNames()
    assert {(r.id, r.language) for r in declared.collect()} == {(1, "en"), (2, "he")}
    filled = ensure_column(declared, "language", F.lit("en"))
    assert {(r.id, r.language) for r in filled.collect()} == {(1, "en"), (2, "he")}
    store.append("t", spark.createDataFrame([(1,)], "id bigint"))
    store.append("t", spark.createDataFrame([(2, "he")], "id bigint, language string"))
    merged = FolderStore(spark, store.root, merge_schema=True).read("t")
    assert {(r.id, r.language) for r in merged.collect()} == {(1, None), (2, "he")}


def test_jdbc_options(spark):
    store = JdbcStore(spark, "jdbc:x", {"user": "u"}, fetch_rows=100, key_ranges={"t": (1, 900)})
    assert store.read_options("t") == {
        "user": "u",
        "url": "jdbc:x",
        "dbtable": "t",
        "fetchsize": "100",
        "partitionColumn": "id",
        "lowerBound": "1",
        "upperBound": "900",
        "numPartitions": "64",
    }
    assert "partitionColumn" not in store.read_options("other")
    assert store.write_options("t")["numPartitions"] == "16"


def test_numbering(spark):
    df = spark.range(1000, numPartitions=7).select(F.col("id").alias("x"))
    with staged(df) as rows:
        odd = number_rows(rows.filter("x % 3 = 0"), first=51).collect()
    assert sorted(r.id for r in odd) == list(range(51, 51 + 334))
    assert {r.x for r in odd} == set(range(0, 1000, 3))
    assert last_id(spark.createDataFrame([], "id bigint")) == 0


def test_staged_rows_are_computed_once_and_removed(spark, tmp_path):
    spent = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            spent.add(len(batch))
            yield batch

    df = spark.range(10).mapInPandas(count, "id bigint")
    with staged(df) as rows:
        assert rows.count() == 10 and rows.agg(F.sum("id")).first()[0] == 45
        path = rows.inputFiles()[0].removeprefix("file:").rsplit("/", 1)[0]
    assert spent.value == 10
    import os

    assert not os.path.exists(path)


def fill_payloads(store, spark):
    news = rss(
        item(title="Robots learn fast", description="robots learn to walk and robots talk",
             link="http://l/1", pubDate="Mon, 29 Jan 2024 10:00:00 GMT"),
        item(title="Broken date", description="x", link="http://l/2", pubDate="soon"),
    )
    store.append("news_feed_payloads", feed(spark, news, "<rss>"))
    paper = rss(
        item(title="Deep robots", link="http://l/3", description="robots walk and learn deep things",
             pubDate="Sun, 28 Jan 2024 10:00:00 +0000")
    )
    store.append("scholarly_feed_payloads", feed(spark, paper))
    store.append(
        "story_payloads",
        spark.createDataFrame(
            [(0, 1, json.dumps({"title": "New app", "score": 500, "time": 1706500000}), FETCHED),
             (1, 2, "{}", FETCHED)],
            schema("story_payloads"),
        ),
    )
    forum, news_site = pages.forum_profile("science"), pages.news_profiles()[0]
    nature = next(p for p in pages.scholarly_profiles() if p.source == "Nature")
    block = '<article><h3><a href="/n">Robots walk around</a></h3><p>robots learn</p></article>'
    for profile, html, status in (
        (forum, '<div class="thing"><a class="title" href="/r/a">Post</a></div>', 200),
        (forum, "", 500),
        (news_site, block, 200),
        (nature, block, 200),
    ):
        store.append("page_payloads", page(spark, profile, html, status=status))


def test_pipeline(store, spark):
    fill_payloads(store, spark)
    outcome = {verb: jobs.run(verb, store) for verb in jobs.JOBS if verb.startswith("extract")}
    assert outcome == {
        "extract_news_feeds": {"stored": 1, "unreadable date": 1, "malformed": 1},
        "extract_scholarly_feeds": {"stored": 1},
        "extract_stories": {"stored": 1, "no title": 1},
        "extract_forum_pages": {"stored": 1, "not fetched": 1},
        "extract_news_pages": {"stored": 1},
        "extract_scholarly_pages": {"stored": 1},
    }
    rejects = {
        (r.table_name, r.reject_reason) for r in store.read(jobs.REJECTS).collect()
    }
    assert rejects == {
        ("news_articles", "unreadable date"),
        ("news_articles", "malformed"),
        ("reddit_posts", "no title"),
        ("reddit_posts", "not fetched"),
    }
    for table, rows in (("news_articles", 2), ("reddit_posts", 2), ("scholarly_articles", 2)):
        ids = [r.id for r in store.read(table).select("id").collect()]
        assert len(set(ids)) == len(ids) == rows

    for verb in ("news_articles", "reddit_posts", "scholarly_articles", "merge_all"):
        jobs.run(verb, store)
    unified = store.read("unified_content")
    assert {(r.content_type, r["count"]) for r in unified.groupBy("content_type").count().collect()} == {
        ("news", 2), ("social_media", 2), ("academic", 2),
    }
    assert set(unified.columns) == set(schema("unified_content").fieldNames())
    academic = unified.filter("content_type = 'academic'")
    assert "PartitionFilters: [isnotnull(content_type" in academic._jdf.queryExecution().toString()

    settings = TopicSettings(topics=2, iterations=2, partitions=2)
    outcome = jobs.insights(store, AS_OF, settings, generated_at="2024-01-30 12:00:00")
    first = store.read("content_insights").count()
    assert outcome == {"stored": first}
    kinds = {r.insight_type for r in store.read("content_insights").collect()}
    assert kinds == {"trending_topic", "discovered_topic"}
    jobs.insights(store, AS_OF, settings, generated_at="2024-01-30 12:00:00")
    again = store.read("content_insights")
    assert again.count() == first and again.select("id").distinct().count() == first
    jobs.insights(store, AS_OF, settings, generated_at="2024-01-30 18:00:00")
    assert store.read("content_insights").count() == 2 * first
    messages = jobs.run("digest", store, as_of=AS_OF).collect()
    assert messages and all("Relevance Score: " in r.message for r in messages)


def test_unnamed_category_is_rejected(store, spark):
    rows = [
        (i, "s", category, "t", None, "u", dt.date(2024, 1, 30), 0.0, "news", f"news_{i}", FETCHED)
        for i, category in enumerate([None, None, "named"])
    ]
    unified = spark.createDataFrame(rows, schema("unified_content"))
    store.overwrite("unified_content", unified, partition_by=("content_type",))
    assert jobs.run("insights", store, as_of=AS_OF) == {"stored": 1, "unnamed category": 1}
    assert [r.title for r in store.read("content_insights").collect()] == ["named"]
    reject = store.read(jobs.REJECTS).first()
    assert (reject.table_name, reject.reject_reason) == ("content_insights", "unnamed category")
    assert json.loads(reject.row)["count"] == 2


def test_scholarly_table_without_language(store, spark):
    old = spark.createDataFrame(
        [(1, "S", "C", "T", "a", "abs", "u", FETCHED, FETCHED)],
        schema("scholarly_articles").fieldNames()[:-1],
    )
    store.append("scholarly_articles", old)
    jobs.run("scholarly_articles", store)
    assert store.read("transformed_scholarly_articles").first().language == "en"


def test_empty_batch_writes_nothing(store, spark):
    store.append("story_payloads", spark.createDataFrame([], schema("story_payloads")))
    assert jobs.run("extract_stories", store) == {}
    assert not store.exists("reddit_posts") and not store.exists(jobs.REJECTS)


def stories_of(spark, *bodies, at=FETCHED):
    rows = [(i, 100 + i, body, at) for i, body in enumerate(bodies)]
    return spark.createDataFrame(rows, schema("story_payloads"))


def titles(*names):
    return [json.dumps({"title": name}) for name in names]


def test_a_window_takes_each_payload_once(store, spark):
    store.append("story_payloads", stories_of(spark, *titles("a", "b"), at=dt.datetime(2024, 1, 1)))
    store.append("story_payloads", stories_of(spark, *titles("c"), at=dt.datetime(2024, 1, 2)))
    days = [jobs.Batch("2024-01-01", "2024-01-02"), jobs.Batch("2024-01-02", "2024-01-03")]
    assert [jobs.run("extract_stories", store, batch=day) for day in days] == [{"stored": 2}, {"stored": 1}]
    found = {r.id: r.title for r in store.read("reddit_posts").collect()}
    assert sorted(found) == [1, 2, 3] and found[3] == "c"
    window = days[0].payloads(store, "story_payloads")._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(fetched_at), GreaterThanOrEqual(fetched_at" in window


def test_ranges_keep_jobs_apart(store, spark):
    store.append("story_payloads", stories_of(spark, *titles(*"abcde")).repartition(3))
    for first in (1000, 5000):
        assert jobs.run("extract_stories", store, batch=jobs.Batch(first_id=first)) == {"stored": 5}
    ids = sorted(r.id for r in store.read("reddit_posts").collect())
    assert ids == [*range(1000, 1005), *range(5000, 5005)]
    jobs.run("extract_stories", store)
    assert max(r.id for r in store.read("reddit_posts").collect()) == 5009


def test_ids_follow_a_table_filled_by_other_means(store, spark):
    row = (41, "Sub", "Title", "a", "u", 5, None, None)
    store.append("reddit_posts", spark.createDataFrame([row], schema("reddit_posts")))
    store.append("story_payloads", stories_of(spark, *titles("a")))
    jobs.run("extract_stories", store)
    assert sorted(r.id for r in store.read("reddit_posts").collect()) == [41, 42]


def test_broken_stories_are_malformed(store, spark):
    bodies = [*titles("good"), '{"title": "cut', '{"title": "x", "score": 5.5}', '{"title": "y", "score": 99999999999}', "{}"]
    store.append("story_payloads", stories_of(spark, *bodies))
    assert jobs.run("extract_stories", store) == {"stored": 1, "malformed": 3, "no title": 1}


def test_one_odd_page_costs_no_other(store, spark, monkeypatch):
    good = '<div class="thing"><a class="title" href="/r/a">Post</a></div>'
    forum, broken = pages.forum_profile("science"), pages.forum_profile("technology")
    store.append("page_payloads", page(spark, forum, good))
    store.append("page_payloads", page(spark, forum, "<![word[ x ]>" + good.replace("Post", "Odd")))
    store.append("page_payloads", page(spark, broken, good))
    stray = page(spark, forum, good).withColumns({"profile": F.lit(None).cast("string"), "url": F.lit("http://nobody")})
    store.append("page_payloads", stray)
    unreadable = dataclasses.replace(broken, block=("a:hover",))
    monkeypatch.setattr(pages, "forum_profiles", lambda: [forum, unreadable])
    assert jobs.run("extract_forum_pages", store) == {"stored": 2, "unreadable page": 1}
    assert {r.title for r in store.read("reddit_posts").collect()} == {"Post", "Odd"}
    assert jobs.run("extract_news_pages", store) == {"unknown profile": 1}
    rejects = {(r.reject_reason, json.loads(r.row)["origin"]) for r in store.read(jobs.REJECTS).collect()}
    assert rejects == {("unreadable page", "https://a.com/list"), ("unknown profile", "http://nobody")}


def test_unified_rows_are_clustered_by_day(store, spark):
    fill_payloads(store, spark)
    for verb in jobs.JOBS:
        if verb not in ("insights", "digest"):
            jobs.run(verb, store)
    rows = store.read("unified_content").hint("rebalance", F.col("content_type"), F.col("published_date"))
    assert "REBALANCE" in rows._jdf.queryExecution().executedPlan().toString()
    assert not [t for t in store.spark._jvm.java.io.File(store.path("_staging")).list() or []]


def test_unknown_verb(store):
    with pytest.raises(ValueError, match="unknown job"):
        jobs.run("nonsense", store)
