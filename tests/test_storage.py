"""Appends that survive failed runs, refreshes that readers survive, stored columns, insights by day."""

import datetime as dt
import json
import uuid

import pytest
from pyspark.sql import functions as F

from contentloom.operators import serving
from contentloom.plans import jobs
from contentloom.schemas import conform, schema
from contentloom.sources import pages
from contentloom.sources.ledger import ID_RANGES, Ledger, RangeTaken, not_yet_stored
from contentloom.sources.storage import CatalogStore, FolderStore
from tests.test_extraction import feed, item, page, rss
from tests.test_jobs import stories_of, titles

DAY = dt.datetime(2024, 1, 1, 6)
WINDOW = jobs.Batch("2024-01-01", "2024-01-02")


@pytest.fixture(params=["folder", "catalog"])
def store(request, spark, tmp_path):
    if request.param == "folder":
        return FolderStore(spark, str(tmp_path))
    database = f"db_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database}")
    made = CatalogStore(spark, database)
    made.staging_folder = lambda: str(tmp_path)
    return made


class Died(Exception):
    pass


def dying(store, monkeypatch, when, instead=None):
    """The next append to a table dies; ``instead`` may store a part of its rows before."""
    kept = store.append

    def append(table, df):
        if table == when:
            monkeypatch.undo()
            if instead:
                instead(table, df)
            raise Died
        kept(table, df)

    monkeypatch.setattr(store, "append", append)


def posts(store):
    store.create_if_absent("reddit_posts")
    return {r.id: r.title for r in store.read("reddit_posts").collect()}


def test_a_crash_before_the_append_costs_ids_only(store, spark, monkeypatch):
    store.append("story_payloads", stories_of(spark, *titles("a", "b", "c"), at=DAY))
    assert posts(store) == {}
    dying(store, monkeypatch, "reddit_posts")
    with pytest.raises(Died):
        jobs.run("extract_stories", store, batch=WINDOW)
    assert posts(store) == {}
    assert jobs.run("extract_stories", store, batch=WINDOW)["stored"] == 3
    # The open range 1 to 3 is not given again.
    assert sorted(posts(store)) == [4, 5, 6] and sorted(posts(store).values()) == ["a", "b", "c"]


@pytest.mark.parametrize("part", ["all", "some"])
def test_a_crash_after_the_append_stores_nothing_twice(store, spark, monkeypatch, part):
    store.append("story_payloads", stories_of(spark, *titles("a", "b", "c", "b"), at=DAY))
    write, there = store.append, posts(store)
    dying(
        store,
        monkeypatch,
        "reddit_posts",
        lambda table, df: write(table, df if part == "all" else df.filter("title != 'c' and id != 2")),
    )
    with pytest.raises(Died):
        jobs.run("extract_stories", store, batch=WINDOW)
    there = len(posts(store))
    assert jobs.run("extract_stories", store, batch=WINDOW) == {"stored": 4 - there, jobs.BEFORE: there}
    assert sorted(posts(store).values()) == ["a", "b", "b", "c"]
    # Without a window nothing tells that the rows are known.
    monkeypatch.undo()
    assert jobs.run("extract_stories", store) == {"stored": 4}
    ids = [r.id for r in store.read("reddit_posts").select("id").collect()]
    assert len(ids) == len(set(ids)) == 8


def test_a_repeated_window_stores_what_is_new(store, spark):
    payloads = stories_of(spark, *titles("a", "b"), "{}", at=DAY)
    store.append("story_payloads", payloads)
    first = {"stored": 2, "no title": 1}
    assert jobs.run("extract_stories", store, batch=WINDOW) == first
    assert jobs.run("extract_stories", store, batch=WINDOW) == {"stored": 0, jobs.BEFORE: 2, "no title": 1}
    store.append("story_payloads", stories_of(spark, *titles("b", "late"), at=DAY.replace(hour=7)))
    assert jobs.run("extract_stories", store, batch=WINDOW) == {"stored": 2, jobs.BEFORE: 2, "no title": 1}
    assert sorted(posts(store).values()) == ["a", "b", "b", "late"]
    assert store.read(jobs.REJECTS).count() == 1
    named = jobs.Batch(batch_id="evening")
    assert jobs.run("extract_stories", store, batch=named)["stored"] == 4
    assert jobs.run("extract_stories", store, batch=named)["stored"] == 0


def test_stored_rows_of_a_batch_are_found_by_their_ids(store, spark):
    store.append("story_payloads", stories_of(spark, *titles("a", "b"), at=DAY))
    jobs.run("extract_stories", store, batch=WINDOW)
    jobs.run("extract_stories", store)
    found = Ledger(store, "reddit_posts").stored("extract_stories 2024-01-01 to 2024-01-02")
    assert sorted(r.id for r in found.collect()) == [1, 2]
    assert "PushedFilters: [IsNotNull(id), GreaterThanOrEqual(id,1)" in found._jdf.queryExecution().toString()
    states = [(r.first_id, r.rows, r.state) for r in store.read(ID_RANGES).collect()]
    assert sorted(states) == [(1, 2, "closed"), (1, 2, "open"), (3, 2, "closed"), (3, 2, "open")]


def test_ranges_that_meet_are_refused(store, spark):
    store.append("story_payloads", stories_of(spark, *titles("a", "b", "c"), at=DAY))
    jobs.run("extract_stories", store, batch=jobs.Batch(first_id=7))
    for first in (7, 5, 9):
        with pytest.raises(RangeTaken, match="closed range 7 to 9"):
            jobs.run("extract_stories", store, batch=jobs.Batch(first_id=first))
    jobs.run("extract_stories", store, batch=jobs.Batch(first_id=4))
    assert sorted(posts(store)) == [4, 5, 6, 7, 8, 9]
    row = (50, "Sub", "Title", "a", "u", 5, None, None)
    store.append("reddit_posts", spark.createDataFrame([row], schema("reddit_posts")))
    with pytest.raises(RangeTaken, match="has rows"):
        jobs.run("extract_stories", store, batch=jobs.Batch(first_id=49))


def test_an_open_range_is_never_used_again(store, spark):
    store.create_if_absent("reddit_posts")
    ledger = Ledger(store, "reddit_posts")
    lost = ledger.reserve(10, "night")
    assert (lost.first, lost.end) == (1, 11)
    with pytest.raises(RangeTaken, match="open range 1 to 10"):
        ledger.reserve(3, first=10)
    assert ledger.reserve(5).first == 11
    assert Ledger(store, "news_articles").store is store and ledger.next_id() == 16
    assert ledger.ranges("night") == [(1, 11)]


def test_two_runs_that_choose_one_range(store, spark, monkeypatch):
    store.create_if_absent("reddit_posts")
    here, there = Ledger(store, "reddit_posts"), Ledger(store, "reddit_posts")
    mine = here.reserve(4)
    true = there.next_id
    seen = iter([1])
    # The other run has looked before this one's record was written.
    monkeypatch.setattr(there, "next_id", lambda: next(seen, None) or true())
    other = there.reserve(4)
    assert (mine.first, mine.end) == (1, 5) and other.first >= 5
    assert store.read(ID_RANGES).filter("state = 'lost'").count() == 1


def test_rows_that_are_stored_in_part(spark):
    new = spark.createDataFrame(
        [(1, None, "x"), (1, None, "x"), (1, None, "x"), (None, 1, "x"), (2, 2, None), (2, None, "2")],
        "a int, b int, c string",
    )
    old = spark.createDataFrame([(1, None, "x"), (2, 2, None), (9, 9, "9")], "a int, b int, c string")
    left = sorted(map(repr, not_yet_stored(new, old, ["a", "b", "c"]).collect()))
    assert left == sorted(
        ["Row(a=1, b=None, c='x')"] * 2 + ["Row(a=None, b=1, c='x')", "Row(a=2, b=None, c='2')"]
    )


# --- refreshes ----------------------------------------------------------------------------------


def test_a_refresh_that_dies_leaves_the_old_rows(store, spark):
    good = spark.range(6).withColumn("t", F.lit("old"))
    store.overwrite("t", good)
    fails = F.when(F.col("id") < 5, "new").otherwise(F.raise_error(F.lit("died")).cast("string"))
    for _ in range(2):
        with pytest.raises(Exception, match="died"):
            store.overwrite("t", spark.range(6, numPartitions=6).withColumn("t", fails))
        assert {r.t for r in store.read("t").collect()} == {"old"} and store.read("t").count() == 6
    store.overwrite("t", spark.range(3).withColumn("u", F.lit("new")))
    assert store.read("t").columns == ["id", "u"] and store.read("t").count() == 3


def test_a_reader_outlives_a_refresh(store, spark):
    store.overwrite("t", spark.range(4))
    begun = store.read("t")
    store.overwrite("t", spark.range(9))
    assert begun.count() == 4 and store.read("t").count() == 9
    for rows in (2, 3, 5):
        store.overwrite("t", spark.range(rows))
        assert store.read("t").count() == rows
    if isinstance(store, FolderStore):
        kept = spark._jvm.java.io.File(f"{store.root}/_versions/t").list()
    else:
        kept = [t for t in spark.catalog.listTables(store.database) if t.name.startswith("t__")]
    assert len(kept) == 2


def test_a_table_made_by_other_means_is_refreshed(store, spark):
    store.append("t", spark.range(2))
    begun = store.read("t")
    store.overwrite("t", store.read("t").union(spark.range(5, 8)))
    assert store.read("t").count() == 5
    if isinstance(store, FolderStore):
        assert begun.count() == 2
    store.append("t", spark.range(1))
    assert store.read("t").count() == 6
    store.overwrite("t", spark.range(1))
    assert store.read("t").count() == 1


def test_partitions_of_a_refreshed_table_are_replaced(store, spark):
    rows = spark.range(12).selectExpr("id", "id % 3 AS k")
    store.overwrite("t", rows, partition_by=("k",))
    store.replace_parts("t", rows.filter("k = 1").limit(1), ("k",))
    assert {r.k: r["count"] for r in store.read("t").groupBy("k").count().collect()} == {0: 4, 1: 1, 2: 4}
    plan = store.read("t").filter("k = 2")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(k" in plan


# --- declared columns ---------------------------------------------------------------------------


@pytest.mark.parametrize("vectorized", ["true", "false"])
def test_a_column_added_later_shows_its_default_in_old_files(store, spark, vectorized):
    table = "scholarly_articles"
    old = spark.createDataFrame([(1, "S", "T")], "id bigint, source string, title string")
    store.append(table, old)
    if isinstance(store, CatalogStore):
        assert store.read(table).columns == ["id", "source", "title"]
        assert "language" in store.add_missing_columns(table) and store.add_missing_columns(table) == []
    new = spark.createDataFrame([(2, "S", None), (3, "S", "he")], "id bigint, source string, language string")
    store.append(table, conform(new, table))
    store.append(table, conform(new.drop("language").withColumn("id", F.col("id") + 10), table))
    setting = "spark.sql.parquet.enableVectorizedReader"
    before = spark.conf.get(setting)
    spark.conf.set(setting, vectorized)
    try:
        found = {r.id: r.language for r in store.read(table).collect()}
        # Old rows have it without a rewrite, rows stored without it too; a stored NULL stays one.
        assert found == {1: "en", 2: None, 3: "he", 12: "en", 13: "en"}
        assert {r.id for r in store.read(table).filter("language = 'en'").collect()} == {1, 12, 13}
    finally:
        spark.conf.set(setting, before)


def test_extraction_into_a_table_without_the_column(store, spark):
    old = schema("scholarly_articles").fieldNames()[:-1]
    row = (1, "S", "C", "T", "a", "abs", "u", DAY, DAY)
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema("scholarly_articles").fields[:-1])
    store.append("scholarly_articles", spark.createDataFrame([row], kinds).select(*old))
    paper = rss(item(title="Deep robots", link="http://l/3", description="learn",
                     pubDate="Sun, 28 Jan 2024 10:00:00 +0000"))
    store.append("scholarly_feed_payloads", feed(spark, paper))
    assert jobs.run("extract_scholarly_feeds", store) == {"stored": 1}
    languages = {r.id: r.language for r in store.read("scholarly_articles").collect()}
    assert languages[1] == "en" and len(languages) == 2
    jobs.run("scholarly_articles", store)
    assert store.read("transformed_scholarly_articles").filter("id = 1").first().language == "en"


def test_values_beyond_their_width_are_rejected(store, spark):
    fits, long = "c" * 255, "c" * 256
    rows = spark.createDataFrame(
        [("S", fits, "ok"), ("S", long, "too long"), (long, "c", "source"), ("é" * 255, "c", "signs count")],
        "source string, category string, title string",
    )
    none = spark.createDataFrame([], f"{jobs.REASON} string, row string")
    outcome = jobs.store_rows(store, "news_articles", rows, none)
    assert outcome == {"stored": 2, "category is longer than 255": 1, "source is longer than 255": 1}
    assert {r.title for r in store.read("news_articles").collect()} == {"ok", "signs count"}
    rejects = {(r.reject_reason, json.loads(r.row)["title"]) for r in store.read(jobs.REJECTS).collect()}
    assert rejects == {("category is longer than 255", "too long"), ("source is longer than 255", "source")}


def test_rows_without_required_values_are_rejected(store, spark):
    fields = "id bigint, insight_type string, title string, description string, sources array<string>"
    rows = spark.createDataFrame([(1, "t", "x", "d", ["s"]), (2, None, "x", "d", None), (3, "t" * 51, "x", "d", [])], fields)
    rows = rows.withColumns({"score": F.lit(1.0), "generated_at": F.lit(DAY)})
    from contentloom.operators.quality import reason_counts, with_reason
    from contentloom.schemas import declared_rules

    counts = reason_counts(with_reason(rows, declared_rules(rows, "content_insights"))).collect()
    assert {r.reject_reason: r["rows"] for r in counts} == {
        "stored": 1, "insight_type is missing": 1, "insight_type is longer than 50": 1,
    }


def test_catalog_tables_have_their_declared_columns(spark):
    database = f"db_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database}")
    store = CatalogStore(spark, database)
    store.create_if_absent("scholarly_articles")
    store.create_if_absent("content_insights")
    described = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE {database}.scholarly_articles").collect()}
    assert described["source"] == "varchar(255)" and described["language"] == "varchar(10)"
    assert described["abstract"] == "string"
    with pytest.raises(Exception, match="EXCEED_LIMIT_LENGTH|too long|Exceeds"):
        spark.sql(f"INSERT INTO {database}.scholarly_articles (id, source) VALUES (1, repeat('x', 256))")


# --- insights by day ------------------------------------------------------------------------------


def insight(spark, moment, names):
    rows = [
        (i, "trending_topic", name, "d", ["s"], [], float(i), dt.datetime.fromisoformat(moment))
        for i, name in enumerate(names)
    ]
    return spark.createDataFrame(rows, schema("content_insights"))


def scans(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "FileScan" in line]


def test_insights_are_kept_and_read_by_day(store, spark):
    store.create_if_absent("content_insights")
    for moment in ("2024-01-28 06:00:00", "2024-01-29 06:00:00", "2024-01-30 06:00:00", "2024-01-30 12:00:00"):
        store.replace_parts("content_insights", insight(spark, moment, [moment + x for x in "ab"]))
    assert store.read("content_insights").columns == schema("content_insights").fieldNames()
    stored = store.read_laid_out("content_insights")
    for found, rows in (
        (serving.digest(stored, "2024-01-30"), 4),
        (serving.briefing(stored, "2024-01-30"), 4),
        (serving.latest(stored, "2024-01-30", rows=50), 6),
    ):
        assert found.count() == rows
        (scan,) = scans(found)
        filters = scan.split("PartitionFilters: [", 1)[1].split("]", 1)[0]
        assert "generated_day" in filters
    files = {f.split("generated_day=")[1][:10] for f in serving.digest(stored, "2024-01-30").inputFiles()}
    assert "2024-01-30" in files


def test_a_repeated_run_replaces_its_own_rows(store, spark):
    store.create_if_absent("content_insights")
    write = lambda moment, names: store.replace_parts("content_insights", insight(spark, moment, names))
    write("2024-01-30 06:00:00", "ab")
    write("2024-01-30 12:00:00", "cde")
    write("2024-01-30 12:00:00", "fg")
    write("2024-01-31 12:00:00", "h")
    assert sorted(r.title for r in store.read("content_insights").collect()) == list("abfgh")


# --- pages by profile, layouts given later ------------------------------------------------------


def test_pages_are_read_by_profile(store, spark):
    forum, site, paper = pages.forum_profile("science"), pages.news_profiles()[0], pages.scholarly_profiles()[0]
    block = '<article><h3><a href="/n">Robots walk around</a></h3><p>robots learn</p></article>'
    for profile in (forum, site, paper):
        # One page with its profile, one that is known by its address only.
        jobs.store_pages(store, page(spark, profile, block))
        fetched = page(spark, profile, block).withColumns({"profile": F.lit(None).cast("string"), "url": F.lit(profile.url)})
        jobs.store_pages(store, fetched)
        store.append("page_payloads", fetched)
    lost = page(spark, forum, block).withColumns({"profile": F.lit("forum:gone"), "url": F.lit("http://gone")})
    store.append("page_payloads", lost)
    stored = store.read_laid_out("page_payloads")
    for own, known, read in (([forum], [], 2 + 3), ([site], pages.all_profiles(), 2 + 3 + 1)):
        found = pages.of_profiles(stored, own, known)
        assert found.count() == read
        (scan,) = scans(found)
        filters = scan.split("PartitionFilters: [", 1)[1].split("PushedFilters", 1)[0]
        assert "page_profile" in filters and "DataFilters: []" in scan
    assert jobs.run("extract_news_pages", store) == {"stored": 3, "unknown profile": 1}
    assert jobs.run("extract_scholarly_pages", store) == {"stored": 3}
    assert jobs.run("extract_forum_pages", store).get("unknown profile") is None


def test_a_table_from_before_its_layout(store, spark):
    """Rows stored flat are read as they are, and get the layout with the next write."""
    flat = insight(spark, "2024-01-30 06:00:00", "ab").unionByName(insight(spark, "2024-01-20 06:00:00", "c"))
    if isinstance(store, FolderStore):
        flat.write.parquet(store.path("content_insights"))
    else:
        flat.write.format("parquet").saveAsTable(f"{store.database}.content_insights")
    stored = store.read_laid_out("content_insights")
    assert serving.digest(stored, "2024-01-30").count() == 2
    store.replace_parts("content_insights", insight(spark, "2024-01-30 12:00:00", "d"))
    store.append("content_insights", insight(spark, "2024-01-31 12:00:00", "e"))
    assert sorted(r.title for r in store.read("content_insights").collect()) == list("abcde")
    found = serving.digest(store.read_laid_out("content_insights"), "2024-01-30")
    assert found.count() == 4 and "generated_day" in scans(found)[0].split("PartitionFilters: [", 1)[1]
