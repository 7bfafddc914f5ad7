"""Refreshes by window against full ones, the folders they touch, and the counts of each day."""

import datetime as dt
import os
import random
import uuid

import pytest
from pyspark.sql import functions as F

from contentloom.operators import ranking
from contentloom.plans import jobs, refresh
from contentloom.schemas import schema
from contentloom.sources.storage import CatalogStore, FolderStore

VERBS = ("news_articles", "reddit_posts", "scholarly_articles", "merge_all")
START = dt.datetime(2024, 1, 1)


def window(day):
    return jobs.Batch(str((START + dt.timedelta(day)).date()), str((START + dt.timedelta(day + 1)).date()))


def raw_rows(spark, pick, day, first):
    """Some rows of each raw table, extracted on a day and published on any."""

    def moments():
        published = None if pick.random() < 0.1 else START - dt.timedelta(days=pick.randrange(6), hours=5)
        return published, START + dt.timedelta(days=day, hours=pick.randrange(24))

    def title():
        return pick.choice(["A title", "", None, "Été 7 things"])

    tables, i = {}, first
    for table in ("news_articles", "reddit_posts", "scholarly_articles"):
        rows = []
        for _ in range(pick.randrange(1, 9)):
            i += 1
            published, extracted = moments()
            label = pick.choice([" A ", "b", None])
            text = pick.choice(["Some words here", "", None])
            rows.append(
                (i, "Sub", title(), label, "u", pick.randrange(2000), published, extracted)
                if table == "reddit_posts"
                else (i, " S", label, title(), text, "u", published, extracted)
                if table == "news_articles"
                else (i, " S", label, title(), "x, y", text, "u", published, extracted, "en")
            )
        tables[table] = spark.createDataFrame(rows, schema(table))
    return tables, i


def fill(store, spark, pick, day, first=0):
    tables, last = raw_rows(spark, pick, day, first)
    for table, rows in tables.items():
        store.append(table, rows)
    return last


def made(kind, spark, path):
    if kind == "folder":
        return FolderStore(spark, str(path / uuid.uuid4().hex))
    database = f"db_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database}")
    store = CatalogStore(spark, database)
    store.staging_folder = lambda: str(path / database)
    return store


def contents(store, table, *without):
    df = store.read(table)
    names = sorted(set(df.columns) - set(without))
    return sorted(map(repr, df.select(*names).collect()))


def run_all(store, batch=jobs.EVERYTHING):
    for verb in VERBS:
        jobs.run(verb, store, batch=batch)


STAMPS = ("processed_timestamp", "transformation_date")


@pytest.mark.parametrize("kind, seed", [("folder", 1), ("folder", 2), ("catalog", 3)])
def test_windows_make_what_a_full_refresh_makes(spark, tmp_path, kind, seed):
    pick = random.Random(seed)
    store, whole = made(kind, spark, tmp_path), made("folder", spark, tmp_path)
    last = fill(store, spark, pick, 0)
    run_all(store)
    for day in (1, 2):
        last = fill(store, spark, pick, day, last)
        run_all(store, window(day))
    # Late rows of an earlier window, and a window that is run again.
    fill(store, spark, pick, 1, last)
    run_all(store, window(1))
    run_all(store, window(2))
    for table in ("news_articles", "reddit_posts", "scholarly_articles"):
        whole.append(table, store.read(table))
    run_all(whole)
    for table in ("transformed_news_articles", "transformed_reddit_posts", "transformed_scholarly_articles"):
        assert contents(store, table, *STAMPS) == contents(whole, table, *STAMPS)
    assert contents(store, "unified_content", *STAMPS) == contents(whole, "unified_content", *STAMPS)
    assert contents(store, refresh.DAYS) == contents(whole, refresh.DAYS)
    assert store.read(refresh.DAYS).agg(F.sum("rows")).first()[0] == store.read("unified_content").count()


def files_below(path):
    return {
        os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns
        for d, _, names in os.walk(path)
        for f in names
        if f.endswith(".parquet")
    }


def test_only_touched_folders_change(spark, tmp_path):
    store = FolderStore(spark, str(tmp_path))
    pick = random.Random(5)
    last = 0
    for _ in range(4):
        last = fill(store, spark, pick, 0, last)
    run_all(store)
    days = {r.published_date for r in store.read("unified_content").select("published_date").distinct().collect()}
    assert len(days) > 3
    path = store.path("unified_content")
    before = files_below(path)
    new = (last + 1, "S", "c", "T", "words", "u", dt.datetime(2023, 12, 30, 9), START + dt.timedelta(days=1))
    store.append("news_articles", spark.createDataFrame([new], schema("news_articles")))
    for verb in VERBS[:-1]:
        jobs.run(verb, store, batch=window(1))
    assert jobs.run("merge_all", store, batch=window(1)) == {"rows": 1, "folders": 1}
    assert store.path("unified_content") == path
    after = files_below(path)
    changed = {f for f in before.keys() | after.keys() if before.get(f) != after.get(f)}
    assert changed and all("content_type=news/published_date=2023-12-30" in f for f in changed)
    assert jobs.run("merge_all", store, batch=window(3)) == {"rows": 0, "folders": 0}
    assert files_below(path) == after


def test_the_scan_opens_touched_folders_only(spark, tmp_path):
    store = FolderStore(spark, str(tmp_path))
    fill(store, spark, random.Random(6), 0)
    run_all(store)
    rows = [("news", dt.date(2023, 12, 30)), ("academic", dt.date(2023, 12, 29)), ("news", None)]
    touched = spark.createDataFrame(rows, "content_type string, published_date date")
    store.append("touched", touched)
    found = refresh.touched_rows(store.read("unified_content"), store.read("touched"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning#" in plan and "LeftSemi" in plan
    expected = store.read("unified_content").collect()
    expected = [r for r in expected if (r.content_type, r.published_date) in rows]
    assert sorted(map(repr, found.collect())) == sorted(map(repr, expected))


def test_a_window_reads_its_rows_by_a_pushed_filter(spark, tmp_path):
    store = FolderStore(spark, str(tmp_path))
    fill(store, spark, random.Random(7), 0)
    plan = refresh.within(store.read("news_articles"), "2024-01-01", "2024-01-02")._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(extracted_date), GreaterThanOrEqual(extracted_date" in plan


@pytest.mark.parametrize("kind", ["folder", "catalog"])
@pytest.mark.parametrize("table", [refresh.UNIFIED, refresh.DAYS])
def test_a_refresh_that_dies_is_finished_by_the_next(spark, tmp_path, monkeypatch, kind, table):
    pick = random.Random(8)
    store, whole = made(kind, spark, tmp_path), made("folder", spark, tmp_path)
    last = fill(store, spark, pick, 0)
    run_all(store)
    last = fill(store, spark, pick, 1, last)
    for verb in VERBS[:-1]:
        jobs.run(verb, store, batch=window(1))
    replace = store.replace_parts

    def dies(name, df, partition_by=()):
        if name == table:
            # As if some folders had been emptied before the process went away.
            replace(name, df.limit(1), partition_by)
            raise KeyboardInterrupt
        replace(name, df, partition_by)

    monkeypatch.setattr(store, "replace_parts", dies)
    with pytest.raises(KeyboardInterrupt):
        jobs.run("merge_all", store, batch=window(1))
    monkeypatch.undo()
    if kind == "catalog":
        store.staging_folder = lambda: str(tmp_path / store.database)
    fill(store, spark, pick, 2, last)
    for batch in (window(2), window(1)):
        run_all(store, batch)
    for raw in ("news_articles", "reddit_posts", "scholarly_articles"):
        whole.append(raw, store.read(raw))
    run_all(whole)
    for name in (refresh.UNIFIED, refresh.DAYS):
        assert contents(store, name, *STAMPS) == contents(whole, name, *STAMPS)


def test_trending_topics_from_the_counts_of_days(spark, tmp_path):
    pick = random.Random(9)
    rows = [
        (
            pick.choice(["news", "academic"]),
            None if pick.random() < 0.1 else dt.date(2024, 1, 30) - dt.timedelta(days=pick.randrange(-1, 8)),
            pick.choice(["a", "b", None, ""]),
            pick.choice([None, 0.25, 0.5, 1.0]),
        )
        for _ in range(400)
    ]
    unified = spark.createDataFrame(
        rows, "content_type string, published_date date, category string, sentiment_score double"
    )
    store = FolderStore(spark, str(tmp_path))
    # Counts of parts of the rows add up: three partial tables for the same days.
    for part in unified.randomSplit([1.0, 1.0, 1.0], seed=1):
        store.append(refresh.DAYS, ranking.daily_categories(part))
    days = store.read(refresh.DAYS)
    for as_of, back in (("2024-01-30", 3), ("2024-01-27", 0), ("2024-01-30", 14)):
        expected = ranking.trending_topics(unified, as_of, back).collect()
        assert ranking.trending_topics_of_days(days, as_of, back).collect() == expected
    counted = ranking.category_counts_of_days(days, days=None)
    assert sorted(map(repr, counted.collect())) == sorted(
        map(repr, ranking.category_counts(unified, days=None).collect())
    )


def test_insights_rank_categories_without_the_content_table(spark, tmp_path):
    store = FolderStore(spark, str(tmp_path))
    last = fill(store, spark, random.Random(10), 0)
    run_all(store)
    fill(store, spark, random.Random(11), 1, last)
    run_all(store, window(1))
    ranked = ranking.trending_topics_of_days(store.read(refresh.DAYS), "2024-01-01")
    scans = [x for x in ranked._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in x]
    assert len(scans) == 1 and "published_date" in scans[0].split("PartitionFilters")[1]
    assert all("/category_days/" in file for file in ranked.inputFiles())
    expected = ranking.trending_topics(store.read("unified_content"), "2024-01-01").collect()
    assert ranked.collect() == expected and expected


@pytest.mark.parametrize("held", [1_000_000, 0])
def test_rows_without_the_keys_of_others(spark, tmp_path, monkeypatch, held):
    """As a left anti-join: repeated rows and rows without a key, few keys to drop, few to keep, none."""
    monkeypatch.setattr(refresh, "HELD_KEYS", held)
    keys = [None, None, 1, 1, 2, 3, 4, 5]
    rows = spark.createDataFrame([(k, f"text {i}") for i, k in enumerate(keys)], "id long, text string")
    for gone in ([], [None], [9, 9], [1, 1, None], [1, 2, 3, 4], [1, 2, 3, 4, 5], [2, 3, 4, 5, 6, 7]):
        others = spark.createDataFrame([(g,) for g in gone], "id long")
        expected = sorted(map(repr, rows.join(others, "id", "left_anti").collect()))
        with refresh.without(rows, others, "id", str(tmp_path)) as left:
            assert sorted(map(repr, left.collect())) == expected, gone
            assert left.columns == rows.columns
    keyed = rows.filter("id IS NOT NULL")
    with refresh.without(keyed, keyed.select("id"), "id", str(tmp_path)) as left:
        assert left.collect() == []


def test_texts_do_not_move_to_compare_keys(spark, tmp_path, monkeypatch):
    store = FolderStore(spark, str(tmp_path))
    pick = random.Random(12)
    last = 0
    for day in (0, 1):
        last = fill(store, spark, pick, day, last)
    run_all(store)
    fill(store, spark, pick, 1, last)
    plans = {}
    append, swap = store.append, store.swap_parts
    planned = lambda df: df._jdf.queryExecution().executedPlan().toString()

    def appends(table, df):
        plans[table] = planned(df)
        append(table, df)

    def swaps(table, df, partition_by):
        plans[table] = planned(df)
        swap(table, df, partition_by)

    monkeypatch.setattr(store, "append", appends)
    monkeypatch.setattr(store, "swap_parts", swaps)
    # As for large tables, whose ids Spark does not broadcast by itself.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        run_all(store, window(1))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    transformed = [f"transformed_{t}" for t in ("news_articles", "reddit_posts", "scholarly_articles")]
    for table in transformed:
        assert "SortMergeJoin [id" not in plans[table] and "Exchange hashpartitioning(id" not in plans[table]
    assert "clean_content" in plans[refresh.UNIFIED]
    assert "hashpartitioning(unified_id" not in plans[refresh.UNIFIED]


def test_stored_files_are_packed_with_zstd(spark, tmp_path):
    store = FolderStore(spark, str(tmp_path))
    pick = random.Random(13)
    last = fill(store, spark, pick, 0)
    run_all(store)
    fill(store, spark, pick, 1, last)
    run_all(store, window(1))
    files = files_below(tmp_path)
    assert files and all(name.endswith(".zstd.parquet") for name in files)
