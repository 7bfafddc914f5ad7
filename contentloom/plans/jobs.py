"""Jobs by verb: read tables of a store, apply the operators, write tables.

    python -m contentloom.plans.jobs merge_all --root /data/content
"""

from __future__ import annotations

import argparse
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from contentloom.operators.insights import build_insights
from contentloom.operators.quality import (
    REASON,
    good_rows,
    reason_counts,
    rejected_rows,
    with_reason,
)
from contentloom.operators.ranking import trending_topics, trending_topics_of_days
from contentloom.operators.serving import digest_messages
from contentloom.operators.topics import TopicSettings
from contentloom.operators.transform import transform_news, transform_posts, transform_scholarly
from contentloom.operators.unify import unify
from contentloom.plans import refresh
from contentloom.schemas import conform, declared_rules, ensure_column, schema
from contentloom.session import pin_session
from contentloom.sources import feeds, pages, stories
from contentloom.sources.ledger import Ledger, not_yet_stored
from contentloom.sources.storage import CatalogStore, FolderStore, TableStore, number_rows, staged

REJECTS = "rejected_rows"


@dataclass(frozen=True)
class Batch:
    """Which payloads a run takes, by ``fetched_at`` (``since`` included, ``until`` not), and ids.

    ``first_id`` starts the range of ids that the caller has set aside for this run; without it ids
    follow all that are reserved. ``batch_id`` names what the run takes, so that a run that repeats it
    stores nothing twice; by default that is a window with both ends. Runs without a name always
    store all they take.
    """

    since: str | None = None
    until: str | None = None
    first_id: int | None = None
    batch_id: str | None = None

    def payloads(self, store: TableStore, table: str) -> DataFrame:
        return self.within(store.read(table))

    def within(self, found: DataFrame) -> DataFrame:
        if self.since is not None:
            found = found.filter(F.col("fetched_at") >= F.lit(self.since).cast("timestamp"))
        if self.until is not None:
            found = found.filter(F.col("fetched_at") < F.lit(self.until).cast("timestamp"))
        return found

    @property
    def windowed(self) -> bool:
        return self.since is not None and self.until is not None

    def name(self, verb: str) -> str | None:
        if self.batch_id is not None:
            return f"{verb} {self.batch_id}"
        if not self.windowed:
            return None
        return f"{verb} {self.since} to {self.until}"


EVERYTHING = Batch()


def _transform(
    store: TableStore,
    raw: DataFrame,
    table: str,
    transform: Callable[[DataFrame], DataFrame],
    batch: Batch,
) -> None:
    """All rows anew, or those of a window with both ends behind the ones that are there."""
    if batch.windowed and store.exists(table):
        refresh.append_transformed(store, raw, table, transform, batch.since, batch.until)
    else:
        store.overwrite(table, transform(raw))


def news_articles(store: TableStore, batch: Batch = EVERYTHING) -> None:
    _transform(store, store.read("news_articles"), "transformed_news_articles", transform_news, batch)


def reddit_posts(store: TableStore, batch: Batch = EVERYTHING) -> None:
    _transform(store, store.read("reddit_posts"), "transformed_reddit_posts", transform_posts, batch)


def scholarly_articles(store: TableStore, batch: Batch = EVERYTHING) -> None:
    raw = ensure_column(store.read("scholarly_articles"), "language", F.lit("en"))
    _transform(store, raw, "transformed_scholarly_articles", transform_scholarly, batch)


def merge_all(store: TableStore, batch: Batch = EVERYTHING) -> dict[str, int] | None:
    """Unified rows in a folder for each content type and day, and the counts of each day.

    Reports read the last days of the table. With a window, only the folders that its rows fall into
    are written again.
    """
    if batch.windowed and store.exists(refresh.UNIFIED) and store.exists(refresh.DAYS):
        return refresh.refresh_unified(store, batch.since, batch.until)
    unified = unify(
        store.read("transformed_news_articles"),
        store.read("transformed_reddit_posts"),
        store.read("transformed_scholarly_articles"),
    )
    refresh.write_unified(store, unified)
    return None


def insights(
    store: TableStore, as_of=None, settings: TopicSettings = TopicSettings(cleaned=True), generated_at=None
) -> dict[str, int]:
    """Store the insights of one run; returns the number of rows by outcome.

    Insights are kept by day and run. A run that repeats one, that is with the same
    ``generated_at``, replaces its rows and leaves those of all others. Rows are counted while they
    are written. A trending category without a name cannot become an insight and goes to the rejects.
    Categories are ranked by the counts that ``merge_all`` keeps of each day, where there are any.
    """
    unified = store.register("unified_content")
    store.create_if_absent("content_insights")
    if store.exists(refresh.DAYS):
        ranked = trending_topics_of_days(store.read(refresh.DAYS), as_of)
    else:
        ranked = trending_topics(unified, as_of)
    with staged(ranked, store.staging_folder()) as trending:
        rows = build_insights(unified, as_of, generated_at, settings, trending, store.staging_folder())
        counted = Observation()
        store.replace_parts(
            "content_insights",
            conform(rows, "content_insights").observe(counted, F.count(F.lit(1)).alias("stored")),
        )
        checked = with_reason(trending, {"unnamed category": F.col("category").isNull()})
        unnamed = rejected_rows(checked).count()
        if unnamed:
            run = None if generated_at is None else f"insights {generated_at}"
            _store_rejects(store, "content_insights", rejected_rows(checked), run)
    return {**counted.get, **({"unnamed category": unnamed} if unnamed else {})}


def digest(store: TableStore, as_of=None) -> DataFrame:
    """Messages of the day's best insights, read from the folders of that day alone."""
    return digest_messages(store.read_laid_out("content_insights"), as_of)


def _store_rejects(store: TableStore, table: str, bad: DataFrame, batch_id: str | None = None) -> None:
    """Append rows with their reasons; a batch that is repeated stores only those it did not store."""
    fields = [c for c in bad.columns if c != REASON]
    rows = bad.select(
        F.lit(table).alias("table_name"),
        REASON,
        F.to_json(F.struct(*fields)).alias("row"),
        F.lit(batch_id).cast("string").alias("batch_id"),
    )
    if batch_id is None or not store.exists(REJECTS):
        store.append(REJECTS, rows)
        return
    same = (F.col("table_name") == table) & (F.col("batch_id") == batch_id)
    fresh = not_yet_stored(rows, store.read(REJECTS).filter(same), ["table_name", REASON, "row"])
    with staged(fresh, store.staging_folder()) as left:
        if not left.isEmpty():
            store.append(REJECTS, left)


#: Outcome of rows that an earlier run of the same batch has stored.
BEFORE = "stored before"


def _append_numbered(
    store: TableStore, table: str, good: DataFrame, rows: int, batch_id: str | None, first_id: int | None
) -> None:
    """Reserve ids, append the rows of a staged table with them, close the reservation.

    A run that dies on the way leaves the reservation open: its ids are never given again, and what
    it has stored is found by them.
    """
    ledger = Ledger(store, table)
    kept = ledger.reserve(rows, batch_id, first_id)
    store.append(table, conform(number_rows(good, kept.first), table))
    ledger.close(kept)


def store_rows(
    store: TableStore,
    table: str,
    rows: DataFrame,
    failed: DataFrame,
    rules: Mapping[str, Column] | None = None,
    first_id: int | None = None,
    batch_id: str | None = None,
) -> dict[str, int]:
    """Append extracted rows to a raw table; bad rows and failed payloads go to the rejects.

    Bad are rows that break one of ``rules`` or the table's declared widths and required columns.
    Returns the number of rows, and of failed payloads, by outcome. An empty batch writes nothing.
    Of a batch with a name, rows that an earlier run of it has stored are left out and counted.
    """
    folder = store.staging_folder()
    checks = {**(rules or {}), **declared_rules(rows, table)}
    with staged(with_reason(rows, checks), folder) as checked:
        counts = {row[REASON]: row["rows"] for row in reason_counts(checked).collect()}
        if stored := counts.get("stored"):
            store.create_if_absent(table)
            store.add_missing_columns(table)
            good = good_rows(checked)
            there = Ledger(store, table).stored(batch_id) if batch_id is not None else None
            if there is None:
                _append_numbered(store, table, good, stored, batch_id, first_id)
            else:
                names = [f.name for f in schema(table).fields if f.name in good.columns and f.name != "id"]
                typed = conform(good, table).select(*names)
                with staged(not_yet_stored(typed, there, names), folder) as fresh:
                    left = fresh.count()
                    if left:
                        _append_numbered(store, table, fresh, left, batch_id, first_id)
                counts |= {"stored": left, BEFORE: stored - left}
        if counts.keys() - {"stored", BEFORE}:
            _store_rejects(store, table, rejected_rows(checked), batch_id)
    with staged(failed, folder) as bad:
        lost = {row[REASON]: row["rows"] for row in reason_counts(bad).collect()}
        if lost:
            _store_rejects(store, table, bad, batch_id)
    return {reason: counts.get(reason, 0) + lost.get(reason, 0) for reason in counts | lost}


def _unreadable_date() -> dict[str, Column]:
    return {"unreadable date": F.col("published_date").isNull()}


def extract_news_feeds(store: TableStore, batch: Batch = EVERYTHING) -> dict[str, int]:
    payloads = feeds.with_details(batch.payloads(store, "news_feed_payloads"), feeds.news_feeds())
    with staged(feeds.parse_feeds(payloads), store.staging_folder()) as parsed:
        return store_rows(
            store,
            "news_articles",
            feeds.news_articles(parsed),
            feeds.failed_payloads(parsed, fetched_only=False),
            _unreadable_date(),
            batch.first_id,
            batch.name("extract_news_feeds"),
        )


def extract_scholarly_feeds(store: TableStore, batch: Batch = EVERYTHING) -> dict[str, int]:
    payloads = feeds.with_details(
        batch.payloads(store, "scholarly_feed_payloads"), feeds.scholarly_feeds()
    )
    with staged(feeds.parse_feeds(payloads), store.staging_folder()) as parsed:
        return store_rows(
            store,
            "scholarly_articles",
            feeds.scholarly_articles(parsed),
            feeds.failed_payloads(parsed, fetched_only=True),
            _unreadable_date(),
            batch.first_id,
            batch.name("extract_scholarly_feeds"),
        )


def extract_stories(store: TableStore, batch: Batch = EVERYTHING) -> dict[str, int]:
    payloads = batch.payloads(store, "story_payloads")
    with staged(stories.parse_stories(payloads), store.staging_folder()) as parsed:
        return store_rows(
            store,
            "reddit_posts",
            stories.story_posts(parsed),
            stories.failed_payloads(parsed),
            first_id=batch.first_id,
            batch_id=batch.name("extract_stories"),
        )


def store_pages(store: TableStore, fetched: DataFrame) -> None:
    """Keep fetched pages (url, status, html, fetched_at, perhaps profile) with the profile of their
    address, by which they are laid out."""
    known = pages.with_profiles(fetched, pages.all_profiles())
    store.append("page_payloads", conform(known, "page_payloads"))


def _extract_pages(
    store: TableStore,
    batch: Batch,
    verb: str,
    table: str,
    profiles: list[pages.PageProfile],
    rows: Callable[[DataFrame], DataFrame],
    rules: Mapping[str, Column] | None = None,
    strays: bool = False,
) -> dict[str, int]:
    """Read the pages of some profiles once; ``strays`` also rejects pages that no profile reads.

    Pages are kept by profile, so the scan opens the folders of these profiles and of pages that were
    stored without one, and for strays those of profiles that nobody has.
    """
    everyone = pages.all_profiles()
    stored = batch.within(store.read_laid_out("page_payloads"))
    payloads = pages.with_profiles(pages.of_profiles(stored, profiles, everyone if strays else ()), everyone)
    with staged(pages.page_blocks(payloads, profiles), store.staging_folder()) as blocks:
        failed = pages.failed_payloads(payloads, profiles, everyone if strays else ())
        failed = failed.unionByName(pages.unreadable_pages(blocks))
        return store_rows(store, table, rows(blocks), failed, rules, batch.first_id, batch.name(verb))


def extract_forum_pages(store: TableStore, batch: Batch = EVERYTHING) -> dict[str, int]:
    return _extract_pages(
        store, batch, "extract_forum_pages", "reddit_posts", pages.forum_profiles(), pages.forum_posts
    )


def extract_news_pages(store: TableStore, batch: Batch = EVERYTHING) -> dict[str, int]:
    """Also rejects pages whose address and profile nobody knows."""
    return _extract_pages(
        store,
        batch,
        "extract_news_pages",
        "news_articles",
        pages.news_profiles(),
        pages.news_articles,
        strays=True,
    )


def extract_scholarly_pages(store: TableStore, batch: Batch = EVERYTHING) -> dict[str, int]:
    return _extract_pages(
        store,
        batch,
        "extract_scholarly_pages",
        "scholarly_articles",
        pages.scholarly_profiles(),
        pages.scholarly_articles,
        _unreadable_date(),
    )


JOBS: dict[str, Callable] = {
    job.__name__: job
    for job in (
        extract_news_feeds,
        extract_scholarly_feeds,
        extract_stories,
        extract_forum_pages,
        extract_news_pages,
        extract_scholarly_pages,
        news_articles,
        reddit_posts,
        scholarly_articles,
        merge_all,
        insights,
        digest,
    )
}
#: Jobs that take a batch.
BY_BATCH = frozenset(job for job in JOBS if job not in ("insights", "digest"))


def run(
    verb: str,
    store: TableStore,
    as_of=None,
    generated_at=None,
    batch: Batch = EVERYTHING,
):
    """Run the job of that name; raises ``ValueError`` for an unknown one.

    ``generated_at`` stamps insights; a run that repeats a failed one gives the same time, so that
    its insights get the same ids.
    """
    if verb not in JOBS:
        raise ValueError(f"unknown job {verb!r}, expected one of {', '.join(JOBS)}")
    pin_session(store.spark)
    job = JOBS[verb]
    if verb == "insights":
        return job(store, as_of=as_of, generated_at=generated_at)
    if verb == "digest":
        return job(store, as_of=as_of)
    return job(store, batch) if verb in BY_BATCH else job(store)


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Run one content job")
    parser.add_argument("verb", choices=JOBS)
    parser.add_argument("--root", help="folder that holds the tables")
    parser.add_argument("--database", help="catalog database that holds the tables instead")
    parser.add_argument("--as-of", help="day the reports refer to, YYYY-MM-DD; default today")
    parser.add_argument("--generated-at", help="time stamp of insights; default now")
    parser.add_argument("--since", help="first fetch time of what a job takes in")
    parser.add_argument("--until", help="fetch time at which that ends")
    parser.add_argument("--first-id", type=int, help="start of this run's range of ids")
    parser.add_argument("--batch-id", help="name of what is extracted, if not a window with both ends")
    given = parser.parse_args(arguments)
    if bool(given.root) == bool(given.database):
        parser.error("give either --root or --database")
    spark = SparkSession.builder.appName(f"contentloom {given.verb}").getOrCreate()
    try:
        store = FolderStore(spark, given.root) if given.root else CatalogStore(spark, given.database)
        batch = Batch(given.since, given.until, given.first_id, given.batch_id)
        outcome = run(given.verb, store, given.as_of, given.generated_at, batch)
        if isinstance(outcome, DataFrame):
            for row in outcome.select("message").collect():
                print(row.message)
        elif outcome is not None:
            print(outcome)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
