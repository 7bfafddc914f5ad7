"""Refreshes that do the work of a window of new rows, not of all history.

Raw tables only grow and every transform maps one row to one row, so a transformed table gets the
window's new rows behind its old ones. The unified table is kept in a folder for each type and day;
only the folders that the window's rows fall into are written again, from what they hold and the new
rows. The day's counts per category are kept the same way. A window may be run again at any time: its
rows are taken out before they are put in.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import ExitStack, contextmanager
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contentloom.operators.ranking import daily_categories
from contentloom.operators.unify import unify
from contentloom.sources.storage import TableStore, staged

UNIFIED, DAYS = "unified_content", "category_days"
#: The folders of both tables.
PARTS = ("content_type", "published_date")
#: Keys that a join may send to every task; where there are more, the rows are shuffled by their keys.
HELD_KEYS = 1_000_000


def within(df: DataFrame, since: str, until: str) -> DataFrame:
    """Rows extracted in a window, by a filter that reaches the scan."""
    at = F.col("extracted_date")
    return df.filter((at >= F.lit(since).cast("timestamp")) & (at < F.lit(until).cast("timestamp")))


@contextmanager
def without(rows: DataFrame, gone: DataFrame, key: str, folder: str | None) -> Iterator[DataFrame]:
    """``rows`` but for those whose key ``gone`` has, as a left anti-join gives them, while the block runs.

    Rows hold whole texts, so the keys are compared by themselves. Then the rows are filtered where the
    scan put them, by the keys to drop or the keys to keep, whichever are fewer. Rows without a key stay.
    """
    if gone.isEmpty():
        yield rows
        return
    dropped = gone.select(key).distinct().withColumn("dropped", F.lit(True))
    keys = rows.select(key).distinct().join(dropped, key, "left")
    with staged(keys.select(key, F.col("dropped").isNotNull().alias("dropped")), folder) as marked:
        counts = {row.dropped: row["count"] for row in marked.groupBy("dropped").count().collect()}
        drop, keep = counts.get(True, 0), counts.get(False, 0)
        if not drop:
            yield rows
        elif not keep:
            yield rows.filter(F.lit(False))
        elif min(drop, keep) > HELD_KEYS:
            yield rows.join(gone.select(key), key, "left_anti")
        elif drop <= keep:
            yield rows.join(F.broadcast(marked.filter("dropped").select(key)), key, "left_anti")
        else:
            kept = marked.filter("NOT dropped").select(F.col(key).alias("kept_key"))
            yield rows.join(F.broadcast(kept), F.col(key).eqNullSafe(F.col("kept_key")), "left_semi")


def append_transformed(
    store: TableStore,
    raw: DataFrame,
    table: str,
    transform: Callable[[DataFrame], DataFrame],
    since: str,
    until: str,
) -> None:
    """Append the window's rows that the transformed table does not have, known by their ids."""
    there = within(store.read(table), since, until).select("id")
    with without(within(raw, since, until), there, "id", store.staging_folder()) as new:
        store.append(table, transform(new))


def by_day(unified: DataFrame) -> DataFrame:
    """Rows of a type and day together, days too large for one file split."""
    return unified.hint("rebalance", *[F.col(name) for name in PARTS])


def write_unified(store: TableStore, unified: DataFrame) -> None:
    """The whole unified table and the counts of its days."""
    store.overwrite(UNIFIED, by_day(unified), partition_by=PARTS)
    store.overwrite(DAYS, daily_categories(store.read(UNIFIED)), partition_by=PARTS)


def touched_rows(unified: DataFrame, touched: DataFrame) -> DataFrame:
    """Rows of the unified table in the given folders (content_type, published_date).

    A semi-join on both columns: Spark hands the few folders to the scan, which opens no others. The
    comparison with the first day marks the folders as few. Rows without a day are in a folder of
    their own for each type and are taken where it was touched.
    """
    first = touched.agg(F.min("published_date")).first()[0]
    undated = [row.content_type for row in touched.filter("published_date IS NULL").collect()]
    none = unified.filter(F.col("published_date").isNull() & F.col("content_type").isin(undated))
    if first is None:
        return none
    dated = unified.join(touched.filter(F.col("published_date") >= F.lit(first)), list(PARTS), "left_semi")
    return dated.unionByName(none) if undated else dated


def refresh_unified(store: TableStore, since: str, until: str) -> dict[str, int]:
    """Put the window's rows into the unified table; returns how many rows and folders that concerned.

    Folders are written beside the table first. A run that dies while it puts them in place leaves a
    note, and the next one does that first, so no folder stays half replaced.
    """
    store.finish_swap(UNIFIED)
    store.finish_swap(DAYS)
    # Stored columns under other names, so reading them again costs less than another copy of the texts.
    fresh = unify(
        within(store.read("transformed_news_articles"), since, until),
        within(store.read("transformed_reddit_posts"), since, until),
        within(store.read("transformed_scholarly_articles"), since, until),
    )
    folder = store.staging_folder()
    with ExitStack() as opened:
        touched = opened.enter_context(staged(fresh.select(*PARTS).distinct(), folder))
        counts = {"rows": fresh.count(), "folders": touched.count()}
        if counts["folders"]:
            unified = store.read(UNIFIED)
            parts = [fresh]
            # By type: long texts of one need not move because short rows of another are many.
            for row in touched.select("content_type").distinct().collect():
                own = F.col("content_type") == row.content_type
                there = touched_rows(unified.filter(own), touched.filter(own))
                again = fresh.filter(own).select("unified_id")
                parts.append(opened.enter_context(without(there, again, "unified_id", folder)))
            whole = reduce(DataFrame.unionByName, parts).select(*unified.columns)
            store.swap_parts(UNIFIED, by_day(whole), PARTS)
            store.swap_parts(DAYS, daily_categories(touched_rows(store.read(UNIFIED), touched)), PARTS)
    return counts
