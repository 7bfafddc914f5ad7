"""Appends that survive a failed run: ids are reserved before rows are written.

The table ``id_ranges`` records each reservation, with the batch it is for, as open before the append
and once more as closed after it. A range counts as used from the first record on, whether or not its
rows arrived, so ids never meet. What a batch has stored is what the table holds in the ranges of
that batch; a run that repeats it takes away those rows and stores the rest.
"""

from __future__ import annotations

import random
import time
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contentloom.schemas import schema
from contentloom.sources.storage import TableStore, last_id

ID_RANGES = "id_ranges"
OPEN, CLOSED, LOST = "open", "closed", "lost"


class RangeTaken(ValueError):
    """Ids that a run was given belong to another one, or to rows that are there."""


@dataclass(frozen=True)
class Reservation:
    """The ids first .. first + rows - 1 of a table."""

    table: str
    first: int
    rows: int
    batch_id: str | None
    token: str

    @property
    def end(self) -> int:
        return self.first + self.rows


class Ledger:
    """The record of the ids of one table."""

    def __init__(self, store: TableStore, table: str, attempts: int = 8):
        self.store, self.table, self.attempts = store, table, attempts
        store.create_if_absent(ID_RANGES)

    def _records(self) -> DataFrame:
        return self.store.read(ID_RANGES).filter(F.col("table_name") == self.table)

    def _write(self, kept: Reservation, state: str) -> None:
        record = (kept.table, kept.first, kept.rows, kept.batch_id, state, kept.token, None)
        row = self.store.spark.createDataFrame([record], schema(ID_RANGES))
        self.store.append(ID_RANGES, row.withColumn("recorded_at", F.current_timestamp()))

    def _meeting(self, first: int, rows: int) -> DataFrame:
        """Records of ranges that share an id with the given one."""
        return self._records().filter(
            (F.col("first_id") < first + rows) & (F.col("first_id") + F.col("rows") > first)
        )

    def next_id(self) -> int:
        """The first id behind all reservations, or behind the rows of a table without any."""
        end = self._records().agg(F.max(F.col("first_id") + F.col("rows"))).first()[0]
        return end if end is not None else last_id(self.store.read(self.table)) + 1

    def reserve(self, rows: int, batch_id: str | None = None, first: int | None = None) -> Reservation:
        """Record a range as open and return it.

        Without ``first`` it follows all others. If two runs choose the same range at a time, both
        see the other's record, give theirs up and try again a little later; records are read after
        they are written, so at most one of two meeting ranges is ever used. A given ``first`` that
        meets a recorded range, open or not, or a stored row, raises ``RangeTaken``.
        """
        for attempt in range(self.attempts):
            start = self.next_id() if first is None else first
            wanted = Reservation(self.table, start, rows, batch_id, uuid.uuid4().hex)
            if first is not None:
                self._refuse_taken(wanted)
            self._write(wanted, OPEN)
            others = self._meeting(start, rows).filter(
                ~F.col("token").eqNullSafe(wanted.token) & ~F.col("state").eqNullSafe(LOST)
            )
            if others.isEmpty():
                return wanted
            self._write(wanted, LOST)
            if first is not None:
                break
            time.sleep(random.random() * 0.1 * 2**attempt)
        raise RangeTaken(f"another run reserves ids of {self.table} from {start} on")

    def _refuse_taken(self, wanted: Reservation) -> None:
        taken = self._meeting(wanted.first, wanted.rows).select("first_id", "rows", "state").first()
        if taken:
            raise RangeTaken(
                f"ids {wanted.first} to {wanted.end - 1} of {self.table} meet the {taken.state or CLOSED} "
                f"range {taken.first_id} to {taken.first_id + taken.rows - 1}"
            )
        stored = self.store.read(self.table).filter(F.col("id").between(wanted.first, wanted.end - 1))
        if not stored.select("id").isEmpty():
            raise RangeTaken(f"{self.table} has rows with ids from {wanted.first} to {wanted.end - 1}")

    def close(self, kept: Reservation) -> None:
        self._write(kept, CLOSED)

    def ranges(self, batch_id: str) -> list[tuple[int, int]]:
        """First id and end of all ranges ever reserved for a batch; a few for each time it ran."""
        own = self._records().filter(F.col("batch_id") == batch_id).select("first_id", "rows").distinct()
        return sorted((row.first_id, row.first_id + row.rows) for row in own.collect())

    def stored(self, batch_id: str) -> DataFrame | None:
        """The rows of the table that belong to a batch, by a filter on ids that reaches the scan."""
        found = self.ranges(batch_id)
        if not found:
            return None
        within = F.lit(False)
        for first, end in found:
            within = within | ((F.col("id") >= first) & (F.col("id") < end))
        return self.store.read(self.table).filter(within)


def content_key(names: list[str]) -> list[Column]:
    """128 bits of the content of a row, NULL apart from every value and place."""
    parts = [part for name in names for part in (F.col(name).isNull(), F.col(name))]
    return [F.xxhash64(*parts).alias("_low"), F.xxhash64(F.lit(1), *parts).alias("_high")]


def not_yet_stored(rows: DataFrame, stored: DataFrame, names: list[str]) -> DataFrame:
    """The rows that ``stored`` does not have, compared by the columns ``names``.

    Equal rows count: of three equal rows, one is left where two are stored. Most rows leave by the
    anti join; only rows that are stored in part are numbered.
    """
    low, high = F.col("_low"), F.col("_high")
    there = stored.select(*content_key(names)).groupBy("_low", "_high").agg(F.count(F.lit(1)).alias("_there"))
    keyed = rows.select("*", *content_key(names))
    fresh = keyed.join(there, ["_low", "_high"], "left_anti")
    place = F.row_number().over(Window.partitionBy(low, high).orderBy(low))
    again = keyed.join(there, ["_low", "_high"]).withColumn("_place", place).filter("_place > _there")
    return fresh.select(*rows.columns).unionByName(again.select(*rows.columns))
