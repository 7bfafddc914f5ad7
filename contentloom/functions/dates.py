"""Date rules. Time stamps follow the session time zone, which the jobs pin to UTC."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

_ISO_START = r"^\d{4}-\d{2}-\d{2}"
_WEEKDAY = r"(?i)^(mon|tue|wed|thu|fri|sat|sun),\s+"


def as_date(as_of: dt.date | str | Column | None) -> Column:
    """A day given as date, ISO text or column; the current day when absent."""
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of
    return F.lit(dt.date.fromisoformat(as_of) if isinstance(as_of, str) else as_of)


def as_timestamp(moment: dt.datetime | str | Column | None) -> Column:
    """A moment given as datetime, text or column; the current time when absent."""
    if moment is None:
        return F.current_timestamp()
    if isinstance(moment, Column):
        return moment
    return F.lit(str(moment)).cast("timestamp")


def recent(day: Column, as_of: Column, days: int) -> Column:
    """At most ``days`` days before ``as_of``. Future days pass, NULL does not.

    Written as a comparison with a constant so that it can be pushed to the scan.
    """
    return day >= F.date_sub(as_of, days)


def iso_timestamp(text: Column) -> Column:
    """Text that starts like an ISO date; NULL otherwise. Trailing remarks are ignored."""
    return F.when(
        text.rlike(_ISO_START),
        F.coalesce(F.try_to_timestamp(text), F.try_to_timestamp(F.substring(text, 1, 10))),
    )


def mail_timestamp(text: Column) -> Column:
    """``Mon, 02 Jan 2023 10:00:00 +0000`` with a numeric offset or Z; NULL otherwise."""
    return F.when(
        text.rlike(_WEEKDAY),
        F.try_to_timestamp(
            F.regexp_replace(text, _WEEKDAY, ""), F.lit("d MMM yyyy H:m:s [XXX][XX]")
        ),
    )


# Zone names of mail dates and their offsets.
ZONE_OFFSETS = {
    "GMT": "+0000",
    "UTC": "+0000",
    "UT": "+0000",
    "EST": "-0500",
    "EDT": "-0400",
    "CST": "-0600",
    "CDT": "-0500",
    "MST": "-0700",
    "MDT": "-0600",
    "PST": "-0800",
    "PDT": "-0700",
}


def any_mail_timestamp(text: Column) -> Column:
    """As ``mail_timestamp``, also with a zone name and without a weekday."""
    zone = F.regexp_extract(text, r"\s([A-Z]{2,3})$", 1)
    offsets = F.create_map(*[F.lit(part) for pair in ZONE_OFFSETS.items() for part in pair])
    numeric = F.regexp_replace(text, r"\s[A-Z]{2,3}$", "")
    dated = F.when(zone == "", text).otherwise(F.concat_ws(" ", numeric, F.try_element_at(offsets, zone)))
    return F.try_to_timestamp(
        F.regexp_replace(dated, _WEEKDAY, ""), F.lit("d MMM yyyy H:m:s [XXX][XX]")
    )


def page_timestamp(text: Column, default: Column) -> Column:
    """Date found on a page: ISO text, else the default."""
    return F.when(text.rlike(_ISO_START), iso_timestamp(text)).otherwise(default)


def feed_timestamp(text: Column, default: Column) -> Column:
    """Date of a feed item: ISO text or a mail date, else the default."""
    return F.when(text.rlike(_ISO_START), iso_timestamp(text)).otherwise(
        F.coalesce(mail_timestamp(text), default)
    )


def epoch_timestamp(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds)
