"""Splitting rows into good ones and rejects with a reason."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REASON = "reject_reason"


def with_reason(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Name of the first rule a row breaks, NULL for good rows.

    A rule is the condition under which a row is bad; an unknown outcome counts as good.
    """
    broken = [F.when(condition, F.lit(reason)) for reason, condition in rules.items()]
    return df.withColumn(REASON, F.coalesce(*broken, F.lit(None).cast("string")))


def good_rows(checked: DataFrame) -> DataFrame:
    return checked.filter(F.col(REASON).isNull()).drop(REASON)


def rejected_rows(checked: DataFrame) -> DataFrame:
    return checked.filter(F.col(REASON).isNotNull())


def reason_counts(checked: DataFrame) -> DataFrame:
    """Rows per reason; good rows are counted as ``stored``."""
    return (
        checked.groupBy(F.coalesce(REASON, F.lit("stored")).alias(REASON))
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def duplicate_keys(unified: DataFrame) -> DataFrame:
    """Keys that occur more than once: nothing in the pipeline removes repeats."""
    return (
        unified.groupBy("unified_id").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")
    )
