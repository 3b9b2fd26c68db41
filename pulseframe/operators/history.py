"""Rows with the version of their key that was valid on their day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def version_on(
    rows: DataFrame,
    versions: DataFrame,
    key: str,
    day: str,
    columns: Sequence[str],
    starts: str = "effective_date",
    ends: str = "expiry_date",
) -> DataFrame:
    """``rows`` with ``columns`` of the version of ``key`` that is valid on ``day``.

    A version is valid from ``starts`` on and before ``ends``, or for ever without one; of several
    that start on a day the one that ends last counts. Rows without a valid version, a key or a day keep
    nulls; versions without a key or a start match nothing. Every row stays, once.

    A join on a range of days would pair each row with all versions of its key first. Here both sides
    are put together by a union and shuffled once, by key and sorted by day, and each row takes the
    last version before it. The daily facts have one row per user and day, so a key is bounded by the
    calendar and its changes.
    """
    version = F.struct(*[F.col(c) for c in columns], F.col(ends).cast("date").alias("_ends"))
    known = versions.filter(F.col(key).isNotNull() & F.col(starts).isNotNull())
    known = known.select(
        F.col(key).alias("_key"),
        F.col(starts).cast("date").alias("_at"),
        F.lit(0).alias("_kind"),
        F.coalesce(F.col(ends).cast("date"), F.lit("9999-12-31").cast("date")).alias("_order"),
        version.alias("_version"),
    )
    facts = rows.select(
        F.col(key).alias("_key"),
        F.col(day).cast("date").alias("_at"),
        F.lit(1).alias("_kind"),
        F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("_row"),
    )
    both = known.unionByName(facts, allowMissingColumns=True)
    before = Window.partitionBy("_key").orderBy("_at", "_kind", "_order")
    last = F.last("_version", ignorenulls=True).over(before.rowsBetween(Window.unboundedPreceding, 0))
    found = both.withColumn("_found", last).filter("_kind = 1")
    valid = F.col("_key").isNotNull() & F.col("_at").isNotNull() & (
        F.col("_found._ends").isNull() | (F.col("_at") < F.col("_found._ends"))
    )
    return found.select("_row.*", *[F.when(valid, F.col(f"_found.{c}")).alias(c) for c in columns])
