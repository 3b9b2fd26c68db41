"""Row frames over a user's daily series.

Every function here expects at most one row per user and day (see
:func:`pulseframe.operators.dedup.latest_per_key`). The days come from the date
dimension, so a user's partition is bounded by the calendar (4,018 rows for the
default range) however many raw rows that user has; the reduction to one row per
day happens in the map tasks, before anything is shuffled by user.

All frames count rows, not days: gaps in a series are not filled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

USER = "user_sk"
DAY = "date_sk"


def by_day(user: str = USER, day: str = DAY, *more: str) -> WindowSpec:
    return Window.partitionBy(user, *more).orderBy(F.asc_nulls_last(day))


def last_rows(n: int, user: str = USER, day: str = DAY) -> WindowSpec:
    """The current row and the ``n - 1`` before it."""
    return by_day(user, day).rowsBetween(-(n - 1), 0)


def previous_rows(n: int, user: str = USER, day: str = DAY, *more: str) -> WindowSpec:
    """The ``n`` rows before the current one."""
    return by_day(user, day, *more).rowsBetween(-n, -1)


def change(c: str, k: int, user: str = USER, day: str = DAY) -> Column:
    """Value minus the value ``k`` rows earlier."""
    return F.col(c) - F.lag(c, k).over(by_day(user, day))


def rows_so_far(n: int, user: str = USER, day: str = DAY) -> Column:
    """Count of the last ``n`` rows; a capped row number needs no sliding frame."""
    return F.least(F.row_number().over(by_day(user, day)), F.lit(n)).cast("long")


def percent_rank(c: str, descending: bool = False, user: str = USER) -> Column:
    """Rank 0..100 within the user's whole series; nulls last, or first if descending."""
    order = F.desc_nulls_first(c) if descending else F.asc_nulls_last(c)
    return F.percent_rank().over(Window.partitionBy(user).orderBy(order)) * 100


def rank_percentile(c: str, descending: bool = False, user: str = USER) -> Column:
    """Whole-number :func:`percent_rank`."""
    return F.round(percent_rank(c, descending, user)).cast("int")


def beside(
    left: DataFrame, right: DataFrame, columns: Sequence[str], user: str = USER, day: str = DAY
) -> DataFrame:
    """Left join of two daily series on user and day, laid out by user.

    Adds ``columns`` of the right side and ``_matched`` (true or null). Both sides
    hold at most one row per user and day, so the join is a union in which a row's
    partner is the next row of its user: every row is shuffled once, by user, and
    sorted once, and the per-user frames that follow reuse this layout. A join on both
    keys would shuffle by both, and its result again by user; a grouping would hold
    the rows in two hash tables before they are sorted. A second row for a user and
    day, on either side, is an error; right rows with a null key match nothing.
    """
    own = [c for c in left.columns if c not in (user, day)]
    known = right.filter(F.col(user).isNotNull() & F.col(day).isNotNull())
    both = left.withColumn("_other", F.lit(False)).unionByName(
        known.select(user, day, *columns, F.lit(True).alias("_other")), allowMissingColumns=True
    )
    # The order of by_day, so that its frames need no other sort.
    along = Window.partitionBy(user).orderBy(F.asc_nulls_last(day), "_other")
    same_day = F.lead(day).over(along).eqNullSafe(F.col(day))
    # After the last row of a user there is no side, so a null day there is not taken for its own.
    partner = same_day & F.lead("_other").over(along)
    merged = both.repartition(user).select(
        user,
        day,
        *own,
        *[F.when(partner, F.lead(c).over(along)).alias(c) for c in columns],
        F.when(partner, True).alias("_matched"),
        "_other",
        (same_day & (F.lead("_other").over(along) == F.col("_other"))).alias("_repeated"),
    )
    repeated = F.raise_error(F.lit("more than one row for a user and day")).cast("boolean")
    single = F.when(F.col("_repeated"), repeated)
    return merged.filter(F.coalesce(single, ~F.col("_other"))).drop("_other", "_repeated")
