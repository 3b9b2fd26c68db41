"""Moments of groups that grow and change: state that is merged instead of counting again.

The state of a measure is the number of its values, their sum and the sum of their squares, in decimals.
Decimal sums are exact, so parts can be added and taken away in any order, and a state that was
merged from many parts equals one that was counted at once to the last digit; with means and
squared deviations in floating point it would not.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The newest part that is in a row of the state.
APPLIED = "applied"
_PARTS = ("n", "total", "squares")


def _columns(measures: Sequence[str]) -> list[str]:
    return ["rows", *[f"{part}_{m}" for m in measures for part in _PARTS]]


def moments(
    df: DataFrame, keys: Sequence[str], measures: Sequence[str], sign: Column | None = None
) -> DataFrame:
    """State of each group: ``rows``, and ``n_``, ``total_`` and ``squares_`` of each decimal or whole measure.

    ``sign`` is 1 for rows that come and -1 for rows that go. All parts combine in the map tasks.
    """
    sign = F.lit(1) if sign is None else sign
    aggregates = [F.sum(sign).cast("long").alias("rows")]
    for m in measures:
        value = F.col(m).cast("decimal(12,4)")
        aggregates += [
            F.sum(F.when(value.isNotNull(), sign)).cast("long").alias(f"n_{m}"),
            F.sum(value * sign).cast("decimal(32,4)").alias(f"total_{m}"),
            F.sum(value * value * sign).cast("decimal(36,8)").alias(f"squares_{m}"),
        ]
    state = df.groupBy(*keys).agg(*aggregates)
    return state.na.fill(0, [c for c in state.columns if c not in keys])


def merge_part(
    state: DataFrame, part: DataFrame, keys: Sequence[str], measures: Sequence[str], name: str
) -> DataFrame:
    """State of the groups in ``part`` with it merged in; groups that it leaves alone are not returned.

    Parts have ascending names. A group that has the part already, after a run that stopped before it
    was done with it, stays as it is. A group without rows is kept, since it remembers the part.
    """
    columns = _columns(measures)
    known = state.join(part.select(*keys), list(keys), "left_semi").select(
        *keys, F.struct(*columns).alias("_old"), F.lit(None).cast(_kind(state, columns)).alias("_new"), APPLIED
    )
    new = part.select(
        *keys, F.lit(None).cast(_kind(state, columns)).alias("_old"),
        F.struct(*columns).cast(_kind(state, columns)).alias("_new"), F.lit(None).cast("string").alias(APPLIED),
    )
    both = known.unionByName(new).groupBy(*keys).agg(
        F.max("_old").alias("_old"), F.max("_new").alias("_new"), F.max(APPLIED).alias(APPLIED)
    )
    due = F.coalesce(F.col(APPLIED) < name, F.lit(True))

    def added(c: str) -> Column:
        kind = state.schema[c].dataType
        zero = F.lit(0).cast(kind)
        after = F.coalesce(F.col(f"_old.{c}"), zero) + F.when(due, F.coalesce(F.col(f"_new.{c}"), zero)).otherwise(zero)
        return after.cast(kind).alias(c)

    return both.select(*keys, *[added(c) for c in columns], F.when(due, F.lit(name)).otherwise(F.col(APPLIED)).alias(APPLIED))


def _kind(state: DataFrame, columns: Sequence[str]):
    return state.select(F.struct(*columns).alias("s")).schema["s"].dataType


def mean(m: str) -> Column:
    """Mean of a measure; null without values."""
    return F.col(f"total_{m}").cast("double") / F.nullif(F.col(f"n_{m}"), F.lit(0))


def deviation(m: str) -> Column:
    """Sample standard deviation of a measure; null with fewer than two values.

    The difference under the root is taken in decimals, where nothing cancels out.
    """
    n, total, squares = (F.col(f"{part}_{m}") for part in _PARTS)
    total = total.cast("decimal(18,4)")
    off = (squares.cast("decimal(26,8)") * n.cast("decimal(10,0)") - total * total).cast("double")
    return F.when(n > 1, F.sqrt(off / (n * (n - 1))))
