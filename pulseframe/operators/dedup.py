"""Keep the newest row of each key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _newest_first(order: Sequence[Column | str]) -> list[Column]:
    return [F.desc_nulls_first(o) if isinstance(o, str) else o for o in order]


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column | str],
    cut_in_maps: bool = True,
    order_is_total: bool = False,
) -> DataFrame:
    """First row of each key in ``order``; plain names sort newest first, nulls first.

    Rows that tie in all of ``order`` are told apart by a hash of their content, so
    a task that runs again keeps the same row.

    The rank filter directly above the window lets Spark keep one row per key in
    every map task before the shuffle (window group limit), so a key that holds a
    third of all rows still sends at most one row per task. For that a map task
    sorts its rows, and wide ones do not fit its memory: it writes nearly all it
    reads to disk. Without ``cut_in_maps`` rows are dealt by key first and sorted
    only there; that is for whole records of keys with few versions, since all
    versions of a key meet in one task.

    With ``order_is_total`` no two rows of a key tie, as where ``order`` has a unique
    id. No hash is made then, for which all columns would have to come along.
    """
    ties = [] if order_is_total else [F.xxhash64(*df.columns)]
    by_key = Window.partitionBy(*keys).orderBy(*_newest_first(order), *ties)
    dealt = df if cut_in_maps else df.repartition(*keys)
    ranked = dealt.withColumn("_rank", F.row_number().over(by_key))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def latest_row(df: DataFrame, keys: Sequence[str], order: str, cols: Sequence[str]) -> DataFrame:
    """Columns of the row with the greatest ``order`` per key, by partial aggregation."""
    picked = F.max_by(F.struct(*cols), F.col(order)).alias("_last")
    return df.groupBy(*keys).agg(picked).select(*keys, *[f"_last.{c}" for c in cols])
