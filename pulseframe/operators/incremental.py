"""Watermarks, upserts and history tables as plain DataFrame operators."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseframe.operators.dedup import latest_per_key

# Fixed value: the watermark of an empty target.
FLOOR = dt.datetime(1900, 1, 1)


def read_watermark(target: DataFrame, column: str, floor: dt.datetime = FLOOR) -> dt.datetime:
    """Greatest value in the target, or the floor. One row reaches the driver."""
    newest = target.agg(F.max(column)).first()[0]
    return newest if newest is not None else floor


def after_watermark(
    df: DataFrame,
    column: str,
    watermark: dt.datetime,
    lookback: dt.timedelta = dt.timedelta(0),
) -> DataFrame:
    """Rows strictly newer than the watermark; ``lookback`` re-reads a late tail.

    The watermark is a literal, so the filter reaches the file scan.
    """
    limit = F.lit((watermark - lookback).isoformat(sep=" ")).cast("timestamp_ntz")
    return df.filter(F.col(column) > limit)


def after_target(
    df: DataFrame, target: DataFrame, column: str, floor: dt.datetime = FLOOR
) -> DataFrame:
    """Rows strictly newer than the target's greatest value, as one lazy plan."""
    limit = target.agg(
        F.coalesce(F.max(column), F.lit(floor.isoformat(sep=" ")).cast("timestamp_ntz"))
    )
    return df.filter(F.col(column) > limit.scalar())


def since_horizon(df: DataFrame, day: str, as_of: Column, days: int) -> DataFrame:
    """Rows of the last ``days`` days before ``as_of`` (inclusive)."""
    return df.filter(F.col(day) >= F.date_sub(as_of, days))


def merge_upsert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Matched keys take the source row, unmatched source rows are added.

    ``source`` has to be unique on ``keys``.
    """
    kept = target.join(source.select(*keys), list(keys), "left_anti")
    return kept.select(*target.columns).unionByName(source)


def merge_partial(
    target: DataFrame, source: DataFrame, keys: Sequence[str], update: Sequence[str]
) -> DataFrame:
    """Matched keys take only the ``update`` columns of the source; the rest is kept."""
    t = target.withColumn("_in_target", F.lit(True)).alias("t")
    s = source.withColumn("_in_source", F.lit(True)).alias("s")
    on = [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys]
    joined = t.join(s, on, "full_outer")
    in_target, in_source = F.col("t._in_target").isNotNull(), F.col("s._in_source").isNotNull()
    cols = []
    for name in target.columns:
        old, new = F.col(f"t.{name}"), F.col(f"s.{name}")
        take_new = in_source if name in update else ~in_target
        cols.append(F.when(take_new, new).otherwise(old).alias(name))
    return joined.select(*cols)


def update_matched(
    target: DataFrame, source: DataFrame, keys: Sequence[str], update: Sequence[str]
) -> DataFrame:
    """Matched keys take the ``update`` columns of the source; source rows without a match are left out."""
    new = source.select(
        *[F.col(k).alias(f"_key_{k}") for k in keys], F.struct(*update).alias("_new")
    )
    same = [F.col(k) == F.col(f"_key_{k}") for k in keys]
    joined = target.join(new, same, "left")
    return joined.select(
        *[
            F.when(F.col("_new").isNotNull(), F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c)
            if c in update
            else c
            for c in target.columns
        ]
    )


def merge_newest(
    target: DataFrame, source: DataFrame, keys: Sequence[str], order: Sequence[Column | str]
) -> DataFrame:
    """Of target and source rows with the same key keep the newest, whichever side it is on.

    Unlike :func:`merge_upsert` the outcome does not depend on the order of batches.
    """
    return latest_per_key(target.unionByName(source), keys, order)


def align_schema(target: DataFrame, source: DataFrame, policy: str) -> DataFrame:
    """Target with the columns the policy allows: ``fail`` or ``append_new_columns``."""
    new = [f for f in source.schema.fields if f.name not in target.columns]
    missing = [c for c in target.columns if c not in source.columns]
    if policy == "fail":
        if new or missing:
            raise ValueError(
                f"schema changed: new {[f.name for f in new]}, missing {missing}"
            )
        return target
    if policy != "append_new_columns":
        raise ValueError(f"unknown schema policy: {policy}")
    return target.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in new])


def fill_missing(source: DataFrame, target: DataFrame) -> DataFrame:
    """Source in the target's column order, absent columns as typed nulls."""
    have = set(source.columns)
    return source.select(
        *[
            F.col(f.name) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name)
            for f in target.schema.fields
        ]
    )


def merge_with_policy(
    target: DataFrame, source: DataFrame, keys: Sequence[str], policy: str
) -> DataFrame:
    """Upsert after applying the schema policy."""
    wide = align_schema(target, source, policy)
    return merge_upsert(wide, fill_missing(source, wide), keys)


def merge_history(
    dim: DataFrame,
    updates: DataFrame,
    key: str,
    tracked: Sequence[str],
    effective: Column,
) -> DataFrame:
    """History dimension: close the current row of a changed key and open a new one.

    ``dim`` carries ``effective_date``, ``expiry_date`` and ``is_current``;
    ``updates`` holds one row per key with the tracked columns and others. Only
    the tracked columns decide whether a key has changed, but every column of
    the dimension is kept: a new row has the update's values, and the old row's
    where the update lacks the column.
    """
    history = ("effective_date", "expiry_date", "is_current")
    names = [c for c in dim.columns if c not in history]
    current = dim.filter("is_current").alias("c")
    new = updates.select(*[c for c in names if c in updates.columns]).alias("n")
    same = F.lit(True)
    for c in tracked:
        same = same & F.col(f"c.{c}").eqNullSafe(F.col(f"n.{c}"))
    pairs = current.join(new, F.col(f"c.{key}") == F.col(f"n.{key}"), "full_outer")
    is_old, is_new = F.col(f"c.{key}").isNotNull(), F.col(f"n.{key}").isNotNull()
    changed = is_old & is_new & ~same
    old_row = F.struct(
        *[F.col(f"c.{c}").alias(c) for c in names],
        F.col("c.effective_date").alias("effective_date"),
        F.when(changed, effective).otherwise(F.col("c.expiry_date")).alias("expiry_date"),
        (~changed).alias("is_current"),
    )
    new_row = F.struct(
        *[F.col(f"n.{c}" if c in updates.columns else f"c.{c}").alias(c) for c in names],
        effective.alias("effective_date"),
        F.lit(None).cast("date").alias("expiry_date"),
        F.lit(True).alias("is_current"),
    )
    rows = F.array_compact(
        F.array(F.when(is_old, old_row), F.when(changed | ~is_old, new_row))
    )
    closed = dim.filter(~F.col("is_current")).select(*names, *history)
    return pairs.select(F.inline(rows)).unionByName(closed)
