"""Data-quality checks: failing rows of one check, or a summary of many.

A suite reads its table once for all row checks (conditional counts) and once
per uniqueness or relationship check; those reduce in the map tasks first. Row
checks can be counted while a table is written instead (:func:`watch`), so that
they need no reading at all.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# Batch volume above which a source is reported.
HIGH_VOLUME = 1000
# Parts of a table (months, say) whose failures are told apart while it is written.
MAX_PARTS = 10_000
# Stands for rows without a part in :func:`watch`.
_NO_PART = -1


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def unique(df: DataFrame, column: str) -> DataFrame:
    """Non-null values that occur more than once."""
    return unique_combination(df.filter(F.col(column).isNotNull()), [column])


def unique_combination(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Combinations that occur more than once, with their count."""
    return df.groupBy(*columns).agg(F.count("*").alias("n")).filter("n > 1")


def orphans(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Key values without a parent and how many child rows carry each.

    The child is counted per key before the join, so a hot key is one row there.
    """
    keys = (
        child.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n_rows"))
    )
    known = parent.select(F.col(field).alias(column))
    return keys.join(known, column, "left_anti")


def orphan_rows(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Child rows without a parent; rows with a null key are not orphans."""
    known = parent.select(F.col(field).alias(column))
    return child.filter(F.col(column).isNotNull()).join(known, column, "left_anti")


def out_of_range(
    column: str, low: float | None = None, high: float | None = None, inclusive: bool = True
) -> Column:
    """True where the value lies outside the range; a null value is not a failure."""
    c, tests = F.col(column), []
    if low is not None:
        tests.append(c < low if inclusive else c <= low)
    if high is not None:
        tests.append(c > high if inclusive else c >= high)
    if not tests:
        raise ValueError("a range needs a limit")
    return F.coalesce(reduce(lambda a, b: a | b, tests), F.lit(False))


def accepted_range(
    df: DataFrame,
    column: str,
    low: float | None = None,
    high: float | None = None,
    inclusive: bool = True,
    where: str | None = None,
) -> DataFrame:
    rows = df if where is None else df.filter(where)
    return rows.filter(out_of_range(column, low, high, inclusive))


def accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Values outside the list, with their count; nulls are not failures."""
    wrong = df.filter(F.col(column).isNotNull() & ~F.col(column).isin(*values))
    return wrong.groupBy(column).agg(F.count("*").alias("n"))


def expression_holds(df: DataFrame, expression: str, where: str | None = None) -> DataFrame:
    """Rows for which the expression is false; unknown counts as a failure."""
    rows = df if where is None else df.filter(where)
    return rows.filter(~F.coalesce(F.expr(expression), F.lit(False)))


def freshness(
    df: DataFrame,
    column: str,
    as_of: Column,
    warn_days: int,
    error_days: int,
    where: str | None = None,
) -> DataFrame:
    """Age of the newest row against a warning and an error limit, one row."""
    rows = df if where is None else df.filter(where)
    newest = rows.agg(F.max(column).alias("newest"))
    as_of = as_of.cast("timestamp_ntz")

    def older_than(days: int) -> Column:
        return F.col("newest") < as_of - F.expr(f"INTERVAL {int(days)} DAYS")

    status = (
        F.when(F.col("newest").isNull() | older_than(error_days), "error")
        .when(older_than(warn_days), "warn")
        .otherwise("pass")
    )
    return newest.withColumn("status", status)


def volume_status(source: Column, records: Column) -> Column:
    """Message level of a batch size: the single-profile source has to have one row."""
    return (
        F.when((source == "user") & (records != 1), "warn")
        .when((source != "user") & (records == 0), "info")
        .when((source != "user") & (records > HIGH_VOLUME), "warn")
        .otherwise("ok")
    )


def volume(batches: DataFrame, source: str, expected: DataFrame) -> DataFrame:
    """Records per expected source with a status; absent sources count zero."""
    counts = batches.groupBy(source).agg(F.count("*").alias("n"))
    all_sources = expected.join(counts, source, "left")
    records = F.coalesce("n", F.lit(0))
    return all_sources.select(
        F.col(source).alias("source"),
        records.alias("records"),
        volume_status(F.col(source), records).alias("status"),
    )


@dataclass(frozen=True)
class RowCheck:
    """A check of single rows: ``fails`` is true (or null, if strict) on a failing row."""

    name: str
    fails: Column


@dataclass(frozen=True)
class KeyCheck:
    """A check that needs a join or an aggregation: one row per failing key."""

    name: str
    failing: DataFrame
    weight: str | None = None


def null_check(column: str) -> RowCheck:
    return RowCheck(f"not_null_{column}", F.col(column).isNull())


def range_check(column: str, low: float, high: float) -> RowCheck:
    return RowCheck(f"accepted_range_{column}", out_of_range(column, low, high))


def expression_check(name: str, expression: str, where: str = "true") -> RowCheck:
    holds = F.coalesce(F.expr(expression), F.lit(False))
    return RowCheck(name, F.expr(where) & ~holds)


def unique_check(df: DataFrame, *columns: str) -> KeyCheck:
    failing = unique(df, columns[0]) if len(columns) == 1 else unique_combination(df, columns)
    return KeyCheck("unique_" + "_".join(columns), failing)


def relationship_check(
    child: DataFrame, column: str, parent: DataFrame, field: str
) -> KeyCheck:
    return KeyCheck(
        f"relationships_{column}", orphans(child, column, parent, field), weight="n_rows"
    )


def with_flags(results: DataFrame) -> DataFrame:
    """Warning and error flags of a failure count."""
    failed = F.col("failures") != 0
    return results.select(
        "test", "failures", failed.alias("should_warn"), failed.alias("should_error")
    )


def summarize(failing: DataFrame, name: str, weight: str | None = None) -> DataFrame:
    """One-row summary of a frame of failing rows."""
    count = F.count("*") if weight is None else F.coalesce(F.sum(weight), F.lit(0))
    return with_flags(failing.agg(count.cast("long").alias("failures")).withColumn("test", F.lit(name)))


def run_suite(
    df: DataFrame, row_checks: Sequence[RowCheck], key_checks: Sequence[KeyCheck] = ()
) -> DataFrame:
    """One row per check: failures and flags."""
    parts = []
    if row_checks:
        counts = df.agg(
            *[F.count_if(F.coalesce(c.fails, F.lit(False))).alias(c.name) for c in row_checks]
        )
        entries = [F.struct(F.lit(c.name).alias("test"), F.col(c.name).alias("failures")) for c in row_checks]
        parts.append(with_flags(counts.select(F.inline(F.array(*entries)))))
    parts += [summarize(c.failing, c.name, c.weight) for c in key_checks]
    return reduce(DataFrame.unionByName, parts)


def watch(
    df: DataFrame, row_checks: Sequence[RowCheck], part: Column | None = None
) -> tuple[DataFrame, Observation]:
    """Count failing rows per check and part while the rows pass to where they are written.

    ``part`` is a whole number of zero or more, or null. The counts are a histogram with a bin per
    part, which is exact up to ``MAX_PARTS`` parts; :func:`watched` returns none beyond. Call this
    after the last shuffle before the write: Spark counts a task of the last stage once, however
    often it is run, but tasks of earlier stages again when a lost executor makes it repeat them.
    """
    part = F.lit(0) if part is None else F.coalesce(part, F.lit(_NO_PART))
    bins = [
        F.to_json(F.histogram_numeric(F.when(c.fails, part), F.lit(MAX_PARTS))).alias(c.name)
        for c in row_checks
    ]
    seen = Observation()
    return df.observe(seen, F.count("*").alias("rows watched"), *bins), seen


def watched(seen: Observation, row_checks: Sequence[RowCheck]) -> dict[str, dict[str, int]] | None:
    """Failures per check and part of a finished write; parts without a failure are left out.

    None if there were too many parts to tell, so that the table has to be read.
    """
    found = seen.get
    if "rows watched" not in found:
        return None
    counts: dict[str, dict[str, int]] = {}
    for check in row_checks:
        parts: dict[str, int] = {}
        for b in json.loads(found[check.name] or "[]"):
            name = "null" if b["x"] == _NO_PART else str(int(b["x"]))
            parts[name] = parts.get(name, 0) + round(b["y"])
        if len(parts) >= MAX_PARTS:
            return None
        counts[check.name] = parts
    return counts


def failures_by_part(
    df: DataFrame, row_checks: Sequence[RowCheck], part: Column | None = None
) -> dict[str, dict[str, int]]:
    """The same counts from a table that is read for them; a row per part comes to the driver."""
    counts = [F.count_if(F.coalesce(c.fails, F.lit(False))).alias(c.name) for c in row_checks]
    key = F.lit("0") if part is None else F.coalesce(part.cast("string"), F.lit("null"))
    rows = df.groupBy(key.alias("part of table")).agg(*counts).collect()
    return {c.name: {r[0]: r[c.name] for r in rows if r[c.name]} for c in row_checks}


def counted(spark: SparkSession, failures: Mapping[str, int]) -> DataFrame:
    """Summary rows of failures that are known."""
    return with_flags(spark.createDataFrame(list(failures.items()), "test string, failures long"))
