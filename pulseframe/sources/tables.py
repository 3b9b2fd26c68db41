"""Parquet tables: append, replace and upsert of touched partitions.

A rewrite reads the table it replaces, so it goes through a staged copy next to the table. When the
copy is complete, a small plan file is written into it; then its folders or files are renamed into the
table, and at last the rest of the copy is removed. A run that stops in between leaves the plan
behind: whoever opens the table next (:func:`read_table`, :func:`upsert`, :func:`recover`) finishes
the replacement first. A copy without a plan was not complete, and the table is still whole.

A partitioned table without rows holds one file without rows, so that its schema can be read.

A write can count the failures of row checks as the rows pass. They are kept per partition in a file
of the table, so after an upsert the counts of the other partitions still hold (:func:`failures`).
Every write without checks removes that file.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulseframe.operators import quality
from pulseframe.operators.incremental import align_schema, fill_missing, merge_upsert

# Not read as data, because of the underscore.
PLAN = "_rewrite_plan"
COUNTS = "_check_counts"
_STAGED = "__staged"
# Codec of the files: text keys and times, most of a record, get far shorter by it than by Spark's default.
CODEC = "zstd"
# Fixed value: the folder of rows that have no partition value.
_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def month_of(c: Column | str) -> Column:
    """Partition value of a time or date column: yyyymm."""
    c = F.col(c) if isinstance(c, str) else c
    return F.year(c) * 100 + F.month(c)


def _files(spark: SparkSession, path: str):
    """The file system of a path, and the path as that file system takes it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def _delete(spark: SparkSession, path: str) -> None:
    fs, where = _files(spark, path)
    fs.delete(where, True)


def remove(spark: SparkSession, path: str) -> None:
    """Remove a table; nothing happens if there is none."""
    _delete(spark, path)


def _staged_path(path: str) -> str:
    return f"{path.rstrip('/')}{_STAGED}"


def rejected_path(path: str) -> str:
    """Where an upsert puts rows that have a null in their key."""
    return f"{path.rstrip('/')}__rejected"


def table_exists(spark: SparkSession, path: str) -> bool:
    """True if something was written at the path: it is there, with more than hidden files.

    Any trouble with reaching the path is an error, never taken for absence.
    """
    recover(spark, path)
    return bool(entries(spark, path))


def entries(spark: SparkSession, path: str) -> list[str]:
    """Sorted names of what lies in a folder, without hidden files; none if there is no folder."""
    fs, where = _files(spark, path)
    if not fs.exists(where):
        return []
    names = [f.getPath().getName() for f in fs.listStatus(where)]
    return sorted(n for n in names if not n.startswith(("_", ".")))


def last_partition(spark: SparkSession, path: str, column: str) -> str | None:
    """Greatest value among the partition folders of a table, as text; None without any."""
    fs, where = _files(spark, path)
    names = [f.getPath().getName() for f in fs.listStatus(where)]
    values = [n.split("=", 1)[1] for n in names if n.startswith(f"{column}=")]
    return max((v for v in values if not v.startswith("__")), default=None)


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table, or a typed empty frame if it was never written."""
    if not table_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def _gathered(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Rows of a partition gathered into few files of even size.

    Without this every task would write a file into every partition it has rows
    of. Adaptive execution splits large partitions over several tasks again.
    """
    return df.hint("rebalance", *[F.col(c) for c in partition_by]) if partition_by else df


def _part(partition_by: Sequence[str]) -> Column | None:
    """What checks are counted by: the partition, if there is one."""
    if len(partition_by) > 1:
        raise ValueError("checks are counted by one partition column")
    return F.col(partition_by[0]) if partition_by else None


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    recover(df.sparkSession, path)
    _delete(df.sparkSession, f"{path}/{COUNTS}")
    writer = _gathered(df, partition_by).write.mode("append").partitionBy(*partition_by)
    writer.parquet(path, compression=CODEC)


def replace(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    sort_by: Sequence[str] = (),
    checks: Sequence[quality.RowCheck] = (),
) -> None:
    """Replace the whole table by a frame that does not read it.

    What an interrupted rewrite left to do is void then.
    """
    spark = df.sparkSession
    _delete(spark, f"{_staged_path(path)}/{PLAN}")
    counts = _write(df, path, partition_by, sort_by, checks)
    _keep_schema(spark, df.schema, path, partition_by)
    _keep_counts(spark, path, counts)


def _write(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str],
    sort_by: Sequence[str] = (),
    checks: Sequence[quality.RowCheck] = (),
) -> dict | None:
    """Write the files of a table; the failures of the checks, if they were counted."""
    rows, seen = _gathered(df, partition_by), None
    if checks:
        rows, seen = quality.watch(rows, checks, _part(partition_by))
    if sort_by:
        rows = rows.sortWithinPartitions(*partition_by, *sort_by)
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "static")
    writer.partitionBy(*partition_by).parquet(path, compression=CODEC)
    found = quality.watched(seen, checks) if seen else None
    return None if found is None else _with_rules(found, checks)


def _with_rules(found: dict, checks: Sequence[quality.RowCheck]) -> dict:
    """Counts beside the rule that they are of, so that a changed rule is seen."""
    return {c.name: {"rule": str(c.fails), "parts": found[c.name]} for c in checks}


def _keep_counts(spark: SparkSession, path: str, counts: dict | None) -> None:
    if counts is None:
        _delete(spark, f"{path}/{COUNTS}")
    else:
        _write_json(spark, f"{path}/{COUNTS}", counts)


def failures(
    spark: SparkSession, path: str, checks: Sequence[quality.RowCheck], partition_by: str | None = None
) -> dict[str, int]:
    """Failing rows of each check in a table, as they were counted when it was written.

    Where they were not, or a rule has changed since, the table is read once and the counts are kept.
    """
    recover(spark, path)
    kept = _read_json(spark, f"{path}/{COUNTS}") or {}
    if any(kept.get(c.name, {}).get("rule") != str(c.fails) for c in checks):
        part = _part([partition_by] if partition_by else [])
        kept = _with_rules(quality.failures_by_part(spark.read.parquet(path), checks, part), checks)
        _keep_counts(spark, path, kept)
    return {c.name: sum(kept[c.name]["parts"].values()) for c in checks}


def _counts_after(spark: SparkSession, path: str, new: dict | None, parts: Sequence[str]) -> dict | None:
    """Counts of a table of which some partitions are replaced; none unless all others were counted."""
    old = _read_json(spark, f"{path}/{COUNTS}")
    if new is None or old is None or any(old.get(n, {}).get("rule") != c["rule"] for n, c in new.items()):
        return None
    replaced = {n.split("=", 1)[1].replace(_NO_VALUE, "null") for n in parts}
    for name, c in new.items():
        left = {p: n for p, n in old[name]["parts"].items() if p not in replaced}
        c["parts"] = left | c["parts"]
    return new


def _keep_schema(spark: SparkSession, schema: T.StructType, path: str, partition_by: Sequence[str]) -> None:
    """Put a file without rows into a partitioned table that has none; a plain one gets it from Spark."""
    if not partition_by or entries(spark, path):
        return
    fields = T.StructType([f for f in schema.fields if f.name not in partition_by])
    folder = "/".join(f"{c}={_NO_VALUE}" for c in partition_by)
    spark.createDataFrame([], fields).coalesce(1).write.parquet(f"{path.rstrip('/')}/{folder}")


def rewrite(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    touched: DataFrame | None = None,
    checks: Sequence[quality.RowCheck] = (),
) -> None:
    """Overwrite a table by a frame that may read it, through a staged copy.

    With ``touched``, which has the partition column, only those partitions are replaced; one that
    ``df`` has no rows for is removed.
    """
    spark = df.sparkSession
    staged = _staged_path(path)
    counts = _write(df, staged, partition_by, checks=checks)
    gone = []
    if touched is not None:
        (column,) = partition_by
        written = spark.read.schema(df.schema).parquet(staged).select(column).distinct()
        gone = [r[0] for r in touched.select(column).distinct().exceptAll(written).collect()]
    parts = entries(spark, staged)
    if touched is not None:
        replaced = parts + [_folder(partition_by[0], v) for v in gone]
        counts = _counts_after(spark, path, counts, replaced)
    plan = {
        "partition_by": list(partition_by),
        "by_partition": touched is not None,
        "parts": parts,
        "gone": gone,
        "schema": df.schema.jsonValue(),
        "counts": counts,
    }
    _write_plan(spark, staged, plan)
    recover(spark, path)


def _write_plan(spark: SparkSession, staged: str, plan: dict) -> None:
    _write_json(spark, f"{staged}/{PLAN}", plan)


def _folder(column: str, value) -> str:
    return f"{column}={_NO_VALUE if value is None else value}"


def _write_json(spark: SparkSession, path: str, content: dict) -> None:
    """Write a small file under another name and rename it, so it is there as a whole or not at all."""
    fs, where = _files(spark, f"{path}.part")
    out = fs.create(where, True)
    out.write(bytearray(json.dumps(content).encode()))
    out.close()
    fs.delete(_files(spark, path)[1], False)
    fs.rename(where, _files(spark, path)[1])


def _read_json(spark: SparkSession, path: str) -> dict | None:
    fs, where = _files(spark, path)
    if not fs.exists(where):
        return None
    reader = fs.open(where)
    text = spark._jvm.org.apache.commons.io.IOUtils.toString(reader, "UTF-8")
    reader.close()
    return json.loads(text)


def recover(spark: SparkSession, path: str) -> bool:
    """Finish a rewrite whose staged copy is complete; True if there was one.

    Every step can be repeated, so a run that stops here as well leaves the same work behind: a part
    that is not in the copy any more has been moved.
    """
    staged, path = _staged_path(path), path.rstrip("/")
    plan = _read_json(spark, f"{staged}/{PLAN}")
    if plan is None:
        return False
    fs, where = _files(spark, path)
    fs.mkdirs(where)
    _delete(spark, f"{path}/{COUNTS}")
    old = [_folder(plan["partition_by"][0], v) for v in plan["gone"]]
    if not plan["by_partition"]:
        old += [n for n in entries(spark, path) if n not in plan["parts"]]
    for name in old:
        _delete(spark, f"{path}/{name}")
    waiting = set(entries(spark, staged))
    for name in plan["parts"]:
        if name in waiting:
            _delete(spark, f"{path}/{name}")
            if not fs.rename(_files(spark, f"{staged}/{name}")[1], _files(spark, f"{path}/{name}")[1]):
                raise OSError(f"cannot move {staged}/{name} into {path}")
    _keep_schema(spark, T.StructType.fromJson(plan["schema"]), path, plan["partition_by"])
    _keep_counts(spark, path, plan.get("counts"))
    _delete(spark, f"{staged}/{PLAN}")
    _delete(spark, staged)
    return True


def upsert(
    source: DataFrame,
    path: str,
    keys: Sequence[str],
    partition_by: str | None = None,
    partition_is_part_of_key: bool = False,
    merge: Callable[[DataFrame, DataFrame, Sequence[str]], DataFrame] = merge_upsert,
    on_schema_change: str = "fail",
    checks: Sequence[quality.RowCheck] = (),
) -> int:
    """Merge ``source`` (unique on ``keys``) into a Parquet table.

    ``on_schema_change`` is ``fail`` or ``append_new_columns``.
    With ``partition_by`` only touched partitions are read and rewritten: those
    of the source rows and those that hold an older version of their keys. The
    second set is looked up by a key-only scan of the partitions that the first one
    lacks, which is skipped where the partition value is a function of the key.

    Rows with a null in their key never match, and would be added again by every repeated batch.
    They are not merged, but appended to the table at :func:`rejected_path`; returns their number.
    """
    spark = source.sparkSession
    columns = [partition_by] if partition_by else []
    # The batch is read several times below, but computed once.
    batch = source.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        null_key = F.lit(False)
        for k in keys:
            null_key = null_key | F.col(k).isNull()
        rejected = batch.filter(null_key).count()
        good = batch
        if rejected:
            append(batch.filter(null_key), rejected_path(path))
            good = batch.filter(~null_key)
        if not table_exists(spark, path):
            replace(good, path, columns, checks=checks)
        else:
            _merge_into(good, path, keys, partition_by, partition_is_part_of_key, merge, on_schema_change, checks)
    finally:
        batch.unpersist()
    return rejected


def _merge_into(
    source: DataFrame,
    path: str,
    keys: Sequence[str],
    partition_by: str | None,
    partition_is_part_of_key: bool,
    merge: Callable[[DataFrame, DataFrame, Sequence[str]], DataFrame],
    on_schema_change: str,
    checks: Sequence[quality.RowCheck] = (),
) -> None:
    spark = source.sparkSession
    widen = on_schema_change == "append_new_columns"
    stored = spark.read.option("mergeSchema", widen).parquet(path)
    target = align_schema(stored, source, on_schema_change)
    source = fill_missing(source, target)
    if partition_by is None:
        rewrite(merge(target, source, keys), path, checks=checks)
        return
    columns = [partition_by]
    # of a table without rows the reader cannot tell the kind of the partition column
    kind = source.schema[partition_by].dataType
    target = target.withColumn(partition_by, F.col(partition_by).cast(kind))

    # As many values as there are partition folders, which the driver lists to read the table.
    values = [row[0] for row in source.select(partition_by).distinct().collect()]
    part = F.col(partition_by)
    if not partition_is_part_of_key:
        rest = part.isNotNull() & ~part.isin([v for v in values if v is not None])
        if None not in values:
            rest = rest | part.isNull()
        older = target.filter(rest).select(*keys, partition_by).join(
            source.select(*keys), list(keys), "left_semi"
        )
        values += [row[0] for row in older.select(partition_by).distinct().collect()]
    if not values:
        return
    scope = part.isin([v for v in values if v is not None])
    if None in values:
        scope = scope | part.isNull()
    known = spark.createDataFrame([(v,) for v in values], T.StructType([T.StructField(partition_by, kind)]))
    rewrite(merge(target.filter(scope), source, keys), path, columns, known, checks)
