"""Landed JSON pages to flat raw rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulseframe.functions.compat import is_bad_timestamp, parse_timestamp, round_to_long
from pulseframe.sources.specs import SourceSpec


# Text of a page that the reader could not take as a whole.
CORRUPT = "_corrupt_page"
# Parsed times of a record, in the order of its fields.
_TIMES = "_parsed_times"
# One rejected page or record: why, and its text.
REJECTED_SCHEMA = "reason string, content string"


def page_schema(spec: SourceSpec) -> T.StructType:
    """Schema of a page, with the text of one that cannot be read."""
    return T.StructType([*spec.page_schema.fields, T.StructField(CORRUPT, T.StringType())])


def read_pages(
    spark: SparkSession,
    path: str | Sequence[str],
    spec: SourceSpec,
    one_page_per_line: bool = True,
) -> DataFrame:
    """Read page files; one JSON value per line by default, else one per file.

    What cannot be read, a page cut off or printed over several lines, is kept as text in the
    column CORRUPT; see :func:`rejected_pages`.
    """
    reader = spark.read.schema(page_schema(spec)).option("multiLine", not one_page_per_line)
    return reader.option("columnNameOfCorruptRecord", CORRUPT).json(path)


def parse_pages(texts: DataFrame, column: str, spec: SourceSpec) -> DataFrame:
    """Parse a text column that holds one page (or one bare record) per row."""
    options = {"columnNameOfCorruptRecord": CORRUPT}
    # With the test the text is used twice, so Spark works it out by itself, in compiled code. Within the
    # parser, which has none, it would be worked out node by node.
    page = F.when(F.col(column).isNotNull(), F.from_json(column, page_schema(spec), options))
    return texts.select(page.alias("p")).select("p.*")


def is_rejected_page() -> Column:
    """True for a page that was not read in full. Records that could be read are used all the same."""
    # The reader wants another column than the text to be used as well.
    return F.col(CORRUPT).isNotNull() & (F.coalesce(F.size("records"), F.lit(0)) >= -1)


def rejected_pages(pages: DataFrame) -> DataFrame:
    """Quarantine: (reason, content) of pages that could not be read in full."""
    return pages.filter(is_rejected_page()).select(
        F.lit("unreadable page").alias("reason"), F.col(CORRUPT).alias("content")
    )


def why_rejected(spec: SourceSpec) -> Column:
    """Why a nested record cannot be loaded, or null: no key, or a time that cannot be read.

    Of an incremental source the time that places the record has to be there.
    """
    paths = {name: path for name, path, _ in spec.fields}
    reason = F.when(F.col(paths[spec.key]).isNull(), F.lit(f"no {spec.key}"))
    if spec.time_field:
        reason = reason.when(
            parse_timestamp(paths[spec.time_field]).isNull(), F.lit(f"no readable {spec.time_field}")
        )
    for name, path, type in spec.fields:
        if type == "timestamp":
            reason = reason.when(is_bad_timestamp(path), F.lit(f"unreadable {name}"))
    return reason


def rejected_records(records: DataFrame, spec: SourceSpec) -> DataFrame:
    """Quarantine: (reason, content) of records that cannot be loaded, as JSON text."""
    bad = records.withColumn("_reason", why_rejected(spec)).filter("_reason is not null")
    return bad.select(F.col("_reason").alias("reason"), F.to_json(F.struct(*records.columns)).alias("content"))


def explode_records(pages: DataFrame, spec: SourceSpec) -> DataFrame:
    """One row per record of all pages; a payload without a list is one record."""
    names = [f.name for f in spec.record_schema.fields]
    bare = F.struct(*names)
    has_record = F.coalesce(*[F.col(n).cast("string") for n in names]).isNotNull()
    records = F.when(F.col("records").isNotNull(), F.col("records")).when(
        has_record, F.array(bare)
    )
    return pages.select(F.inline(records))


def _raw_column(path: str, type: str) -> Column:
    if type == "long":
        return round_to_long(path)
    return F.col(path)


def flatten_records(
    records: DataFrame,
    spec: SourceSpec,
    ingested_at: Column | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Nested records to the columns of the raw table.

    A missing nested object gives nulls. ``ingested_at`` stamps one time on the
    whole batch; without it the record's own value is kept. ``keep`` names further columns.
    """
    stamped = {} if ingested_at is None else {"ingested_at": ingested_at.cast("timestamp_ntz")}
    # All times are read by one expression. One for each, beside the numbers, makes a generated method
    # that is too long for the JVM to compile.
    times = [(name, path) for name, path, type in spec.fields if type == "timestamp" and name not in stamped]
    texts = F.array(*[F.col(path) for _, path in times])
    records = records.withColumn(_TIMES, F.transform(texts, parse_timestamp))
    read = stamped | {name: F.col(_TIMES)[i] for i, (name, _) in enumerate(times)}
    cols = [read[name] if name in read else _raw_column(path, type) for name, path, type in spec.fields]
    return records.select(*[c.alias(name) for c, (name, _, _) in zip(cols, spec.fields, strict=True)], *keep)


def stamp_ingested(df: DataFrame, batch_time: str) -> DataFrame:
    """The same ingestion time on every row of a batch."""
    return df.withColumn("ingested_at", F.lit(batch_time).cast("timestamp_ntz"))


def flatten_struct(df: DataFrame, separator: str = "_") -> DataFrame:
    """Flatten every nested struct to ``a_b_c`` columns; lists become JSON text."""

    def leaves(schema: T.StructType, path: str, name: str) -> list[Column]:
        out: list[Column] = []
        for field in schema.fields:
            full = f"{path}.`{field.name}`" if path else f"`{field.name}`"
            alias = f"{name}{separator}{field.name}" if name else field.name
            if isinstance(field.dataType, T.StructType):
                out.extend(leaves(field.dataType, full, alias))
            elif isinstance(field.dataType, T.ArrayType):
                out.append(F.to_json(F.col(full)).alias(alias))
            else:
                out.append(F.col(full).alias(alias))
        return out

    return df.select(*leaves(df.schema, "", ""))


def nest_record(spec: SourceSpec) -> Column:
    """Inverse of :func:`flatten_records`: the nested record of a raw row, as JSON text."""
    tree: dict = {}
    for name, path, type in spec.fields:
        *parents, leaf = path.split(".")
        node = tree
        for parent in parents:
            node = node.setdefault(parent, {})
        value = F.col(name)
        if type == "timestamp":
            value = F.date_format(name, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
        node[leaf] = value

    def build(node: dict) -> Column:
        return F.struct(
            *[
                (build(v) if isinstance(v, dict) else v).alias(k)
                for k, v in node.items()
            ]
        )

    return F.to_json(build(tree))
