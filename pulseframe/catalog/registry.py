"""Registration of queries and the portable form of their results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulseframe.functions.compat import THRESHOLD_DIGITS

Query = Callable[[SparkSession, str], DataFrame]


def portable(df: DataFrame) -> DataFrame:
    """Result form that two engines can compare: dates and times as text, fractions
    as doubles rounded to six decimals, lists as comma-joined text."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            c = c.cast("string")
        elif isinstance(f.dataType, (T.DecimalType, T.DoubleType, T.FloatType)):
            c = F.round(c.cast("double"), THRESHOLD_DIGITS)
        elif isinstance(f.dataType, T.ArrayType):
            c = F.array_join(c, ",")
        cols.append(c.alias(f.name))
    return df.select(*cols)


class Registry:
    """Queries by name."""

    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}

    def add(self, name: str, build: Query) -> None:
        if name in self.queries:
            raise ValueError(f"query registered twice: {name}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return portable(build(spark, sf_dir))

        self.queries[name] = run

    def __call__(self, name: str) -> Callable[[Query], Query]:
        def register(build: Query) -> Query:
            self.add(name, build)
            return build

        return register
