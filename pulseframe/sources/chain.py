"""Following the tokens of paged requests, to find missing, repeated and circular pages.

The pages of a request (``request_id``) form a chain: the first one has no token, and each names the
token of the next one until one names none. Tokens without characters count as none. Pages
without a request belong to no chain and are left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulseframe.session import scratch_path

REQUEST, TOKEN, NEXT = "request_id", "token", "next_token"
_PAGE = [REQUEST, TOKEN]


def _nodes(pages: DataFrame) -> DataFrame:
    """(request_id, token, next_token, copies, variants): each page once.

    Copies that name different next pages go on with the smallest token that one of them names.
    """
    some = [F.when(F.col(c) != "", F.col(c)).alias(c) for c in (TOKEN, NEXT)]
    found = pages.filter(F.col(REQUEST).isNotNull()).select(REQUEST, *some)
    ends = F.count_if(F.col(NEXT).isNull())
    return found.groupBy(*_PAGE).agg(
        F.min(NEXT).alias(NEXT),
        F.count("*").alias("copies"),
        F.max(NEXT).alias("_most"),
        ends.alias("_ends"),
    ).select(
        *_PAGE, NEXT, "copies",
        (F.coalesce(F.col("_most") != F.col(NEXT), F.lit(False)) | F.col("_ends").between(1, F.col("copies") - 1)).alias("differ"),
    )


def _walk(nodes: DataFrame) -> DataFrame:
    """(request_id, token, position) of every token on the way from a first page.

    Pointers are doubled: after round k the first 2^k tokens of every request are known, and
    pointers lead 2^k pages on. It ends when no request gets a new token, also on a circle.
    Tokens are unique within a request, so a long request is spread over all tasks.
    """
    spark = nodes.sparkSession

    def written(df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(spark, name)
        df.write.parquet(path)
        return spark.read.parquet(path)

    onward = nodes.filter(F.col(NEXT).isNotNull())
    first = F.col(TOKEN).isNull()
    reached = written(onward.filter(first).select(REQUEST, F.col(NEXT).alias(TOKEN), F.lit(1).cast("long").alias("position")), "reached")
    jumps = onward.filter(~first).select(*_PAGE, F.col(NEXT).alias("to"))
    known, ahead = reached.count(), 1
    while True:
        jumps = written(jumps, "jumps")
        further = reached.join(jumps, _PAGE).select(REQUEST, F.col("to").alias(TOKEN), F.col("position") + ahead)
        reached = written(reached.union(further).groupBy(*_PAGE).agg(F.min("position").alias("position")), "reached")
        found = reached.count()
        if found == known:
            return reached
        known, ahead = found, 2 * ahead
        far = jumps.select(REQUEST, F.col(TOKEN).alias("to"), F.col("to").alias("far"))
        jumps = jumps.join(far, [REQUEST, "to"]).select(*_PAGE, F.col("far").alias("to"))


def follow(pages: DataFrame) -> DataFrame:
    """(request_id, token, next_token, copies, differ, position): every page once.

    ``position`` counts from 0 at the first page and is null where the chain does not lead to a page.
    ``copies`` is how often a page is there, ``differ`` whether its copies name different next pages.
    A table without pages gives no rows.
    """
    nodes = _nodes(pages)
    walked = _walk(nodes).withColumnRenamed("position", "_position")
    position = F.when(F.col(TOKEN).isNull(), F.lit(0)).otherwise(F.col("_position")).alias("position")
    return nodes.join(walked, _PAGE, "left").select(*_PAGE, NEXT, "copies", "differ", position)


def faults(pages: DataFrame) -> DataFrame:
    """(reason, request_id, token): what is wrong with the chains; no rows if they are whole.

    ``repeated page`` and ``differing pages`` name a page, ``missing page`` a token that no page has,
    ``no first page`` a request, ``page not reached`` one that no chain leads to, and ``circle`` the page
    that names one before it as the next one, or itself.
    """
    path = scratch_path(pages.sparkSession, "page-chain")
    follow(pages).write.parquet(path)
    chain = pages.sparkSession.read.parquet(path)

    def fault(reason: str, rows: DataFrame) -> DataFrame:
        return rows.select(F.lit(reason).alias("reason"), *_PAGE)

    named = chain.filter(F.col(NEXT).isNotNull()).select(REQUEST, F.col(NEXT).alias(TOKEN)).distinct()
    firsts = chain.filter(F.col(TOKEN).isNull()).select(REQUEST)
    requests = chain.select(REQUEST).distinct().join(firsts, REQUEST, "left_anti")
    ahead = chain.filter("position is not null and token is not null").select(
        REQUEST, F.col(TOKEN).alias(NEXT), F.col("position").alias("_next")
    )
    back = chain.join(ahead, [REQUEST, NEXT]).filter("_next <= position")
    return (
        fault("repeated page", chain.filter("copies > 1"))
        .unionByName(fault("differing pages", chain.filter("differ")))
        .unionByName(fault("missing page", named.join(chain.select(*_PAGE), _PAGE, "left_anti")))
        .unionByName(fault("no first page", requests.withColumn(TOKEN, F.lit(None).cast("string"))))
        .unionByName(fault("page not reached", chain.filter("position is null")))
        .unionByName(fault("circle", back))
    )
