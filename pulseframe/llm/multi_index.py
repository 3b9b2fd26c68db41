"""Approximate nearest neighbours by an inverted multi-index over the two halves of a vector."""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pulseframe.session import scratch_path

# Centroids of each half; the index has their square of cells.
CENTROIDS = 64
# Rows that the centroids are fitted on, at most about; every row is indexed.
SAMPLE = 20_000
FIT_ROUNDS = 12
# A query visits cells, nearest pair of centroids first, until they hold this part of all entries, and
# the asked number at least. Vectors that point in all directions alike need such a large part for
# a recall of 0.9; clustered ones need far less.
VISITED = 0.5
# Entries and queries that meet in one task.
BLOCK_ENTRIES, BLOCK_QUERIES = 4096, 1024

# The row of a cell is its centroid of the first half.
_ENTRY = "vec_id long, vector array<double>, row int, cell int"


@dataclass
class Index:
    """Centroids (rows) of both halves, and the number of entries in each cell."""

    first: np.ndarray
    second: np.ndarray
    sizes: np.ndarray

    def cells(self, vectors: np.ndarray) -> np.ndarray:
        half = self.first.shape[1]
        a = _distances(vectors[:, :half], self.first).argmin(axis=1)
        b = _distances(vectors[:, half:], self.second).argmin(axis=1)
        return a * len(self.second) + b

    def visit(self, vector: np.ndarray, enough: int) -> list[int]:
        """Cells with entries, by summed distance, until they hold ``enough`` entries.

        A heap holds the next pair of each started row; ties go to the smaller pair of ranks.
        """
        half = self.first.shape[1]
        a = _distances(vector[None, :half], self.first)[0]
        b = _distances(vector[None, half:], self.second)[0]
        by_a, by_b = np.argsort(a, kind="stable"), np.argsort(b, kind="stable")
        heap, out, held = [(a[by_a[0]] + b[by_b[0]], 0, 0)], [], 0
        while heap and held < enough:
            _, i, j = heapq.heappop(heap)
            cell = int(by_a[i]) * len(b) + int(by_b[j])
            if self.sizes[cell]:
                out.append(cell)
                held += int(self.sizes[cell])
            if j + 1 < len(b):
                heapq.heappush(heap, (a[by_a[i]] + b[by_b[j + 1]], i, j + 1))
            if j == 0 and i + 1 < len(a):
                heapq.heappush(heap, (a[by_a[i + 1]] + b[by_b[0]], i + 1, 0))
        return out


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances, for choosing cells only."""
    return (x * x).sum(axis=1)[:, None] + (y * y).sum(axis=1)[None, :] - 2 * (x @ y.T)


def _centroids(x: np.ndarray, k: int) -> np.ndarray:
    """Lloyd's rounds from evenly spread rows of the sample, which is in a fixed order."""
    x = np.unique(x, axis=0)
    centres = x[np.linspace(0, len(x) - 1, min(k, len(x))).astype(int)] if len(x) else x
    for _ in range(FIT_ROUNDS if len(x) else 0):
        near = _distances(x, centres).argmin(axis=1)
        count = np.bincount(near, minlength=len(centres))
        sums = np.stack([np.bincount(near, x[:, j], len(centres)) for j in range(x.shape[1])], axis=1)
        centres = np.where(count[:, None] > 0, sums / np.maximum(count, 1)[:, None], centres)
    return centres


def valid(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", size: int | None = None) -> DataFrame:
    """(vec_id, vector) of rows with an id and a finite vector that is not zero, as doubles.

    Vectors of another length than ``size`` take no part; by default it is the most frequent one
    (ties: the longer).
    """
    plain = vectors.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), F.col(f"`{vector}`").cast("array<double>").alias("vector"))
    finite = ~F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    kept = plain.filter("vec_id is not null and vector is not null").filter(finite & F.exists("vector", lambda x: x != 0))
    if size is None:
        lengths = kept.groupBy(F.size("vector").alias("n")).count()
        found = lengths.orderBy(F.desc("count"), F.desc("n")).limit(1).collect()
        size = found[0]["n"] if found else 0
    return kept.filter(F.size("vector") == size)


def build(vectors: DataFrame, centroids: int = CENTROIDS, sample: int = SAMPLE) -> tuple[DataFrame, Index]:
    """Entries (vec_id, vector, cell) in the shared folder, and the index over them.

    The centroids are fitted on a sample of about ``sample`` rows, chosen by a hash of the id.
    """
    spark = vectors.sparkSession
    n = vectors.count()
    part = F.pmod(F.xxhash64("vec_id"), F.lit(1_000_000)) < (1_000_000 if n <= sample else int(1_000_000 * sample / n))
    rows = vectors.filter(part).select("vector").collect()
    drawn = np.array(sorted(r["vector"] for r in rows), float)
    drawn = drawn if len(drawn) else np.zeros((0, 2))
    half = drawn.shape[1] // 2
    index = Index(_centroids(drawn[:, :half], centroids), _centroids(drawn[:, half:], centroids), np.zeros(0))
    shared = spark.sparkContext.broadcast(index)

    def place(batches):
        for batch in batches:
            if batch.num_rows:
                x = batch.column("vector").flatten().to_numpy().reshape(batch.num_rows, -1)
                cells = shared.value.cells(x).astype(np.int32)
                more = [pa.array(cells // np.int32(len(shared.value.second))), pa.array(cells)]
                yield pa.RecordBatch.from_arrays([*batch.columns, *more], names=["vec_id", "vector", "row", "cell"])

    path = scratch_path(spark, "multi-index")
    (vectors.mapInArrow(place, _ENTRY) if len(drawn) else vectors.withColumns({"row": F.lit(0), "cell": F.lit(0)})).write.parquet(path)
    entries = spark.read.schema(_ENTRY).parquet(path)
    sizes = np.zeros(max(1, len(index.first) * len(index.second)), np.int64)
    for r in entries.groupBy("cell").count().collect():
        sizes[r["cell"]] = r["count"]
    index.sizes = sizes
    return entries, index


def search(
    entries: DataFrame,
    index: Index,
    queries: DataFrame,
    k: int = 10,
    visited: float = VISITED,
    least_visited: int = 1,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest entries found for each query.

    ``queries`` has ``vec_id`` and ``vector``; an entry of the query's own id is left out. The score
    is the Euclidean distance in double precision; ties go to the smaller id. Of rows repeated with
    one id the nearest counts; a query repeated with one id and vector counts once.

    Visited cells are reranked row by row of the grid of cells: a row with many entries is dealt out
    over several tasks, and so are its queries. Only the ``k`` best of each block and query are
    passed on.
    """
    spark = entries.sparkSession
    # one entry more than asked for: the query's own does not count
    enough = max(least_visited, k + 1, int(visited * index.sizes.sum()))
    columns = max(1, len(index.second))
    shared = spark.sparkContext.broadcast(index)
    asked = queries.select(F.col("vec_id").alias("query_id"), F.col("vector").alias("query")).distinct()

    def probe(batches):
        for batch in batches:
            at, rows, cells = [], [], []
            for i, v in enumerate(batch.column("query").to_pylist()):
                by_row: dict[int, list[int]] = {}
                for cell in shared.value.visit(np.array(v), enough):
                    by_row.setdefault(cell // columns, []).append(cell)
                at += [i] * len(by_row)
                rows += by_row
                cells += by_row.values()
            asked = batch.take(pa.array(at, pa.int64()))
            more = [pa.array(rows, pa.int32()), pa.array(cells, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays([*asked.columns, *more], names=["query_id", "query", "row", "cells"])

    path = scratch_path(spark, "probes")
    # queries are few and small, but to probe for each takes time
    asked = asked.repartition(spark.sparkContext.defaultParallelism, "query_id")
    asked.mapInArrow(probe, "query_id long, query array<double>, row int, cells array<int>").write.parquet(path)
    probes = spark.read.parquet(path)
    # Blocks of each side of a row; both tables have at most one line per centroid.
    n_entries = entries.groupBy("row").agg(F.ceil(F.count("*") / BLOCK_ENTRIES).cast("int").alias("parts"))
    n_queries = probes.groupBy("row").agg(F.ceil(F.count("*") / BLOCK_QUERIES).cast("int").alias("rounds"))
    grid = n_entries.join(n_queries, "row")
    part = F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int")
    turn = F.pmod(F.xxhash64("query_id"), F.col("rounds")).cast("int")
    left = entries.join(F.broadcast(grid), "row").select(
        "row", part.alias("part"), F.explode(F.sequence(F.lit(0), F.col("rounds") - 1)).alias("turn"),
        "cell", "vec_id", "vector",
    )
    right = probes.join(F.broadcast(grid), "row").select(
        "row", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), turn.alias("turn"),
        "query_id", "query", "cells",
    )

    def rerank(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            ids, x = left["vec_id"].to_numpy(), np.stack(left["vector"].to_numpy())
            order = np.argsort(ids, kind="stable")
            ids, x, column = ids[order], x[order], left["cell"].to_numpy()[order] % columns
            for name, query, cells in zip(right["query_id"], right["query"], right["cells"], strict=True):
                visited = np.zeros(columns, bool)
                visited[np.asarray(cells) % columns] = True
                keep = np.flatnonzero(visited[column] & (ids != name))
                score = np.zeros(len(ids))
                score[keep] = np.sqrt(((x[keep] - np.asarray(query)) ** 2).sum(axis=1))
                near = keep[np.argsort(score[keep], kind="stable")]
                _, lead = np.unique(ids[near], return_index=True)
                near = near[np.sort(lead)[:k]]
                out += [(name, i, s) for i, s in zip(ids[near].tolist(), score[near].tolist(), strict=True)]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    keys = ("row", "part", "turn")
    near = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(rerank, "query_id long, vec_id long, score double")
    near = near.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = near.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def neighbours(vectors: DataFrame, queries: DataFrame, k: int = 10, **options) -> DataFrame:
    """Index ``vectors`` and search it for the rows of ``queries``; see :func:`valid` for which take part."""
    entries, index = build(valid(vectors))
    size = index.first.shape[1] + index.second.shape[1]
    return search(entries, index, valid(queries, size=size), k, **options)
