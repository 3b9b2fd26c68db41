"""Nearest neighbours against brute force."""

from pathlib import Path

import numpy as np
import pytest

from pulseframe.llm import multi_index as mi
from pulseframe.llm import queries

SCHEMA = "vec_id long, embedding array<float>"


def exact(ids, x, query_id, query, k=10):
    score = np.sqrt(((x - query) ** 2).sum(axis=1))
    order = [i for i in np.lexsort((ids, score)) if ids[i] != query_id]
    return [(int(ids[i]), score[i]) for i in order[:k]]


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.01", "/root/testdata/sf0.1"])
def test_recall(spark, sf):
    table = spark.read.parquet(f"{sf}/embeddings.parquet").toPandas()
    ids, x = table["vec_id"].to_numpy(), np.stack(table["embedding"]).astype(float)
    got = queries.QUERIES["op8_nearest_neighbours"](spark, sf).toPandas()
    hits = 0
    for q in ids[ids % 100 == 0]:
        mine = got[got["query_id"] == q].sort_values("rank")
        assert mine["rank"].tolist() == list(range(1, 11))
        want = exact(ids, x, q, x[ids == q][0])
        hits += len({i for i, _ in want} & set(mine["vec_id"]))
        for i, s in zip(mine["vec_id"], mine["score"], strict=True):
            assert s == pytest.approx(np.sqrt(((x[ids == q][0] - x[ids == i][0]) ** 2).sum()))
    assert hits >= 0.9 * 10 * (ids % 100 == 0).sum()


def test_small_visits_still_recall_clustered_vectors(spark):
    rng = np.random.default_rng(15)
    centres = rng.normal(size=(40, 8)) * 5
    x = (centres[rng.integers(0, 40, 4000)] + rng.normal(size=(4000, 8)) * 0.3).astype(np.float32)
    vectors = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], SCHEMA)
    got = mi.neighbours(vectors, vectors.filter("vec_id % 100 = 0"), visited=0.15, least_visited=1).toPandas()
    hits = sum(
        len({i for i, _ in exact(np.arange(4000), x.astype(float), q, x[q].astype(float))} & set(got[got["query_id"] == q]["vec_id"]))
        for q in range(0, 4000, 100)
    )
    assert hits >= 0.9 * 400


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.1", "/root/testdata/check_s"])
def test_recall_of_the_visited_share_on_given_vectors(spark, sf):
    if not Path(f"{sf}/embeddings.parquet").exists():
        pytest.skip("not among the given tables")
    vectors = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding")
    table = vectors.toPandas()
    ids, x = table["vec_id"].to_numpy(), np.stack(table["embedding"]).astype(float)
    asked = ids[ids % 100 == 0]
    got = mi.neighbours(vectors, vectors.filter("vec_id % 100 = 0"), least_visited=1).toPandas()
    hits = sum(len({i for i, _ in exact(ids, x, q, x[ids == q][0])} & set(got[got["query_id"] == q]["vec_id"])) for q in asked)
    assert hits >= 0.9 * 10 * len(asked)


def test_blocks_of_a_hot_cell(spark, monkeypatch):
    """A third of all rows share one vector: the nearest are those of the smallest ids."""
    monkeypatch.setattr(mi, "BLOCK_ENTRIES", 16)
    monkeypatch.setattr(mi, "BLOCK_QUERIES", 2)
    rng = np.random.default_rng(16)
    rows = [(i, [1.0, 2.0, 3.0, 4.0] if i % 3 == 0 else rng.normal(size=4).astype(np.float32).tolist()) for i in range(400)]
    vectors = spark.createDataFrame(rows, SCHEMA)
    got = mi.neighbours(vectors, vectors.filter("vec_id % 100 = 0")).toPandas()
    ids, x = np.arange(400), np.array([np.float32(v) for _, v in rows]).astype(float)
    for q in range(0, 400, 100):
        mine = got[got["query_id"] == q].sort_values("rank")
        want = exact(ids, x, q, x[q])
        assert mine["vec_id"].tolist() == [i for i, _ in want]
        assert mine["score"].tolist() == pytest.approx([s for _, s in want])


def test_rows_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0]), (1, [1.0, 1.0]), (2, [0.0, 0.0]), (3, None), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]),
        (7, []), (8, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (9, [2.0, 0.0]), (9, [2.0, 0.0]), (100, [5.0, 5.0]), (0, [1.0, 0.0]),
    ]
    vectors = spark.createDataFrame(rows, SCHEMA)
    got = mi.neighbours(vectors, vectors.filter("vec_id % 100 = 0")).collect()
    found = {}
    for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])):
        found.setdefault(r["query_id"], []).append((r["vec_id"], r["rank"]))
    assert found == {0: [(1, 1), (9, 2), (100, 3)], 100: [(1, 1), (9, 2), (0, 3)]}


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    some = spark.createDataFrame([(0, [1.0, 2.0]), (1, [2.0, 1.0])], SCHEMA)
    assert mi.neighbours(none, none).count() == 0
    assert mi.neighbours(some, none).count() == 0
    assert mi.neighbours(some.filter("vec_id = 0"), some.filter("vec_id = 0")).count() == 0


def test_cells_are_visited_by_summed_distance():
    rng = np.random.default_rng(17)
    index = mi.Index(rng.normal(size=(5, 2)), rng.normal(size=(5, 2)), rng.integers(0, 3, 25))
    v = rng.normal(size=4)
    a, b = (((x - y) ** 2).sum(axis=1) for x, y in ((index.first, v[:2]), (index.second, v[2:])))
    want = [c for c in np.argsort((a[:, None] + b[None, :]).ravel(), kind="stable") if index.sizes[c]]
    assert index.visit(v, 10**9) == want
    assert index.visit(v, 4) == want[: len(index.visit(v, 4))]


def test_fewer_entries_than_asked_for(spark):
    """All candidates are found, however small their part of the table is."""
    vectors = spark.createDataFrame([(i, [float(i), 1.0, -float(i), 2.0]) for i in range(0, 700, 100)], SCHEMA)
    got = mi.neighbours(vectors, vectors).toPandas()
    assert got.groupby("query_id").size().to_dict() == dict.fromkeys(range(0, 700, 100), 6)
