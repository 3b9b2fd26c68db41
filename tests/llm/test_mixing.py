"""Posteriors and rates: held-out accuracy, and the fit against a plain solver."""

import numpy as np
import pytest
from helpers import documents
from pyspark.sql import functions as F

from pulseframe.llm import mixing as m
from pulseframe.llm import queries

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    found = m.memberships(docs, labels.filter("doc_id % 3 <> 0"), "text", "doc_id", "doc_id")
    held = labels.filter("doc_id % 3 = 0").withColumnRenamed("doc_id", "row").join(found, "row")
    right = F.array_position("_p", F.array_max("_p")) - 1 == m.domain_of(F.col("quality"), F.col("toxic"))
    n, share = held.select(F.count("*"), F.avg(right.cast("int"))).first()
    assert n > 1000 and share > 0.95


def test_weights_are_met_and_toxic_documents_go(spark):
    got = queries.QUERIES["op6_source_mixing"](spark, SF)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    total = got.selectExpr("sum(n_words)").first()[0]
    sums = [got.selectExpr(f"sum(rate * n_words * p_{d})").first()[0] / total for d in m.DOMAINS]
    assert sums == pytest.approx([m.TARGET[d] for d in m.DOMAINS], abs=0.03)
    by = {r["toxic"]: r["rate"] for r in got.join(labels, "doc_id").groupBy("toxic").agg(F.avg("rate").alias("rate")).collect()}
    assert by[1] < 0.1 < by[0]


def plain(n, p, wanted, rounds=20_000):
    """The same least squares with the same scaling, by many small projected steps."""
    x, total = np.ones(len(n)), n.sum()
    step = 0.5 / np.linalg.eigvalsh((p * n[:, None]).T @ p / total)[-1]
    for _ in range(rounds):
        x = np.maximum(0, x - step * p @ ((n * x) @ p / total - wanted))
    return x


@pytest.mark.parametrize("wanted", [(0.0, 0.1, 0.9), (0.2, 0.5, 0.3), (0.0, 0.0, 0.0)])
def test_rates_against_a_plain_solver(spark, wanted):
    rng = np.random.default_rng(14)
    p = np.round(rng.dirichlet([0.2] * 3, 300), m.DIGITS)
    n = rng.integers(0, 500, 300).astype(float)
    rows = [(int(a), [float(v) for v in b]) for a, b in zip(n, p, strict=True)]
    members = spark.createDataFrame(rows, "_n long, _p array<double>")
    rates = m.fit_rates(members, dict(zip(m.DOMAINS, wanted, strict=True)))
    rate = {tuple(r["_p"]): r["rate"] for r in rates.collect()}
    got = np.array([rate[tuple(b)] for _, b in rows])
    assert (got >= 0).all()
    want = plain(n, p, np.array(wanted))
    assert (n * got) @ p / n.sum() == pytest.approx((n * want) @ p / n.sum(), abs=0.04)


def test_whole_keeps_wanted_documents(spark):
    members = spark.createDataFrame([(100, [0.0, 0.0, 1.0]), (80, [0.0, 1.0, 0.0]), (50, [1.0, 0.0, 0.0])], "_n long, _p array<double>")
    got = {tuple(r["_p"]): r["rate"] for r in m.fit_rates(members, whole=True).collect()}
    assert got[0.0, 0.0, 1.0] > 1 and got[0.0, 1.0, 0.0] > 0.95 and got[1.0, 0.0, 0.0] < 0.01


@pytest.mark.parametrize("toxic", [0.002, 0.005, 0.01, 0.03, 0.12])
def test_a_small_unwanted_domain_goes(spark, toxic):
    """Rates of certain posteriors, and the domains' totals over soft ones, each relative to its part."""
    sure = [(int(1e6 * (0.9 - toxic)), [0.0, 0.0, 1.0]), (100_000, [0.0, 1.0, 0.0]), (int(1e6 * toxic), [1.0, 0.0, 0.0])]
    members = spark.createDataFrame(sure, "_n long, _p array<double>")
    for whole in (False, True):
        got = {tuple(r["_p"]): r["rate"] for r in m.fit_rates(members, whole=whole).collect()}
        assert got[1.0, 0.0, 0.0] < 0.01
        assert got[0.0, 1.0, 0.0] == pytest.approx(1, abs=0.01) and got[0.0, 0.0, 1.0] == pytest.approx(0.9 / (0.9 - toxic), abs=0.01)
    rng = np.random.default_rng(15)
    p = np.round(rng.dirichlet([0.3 * toxic, 0.03, 0.3 * (0.9 - toxic)], 5000), m.DIGITS)
    n = rng.integers(0, 500, 5000).astype(float)
    members = spark.createDataFrame([(int(a), [float(v) for v in b]) for a, b in zip(n, p, strict=True)], "_n long, _p array<double>")
    rate = {tuple(r["_p"]): r["rate"] for r in m.fit_rates(members).collect()}
    have = (n * np.array([rate[tuple(b)] for b in p.tolist()])) @ p / n.sum()
    wanted = np.array([m.TARGET[d] for d in m.DOMAINS])
    assert (np.abs(have - wanted) <= 0.03 * np.maximum(wanted, n @ p / n.sum())).all()


def test_edge_cases(spark):
    texts = [None, "", "!!!", "good words here", "bad words here", "vile words here", "word " * 20_000]
    docs = documents(spark, texts).selectExpr("*", "'mine' as rate", "1 as `a.b`")
    labels = spark.createDataFrame(
        [(3, 1, 0), (4, 0, 0), (5, 1, 1), (5, 1, 1), (None, 1, 1), (0, 1, 0), (6, None, 0), (2, 1, None), (99, 1, 1)],
        "doc_id long, quality int, toxic int",
    )
    got = m.mix(docs.union(docs), labels).collect()
    assert len(got) == 2 * len(texts)
    for r in got:
        assert r["rate"] >= 0 and r["a.b"] == 1
        assert sum(r[f"p_{d}"] for d in m.DOMAINS) == pytest.approx(1, abs=0.002)
    assert {r["doc_id"]: r["n_words"] for r in got} == dict(enumerate([0, 0, 0, 3, 3, 3, 20_000]))


def test_no_labels_one_label_and_empty_tables(spark):
    docs = documents(spark, ["some text", None])
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {(r["p_good"], r["p_toxic"]) for r in m.mix(docs, none).collect()} == {(1.0, 0.0)}
    one = spark.createDataFrame([(0, 0, 0)], "doc_id long, quality int, toxic int")
    assert {r["p_poor"] for r in m.mix(docs, one).collect()} == {1.0}
    assert m.mix(docs.limit(0), none).count() == 0
    assert {r["rate"] for r in m.mix(documents(spark, [None, ""]), none).collect()} == {1.0}


def test_no_python_in_the_plan(spark):
    docs = documents(spark, ["some text", "more text"])
    labels = spark.createDataFrame([(0, 1, 0), (1, 1, 1)], "doc_id long, quality int, toxic int")
    plan = m.memberships(docs, labels, "text", "doc_id", "doc_id")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_a_label_of_its_own_decides_and_the_rest_is_judged(spark):
    texts = ["kind words of friends"] * 40 + ["vile rotten words"] * 40 + ["dull words of friends"] * 3
    docs = documents(spark, texts)
    rows = [(i, 1, int(40 <= i < 80)) for i in range(0, 78)]
    # both labels of one document, one label missing, and labels against the text
    rows += [(80, 0, 1), (81, 0, None), (82, None, 1), (0, 1, 1)]
    labels = spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
    got = {r["row"]: r["_p"] for r in m.memberships(docs, labels, "text", "doc_id", "doc_id").collect()}
    assert got[80] == got[82] == got[0] == [1.0, 0.0, 0.0]
    assert got[81][0] < 0.5 and got[81][2] == 0.0  # poor by its label, judged for the other question
    assert got[78][0] > 0.9 and got[79] == got[78]  # not labelled
    assert got[1] == [0.0, 0.0, 1.0]


def test_the_fit_is_projected_gradient_to_its_tolerance(spark):
    """The optimality condition of the least squares, cell by cell: no gradient where a rate is above 0, none downhill at 0."""
    rng = np.random.default_rng(16)
    p = np.round(rng.dirichlet([0.1, 0.2, 0.6], 400), m.DIGITS)
    n = rng.integers(1, 500, 400).astype(float)
    members = spark.createDataFrame([(int(a), [float(v) for v in b]) for a, b in zip(n, p, strict=True)], "_n long, _p array<double>")
    rate = {tuple(r["_p"]): r["rate"] for r in m.fit_rates(members).collect()}
    x = np.array([rate[tuple(b)] for b in p.tolist()])
    wanted = np.array([m.TARGET[d] for d in m.DOMAINS])
    share = n @ p / n.sum()
    off = ((n * x) @ p / n.sum() - wanted) / np.maximum(wanted, share)
    slope = p @ off + m.RIDGE * (x - 1)
    assert np.abs(slope[x > 0]).max() < 1e-3 and slope[x == 0].min() > -1e-3
    assert (x == 0).any() and (x > 0).any()
