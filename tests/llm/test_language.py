"""Language identification on the given documents and on edge cases."""

import random

import numpy as np
import pytest
from helpers import DOCS, documents

from pulseframe.llm import language, queries
from pulseframe.llm.lattice import MARK

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def judged(spark):
    return queries.QUERIES["op7_language_id"](spark, SF).cache()


def test_held_out_accuracy(spark, judged):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    held = judged.filter("held_out").join(docs, "doc_id").selectExpr("avg(int(lang = lang_pred))", "count(*)").first()
    assert held[1] > 100 and held[0] > 0.97
    assert judged.count() == docs.count()
    assert judged.filter("score < 0 or score > 1 or score is null").count() == 0


@pytest.fixture(scope="module")
def model(spark):
    rng = random.Random(4)
    texts = [(" ".join(rng.choice(["the", "house", "garden"]) for _ in range(20)), "en") for _ in range(20)]
    texts += [(" ".join(rng.choice(["das", "haus", "garten"]) for _ in range(20)), "de") for _ in range(20)]
    texts += [(None, "en"), ("house", None), ("", "de"), ("the", "en")]
    rows = [(i, t, g, "s", 0) for i, (t, g) in enumerate(texts)]
    return language.train(spark.createDataFrame(rows, DOCS))


def test_edge_cases(spark, model):
    texts = ["The HOUSE", "garten, das!", None, "", "123 ²! ", "house " * 20_000, "日本", "the² haus₂ das"]
    docs = documents(spark, texts).selectExpr("*", "'mine' as score", "1 as `a.b`")
    got = {r["doc_id"]: r for r in language.predict(docs, model).collect()}
    assert [got[i]["lang_pred"] for i in range(6)] == ["en", "de", "und", "und", "und", "en"]
    assert got[2]["score"] == 0 and got[5]["score"] == 1 and got[6]["lang_pred"] in ("de", "en")
    assert got[0]["a.b"] == 1


def test_posterior_is_that_of_the_summed_segmentations(spark, model):
    joint = model.prior.copy()
    for word in ("the", "garten", "the"):
        joint += model.lattice.score([MARK + word], model.log_p)[0]
    p = np.exp(joint - joint.max())
    r = language.predict(documents(spark, ["The garten the"]), model).first()
    assert r["lang_pred"] == model.languages[int(p.argmax())]
    assert r["score"] == pytest.approx(p.max() / p.sum())


def test_nothing_to_learn_from(spark):
    empty = language.train(documents(spark, []))
    assert language.predict(documents(spark, ["text"]), empty).first()["lang_pred"] == "und"
    assert language.predict(documents(spark, []), empty).count() == 0


def test_repeated_rows_keep_their_results(spark, model):
    docs = documents(spark, ["the house"])
    assert [r["lang_pred"] for r in language.predict(docs.union(docs), model).collect()] == ["en", "en"]
