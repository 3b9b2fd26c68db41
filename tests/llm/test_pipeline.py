"""The corpus pipeline over planted documents, stage by stage and whole."""

import random

import pytest
from helpers import DOCS, documents, prose, words

import corpus_pipeline as cp

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    rng = random.Random(18)
    folder = str(tmp_path_factory.mktemp("planted"))
    tests = [prose(rng, 3, 10) for _ in range(5)]
    passage = prose(rng, 7)
    texts = {f"clean{i}": prose(rng, 10) for i in range(60)}
    texts |= {f"copy{i}": texts["clean0"] for i in range(20)}
    texts |= {f"near{i}": texts["clean1"].replace(texts["clean1"].split()[i], "changed") for i in range(0, 30, 5)}
    texts |= {f"passage{i}": f"{prose(rng, 5)} {passage} {prose(rng, 5)}" for i in range(10)}
    texts |= {f"bench{i}": f"{prose(rng, 2)} {t}" for i, t in enumerate(tests)}
    texts |= {f"toxic{i}": prose(rng, 8) + " you stupid vile trash" for i in range(30)}
    texts |= {"null": None, "empty": "", "signs": "123 !!!"}
    names = list(texts)
    docs = documents(spark, list(texts.values())).selectExpr("doc_id", "text", "lang", "source", "n_chars", "'x' as rate", "1 as score")
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(list(enumerate(tests)), "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    labels = [(i, 1, int(n.startswith("toxic"))) for i, n in enumerate(names) if n.startswith(("clean", "toxic")) and i % 4]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder, names, texts, passage


def test_planted_cases(spark, planted):
    folder, names, texts, passage = planted
    got = {names[r["doc_id"]]: r for r in cp.run(spark, folder).collect()}
    assert {f"clean{i}" for i in range(60)} <= set(got)
    for i in range(60):
        assert got[f"clean{i}"]["text"] == texts[f"clean{i}"] and got[f"clean{i}"]["copies"] >= 1
    assert {f"passage{i}" for i in range(10)} <= set(got)
    assert not [n for n in got if n.startswith(("copy", "near", "bench", "toxic", "null", "empty", "signs"))]
    kept = [got[f"passage{i}"] for i in range(10)]
    assert sum(passage in r["text"] for r in kept) == 1
    assert all(r["n_chars"] == len(r["text"]) for r in kept)


def test_stages_return_the_columns_of_documents(spark, planted):
    folder = planted[0]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in cp.STAGES[:-1]:
        found = stage(spark, docs, folder)
        assert found.dtypes == docs.dtypes
        assert {r["rate"] for r in found.select("rate").distinct().collect()} == {"x"}
        assert stage(spark, docs.limit(0), folder).count() == 0
    assert cp.STAGES[-1][1](spark, docs.limit(0), folder).count() == 0


def test_stages_survive_nulls_and_repeated_rows(spark, planted):
    folder = planted[0]
    rows = [(None, "Some text of a few words. And more.", None, None, None), (1, None, None, None, 0), (2, "", "en", "s", 0)]
    docs = spark.createDataFrame([*rows, *rows, (3, "word " * 30_000, "en", "s", 5)], DOCS)
    for _, stage in cp.STAGES:
        stage(spark, docs, folder).collect()


def test_given_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    got = cp.run(spark, SF)
    assert 0 < got.count() < docs.count()
    assert got.groupBy("doc_id").count().filter("count > 1").count() == 0
    assert got.filter("copies < 1 or rate < 0").count() == 0
    texts = [r["text"] for r in got.select("text").limit(50).collect()]
    assert all(words(t) for t in texts)
