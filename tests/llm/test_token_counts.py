"""Token counts of documents against segmentations of single words."""

from helpers import documents

from pulseframe.llm import token_counts as tc
from pulseframe.llm.lattice import MARK, vocabulary


def test_edge_cases(spark):
    texts = ["The house of the house", None, "", " \t\n", "日本 \U0001f600", "the " * 30_000, "x" * 20_000]
    docs = documents(spark, texts).selectExpr("*", "'mine' as n_tokens", "1 as `a.b`")
    got = {r["doc_id"]: r for r in tc.token_counts(docs.union(docs)).collect()}
    pieces = tc.Suffixes(*vocabulary())
    for i, text in enumerate(texts):
        found = (text or "").split()
        one = tc.trie_counts({MARK + w for w in found}, pieces)
        assert (got[i]["n_pretokens"], got[i]["n_tokens"]) == (len(found), sum(one[MARK + w] for w in found))
    assert got[0]["a.b"] == 1 and got[1]["n_tokens"] == 0
    assert tc.token_counts(docs.limit(0)).count() == 0


def test_forgotten_words_are_counted_again(spark, monkeypatch):
    docs = documents(spark, ["alpha beta", "beta gamma", "alpha gamma delta"] * 5)
    want = sorted(r["n_tokens"] for r in tc.token_counts(docs).collect())
    monkeypatch.setattr(tc, "KEPT_WORDS", 0)
    assert sorted(r["n_tokens"] for r in tc.token_counts(docs).collect()) == want


def test_counts_are_near_those_of_the_vocabulary_itself(spark):
    import sentencepiece

    from pulseframe.llm.lattice import VOCABULARY

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = tc.token_counts(docs).selectExpr("sum(n_tokens)").first()[0]
    model = sentencepiece.SentencePieceProcessor(model_file=VOCABULARY)
    own = sum(len(model.encode(" ".join(r["text"].split()))) for r in docs.select("text").collect())
    assert abs(got - own) < 0.05 * own
