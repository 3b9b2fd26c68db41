"""Language-model scores: the base against plain counts, the model against its own definition."""

import math
import re
import string
from collections import Counter

import pytest
from helpers import LOWER, documents

from pulseframe.llm import lm_score, queries

SF = "/root/testdata/sf0.01"


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER)) + ["</s>"]


def base(train, text):
    counts = Counter(t for x in train for t in tokens(x))
    n, v = sum(counts.values()), len(counts)
    found = tokens(text)
    score = sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in found)
    return len(found), sum(counts[t] > 0 for t in found), n, score


def test_base_over_all_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: r for r in queries.QUERIES["op9_lm_scoring"](spark, SF).collect()}
    train = [d["text"] for d in docs if not got[d["doc_id"]]["held_out"]]
    counts = Counter(t for x in train for t in tokens(x))
    n, v = sum(counts.values()), len(counts)
    assert len(got) == len(docs)
    better = 0
    for d in docs:
        r, found = got[d["doc_id"]], tokens(d["text"])
        assert (r["n_tokens"], r["train_tokens"]) == (len(found), n)
        assert r["n_known"] == sum(counts[t] > 0 for t in found)
        assert r["base_score"] == pytest.approx(sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in found))
        assert -1e7 < r["score"] < 0
        better += r["score"] > r["base_score"]
    assert better > 0.5 * len(docs)


TEXTS = ["a b a", None, "", "A  b\nété  ", "zzz unseen \x1f", "b " * 3000, "c"]


def scored(spark, texts, train, group="lang"):
    docs = documents(spark, texts).selectExpr("*", f"{train} as train", "'mine' as score", "1 as `a.b`")
    return {r["doc_id"]: r for r in lm_score.score(docs, group=group).collect()}


@pytest.mark.parametrize("group", ["lang", None])
def test_edge_cases(spark, group):
    got = scored(spark, TEXTS, "doc_id <> 4", group)
    train = [t for i, t in enumerate(TEXTS) if i != 4]
    assert set(got) == set(range(len(TEXTS)))
    for i, text in enumerate(TEXTS):
        n_tokens, n_known, n, score = base(train, text)
        r = got[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (n_tokens, n_known, n)
        assert r["base_score"] == pytest.approx(score)
        assert r["a.b"] == 1
    assert got[1]["score"] == got[2]["score"]


def test_nothing_to_learn_from(spark):
    got = scored(spark, ["a b", None], "cast(null as boolean)")
    assert got[0]["n_known"] == 0 and got[0]["train_tokens"] == 0 and got[0]["base_score"] == 0
    assert math.isfinite(got[0]["score"]) and got[0]["score"] < got[1]["score"] <= 0
    assert scored(spark, [], "true") == {}


def test_repeated_rows_are_scored_one_by_one(spark):
    docs = documents(spark, ["a b c"]).selectExpr("doc_id", "text", "lang", "true as train")
    got = lm_score.score(docs.union(docs)).collect()
    assert len(got) == 2 and got[0]["n_tokens"] == 4 and got[0]["score"] == got[1]["score"]


def test_probabilities_of_short_texts_stay_below_one(spark):
    """One-word texts over a few letters, and the empty text, are different outcomes."""
    letters = [*string.ascii_lowercase]
    got = scored(spark, ["", *letters, *[a + b for a in letters for b in letters[:5]]], "doc_id < 20")
    assert sum(10 ** r["score"] for r in got.values()) < 1


def segmentations(word, pieces):
    """Every way to write a word in pieces; None is a character that is no piece."""
    if not word:
        yield []
    for k in range(1, len(word) + 1):
        piece = word[:k] if word[:k] in pieces else None
        if piece or k == 1:
            yield from ([piece, *rest] for rest in segmentations(word[k:], pieces))


def piece_model(counts, pieces, add):
    """Smoothed probabilities; the unknown piece's is shared out over all code points."""
    total = sum(counts.values()) + add * (len(pieces) + 1)
    p = {s: (counts.get(s, 0) + add) / total for s in (*pieces, None)}
    return {**p, None: p[None] / 0x110000}


def by_definition(rows, pieces):
    """Probability of each text: all segmentations are listed, nothing is summed recursively."""
    groups = sorted({g for _, g, train in rows if train}) + [None]
    every = [*groups, "all"]
    words = {g: Counter() for g in every}
    ends = dict.fromkeys(every, 0)
    for text, g, train in rows:
        for name in (g, "all") if train else ():
            words[name].update(tokens(text)[:-1])
            ends[name] += 1
    spelt = {w: list(segmentations("▁" + w, pieces)) for t, _, _ in rows for w in tokens(t)[:-1]}

    def likely(word, p):
        return [math.prod(p[s] for s in found) for found in spelt[word]]

    def expected(seen, p):
        total = Counter()
        for w in seen:
            shares = likely(w, p)
            for found, share in zip(spelt[w], shares, strict=True):
                for s in found:
                    total[s] += share / sum(shares)
        return total

    start = piece_model(pieces, pieces, 1e-9)
    once = piece_model(expected(words["all"], start), pieces, 0.1)
    models = {g: piece_model(expected(words[g], once), pieces, 0.1) for g in every}
    size = {g: words[g].total() + ends[g] + 2 for g in every}

    def of_word(g, w):
        left = (0.75 * (len(words[g]) + 1) + 1) / size[g]
        return max(words[g][w] - 0.75, 0) / size[g] + left * sum(likely(w, models[g]))

    def mixed(g, of):
        return 0.9 * of(g) + 0.1 * of("all")

    out = []
    for text, _, _ in rows:
        p = 0.0
        for g in groups:
            share = (ends[g] + 1) / sum(ends[x] + 1 for x in groups)
            factors = [mixed(g, lambda x, w=w: of_word(x, w)) for w in tokens(text)[:-1]]
            p += share * math.prod(factors) * mixed(g, lambda x: (ends[x] + 1 - 0.75) / size[x])
        out.append(math.log10(p))
    return out


def test_scores_are_sums_over_all_listed_segmentations(spark):
    rows = [
        ("the cat sat", "en", True), ("The cats  sat", "en", True), ("der kater sass", "de", True), (None, "de", True),
        ("le chat 中", "fr", True), ("the kater", "en", False), ("unheard \U00010428x", "de", False), ("", None, False),
    ]
    found, scores = lm_score.vocabulary()
    pieces = dict(zip(found, map(math.exp, scores), strict=True))
    docs = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id int, text string, lang string, train boolean")
    got = {r["doc_id"]: r["score"] for r in lm_score.score(docs).collect()}
    for i, want in enumerate(by_definition(rows, pieces)):
        assert got[i] == pytest.approx(want, rel=1e-9)
