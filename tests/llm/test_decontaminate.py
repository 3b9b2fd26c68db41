"""Test windows against a plain scan."""

import random
import string

import pytest
from helpers import documents, prose, rows, words

from pulseframe.llm import decontaminate as d


def _plain(text, items, window=13):
    w, hit, found = words(text), set(), set()
    for name, test in items:
        t = words(test)
        for k in range(max(1, len(t) - window + 1)) if t else ():
            run = t[k : k + window]
            for i in range(len(w) - len(run) + 1):
                if w[i : i + len(run)] == run:
                    hit.update(range(i, i + len(run)))
                    found.add(str(name))
    return len(w), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(w)


@pytest.fixture
def cases():
    rng = random.Random(3)
    items = [(i, prose(rng, 2, 11, pool=60)) for i in range(12)]
    items += [(20, "short item"), (21, ""), (22, None), (None, "short item"), (23, "SHORT, item"), (20, "short item")]
    texts = [prose(rng, 5, 10, pool=60) for _ in range(20)]
    texts += [None, "", "...", "a short item here", "Short Item", items[0][1], items[1][1].upper() + " " + prose(rng, 90)]
    texts += [prose(rng, 3) + " " + items[2][1].replace(" ", "\n- ") + " " + prose(rng, 3), "short item " * 4000]
    return texts, items


@pytest.mark.parametrize("block", [1_000_000, 40])
def test_against_a_plain_scan(spark, cases, block):
    texts, items = cases
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = d.contamination(documents(spark, texts), benchmark, block_windows=block)
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], r["items"], r["contaminated"]) for r in found.collect()}
    tests = [(i, t) for i, t in items if i is not None]
    assert got == {i: _plain(t, tests) for i, t in enumerate(texts)}


def test_empty_tables_clashing_columns_and_repeated_rows(spark):
    benchmark = spark.createDataFrame([(1, "one two three")], "item_id long, text string")
    docs = documents(spark, ["one two three", "one two three"]).selectExpr("*", "'x' as items", "doc_id as `a.b`")
    docs = docs.union(docs)
    assert len(rows(d.contamination(docs, benchmark).filter("n_hit = 3 and items = array('1')"), "doc_id", "`a.b`")) == 4
    assert d.contamination(docs, benchmark.limit(0)).filter("n_hit = 0").count() == 4
    assert d.contamination(docs.limit(0), benchmark).count() == 0


def test_spans_are_cut_out(spark):
    benchmark = spark.createDataFrame([(1, "one two three")], "item_id long, text string")
    docs = documents(spark, ["Start, One  two THREE: end.", "clean text", None])
    assert rows(d.without_spans(docs, benchmark), "text") == sorted([("Start, : end.",), ("clean text",), (None,)], key=repr)


def test_digest(spark):
    one = spark.createDataFrame([(["1", "12", "2"],), ([],)], "items array<string>")
    got = [r[0] for r in one.select(d.items_digest()).collect()]
    assert got[1] == d.EMPTY_DIGEST and len(got[0]) == 64 and set(got[0]) <= set(string.hexdigits.lower())
