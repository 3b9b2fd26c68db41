"""Fill-in-middle against a plain version, and exact round trips."""

import hashlib
import random
import re

import pytest
from helpers import documents, prose

from pulseframe.llm import fill_middle, queries

UNITS = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain(doc_id, text):
    """(doc_id, n, form, prefix_chars, middle_chars, output)."""
    text = text or ""
    units = UNITS.findall(text)
    n = len(units)
    digest = sha(f"42:{'' if doc_id is None else doc_id}")
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return doc_id, n, "plain", None, None, text
    if h[3] % 100 < 80:
        return doc_id, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    out = [None, "", " ", "\n\t ", "a", " a", "a ", "é à ß \U0001f600 x y\x0bz\x0c\r\n", "x <P> y", "a<S>b", "<M>", "a < P> <p> b"]
    out += [prose(rng, rng.randrange(1, 9)) for _ in range(80)]
    out += ["w " * k + "<" for k in range(12)] + ["> " + "P>< " * k for k in range(12)]
    out += ["x" * 40_000, ("y" * 9_000 + " ") * 9, "é" * 30_001 + " ü" * 30_000, prose(rng, 4000), "\x00\x1c \x1f\x85 a b"]
    return out * 3  # an id decides the form


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_outputs_against_a_plain_version(spark, texts):
    docs = documents(spark, texts)
    got = rows(fill_middle.fill_middle(docs))
    want = [plain(i, t) for i, t in enumerate(texts)]
    assert got == sorted(want, key=repr)
    assert {w[2] for w in want} == {"plain", "spm", "psm"}


def test_restored_by_an_expression(spark, texts):
    docs = documents(spark, texts)
    back = fill_middle.fill_middle(docs).select("doc_id", fill_middle.restored(*map(_col, ("output", "form"))).alias("t"))
    assert dict(back.collect()) == {i: t or "" for i, t in enumerate(texts)}


def _col(name):
    from pyspark.sql import functions as F

    return F.col(name)


@pytest.mark.parametrize("batch", [3, 10_000])
def test_digests_across_batches(spark, texts, batch):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        got = rows(fill_middle.digests(fill_middle.output_pieces(documents(spark, texts).repartition(3))))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = [plain(i, t) for i, t in enumerate(texts)]
    assert got == sorted(((*w[:5], sha(w[5]), sha(t or "")) for w, t in zip(want, texts, strict=True)), key=repr)


def test_pieces_are_short_and_in_units(spark, texts):
    docs = documents(spark, texts)
    pieces = fill_middle.output_pieces(docs).collect()
    longest = {i: max(map(len, (u.encode() for u in UNITS.findall(t or ""))), default=0) for i, t in enumerate(texts)}
    assert all(len(p["piece"]) <= 3 + fill_middle.PIECE_BYTES + longest[p["doc_id"]] for p in pieces)
    assert len(pieces) > 2 * len(texts)


def test_one_shuffle(spark, texts):
    plan = fill_middle.digests(fill_middle.output_pieces(documents(spark, texts)))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_repeated_rows_null_ids_clashes_and_empty_tables(spark):
    docs = documents(spark, ["one two three " * 3000, "", None] * 8)
    docs = docs.selectExpr("doc_id div 12 as doc_id", "text", *[f"1 as `{c}`" for c in ("copy", "task", "nth", "piece", "form", "a.b", "name")])
    null = docs.selectExpr("cast(null as long) as doc_id", "text", *[f"`{c}`" for c in docs.columns[2:]])
    both = docs.union(null)
    want = sorted((plain(r["doc_id"], r["text"]) for r in both.collect()), key=repr)
    assert rows(fill_middle.fill_middle(both)) == want
    hashed = rows(fill_middle.digests(fill_middle.output_pieces(both.repartition(5))))
    assert [h[:6] for h in hashed] == [(*w[:5], sha(w[5])) for w in want]
    assert rows(fill_middle.fill_middle(docs.limit(0))) == []
    assert rows(fill_middle.digests(fill_middle.output_pieces(docs.limit(0)))) == []


def test_given_documents(spark):
    sf = "/root/testdata/sf0.001"
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want = [(*plain(i, t)[:5], sha(plain(i, t)[5]), sha(t or "")) for i, t in docs]
    assert rows(queries.QUERIES["op12_fill_in_middle"](spark, sf)) == sorted(want, key=repr)
