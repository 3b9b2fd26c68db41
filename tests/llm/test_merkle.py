"""Merkle manifest against a tree built in plain Python."""

import hashlib
import random
import zlib

import pytest

from pulseframe.llm import merkle, queries

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def climb(digests):
    """Root, and for every leaf its steps (before, after)."""
    steps, below = [[] for _ in digests], [[i] for i in range(len(digests))]
    while len(digests) > 1:
        above, under = [], []
        for a in range(0, len(digests), 3):
            run = digests[a : a + 3]
            for k, leaves in enumerate(below[a : a + 3]):
                for i in leaves:
                    steps[i].append(("".join(run[:k]), "".join(run[k + 1 :])))
            above.append(h(*run))
            under.append(sum(below[a : a + 3], []))
        digests, below = above, under
    return digests[0], steps


def plain(rows):
    """(doc_id, leaf, subroot, root, proof digest, folded root, verified), sorted."""
    low = lambda v: (v is not None, v)
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append((low(r[0]), plain_leaf(r), r))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        groups[s].sort(key=lambda x: x[:2])
        trees[s] = climb([d for _, d, _ in groups[s]])
    root, tops = climb([trees[s][0] for s in names])
    out = []
    for s, top in zip(names, tops, strict=True):
        for (_, leaf, r), steps in zip(groups[s], trees[s][1], strict=True):
            now = leaf
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and r[4] is not None:
                now = plain_leaf((*r[:4], r[4].replace("\n", "")))
            proof = steps + top
            for before, after in proof:
                now = h(before, now, after)
            out.append((r[0], leaf, trees[s][0], root, h(*[x for p in proof for x in p]), now, now == root))
    return sorted(out, key=repr)


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")


def proofs(spark, tmp_path, rows, cut=1):
    path = f"{tmp_path}/sf/documents.parquet"
    frame(spark, rows).repartition(cut).write.parquet(path)
    found = queries.QUERIES["op11_merkle_manifest"](spark, f"{tmp_path}/sf")
    return sorted((tuple(r) for r in found.collect()), key=repr)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    sizes = {"hot": 300, "a": 1, "b": 2, "é": 3, "z" * 40: 4, "c": 27, "d": 28, None: 10, "": 5}
    out = [(i, s, None if i % 7 == 0 else "en", i if i % 5 else None, f"w{i}\nx é {i % 11}") for i, s in enumerate(s for s, n in sizes.items() for _ in range(n))]
    out += [(None, "b", "en", 1, "no id"), (None, "b", "en", 2, "no id"), (5000, "c", None, None, None), (5001, "c", "", 0, "")]
    out += [(6000, "d", "de", 3, "same\nrow")] * 5 + [(6000, "d", "de", 3, "other row"), (7000, "d", "de", 1, "x\n" * 20_000)]
    rng.shuffle(out)
    return out


def test_against_a_plain_tree(spark, tmp_path, rows):
    want = plain(rows)
    assert proofs(spark, tmp_path, rows, 5) == want
    assert {w[-1] for w in want} == {True, False}


def test_small_tables(spark, tmp_path):
    assert proofs(spark, tmp_path / "0", []) == []
    one = [(1, "s", "en", 1, "a\nb")]
    got = proofs(spark, tmp_path / "1", one)
    assert got == plain(one)
    assert got[0][1] == got[0][2] == got[0][3] and got[0][4] == h("")
    apart = [(i, f"s{i}", None, None, "a\nb") for i in range(11)]
    assert proofs(spark, tmp_path / "11", apart) == plain(apart)


def test_copies_of_a_common_ancestor(spark, monkeypatch, tmp_path, rows):
    monkeypatch.setattr(merkle, "BLOCK", 2)
    assert proofs(spark, tmp_path, rows) == plain(rows)


def test_steps_and_clashing_names(spark, rows):
    names = ["row", "tree", "pos", "level", "n", "group", "order", "leaf_", "subroot", "root", "proof", "a.b", "_at"]
    docs = frame(spark, rows).selectExpr("*", *[f"'x' as `{n}`" for n in names])
    docs = docs.withColumn("digest", merkle.leaf(*[docs[c] for c in FIELDS]))
    got = merkle.manifest(docs, "digest", "source", "doc_id", ("a.b", "pos", "n")).collect()
    assert len(got) == len(rows) and {(r["a.b"], r["pos"], r["n"]) for r in got} == {("x", "x", "x")}
    for r in got:
        now = bytes(r["leaf"]).hex()
        for step in r["proof"]:
            now = h(bytes(step["before"]).hex(), now, bytes(step["after"]).hex())
        assert now == bytes(r["root"]).hex()


def test_given_documents(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select(*FIELDS).collect()]
    found = queries.QUERIES["op11_merkle_manifest"](spark, sf)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == plain(rows)
