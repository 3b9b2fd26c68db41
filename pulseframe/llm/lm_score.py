"""Language-model scores: the probability of a text, summed over all its subword segmentations."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulseframe.llm.lattice import MARK, VOCABULARY, Lattice, vocabulary
from pulseframe.llm.words import blocks
from pulseframe.session import scratch_path

# Different words that a task keeps before it passes their counts on.
KEPT_WORDS = 200_000
# Words that make up this part of all training tokens each are broadcast: at most as many as its inverse.
FREQUENT = 1 / 50_000
# Groups of documents with a model of their own; the smaller ones beyond share the last.
GROUPS = 8
# Part of a seen word's count that goes to the lattice of pieces, and the pooled model's part in each group's.
DISCOUNT = 0.75
POOLED = 0.1


def _tokens(texts: pa.Array) -> list[Counter]:
    """Words of each text, A-Z lower-cased, split at ASCII white space."""
    return [Counter(t.lower().split()) for t in pc.fill_null(texts.cast(pa.binary()), b"").to_pylist()]


def word_counts(docs: DataFrame, n_groups: int) -> DataFrame:
    """(word, n): every word of the ``text`` column, with its counts by ``grp``.

    Rows whose ``grp`` is null give their words a count of 0.
    """

    def count(batches):
        def rows(seen: dict) -> pa.RecordBatch:
            words = [w for c in seen.values() for w in c]
            groups = [g for g, c in seen.items() for _ in c]
            numbers = [n if g is not None else 0 for g, c in seen.items() for n in c.values()]
            return pa.RecordBatch.from_arrays(
                [pa.array(words, pa.binary()).cast(pa.string()), pa.array(groups, pa.int32()), pa.array(numbers, pa.int64())],
                names=["word", "grp", "n"],
            )

        seen: dict[int | None, Counter] = {}
        for block in blocks(batches, "text"):
            for words, g in zip(_tokens(block.column("text")), block.column("grp").to_pylist(), strict=True):
                seen.setdefault(g, Counter()).update(words)
            if sum(map(len, seen.values())) > KEPT_WORDS:
                yield rows(seen)
                seen = {}
        yield rows(seen)

    counted = docs.select("text", "grp").mapInArrow(count, "word string, grp int, n long")
    by_group = [F.sum(F.when(F.col("grp") == g, F.col("n")).otherwise(0)).alias(f"n{g}") for g in range(n_groups)]
    return counted.groupBy("word").agg(*by_group).select(
        "word", F.array(*[f"n{g}" for g in range(n_groups)]).alias("n")
    )


def _matrix(column: pa.ListArray, n_groups: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, n_groups).astype(float)


def fit(counts: DataFrame, n_groups: int, path: str = VOCABULARY):
    """The lattice and log probabilities of its pieces, by group and pooled (last column).

    Two rounds of expectation maximisation over the different training words, the first from the
    vocabulary's own scores. Only expected counts of the vocabulary's pieces reach the driver.
    """
    pieces, scores = vocabulary(path)
    lattice = Lattice(pieces)
    spark = counts.sparkSession
    shared = spark.sparkContext.broadcast(lattice)
    now = lattice.start(scores)
    for _ in range(2):

        def expect(batches, now=now):
            lattice, total = shared.value, None
            for batch in batches:
                seen = _matrix(batch.column("n"), n_groups) > 0
                words = [MARK + w for w in batch.column("word").to_pylist()]
                weights = np.column_stack([seen, seen.any(axis=1)]).astype(float)
                found = lattice.expected(words, weights, now)
                total = found if total is None else total + found
            if total is not None:
                at, group = np.nonzero(total)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(at), pa.array(group), pa.array(total[at, group])], names=["piece", "grp", "n"]
                )

        seen = counts.filter(F.exists("n", lambda n: n > 0))
        rows = seen.mapInArrow(expect, "piece long, grp long, n double").groupBy("piece", "grp").agg(F.sum("n").alias("n"))
        expected = np.zeros((lattice.n + 1, n_groups + 1))
        for r in rows.collect():
            expected[r["piece"], r["grp"]] = r["n"]
        log_p = lattice.log_p(expected)
        now = log_p[:, -1:]
    return lattice, log_p


class WordModel:
    """Log probability of words, by group: counted words, discounted, and the lattice of pieces.

    A seen word is one more edge over the whole of its lattice, worth its discounted share of the
    group's tokens; what the discount leaves weights the segmentations into vocabulary pieces.
    ``tokens`` and ``types`` are those of each group and of all (last), ends of texts included;
    one more end is taken for granted, so that the model is proper without any training text.
    """

    def __init__(self, lattice: Lattice, log_p: np.ndarray, tokens: np.ndarray, types: np.ndarray) -> None:
        self.lattice, self.log_p, self.tokens, self.types = lattice, log_p, tokens, types

    def _mixed(self, p: np.ndarray) -> np.ndarray:
        return np.logaddexp(np.log(1 - POOLED) + p[:, :-1], np.log(POOLED) + p[:, -1:])

    def words(self, words: list[str], counts: np.ndarray) -> np.ndarray:
        counts = np.column_stack([counts, counts.sum(axis=1)])
        pieces = self.lattice.score([MARK + w for w in words], self.log_p)
        left = np.log((DISCOUNT * self.types + 1) / (self.tokens + 1))
        with np.errstate(divide="ignore"):
            whole = np.log(np.maximum(counts - DISCOUNT, 0) / (self.tokens + 1))
        return self._mixed(np.logaddexp(whole, left + pieces))

    def end(self, ends: np.ndarray) -> np.ndarray:
        return self._mixed(np.log((ends - DISCOUNT) / (self.tokens + 1))[None, :])[0]


def _groups(docs: DataFrame, group: str | None) -> list[str]:
    """The most frequent values of the grouping column among training rows, at most GROUPS - 1."""
    if group is None:
        return []
    found = docs.filter("train").groupBy("name").count().filter("name is not null")
    found = found.orderBy(F.desc("count"), "name").limit(GROUPS - 1)
    return [r["name"] for r in found.collect()]


def score(
    docs: DataFrame, text: str = "text", train: str = "train", group: str | None = "lang", path: str = VOCABULARY
) -> DataFrame:
    """The rows of ``docs``, without ``text``, ``train`` and ``group``, with token counts and scores.

    ``train`` names a boolean column: whether the model may learn from the row (null: no).
    ``group`` names a column by which the training rows have models of their own, such as their
    language; other rows' values are never read, as a text is scored by the mixture of all groups.
    New columns, which replace others of the same name: ``n_tokens`` (words and one end),
    ``n_known`` (tokens seen in training), ``train_tokens``, ``base_score`` (log10 of the add-one
    unigram probability) and ``score`` (log10 of the text's probability under the mixture, summed
    over all segmentations). A null text counts as empty: one end. Repeated rows are scored one by
    one. Without training rows all tokens are unknown. ``docs`` must give its rows in the same
    order whenever it is read, as a scan of files does.

    Words are counted and scored once in the whole corpus. Frequent ones, whose number is bounded,
    are broadcast; the others go to their word's partition, where no word has more rows than the
    bound allows.
    """
    spark = docs.sparkSession
    new = ("n_tokens", "n_known", "train_tokens", "base_score", "score")
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in new])
    name = F.lit(None) if group is None else F.col(f"`{group}`")
    texts = docs.select(
        F.col(f"`{text}`").cast("string").alias("text"),
        F.coalesce(F.col(f"`{train}`"), F.lit(False)).alias("train"),
        name.cast("string").alias("name"),
    )
    names = _groups(texts, group)
    n_groups = len(names) + 1
    number = F.coalesce(*[F.when(F.col("name") == v, g) for g, v in enumerate(names)], F.lit(len(names)))
    texts = texts.withColumn("grp", F.when(F.col("train"), number))
    counted = scratch_path(spark, "words")
    word_counts(texts, n_groups).write.parquet(counted)
    counts = spark.read.parquet(counted)

    by_group = [F.col("n")[g] for g in range(n_groups)]
    every = sum(by_group[1:], by_group[0])
    sums = [F.coalesce(F.sum(c), F.lit(0)) for c in (*by_group, every)]
    total = counts.agg(*sums, *[F.count_if(c > 0) for c in (*by_group, every)]).first()
    docs_of = {r["grp"]: r["count"] for r in texts.filter("train").groupBy("grp").count().collect()}
    ends = np.array([docs_of.get(g, 0) for g in range(n_groups)] + [sum(docs_of.values())])
    n_ends = int(ends[-1])
    n = int(total[n_groups]) + n_ends
    v = int(total[2 * n_groups + 1]) + (1 if n_ends else 0)
    tokens = np.array(total[: n_groups + 1], float) + ends + 1
    types = np.array(total[n_groups + 1 :], float) + 1
    lattice, log_p = fit(counts, n_groups, path)
    model = WordModel(lattice, log_p, tokens, types)
    shared = spark.sparkContext.broadcast(model)

    def word_scores(batches):
        model = shared.value
        for batch in batches:
            counts = _matrix(batch.column("n"), n_groups)
            scores = model.words(batch.column("word").to_pylist(), counts)
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(0, scores.size + 1, n_groups), pa.int32()), pa.array(scores.ravel())
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column("word"), pa.array(counts.sum(axis=1).astype(np.int64)), lists], names=["word", "n", "log_p"]
            )

    scored_path = scratch_path(spark, "scored-words")
    counts.mapInArrow(word_scores, "word string, n long, log_p array<double>").write.parquet(scored_path)
    scored = spark.read.parquet(scored_path)
    least = max(1, int(np.ceil(n * FREQUENT)))
    frequent = scored.filter(F.col("n") >= least).collect()
    hot = spark.sparkContext.broadcast(
        (
            {r["word"].encode(): i for i, r in enumerate(frequent)},
            np.array([[r["n"] > 0, np.log10(r["n"] + 1), *r["log_p"]] for r in frequent]).reshape(-1, n_groups + 2),
        )
    )

    def split(batches):
        """A row of sums per text, and one per rare word of it."""
        known, values = hot.value
        for block in blocks(batches, "text"):
            row, word, number, sums = [], [], [], []
            for key, words in zip(block.column("row").to_pylist(), _tokens(block.column("text")), strict=True):
                found = [(known[w], k) for w, k in words.items() if w in known]
                rare = [(w, k) for w, k in words.items() if w not in known]
                at, k = np.array(found, np.int64).reshape(-1, 2).T
                # No word has a space: this row meets no other, wherever it goes.
                row.append(key)
                word.append(b" %d" % key)
                number.append(int(k.sum()))
                sums.append((k @ values[at]).tolist())
                row += [key] * len(rare)
                word += [w for w, _ in rare]
                number += [k for _, k in rare]
                sums += [None] * len(rare)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(row, pa.int64()), pa.array(word, pa.binary()).cast(pa.string()),
                    pa.array(number, pa.int32()), pa.array(sums, pa.list_(pa.float64())),
                ],
                names=["row", "word", "k", "sums"],
            )

    rows = docs.withColumn("__row", F.monotonically_increasing_id())
    parts = rows.select(F.col("__row").alias("row"), F.col(f"`{text}`").cast("string").alias("text"))
    parts = parts.mapInArrow(split, "row long, word string, k int, sums array<double>")
    rare = scored.filter(F.col("n") < least).hint("shuffle_hash")
    joined = parts.join(rare, "word", "left")
    of_word = [F.when(F.col("n") > 0, 1.0).otherwise(0.0), F.log10(F.col("n") + 1)]
    of_word += [F.col("log_p")[g] for g in range(n_groups)]
    summed = [
        F.sum(F.coalesce(F.col("sums")[i], F.col("k") * c)).alias(f"s{i}") for i, c in enumerate(of_word)
    ]
    sums = joined.groupBy("row").agg(F.sum("k").alias("k"), *summed)
    # The mixture: the logarithm of a sum, with its largest term taken out.
    end, share = model.end(ends + 1), np.log((ends[:-1] + 1) / (ends[:-1] + 1).sum())
    terms = F.array(*[F.col(f"s{g + 2}") + float(end[g] + share[g]) for g in range(n_groups)])
    most = F.array_max("terms")
    mixed = most + F.log(F.aggregate("terms", F.lit(0.0), lambda a, t: a + F.exp(t - F.array_max("terms"))))
    n_tokens = (F.col("k") + 1).cast("long")
    sums = sums.withColumn("terms", terms).select(
        F.col("row").alias("__row"),
        n_tokens.alias("n_tokens"),
        (F.round("s0").cast("long") + (1 if n_ends else 0)).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("s1") + float(np.log10(n_ends + 1)) - n_tokens * float(np.log10(n + v + 1))).alias("base_score"),
        (mixed / float(np.log(10))).alias("score"),
    )
    kept = rows.select(*[F.col(f"`{c}`") for c in rows.columns if c not in (text, train, group)])
    return kept.join(sums, "__row").drop("__row")
