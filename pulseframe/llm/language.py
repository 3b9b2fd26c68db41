"""Language identification: unigram pieces per language, summed over all segmentations of a text."""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulseframe.llm.lattice import MARK, VOCABULARY, Lattice, vocabulary
from pulseframe.llm.words import blocks, map_rows

UNDETERMINED = "und"
# Different words that a task keeps before it adds them up or forgets them.
KEPT_WORDS = 200_000

_LETTERS = re.compile(r"[^\W\d_]+")


def letter_words(text: str) -> list[str]:
    """Runs of letters, lower-cased. Other characters that belong to words are dropped later."""
    return _LETTERS.findall(text.lower())


def _letters(word: str) -> str:
    return word if word.isalpha() else "".join(filter(str.isalpha, word))


class Model:
    """Languages, their log priors, and log probabilities of pieces by language (column)."""

    def __init__(self, lattice: Lattice, languages: list[str], prior: np.ndarray, log_p: np.ndarray) -> None:
        self.lattice, self.languages, self.prior, self.log_p = lattice, languages, prior, log_p


def train(docs: DataFrame, text: str = "text", lang: str = "lang", path: str = VOCABULARY) -> Model:
    """Learn piece probabilities of each language from all rows with a text and a language.

    Each word's pieces are counted by their expected number under the vocabulary's own scores.
    Null texts and languages are left out; repeated rows count again. Only one vector of piece
    counts per language reaches the driver.
    """
    pieces, scores = vocabulary(path)
    lattice = Lattice(pieces)
    start = lattice.start(scores)
    shared = docs.sparkSession.sparkContext.broadcast((lattice, start))

    def count(batches):
        lattice, start = shared.value
        seen: dict[str, Counter] = {}
        total: dict[str, np.ndarray] = {}
        n_docs: Counter = Counter()

        def add_up() -> None:
            names = list(seen)
            joined: dict[str, np.ndarray] = {}
            for g, name in enumerate(names):
                for word, n in seen[name].items():
                    word = _letters(word)
                    if word:
                        joined.setdefault(MARK + word, np.zeros(len(names)))[g] += n
            if joined:
                counts = lattice.expected(list(joined), np.array(list(joined.values())), start)
                for g, name in enumerate(names):
                    total[name] = total.get(name, 0) + counts[:, g]
            seen.clear()

        for block in blocks(batches, "text"):
            for t, name in zip(block.column("text").to_pylist(), block.column("lang").to_pylist(), strict=True):
                n_docs[name] += 1
                seen.setdefault(name, Counter()).update(letter_words(t))
            if sum(map(len, seen.values())) > KEPT_WORDS:
                add_up()
        add_up()
        rows = [(name, -1, float(n)) for name, n in n_docs.items()]
        for name, counts in total.items():
            rows += [(name, int(i), float(counts[i])) for i in np.flatnonzero(counts)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(x) for x in zip(*rows, strict=True)] if rows else [pa.array([], t) for t in (pa.string(), pa.int64(), pa.float64())],
            names=["lang", "piece", "n"],
        )

    texts = docs.select(F.col(f"`{text}`").cast("string").alias("text"), F.col(f"`{lang}`").cast("string").alias("lang"))
    counted = texts.filter("text is not null and lang is not null").mapInArrow(count, "lang string, piece long, n double")
    rows = counted.groupBy("lang", "piece").agg(F.sum("n").alias("n")).collect()
    languages = sorted({r["lang"] for r in rows})
    counts, n_docs = np.zeros((lattice.n + 1, len(languages))), np.ones(len(languages))
    for r in rows:
        if r["piece"] < 0:
            n_docs[languages.index(r["lang"])] += r["n"]
        else:
            counts[r["piece"], languages.index(r["lang"])] = r["n"]
    return Model(lattice, languages, np.log(n_docs / n_docs.sum()), lattice.log_p(counts))


class _Scores:
    """Scores of words, kept from text to text; forgotten when they are too many."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self.at: dict[str, int] = {}
        self.rows = np.zeros((0, len(model.languages)))

    def need(self, words: list[Counter]) -> None:
        if len(self.at) > KEPT_WORDS:
            self.at, self.rows = {}, self.rows[:0]
        new = list({w for c in words for w in c if w not in self.at})
        kept = [_letters(w) for w in new]
        scores = np.zeros((len(new), self.rows.shape[1]))
        full = [i for i, w in enumerate(kept) if w]
        if full:
            scores[full] = self.model.lattice.score([MARK + kept[i] for i in full], self.model.log_p)
        self.at.update(zip(new, range(len(self.rows), len(self.rows) + len(new)), strict=True))
        self.rows = np.concatenate([self.rows, scores])

    def text(self, words: Counter) -> np.ndarray:
        at = np.fromiter(map(self.at.__getitem__, words), np.int64, len(words))
        return np.fromiter(words.values(), float, len(words)) @ self.rows[at]


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows of ``docs`` with ``lang_pred`` and ``score``, from the text alone.

    ``score`` is the posterior probability of the predicted language. A null text, a text without
    letters and a model without languages give ``und`` and 0. Ties go to the first language by
    name. Columns of ``docs`` named like the new ones are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    out = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in ("lang_pred", "score")])
    out = out.withColumns({"lang_pred": F.lit(None).cast("string"), "score": F.lit(0.0)})

    def judge(batches):
        model = shared.value
        scores = _Scores(model)
        for block in blocks(batches, text):
            words = [Counter(letter_words(t)) if t else Counter() for t in block.column(text).to_pylist()]
            names, sure = [], []
            scores.need(words)
            for c in words:
                if not model.languages or not any(_letters(w) for w in c):
                    names.append(UNDETERMINED)
                    sure.append(0.0)
                    continue
                joint = model.prior + scores.text(c)
                best = int(np.argmax(joint))
                names.append(model.languages[best])
                sure.append(float(1 / np.exp(joint - joint[best]).sum()))
            new = {"lang_pred": pa.array(names, pa.string()), "score": pa.array(sure, pa.float64())}
            columns = [new.get(n, block.column(n)) for n in block.schema.names]
            yield pa.RecordBatch.from_arrays(columns, names=block.schema.names)

    return map_rows(out, judge, out.schema)
