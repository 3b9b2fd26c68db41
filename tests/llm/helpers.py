"""Small frames and plain versions of the operators."""

from __future__ import annotations

import math
import re
import string

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def documents(spark, texts, lang="en"):
    """Documents 0, 1, ... with these texts."""
    rows = [(i, t, lang, "src0", None if t is None else len(t)) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def sentence(rng, n: int, pool: int = 5000) -> str:
    return " ".join(f"w{rng.randrange(pool)}x" for _ in range(n)).capitalize() + "."


def prose(rng, sentences: int, n: int = 9, pool: int = 5000) -> str:
    return " ".join(sentence(rng, n, pool) for _ in range(sentences))


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def log_sum(values):
    m = max(values)
    return m + math.log(sum(math.exp(v - m) for v in values))


def segmentations(word: str, pieces):
    """Every way to cut a word into pieces; a character without a piece stands alone."""
    if not word:
        yield []
        return
    for k in range(1, len(word) + 1):
        if word[:k] in pieces or k == 1:
            for rest in segmentations(word[k:], pieces):
                yield [word[:k], *rest]
