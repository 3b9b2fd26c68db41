"""Token counts: the best unigram segmentation, worked out once per shared prefix of the pre-tokens."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulseframe.llm.lattice import MARK, VOCABULARY, vocabulary
from pulseframe.llm.words import blocks, map_rows

# Different pre-tokens that a task keeps the counts of before it forgets them.
KEPT_WORDS = 300_000
# Log probability of a character without a piece, below that of any piece. It counts as its UTF-8 bytes.
UNKNOWN = -30.0


class Suffixes:
    """Every suffix of a piece, with the piece's score or None: read backwards, a trie."""

    def __init__(self, pieces: Sequence[str], scores: Sequence[float]) -> None:
        self.of: dict[str, float | None] = {}
        for p in pieces:
            for k in range(len(p)):
                self.of.setdefault(p[k:], None)
        self.of.update(zip(pieces, map(float, scores), strict=True))


def trie_counts(words: Sequence[str], pieces: Suffixes) -> dict[str, int]:
    """Tokens in the best segmentation of each different word; ties go to fewer tokens.

    The words, sorted, are the depth-first order of their trie. ``best[k]`` and ``count[k]`` belong
    to the prefix of length k of the present word, so words with a common prefix share its work.
    The count is stored where a word ends.
    """
    of = pieces.of
    best, count, before, out = [0.0], [0], "", {}
    for word in sorted(words):
        same = 0
        for a, b in zip(word, before, strict=False):
            if a != b:
                break
            same += 1
        del best[same + 1 :], count[same + 1 :]
        for stop in range(same + 1, len(word) + 1):
            top = best[stop - 1] + UNKNOWN
            n = count[stop - 1] + len(word[stop - 1].encode("utf-8", "surrogatepass"))
            for start in range(stop - 1, -1, -1):
                score = of.get(word[start:stop], 0)
                if score == 0:  # no piece ends like this
                    break
                if score is not None:
                    score += best[start]
                    if score > top or score == top and count[start] + 1 < n:
                        top, n = score, count[start] + 1
            best.append(top)
            count.append(n)
        out[word] = count[-1]
        before = word
    return out


def token_counts(docs: DataFrame, text: str = "text", path: str = VOCABULARY) -> DataFrame:
    """The rows of ``docs`` with ``n_pretokens`` and ``n_tokens``.

    Pre-tokens are the runs between ASCII white space, marked as word starts. A null or empty text
    has none. Repeated rows are counted one by one; columns of ``docs`` named like the new ones are
    replaced. No rows are moved: each task keeps the counts of the pre-tokens it has met.
    """
    names, scores = vocabulary(path)
    shared = docs.sparkSession.sparkContext.broadcast(Suffixes(names, scores))
    out = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in ("n_pretokens", "n_tokens")])
    out = out.withColumns({"n_pretokens": F.lit(0).cast("long"), "n_tokens": F.lit(0).cast("long")})

    def count(batches):
        known: dict[bytes, int] = {}
        for block in blocks(batches, text):
            texts = pc.fill_null(block.column(text).cast(pa.binary()), b"").to_pylist()
            found = [Counter(t.split()) for t in texts]
            if len(known) > KEPT_WORDS:
                known = {}
            new = {w for c in found for w in c if w not in known}
            counts = trie_counts([MARK + w.decode() for w in new], shared.value)
            known.update((w, counts[MARK + w.decode()]) for w in new)
            number = [sum(c.values()) for c in found]
            tokens = [
                int(np.fromiter(map(known.__getitem__, c), np.int64, len(c)) @ np.fromiter(c.values(), np.int64, len(c)))
                for c in found
            ]
            more = {"n_pretokens": pa.array(number, pa.int64()), "n_tokens": pa.array(tokens, pa.int64())}
            columns = [more.get(n, block.column(n)) for n in block.schema.names]
            yield pa.RecordBatch.from_arrays(columns, names=block.schema.names)

    return map_rows(out, count, out.schema)
