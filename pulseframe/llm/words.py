"""Words and word runs of whole text columns, as numpy arrays over the Arrow buffers."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Texts are taken in blocks of about so many bytes; a longer text is a block of its own.
BLOCK_BYTES = 1_000_000

# An odd factor of the byte polynomial, and the two of a 64-bit mixer.
FACTOR = np.uint64(0x9E3779B97F4A7C15)
MIX_A = np.uint64(0xBF58476D1CE4E5B9)
MIX_B = np.uint64(0x94D049BB133111EB)


def _word_bytes() -> np.ndarray:
    """Byte -> lower-case byte of a word, or 0 for a byte that separates words.

    Words are runs of a-z, 0-9 and all bytes beyond ASCII, after A-Z are lower-cased.
    """
    table = np.zeros(256, np.uint8)
    for b in range(256):
        lower = b + 32 if 65 <= b <= 90 else b
        if 48 <= lower <= 57 or 97 <= lower <= 122 or lower >= 128:
            table[b] = lower
    return table


WORD_BYTES = _word_bytes()
_powers = np.ones(1, np.uint64)


def powers(n: int) -> np.ndarray:
    """FACTOR to the powers 0 .. n-1, modulo 2**64."""
    global _powers
    if len(_powers) < n:
        steps = np.full(max(n, 64), FACTOR, np.uint64)
        steps[0] = 1
        _powers = np.multiply.accumulate(steps)
    return _powers[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    h = (h ^ (h >> np.uint64(30))) * MIX_A
    h = (h ^ (h >> np.uint64(27))) * MIX_B
    return h ^ (h >> np.uint64(31))


def blocks(
    batches: Iterable[pa.RecordBatch], column: str, limit: int = BLOCK_BYTES
) -> Iterator[pa.RecordBatch]:
    """Slices of the batches whose texts hold about ``limit`` bytes together."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        group = np.cumsum(lengths) // limit
        edges = np.flatnonzero(np.diff(group)) + 1
        for a, b in zip([0, *edges], [*edges, batch.num_rows], strict=True):
            if b > a:
                yield batch.slice(a, b - a)


# Stands for a dot while rows pass through Python, which cannot take columns with a dot in their name.
_DOT = "\ue000"


def map_rows(
    df: DataFrame, function: Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: T.StructType
) -> DataFrame:
    """``mapInArrow`` for columns of any name."""
    names, out = df.columns, schema.fieldNames()
    if not any("." in n for n in (*names, *out)):
        return df.mapInArrow(function, schema)
    plain = [n.replace(".", _DOT) for n in out]

    def renamed(batches):
        for batch in function(b.rename_columns(names) for b in batches):
            yield batch.rename_columns(plain)

    fields = [T.StructField(n, f.dataType) for n, f in zip(plain, schema.fields, strict=True)]
    return df.toDF(*[n.replace(".", _DOT) for n in names]).mapInArrow(renamed, T.StructType(fields)).toDF(*out)


class Words:
    """Words of a block of texts: where they lie, and a 64-bit hash of each.

    ``first[d]`` and ``first[d + 1]`` bound the words of text ``d``. A null text has none.
    """

    def __init__(self, texts: pa.Array, table: np.ndarray = WORD_BYTES) -> None:
        texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
        _, at, data = texts.buffers()
        offsets = np.frombuffer(at, np.int64)[texts.offset : texts.offset + len(texts) + 1]
        raw = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
        self.data = table[raw[offsets[0] : offsets[-1]]]
        self.offsets = offsets - offsets[0]
        inside = self.data != 0
        before = np.empty(len(inside) + 1, bool)
        before[0], before[1:] = False, inside
        after = np.empty(len(inside) + 1, bool)
        after[:-1], after[-1] = inside, False
        before[self.offsets] = False  # a text starts here
        self.starts = np.flatnonzero(inside & ~before[:-1])
        # a word ends before a separator, at the end, or where the next text starts
        nexts = after[1:].copy()
        nexts[self.offsets[1:][self.offsets[1:] > 0] - 1] = False
        self.ends = np.flatnonzero(inside & ~nexts) + 1
        self.first = np.searchsorted(self.starts, self.offsets)
        self.n = len(self.starts)
        self._inside = inside

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self) -> np.ndarray:
        """A hash of each word."""
        if not self.n:
            return np.zeros(0, np.uint64)
        lengths = self.ends - self.starts
        begins = np.cumsum(lengths) - lengths
        place = np.arange(begins[-1] + lengths[-1]) - np.repeat(begins, lengths)
        value = self.data[self._inside].astype(np.uint64) * powers(int(lengths.max()))[place]
        return mix(np.add.reduceat(value, begins))

    def text(self, i: int, j: int) -> bytes:
        """Words i .. j-1, joined by one space."""
        return b" ".join(self.data[a:b].tobytes() for a, b in zip(self.starts[i:j], self.ends[i:j], strict=True))


def runs(hashes: np.ndarray, length: int) -> np.ndarray:
    """Hash of the ``length`` words from each place on; as many as there are whole runs."""
    n = max(0, len(hashes) - length + 1)
    out = np.zeros(n, np.uint64)
    for k, p in enumerate(powers(length)):
        out += hashes[k : k + n] * p
    return mix(out + np.uint64(length))
