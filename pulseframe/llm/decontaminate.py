"""Benchmark decontamination: test n-grams as a broadcast hash set, scanned over all token windows."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulseframe.llm.words import Words, blocks, map_rows, runs
from pulseframe.session import scratch_path

WINDOW = 13
# Most test windows broadcast at once (about 100 bytes each). More are scanned in several blocks.
BLOCK_WINDOWS = 1_000_000

_FOUND = "n_words long, spans array<struct<start:int,stop:int>>, items array<string>"


@dataclass
class _Index:
    """Normalised test windows: texts with their items, and a small filter over their hashes."""

    items: dict[bytes, list[str]]
    hashes: dict[int, np.ndarray]
    seen: np.ndarray


def _windows(words: Words, first: int, last: int, window: int) -> Iterator[tuple[int, int]]:
    if last - first < window:
        if last > first:
            yield first, last
        return
    for i in range(first, last - window + 1):
        yield i, i + window


def test_windows(benchmark: DataFrame, window: int = WINDOW, item: str = "item_id") -> DataFrame:
    """(item, window): every normalised window of every test text.

    A text with fewer words than ``window`` is one window, one without words none. Null items
    and null texts have none. Repeated rows give the same windows once.
    """

    def scan(batches):
        for block in blocks(batches, "text"):
            words = Words(block.column("text"))
            rows = [
                (name, words.text(i, j))
                for d, name in enumerate(block.column("item").to_pylist())
                for i, j in _windows(words, words.first[d], words.first[d + 1], window)
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.binary())],
                names=["item", "window"],
            )

    texts = benchmark.select(F.col(item).cast("string").alias("item"), F.col("text").cast("string").alias("text"))
    texts = texts.filter("item is not null and text is not null")
    return texts.mapInArrow(scan, "item string, window binary").distinct()


def _index(rows: list, bits: int = 22) -> _Index:
    items: dict[bytes, list[str]] = {}
    for r in rows:
        items.setdefault(bytes(r["window"]), []).append(r["item"])
    by_length: dict[int, list[bytes]] = {}
    for text in items:
        by_length.setdefault(text.count(b" ") + 1, []).append(text)
    hashes, seen = {}, np.zeros(1 << bits, bool)
    for length, texts in by_length.items():
        words = Words(pa.array(texts, pa.binary()))
        found = runs(words.hashes(), length)[words.first[:-1]]
        hashes[length] = np.unique(found)
        seen[(found >> np.uint64(64 - bits)).astype(np.int64)] = True
    return _Index(items, hashes, seen)


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _scan(index: _Index, texts: pa.Array):
    """Per text: number of words, merged word spans inside test windows, items found."""
    words = Words(texts)
    spans: dict[int, list[tuple[int, int]]] = {}
    found: dict[int, set[str]] = {}
    shift = np.uint64(64 - (len(index.seen).bit_length() - 1))
    hashes = words.hashes()
    for length, known in index.hashes.items():
        here = runs(hashes, length)
        at = np.flatnonzero(index.seen[(here >> shift).astype(np.int64)])
        at = at[np.isin(here[at], known)]
        text_of = np.searchsorted(words.first, at, side="right") - 1
        inside = at + length <= words.first[text_of + 1]
        for i, d in zip(at[inside].tolist(), text_of[inside].tolist(), strict=True):
            items = index.items.get(words.text(i, i + length))
            if items:
                base = int(words.first[d])
                spans.setdefault(d, []).append((i - base, i - base + length))
                found.setdefault(d, set()).update(items)
    return words.counts(), spans, found


def _pass(docs: DataFrame, rows: list, column: str) -> DataFrame:
    """Adds what one block of windows finds to the columns of _FOUND."""
    index = docs.sparkSession.sparkContext.broadcast(_index(rows))
    span = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))

    def scan(batches):
        for block in blocks(batches, column):
            counts, spans, found = _scan(index.value, block.column(column))
            old_spans, old_items = block.column("spans").to_pylist(), block.column("items").to_pylist()
            for d, more in spans.items():
                old = [(s["start"], s["stop"]) for s in old_spans[d]]
                old_spans[d] = [{"start": a, "stop": b} for a, b in _merged(old + more)]
                old_items[d] = sorted({*old_items[d], *found[d]})
            new = {
                "n_words": pa.array(counts, pa.int64()),
                "spans": pa.array(old_spans, span),
                "items": pa.array(old_items, pa.list_(pa.string())),
            }
            names = block.schema.names
            yield pa.RecordBatch.from_arrays([new.get(n, block.column(n)) for n in names], names=names)

    return map_rows(docs, scan, docs.schema)


def contaminated_spans(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    window: int = WINDOW,
    block_windows: int = BLOCK_WINDOWS,
) -> DataFrame:
    """The rows of ``docs`` with ``n_words``, ``spans`` and ``items``.

    ``spans`` are the merged word ranges (start, stop) inside any occurrence of a test window,
    ``items`` the test items with an occurring window, sorted as text. Null and empty texts have
    no words, spans or items. Repeated rows are judged one by one. An empty benchmark finds
    nothing. Columns of ``docs`` named like the three new ones are replaced.

    The windows are broadcast in blocks of at most ``block_windows``; with more than one block,
    the rows are written to the shared folder between the passes.
    """
    spark = docs.sparkSession
    windows = test_windows(benchmark, window)
    n_blocks = max(1, -(-windows.count() // block_windows))
    new = ("n_words", "spans", "items")
    out = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in new])
    out = out.withColumns(
        {
            "n_words": F.lit(0).cast("long"),
            "spans": F.array().cast("array<struct<start:int,stop:int>>"),
            "items": F.array().cast("array<string>"),
        }
    )
    for b in range(n_blocks):
        if b:
            path = scratch_path(spark, "decontaminate")
            out.write.parquet(path)
            out = spark.read.schema(out.schema).parquet(path)
        part = windows.filter(F.pmod(F.xxhash64("window"), F.lit(n_blocks)) == b)
        out = _pass(out, part.collect(), text)
    return out


def contamination(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``contaminated_spans`` with ``n_hit``, ``n_items`` and ``contaminated``.

    A document is contaminated if any word is hit and the hit words are a twentieth of all or more.
    """
    found = contaminated_spans(docs, benchmark, **options)
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["stop"] - s["start"])
    found = found.withColumns({"n_hit": hit, "n_items": F.size("items").cast("long")})
    return found.withColumn("contaminated", F.expr("n_hit > 0 and 20 * n_hit >= n_words"))


def without_spans(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """``docs`` with the found word ranges cut out of the text, whole documents kept."""
    found = contaminated_spans(docs, benchmark, text=text, **options)

    def cut(batches):
        for block in blocks(batches, text):
            texts = pc.fill_null(block.column(text).cast(pa.binary()), b"").to_pylist()
            words = Words(block.column(text))
            for d, spans in enumerate(block.column("spans").to_pylist()):
                for s in reversed(spans):
                    base, lead = int(words.first[d]), int(words.offsets[d])
                    a, b = words.starts[base + s["start"]] - lead, words.ends[base + s["stop"] - 1] - lead
                    texts[d] = texts[d][:a].rstrip() + b" " + texts[d][b:].lstrip()
            nulls = block.column(text).is_null().to_pylist()
            fixed = pa.array([None if n else t.decode() for t, n in zip(texts, nulls, strict=True)], pa.string())
            names = [n for n in block.schema.names if n not in ("n_words", "spans", "items")]
            columns = [fixed if n == text else block.column(n) for n in names]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return map_rows(found, cut, found.drop("n_words", "spans", "items").schema)


def items_digest(items: str = "items"):
    """Lower-case SHA-256 of the items, comma-joined."""
    return F.sha2(F.array_join(items, ","), 256)


EMPTY_DIGEST = hashlib.sha256(b"").hexdigest()
