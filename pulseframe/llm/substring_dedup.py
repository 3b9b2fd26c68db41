"""Substring dedup: runs of consecutive sentences, hashed and joined over the whole corpus."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulseframe.llm.words import Words, blocks, map_rows, mix, powers
from pulseframe.session import scratch_path

# A run: the fewest sentences from a place on or up to one, two at least, that have so many words together.
RUN_SENTENCES = 2
RUN_WORDS = 25
# A sentence of so many words is a run by itself.
LONG_SENTENCE = 50
# Hashes that make up this part of all repeated places each are broadcast: at most as many as its inverse.
FREQUENT = 1 / 10_000

_ENDS = np.zeros(256, bool)
_ENDS[[ord(c) for c in ".!?"]] = True
_SPACE = np.zeros(256, bool)
_SPACE[[ord(c) for c in " \t\n\r\x0b\x0c"]] = True


class Sentences:
    """Sentences of a block of texts.

    A sentence ends at a line feed, or at ``.``, ``!`` or ``?`` before white space. What has no
    word (letters A-Z, digits, bytes beyond ASCII) belongs to the sentence before it, or to the
    first one. ``first[d]`` and ``first[d + 1]`` bound the sentences of text ``d``; ``begins`` are
    byte places within the text; ``sizes`` are words.
    """

    def __init__(self, texts: pa.Array) -> None:
        texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
        words = Words(texts)
        raw = np.frombuffer(b"".join(texts.to_pylist()), np.uint8)
        breaks = raw == 10
        breaks[:-1] |= _ENDS[raw[:-1]] & _SPACE[raw[1:]]
        passed = np.concatenate([[0], np.cumsum(breaks)])
        new = np.ones(words.n, bool)
        if words.n:
            new[1:] = passed[words.starts[1:]] > passed[words.ends[:-1]]
            new[words.first[:-1][words.first[:-1] < words.n]] = True
        at = np.flatnonzero(new)  # first word of each sentence
        self.first = np.searchsorted(at, words.first)
        self.sizes = np.diff(np.append(at, words.n))
        text_of = np.searchsorted(words.first, at, side="right") - 1
        self.begins = words.starts[at] - words.offsets[text_of]
        has = np.diff(self.first) > 0
        self.begins[self.first[:-1][has]] = 0
        if words.n:
            place = np.arange(words.n) - np.repeat(at, self.sizes)
            value = words.hashes() * powers(int(self.sizes.max()))[place]
            self.hashes = mix(np.add.reduceat(value, at))
        else:
            self.hashes = np.zeros(0, np.uint64)

    def runs(self, sentences: int, least: int, long: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash and number of sentences of the run from each sentence on; 0 sentences: no run."""
        n = len(self.sizes)
        text_end = np.repeat(self.first[1:], np.diff(self.first))
        words = np.concatenate([[0], np.cumsum(self.sizes)])
        # the first sentence after which the run has enough words
        stop = np.searchsorted(words, words[:-1] + least, side="left")
        stop = np.maximum(stop, np.arange(n) + sentences)
        stop = np.where(self.sizes >= long, np.arange(n) + 1, stop)
        size = np.where(stop <= text_end, stop - np.arange(n), 0)
        return self._hashed(np.arange(n), size), size

    def endings(self, sizes: np.ndarray, sentences: int, least: int, long: int) -> tuple[np.ndarray, ...]:
        """Hash and number of sentences of the shortest run that ends with a sentence, by its place.

        Runs that are among those of ``sizes``, as ``runs`` gives them, are left out. The third
        array bounds the runs that begin with a sentence.
        """
        n = len(self.sizes)
        text_begin = np.repeat(self.first[:-1], np.diff(self.first))
        words = np.concatenate([[0], np.cumsum(self.sizes)])
        begin = np.searchsorted(words, words[1:] - least, side="right") - 1
        begin = np.minimum(begin, np.arange(n) + 1 - sentences)
        begin = np.where(self.sizes >= long, np.arange(n), begin)
        last = np.flatnonzero(begin >= text_begin)
        begin = begin[last]
        new = sizes[begin] != last + 1 - begin
        begin, size = begin[new], (last + 1 - begin)[new]
        order = np.argsort(begin, kind="stable")
        begin, size = begin[order], size[order]
        return self._hashed(begin, size), size, np.searchsorted(begin, np.arange(n + 1))

    def _hashed(self, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
        most = int(size.max(initial=0))
        out, weight = np.zeros(len(size), np.uint64), powers(most + 1)
        for k in range(most):
            at = np.flatnonzero(size > k)
            out[at] += self.hashes[begin[at] + k] * weight[k]
        return mix(out + size.astype(np.uint64))


def _lists(values: np.ndarray | pa.Array, first: np.ndarray, kind: pa.DataType | None = None) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(values, kind) if kind else values)


def sentence_runs(
    docs: DataFrame, text: str, doc_id: str, sentences: int, least: int, long: int
) -> DataFrame:
    """(doc, copy, hashes, sizes, end_hashes, end_sizes): runs from each sentence of a text on.

    ``hashes`` and ``sizes`` have the shortest one, ``end_hashes`` and ``end_sizes`` a list of those
    that are the shortest one to end with their last sentence. Together they cover a repeated
    passage to its last sentence. Documents are ordered by ``doc``, the id, then ``copy``, a hash of the text.
    """

    def scan(batches):
        for block in blocks(batches, "text"):
            found = Sentences(block.column("text"))
            hashes, sizes = found.runs(sentences, least, long)
            end_hashes, end_sizes, bounds = found.endings(sizes, sentences, least, long)
            yield pa.RecordBatch.from_arrays(
                [
                    block.column("doc"), block.column("copy"),
                    _lists(hashes.view(np.int64), found.first, pa.int64()), _lists(sizes, found.first, pa.int32()),
                    _lists(_lists(end_hashes.view(np.int64), bounds, pa.int64()), found.first),
                    _lists(_lists(end_sizes, bounds, pa.int32()), found.first),
                ],
                names=["doc", "copy", "hashes", "sizes", "end_hashes", "end_sizes"],
            )

    keyed = docs.select(
        F.col(f"`{doc_id}`").alias("doc"),
        F.xxhash64(F.col(f"`{text}`")).alias("copy"),
        F.col(f"`{text}`").cast("string").alias("text"),
    )
    kind = keyed.schema["doc"].dataType.simpleString()
    return keyed.filter("text is not null").mapInArrow(
        scan,
        f"doc {kind}, copy long, hashes array<long>, sizes array<int>, "
        "end_hashes array<array<long>>, end_sizes array<array<int>>",
    )


def _occurrences(each: DataFrame) -> DataFrame:
    """The rows of ``each`` whose hash is at several places, with ``first``, the first of them.

    Minimum, maximum and number are combined before the shuffle, so a run that a third of all
    documents share costs one row per task. Hashes that make up a FREQUENT-th of all repeated places
    each are broadcast, and their rows stay where they are; of the others, which are joined by
    shuffle, none has more rows than that.
    """
    spark = each.sparkSession
    known = each.groupBy("hash").agg(
        *[f(F.struct("doc", "copy", "pos")).alias(n) for f, n in ((F.min, "first"), (F.max, "last"))],
        F.count("*").alias("n"),
    )
    path = scratch_path(spark, "repeated-hashes")
    known.filter("first <> last").select("hash", "first", "n").write.parquet(path)
    known = spark.read.parquet(path)
    least = (known.agg(F.sum("n")).first()[0] or 0) * FREQUENT
    frequent = F.broadcast(known.filter(F.col("n") >= least).drop("n"))
    others = each.join(frequent.select("hash"), "hash", "left_anti")
    return each.join(frequent, "hash").unionByName(others.join(known.filter(F.col("n") < least).drop("n"), "hash"))


def repeated_runs(runs: DataFrame) -> DataFrame:
    """(doc, copy, cuts): sentences (pos, size) covered by a repeated run other than its first.

    The first occurrence is that of the smallest (doc, copy, pos). A run that is the shortest one
    to its end holds the shortest one from its begin, so it is looked at only where that is repeated.
    """
    zipped = F.arrays_zip("hashes", "sizes", "end_hashes", "end_sizes")
    each = runs.select("doc", "copy", F.posexplode(zipped).alias("pos", "run")).filter("run.sizes > 0")
    each = each.select(
        F.col("run.hashes").alias("hash"), "doc", "copy", "pos", F.col("run.sizes").alias("size"),
        F.arrays_zip(F.col("run.end_hashes").alias("hash"), F.col("run.end_sizes").alias("size")).alias("ends"),
    )
    path = scratch_path(runs.sparkSession, "repeated-runs")
    _occurrences(each).write.parquet(path)
    found = runs.sparkSession.read.parquet(path)
    ends = found.select("doc", "copy", "pos", F.explode("ends").alias("end"))
    ends = _occurrences(ends.select(F.col("end.hash").alias("hash"), "doc", "copy", "pos", F.col("end.size").alias("size")))
    later = found.drop("ends").unionByName(ends).filter("struct(doc, copy, pos) <> first")
    return later.groupBy("doc", "copy").agg(F.array_sort(F.collect_set(F.struct("pos", "size"))).alias("cuts"))


def substring_dedup(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    sentences: int = RUN_SENTENCES,
    least: int = RUN_WORDS,
    long: int = LONG_SENTENCE,
) -> DataFrame:
    """The rows of ``docs`` without sentences that a run seen before covers.

    Runs occur in the order of (doc_id, text hash, place); all but the first occurrence of a run
    lose their sentences. Adds ``n_sentences`` and ``n_removed``, replacing columns of that name;
    a text that loses nothing stays as it is to the last byte. Null and empty texts stay, with no
    sentences. A null id comes first. Rows repeated with the same id and text count as one document
    and get the same result. No row is dropped: a text that loses everything becomes empty.
    """
    spark = docs.sparkSession
    new = ("n_sentences", "n_removed")
    names = [c for c in docs.columns if c not in new]
    docs = docs.select(*[F.col(f"`{c}`") for c in names])
    path = scratch_path(spark, "sentence-runs")
    sentence_runs(docs, text, doc_id, sentences, least, long).write.parquet(path)
    cuts = repeated_runs(spark.read.parquet(path))
    # names that no column of the documents has
    prefix = "_" * (1 + max((len(c) - len(c.lstrip("_")) for c in names), default=0))
    doc, copy, spans_of = (prefix + n for n in ("doc", "copy", "cuts"))
    cuts = cuts.select(F.col("doc").alias(doc), F.col("copy").alias(copy), F.col("cuts").alias(spans_of))
    same = F.col(f"`{doc_id}`").eqNullSafe(F.col(doc)) & (F.xxhash64(F.col(f"`{text}`")) == F.col(copy))
    counts = {"n_sentences": F.lit(0), "n_removed": F.lit(0)}
    joined = docs.join(cuts, same, "left").drop(doc, copy).withColumns(counts)

    def cut(batches):
        for block in blocks(batches, text):
            column = block.column(text)
            found = Sentences(column)
            number = np.diff(found.first)
            removed, fixed = np.zeros(len(number), np.int64), {}
            for d, spans in enumerate(block.column(spans_of).to_pylist()):
                if not spans:
                    continue
                gone = np.zeros(int(number[d]), bool)
                for s in spans:
                    gone[s["pos"] : s["pos"] + s["size"]] = True
                removed[d] = gone.sum()
                raw = column[d].as_py().encode("utf-8", "surrogatepass")
                begins = [*found.begins[found.first[d] : found.first[d + 1]].tolist(), len(raw)]
                parts = [raw[begins[i] : begins[i + 1]] for i in np.flatnonzero(~gone)]
                fixed[d] = b"".join(parts).rstrip().decode("utf-8", "surrogatepass")
            texts = column
            if fixed:
                texts = pa.array([fixed.get(d, t) for d, t in enumerate(column.to_pylist())], column.type)
            more = {text: texts, "n_sentences": pa.array(number, pa.int32()), "n_removed": pa.array(removed, pa.int32())}
            kept = [n for n in block.schema.names if n != spans_of]
            yield pa.RecordBatch.from_arrays([more.get(n, block.column(n)) for n in kept], names=kept)

    return map_rows(joined, cut, joined.drop(spans_of).schema)
