"""Near-duplicates: consistent weighted samples of TF-IDF shingles, banded, then verified.

The samples are those of improved consistent weighted sampling. For a shingle and a sample number,
that scheme draws r, c ~ Gamma(2, 1) and b ~ U(0, 1); a weight w gives t = floor(ln w / r + b),
y = exp(r (t - b)) and a = c / (y exp(r)), and the shingle with the smallest a is sampled, with t.
Here the draws are made in an order that has the same distribution: at weight 1, a is exponential
and independent of A = r b, which is exponential too, and c - a given a is exponential again; then
r = A + ln(c / a) and b = A / r. So a shingle of weight 1, which nearly all are, needs one hash, and
the general formula runs for the others only.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pulseframe.llm.components import components
from pulseframe.llm.words import Words, blocks, mix, powers, runs
from pulseframe.session import scratch_path

SHINGLE = 5
SIMILARITY = 0.8
# A pair of similarity 0.8 shares a band with probability 1 - (1 - 0.8 ** 3) ** 9 = 0.998.
BANDS, ROWS = 9, 3
# A shingle in fewer than this part of all documents has full weight, 1. The number of others is
# bounded: documents' mean number of shingles times the inverse, and FEWEST_SHINGLES whatever the mean.
COMMON = 1 / 1000
LEAST_COMMON = 10
# What a shingle in every document would lose of its weight, at most. A copy of a text that very many
# others copy shares only common shingles with them, but differs in rare ones: with a greater loss it
# would fall below the similarity that it has by plain shingles.
DAMPING = 0.25
MOST_COMMON_SHINGLES = 1_000_000
# While counting, shingles seen once are forgotten after so many documents or shingles.
FORGET_DOCS, FORGET_SHINGLES = 4000, 4_000_000
# Documents of a bucket that meet in one task: characters, of which each document counts some more.
BLOCK_CHARS, DOCUMENT_CHARS = 8_000_000, 8_000
# Cells of a matrix of documents and shingles.
MATRIX_CELLS = 4_000_000

_U = np.uint64


class Shingles:
    """Different shingles of a block of texts, sorted by text, with their number in it.

    A text of fewer than five words, but not none, is one shingle. ``first[d]`` and
    ``first[d + 1]`` bound the shingles of text ``d``; ``nodes`` fingerprint the word sequences.
    """

    def __init__(self, texts: pa.Array) -> None:
        words = Words(texts)
        hashes, n = words.hashes(), words.counts()
        short = np.flatnonzero((n > 0) & (n < SHINGLE))
        values = runs(hashes, SHINGLE)
        doc = np.repeat(np.arange(len(n)), n)[: len(values)]
        at = np.flatnonzero(np.arange(len(values)) + SHINGLE <= words.first[1:][doc])
        values, doc = values[at], doc[at]
        if len(short):
            whole = [runs(hashes[words.first[d] : words.first[d + 1]], int(n[d]))[0] for d in short]
            values, doc = np.append(values, np.array(whole, np.uint64)), np.append(doc, short)
        order = np.lexsort((values, doc))
        values, doc = values[order], doc[order]
        new = np.ones(len(values), bool)
        new[1:] = (values[1:] != values[:-1]) | (doc[1:] != doc[:-1])
        begins = np.flatnonzero(new)
        self.values, self.doc = values[begins], doc[begins]
        self.times = np.diff(np.append(begins, len(values)))
        self.first = np.searchsorted(self.doc, np.arange(len(n) + 1))
        self.n_words, self._hashes, self._at = n, hashes, words.first

    def nodes(self) -> list[bytes | None]:
        """16 bytes for each sequence of words; None without words."""
        full = np.flatnonzero(self.n_words)
        out: list[bytes | None] = [None] * len(self.n_words)
        if len(full):
            begins = self._at[:-1][full]
            place = np.arange(len(self._hashes)) - np.repeat(begins, self.n_words[full])
            weight = powers(int(self.n_words.max()))[place]
            size = self.n_words[full].astype(np.uint64)
            one = mix(np.add.reduceat(self._hashes * weight, begins) + size)
            two = mix(np.add.reduceat(mix(self._hashes + _U(1)) * weight, begins) ^ size)
            for d, a, b in zip(full.tolist(), one.tolist(), two.tolist(), strict=True):
                out[d] = a.to_bytes(8, "big") + b.to_bytes(8, "big")
        return out


@dataclass
class Weights:
    """Damped idf of each common shingle; that of every other is 1. Term frequency counts as 1 + ln."""

    values: np.ndarray
    weights: np.ndarray

    def of(self, shingles: np.ndarray, times: np.ndarray) -> np.ndarray:
        out = 1 + np.log(times)
        if len(self.values):
            at = np.minimum(np.searchsorted(self.values, shingles), len(self.values) - 1)
            out *= np.where(self.values[at] == shingles, self.weights[at], 1.0)
        return out


def _grouped(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    key, count = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(key, kind="stable")
    key, count = key[order], count[order]
    begins = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, int)
    return key[begins], np.add.reduceat(count, begins) if len(key) else count


def _rows(kind: str, keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    kinds = pa.array([kind], pa.string()).take(pa.array(np.zeros(len(keys), np.int32)))
    return pa.RecordBatch.from_arrays(
        [kinds, pa.array(keys.view(np.int64)), pa.array(counts.astype(np.int64))], names=["kind", "value", "n"]
    )


def idf_weights(texts: DataFrame) -> Weights:
    """Weights of the shingles of a ``text`` column by their inverse document frequency.

    ln(1 + documents / frequency), as part of its value at the bound below which a shingle is
    rare, damped. A first pass finds every shingle that can reach the bound (it counts each, forgets those
    seen once from time to time, and adds up how much that can hide), a second one counts these.
    """
    spark = texts.sparkSession

    def candidates(batches):
        keys, counts, docs, shingles, forgotten = [], [], 0, 0, 0
        n_docs = n_shingles = size = 0

        def fold(forget: bool) -> None:
            nonlocal keys, counts, size, docs, shingles, forgotten
            key, count = _grouped(keys, counts)
            if forget:
                key, count = key[count > 1], count[count > 1]
                docs, shingles, forgotten = 0, 0, forgotten + 1
            keys, counts, size = [key], [count], 0

        for block in blocks(batches, "text"):
            found = Shingles(block.column("text"))
            keys.append(found.values)
            counts.append(np.ones(len(found.values), np.int64))
            here = int((found.n_words > 0).sum())
            n_docs, docs = n_docs + here, docs + here
            n_shingles, shingles, size = (x + len(found.values) for x in (n_shingles, shingles, size))
            if docs >= FORGET_DOCS or shingles >= FORGET_SHINGLES:
                fold(forget=True)
            elif size >= FORGET_SHINGLES // 4:
                fold(forget=False)
        if keys:
            fold(forget=n_docs >= FORGET_DOCS // 2 and docs > 0)
            yield _rows("shingle", keys[0], counts[0])
        none = np.zeros(1, np.uint64)
        for kind, n in (("docs", n_docs), ("shingles", n_shingles), ("forgotten", forgotten)):
            yield _rows(kind, none, np.array([n]))

    path = scratch_path(spark, "shingles")
    counted = texts.select("text").mapInArrow(candidates, "kind string, value long, n long")
    counted.groupBy("kind", "value").agg(F.sum("n").alias("n")).write.parquet(path)
    counted = spark.read.parquet(path)
    sums = {r["kind"]: r["n"] for r in counted.filter("kind <> 'shingle'").collect()}
    n_docs = sums.get("docs", 0)
    bound = max(LEAST_COMMON, int(np.ceil(n_docs * COMMON)), -(-sums.get("shingles", 0) // MOST_COMMON_SHINGLES))
    able = counted.filter((F.col("kind") == "shingle") & (F.col("n") + sums.get("forgotten", 0) >= bound))
    wanted = np.sort(np.array([r["value"] for r in able.select("value").collect()], np.int64).view(np.uint64))
    if not len(wanted):
        return Weights(wanted, np.zeros(0))
    shared = spark.sparkContext.broadcast(wanted)

    def exact(batches):
        wanted = shared.value
        total = np.zeros(len(wanted), np.int64)
        for block in blocks(batches, "text"):
            values = Shingles(block.column("text")).values
            at = np.minimum(np.searchsorted(wanted, values), len(wanted) - 1)
            total += np.bincount(at[wanted[at] == values], minlength=len(wanted))
        some = np.flatnonzero(total)
        yield _rows("shingle", wanted[some], total[some])

    found = texts.select("text").mapInArrow(exact, "kind string, value long, n long")
    found = found.groupBy("value").agg(F.sum("n").alias("n")).filter(F.col("n") >= bound).collect()
    values = np.array([r["value"] for r in found], np.int64).view(np.uint64)
    order = np.argsort(values)
    frequency = np.array([r["n"] for r in found], float)[order]
    idf = np.log1p(n_docs / frequency) / np.log1p(n_docs / bound)
    return Weights(values[order], 1 - DAMPING * (1 - idf))


def _unit(h: np.ndarray) -> np.ndarray:
    """A number in (0, 1) from the upper bits."""
    return ((h >> _U(11)).astype(float) + 0.5) * 2.0**-53


def samples(found: Shingles, weights: np.ndarray, n: int) -> np.ndarray:
    """``n`` consistent weighted samples (columns) of each text; texts without shingles: 0."""
    full = np.flatnonzero(np.diff(found.first))
    out = np.zeros((len(found.first) - 1, n), np.uint64)
    if not len(full):
        return out
    begins = found.first[:-1][full]
    other = np.flatnonzero(weights != 1)
    log_w = np.log(weights[other])
    seeds = mix(np.arange(1, n + 1, dtype=np.uint64) * _U(0x9E3779B97F4A7C15)) | _U(1)
    doc_of = np.searchsorted(full, found.doc[other])
    for k in range(n):
        h = found.values * seeds[k]
        h ^= h >> _U(32)
        h *= _U(0xD6E8FEB86659FD93)
        h ^= h >> _U(32)
        special = h[other]
        h[other] = _U(0xFFFFFFFFFFFFFFFF)
        low = np.minimum.reduceat(h, begins)
        if len(other):
            a_one = -np.log1p(-_unit(special))
            draw = mix(special + _U(1))
            c = a_one - np.log(_unit(draw))
            big_a = -np.log(_unit(mix(draw + _U(1))))
            r = big_a + np.log(c / a_one)
            b = big_a / r
            t = np.floor(log_w / r + b)
            a = c / np.exp(r * (t - b) + r)
            order = np.lexsort((special, a, doc_of))
            lead = order[np.flatnonzero(np.append(True, doc_of[order][1:] != doc_of[order][:-1]))]
            d = doc_of[lead]
            with np.errstate(divide="ignore"):  # the largest hash, of texts with common shingles only
                best = -np.log1p(-_unit(low[d]))
            wins = (a[lead] < best) | (low[d] == _U(0xFFFFFFFFFFFFFFFF))
            # A sample at t = 0 is the one that the same shingle gives at weight 1.
            step = t[lead[wins]].astype(np.int64)
            name = special[lead[wins]]
            low[d[wins]] = np.where(step == 0, name, mix(name + step.view(np.uint64)))
        out[full, k] = low
    return out


def signatures(docs: DataFrame, weights: Weights) -> DataFrame:
    """(doc, key, node, bands) of each row: the word sequence and its band hashes; no words: null."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    kind = docs.schema["doc"].dataType.simpleString()

    def sign(batches):
        for block in blocks(batches, "text"):
            found = Shingles(block.column("text"))
            drawn = samples(found, shared.value.of(found.values, found.times), BANDS * ROWS)
            drawn = drawn.reshape(len(drawn), BANDS, ROWS)
            bands = np.repeat(np.arange(1, BANDS + 1, dtype=np.uint64)[None, :], len(drawn), axis=0)
            for k in range(ROWS):
                bands = mix(bands * powers(2)[1] + drawn[:, :, k])
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(0, bands.size + 1, BANDS), pa.int32()), pa.array(bands.ravel().view(np.int64))
            )
            yield pa.RecordBatch.from_arrays(
                [block.column("doc"), block.column("key"), pa.array(found.nodes(), pa.binary()), lists],
                names=["doc", "key", "node", "bands"],
            )

    return docs.mapInArrow(sign, f"doc {kind}, key long, node binary, bands array<long>")


def verify(pairs: DataFrame, texts: DataFrame, weights: Weights, least: float) -> DataFrame:
    """The pairs (a, b) of nodes whose texts have a weighted Jaccard similarity of ``least`` or more.

    ``texts`` has one text per node. A first document with very many partners is spread by the
    engine's handling of skewed joins, since the partners' texts come first.
    """
    shared = pairs.sparkSession.sparkContext.broadcast(weights)
    joined = pairs.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
    joined = joined.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")

    def vector(text: str) -> tuple[np.ndarray, np.ndarray]:
        found = Shingles(pa.array([text], pa.string()))
        return found.values, shared.value.of(found.values, found.times)

    def compare(batches):
        last, one = None, None
        for batch in batches:
            kept = []
            columns = [batch.column(c).to_pylist() for c in ("a", "text_a", "text_b")]
            for i, (a, text_a, text_b) in enumerate(zip(*columns, strict=True)):
                if a != last:
                    last, one = a, vector(text_a)
                two = vector(text_b)
                both, at, to = np.intersect1d(one[0], two[0], assume_unique=True, return_indices=True)
                common = np.minimum(one[1][at], two[1][to]).sum()
                if common >= least * (one[1].sum() + two[1].sum() - common) - 1e-12:
                    kept.append(i)
            yield batch.select(["a", "b"]).take(pa.array(kept, pa.int64()))

    return joined.select("a", "b", "text_a", "text_b").mapInArrow(compare, "a binary, b binary")


def _common(found: Shingles, idf: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Sum over all shingles of the smaller weight, for the texts ``rows`` (rows) and all texts.

    A weight is the idf times 1 + ln(times), which is a sum of steps at the numbers of times that
    occur. Two texts have a step in common if both have the shingle so often, so the sum over the
    smaller weights is a product of matrices whose columns are shingles and steps.
    """
    steps = np.unique(found.times)
    gain = np.sqrt(np.diff(1 + np.log(steps), prepend=0))
    n_steps = np.searchsorted(steps, found.times, side="right")
    entry = np.repeat(np.arange(len(n_steps)), n_steps)
    step = np.arange(len(entry)) - np.repeat(np.cumsum(n_steps) - n_steps, n_steps)
    _, shingle = np.unique(found.values, return_inverse=True)
    column, doc = shingle[entry] * len(steps) + step, found.doc[entry]
    value = np.sqrt(idf)[entry] * gain[step]
    # only columns of two texts or more, one of them among the rows
    number = np.bincount(column)
    asked = np.zeros(n, bool)
    asked[rows] = True
    useful = (number > 1) & (np.bincount(column, asked[doc], len(number)) > 0)
    keep = useful[column]
    column, doc, value = (np.cumsum(useful) - 1)[column[keep]], doc[keep], value[keep]
    order = np.argsort(column, kind="stable")
    column, doc, value = column[order], doc[order], value[order]
    out = np.zeros((len(rows), n))
    width = max(1, MATRIX_CELLS // n)
    for begin in range(0, int(useful.sum()), width):
        a, b = np.searchsorted(column, [begin, begin + width])
        part = np.zeros((n, width))
        part[doc[a:b], column[a:b] - begin] = value[a:b]
        out += part[rows] @ part.T
    return out


def _open_links(members: DataFrame, links: DataFrame, texts: DataFrame, weights: Weights, least: float) -> DataFrame:
    """Links (a, b) within buckets whose documents the first round left in several components.

    ``members`` has the first document ``a`` of each bucket, with which the others were compared
    already; it takes no part. Of the others, the largest component is the bucket's main part. All documents outside it are
    compared with all the others, in blocks of bounded size, so no pair that could link two
    components is left out. Of the links found between two components one is returned.
    """
    spark = members.sparkSession
    labels = components(links)
    others = members.filter("node <> a").select("bucket", "node")
    placed = others.join(labels, "node", "left").select("bucket", "node", F.coalesce("label", "node").alias("label"))
    parts = placed.groupBy("bucket", "label").agg(F.count("*").alias("n"))
    main = parts.groupBy("bucket").agg(F.max_by("label", F.struct("n", "label")).alias("main"), F.count("*").alias("parts"))
    open_ = placed.join(main.filter("parts > 1"), "bucket")
    rows = open_.select("bucket", "node", "label", (F.col("label") != F.col("main")).alias("outside")).join(texts, "node")
    before = Window.partitionBy("bucket").orderBy("node").rowsBetween(Window.unboundedPreceding, 0)
    size = F.length("text") + DOCUMENT_CHARS
    rows = rows.withColumn("block", F.floor(F.sum(size).over(before) / BLOCK_CHARS).cast("int"))
    path = scratch_path(spark, "open-buckets")
    rows.write.parquet(path)
    rows = spark.read.parquet(path)
    last = rows.groupBy("bucket").agg(F.max("block").alias("last"))
    met = rows.join(last, "bucket").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("last"))))
    met = met.select(
        "bucket", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
        "node", "label", "outside", "text",
    )
    shared = spark.sparkContext.broadcast(weights)

    def compare(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        outside = np.flatnonzero(group.column("outside").to_numpy(zero_copy_only=False))
        pairs = np.zeros((0, 2), int)
        if len(outside):
            found = Shingles(group.column("text").chunk(0))
            idf = shared.value.of(found.values, np.ones(len(found.values)))
            common = _common(found, idf, outside, group.num_rows)
            total = np.bincount(found.doc, idf * (1 + np.log(found.times)), group.num_rows)
            near = common >= least * (total[outside][:, None] + total[None, :] - common) - 1e-9
            label = group.column("label").chunk(0).dictionary_encode().indices.to_numpy()
            a, b = np.nonzero(near & (label[outside][:, None] != label[None, :]))
            pairs = np.column_stack([outside[a], b])
            _, one = np.unique(np.sort(label[pairs], axis=1), axis=0, return_index=True)
            pairs = pairs[one]
        node = group.column("node")
        return pa.table({"a": node.take(pa.array(pairs[:, 0])), "b": node.take(pa.array(pairs[:, 1]))})

    return met.groupBy("bucket", "i", "j").applyInArrow(compare, "a binary, b binary")


def classes(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", least: float = SIMILARITY) -> DataFrame:
    """(doc, key, class_id, lead) for every row of ``docs``.

    Two rows are linked if they have the same words in the same order, or if they share a band and
    have a weighted Jaccard similarity of ``least`` or more; classes are the connected components.
    ``class_id`` is the smallest id of the class. ``key`` is a hash of id and text, ``lead`` the
    (id, key) of the class's first row. A null or wordless text is alone in its class, unless the
    same row is repeated. Null ids come first, so a class that has one is named null.

    Every document of a bucket is compared with the bucket's smallest one, then documents that are
    still in different components of a bucket with each other, in blocks. No bucket is cut short.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col(f"`{doc_id}`").alias("doc"),
        F.xxhash64(F.col(f"`{doc_id}`"), F.col(f"`{text}`")).alias("key"),
        F.col(f"`{text}`").cast("string").alias("text"),
    )
    weights = idf_weights(rows)
    path = scratch_path(spark, "signatures")
    signatures(rows, weights).write.parquet(path)
    signed = spark.read.parquet(path)
    nodes = signed.filter("node is not null").groupBy("node").agg(F.min(F.struct("key", "bands")).alias("of"))
    members = nodes.select("node", F.col("of.key").alias("key"), F.explode("of.bands").alias("bucket"))
    shared = members.groupBy("bucket").agg(F.min("node").alias("a"), F.count("*").alias("size")).filter("size > 1")
    path = scratch_path(spark, "buckets")
    members.join(shared.select("bucket", "a"), "bucket").write.parquet(path)
    members = spark.read.parquet(path)

    texts_path = scratch_path(spark, "candidate-texts")
    chosen = members.select("node", "key").distinct()
    chosen.join(rows.select("key", "text"), "key").dropDuplicates(["node"]).select("node", "text").write.parquet(texts_path)
    texts = spark.read.parquet(texts_path)

    done_path = scratch_path(spark, "links")
    star = members.filter("a <> node").select("a", F.col("node").alias("b")).distinct()
    verify(star, texts, weights, least).write.parquet(done_path)
    links = spark.read.schema("a binary, b binary").parquet(done_path)
    more = _open_links(members, links, texts, weights, least)
    more.write.mode("append").parquet(done_path)
    labels = components(spark.read.schema("a binary, b binary").parquet(done_path))

    placed = signed.select("doc", "key", "node").join(labels, "node", "left")
    own = F.concat(F.lit(b"-"), F.col("key").cast("string").cast("binary"))
    placed = placed.select("doc", "key", F.coalesce("label", "node", own).alias("label"))
    lead = placed.groupBy("label").agg(F.min(F.struct("doc", "key")).alias("lead"))
    return placed.join(lead, "label").select("doc", "key", F.col("lead.doc").alias("class_id"), "lead")


def dedup(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", least: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` with one row of each class left: that of the smallest id.

    Of rows repeated with the same id and text one is left, whichever.
    """
    found = classes(docs, text, doc_id, least).filter("key = lead.key and doc <=> lead.doc")
    kept = found.groupBy(F.col("key").alias("__key")).agg(F.count("*").alias("__n"))
    keyed = docs.withColumn("__key", F.xxhash64(F.col(f"`{doc_id}`"), F.col(f"`{text}`")))
    joined = keyed.join(kept, "__key")
    once = joined.filter("__n = 1")
    more = joined.filter("__n > 1").dropDuplicates(["__key"])
    return once.union(more).drop("__key", "__n")
