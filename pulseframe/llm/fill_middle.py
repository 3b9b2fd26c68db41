"""Fill-in-middle: texts whose middle part is moved to the end, assembled by a secondary sort.

A text is cut into units, and its parts into pieces of some units. Every piece carries its document
and its position in the output. One shuffle deals the pieces out by document and sorts them by
position inside the tasks (``repartition`` and ``sortWithinPartitions``, the frame's form of
``repartitionAndSortWithinPartitions``), so an output is a stream of pieces: it is hashed, or put
together, as they come, whatever the lengths of the texts. For the way back the pieces are
labelled by the marks met in that stream and sorted again in the same task, without a second shuffle.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseframe.llm.words import blocks

# The marks before prefix, suffix and middle, white space, and what the digest of an id begins with.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SPACE = b" \t\n\x0b\x0c\r"
SEED = 42
# Per cent of the texts that are changed, and of those the ones whose suffix comes first.
RATE = 50
SPM_RATE = 80

# A piece holds the units that end within so many bytes; a longer unit is a piece by itself.
PIECE_BYTES = 8192
# Order of the parts in a text.
_PART = {PREFIX: 0, MIDDLE: 1, SUFFIX: 2}
_FORM = {"psm": (PREFIX, SUFFIX, MIDDLE), "spm": (SUFFIX, PREFIX, MIDDLE)}

KEY = ("copy", "task", "nth")
FACTS = ("n", "form", "prefix_chars", "middle_chars")
_KEY_DDL = "copy long, task int, nth int"
_FACTS_DDL = "n long, form string, prefix_chars long, middle_chars long"

_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACE)] = True


class Units:
    """Ends of the units of a block of texts, in bytes.

    A unit is a run of other characters with the white space before it; white space that ends a text
    is one unit more. ``first[d]`` and ``first[d + 1]`` bound the units of text ``d`` in ``ends``.
    """

    def __init__(self, texts: pa.Array) -> None:
        texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
        self.texts = texts.to_pylist()
        sizes = np.array([len(t) for t in self.texts], np.int64)
        self.offsets = np.concatenate([[0], np.cumsum(sizes)])
        data = np.frombuffer(b"".join(self.texts), np.uint8)
        goes_on = np.zeros(len(data), bool)
        goes_on[:-1] = ~_IS_SPACE[data[1:]]
        lasts = self.offsets[1:][sizes > 0] - 1
        goes_on[lasts] = False
        is_end = ~_IS_SPACE[data] & ~goes_on
        is_end[lasts] = True
        self.ends = np.flatnonzero(is_end) + 1
        self.first = np.searchsorted(self.ends, self.offsets, side="right")
        # characters before each byte
        self.chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])

    def cut(self, d: int, unit: int) -> int:
        """Byte of the block after so many units of text ``d``."""
        return int(self.ends[self.first[d] + unit - 1]) if unit else int(self.offsets[d])

    def pieces(self, d: int, start: int, stop: int) -> Iterator[bytes]:
        """Units start .. stop-1 of text ``d``, some at a time; one empty piece for none."""
        begin, text, base = self.cut(d, start), self.texts[d], int(self.offsets[d])
        ends = self.ends[self.first[d] + start : self.first[d] + stop]
        window = (ends - begin - 1) // PIECE_BYTES
        last = np.append(window[1:] != window[:-1], True) if len(ends) else []
        for end in ends[last].tolist() if len(ends) else [begin]:
            yield text[begin - base : end - base]
            begin = end


def choice(doc_id: str | None, n: int, text: bytes, rate: int, spm_rate: int, seed: int) -> tuple[str, int, int]:
    """Form of a text of ``n`` units, and the units before its middle and up to its end.

    A null id counts as an empty one.
    """
    digest = hashlib.sha256(f"{seed}:{doc_id or ''}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(m in text for m in _PART) or h[2] % 100 >= rate:
        return "plain", a, b
    return ("spm" if h[3] % 100 < spm_rate else "psm"), a, b


def output_pieces(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", rate: int = RATE, spm_rate: int = SPM_RATE,
    seed: int = SEED,
) -> DataFrame:
    """Pieces of the outputs: (doc_id, copy, task, nth, n, form, prefix_chars, middle_chars, position, piece).

    The first piece of a part begins with the part's mark. ``copy``, ``task`` and ``nth`` name a row
    of ``docs``: a hash of id and text, the task that read it, and how many rows with
    that hash the task had read before. Another order of the rows, as a repeated task may see
    it, gives the same pieces.
    """
    rows = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"),
        F.col(f"`{doc_id}`").cast("string").alias("name"),
        F.xxhash64(F.col(f"`{doc_id}`"), F.col(f"`{text}`")).alias("copy"),
        F.col(f"`{text}`").cast("string").alias("text"),
    )
    kind = rows.schema["doc_id"].dataType.simpleString()

    def emit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, seen = TaskContext.get().partitionId(), Counter()
        for block in blocks(batches, "text"):
            units = Units(block.column("text"))
            copies, names = block.column("copy").to_pylist(), block.column("name").to_pylist()
            at, facts, nths, positions, found = [], [], [], [], []
            for d, raw in enumerate(units.texts):
                n = int(units.first[d + 1] - units.first[d])
                form, a, b = choice(names[d], n, raw, rate, spm_rate, seed)
                bounds = {PREFIX: (0, a), MIDDLE: (a, b), SUFFIX: (b, n)}
                fact = (n, form, None, None)
                if form != "plain":
                    edges = [int(units.chars[units.cut(d, k)]) for k in (0, a, b)]
                    fact = (n, form, edges[1] - edges[0], edges[2] - edges[1])
                position = 0
                for mark in _FORM.get(form, (b"",)):
                    for k, piece in enumerate(units.pieces(d, *bounds.get(mark, (0, n)))):
                        found.append(mark + piece if k == 0 else piece)
                        positions.append(position)
                        position += 1
                at.extend([d] * position)
                facts.extend([fact] * position)
                nths.extend([seen[copies[d]]] * position)
                seen[copies[d]] += 1
            rows_of = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    block.column("doc_id").take(rows_of), block.column("copy").take(rows_of),
                    pa.array([task] * len(at), pa.int32()), pa.array(nths, pa.int32()),
                    *_fact_arrays(facts), pa.array(positions, pa.int32()), pa.array(found, pa.binary()),
                ],
                names=["doc_id", *KEY, *FACTS, "position", "piece"],
            )

    return rows.mapInArrow(emit, f"doc_id {kind}, {_KEY_DDL}, {_FACTS_DDL}, position int, piece binary")


def _fact_arrays(facts: list[tuple]) -> list[pa.Array]:
    columns = list(zip(*facts, strict=True)) if facts else [()] * 4
    kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64())
    return [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]


def arranged(pieces: DataFrame) -> DataFrame:
    """The pieces, each document's in one task and in the order of its output."""
    return pieces.repartition(*KEY).sortWithinPartitions(*KEY, "position")


def _groups(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, int, bool, bytes]]:
    """(batch, row, first of its document, piece) of a sorted stream, across batches."""
    before = None
    for batch in batches:
        keys = list(zip(*[batch.column(k).to_pylist() for k in KEY], strict=True))
        pieces = batch.column("piece")
        for i, key in enumerate(keys):
            yield batch, i, key != before, pieces[i].as_py()
            before = key


def _take(parts: list[tuple[pa.RecordBatch, list[int]]], names: tuple[str, ...]) -> list[pa.Array]:
    """Columns of some rows of several batches."""
    rows = [batch.select(list(names)).take(pa.array(i, pa.int64())) for batch, i in parts]
    table = pa.Table.from_batches(rows).combine_chunks()
    return [table.column(n).combine_chunks() for n in names]


def _as_chunks(rows: Iterable[tuple], limit: int = 1_000_000) -> Iterator[list[tuple]]:
    """Lists of rows (batch, row number, bytes, ..) of about ``limit`` bytes."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[2]) + 100
        if size >= limit:
            yield held
            held, size = [], 0
    if held:
        yield held


def _by_batch(rows: list[tuple]) -> list[tuple[pa.RecordBatch, list[int]]]:
    parts: list[tuple[pa.RecordBatch, list[int]]] = []
    for batch, i, *_ in rows:
        if not parts or parts[-1][0] is not batch:
            parts.append((batch, []))
        parts[-1][1].append(i)
    return parts


def outputs(pieces: DataFrame) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output): the texts that arranged pieces make."""
    kind = pieces.schema["doc_id"].dataType.simpleString()
    names = ("doc_id", *FACTS)

    def texts(batches):
        at, held = None, []
        for batch, i, new, piece in _groups(batches):
            if new and at:
                yield (*at, b"".join(held))
            if new:
                at, held = (batch, i), []
            held.append(piece)
        if at:
            yield (*at, b"".join(held))

    def assemble(batches):
        for rows in _as_chunks(texts(batches)):
            texts_ = pa.array([r[2] for r in rows], pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([*_take(_by_batch(rows), names), texts_], names=[*names, "output"])

    return arranged(pieces).mapInArrow(assemble, f"doc_id {kind}, {_FACTS_DDL}, output string")


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made of."""
    p, s, m = (F.instr(output, mark.decode()) for mark in (PREFIX, SUFFIX, MIDDLE))
    between = lambda a, b: F.substr(output, a + 3, b - a - 3)
    middle = F.substr(output, m + 3)
    psm = F.concat(between(p, s), middle, between(s, m))
    spm = F.concat(between(p, m), middle, between(s, p))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def digests(pieces: DataFrame) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256), a row per document.

    The first pass hashes each output and labels its pieces by the last mark in the output before
    them; the second one reads them by part and position, without marks, and hashes again.
    """
    kind = pieces.schema["doc_id"].dataType.simpleString()
    names = ("doc_id", *KEY, *FACTS)
    schema = f"doc_id {kind}, {_KEY_DDL}, {_FACTS_DDL}, part int, position int, piece binary, output_sha256 string"

    def labelled(batches):
        """(batch, row, piece, part, position, digest); a row with the digest follows each document's pieces."""
        sha, part, position, at = None, 0, 0, None
        for batch, i, new, piece in _groups(batches):
            if new:
                if at:
                    yield (*at, b"", len(_PART), position, sha.hexdigest())
                sha, part, position = hashlib.sha256(), 0, 0
                plain = batch.column("form")[i].as_py() == "plain"
            at = (batch, i)
            sha.update(piece)
            mark = piece[: len(PREFIX)]
            if not plain and mark in _PART:
                part, piece = _PART[mark], piece[len(mark) :]
            yield batch, i, piece, part, position, None
            position += 1
        if at:
            yield (*at, b"", len(_PART), position, sha.hexdigest())

    def label(batches):
        for rows in _as_chunks(labelled(batches)):
            yield pa.RecordBatch.from_arrays(
                [
                    *_take(_by_batch(rows), names), pa.array([r[3] for r in rows], pa.int32()),
                    pa.array([r[4] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.binary()),
                    pa.array([r[5] for r in rows], pa.string()),
                ],
                names=[*names, "part", "position", "piece", "output_sha256"],
            )

    def rebuilt(batches):
        sha = None
        for batch, i, new, piece in _groups(batches):
            if new:
                sha = hashlib.sha256()
            if batch.column("part")[i].as_py() == len(_PART):
                yield batch, i, b"", sha.hexdigest()
            else:
                sha.update(piece)

    def rebuild(batches):
        wanted = ("doc_id", *FACTS, "output_sha256")
        for rows in _as_chunks(rebuilt(batches)):
            found = pa.array([r[3] for r in rows], pa.string())
            yield pa.RecordBatch.from_arrays([*_take(_by_batch(rows), wanted), found], names=[*wanted, "restored_sha256"])

    streamed = arranged(pieces).mapInArrow(label, schema)
    again = streamed.sortWithinPartitions(*KEY, "part", "position")
    return again.mapInArrow(rebuild, f"doc_id {kind}, {_FACTS_DDL}, output_sha256 string, restored_sha256 string")


def fill_middle(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", **rates: int) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) for every row of ``docs``.

    A text of ``n`` units (white space with what follows it) is split before and after its middle at
    two places drawn from a digest of the id. ``form`` is ``psm``, ``spm`` (suffix first) or
    ``plain``, where the output is the text: half of the texts, empty ones, and
    those that contain a mark. A null text counts as empty, a null id as an empty one. Repeated rows
    are rows of their own with the same result. Other columns are left out, whatever their
    names; an empty table gives no rows.
    """
    return outputs(output_pieces(docs, text, doc_id, **rates))
