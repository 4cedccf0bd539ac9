"""Line dedup: range-partitioned line hashes, streamed in order, answered with keep bitmaps.

Lines travel as 128-bit hashes with document and position, never as text.  They are dealt by range of (hash, document)
and sorted, so each task streams whole runs of equal lines, the document that keeps the line first.  A line that stands
in a third of all documents is cut by the range partitioner into several tasks; the runs at a task's two ends are
therefore only counted there, and settled by a join with the summed counts (two rows a task).
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldbook.llm import textbytes as tb
from fieldbook.session import stage

NEWLINE = 0x0A
_LINE = "h1 long, h2 long, doc_id long, pos int"


def line_spans(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every line; an empty text has one empty line."""
    breaks = np.flatnonzero(data == NEWLINE)
    rows = len(offs) - 1
    starts = np.concatenate((offs[:-1], breaks + 1))
    row = np.concatenate((np.arange(rows), np.searchsorted(offs, breaks, side="right") - 1))
    ends = np.concatenate((breaks, offs[1:]))
    end_row = np.concatenate((np.searchsorted(offs, breaks, side="right") - 1, np.arange(rows)))
    a, b = np.lexsort((starts, row)), np.lexsort((ends, end_row))
    return starts[a], ends[b], row[a]


def _strip(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    solid = np.flatnonzero(~tb.WHITE[data])
    if not len(solid):
        return starts, starts
    lo = np.searchsorted(solid, starts)
    hi = np.searchsorted(solid, ends)
    some = hi > lo
    return np.where(some, solid[np.minimum(lo, len(solid) - 1)], starts), np.where(some, solid[hi - 1] + 1, starts)


def _lines(min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tb.chunks(batches, "text"):
            data, offs = tb.text_buffer(batch.column("text"))
            starts, ends, row = line_spans(data, offs)
            count = np.bincount(row, minlength=batch.num_rows)
            pos = np.arange(len(row)) - (np.cumsum(count) - count)[row]
            starts, ends = _strip(data, starts, ends)
            points = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
            long_ = np.flatnonzero(points[ends] - points[starts] >= min_chars)
            low = tb.LOWER[data]
            h1, h2 = (tb.signed(tb.span_hashes(low, starts[long_], ends[long_], i)) for i in (0, 1))
            ids = batch.column("doc_id").take(pa.array(row[long_]))
            yield pa.RecordBatch.from_arrays([pa.array(h1), pa.array(h2), ids, pa.array(pos[long_].astype(np.int32))], ["h1", "h2", "doc_id", "pos"])

    return run


def _rows(h1, h2, doc, pos, docs) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(h1, pa.int64()), pa.array(h2, pa.int64()), doc, pa.array(pos, pa.int32()), pa.array(docs, pa.int64())], ["h1", "h2", "doc_id", "pos", "docs"])


def _stream(min_docs: int):
    """Of lines in order of hash and falling document, the lines to drop (``docs`` = 0).

    From the ``min_docs``-th document of a run on, every line goes at once.  Lines of the documents before wait until
    the run has that many.  A task's first and last run may go on in another task: of these the waiting lines
    (``docs`` = -1) and one row with the number of documents and the largest one are handed on.  Memory: one batch and
    the waiting lines of one run.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = doc = opening = top = None
        docs, wait = 0, []  # of the current run: documents so far, waiting lines with their rank

        def flag(part: pa.RecordBatch, value: int) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([*part.columns, pa.array(np.full(part.num_rows, value, dtype=np.int64))], ["h1", "h2", "doc_id", "pos", "docs"])

        def undecided(key, count, top, wait) -> Iterator[pa.RecordBatch]:
            for part, _ in wait:
                yield flag(part, -1)
            yield _rows([key[0]], [key[1]], pa.array([top], pa.int64()), [None], [count])

        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            h1, h2 = (batch.column(i).to_numpy() for i in (0, 1))
            ids = batch.column(2).fill_null(np.iinfo(np.int64).min).to_numpy()
            head = np.ones(n, dtype=bool)
            head[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
            head[0] = key != (h1[0], h2[0])
            first = head.copy()
            first[1:] |= ids[1:] != ids[:-1]
            first[0] |= doc != ids[0]
            group, total, heads = np.cumsum(head), np.cumsum(first), np.flatnonzero(head)
            rank = total - np.concatenate(([-docs], total[heads] - 1))[group]
            size = np.zeros(group[-1] + 1, dtype=np.int64)
            np.maximum.at(size, group, rank)
            size[0] = max(size[0], docs)
            opening = opening or (h1[0], h2[0])
            at_start = (h1 == opening[0]) & (h2 == opening[1])
            open_ = (group == group[-1]) | at_start
            drop = np.where(open_, rank >= min_docs, (rank > 1) & (size[group] >= min_docs))
            if drop.any():
                yield flag(batch.filter(pa.array(drop)), 0)
            early = rank < min_docs
            if len(heads) and key is not None:  # the run before this batch has ended
                if key == opening:
                    mine = (group == 0) & early
                    yield from undecided(key, int(size[0]), top, [*wait, (batch.filter(pa.array(mine)), None)])
                elif size[0] >= min_docs:
                    for part, r in wait:
                        yield flag(part.filter(pa.array(r > 1)), 0)
            if len(heads):
                wait = []
                if key is None and group[-1] > 1:  # the task's first run begins and ends here
                    mine = (group == 1) & early
                    yield from undecided(opening, int(size[1]), batch.column(2)[0].as_py(), [(batch.filter(pa.array(mine)), None)])
                top = batch.column(2)[int(heads[-1])].as_py()
            mine = (group == group[-1]) & early
            if mine.any():
                wait.append((batch.filter(pa.array(mine)), rank[mine]))
            key, doc, docs = (h1[-1], h2[-1]), ids[-1], int(rank[-1])
        if key is not None:
            yield from undecided(key, docs, top, wait)

    return run


def _bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for drops, n in zip(batch.column("drops").to_pylist(), batch.column("n_lines").to_pylist(), strict=True):
            keep = np.ones(n, dtype=np.uint8)
            keep[drops] = 0
            out.append(zlib.compress(np.packbits(keep).tobytes(), 6))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_lines"), pa.array([len(x) for x in batch.column("drops").to_pylist()], pa.int64()), pa.array(out, pa.binary())], ["doc_id", "n_lines", "n_dropped", "keep"])


def dropped_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """``doc_id, drops``: ascending positions of the lines that each document loses; documents that lose none are left out."""
    lines = docs.select("doc_id", "text").mapInArrow(_lines(min_chars), _LINE)
    dealt = lines.repartitionByRange("h1", "h2", "doc_id").sortWithinPartitions("h1", "h2", F.col("doc_id").desc_nulls_last(), "pos")
    found = stage(dealt.mapInArrow(_stream(min_docs), _LINE + ", docs long"), "lines")
    counts = found.where("docs > 0").groupBy("h1", "h2").agg(F.sum("docs").alias("n"), F.max("doc_id").alias("top"))
    late = found.where("docs = -1").drop("docs").join(counts.where(F.col("n") >= min_docs), ["h1", "h2"])
    late = late.where("doc_id is null or doc_id < top").select("doc_id", "pos")
    drops = found.where("docs = 0").select("doc_id", "pos").union(late)
    return drops.groupBy("doc_id").agg(F.sort_array(F.collect_set("pos")).alias("drops"))


def keep_bitmaps(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """``doc_id, n_lines, n_dropped, keep`` for the documents of ``docs(doc_id, text)`` that lose lines.

    A line's key is the line without white space at both ends, A-Z lower-cased.  Lines whose key has at least
    ``min_chars`` code points and stands in at least ``min_docs`` documents go, except in the largest ``doc_id``
    holding the key, which keeps all of them.  ``keep`` is the zlib-compressed bitmap of the lines, first line in the
    highest bit, 1 for kept.

    Null or empty text is one empty line and never loses it.  Rows that share a ``doc_id`` are one document, whose
    positions are those of any of its rows (repeated rows give repeated results; different texts under one id are
    outside the contract and lose each other's positions too).  A null ``doc_id`` is one document below all others.
    An empty table gives an empty table; other columns are ignored.
    """
    n = docs.select("doc_id", F.size(F.split(F.coalesce("text", F.lit("")), "\n")).alias("n_lines")).groupBy("doc_id").agg(F.max("n_lines").cast("int").alias("n_lines"))
    drops = dropped_lines(docs, min_chars, min_docs)
    return drops.join(n, drops.doc_id.eqNullSafe(n.doc_id)).select(drops.doc_id, "n_lines", "drops").mapInArrow(_bitmaps, "doc_id long, n_lines int, n_dropped long, keep binary")


def _left(text: str | None, keep: bytes | None) -> tuple[int, list[str]]:
    lines = (text or "").split("\n")
    if keep is None:
        return len(lines), lines
    bits = np.unpackbits(np.frombuffer(zlib.decompress(keep), dtype=np.uint8), count=len(lines))
    return len(lines), [x for x, b in zip(lines, bits.tolist(), strict=True) if b]


def _kept(names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tb.chunks(batches, "text"):
            texts = batch.column("text").to_pylist()
            found = [_left(t, k) for t, k in zip(texts, batch.column("keep").to_pylist(), strict=True)]
            n, left = np.array([f[0] for f in found], dtype=np.int64), np.array([len(f[1]) for f in found], dtype=np.int64)
            text = pa.array([t if t is None else "\n".join(f[1]) for t, f in zip(texts, found, strict=True)], pa.string())
            yield pa.RecordBatch.from_arrays([*(batch.column(x) for x in names), pa.array(n), pa.array(n - left), text], [*names, "n_lines", "n_dropped", "kept_text"])

    return run


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """``docs`` with ``n_lines, n_dropped, kept_text``: the lines each bitmap keeps, all where there is none; null stays null.

    Columns of ``docs`` with these names, or named ``keep``, are replaced or dropped.
    """
    names = [c for c in docs.columns if c not in ("n_lines", "n_dropped", "kept_text", "keep")]
    marks = bitmaps.select(F.col("doc_id").alias("_marked"), "keep")
    rows = docs.select(*names)
    both = rows.join(marks, rows["doc_id"].eqNullSafe(F.col("_marked")), "left").drop("_marked")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return both.mapInArrow(_kept(names), schema + ", n_lines long, n_dropped long, kept_text string")
