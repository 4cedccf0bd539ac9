"""Fill-in-middle documents, put together by a secondary sort of their pieces.

A document is cut into units and these into a prefix, a middle and a suffix, whose chunks leave as pieces keyed by the
document and their position in the output.  One repartition by document and a sort within partitions bring the pieces in
output order, so output texts stream into incremental digests (or out again, as pieces) and no document is put together
in memory.  Restoring needs the parts in another order: the streamed output is cut at its own sentinels, the same
partitions are sorted again by original position, and the text streams into a second digest.  Text crosses one exchange.

Rows that are equal in id and text have equal pieces; they travel as often as they stand, are streamed once and counted.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldbook.llm import textbytes as tb

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
#: bytes of text for each task of the exchange
TASK_BYTES = 64 << 20

_SECTION = {PREFIX: 0, MIDDLE: 1, SUFFIX: 2}
_KEY = ["doc_id", "text_hash"]
_FACTS = ["n", "form", "prefix_chars", "middle_chars"]
_PIECES = "doc_id long, text_hash long, pos int, n long, form string, prefix_chars long, middle_chars long, piece binary"
_STREAMED = "doc_id long, text_hash long, section int, pos int, copies long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, piece binary"


@dataclass(frozen=True)
class Settings:
    """Of 100 documents ``transformed`` are cut, of 100 of these ``suffix_first`` lead with the suffix.

    A piece has at most ``chunk`` bytes of text (at least 4); it ends between code points.
    """

    transformed: int = 90
    suffix_first: int = 20
    seed: int = 1
    chunk: int = 64 << 10


def draws(doc_id: Column, seed: int) -> list[Column]:
    """Four numbers below 2**32 from the digest of ``seed:doc_id``; a null id counts as an empty one."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]


def unit_starts(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Places where units begin: runs of A-Z and a-z, and every other code point by itself."""
    low = data | 0x20
    letter = (low >= ord("a")) & (low <= ord("z"))
    after = np.zeros(len(data), dtype=bool)
    after[1:] = letter[:-1]
    edges = offs[:-1]
    after[edges[edges < len(data)]] = False
    return np.flatnonzero(np.where(letter, ~after, (data & 0xC0) != 0x80))


def _cuts(data: np.ndarray, lo: int, hi: int, chunk: int) -> list[int]:
    """Ends of the chunks of ``data[lo:hi]``, none inside a code point."""
    ends = []
    while hi - lo > chunk:
        end = lo + chunk
        while data[end] & 0xC0 == 0x80:
            end -= 1
        ends.append(lo := end)
    return [*ends, hi]


def _pieces(settings: Settings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tb.chunks(batches, "text"):
            rows = batch.num_rows
            text = pc.fill_null(batch.column("text"), "")
            data, offs = tb.text_buffer(text)
            starts = unit_starts(data, offs)
            first = np.searchsorted(starts, offs)
            n = np.diff(first)
            points = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
            h = [batch.column(f"h{i}").to_numpy() for i in range(1, 5)]
            a, b = h[0] % (n + 1), h[1] % (n + 1)
            marked = np.zeros(rows, dtype=bool)
            for mark in _SECTION:
                marked |= pc.match_substring(text, mark.decode()).to_numpy(zero_copy_only=False)
            plain = (n == 0) | marked | (h[2] % 100 >= settings.transformed)
            spm = h[3] % 100 < settings.suffix_first
            padded = np.concatenate((starts, [len(data)]))

            def cut(units: np.ndarray) -> np.ndarray:
                return np.where(units < n, padded[np.minimum(first[:-1] + units, len(starts))], offs[1:])

            p, m = cut(np.minimum(a, b)), cut(np.maximum(a, b))
            raw = data.tobytes()
            at, pos, piece = [], [], []
            for row, (lo, p_end, m_end, hi, is_plain, is_spm) in enumerate(zip(offs[:-1].tolist(), p.tolist(), m.tolist(), offs[1:].tolist(), plain.tolist(), spm.tolist(), strict=True)):
                parts = {PREFIX: (lo, p_end), MIDDLE: (p_end, m_end), SUFFIX: (m_end, hi)}
                order = (b"",) if is_plain else (SUFFIX, PREFIX, MIDDLE) if is_spm else (PREFIX, SUFFIX, MIDDLE)
                k = 0
                for mark in order:
                    start, stop = parts.get(mark, (lo, hi))
                    for end in _cuts(data, start, stop, settings.chunk):
                        at.append(row)
                        pos.append(k)
                        piece.append(mark + raw[start:end])
                        start, mark, k = end, b"", k + 1
            at = np.array(at, dtype=np.int64)
            form = np.where(plain, "plain", np.where(spm, "spm", "psm")).astype(object)
            columns = {
                "doc_id": batch.column("doc_id").take(pa.array(at)),
                "text_hash": batch.column("text_hash").take(pa.array(at)),
                "pos": pa.array(pos, pa.int32()),
                "n": pa.array(n[at], pa.int64()),
                "form": pa.array(form[at], pa.string()),
                "prefix_chars": pa.array((points[p] - points[offs[:-1]])[at], pa.int64(), mask=plain[at]),
                "middle_chars": pa.array((points[m] - points[p])[at], pa.int64(), mask=plain[at]),
                "piece": pa.array(piece, pa.binary()),
            }
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return run


def _record(rows: list[tuple], fields: list[pa.Field]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in fields]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, fields, strict=True)], [f.name for f in fields])


_L, _I, _S, _B = pa.int64(), pa.int32(), pa.string(), pa.binary()
_STREAMED_FIELDS = [pa.field(*f) for f in (("doc_id", _L), ("text_hash", _L), ("section", _I), ("pos", _I), ("copies", _L), ("n", _L), ("form", _S), ("prefix_chars", _L), ("middle_chars", _L), ("output_sha256", _S), ("piece", _B))]
_RESULT_FIELDS = [pa.field(*f) for f in (("doc_id", _L), ("n", _L), ("form", _S), ("prefix_chars", _L), ("middle_chars", _L), ("output_sha256", _S), ("restored_sha256", _S))]


def _output(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of pieces in output order: the same without sentinels, told by the sentinels which part they are of, and after a
    document's last piece one row (section 3) with its facts and the digest of its output.  Memory: one batch."""
    key = digest = facts = None
    section, last, copies = 0, -1, 0

    def closed() -> list[tuple]:
        return [] if key is None else [(*key, 3, 0, copies, *facts, digest.hexdigest(), None)]

    for batch in batches:
        out: list[tuple] = []
        columns = [batch.column(c).to_pylist() for c in ("doc_id", "text_hash", "pos", *_FACTS, "piece")]
        for doc, h, pos, n, form, prefix, middle, piece in zip(*columns, strict=True):
            if (doc, h) != key:
                out += closed()
                key, digest, facts = (doc, h), hashlib.sha256(), (n, form, prefix, middle)
                section, last, copies = 0, -1, 0
            if pos == 0:
                copies += 1
            if pos == last:
                continue  # the same piece of an equal row
            last = pos
            digest.update(piece)
            if form != "plain" and piece[:3] in _SECTION:
                section, piece = _SECTION[piece[:3]], piece[3:]
            if piece:
                out.append((doc, h, section, pos, None, None, None, None, None, None, piece))
        yield _record(out, _STREAMED_FIELDS)
    yield _record(closed(), _STREAMED_FIELDS)


def _restored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of the parts in their original order: one row for each copy of a document, with both digests.  Memory: one batch."""
    digest = hashlib.sha256()
    for batch in batches:
        out: list[tuple] = []
        columns = [batch.column(c).to_pylist() for c in ("doc_id", "section", "copies", *_FACTS, "output_sha256", "piece")]
        for doc, section, copies, n, form, prefix, middle, sha, piece in zip(*columns, strict=True):
            if section < 3:
                digest.update(piece)
                continue
            out += [(doc, n, form, prefix, middle, sha, digest.hexdigest())] * copies
            digest = hashlib.sha256()
        yield _record(out, _RESULT_FIELDS)


def output_pieces(docs: DataFrame, settings: Settings | None = None) -> DataFrame:
    """The outputs themselves: ``doc_id, text_hash, pos, n, form, prefix_chars, middle_chars, piece``.

    The pieces (UTF-8 bytes, at most ``chunk`` and a sentinel) of a document, in order of ``pos`` within its partition,
    are its output; partitions hold whole documents.  Rows equal in id and text have their pieces as often as they stand.
    """
    s = settings or Settings()
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // TASK_BYTES))
    doc = F.col("doc_id").cast("long")
    rows = docs.select(doc.alias("doc_id"), "text", F.xxhash64("text").alias("text_hash"), *[h.alias(f"h{i}") for i, h in enumerate(draws(doc, s.seed), 1)])
    return rows.mapInArrow(_pieces(s), _PIECES).repartition(tasks, *_KEY).sortWithinPartitions(*_KEY, "pos")


def fill_in_middle(docs: DataFrame, settings: Settings | None = None) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256`` for each row of ``docs(doc_id, text)``.

    Units are runs of English letters and single other code points; ``n`` counts them.  The numbers drawn from the id
    choose the cuts and the form: ``plain`` (the text itself: also texts that are empty or hold a sentinel), ``psm`` or
    ``spm``.  A null text counts as empty and a null id as an empty one; repeated rows come out as often as they stand,
    ids with several texts once for each; other columns are ignored; an empty table gives an empty table.  Digests are
    of UTF-8 bytes; the restored text is read back from the output, not from the input.
    """
    streamed = output_pieces(docs, settings).mapInArrow(_output, _STREAMED)
    again = streamed.sortWithinPartitions(*_KEY, "section", "pos")
    return again.mapInArrow(_restored, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string")
