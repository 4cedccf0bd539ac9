"""Byte-level BPE over a corpus: every distinct pre-token is encoded once.

Texts are cut into pre-tokens; each block of text (a slice of one input partition) sends each of its distinct
pre-tokens once to the task that owns the pre-token's bucket, which encodes it once for all blocks and sends the ids
back.  The block's texts meet its dictionary there, are cut again and put together by position.  So what is shuffled is
compressed text and one entry for each pre-token and block, not one for each occurrence: a word that is a third of all
occurrences is one entry a block.  Both travel as compressed Arrow batches, a row for each block and bucket.

Blocks are numbered by partition and place in it.  Should a recomputed partition arrive in another order, a pre-token
can be missing from its block's dictionary; it is then encoded on the spot, so the result does not depend on it.
"""

from __future__ import annotations

import base64
import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldbook.llm import blocks

#: pieces longer than this are merged with a heap
LONG_PIECE = 64

_COLUMNS = "block long, seq int, blob binary"
_cache: dict[str, object] = {}


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and their ids from a file with a base64 token and a rank a line; read on the driver."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines) if token}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: of all neighbours the pair with the least rank (the first of equal ones) joins, until none has one."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    if len(piece) > LONG_PIECE:
        return _merge_long(piece, ranks)
    parts = [piece[i : i + 1] for i in range(len(piece))]
    none = len(ranks) + 1
    pairs = [ranks.get(piece[i : i + 2], none) for i in range(len(piece) - 1)]
    while pairs:
        best = min(pairs)
        if best == none:
            break
        at = pairs.index(best)
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
        del pairs[at]
        if at:
            pairs[at - 1] = ranks.get(parts[at - 1] + parts[at], none)
        if at < len(pairs):
            pairs[at] = ranks.get(parts[at] + parts[at + 1], none)
    return [ranks[p] for p in parts]


def _merge_long(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    n = len(piece)
    end, nxt, prev = list(range(1, n + 1)), list(range(1, n + 1)), list(range(-1, n - 1))
    alive = [True] * n
    heap: list[tuple[int, int, int]] = []

    def offer(i: int) -> None:
        if i >= 0 and nxt[i] < n and (rank := ranks.get(piece[i : end[nxt[i]]])) is not None:
            heapq.heappush(heap, (rank, i, end[nxt[i]]))

    for i in range(n - 1):
        offer(i)
    while heap:
        _, i, upto = heapq.heappop(heap)
        if not alive[i] or nxt[i] >= n or end[nxt[i]] != upto:
            continue
        j = nxt[i]
        alive[j] = False
        end[i], nxt[i] = end[j], nxt[j]
        if nxt[i] < n:
            prev[nxt[i]] = i
        offer(prev[i])
        offer(i)
    return [ranks[piece[i : end[i]]] for i in range(n) if alive[i]]


def _cutter(pattern: str):
    import regex

    if pattern not in _cache:
        _cache[pattern] = regex.compile(pattern).findall
    return _cache[pattern]


def _pieces(pattern: str, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        findall, now, seen = _cutter(pattern), None, set()

        def rows() -> Iterator[pa.RecordBatch]:
            dealt: dict[int, list[str]] = {}
            for piece in sorted(seen):
                dealt.setdefault(zlib.crc32(piece.encode()) % buckets, []).append(piece)
            for bucket, own in dealt.items():
                blob = blocks.pack(pa.RecordBatch.from_arrays([pa.array(own, pa.string())], ["piece"]))
                yield pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), pa.array([now], pa.int64()), pa.array([blob], pa.binary())], ["bucket", "block", "blob"])

        for block, _, batch in blocks.numbered(batches):
            if block != now:
                yield from rows()
                now, seen = block, set()
            for text in batch.column("text").to_pylist():
                if text:
                    seen.update(findall(text))
        yield from rows()

    return run


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block, seq, batch in blocks.numbered(batches):
        blob = blocks.pack(batch.select(["doc_id", "text"]))
        yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([seq], pa.int32()), pa.array([blob], pa.binary())], ["block", "seq", "blob"])


class _Dictionary(dict):
    """Ids of pre-tokens, worked out when first asked for."""

    def __init__(self, table: dict[bytes, int]):
        super().__init__()
        self.table = table

    def __missing__(self, piece: str) -> bytes:
        ids = self[piece] = np.array(merge(piece.encode(), self.table), dtype="<i4").tobytes()
        return ids


def _encoded(ranks: Broadcast):
    """Of rows in order of bucket: each block's pre-tokens with their ids.  Holds the distinct pre-tokens of one bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, now, known = ranks.value, None, {}
        for batch in batches:
            for bucket, block, blob in zip(batch.column("bucket").to_pylist(), batch.column("block").to_pylist(), batch.column("blob"), strict=True):
                if bucket != now:
                    now, known = bucket, _Dictionary(table)
                part = blocks.unpack(blob.as_buffer())
                ids = pa.array(list(map(known.__getitem__, part.column("piece").to_pylist())), pa.binary())
                out = blocks.pack(pa.RecordBatch.from_arrays([part.column("piece"), ids], ["piece", "ids"]))
                yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([-1], pa.int32()), pa.array([out], pa.binary())], ["block", "seq", "blob"])

    return run


class _Lexicon:
    """A block's pre-tokens and their ids, as Arrow arrays."""

    def __init__(self) -> None:
        self.parts: list[tuple[pa.Array, pa.Array]] = []

    def add(self, pieces: pa.Array, ids: pa.Array) -> None:
        self.parts.append((pieces, ids))

    def ids(self, pieces: pa.Array, table: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces one after the other, and how many each has."""
        if len(self.parts) != 1:
            kinds = (pa.string(), pa.binary())
            self.parts = [tuple(pa.concat_arrays([pa.array([], k), *(p[i] for p in self.parts)]) for i, k in enumerate(kinds))]
        known, coded = self.parts[0]
        at = pc.index_in(pieces, value_set=known)
        if at.null_count:  # see the module's docstring
            new = pc.unique(pieces.filter(pc.is_null(at)))
            self.add(new, pa.array([np.array(merge(p.encode(), table), dtype="<i4").tobytes() for p in new.to_pylist()], pa.binary()))
            return self.ids(pieces, table)
        offsets = np.frombuffer(coded.buffers()[1], dtype=np.int32)[coded.offset : coded.offset + len(coded) + 1] // 4
        flat = np.frombuffer(coded.buffers()[2] or b"", dtype="<i4")
        at = at.to_numpy()
        size = offsets[at + 1] - offsets[at]
        ends = np.cumsum(size)
        return flat[np.repeat(offsets[at] - (ends - size), size) + np.arange(int(size.sum()))], size


def _assembled(ranks: Broadcast, pattern: str, table: Broadcast | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        findall, now, lexicon = _cutter(pattern), None, _Lexicon()
        for batch in batches:
            for block, texts, lo, hi in blocks.runs(batch):
                if block != now:
                    now, lexicon = block, _Lexicon()
                if not texts:
                    for blob in batch.column("blob")[lo:hi]:
                        part = blocks.unpack(blob.as_buffer())
                        lexicon.add(part.column("piece"), part.column("ids"))
                    continue
                part = blocks.unpack(batch.column("blob")[lo].as_buffer())
                pieces, per_row = [], [0]
                for text in part.column("text").to_pylist():
                    if text:
                        pieces += findall(text)
                    per_row.append(len(pieces))
                ids, size = lexicon.ids(pa.array(pieces, pa.string()), ranks.value)
                offsets = np.concatenate(([0], np.cumsum(size)))[per_row].astype(np.int32)
                columns = {"doc_id": part.column("doc_id"), "ids": pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids))}
                if table is not None:
                    columns["decoded"] = _bytes_of(columns["ids"], table.value)
                yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return run


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, decoded: bool = False) -> DataFrame:
    """``doc_id, ids array<int>`` for each row of ``docs(doc_id, text)``, with ``decoded`` also what ``decode`` makes of them.

    Each match of ``pattern`` is encoded by itself by the ranks; there are no special tokens.  Null and empty text give
    no ids; null and repeated ``doc_id`` stay as they are; empty tables give empty tables; other columns are ignored.
    ``ranks`` is broadcast: a vocabulary is of fixed size.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(ranks)
    texts = docs.select("doc_id", "text", F.spark_partition_id().alias("part"))
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    pieces = texts.mapInArrow(_pieces(pattern, buckets), "bucket int, block long, blob binary")
    words = pieces.repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(_encoded(shared), _COLUMNS)
    packed = texts.mapInArrow(_packed, _COLUMNS)
    meet = packed.union(words).repartition("block").sortWithinPartitions("block", "seq")
    table = spark.sparkContext.broadcast(_token_bytes(ranks)) if decoded else None
    return meet.mapInArrow(_assembled(shared, pattern, table), "doc_id long, ids array<int>" + ", decoded binary" * decoded)


def _token_bytes(ranks: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The token-byte table: all tokens' bytes, and where each id's begin and how many they are."""
    size, start = (np.zeros(max(ranks.values(), default=-1) + 1, dtype=np.int64) for _ in range(2))
    at = 0
    for token, i in ranks.items():
        start[i], size[i] = at, len(token)
        at += len(token)
    return np.frombuffer(b"".join(ranks), dtype=np.uint8), start, size


def _bytes_of(column: pa.ListArray, table: tuple[np.ndarray, np.ndarray, np.ndarray]) -> pa.Array:
    data, start, size = table
    ids = column.flatten().to_numpy()
    if len(ids) and not (0 <= ids.min() and ids.max() < len(size) and size[ids].all()):
        raise ValueError("an id that the vocabulary lacks")
    ends = np.concatenate(([0], np.cumsum(size[ids])))
    per_row = np.concatenate(([0], np.cumsum(pc.fill_null(pc.list_value_length(column), 0).to_numpy())))
    out = data[np.repeat(start[ids] - ends[:-1], size[ids]) + np.arange(ends[-1])]
    return pa.Array.from_buffers(pa.binary(), len(column), [None, pa.py_buffer(ends[per_row].astype(np.int32)), pa.py_buffer(out)])


def _decoded(table: Broadcast, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*(batch.column(x) for x in names), _bytes_of(batch.column("ids"), table.value)], [*names, "decoded"])

    return run


def decode(coded: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """``coded`` (with ``ids``) and a column ``decoded``: the bytes of the ids in order, by a map-side join with the token-byte table.

    Null or no ids give no bytes; an id that the table lacks fails the job.  The table has a vocabulary's fixed size.
    """
    table = coded.sparkSession.sparkContext.broadcast(_token_bytes(ranks))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in coded.schema.fields)
    return coded.mapInArrow(_decoded(table, coded.columns), schema + ", decoded binary")
