"""Alignment of two tokenizers over a corpus: token groups, linked id pairs and how many documents hold each pair.

Token ends cut a text into pieces that belong to one token of A and one of B each; such a piece is a link.  An array from
each A id to the B id of the same bytes makes most links cheap: a pair of that map is told by its A id alone, so its
documents are counted in a vector as long as A's vocabulary, one vector a task.  Only pairs beside the map are keyed, and
each once for a block of texts with the number of documents of the block that hold it; what is shuffled grows with
blocks times distinct irregular pairs, not with tokens.  A pair's corpus-wide count goes back to the blocks that hold it
by the same keys, and documents, which were written once as compressed lists of their distinct pairs, look it up there.
So each text is encoded once, and a pair held by a third of all documents is one row a block.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldbook.llm import blocks
from fieldbook.llm import textbytes as tb
from fieldbook.session import stage

#: a run of white space beyond this is more than the fast encoder of A takes
LONG_WHITE = 100_000
#: compressed rows of texts (1 MB of text each) for each task of the last step
ROWS_PER_TASK = 32

_NUMBERS = "n_a long, n_b long, n_groups long, n_links long"
_cache: dict[bytes, object] = {}


@dataclass(frozen=True)
class Tokenizers:
    """The files of both tokenizers and what follows from them; of a vocabulary's size, so it can be broadcast."""

    a_json: str
    b_model: bytes
    a_bytes: list[bytes]
    b_bytes: list[bytes]
    same: np.ndarray  # of each A id the B id of the same bytes, or -1

    @property
    def key(self) -> bytes:
        return hashlib.sha256(self.a_json.encode() + self.b_model).digest()


def _byte_letters() -> dict[str, int]:
    """The letter that byte-level vocabularies write for each byte: itself where it can be seen, else one from 256 on."""
    seen = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    unseen = [b for b in range(256) if b not in set(seen)]
    return {chr(b): b for b in seen} | {chr(256 + n): b for n, b in enumerate(unseen)}


def load(a_path: str, b_path: str) -> Tokenizers:
    """Both tokenizers from their files; read on the driver."""
    import sentencepiece

    with open(a_path, encoding="utf-8") as f:
        a_json = f.read()
    with open(b_path, "rb") as f:
        b_model = f.read()
    letters, vocabulary = _byte_letters(), json.loads(a_json)["model"]["vocab"]
    a_bytes = [b""] * (max(vocabulary.values(), default=-1) + 1)
    for token, i in vocabulary.items():
        a_bytes[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
    b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
    b_bytes, plain = [], {}
    for i in range(b.get_piece_size()):
        piece = b.id_to_piece(i)
        if b.is_byte(i):
            b_bytes.append(bytes([int(piece[3:5], 16)]))
        else:
            b_bytes.append(piece.replace("▁", " ").encode())
            if not (b.is_control(i) or b.is_unknown(i)):
                plain.setdefault(b_bytes[-1], i)
    for i, raw in enumerate(b_bytes):
        if b.is_byte(i):  # only where no piece is spelled so
            plain.setdefault(raw, i)
    return Tokenizers(a_json, b_model, a_bytes, b_bytes, np.array([plain.get(x, -1) if x else -1 for x in a_bytes], dtype=np.int64))


def _encoder_a(t: Tokenizers) -> Callable[[list[str]], list[np.ndarray]]:
    """Ids of texts by A's file.

    A plain byte-level BPE file (merges in order of ids, the public split pattern, no normalisation) runs on the faster
    library; texts with very long white space, and any other file, on the file's own.
    """
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    own = Tokenizer.from_str(t.a_json)
    own.encode_special_tokens = True
    slow = lambda texts: [np.array(e.ids, dtype=np.int64) for e in own.encode_batch_fast(texts, add_special_tokens=False)]
    spec = json.loads(t.a_json)
    model, pre = spec["model"], spec["pre_tokenizer"] or {}
    vocabulary, special = model["vocab"], {x["content"] for x in spec["added_tokens"]}
    merged = ["".join(m) if not isinstance(m, str) else m.replace(" ", "") for m in model["merges"]]
    order = [vocabulary.get(m, -1) for m in merged]
    singles = sorted(vocabulary[c] for c in _byte_letters() if c in vocabulary)
    plain = (
        model["type"] == "BPE"
        and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
        and spec["normalizer"] is None
        and pre.get("type") == "ByteLevel"
        and pre.get("use_regex", True)
        and not pre.get("add_prefix_space", False)
        and singles == list(range(256))
        and order == list(range(256, 256 + len(order)))
        and len(vocabulary) - len(special & vocabulary.keys()) == 256 + len(order)
    )
    if not plain:
        return slow
    import tiktoken

    ranks = {t.a_bytes[i]: i for i in range(256 + len(order))}
    fast = tiktoken.Encoding("a", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    white = re.compile(r"\s{%d}" % LONG_WHITE)

    def run(texts: list[str]) -> list[np.ndarray]:
        return [slow([x])[0] if len(x) >= LONG_WHITE and white.search(x) else fast.encode_to_numpy(x, disallowed_special=()) for x in texts]

    return run


class _Coder:
    """Both encoders and the tables of one worker."""

    def __init__(self, t: Tokenizers):
        import sentencepiece

        self.a = _encoder_a(t)
        self.b = sentencepiece.SentencePieceProcessor(model_proto=t.b_model)
        self.a_table, self.b_table = (_table(x) for x in (t.a_bytes, t.b_bytes))
        self.same, self.width = t.same, len(t.b_bytes)
        digits = max(len(str(len(x))) for x in (t.a_bytes, t.b_bytes))
        self.numbers = np.array([str(i).encode() for i in range(max(len(t.a_bytes), len(t.b_bytes)))], dtype=f"S{digits}")


def _table(tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    size = np.array([len(x) for x in tokens], dtype=np.int64)
    return np.frombuffer(b"".join(tokens), dtype=np.uint8), np.cumsum(size) - size, size


def _coder(shared: Broadcast) -> _Coder:
    t = shared.value
    if t.key not in _cache:
        _cache.clear()
        _cache[t.key] = _Coder(t)
    return _cache[t.key]


def _spelled(ids: np.ndarray, table: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
    data, start, size = table
    ends = np.cumsum(size[ids])
    return data[np.repeat(start[ids] - (ends - size[ids]), size[ids]) + np.arange(int(ends[-1]) if len(ends) else 0)]


class Aligned:
    """Tokens, groups and links of some texts; ``None`` and texts that a tokenizer does not spell out have none."""

    def __init__(self, texts: list[str | None], coder: _Coder):
        rows = [i for i, t in enumerate(texts) if t]
        given = [texts[i] for i in rows]
        a, b = coder.a([" " + t for t in given]), coder.b.encode(given, num_threads=1)
        want = [(" " + t).encode() for t in given]
        na, nb = (np.array([len(x) for x in ids], dtype=np.int64) for ids in (a, b))
        a = np.concatenate([np.zeros(0, dtype=np.int64), *a]).astype(np.int64)
        b = np.array(list(chain.from_iterable(b)), dtype=np.int64)
        size = np.array([len(w) for w in want], dtype=np.int64)
        raw = np.frombuffer(b"".join(want), dtype=np.uint8)
        good = np.ones(len(rows), dtype=bool)
        for ids, n, table in ((a, na, coder.a_table), (b, nb, coder.b_table)):
            row = np.repeat(np.arange(len(rows)), n)
            have = np.bincount(row, weights=table[2][ids], minlength=len(rows)).astype(np.int64)
            good &= have == size
            keep = np.repeat(have == size, n)
            wrong = _spelled(ids[keep], table) != raw[np.repeat(have == size, size)]
            spelled_row = np.repeat(np.flatnonzero(have == size), size[have == size])
            good[spelled_row[wrong]] = False
        a, b = a[np.repeat(good, na)], b[np.repeat(good, nb)]
        self.rows = len(texts)
        at = np.array(rows, dtype=np.int64)[good]
        self.na, self.nb = (np.zeros(self.rows, dtype=np.int64) for _ in range(2))
        self.na[at], self.nb[at] = na[good], nb[good]
        self.a, self.b = a, b
        ends_a, ends_b = np.cumsum(coder.a_table[2][a]), np.cumsum(coder.b_table[2][b])
        # a text's last byte ends a token of both, so groups and links never cross texts
        mark = np.zeros(int(ends_a[-1]) + 1 if len(ends_a) else 1, dtype=np.uint8)
        mark[ends_a] = 1
        mark[ends_b] += 2
        is_a, is_b = (mark & 1).astype(bool), mark >= 2
        cuts = np.flatnonzero(mark)
        both = mark[cuts] == 3
        before_a, before_b = np.cumsum(is_a[cuts]), np.cumsum(is_b[cuts])
        self.link_a, self.link_b = before_a - is_a[cuts], before_b - is_b[cuts]  # the tokens that each piece is of
        group_of_cut = np.cumsum(both) - both
        self.group_a, self.group_b = group_of_cut[is_a[cuts]], group_of_cut[is_b[cuts]]
        self.row_a = np.repeat(np.arange(self.rows), self.na)
        link_row = self.row_a[self.link_a]
        self.n_links = np.bincount(link_row, minlength=self.rows)
        self.n_groups = np.bincount(link_row[both], minlength=self.rows)
        self.link_row = link_row

    def pairs(self, coder: _Coder) -> tuple[tuple, tuple]:
        """Distinct pairs of each text, as (row, code, times): those of the identity map by A id, the others as A id x width + B id."""
        a, b = self.a[self.link_a], self.b[self.link_b]
        mapped = coder.same[a] == b
        return _counted(self.link_row[mapped], a[mapped]), _counted(self.link_row[~mapped], a[~mapped] * coder.width + b[~mapped])

    def written(self, coder: _Coder) -> tuple[np.ndarray, np.ndarray]:
        """All texts' groups spelled as ``a1,a2|b1;a3|b2``, as bytes and the offset of each text."""
        last_a = np.concatenate((np.diff(self.group_a) != 0, [True]))[: len(self.a)]
        last_b = np.concatenate((np.diff(self.group_b) != 0, [True]))[: len(self.b)]
        size_b = np.bincount(self.group_b) if len(self.group_b) else np.zeros(0, dtype=np.int64)
        size_a = np.bincount(self.group_a) if len(self.group_a) else np.zeros(0, dtype=np.int64)
        at_a = np.arange(len(self.a)) + (np.cumsum(size_b) - size_b)[self.group_a]
        at_b = np.arange(len(self.b)) + np.cumsum(size_a)[self.group_b]
        width = coder.numbers.dtype.itemsize
        out = np.zeros((len(self.a) + len(self.b), width + 1), dtype=np.uint8)
        spelled = coder.numbers.view(np.uint8).reshape(-1, width)
        out[at_a, :width], out[at_b, :width] = spelled[self.a], spelled[self.b]
        out[at_a, width] = np.where(last_a, ord("|"), ord(","))
        out[at_b, width] = np.where(last_b, ord(";"), ord(","))
        ends = np.cumsum(self.na + self.nb)
        filled = ends[(self.na + self.nb) > 0] - 1
        out[filled, width] = 0  # a text's last group has no separator
        there = out != 0
        offsets = np.concatenate(([0], np.cumsum(there.sum(axis=1))))
        return out[there], offsets[np.concatenate(([0], ends))]


def _counted(row: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct codes of each row (rows ascend) and how often each occurs."""
    if not len(row):
        return row, code, row
    span = int(code.max()) + 1
    key, times = np.unique(row * span + code, return_counts=True)
    return key // span, key % span, times


def _lists(row: np.ndarray, values: np.ndarray, rows: int, kind: pa.DataType) -> pa.ListArray:
    offsets = np.concatenate(([0], np.cumsum(np.bincount(row, minlength=rows)))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def _documents(shared: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(shared)
        for block, seq, batch in blocks.numbered(batches):
            found = Aligned(batch.column("text").to_pylist(), coder)
            (row, code, times), (row2, code2, times2) = found.pairs(coder)
            data, offs = found.written(coder)
            digest = [hashlib.sha256(data[lo:hi]).hexdigest() if hi > lo else "" for lo, hi in zip(offs[:-1].tolist(), offs[1:].tolist(), strict=True)]
            n = found.rows
            columns = {
                "doc_id": batch.column("doc_id"),
                "n_a": pa.array(found.na),
                "n_b": pa.array(found.nb),
                "n_groups": pa.array(found.n_groups, pa.int64()),
                "n_links": pa.array(found.n_links, pa.int64()),
                "groups_sha256": pa.array(digest, pa.string()),
                "same": _lists(row, code, n, pa.int32()),
                "same_times": _lists(row, times, n, pa.int32()),
                "pair": _lists(row2, code2, n, pa.int64()),
                "pair_times": _lists(row2, times2, n, pa.int32()),
            }
            blob = blocks.pack(pa.RecordBatch.from_arrays(list(columns.values()), list(columns)))
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([seq], pa.int32()), pa.array([blob], pa.binary())], ["block", "seq", "blob"])

    return run


def _counts(width: int):
    """Of packed documents: ``block`` -1 and A id of each pair of the identity map, block and code of each other pair; with documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vector, now, codes = np.zeros(0, dtype=np.int64), None, []

        def rows(block, code, n) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(code), block), pa.int64()), pa.array(code, pa.int64()), pa.array(n, pa.int64())], ["block", "code", "n"])

        def flushed() -> Iterator[pa.RecordBatch]:
            if codes:
                yield rows(now, *np.unique(np.concatenate(codes), return_counts=True))

        vector = np.zeros(width, dtype=np.int64)
        for batch in batches:
            for block, blob in zip(batch.column("block").to_pylist(), batch.column("blob"), strict=True):
                if block != now:
                    yield from flushed()
                    now, codes = block, []
                part = blocks.unpack(blob.as_buffer())
                vector += np.bincount(part.column("same").flatten().to_numpy(), minlength=width)
                codes.append(part.column("pair").flatten().to_numpy())
        yield from flushed()
        there = np.flatnonzero(vector)
        if len(there):
            yield rows(-1, there, vector[there])

    return run


def _looked_up(tables: Broadcast, width: int):
    """Of rows in order of block, a block's pairs first: its documents with their sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        same_count, best = tables.value
        now, parts, codes, counts = None, [], None, None
        for batch in batches:
            for block, texts, lo, hi in blocks.runs(batch):
                if block != now:
                    now, parts, codes = block, [], None
                if not texts:
                    parts.append((batch.column("code")[lo:hi].to_numpy(), batch.column("n")[lo:hi].to_numpy()))
                    continue
                if codes is None:
                    codes, counts = (np.concatenate([np.zeros(0, dtype=np.int64), *(p[i] for p in parts)]) for i in range(2))
                    order = np.argsort(codes, kind="stable")
                    codes, counts = codes[order], counts[order]
                part = blocks.unpack(batch.column("blob")[lo].as_buffer())
                n = part.num_rows
                count_sum, n_best = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
                for name in ("same", "pair"):
                    lists = part.column(name)
                    row = np.repeat(np.arange(n), np.diff(lists.offsets.to_numpy()))
                    code, times = lists.flatten().to_numpy(), part.column(f"{name}_times").flatten().to_numpy()
                    if name == "same":
                        count, a = same_count[code], code
                    else:
                        count, a = counts[np.searchsorted(codes, code)] if len(code) else code, code // width
                    np.add.at(count_sum, row, count * times)
                    np.add.at(n_best, row, np.where(count == best[a], times, 0))
                columns = {k: part.column(k) for k in ("doc_id", "n_a", "n_b", "n_groups", "n_links")}
                columns |= {"n_best": pa.array(n_best), "count_sum": pa.array(count_sum), "groups_sha256": part.column("groups_sha256")}
                yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return run


@dataclass(frozen=True)
class Counted:
    """Documents as packed rows, the pairs of each block, corpus-wide counts of irregular and of identity pairs."""

    packed: DataFrame
    by_block: DataFrame
    irregular: DataFrame
    same_count: np.ndarray


def count_pairs(docs: DataFrame, t: Tokenizers) -> Counted:
    """One pass over the texts of ``docs(doc_id, text)``, and the counts of all linked pairs."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.spark_partition_id().alias("part"))
    packed = stage(texts.mapInArrow(_documents(spark.sparkContext.broadcast(t)), "block long, seq int, blob binary"), "aligned")
    found = stage(packed.sortWithinPartitions("block", "seq").mapInArrow(_counts(len(t.a_bytes)), "block long, code long, n long"), "pairs")
    same_count = np.zeros(len(t.a_bytes), dtype=np.int64)
    for r in found.where("block = -1").groupBy("code").agg(F.sum("n").alias("n")).collect():  # at most one row an A id
        same_count[r["code"]] = r["n"]
    by_block = found.where("block >= 0")
    # a block that is split over files has a row for each
    irregular = by_block.groupBy("code").agg(F.sum("n").alias("n"))
    return Counted(packed, by_block.select("block", "code").distinct(), irregular, same_count)


def _best(c: Counted, width: int) -> np.ndarray:
    """Of each A id the highest count of its pairs."""
    best = c.same_count.copy()
    a = F.floor(F.col("code") / F.lit(width)).cast("long").alias("a")
    for r in c.irregular.groupBy(a).agg(F.max("n").alias("n")).collect():  # at most one row an A id
        best[r["a"]] = max(best[r["a"]], r["n"])
    return best


def pair_table(c: Counted, t: Tokenizers) -> DataFrame:
    """``a_id, b_id, n_docs``: every linked pair of ids and the number of documents that hold it linked."""
    spark, width = c.packed.sparkSession, len(t.b_bytes)
    a = F.floor(F.col("code") / F.lit(width)).cast("long")
    there = [(int(i), int(t.same[i]), int(c.same_count[i])) for i in np.flatnonzero(c.same_count)]
    same = spark.createDataFrame(there, "a_id long, b_id long, n_docs long")
    return c.irregular.select(a.alias("a_id"), (F.col("code") % width).alias("b_id"), F.col("n").alias("n_docs")).unionByName(same)


def align(docs: DataFrame, t: Tokenizers) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` for each row of ``docs(doc_id, text)``.

    A encodes a space and the text, B the text, to which it adds the space; strings of special tokens are plain text.
    Offsets at which tokens of both end cut the text into groups; a link is a pair of tokens whose bytes overlap.  A pair
    of ids counts once for each row of ``docs`` that holds it linked, so repeated rows count as often as they stand.
    ``n_best`` are links whose count is the highest of their A id (ties included), ``count_sum`` the sum of counts over
    links.  ``groups_sha256`` is the digest of the groups as ``a1,a2|b1;a3|b2,b3``.  Null and empty texts, and texts that
    either tokenizer does not spell out byte by byte, have zeros and ''.  Null and repeated ``doc_id`` stay as they are,
    other columns are ignored, an empty table gives an empty table.  Vectors of A's vocabulary size are broadcast.
    """
    spark, width = docs.sparkSession, len(t.b_bytes)
    c = count_pairs(docs, t)
    irregular = stage(c.irregular, "pair-counts")
    tables = spark.sparkContext.broadcast((c.same_count, _best(Counted(c.packed, c.by_block, irregular, c.same_count), width)))
    back = c.by_block.join(irregular, "code").select("block", F.lit(-1).alias("seq"), F.lit(None).cast("binary").alias("blob"), "code", "n")
    texts = c.packed.select("block", "seq", "blob", F.lit(None).cast("long").alias("code"), F.lit(None).cast("long").alias("n"))
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-c.packed.count() // ROWS_PER_TASK))
    meet = texts.union(back).repartition(tasks, "block").sortWithinPartitions("block", "seq")
    return meet.mapInArrow(_looked_up(tables, width), f"doc_id long, {_NUMBERS}, n_best long, count_sum long, groups_sha256 string")


def _groups(shared: Broadcast):
    def nested(ids: np.ndarray, group: np.ndarray, n: int) -> pa.ListArray:
        return _lists(group, ids, n, pa.int32())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(shared)
        for batch in tb.chunks(batches, "text"):
            found = Aligned(batch.column("text").to_pylist(), coder)
            n = int(found.n_groups.sum())
            both = pa.StructArray.from_arrays([nested(found.a, found.group_a, n), nested(found.b, found.group_b, n)], ["a", "b"])
            offsets = np.concatenate(([0], np.cumsum(found.n_groups))).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.ListArray.from_arrays(pa.array(offsets), both)], ["doc_id", "groups"])

    return run


def token_groups(docs: DataFrame, t: Tokenizers) -> DataFrame:
    """``doc_id, groups`` (for each group the ids of A and of B, in order); cases as in ``align``."""
    shared = docs.sparkSession.sparkContext.broadcast(t)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(_groups(shared), "doc_id long, groups array<struct<a: array<int>, b: array<int>>>")
