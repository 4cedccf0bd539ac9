"""Language-model scores by a probabilistic suffix tree.

The tree's symbols are bytes of lower-cased text, words ending in a space and a text in a newline.  A context of up to
``depth`` symbols is a state of the tree if it is seen ``least`` times and if what follows it diverges from what follows
its longest suffix in the tree by more than chance.  Both cuts are absolute, so the tree grows with the corpus.  A
state's next-symbol distribution is smoothed towards that suffix's; a symbol is scored in the longest state that its past
ends in.  As for the base score, tokens are the training words and one token that stands for all others.  The latter has
the probability that the words seen once suggest (Good and Turing); a known token mixes the tree's probability of its
spelling, given the text so far, with its share of the training tokens.

Counts, tree and scores are Spark tables.  Each task counts its symbol strings and words before anything is shuffled; the
tree is worked out level by level with a join and a window (a context has at most 256 next symbols, so no key is hot); each
block of text (see ``blocks``) asks for the words and symbol strings that stand in it.  Strings travel sorted and compressed,
many to a row, to the bucket that their hash gives, where they are added up or looked up.  Only sums come to the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldbook.llm import blocks
from fieldbook.llm import textbytes as tb
from fieldbook.session import stage

SPACE, NEWLINE = 0x20, 0x0A
#: key of the end token among word hashes
END = np.uint64(0x5851F42D4C957F2D)
#: units of a natural logarithm in which probabilities travel
FINE = 1 << 16
#: buckets of each kind in which counts are added up; a task holds one at a time
COUNT_BUCKETS = 512
#: strings or words of a bucket in which they are looked up, about
BUCKET = 30_000
#: strings that a bucket's task holds before it adds them up
HELD = 2_000_000
#: scatters keys over the slots of a dictionary
ODD = np.uint64(0x9E3779B97F4A7C15)
#: lower-case letters, all white space as one
_SYMBOLS = np.where(tb.WHITE, np.uint8(SPACE), tb.LOWER)
_CODEC = pa.Codec("zstd")
_DEALT = "bucket int, block long, n int, blob binary"
_MET = "block long, seq int, kind int, n int, blob binary"


@dataclass(frozen=True)
class Settings:
    depth: int = 6  # longest context, at most 7
    least: int = 4  # times that a state is seen
    divergence: float = 3.0  # log likelihood that a state must gain for each of its symbols
    weight: float = 0.4  # of the tree in a known token's probability
    hold: int = 4_000_000  # strings and words that a counting task holds before it sends them


@dataclass(frozen=True)
class Totals:
    symbols: int  # in training texts
    tokens: int
    distinct: int
    once: int  # words seen once
    ends: int  # end tokens
    weight: float
    strings: int = 0  # distinct ones, those of held-out texts among them


def held_out(doc_id: Column, parts: int = 5) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % parts == 1, F.lit(False))


def spelled(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Symbols of all texts; first symbol, hash and row of each token (words, then the end, of each text)."""
    text = batch.column("text")
    empty, end = (pa.scalar(x, pa.binary()).cast(text.type) for x in (b"", b" \n"))
    closed = pc.binary_join_element_wise(pc.fill_null(text, empty), end, empty)
    data, offs = tb.text_buffer(closed)
    low = _SYMBOLS[data]
    white = low == SPACE
    low[offs[1:] - 1] = NEWLINE
    keep = ~white
    keep[1:] |= ~white[:-1]  # white space right after a word
    keep[offs[1:] - 1] = True
    out = low[keep]
    ends = np.flatnonzero((out == SPACE) | (out == NEWLINE))
    at = np.concatenate(([0], ends[:-1] + 1))[: len(ends)]
    last = out[ends] == NEWLINE
    hashes = np.where(last, END, tb.span_hashes(out, at, ends))
    return out, at, hashes, np.cumsum(last) - last


def strings(symbols: np.ndarray, ends: np.ndarray, depth: int) -> np.ndarray:
    """Each symbol with the ``depth`` before it, the symbol in the highest byte, then from late to early; newlines before a text."""
    n = len(symbols)
    late = np.full(n + 7, NEWLINE, dtype=np.uint8)
    late[:n] = symbols[::-1]
    out = np.ndarray((n,), dtype=">u8", buffer=late, strides=(1,))[::-1].astype(np.uint64)
    first = np.concatenate(([0], ends[:-1] + 1))
    newlines = int.from_bytes(bytes([NEWLINE]) * 8, "big")
    for j in range(depth):  # the j-th symbol of a text has j before it
        here = first + j
        here = here[here <= ends]
        own = np.uint64(((1 << 64) - 1) << (56 - 8 * j) & ((1 << 64) - 1))
        out[here] = (out[here] & own) | (np.uint64(newlines) & ~own)
    return out & np.uint64(((1 << 64) - 1) << (56 - 8 * depth) & ((1 << 64) - 1))


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and how often each occurs."""
    keys = np.sort(keys)
    head = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[: len(keys)])
    return keys[head], np.diff(np.append(head, len(keys)))


def _merged(found: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of all in order, their numbers added up; each has its keys in order."""
    keys = np.concatenate([f[0] for f in found])
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    head = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[: len(keys)])
    keys = keys[head]  # one array less while the numbers are added up
    n = np.concatenate([f[1] for f in found])[order]
    return keys, np.add.reduceat(n, head) if len(head) else n


def _squeezed(keys: np.ndarray, values: np.ndarray | None = None) -> bytes:
    """Ascending keys (and their numbers), differences byte by byte, compressed."""
    parts = [np.diff(keys, prepend=np.uint64(0))] + ([] if values is None else [values.astype(np.uint64)])
    return _CODEC.compress(np.concatenate([np.ascontiguousarray(p).view(np.uint8).reshape(-1, 8).T.ravel() for p in parts]), asbytes=True)


def _restored(blob, n: int, columns: int) -> list[np.ndarray]:
    raw = np.frombuffer(_CODEC.decompress(blob, 8 * n * columns), dtype=np.uint8)
    found = [np.ascontiguousarray(raw[8 * n * c : 8 * n * (c + 1)].reshape(8, n).T).view(np.uint64).ravel() for c in range(columns)]
    return [np.cumsum(found[0], dtype=np.uint64), *(f.view(np.int64) for f in found[1:])]


def _dealt(kind: int, keys: np.ndarray, values: np.ndarray | None, wide: int, block: int | None = None) -> Iterator[pa.RecordBatch]:
    """Rows (bucket, block, n, blob) of ascending keys, those of a bucket together; buckets of kind 0 are even, of kind 1 odd.

    Strings go by their symbol and the three before it, so that those of a bucket differ little from one to the next.
    """
    of = tb.mix(keys if kind else keys >> np.uint64(32)) % np.uint64(wide)
    of = of.astype(np.uint16 if wide <= 1 << 16 else np.int64)
    order = np.argsort(of, kind="stable")
    keys, of = keys[order], of[order]
    values = None if values is None else values[order]
    head = np.flatnonzero(np.append(True, of[1:] != of[:-1])[: len(of)])
    bounds = np.append(head, len(of)).tolist()
    for at in range(0, len(head), 256):
        spans = [(lo, hi) for lo, hi in zip(bounds[at : at + 256], bounds[at + 1 : at + 257], strict=False)]
        blobs = [_squeezed(keys[lo:hi], None if values is None else values[lo:hi]) for lo, hi in spans]
        bucket = of[head[at : at + 256]].astype(np.int32) * 2 + kind
        columns = [pa.array(bucket), pa.array([block] * len(spans), pa.int64()), pa.array([hi - lo for lo, hi in spans], pa.int32()), pa.array(blobs, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["bucket", "block", "n", "blob"])


def _counted(s: Settings):
    """Strings (kind 0; those of held-out texts with n = 0) and training words (1) of a task, counted and dealt to buckets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fresh: list[list[list[np.ndarray]]] = [[[], []], [[], []]]  # by kind, by held_out
        runs: list[list[tuple[np.ndarray, np.ndarray]]] = [[], []]  # of distinct ones in order, with their counts
        size = held_size = 0

        def sort() -> int:
            more = 0
            for kind in (0, 1):
                for held in (False, True):
                    if fresh[kind][held]:
                        keys, n = _distinct(np.concatenate(fresh[kind][held]))
                        runs[kind].append((keys, n * (not held)))
                        fresh[kind][held].clear()
                        more += len(keys)
            return more

        def merge() -> int:
            for kind in (0, 1):
                runs[kind][:] = [_merged(runs[kind])] if runs[kind] else []
            return sum(len(r[0][0]) for r in runs if r)

        def flush() -> Iterator[pa.RecordBatch]:
            for kind in (0, 1):
                if runs[kind]:
                    yield from _dealt(kind, *runs[kind].pop(), COUNT_BUCKETS)

        for batch in tb.chunks(batches, "text"):
            out = batch.column("held_out")
            for held in (False, True):
                part = batch.filter(out if held else pc.invert(out))
                if not part.num_rows:
                    continue
                symbols, at, hashes, _ = spelled(part)
                fresh[0][held].append(strings(symbols, at[hashes == END], s.depth))
                if not held:
                    fresh[1][held].append(hashes)
                size += len(symbols) + len(hashes)
            if size > s.hold // 4:
                held_size, size = held_size + sort(), 0
                if held_size > 3 * s.hold // 4:
                    held_size = merge()
                    if held_size > s.hold // 2:
                        yield from flush()
                        held_size = 0
        sort()
        merge()
        yield from flush()

    return run


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows in order of their buckets: kind, key and n of each string and word."""
    now, found, size = None, [], 0

    def rows() -> Iterator[pa.RecordBatch]:
        keys, n = _merged(found)
        for lo in range(0, len(keys), 100_000):
            part = keys[lo : lo + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), now & 1, np.int32)), pa.array(tb.signed(part)), pa.array(n[lo : lo + 100_000])], ["kind", "key", "n"])

    for batch in batches:
        for bucket, n, blob in zip(batch.column("bucket").to_pylist(), batch.column("n").to_pylist(), batch.column("blob"), strict=True):
            if bucket != now:
                if found:
                    yield from rows()
                now, found, size = bucket, [], 0
            found.append(tuple(_restored(blob.as_buffer(), n, 2)))
            size += n
            if size > HELD:
                found = [_merged(found)]
                size = 0
    if found:
        yield from rows()


def counts(docs: DataFrame, settings: Settings | None = None) -> DataFrame:
    """``kind, key, n`` over all of ``docs(text, held_out)``: symbol strings (0) and words, the end among them (1).

    Training texts are counted.  Strings that only held-out texts have are listed with n = 0; their words are not.
    """
    found = docs.select("text", "held_out").mapInArrow(_counted(settings or Settings()), _DEALT)
    return found.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_summed, "kind int, key long, n long")


def _lookup(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return np.zeros(len(wanted), dtype=np.int64), np.zeros(len(wanted), dtype=bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def _first(key: Column, symbols: int) -> Column:
    """A string's first bytes, the others zero."""
    return F.shiftleft(F.shiftrightunsigned(key, 64 - 8 * symbols), 64 - 8 * symbols) if symbols < 8 else key


def grow(counted: DataFrame, total: int, settings: Settings | None = None) -> DataFrame:
    """``key, context, p, state``: probability of each string's symbol in the longest state its context ends in, and that state's length.

    ``counted(key, n)``: the strings of ``depth`` + 1 symbols, stored; ``total``: the sum of n.
    """
    s = settings or Settings()
    levels = [counted.select("key", "n")]
    for d in range(s.depth - 1, -1, -1):
        shorter = levels[0].groupBy(_first(F.col("key"), d + 1).alias("key")).agg(F.sum("n").alias("n"))
        levels.insert(0, stage(shorter, "strings"))
    tree = levels[0].select("key", F.lit(0).cast("long").alias("context"), ((F.col("n") + 0.5) / (total + 128)).alias("p"), F.lit(0).alias("state"))
    for d in range(1, s.depth + 1):
        longer = levels[d].withColumn("up", _first(F.col("key"), d))
        met = longer.join(tree.select(F.col("key").alias("up"), "p", "state"), "up").withColumn("context", F.shiftleft("key", 8))
        of_context = Window.partitionBy("context")
        c, kinds = F.sum("n").over(of_context), F.sum((F.col("n") > 0).cast("int")).over(of_context)
        gain = F.sum(F.when(F.col("n") > 0, F.col("n") * (F.ln("n") - F.ln("p")))).over(of_context)
        tested = met.select("key", "context", "n", "p", "state", c.alias("c"), kinds.alias("kinds"), gain.alias("gain"))
        keep = (F.col("c") >= s.least) & (F.col("gain") - F.col("c") * F.ln("c") > s.divergence * F.col("kinds"))
        smooth = (F.col("n") + F.col("kinds") * F.col("p")) / (F.col("c") + F.col("kinds"))
        tree = tested.select("key", "context", F.when(keep, smooth).otherwise(F.col("p")).alias("p"), F.when(keep, d).otherwise(F.col("state")).alias("state"))
    return tree


def totals(counted: DataFrame, settings: Settings | None = None) -> Totals:
    """Sums of a stored table of counts."""
    is_end = F.col("key") == int(END.view(np.int64))
    sums = counted.groupBy("kind").agg(F.sum("n").alias("n"), F.count("*").alias("distinct"), F.count_if(F.col("n") == 1).alias("once"), F.sum(F.when(is_end, F.col("n"))).alias("ends"))
    by_kind = {r["kind"]: r for r in sums.collect()}  # at most two rows
    words = by_kind.get(1)
    found = (int(words["n"]), int(words["distinct"]), int(words["once"]), int(words["ends"] or 0)) if words else (0, 0, 0, 0)
    symbols, kept = (int(by_kind[0]["n"]), int(by_kind[0]["distinct"])) if 0 in by_kind else (0, 0)
    return Totals(symbols, *found, (settings or Settings()).weight, kept)


def _wanted(depth: int, wide: tuple[int, int]):
    """Distinct strings (kind 0) and word hashes (1) of each block, dealt to buckets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, seen = None, ([], [])

        def rows() -> Iterator[pa.RecordBatch]:
            for kind, found in enumerate(seen):
                if found:
                    yield from _dealt(kind, _distinct(np.concatenate(found))[0], None, wide[kind], now)

        for block, _, batch in blocks.numbered(batches):
            if block != now:
                yield from rows()
                now, seen = block, ([], [])
            symbols, at, hashes, _ = spelled(batch)
            for kind, keys in enumerate((strings(symbols, at[hashes == END], depth), hashes)):
                seen[kind].append(_distinct(keys)[0])
                if len(seen[kind]) == 8:
                    seen[kind][:] = [_distinct(np.concatenate(seen[kind]))[0]]
        yield from rows()

    return run


def _table(wide: tuple[int, int]):
    """Keys and values of a part of the table of strings (kind 0) and words (1), dealt to buckets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, size = ([], []), 0

        def rows() -> Iterator[pa.RecordBatch]:
            for kind, parts in enumerate(found):
                if parts:
                    keys, values = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
                    order = np.argsort(keys)
                    yield from _dealt(kind, keys[order], values[order], wide[kind])
                    parts.clear()

        for batch in batches:
            kinds, keys, values = (batch.column(c).to_numpy() for c in ("kind", "key", "value"))
            for kind in (0, 1):
                here = kinds == kind
                if here.any():
                    found[kind].append((keys[here].view(np.uint64), values[here]))
            size += len(keys)
            if size > HELD:
                yield from rows()
                size = 0
        yield from rows()

    return run


def _answered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows in order of buckets, those of the table (without a block) first: keys and values that each block asks for.

    A word that no training text has is left out.
    """
    now, parts, keys, values = None, [], None, None
    for batch in batches:
        out: list[tuple] = []
        for bucket, block, n, blob in zip(*(batch.column(c).to_pylist() for c in ("bucket", "block", "n")), batch.column("blob"), strict=True):
            if bucket != now:
                now, parts, keys = bucket, [], None
            if block is None:
                parts.append(_restored(blob.as_buffer(), n, 2))
                continue
            if keys is None:
                keys, values = (np.concatenate([p[i] for p in parts]) if parts else np.zeros(0, t) for i, t in ((0, np.uint64), (1, np.int64)))
                order = np.argsort(keys)
                keys, values, parts = keys[order], values[order], []
            wanted = _restored(blob.as_buffer(), n, 1)[0]
            at, known = _lookup(keys, wanted)
            if known.any():
                out.append((block, -1, bucket & 1, int(known.sum()), _squeezed(wanted[known], values[at[known]])))
        columns = list(zip(*out, strict=True)) or [()] * 5
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["block", "seq", "kind", "n", "blob"])


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block, seq, batch in blocks.numbered(batches):
        blob = blocks.pack(batch.select(["doc_id", "text", "held_out"]))
        none = pa.nulls(1, pa.int32())
        columns = [pa.array([block], pa.int64()), pa.array([seq], pa.int32()), none, none, pa.array([blob], pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["block", "seq", "kind", "n", "blob"])


def token_scores(t: Totals, n: np.ndarray, spelling: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Base and model log10 probability of tokens with training counts ``n`` and log probability ``spelling`` in the tree."""
    base = np.log10((n + 0.5) / (t.tokens + 0.5 * (t.distinct + 1)))
    other = (t.once + 0.5) / (t.tokens + 0.5)
    if other >= 1:  # nothing was seen, or nothing twice
        other = 1 - 0.5 * t.tokens / (t.tokens + 0.5)
    with np.errstate(divide="ignore"):
        share = np.log((1 - t.weight) * n / max(1, t.tokens))
        known = np.log1p(-other) + np.logaddexp(share, np.log(t.weight) + spelling)
    return base, np.where(n > 0, known, np.log(other)) / np.log(10)


class _Dictionary:
    """Words and strings of one block."""

    def __init__(self) -> None:
        self.parts: tuple[list, list] = ([], [])

    def add(self, batch: pa.RecordBatch, lo: int, hi: int) -> None:
        for kind, n, blob in zip(*(batch.column(c)[lo:hi].to_pylist() for c in ("kind", "n")), batch.column("blob")[lo:hi], strict=True):
            self.parts[kind].append(_restored(blob.as_buffer(), n, 2))

    def sort(self) -> None:
        self.tables = []
        for found in self.parts:
            keys, values = (np.concatenate([p[i] for p in found]) if found else np.zeros(0, t) for i, t in ((0, np.uint64), (1, np.int64)))
            found.clear()
            shift = np.uint64(63 - max(1, len(keys)).bit_length())  # two slots and more for a key
            slot = (keys * ODD) >> shift
            order = np.argsort(slot)
            starts = np.concatenate(([0], np.cumsum(np.bincount(slot.astype(np.int64), minlength=1 << (64 - int(shift)))))).astype(np.int32)
            self.tables.append((np.append(keys[order], np.uint64(0)), np.append(values[order], 0), starts, shift))

    def _found(self, kind: int, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Value of each key, and whether it is there."""
        keys, values, starts, shift = self.tables[kind]
        slot = ((wanted * ODD) >> shift).astype(np.int64)
        at, known = starts[slot], np.ones(len(wanted), dtype=bool)
        ask = np.flatnonzero((keys[at] != wanted) | (at >= len(keys) - 1))
        while len(ask):
            at[ask] += 1
            over = at[ask] >= starts[slot[ask] + 1]
            known[ask[over]], at[ask[over]] = False, len(keys) - 1
            ask = ask[~over]
            ask = ask[keys[at[ask]] != wanted[ask]]
        return values[at], known & (at < len(keys) - 1)

    def logs(self, packed: np.ndarray) -> np.ndarray:
        """Natural log of each symbol's probability; every string of the block is in the dictionary."""
        units, known = self._found(0, packed)
        if not known.all():
            raise ValueError("a block without the strings of its texts")
        return units / -FINE

    def counts(self, hashes: np.ndarray) -> np.ndarray:
        return self._found(1, hashes)[0]


def _scored(t: Totals, depth: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, own, ready = None, _Dictionary(), False
        for batch in batches:
            for block, texts, lo, hi in blocks.runs(batch):
                if block != now:
                    now, own, ready = block, _Dictionary(), False
                if not texts:
                    own.add(batch, lo, hi)
                    continue
                if not ready:
                    own.sort()
                    ready = True
                part = blocks.unpack(batch.column("blob")[lo].as_buffer())
                symbols, at, hashes, row = spelled(part)
                spelling = np.add.reduceat(own.logs(strings(symbols, at[hashes == END], depth)), at)
                count = own.counts(hashes)
                count[hashes == END] = t.ends
                base, score = token_scores(t, count, spelling)
                spelled_out = score + np.where(count > 0, 0, spelling / np.log(10))
                sums = [np.bincount(row, weights=w, minlength=part.num_rows) for w in (np.ones(len(row)), count > 0, base, score, spelled_out)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("held_out"), pa.array(sums[0].astype(np.int64)), pa.array(sums[1].astype(np.int64)), pa.array(np.full(part.num_rows, t.tokens, np.int64)), *map(pa.array, sums[2:])],
                    ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "spelled_score"],
                )

    return run


def scores(docs: DataFrame, settings: Settings | None = None) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, spelled_score`` for each row of ``docs(doc_id, text)``.

    Learns from rows whose id is not held out (a null id is neither held out nor learned from).  Tokens are the words
    and one end; null and empty texts are one end.  Scores are log10 probabilities; in ``spelled_score`` an unknown token
    also has the tree's probability of its spelling, so that it is the probability of the very text.  With nothing to learn
    from, all tokens are the unknown one and ``score`` is 0.  Words are known by 64-bit hashes.  Repeated rows count as
    often in training and get equal scores; empty tables give empty tables; other columns are ignored.
    """
    s = settings or Settings()
    rows = docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out"), F.spark_partition_id().alias("part"))
    counted = stage(counts(rows.withColumn("held_out", F.col("held_out") | F.col("doc_id").isNull()), s), "counts")
    t = totals(counted, s)
    tree = grow(counted.where("kind = 0"), t.symbols, s)
    units = F.round(F.least(-F.ln("p"), F.lit(127.0)) * FINE).cast("long")  # probabilities have a floor of exp(-127)
    table = tree.select(F.lit(0).alias("kind"), "key", units.alias("value")).union(counted.where("kind = 1").select("kind", "key", F.col("n").alias("value")))
    buckets = -(-t.strings // BUCKET) or 1, -(-t.distinct // BUCKET) or 1
    asked = table.mapInArrow(_table(buckets), _DEALT).union(rows.mapInArrow(_wanted(s.depth, buckets), _DEALT))
    known = asked.repartition("bucket").sortWithinPartitions("bucket", F.col("block").asc_nulls_first()).mapInArrow(_answered, _MET)
    meet = rows.mapInArrow(_packed, _MET).union(known)
    wide = -(-t.symbols // blocks.BLOCK_BYTES)  # about as many as there are blocks
    more = wide > int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    meet = (meet.repartition(wide, "block") if more else meet.repartition("block")).sortWithinPartitions("block", "seq")
    return meet.mapInArrow(_scored(t, s.depth), "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, spelled_score double")
