"""N-gram Jaccard join by a size-aware light and heavy path.

A document is the set of its distinct k-word shingles.  Documents with equal sets form a class; links are looked for
between classes.

* Light sets (at most ``boundary`` shingles) enumerate their subsets of every fixed size that a linked partner must
  share; equal subsets meet.
* Heavy sets write inverted lists.  A list belongs to a hash range of shingles ("block") of a size level: there are
  more blocks than shingles in which two linked sets of that level can differ, so linked sets hold at least one block
  with the same shingles, and that block's digest is the key of the list they meet in.  Unlike lists of single
  shingles, a passage that thousands of documents share makes no long list unless it is most of the document.
* The boundary is the one with the fewest keys in total, from the histogram of set sizes.  Sets next to it write both
  kinds of keys, so pairs across the boundary meet.

Lists are scanned in key order.  A list's first member is compared with the others; members that the links found so
far already put in one component need no comparison.  Lists that still hold several components go on with the next
member.  Linked sets share not one block but as many as a level has to spare, less the empty blocks of either; a set that
is left in fewer lists of a level than that goes out of all of them, so documents that merely share a passage drop out
here.  What is left after these rounds is paired within short lists; members of long ones, mostly groups that differ by
a little more than a link allows, are joined on the rarest shingles of each set, with bounds on size and on the place of
the first common shingle that exclude such pairs unseen.  So no link between components is lost, and a group of thousands of near copies costs about
one comparison a member.  Candidates first compare parity bitmaps: where these differ in more bits than linked sets in
shingles, the pair is no link.  The others are checked exactly.
"""

from __future__ import annotations

import functools
import itertools
import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldbook.llm import textbytes as tb
from fieldbook.llm.graph import components
from fieldbook.session import stage

#: largest set that may enumerate its subsets
MOST_LIGHT = 24
#: rounds with one centre a list before what is left is settled at once
STAR_ROUNDS = 2
#: lists with at most so many members left are then paired as they are, longer ones joined on rare shingles
SHORT_LIST = 16
#: size levels grow by this factor
LEVEL = 1.5
#: the low bits of a key tell its level, or that it is of a subset
LEVEL_BITS = 6
SUBSET = (1 << LEVEL_BITS) - 1
#: times that sets in too few lists are taken out, which leaves others in too few
PEELS = 3
#: 64-bit words of a set's parity bitmap
BITMAP = 16
#: broadcast a list of texts to fetch up to this many, shuffle beyond
BROADCAST_ROWS = 200_000


def _light_keys(n: int, t: Fraction) -> int:
    return sum(math.comb(n, c) for c in range(max(1, math.ceil(t * n)), n + 1))


@functools.cache
def _blocks(level: int, t: Fraction) -> tuple[int, int]:
    """Blocks of a size level, and how many of them are equal in linked sets at least.

    So many blocks more than can differ that hardly any set of the level has as many empty ones: empty blocks are equal
    too, and would be long lists.
    """
    upper = _upper(level)
    differ = math.floor(2 * upper * (1 - t) / (1 + t))
    smallest = float(t) * upper / LEVEL  # that writes keys of this level
    spare = 3
    while True:
        empty = math.exp(-smallest / (differ + spare))
        spread = math.sqrt((differ + spare) * empty * max(0.0, 1 - (1 + smallest / (differ + spare)) * empty))
        if spare > (differ + spare) * empty + 3 * spread + 1:
            return differ + spare, spare
        spare += 1 + spare // 16


def _upper(level: int) -> int:
    return math.ceil(4 * LEVEL**level)


def _levels(sizes: np.ndarray, t: Fraction) -> tuple[np.ndarray, np.ndarray]:
    """The level of each size, and that of its largest possible partner."""
    most = int(sizes.max(initial=1) / t) + 2
    bounds = np.array([_upper(i) for i in range(3 + int(math.log(max(most, 4) / 4, LEVEL)))])
    return np.searchsorted(bounds, sizes), np.searchsorted(bounds, np.floor(sizes / float(t) + 1e-9).astype(np.int64))


def _heavy_keys(n: int, t: Fraction) -> int:
    own, most = _levels(np.array([n]), t)
    return sum(_blocks(x, t)[0] for x in range(int(own[0]), int(most[0]) + 1))


def choose_boundary(histogram: dict[int, int], t: Fraction) -> int:
    """The size up to which sets enumerate subsets, by the number of keys written."""
    light = {n: c * _light_keys(n, t) for n, c in histogram.items() if n <= MOST_LIGHT}
    heavy = {n: c * _heavy_keys(n, t) for n, c in histogram.items()}
    cost = lambda b: sum(v for n, v in light.items() if n <= b) + sum(v for n, v in heavy.items() if n >= t * b)
    return min(range(1, MOST_LIGHT + 1), key=lambda b: (cost(b), b))


def _sets(batch: pa.RecordBatch, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Shingle hashes by row, ascending; their rows; set sizes; class digests."""
    data, offs = tb.text_buffer(batch.column("text"))
    values, row = tb.shingles(*tb.word_hashes(data, offs), batch.num_rows, k)
    values, row = tb.distinct_sorted(values, row)
    n = np.bincount(row, minlength=batch.num_rows)
    ends = np.cumsum(n)
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(tb.mix(values + np.uint64(77)))))
    digest = tb.mix(total[ends] - total[ends - n] + n.astype(np.uint64))
    return values, row, n, digest


def _bitmaps(values: np.ndarray, row: np.ndarray, rows: int) -> pa.Array:
    """For each row, the parity of its shingles in each of the bitmap's bits."""
    bits = 64 * BITMAP
    place = (tb.mix(values + np.uint64(33)) % np.uint64(bits)).astype(np.int64)
    out = np.empty((rows, bits // 8), dtype=np.uint8)
    cuts = np.searchsorted(row, np.arange(0, rows + 1024, 1024))
    for i, (lo, hi) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
        some = min(1024, rows - 1024 * i)
        odd = np.bincount((row[lo:hi] - 1024 * i) * bits + place[lo:hi], minlength=some * bits) & 1
        out[1024 * i : 1024 * i + some] = np.packbits(odd.reshape(some, bits).astype(np.uint8), axis=1)
    words = pa.array(out.ravel().view(np.int64))
    return pa.ListArray.from_arrays(pa.array(np.arange(0, rows * BITMAP + 1, BITMAP, dtype=np.int32)), words)


def _profiles(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tb.chunks(batches, "text"):
            values, row, n, digest = _sets(batch, k)
            cls = pa.array(tb.signed(digest), mask=n == 0)
            bits = _bitmaps(values, row, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("th"), pa.array(n.astype(np.int64)), cls, bits], ["doc_id", "th", "n_shingles", "cls", "bits"])

    return run


def _levelled(key: np.ndarray, level: np.ndarray) -> np.ndarray:
    return (key & ~np.uint64(SUBSET)) | level


def _light(values: np.ndarray, at: np.ndarray, n: np.ndarray, cls: np.ndarray, t: Fraction) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for size in np.unique(n):
        of = np.flatnonzero(n == size)
        h = tb.mix(values[at[of][:, None] + np.arange(size)] + np.uint64(99))
        whole = h.sum(axis=1, dtype=np.uint64)
        for c in range(max(1, math.ceil(t * int(size))), int(size) + 1):
            out = np.array(list(itertools.combinations(range(size), int(size) - c)), dtype=np.int64)
            less = h[:, out].sum(axis=2, dtype=np.uint64) if out.shape[1] else np.zeros((len(of), 1), np.uint64)
            yield _levelled(tb.mix(tb.mix(whole[:, None] - less) + np.uint64(c)).ravel(), np.uint64(SUBSET)), np.repeat(cls[of], less.shape[1])


def _heavy(values: np.ndarray, at: np.ndarray, n: np.ndarray, cls: np.ndarray, t: Fraction) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    own, most = _levels(n, t)
    for step in range(int((most - own).max(initial=-1)) + 1):
        of = np.flatnonzero(own + step <= most)
        sizes, lev = n[of], (own + step)[of]
        table = {int(x): _blocks(int(x), t) for x in np.unique(lev)}
        k = np.array([table[int(x)][0] for x in lev])
        spare = np.array([table[int(x)][1] for x in lev])
        rows = np.repeat(np.arange(len(of)), sizes)
        index = np.arange(len(rows)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(at[of], sizes)
        h = values[index]
        block = ((h >> np.uint64(32)) * k[rows].astype(np.uint64)) >> np.uint64(32)
        first = np.ones(len(h), dtype=bool)
        first[1:] = (rows[1:] != rows[:-1]) | (block[1:] != block[:-1])
        at_first = np.flatnonzero(first)
        digest = np.add.reduceat(tb.mix(h + np.uint64(55)), at_first)
        tag = lambda r, b: lev[r].astype(np.uint64) * np.uint64(0x8EBC6AF09C88C6E3) + b * np.uint64(0x589965CC75374CC3)
        yield _levelled(tb.mix(tb.mix(digest) + tag(rows[at_first], block[at_first])), lev[rows[at_first]].astype(np.uint64)), cls[of][rows[at_first]]
        # blocks without a shingle are equal too: they are keys of the few sets that have as many as linked sets need
        filled = np.bincount(rows[at_first], minlength=len(of))
        for r in np.flatnonzero(k - filled >= spare):
            empty = np.setdiff1d(np.arange(k[r], dtype=np.uint64), block[rows == r])
            yield _levelled(tb.mix(tag(np.full(len(empty), r), empty)), lev[np.full(len(empty), r)].astype(np.uint64)), np.full(len(empty), cls[of][r])


def _needs(k: int, t: Fraction):
    """Of each class and each level that it writes keys of: the keys that it has in common with any linked class at least."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tb.chunks(batches, "text"):
            values, row, n, digest = _sets(batch, k)
            own, most = _levels(n, t)
            of, levels, needs = [], [], []
            for level in range(int(own.min(initial=0)), int(most.max(initial=-1)) + 1):
                at = np.flatnonzero((n > 0) & (own <= level) & (level <= most))
                blocks, spare = _blocks(level, t)
                here = np.isin(row, at)
                block = ((values[here] >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32)
                filled = np.bincount(np.unique(row[here] * blocks + block.astype(np.int64)) // blocks, minlength=batch.num_rows)[at]
                of.append(tb.signed(digest)[at])
                levels.append(np.full(len(at), level, dtype=np.int32))
                needs.append(np.maximum(1, spare - (blocks - filled)).astype(np.int32))
            columns = [np.concatenate([np.zeros(0, dtype=kind), *x]) for x, kind in ((of, np.int64), (levels, np.int32), (needs, np.int32))]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["cls", "level", "need"])

    return run


def _keys(k: int, t: Fraction, boundary: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in tb.chunks(batches, "text"):
            values, _, n, digest = _sets(batch, k)
            at = np.cumsum(n) - n
            _, fresh = np.unique(digest, return_index=True)
            fresh = np.array([i for i in fresh if n[i] and int(digest[i]) not in seen], dtype=np.int64)
            seen.update(digest[fresh].tolist())
            cls = tb.signed(digest)
            low, high = fresh[n[fresh] <= boundary], fresh[n[fresh] >= t * boundary]
            for key, who in itertools.chain(_light(values, at[low], n[low], cls[low], t), _heavy(values, at[high], n[high], cls[high], t)):
                yield pa.RecordBatch.from_arrays([pa.array(tb.signed(key)), pa.array(who)], ["key", "cls"])

    return run


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of lists in (key, cls) order: first member with each other one, and the members of lists of three and more.

    Holds one Arrow batch; of a list that reaches into the next one only the first member and the count stay.
    """
    key_now, first, second, count = None, None, None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        key, cls = (batch.column(i).to_numpy() for i in (0, 1))
        fresh = np.ones(len(key), dtype=bool)
        fresh[1:] = (key[1:] != key[:-1]) | (cls[1:] != cls[:-1])
        if key_now is not None and key[0] == key_now and cls[0] == last:
            fresh[0] = False
        last = cls[-1]
        key, cls = key[fresh], cls[fresh]
        if not len(key):
            continue
        head = np.ones(len(key), dtype=bool)
        head[1:] = key[1:] != key[:-1]
        head[0] = key_now is None or key[0] != key_now
        group = np.cumsum(head)  # 0: goes on from the last batch
        heads = np.flatnonzero(head)
        centre = np.empty(len(heads) + 1, dtype=np.int64)
        centre[1:] = cls[heads]
        centre[0] = first if first is not None else 0
        begun = np.concatenate(([count if group[0] == 0 else 0], np.zeros(len(heads), dtype=np.int64)))
        start = np.concatenate(([0], heads))
        place = np.arange(len(key)) - start[group] + begun[group]
        pair = place > 0
        size = np.bincount(group, minlength=len(heads) + 1) + begun
        listed = [(key[place == 2], centre[group][place == 2])]  # the first two are told when the third comes
        two = np.flatnonzero(place == 2)
        before = np.array([cls[i - 1] if i and group[i - 1] == group[i] else second for i in two], dtype=np.int64)
        listed += [(key[two], before), (key[place >= 2], cls[place >= 2])]
        yield pa.RecordBatch.from_arrays([pa.nulls(int(pair.sum()), pa.int64()), pa.array(centre[group][pair]), pa.array(cls[pair])], ["key", "a", "b"])
        k, c = (np.concatenate([x[i] for x in listed]) for i in (0, 1))
        yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(c), pa.nulls(len(k), pa.int64())], ["key", "a", "b"])
        g = group[-1]
        where = np.flatnonzero(group == g)
        key_now, first, count = key[-1], centre[g], int(size[g])
        second = next((int(cls[i]) for i in where if place[i] == 1), second)


def _blobs(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tb.chunks(batches, "text"):
            values, _, n, digest = _sets(batch, k)
            ends = np.cumsum(n)
            rows = np.flatnonzero(n)
            blobs = pa.array([values[ends[i] - n[i] : ends[i]].tobytes() for i in rows], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(tb.signed(digest)[rows]), blobs], ["cls", "blob"])

    return run


def _linked(t: Fraction):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
                x, y = (np.frombuffer(v.as_buffer(), dtype=np.uint64) for v in (x, y))
                both = np.concatenate((x, y))
                both.sort(kind="stable")
                shared = int((both[1:] == both[:-1]).sum())
                keep.append(shared >= t * (len(x) + len(y) - shared))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def jaccard_components(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id, n_links`` for each row of ``docs(doc_id, text)``.

    Two documents link when shared shingles are at least ``percent`` of all their shingles; ``component_id`` is the
    smallest ``doc_id`` reached by links.  ``n_links`` counts the links found while joining components (at least one
    for each further class of a component), not all pairs.

    Null or wordless text: empty set, linked with nothing, component of its own.  Equal sets link whatever the ids, so
    repeated rows share a component.  A null ``doc_id`` takes part and gets its component's id.  Other columns are
    ignored.  An empty table gives an empty table.  64-bit shingle hashes stand for shingles.
    """
    spark = docs.sparkSession
    t = Fraction(percent, 100)
    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("th"))
    rows = stage(texts.mapInArrow(_profiles(k), "doc_id long, th long, n_shingles long, cls long, bits array<bigint>"), "profiles")
    classes = rows.where("cls is not null")
    histogram = {r[0]: r[1] for r in classes.where(F.col("n_shingles") <= 4 * MOST_LIGHT).groupBy("n_shingles").count().collect()}
    keys = texts.select("text").mapInArrow(_keys(k, t, choose_boundary(histogram, t)), "key long, cls long")
    found = keys.repartition("key").sortWithinPartitions("key", "cls").mapInArrow(_scan, "key long, a long, b long")
    found = stage(found, "lists")
    lists = found.where("key is not null").select("key", F.col("a").alias("cls")).distinct()
    todo = found.where("key is null").select("a", "b").distinct()
    one_text = stage(classes.groupBy("cls").agg(F.min("th").alias("th"), F.min("n_shingles").alias("n"), F.min("bits").alias("bits")), "classes")
    links = labels = None
    for round_ in itertools.count(1):
        todo = stage(_plausible(todo, one_text, t), "candidates")
        new = stage(_check(texts, todo, one_text, k, t), "checked")
        links = new if links is None else links.union(new)
        labels = components(links)
        if round_ > STAR_ROUNDS:
            break
        member = lists.join(labels, lists.cls == labels.node, "left").select("key", "cls", F.coalesce("root", "cls").alias("comp"))
        open_ = member.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low <> high").select("key")
        # the smallest member has met all others: what is left of the list goes on without it
        left = member.join(open_, "key")
        first = left.groupBy("key").agg(F.min("cls").alias("done"))
        left = _in_enough(texts, stage(left.join(first, "key").where("cls <> done").select("key", "cls", "comp"), "lists"), one_text, k, t)
        if left.isEmpty():
            break
        lists = left.select("key", "cls")
        if round_ < STAR_ROUNDS:
            centre = left.groupBy("key").agg(F.min(F.struct("cls", "comp")).alias("c"))
            todo = left.join(centre, "key").where("comp <> c.comp").select(F.col("c.cls").alias("a"), F.col("cls").alias("b")).distinct()
        else:
            sized = stage(left.join(left.groupBy("key").agg(F.count("*").alias("size")), "key"), "lists")
            short, long_ = sized.where(F.col("size") <= SHORT_LIST).drop("size"), sized.where(F.col("size") > SHORT_LIST)
            other = short.select("key", F.col("cls").alias("b"), F.col("comp").alias("comp_b"))
            todo = short.join(other, "key").where((F.col("comp") != F.col("comp_b")) & (F.col("cls") < F.col("b"))).select(F.col("cls").alias("a"), "b")
            if not long_.isEmpty():
                todo = todo.union(_rare_pairs(texts, long_.select("cls", "comp").distinct(), one_text, k, t))
            todo = todo.distinct()
    ends = links.select(F.explode(F.array("a", "b")).alias("cls")).groupBy("cls").count()
    placed = rows.join(labels.withColumnRenamed("node", "cls"), "cls", "left").withColumn("comp", F.coalesce("root", "cls"))
    placed = placed.join(ends, "cls", "left").select("doc_id", "n_shingles", "comp", F.coalesce("count", F.lit(0)).alias("n_links"))
    least = placed.where("comp is not null").groupBy("comp").agg(F.min("doc_id").alias("least"))
    return placed.join(least, "comp", "left").select("doc_id", "n_shingles", F.when(F.col("comp").isNull(), F.col("doc_id")).otherwise(F.col("least")).alias("component_id"), "n_links")


def _in_enough(texts: DataFrame, left: DataFrame, one_text: DataFrame, k: int, t: Fraction) -> DataFrame:
    """The members ``key, cls, comp`` that can still have a partner.

    Two linked classes that have not met are both in all lists that they share, so each is in as many lists of some level
    as it needs there; lists of one component have no partner to offer.
    """
    if left.isEmpty():
        return left
    needs = stage(_wanted(texts, left.select("cls"), one_text).mapInArrow(_needs(k, t), "cls long, level int, need int").distinct(), "needs")
    level = F.col("key").bitwiseAND(F.lit(SUBSET)).cast("int")
    left = left.withColumn("level", level)
    for _ in range(PEELS):
        counts = left.groupBy("cls", "level").agg(F.count(F.lit(1)).alias("lists"))
        able = counts.join(needs, ["cls", "level"], "left").where((F.col("level") == SUBSET) | (F.col("lists") >= F.col("need"))).select("cls", "level")
        kept = left.join(able, ["cls", "level"], "left_semi")
        open_ = kept.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low <> high").select("key")
        left = stage(kept.join(open_, "key", "left_semi"), "lists")
    return left.select("key", "cls", "comp")


def _differ_little(t: Fraction, n1: Column, n2: Column, bits1: Column, bits2: Column) -> Column:
    """False where sizes or bitmaps show that two sets do not link: linked ones differ in at most (1 - t) / (1 + t) of their sizes' sum."""
    num, den = t.numerator, t.denominator
    apart = F.aggregate(F.zip_with(bits1, bits2, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda all_, one: all_ + one)
    return (den * F.least(n1, n2) >= num * F.greatest(n1, n2)) & ((den + num) * apart <= (den - num) * (n1 + n2))


def _plausible(pairs: DataFrame, classes: DataFrame, t: Fraction) -> DataFrame:
    one, two = (classes.select(F.col("cls").alias(c), F.col("n").alias(f"n{c}"), F.col("bits").alias(f"bits{c}")) for c in "ab")
    both = pairs.join(one, "a").join(two, "b")
    return both.where(_differ_little(t, F.col("na"), F.col("nb"), F.col("bitsa"), F.col("bitsb"))).select("a", "b")


def _wanted(texts: DataFrame, classes: DataFrame, one_text: DataFrame) -> DataFrame:
    """One text (or more equal ones) of each class in question."""
    asked = stage(classes.select("cls").distinct().join(one_text, "cls").select("th").distinct(), "asked")
    small = asked.count() <= BROADCAST_ROWS
    return texts.join(F.broadcast(asked) if small else asked, "th", "left_semi").select("text")


def _check(texts: DataFrame, pairs: DataFrame, one_text: DataFrame, k: int, t: Fraction) -> DataFrame:
    """The candidate pairs that link.  Sets are made again from one text of each class in question."""
    wanted = _wanted(texts, pairs.select(F.explode(F.array("a", "b")).alias("cls")), one_text)
    blobs = wanted.mapInArrow(_blobs(k), "cls long, blob binary").dropDuplicates(["cls"])
    left = pairs.join(blobs.select(F.col("cls").alias("a"), F.col("blob").alias("x")), "a")
    both = left.join(blobs.select(F.col("cls").alias("b"), F.col("blob").alias("y")), "b")
    return both.mapInArrow(_linked(t), "a long, b long")


def _elements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for cls, blob in zip(batch.column("cls").to_pylist(), batch.column("blob"), strict=True):
            token = np.frombuffer(blob.as_buffer(), dtype=np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(token), cls)), pa.array(np.full(len(token), len(token), np.int32)), pa.array(token)], ["cls", "n", "token"])


def _rare_pairs(texts: DataFrame, members: DataFrame, one_text: DataFrame, k: int, t: Fraction) -> DataFrame:
    """Candidates ``a, b`` among ``members(cls, comp)`` of different components, by prefixes of their rarest shingles.

    Shingles are in order of their number of members, then hash.  Linked sets have a common shingle among the first
    ``n - t n + 1`` of each, and from the first common one on at least as many shingles as they share.  Sets of one
    size with that shingle at one place are told apart from others together, before single members are looked at.
    """
    num, den = t.numerator, t.denominator
    blobs = _wanted(texts, members, one_text).mapInArrow(_blobs(k), "cls long, blob binary").dropDuplicates(["cls"])
    elements = stage(blobs.mapInArrow(_elements, "cls long, n int, token long"), "elements")
    often = elements.groupBy("token").agg(F.count("*").alias("df"))
    place = F.row_number().over(Window.partitionBy("cls").orderBy("df", "token")) - 1
    ranked = elements.join(often, "token").withColumn("pos", place)
    prefix = ranked.where((den * (F.col("n") - F.col("pos")) >= num * F.col("n")) & (F.col("df") > 1)).select("token", "cls", "n", "pos")
    prefix = prefix.join(members, "cls").join(one_text.select("cls", "bits"), "cls")
    prefix = stage(prefix, "prefixes")
    kinds = prefix.select("token", "n", "pos").distinct()
    x, y = (kinds.select("token", F.col("n").alias(f"n{i}"), F.col("pos").alias(f"pos{i}")) for i in (1, 2))
    room = F.least(F.col("n1") - F.col("pos1"), F.col("n2") - F.col("pos2"))
    fit = (F.col("n1") <= F.col("n2")) & (den * F.col("n1") >= num * F.col("n2")) & ((den + num) * room >= num * (F.col("n1") + F.col("n2")))
    near = x.join(y, "token").where(fit)
    one, two = (prefix.select("token", F.col("n").alias(f"n{i}"), F.col("pos").alias(f"pos{i}"), F.col("cls").alias(c), F.col("comp").alias(f"comp{i}"), F.col("bits").alias(f"bits{i}")) for i, c in ((1, "a"), (2, "b")))
    pairs = near.join(one, ["token", "n1", "pos1"]).join(two, ["token", "n2", "pos2"])
    pairs = pairs.where((F.col("comp1") != F.col("comp2")) & _differ_little(t, F.col("n1"), F.col("n2"), F.col("bits1"), F.col("bits2")))
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
