"""Benchmark decontamination by winnowing, in DataFrame functions only.

Of the k-word hashes in each sliding window the least one is kept as a fingerprint.  With k + window - 1 = m every
shared run of m words and more holds a common fingerprint, on both sides at the same place of the run.  Documents and
benchmark meet on fingerprints; each hit is extended to the benchmark windows around it, word by word.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from fieldbook.session import stage

#: everything but digits, a-z and non-ASCII (A-Z is lower-cased before)
SEPARATORS = "".join(map(chr, [*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]))
SPLIT = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: a fingerprint's low bits hold its place (a text has fewer words than 2**30), the others its hash
PLACE_BITS = 30
#: broadcast tables of up to this many rows, shuffle beyond
BROADCAST_ROWS = 200_000


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """Lower-cased words; none for null."""
    core = F.btrim(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit(SEPARATORS))
    return let(core, lambda t: F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, SPLIT)))


def fingerprints(tokens: Column, k: int, window: int) -> Column:
    """Packed hash and place of the least k-word hash of each window (shorter windows at the end)."""

    def grams(h: Column) -> Column:
        one = lambda i: F.xxhash64(*(h[i + j] for j in range(k))).bitwiseAND(F.lit(-1 << PLACE_BITS)).bitwiseOR(i.cast("long"))
        return F.when(F.size(h) >= k, F.transform(F.sequence(F.lit(0), F.size(h) - k), one)).otherwise(F.array().cast("array<bigint>"))

    def least(g: Column, have: int) -> Column:
        if have == window:
            return F.array_distinct(g)
        step = min(have, window - have)
        return let(F.transform(g, lambda x, i: F.least(x, F.get(g, i + step))), lambda nxt: least(nxt, have + step))

    return let(F.transform(tokens, lambda w: F.xxhash64(w)), lambda h: let(grams(h), lambda g: least(g, 1)))


def _bounded(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def _unpacked(df: DataFrame, name: str) -> DataFrame:
    mask = (1 << PLACE_BITS) - 1
    return df.select("*", F.shiftright("fp", PLACE_BITS).alias("code"), F.col("fp").bitwiseAND(F.lit(mask)).cast("int").alias(name)).drop("fp")


def occurrences(docs: DataFrame, benchmark: DataFrame, window: int = 13) -> tuple[DataFrame, DataFrame]:
    """Where windows of benchmark items stand in texts: ``(th, bytes, start, length, cls)`` by text, and ``(cls, item_id)``."""
    items = benchmark.select("item_id", words(F.col("text")).alias("iw")).where(F.size("iw") > 0).withColumn("cls", F.xxhash64("iw"))
    items = stage(items, "items")
    texts = items.select("cls", "iw").dropDuplicates(["cls"])
    sizes = [r[0] for r in items.select(F.least(F.size("iw"), F.lit(window)).alias("n")).distinct().collect()]  # at most `window` rows
    found = None
    base = docs.select(F.xxhash64("text").alias("th"), F.octet_length("text").alias("bytes"), words(F.col("text")).alias("dw"))
    levels = sorted({max(m for m in (window, 7, 3, 1) if m <= n) for n in sizes})
    for m, above in zip(levels, [*levels[1:], None][: len(levels)], strict=True):
        k = (m + 1) // 2
        of_level = texts.where(F.least(F.size("iw"), F.lit(window)) >= m)
        if above:
            of_level = of_level.where(F.least(F.size("iw"), F.lit(window)) < above)
        marks = _unpacked(of_level.select("cls", F.explode(fingerprints(F.col("iw"), k, m - k + 1)).alias("fp")), "q")
        marks = stage(marks, "marks")
        seen = _unpacked(base.select("th", "bytes", F.explode(fingerprints(F.col("dw"), k, m - k + 1)).alias("fp")), "p")
        met = seen.join(_bounded(marks, marks.count()), "code").select("th", "bytes", "p", "cls", "q", F.lit(k).alias("k"))
        found = met if found is None else found.union(met)
    if found is None:
        empty = docs.select(F.xxhash64("text").alias("th"), F.octet_length("text").alias("bytes"), F.lit(0).alias("start"), F.lit(0).alias("length"), F.lit(0).cast("long").alias("cls"))
        return empty.where("false"), items.select("cls", "item_id")
    found = stage(found.distinct(), "hits")
    asked = stage(found.select("th", "bytes").distinct(), "hit_texts")
    n_asked = asked.count()
    hit_words = base.join(_bounded(asked, n_asked), ["th", "bytes"], "left_semi").dropDuplicates(["th", "bytes"])
    both = found.join(hit_words, ["th", "bytes"]).join(_bounded(texts, texts.count()), "cls")
    length = F.least(F.size("iw"), F.lit(window))
    low = F.greatest(F.lit(0), F.col("q") + F.col("k") - length, F.col("q") - F.col("p"))
    high = F.least(F.col("q"), F.size("iw") - length, F.size("dw") - length - F.col("p") + F.col("q"))
    both = both.withColumns({"length": length, "low": low, "high": high}).where("low <= high")
    each = both.withColumn("j", F.explode(F.sequence("low", "high"))).withColumn("start", F.col("p") - F.col("q") + F.col("j"))
    same = F.slice("dw", F.col("start") + 1, F.col("length")) == F.slice("iw", F.col("j") + 1, F.col("length"))
    return stage(each.where(same).select("th", "bytes", "start", "length", "cls").distinct(), "windows"), items.select("cls", "item_id")


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 13, one_in: int = 20) -> DataFrame:
    """Per row of ``docs(doc_id, text)``: ``doc_id, n_words, n_hit, n_items, items, contaminated``.

    ``benchmark(item_id, text)``: a window is ``window`` consecutive words of an item, or the whole of a shorter item.
    Words inside an occurrence are hit; ``items`` are the ids, as text, sorted, of the items with an occurring window;
    contaminated: some word is hit, and at least one in ``one_in``.

    Null or wordless texts have no words and are clean; such items have no window.  An item without an id marks words
    but is not listed.  Equal texts are looked at once, so repeated rows give repeated results; ids do not matter for
    the search.  Empty documents give an empty table, an empty benchmark only clean documents.  Other columns are
    ignored.
    """
    hits, items = occurrences(docs, benchmark, window)
    by_text = Window.partitionBy("th", "bytes").orderBy("start", "length").rowsBetween(Window.unboundedPreceding, -1)
    spans = hits.select("th", "bytes", "start", "length").distinct()
    fresh = F.greatest(F.lit(0), F.col("start") + F.col("length") - F.greatest("start", F.coalesce(F.max(F.col("start") + F.col("length")).over(by_text), F.lit(0))))
    hit = spans.withColumn("fresh", fresh).groupBy("th", "bytes").agg(F.sum("fresh").alias("n_hit"))
    listed = hits.select("th", "bytes", "cls").distinct().join(items.where("item_id is not null").distinct(), "cls")
    listed = listed.groupBy("th", "bytes").agg(F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    marked = hit.join(listed, ["th", "bytes"], "left")
    rows = docs.select("doc_id", F.xxhash64("text").alias("th"), F.octet_length("text").alias("bytes"), F.size(words(F.col("text"))).cast("long").alias("n_words"))
    out = rows.join(marked, ["th", "bytes"], "left")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    names = F.coalesce("items", F.array().cast("array<string>"))
    return out.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size(names).cast("long").alias("n_items"), names.alias("items"), ((n_hit > 0) & (one_in * n_hit >= F.col("n_words"))).alias("contaminated"))
