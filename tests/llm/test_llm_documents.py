"""Document operators against brute force on small, awkward tables."""

import collections
import hashlib
import math
import random
import re
import time
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
import public_tokenizers
import tiktoken
from pyspark.sql import functions as F

from fieldbook.llm import bpe, jaccard, langid, linededup, substring, suffixtree, textbytes, winnow
from fieldbook.session import stage

SCHEMA = "doc_id long, text string, lang string, keep int, score string, cls string, th int"
WHITE = " \t\n\x0b\x0c\r"


def low(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", low(text))


def sentence(rng, n, pool=400):
    return " ".join(f"w{rng.randrange(pool)}" for _ in range(n))


@pytest.fixture(scope="module")
def awkward(spark):
    """Nulls, empty and long texts, copies, near copies around the threshold, shared lines, repeated rows."""
    rng = random.Random(3)
    base = sentence(rng, 120).split()
    texts = [None, "", "   \n\t ", "one", "One two THREE", "one  two\nthree", "É é ÉÉ", "a b c d", "A B\tC D", "\n\n", "x" * 5000, sentence(rng, 6000)]
    for edits in [0, 0, 1, 1, 2, 2, 3, 3, 4, 5, 6] * 4:  # a group whose members are alike to different degrees
        copy = list(base)
        for at in rng.sample(range(len(copy)), edits):
            copy[at] = f"e{rng.randrange(10**6)}"
        texts.append(" ".join(copy))
    for n in range(2, 26):  # small sets, and the same less or more a word
        text = sentence(rng, n, 10**6)
        texts += [text, text + " more", text.replace(" ", "\t"), " ".join(text.split()[1:])]
    line = "This line stands in many documents, Word for word."
    for i in range(12):
        texts.append("\n".join([sentence(rng, 5), line if i % 2 else f"  {line.upper()}\t", sentence(rng, 4), line]))
    texts += [f"{line}\nshort\nshort", "short", "short", f"é{'ü' * 19}\né", f"É{'ü' * 19}", f"é{'ü' * 19}", f"  é{'ü' * 19}"]
    rows = [(i * 3, t, "en", 1, "s", "c", 2) for i, t in enumerate(texts)] + [(None, line, None, 1, None, None, None), (None, None, None, None, None, None, None)]
    rows += [r for r in rows if r[0] in (36, 39, 300)]  # repeated rows
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def brute_components(rows, k, percent):
    sets = {}
    for i, t in rows:
        w = words(t)
        sets[i] = frozenset(tuple(w[j : j + k]) for j in range(max(1, len(w) - k + 1))) if w else frozenset()
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


@pytest.mark.parametrize(("k", "percent"), [(4, 85), (5, 80)])
def test_jaccard_components(awkward, k, percent):
    got = {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard.jaccard_components(awkward, k, percent).collect() if r["doc_id"] is not None}
    want = brute_components([(r["doc_id"], r["text"]) for r in awkward.collect() if r["doc_id"] is not None], k, percent)
    assert got == {(i, n, c) for i, (n, c) in want.items()}


def test_jaccard_rows_and_empty(awkward, nothing):
    assert jaccard.jaccard_components(awkward).count() == awkward.count()
    assert jaccard.jaccard_components(nothing).collect() == []


def test_jaccard_group_just_below_the_threshold(spark, monkeypatch):
    """Members that differ by a bit too much share lists but no link; only the pairs planted in it link."""
    monkeypatch.setattr(jaccard, "STAR_ROUNDS", 1)
    rng = random.Random(5)
    base = sentence(rng, 150, 10**6).split()
    texts = []
    for i in range(60):
        copy = list(base)
        for at in rng.sample(range(len(copy)), 4):
            copy[at] = f"e{rng.randrange(10**6)}"
        texts.append(" ".join(copy))
        if i % 10 == 0:
            texts.append(" ".join([*copy[:-1], "other"]))
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.jaccard_components(docs, 4, 85).collect()}
    assert got == brute_components(rows, 4, 85)
    assert len({c for _, c in got.values()}) == 60


def test_boundary_is_by_cost():
    from fractions import Fraction

    t = Fraction(85, 100)
    assert jaccard.choose_boundary({5: 1000, 30: 1}, t) >= 5
    assert jaccard.choose_boundary({20: 10**6}, t) < 20  # 1,351 subsets are dearer than lists


def brute_lines(rows, least, docs):
    held = collections.defaultdict(set)
    for i, t in rows:
        for x in (t or "").split("\n"):
            key = low(x.strip(WHITE))
            if len(key) >= least:
                held[key].add(i)
    out = {}
    for i, t in rows:
        lines = (t or "").split("\n")
        keys = [low(x.strip(WHITE)) for x in lines]
        kept = [x for x, k in zip(lines, keys) if not (len(held.get(k, ())) >= docs and max(held[k]) != i)]
        out[i] = (len(lines), len(lines) - len(kept), "\n".join(kept))
    return out


def test_line_dedup(awkward):
    docs = awkward.where("doc_id is not null")
    got = {r["doc_id"]: (r["n_lines"], r["n_dropped"], r["kept_text"] or "") for r in linededup.apply_bitmaps(docs, linededup.keep_bitmaps(docs)).collect()}
    assert got == brute_lines([(r["doc_id"], r["text"]) for r in docs.collect()], 20, 3)


def test_line_dedup_keeps_other_columns_and_rows(awkward, nothing):
    out = linededup.apply_bitmaps(awkward, linededup.keep_bitmaps(awkward))
    assert out.count() == awkward.count() and {"lang", "cls", "score"} <= set(out.columns)
    assert linededup.apply_bitmaps(nothing, linededup.keep_bitmaps(nothing)).collect() == []


def test_hot_line_over_many_tasks(spark):
    """One line in every document, dealt by range to several tasks, stays once."""
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat(F.lit("the very same line of text\nown "), F.col("id").cast("string")).alias("text"))
    kept = linededup.apply_bitmaps(docs, linededup.keep_bitmaps(docs)).where("n_dropped = 0").collect()
    assert [r["doc_id"] for r in kept] == [2999]


def brute_contamination(docs, items, window=13):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low(t))
    windows = collections.defaultdict(set)
    for i, t in items:
        w = split(t)
        n = min(window, len(w))
        for j in range(len(w) - n + 1 if n else 0):
            windows[tuple(w[j : j + n])].add(i)
    out = {}
    for i, t in docs:
        w, hit, found = split(t), set(), set()
        for n in {len(x) for x in windows}:
            for j in range(len(w) - n + 1):
                if tuple(w[j : j + n]) in windows:
                    hit.update(range(j, j + n))
                    found |= {x for x in windows[tuple(w[j : j + n])] if x is not None}
        out[i] = (len(w), len(hit), sorted(map(str, found)), bool(hit) and 20 * len(hit) >= len(w))
    return out


def test_contamination(spark):
    rng = random.Random(9)
    items = [(i, sentence(rng, n, 60)) for i, n in enumerate([40, 14, 13, 12, 9, 7, 6, 3, 2, 1, 30])]
    items += [(50, None), (51, "!!"), (None, items[0][1]), (52, items[0][1]), (53, items[1][1].upper()), (2, items[2][1])]
    docs = [(0, None), (1, ""), (2, "..."), (3, sentence(rng, 300, 60)), (4, sentence(rng, 5000, 9))]
    for i, (_, t) in enumerate(items[:11]):
        w = t.split()
        at = rng.randrange(max(1, len(w) - 13))
        docs.append((10 + i, f"{sentence(rng, 30, 10**6)} {', '.join(w[at : at + 13 + i])}. {sentence(rng, rng.choice([5, 300, 600]), 10**6)}"))
        docs.append((30 + i, " ".join(w[:12])))
    docs.append(docs[-1])
    d = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, n_hit int, items string").repartition(3)
    b = spark.createDataFrame(items, "item_id long, text string")
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], r["items"], r["contaminated"]) for r in winnow.contamination(d, b).collect()}
    assert got == brute_contamination(docs, items)
    assert winnow.contamination(d.limit(0), b).collect() == []
    assert {r["contaminated"] for r in winnow.contamination(d, b.limit(0)).collect()} == {False}


def test_contamination_runs_no_python(spark):
    d = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    plan = winnow.contamination(d, d.withColumnRenamed("doc_id", "item_id"))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


@pytest.fixture(scope="module")
def ranks():
    return bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))


@pytest.fixture(scope="module")
def tokenizer(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_like_the_library(spark, awkward, nothing, ranks, tokenizer):
    odd = ["<|endoftext|>", "a\x1cb\x85c\u2003d\u200be", "日本語 テキスト١٢٣ ²Ⅷ", "'s'LL don't", "ab" * 4000, "é" * 3000, "\r\n\r\n  x", "\U0001F600" * 50, "\x00\x01"]
    docs = awkward.select("doc_id", "text").union(spark.createDataFrame(list(enumerate(odd, 10_000)), "doc_id long, text string"))
    out = bpe.decode(bpe.encode(docs, ranks, public_tokenizers.PATTERN), ranks).collect()
    both = bpe.encode(docs, ranks, public_tokenizers.PATTERN, decoded=True).collect()
    assert sorted(map(str, both)) == sorted(map(str, out))
    want = collections.Counter((r["doc_id"], tuple(tokenizer.encode_ordinary(r["text"] or "")), (r["text"] or "").encode()) for r in docs.collect())
    assert collections.Counter((r["doc_id"], tuple(r["ids"]), bytes(r["decoded"])) for r in out) == want
    assert bpe.decode(bpe.encode(nothing, ranks, public_tokenizers.PATTERN), ranks).collect() == []


def test_bpe_merges_like_the_library(ranks, tokenizer):
    rng = random.Random(2)
    for _ in range(300):
        text = "".join(rng.choice("aeinrstth lou") for _ in range(rng.randrange(1, 200))).strip() or "a"
        text = text.replace(" ", "")
        assert bpe.merge(text.encode(), ranks) == tokenizer.encode_ordinary(text)


def test_bpe_decode_of_nulls_and_unknown_ids(spark, ranks):
    got = bpe.decode(spark.createDataFrame([(1, None), (2, []), (3, [0, 1])], "doc_id long, ids array<int>"), ranks).collect()
    assert [bytes(r["decoded"]) for r in got][:2] == [b"", b""]
    with pytest.raises(Exception, match="vocabulary"):
        bpe.decode(spark.createDataFrame([(1, [60_000])], "doc_id long, ids array<int>"), ranks).collect()


def test_language_id(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    net = langid.learn(docs, langid.Settings(epochs=6))
    out = langid.tag(docs.withColumn("held", langid.held_out(F.col("doc_id"))), net).where("held").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in out]) > 0.95
    odd = spark.createDataFrame([(1, None, 5), (2, "", 5), (3, "12 !?", 5), (4, "the " * 40_000, 5), (None, "the thing that", 5), (4, "the " * 40_000, 5)], "doc_id long, text string, lang_pred int")
    got = langid.tag(odd, net).collect()
    assert [r["lang_pred"] for r in got][:3] == ["und"] * 3 and {r["score"] for r in got[:3]} == {0.0}
    assert got[3]["lang_pred"] == "en" and got[3] == got[5] and 0 < got[3]["score"] <= 1
    assert langid.tag(odd.limit(0), net).collect() == []
    assert langid.learn(docs.limit(0)) is None and {r["lang_pred"] for r in langid.tag(odd, None).collect()} == {"und"}


def test_language_learns_only_from_its_part(spark):
    rows = [(i, "aaa bbb" if i % 2 else "ccc ddd", "x" if i % 2 else "y") for i in range(60)]
    held = [i for i in range(60) if zlib.crc32(str(i).encode()) % 3 == 1]
    rows = [(i, t, "secret" if i in held else lang) for i, t, lang in rows] + [(None, "zzz", "nameless"), (100, "zzz", None)]
    net = langid.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"), langid.Settings(epochs=1))
    assert net.languages == ["x", "y"]


def test_suffix_tree_scores(spark, awkward):
    docs = awkward.where("doc_id is not null")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    count = collections.Counter()
    for i, t in rows:
        if zlib.crc32(str(i).encode()) % 5 != 1:
            count.update([*words(t), "\n"])
    n, v = sum(count.values()), len(count)
    got = {r["doc_id"]: r for r in suffixtree.scores(docs).collect()}
    for i, t in rows:
        tokens = [*words(t), "\n"]
        r = got[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(tokens), sum(count[x] > 0 for x in tokens), n)
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 1)
        assert r["base_score"] == pytest.approx(sum(np.log10((count[x] + 0.5) / (n + 0.5 * (v + 1))) for x in tokens))
        assert np.isfinite(r["score"]) and r["score"] < 0


def test_suffix_tree_nulls_and_empty(spark, awkward, nothing):
    assert suffixtree.scores(nothing).collect() == []
    assert suffixtree.scores(awkward).count() == awkward.count()
    got = suffixtree.scores(spark.createDataFrame([(None, None), (None, "a b")], "doc_id long, text string")).collect()
    assert [(r["n_tokens"], r["train_tokens"], r["base_score"]) for r in sorted(got, key=lambda r: r["n_tokens"])] == [(1, 0, 0.0), (3, 0, 0.0)]


def plain_tree(texts, depth, least, divergence):
    """Probability of ``symbol`` after ``past`` (latest first) in a suffix tree of dictionaries."""
    follow = collections.defaultdict(collections.Counter)
    for t in texts:
        past = b"\n" * depth
        for symbol in "".join(w + " " for w in words(t)).encode() + b"\n":
            for d in range(depth + 1):
                follow[past[:d]][symbol] += 1
            past = bytes([symbol]) + past[:-1]
    total, states = sum(follow[b""].values()), set()

    def chance(symbol, past):
        at = next((past[:d] for d in range(len(past), 0, -1) if past[:d] in states), b"")
        if not at:
            return (follow[b""][symbol] + 0.5) / (total + 128)
        n = follow[at]
        return (n[symbol] + len(n) * chance(symbol, at[:-1])) / (n.total() + len(n))

    for context in sorted(follow, key=len)[1:]:
        n = follow[context]
        gain = sum(k * (math.log(k / n.total()) - math.log(chance(x, context[:-1]))) for x, k in n.items())
        if n.total() >= least and gain > divergence * len(n):
            states.add(context)
    return chance, states


def test_suffix_tree_against_dictionaries(spark):
    """Tables of a small corpus: every string's probability, the states, and scores of known and unknown words."""
    rng = random.Random(4)
    rows = [(i, sentence(rng, rng.randrange(60), 25) + " abc Abd é" * rng.randrange(4)) for i in range(60)] + [(60, None), (61, ""), (62, "new words xyz")]
    train = [t for i, t in rows if zlib.crc32(str(i).encode()) % 5 != 1]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for depth in (3, 7):
        s = suffixtree.Settings(depth=depth)
        chance, states = plain_tree(train, depth, s.least, s.divergence)
        assert {len(x) for x in states} >= {1, 2}
        counted = stage(suffixtree.counts(docs.withColumn("held_out", suffixtree.held_out(F.col("doc_id"))), s), "counts")
        t = suffixtree.totals(counted, s)
        tree = suffixtree.grow(counted.where("kind = 0"), t.symbols, s).collect()
        assert len(tree) == counted.where("kind = 0").count()
        for r in tree:
            key = (r["key"] % 2**64).to_bytes(8, "big")
            past = key[1 : depth + 1]
            assert r["p"] == pytest.approx(chance(key[0], past), rel=1e-9)
            assert r["state"] == next((d for d in range(depth, 0, -1) if past[:d] in states), 0)
        seen = collections.Counter(w for x in train for w in [*words(x), "\n"])
        other = (t.once + 0.5) / (t.tokens + 0.5)
        got = {r["doc_id"]: r for r in suffixtree.scores(docs, s).collect()}
        for i, text in rows:
            past, score, spelled = b"\n" * depth, 0.0, 0.0
            for token in [*words(text), "\n"]:
                spelling = 1.0
                for symbol in (token if token == "\n" else token + " ").encode():
                    spelling *= chance(symbol, past)
                    past = bytes([symbol]) + past[:-1]
                known = (1 - other) * (s.weight * spelling + (1 - s.weight) * seen[token] / t.tokens)
                score += math.log10(known if seen[token] else other)
                spelled += math.log10(known if seen[token] else other * spelling)
            assert got[i]["score"] == pytest.approx(score, rel=1e-5)
            assert got[i]["spelled_score"] == pytest.approx(spelled, rel=1e-5)
    past = b"w 1"
    assert sum(chance(b, past) for b in range(256)) == pytest.approx(1)


def test_suffix_tree_grows(spark):
    """Twice the corpus has more states: nothing is cut by its share."""
    rng = random.Random(8)
    s = suffixtree.Settings()
    sizes = []
    rows = [(i, sentence(rng, 80, 10**4), False) for i in range(400)]
    for n in (100, 200, 400):
        counted = stage(suffixtree.counts(spark.createDataFrame(rows[:n], "doc_id long, text string, held_out boolean"), s), "counts").where("kind = 0")
        tree = suffixtree.grow(counted, counted.agg(F.sum("n")).first()[0], s)
        sizes.append(tree.where("state > 0").select(F.expr("shiftleft(key, 8)"), "state").distinct().count())
    assert sizes[0] * 1.2 < sizes[1] and sizes[1] * 1.2 < sizes[2]


def test_suffix_tree_counts_in_little_memory():
    """A task counts 12 MB of text that hardly repeats a string within 256 MB (370 MB once)."""
    rng = np.random.default_rng(5)
    letters = np.frombuffer(b"abcdefghijklmnopqrstuvwxyz ", dtype=np.uint8)
    texts = [[rng.choice(letters, 4096).tobytes().decode() for _ in range(64)] for _ in range(48)]
    batches = [pa.RecordBatch.from_arrays([pa.array(t), pa.array([i % 4 == 0] * 64)], ["text", "held_out"]) for i, t in enumerate(texts)]
    tracemalloc.start()
    for _ in suffixtree._counted(suffixtree.Settings())(iter(batches)):
        pass
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 256e6


def test_suffix_tree_symbols_of_every_text_type():
    texts = [b"a B", None, b"", b" \x0b\xc3\xa9\tx", b"\n", b"y \n"]
    plain = [" ".join(words(t.decode())) + " " if t and words(t.decode()) else "" for t in (t or b"" for t in texts)]
    for kind in (pa.string(), pa.large_string(), pa.binary(), pa.large_binary()):
        symbols, at, hashes, row = suffixtree.spelled(pa.RecordBatch.from_arrays([pa.array(texts, pa.binary()).cast(kind)], ["text"]))
        assert symbols.tobytes().decode() == "".join(t + "\n" for t in plain)
        assert row.tolist() == [0, 0, 0, 1, 2, 3, 3, 3, 4, 5, 5] and (hashes == suffixtree.END).tolist() == [bool(symbols[i] == 10) for i in at]


def test_suffix_tree_strings_by_way_of_buckets():
    """Keys and numbers that are dealt come back whole, and a dictionary tells those that it lacks."""
    rng = np.random.default_rng(6)
    for size in (1, 2, 5000):
        keys = np.unique(rng.integers(0, 1 << 56, size, dtype=np.uint64)) << np.uint64(8)
        n = rng.integers(0, 1 << 40, len(keys))
        for kind in (0, 1):
            found, buckets = {}, []
            for batch in suffixtree._dealt(kind, keys, n, 7, 3):
                for bucket, block, m, blob in zip(*(batch.column(c).to_pylist() for c in ("bucket", "block", "n")), batch.column("blob"), strict=True):
                    found |= dict(zip(*(x.tolist() for x in suffixtree._restored(blob.as_buffer(), m, 2)), strict=True))
                    buckets.append((bucket, block))
            assert found == dict(zip(keys.tolist(), n.tolist(), strict=True))
            assert len(set(buckets)) == len(buckets) and {(b & 1, k) for b, k in buckets} == {(kind, 3)}
        own = suffixtree._Dictionary()
        own.parts[1].append((keys, n))
        own.sort()
        asked = np.concatenate((keys[::-1], keys + np.uint64(1), np.zeros(1, np.uint64)))
        assert own.counts(asked).tolist() == [dict(zip(keys.tolist(), n.tolist(), strict=True)).get(k, 0) for k in asked.tolist()]
        with pytest.raises(ValueError, match="without"):
            own.logs(keys)


def test_suffix_tree_beats_the_base_on_held_out(spark, sf_dir):
    out = suffixtree.scores(spark.read.parquet(f"{sf_dir}/documents.parquet")).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert out[0] > out[1]


def test_passages(spark):
    rng = random.Random(6)
    passage = sentence(rng, 55, 10**6).split()
    fuzzy = sentence(rng, 90, 10**6).split()
    rows, spans = [], {}
    for i in range(20):
        head, tail = sentence(rng, rng.randrange(10, 80), 10**6), sentence(rng, 40, 10**6)
        body, kind = "", i % 4
        if kind == 0:
            body = " ".join(passage).upper()
            spans[i] = (len(head.split()), len(head.split()) + 55)
        elif kind == 1:
            copy = list(fuzzy)
            copy[30] = f"edit{i}"
            copy[60:61] = [f"more{i}", "words"]
            body = " ".join(copy)
        elif kind == 2:
            body = " ".join(passage[:20])  # too short
        rows.append((i, f"{head} {body} {tail}", 1))
    rows += [(100, rows[3][1], 1), (101, rows[3][1].replace(" ", "\n"), 1), (102, None, 1), (103, "", 1), (104, "short text", 1), (105, "short text", 1), (100, rows[3][1], 1), (None, rows[3][1], 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, cls int").repartition(4)
    got = substring.repeated_passages(docs).collect()
    exact = {r["doc_id"]: (r["start_word"], r["end_word"]) for r in got if r["doc_id"] in spans and r["doc_id"] < 100}
    assert exact == {i: s for i, s in spans.items() if i}
    assert {r["doc_id"] for r in got if r["doc_id"] is not None and r["doc_id"] % 4 == 1 and r["doc_id"] < 100} == {5, 9, 13, 17}
    assert all(r["end_word"] - r["start_word"] >= 90 for r in got if r["doc_id"] in (5, 9, 13, 17))
    assert {(r["doc_id"], r["other_id"]) for r in got if r["doc_id"] is None or r["doc_id"] >= 100} == {(100, 3), (101, 3), (None, 3)}
    assert not any(i in (2, 6, 7, 10, 11) for r in got for i in (r["doc_id"], r["other_id"]))
    assert substring.repeated_passages(docs.limit(0)).collect() == []


def test_chains_against_all_predecessors():
    """The Fenwick tree finds the same best chain score as trying every predecessor."""
    s = substring.Settings()
    rng = np.random.default_rng(1)
    for _ in range(30):
        pairs = sorted({(int(a), int(b)) for a, b in rng.integers(0, 60, (40, 2))})
        i, j = (np.array(x) for x in zip(*pairs))
        best = []
        for x in range(len(i)):
            gains = [best[y] - s.gap_cost * (i[x] - i[y] + j[x] - j[y]) for y in range(x) if i[y] < i[x] and j[y] < j[x]]
            best.append(s.k + max([0.0, *gains]))
        chain = substring.chains(i, j, s)[0]
        worth = s.k * len(chain) - s.gap_cost * (chain[-1][0] - chain[0][0] + chain[-1][1] - chain[0][1])
        assert worth == pytest.approx(max(best))
        assert all(a[0] < b[0] and a[1] < b[1] for a, b in zip(chain, chain[1:]))


def test_passage_whose_parts_stand_alone_elsewhere(spark):
    """Both halves of a passage have other firsts and predecessors in their lists; the whole is found nevertheless."""
    rng = random.Random(8)
    rows, wanted = [], set()
    for case in range(12):
        left, right = (sentence(rng, rng.randrange(30, 50), 10**6) for _ in range(2))
        own = lambda: sentence(rng, 40, 10**6)
        for i, body in ((1, left), (2, right), (100, f"{left} {right}"), (150, left), (151, right), (200, f"{left} {right}")):
            rows.append((case * 1000 + i, f"{own()} {body} {own()}"))
        wanted.add((case * 1000 + 200, case * 1000 + 100, 40, 40 + len(f"{left} {right}".split())))
    got = substring.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert {(r["doc_id"], r["other_id"], r["start_word"], r["end_word"]) for r in got} == wanted


def test_near_passage_whose_seeds_have_other_firsts_and_predecessors(spark):
    """Every seed of a passage stands in other documents before and between the two that share it nearly; the pair is found nevertheless."""
    rng = random.Random(12)
    own = lambda n: sentence(rng, n, 10**6)
    passage = sentence(rng, 60, 10**6).split()
    copy = list(passage)
    copy[7::8] = [f"changed{i}" for i in range(len(copy[7::8]))]
    parts = [" ".join(passage[i : i + 7]) for i in range(0, 60, 8)]
    # documents with single pieces: one before both, one between them
    rows = [(i, f"{own(30)} {part} {own(30)}") for i, part in enumerate(parts)]
    rows += [(200 + i, f"{own(30)} {part} {own(30)}") for i, part in enumerate(parts)]
    rows += [(100, f"{own(40)} {' '.join(passage)} {own(40)}"), (300, f"{own(40)} {' '.join(copy)} {own(40)}")]
    got = substring.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert {(r["doc_id"], r["other_id"]) for r in got} == {(300, 100)}


def test_all_pairs_of_long_and_short_lists(spark, monkeypatch):
    """Lists of any length, with repeated members, cut over tasks and batches: pairs and their counts by brute force."""
    monkeypatch.setattr(substring, "PART", 40)
    rng = random.Random(3)
    lists = {seed: [rng.randrange(-300, 300) for _ in range(size)] for seed, size in enumerate([1, 2, 31, 32, 33, 34, 200, 201, 3, 0, 150])}
    want = {}
    for members in lists.values():
        members = sorted(set(members))
        for x, a in enumerate(members):
            for b in members[x + 1 :]:
                want[a, b] = want.get((a, b), 0) + 1
    rows = [(seed, cls) for seed, members in lists.items() for cls in members]
    rng.shuffle(rows)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "17")
    try:
        got = substring._met(spark.createDataFrame(rows, "seed long, cls long"), "lists").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert {(r["a"], r["b"]): r["n"] for r in got} == want and len(got) == len(want)


def test_passage_of_repeated_words(spark):
    """A run of 50 words that holds fewer different seeds than make a pair."""
    rng = random.Random(4)
    rows = [(i, f"{sentence(rng, 40, 10**6)} {' '.join(['ha', 'ho'] * 30)} {sentence(rng, 40, 10**6)}") for i in range(3)]
    got = substring.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r["doc_id"], r["other_id"]) for r in got} == {(1, 0), (2, 0), (2, 1)}


def test_worker_memory_of_words_and_languages():
    """Arrays that a worker holds at once are small multiples of the text; parts of a batch score as the whole does."""
    rng = np.random.default_rng(9)
    net = langid.train([rng.bytes(200) for _ in range(40)], ["a", "b"] * 20, langid.Settings(epochs=1))
    texts = pa.array(["".join(chr(c) for c in rng.integers(32, 120, 600)) for _ in range(3000)])
    rows = pa.RecordBatch.from_arrays([pa.array(range(3000)), texts, pa.array([True] * 3000)], ["doc_id", "text", "has_letter"])
    whole = []
    for batch in textbytes.chunks([rows], "text", langid.STEP):
        data, _, _ = langid.padded(*textbytes.text_buffer(batch.column("text")))
        whole.append(langid.logits(net, data))
    parts, step = [], langid.PART // langid.WINDOW
    for batch in textbytes.chunks([rows], "text", langid.STEP):
        data, row, _ = langid.padded(*textbytes.text_buffer(batch.column("text")))
        for lo in range(0, len(row), step):
            hi = min(lo + step, len(row))
            parts.append(langid.logits(net, data[lo * langid.WINDOW : hi * langid.WINDOW + langid.WIDTHS[-1]]))
    np.testing.assert_allclose(np.concatenate(parts), np.concatenate(whole), rtol=1e-5, atol=1e-6)
    textbytes._powers.clear()
    tracemalloc.start()
    for batch in langid._tagged(net, ["doc_id"])([rows]):
        assert batch.num_rows
    for batch in textbytes.chunks([rows], "text"):
        textbytes.word_hashes(*textbytes.text_buffer(batch.column("text")))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40 << 20


def test_every_word_for_word_run_is_covered():
    """Words of ``y`` in a run of 50 that ``x`` has too are in a passage, also in texts that repeat themselves."""
    rng = np.random.default_rng(5)
    s = substring.Settings()
    for _ in range(40):
        parts = [rng.integers(0, 10**6, rng.integers(1, 70)).astype(np.uint32) for _ in range(6)] + [np.full(rng.integers(1, 200), 7, np.uint32)]
        x, y = (np.concatenate([parts[i] for i in rng.integers(0, 7, n)]) for n in (5, 20))
        have = {x[i : i + 50].tobytes() for i in range(len(x) - 49)}
        want = {w for j in range(len(y) - 49) if y[j : j + 50].tobytes() in have for w in range(j, j + 50)}
        found = substring.passages(x, y, s)
        assert want <= {w for p in found for w in range(p[2], p[3])}
        assert all((x[p[0] : p[1]] == y[p[2] : p[3]]).all() for p in found if p[4] == 1.0)


@pytest.mark.parametrize("m, n", [(1, 70), (5, 13), (9, 40), (70, 1)])
def test_every_copy_within_a_document_is_found(m, n):
    """Near copies (a word changed every 30) of one passage, m in ``x`` and n in ``y``: each place in ``y`` has a partner."""
    rng = np.random.default_rng(m * 100 + n)
    new = lambda size: rng.integers(0, 2**32, size, dtype=np.uint32)
    base = new(90)

    def text(copies):
        parts, spans, at = [new(30)], [], 30
        for _ in range(copies):
            copy = base.copy()
            copy[[29, 59]] = new(2)
            parts += [copy, new(40)]
            spans.append((at, at + 90))
            at += 130
        return np.concatenate(parts), spans

    (x, _), (y, spans) = text(m), text(n)
    found = substring.passages(x, y, substring.Settings())
    for lo, hi in spans:
        assert any(p[2] <= lo and p[3] >= hi for p in found)


@pytest.mark.parametrize("rate, size, least", [(0.05, 55, 1.0), (0.1, 55, 1.0), (0.15, 55, 0.97), (0.18, 55, 0.95), (0.18, 100, 0.97)])
def test_recall_of_near_passages(spark, rate, size, least):
    """Planted passages with random single words changed, identity at least 0.8."""
    rng = random.Random(int(rate * 100) + size)
    rows, planted = [], set()
    for case in range(200):
        passage = sentence(rng, size, 10**6).split()
        copy = list(passage)
        for at in rng.sample(range(size), int(rate * size)):
            copy[at] = f"e{rng.randrange(10**6)}"
        for i, body in ((0, passage), (1, copy)):
            rows.append((2 * case + i, " ".join([sentence(rng, 60, 10**6), *body, sentence(rng, 60, 10**6)])))
        planted.add((2 * case + 1, 2 * case))
    got = substring.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert {(r["doc_id"], r["other_id"]) for r in got} <= planted
    assert all(r["identity"] >= 0.8 and r["end_word"] - r["start_word"] >= 50 for r in got)
    found = len({r["doc_id"] for r in got}) / len(planted)
    print(f"recall at {rate:.0%} changed of {size} words: {found:.3f}")
    assert found >= least


def test_near_passages_with_evenly_spread_changes():
    rng = np.random.default_rng(2)
    new = lambda n: rng.integers(0, 2**32, n, dtype=np.uint32)
    for every, size in ((6, 60), (6, 300), (5, 300), (25, 51)):
        base, copy = new(size), None
        copy = base.copy()
        copy[every - 1 :: every] = new(len(copy[every - 1 :: every]))
        x, y = np.concatenate((new(30), base, new(30))), np.concatenate((new(50), copy, new(20)))
        (found,) = substring.passages(x, y, substring.Settings())
        assert found[3] - found[2] >= min(size, 50) and found[4] >= 0.8
        assert found[2] <= 50 + 5 and found[3] >= 50 + size - 5


def test_pairs_without_a_chance_are_not_chained(spark, monkeypatch):
    """Of documents that share a line of 9 words and one near passage only the pair with the passage is chained, whatever the cell's batches."""
    rng = np.random.default_rng(7)
    s = substring.Settings()
    new = lambda n: rng.integers(0, 2**32, n, dtype=np.uint32)
    line, passage = new(9), new(60)
    copy = passage.copy()
    copy[7::8] = new(len(copy[7::8]))
    texts = {i: np.concatenate((new(70), line, new(70))) for i in range(30)}
    texts[3], texts[11] = np.concatenate((texts[3], passage)), np.concatenate((copy, texts[11]))
    words = pa.RecordBatch.from_arrays([pa.array([0] * 30), pa.array(list(texts), pa.int64()), pa.array([t.tobytes() for t in texts.values()])], ["bucket", "cls", "blob"])
    packs = [p for b in substring._packed([words.slice(0, 7), words.slice(7)]) for p in b.column("pack").to_pylist()]
    a, b = np.array([(x, y) for x in texts for y in texts if x < y]).T
    zero, none = (lambda n: pa.array([0] * n, pa.int64())), (lambda n: pa.nulls(n, pa.int64()))
    names = ["i", "j", "a", "b", "pack"]
    rows = [pa.RecordBatch.from_arrays([zero(1), zero(1), none(1), none(1), pa.array([p])], names) for p in packs]
    rows.append(pa.RecordBatch.from_arrays([zero(len(a)), zero(len(a)), pa.array(a), pa.array(b), pa.nulls(len(a), pa.binary())], names))
    tried, chain = [], substring.passages
    monkeypatch.setattr(substring, "passages", lambda x, y, *rest: tried.append((len(x), len(y))) or chain(x, y, *rest))
    found = [(r["a"], r["b"]) for out in substring._chained(s)(rows) for r in out.to_pylist()]
    assert found == [(3, 11)] and len(tried) == 1


@pytest.mark.parametrize("settings", [{}, {"min_words": 20, "identity": 0.7}, {"min_words": 30, "identity": 0.9}, {"min_words": 12, "most_gap": 6}, {"identity": 1.0}, {"min_words": 5, "identity": 0.5}])
@pytest.mark.parametrize("words", [2, 5, 30, 300, 10**6])
def test_no_pair_with_a_passage_is_left_out(settings, words, monkeypatch):
    """Of documents cut from the same texts, with words changed, added and left out, every pair that chaining finds a passage in is chained."""
    monkeypatch.setattr(substring, "SLICE", 500)
    monkeypatch.setattr(substring, "HELD", 2_000)
    rng = np.random.default_rng(words)
    s = substring.Settings(**settings)
    base = [rng.integers(0, words, rng.integers(5, 200)) for _ in range(4)]
    base.append(base[0].copy())
    base[4][4::5] = rng.integers(0, 10**6, len(base[4][4::5]))

    def text():
        out = []
        for _ in range(rng.integers(1, 4)):
            out += rng.integers(0, words, rng.integers(0, 60)).tolist()
            part = base[rng.integers(5)]
            at, rate = rng.integers(0, len(part)), rng.choice([0, 0.05, 0.1, 0.2, 0.3])
            for w in part[at : at + rng.integers(1, 2 * s.min_words + 2)].tolist():
                kind = rng.integers(3) if rng.random() < rate else 3  # change, add, leave out, keep
                out += [[int(rng.integers(words))], [w, int(rng.integers(words))], [], [w]][kind]
        return np.array(out, dtype=np.uint32)

    texts = {i: t for i, t in enumerate([text() for _ in range(16)]) if len(t) >= s.min_words}
    a, b = np.array([(x, y) for x in texts for y in texts if x < y]).T
    use = substring.hopeful(texts, a, b, s)
    assert not [p for p in zip(a[~use].tolist(), b[~use].tolist(), strict=True) if substring.passages(texts[p[0]], texts[p[1]], s)]


def test_pairs_that_share_a_line_only_are_not_written(spark, monkeypatch):
    """Documents that share a line too short for a passage meet where their texts are; no table holds a row for each two of them."""
    rng = random.Random(21)
    line = sentence(rng, 12, 10**6)
    passage = sentence(rng, 60, 10**6)
    rows = [(i, f"{sentence(rng, 40, 10**6)} {line} {sentence(rng, 20, 10**6)} {passage if i in (30, 250) else ''}") for i in range(300)]
    written, met = [], substring._met
    monkeypatch.setattr(substring, "_met", lambda members, name: written.append(pairs := met(members, name)) or pairs)
    got = substring.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert [(r["doc_id"], r["other_id"]) for r in got] == [(250, 30)]
    assert sum(pairs.count() for pairs in written) < 300


def test_every_two_buckets_meet(spark, monkeypatch):
    """One bucket, or many that meet in several rounds: the same passages, with copies, repeated words and repeated ids."""
    rng = random.Random(22)
    passages = [sentence(rng, 60, 10**6) for _ in range(4)] + [" ".join(["ha", "ho"] * 30)]
    rows = [(rng.randrange(100) if i % 9 else None, f"{sentence(rng, 30, 10**6)} {passages[i % 5]} {sentence(rng, 10 * (i % 3), 10**6)}") for i in range(60)]
    docs = spark.createDataFrame(rows + rows[:4], "doc_id long, text string").repartition(4)
    found = []
    for words in (10**6, 700):  # 1 bucket, about 8
        monkeypatch.setattr(substring, "BUCKET_WORDS", words)
        monkeypatch.setattr(substring, "DISTANCES", 2)
        found.append(collections.Counter(tuple(r) for r in substring.repeated_passages(docs).collect()))
    assert found[0] == found[1] and len(found[0]) > 200


def test_matched_pairs_against_brute_force(monkeypatch):
    """Documents matched among themselves and with others, seeds in common counted, long lists and long documents in pieces."""
    rng = np.random.default_rng(23)
    monkeypatch.setattr(substring, "SLICE", 300)
    monkeypatch.setattr(substring, "HELD", 400)
    s = substring.Settings(min_words=20)
    base = [rng.integers(0, 10**6, 40) for _ in range(3)]
    texts = [np.concatenate((rng.integers(0, 40, rng.integers(0, 300)), base[i % 3][: rng.integers(10, 41)])).astype(np.uint32) for i in range(24)]
    known = [set(substring.seeds(t.astype(np.uint64), np.zeros(len(t), np.int64), 1, s)[0].tolist()) for t in texts]
    for lo, hi in ((0, 24), (10, 24)):
        xs, ys = texts[:lo] or texts, texts[lo:] if lo else None
        given = np.array([3])
        x, y = (v.tolist() for v in substring.matched(xs, ys, s, 5, given))
        got = {(a, b + lo) for a, b in zip(x, y, strict=True)}
        all_pairs = [(a, b) for a in range(len(xs)) for b in range(lo, hi) if a < b or lo]
        shared = {p: len(known[p[0]] & known[p[1]]) for p in all_pairs}
        assert len(got) == len(x) and all(shared[p] >= 5 or p == (0, lo + 3) for p in got)
        want = {p for p in all_pairs if shared[p] >= 5 and substring.passages(texts[p[0]], texts[p[1]], s)}
        assert want <= got and len(want) > 10


def test_texts_come_out_of_packs_as_they_went_in():
    rng = np.random.default_rng(24)
    texts = [rng.integers(0, top, n, dtype=np.uint32) for top, n in ((3, 900), (2**32, 70_000), (2**32, 1), (300, 5_000))]
    rows = pa.RecordBatch.from_arrays([pa.array([1, 1, 1, 2]), pa.array([-5, 7, 8, 9]), pa.array([50, 40, 30, 20]), pa.array([t.tobytes() for t in texts])], ["bucket", "cls", "keeper", "blob"])
    packs = [(b, substring._unpacked(p)) for out in substring._packed([rows]) for b, p in zip(out.column("bucket").to_pylist(), out.column("pack").to_pylist())]
    assert [b for b, _ in packs] == [1, 2]
    assert [(int(c), int(k)) for _, p in packs for c, k in zip(p[0], p[1])] == [(-5, 50), (7, 40), (8, 30), (9, 20)]
    assert all((a == b).all() and len(a) == len(b) for a, b in zip(texts, [t for _, p in packs for t in p[2]], strict=True))


def test_released_stages_leave_no_shuffle_files(spark):
    def held() -> set[str]:
        files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles().mkString("\n")
        return {f for f in files.split("\n") if f.endswith(".data")}

    before = held()
    staged = stage(spark.range(1000).repartition(5, "id"), "released", release=True)
    for _ in range(50):
        if held() <= before:
            break
        time.sleep(0.1)
    assert held() <= before and staged.count() == 1000
    before = held()
    stage(spark.range(1000).repartition(5, "id"), "kept")
    assert held() - before and spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
