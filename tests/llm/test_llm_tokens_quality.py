"""Cross-tokenizer alignment, fill-in-middle and quality against brute force, libraries and held-out labels."""

import bisect
import collections
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from fieldbook.llm import infill, quality, tokenmap

SCHEMA = "doc_id long, text string, n long, form string, piece string, quality int, score int, block int, code string"
A, B = (public_tokenizers.path(x) for x in ("byte_bpe_50k.json", "piece_bpe_32k.model"))


def sample_texts():
    rng = random.Random(4)
    some = lambda n: " ".join(rng.choice(["the", "token", "naïve", "größer", "日本語", "x1", "don't", "aaa", "Z" * 7]) for _ in range(n))
    texts = [None, "", " ", "a", "\n\n\t ", "aaaa aaaa", "▁ underscored", "a\x00b", "<|endoftext|> <s></s> <0x41>", "é é", "🙂🙂 ﷺ", "٣ ½ ①", "a<P>b", "<M>", "x<S", "  two  spaces  "]
    texts += ["aa" * k + " " + "a" * k for k in range(1, 12)]
    texts += [some(n) for n in (1, 2, 3, 5, 8, 40, 200)] * 2
    texts += ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(0xA0, 0x250), rng.randrange(0x3040, 0x3100)])) for _ in range(60)) for _ in range(12)]
    texts += [some(8_000), " " * 120_000 + "end", "é" * 70_000]
    return texts


@pytest.fixture(scope="module")
def awkward(spark):
    rows = [(i * 7, t, 1, "f", "p", 0, 3, 2, "c") for i, t in enumerate(sample_texts())]
    rows += [(None, "no id", *rows[0][2:]), (None, None, *rows[0][2:])]
    rows += [r for r in rows if r[0] in (35, 49, 210)] + [(35, "another text", *rows[0][2:])]
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


# ---- cross-tokenizer alignment


@pytest.fixture(scope="module")
def both():
    return tokenmap.load(A, B)


def brute_links(rows):
    """Tokens by the libraries themselves, links by comparing every token with every other."""
    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    letters = tokenmap._byte_letters()
    spell_a = lambda i: bytes(letters[c] for c in a.id_to_token(i))
    spell_b = lambda i: bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
    out = []
    for text in rows:
        ids_a = a.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        spans = []
        for ids, spell in ((ids_a, spell_a), (ids_b, spell_b)):
            at, found = 0, []
            for i in ids:
                found.append((at, at + len(spell(i)), i))
                at = found[-1][1]
            spans.append(found)
        want = (" " + text).encode() if text else b""
        if b"".join(map(spell_a, ids_a)) != want or b"".join(map(spell_b, ids_b)) != want:
            spans = [[], []]
        ends = sorted({e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]})
        groups = [([], []) for _ in ends]
        for which, side in enumerate(spans):
            for _, e, i in side:
                groups[bisect.bisect_left(ends, e)][which].append(i)
        groups = [(tuple(x), tuple(y)) for x, y in groups]
        second = spans[1]
        links, j = [], 0
        for s, e, i in spans[0]:
            while second[j][1] <= s:
                j += 1
            k = j
            while k < len(second) and second[k][0] < e:
                links.append((i, second[k][2]))
                k += 1
        out.append((len(spans[0]), len(spans[1]), groups, links))
    return out


def test_alignment_equals_brute_force(awkward, both):
    rows = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    found = brute_links([t for _, t in rows])
    count = collections.Counter(p for _, _, _, links in found for p in set(links))
    best = collections.defaultdict(int)
    for (a, _), n in count.items():
        best[a] = max(best[a], n)
    want = collections.Counter()
    for (doc, _), (na, nb, groups, links) in zip(rows, found, strict=True):
        text = ";".join("|".join(",".join(map(str, side)) for side in g) for g in groups)
        sha = hashlib.sha256(text.encode()).hexdigest() if text else ""
        want[(doc, na, nb, len(groups), len(links), sum(count[p] == best[p[0]] for p in links), sum(count[p] for p in links), sha)] += 1
    got = collections.Counter(tuple(r) for r in tokenmap.align(awkward, both).collect())
    assert got == want
    assert any(na != len(g) for na, _, g, _ in found) and sum(1 for na, *_ in found if not na) > 3
    pairs = {(r["a_id"], r["b_id"]): r["n_docs"] for r in tokenmap.pair_table(tokenmap.count_pairs(awkward, both), both).collect()}
    assert pairs == dict(count)
    for r in tokenmap.token_groups(awkward.where("doc_id % 21 = 0 and doc_id <> 35"), both).collect():
        i = rows.index((r["doc_id"], next(t for d, t in rows if d == r["doc_id"])))
        assert [(tuple(g["a"]), tuple(g["b"])) for g in r["groups"]] == found[i][2]


def test_alignment_does_not_depend_on_blocks(awkward, both):
    once = sorted(map(tuple, tokenmap.align(awkward, both).collect()), key=str)
    assert sorted(map(tuple, tokenmap.align(awkward.repartition(2).cache(), both).collect()), key=str) == once


def test_alignment_of_nothing(nothing, both):
    out = tokenmap.align(nothing, both)
    assert out.collect() == [] and out.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert tokenmap.token_groups(nothing, both).collect() == []


def test_identity_map(both):
    known = np.flatnonzero(both.same >= 0)
    assert len(known) > 10_000 and all(both.a_bytes[i] == both.b_bytes[both.same[i]] for i in known)


def test_fast_encoder_equals_the_files_own(both):
    """Every code point between letters, digits and marks, in both libraries."""
    own = Tokenizer.from_file(A)
    own.encode_special_tokens = True
    run = tokenmap._encoder_a(both)
    rng = random.Random(1)
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = [f" a{chr(c)}b 1{chr(c)} {chr(c)}!{chr(c)}" for c in [*range(0x3000), *rng.sample(points, 8000)]]
    texts += [" " * n + "x" for n in (1, 2, 99_999, 100_001)] + ["\n" * 150_000]
    for got, want in zip(run(texts), own.encode_batch_fast(texts, add_special_tokens=False), strict=True):
        assert got.tolist() == want.ids


# ---- fill-in-middle


def brute_fim(doc, text):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    n = len(units)
    digest = hashlib.sha256(f"1:{'' if doc is None else doc}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    x, y = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = ("".join(u) for u in (units[:x], units[x:y], units[y:]))
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    if not text or any(k in text for k in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return (doc, n, "plain", None, None, sha(text), sha(text))
    spm = h[3] % 100 < 20
    out = f"<S>{s}<P>{p}<M>{m}" if spm else f"<P>{p}<S>{s}<M>{m}"
    return (doc, n, "spm" if spm else "psm", len(p), len(m), sha(out), sha(text))


@pytest.mark.parametrize("chunk", [1 << 16, 5])
def test_fill_in_middle_equals_brute_force(awkward, spark, chunk):
    rng = random.Random(9)
    more = [(10_000 + i, "".join(rng.choice("aB é\n🙂<PSM>") for _ in range(rng.randrange(60)))) for i in range(300)]
    docs = awkward.select("doc_id", "text")
    if chunk == 5:  # pieces of a few bytes, in the tasks as well
        docs = docs.where("length(text) < 2000 or text is null")
        assert infill._cuts(np.frombuffer("aé🙂é🙂a".encode(), dtype=np.uint8), 0, 14, 5) == [3, 7, 9, 14]
    docs = docs.union(spark.createDataFrame(more, "doc_id long, text string"))
    want = collections.Counter(brute_fim(r["doc_id"], r["text"]) for r in docs.collect())
    got = collections.Counter(tuple(r) for r in infill.fill_in_middle(docs, infill.Settings(chunk=chunk)).collect())
    assert got == want
    assert {k[2] for k in want} == {"plain", "psm", "spm"}


def test_output_pieces_are_the_outputs(awkward):
    docs = awkward.where("doc_id is not null and doc_id <> 35").dropDuplicates(["doc_id"])
    parts = collections.defaultdict(list)
    for r in infill.output_pieces(docs).collect():
        parts[r["doc_id"]].append((r["pos"], bytes(r["piece"])))
    for r in docs.collect():
        want = brute_fim(r["doc_id"], r["text"])
        assert hashlib.sha256(b"".join(p for _, p in sorted(parts[r["doc_id"]]))).hexdigest() == want[5]


def test_fill_in_middle_of_nothing_and_shuffles_once(nothing, awkward):
    assert infill.fill_in_middle(nothing).collect() == []
    plan = infill.fill_in_middle(awkward.select("doc_id", "text").coalesce(3))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_NUM") == 2  # the one of this frame's own, and one of the pieces


# ---- quality


def test_quality_on_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    model = quality.learn(docs, labels)
    held = quality.score(docs.select("doc_id", "text"), model).join(labels, "doc_id").where(quality.held_out(F.col("doc_id"))).collect()
    for q in (0, 1):
        right = [r["predicted"] == q for r in held if r["quality"] == q]
        assert len(right) > 10 and sum(right) >= 0.97 * len(right)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in held)


def test_quality_learns_from_the_training_part_only(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    other = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    one, two = quality.learn(docs, labels), quality.learn(docs, other)
    assert one.bias == two.bias and np.array_equal(one.weight, two.weight)
    shuffled = quality.learn(docs.repartition(7), labels.repartition(3))
    assert one.bias == shuffled.bias and np.array_equal(one.weight, shuffled.weight)


def test_quality_scores_equal_mean_of_rows(spark, awkward):
    """The table of weights against words, pairs and n-grams looked at one by one."""
    rng = np.random.default_rng(2)
    model = quality.Model(rng.normal(size=1 << 10).astype(np.float32), 0.25)
    for r in quality.score(awkward.where("length(text) < 500 or text is null").select("doc_id", "text", "score", "n"), model).collect():
        raw = (r["text"] or "").encode()
        data = np.frombuffer(raw, dtype=np.uint8)
        found = [f for _, f in quality.features(data, np.array([0, len(data)]), 10)]
        tidy = bytes(quality._TIDY[data])
        words = tidy.split()
        assert [len(f) for f in found] == ([len(words), max(0, len(words) - 1)] + [len(raw) - n + 1 for n in quality.GRAMS if n <= len(raw)])
        mean = model.weight[np.concatenate(found)].astype(float).mean() if raw else 0.0
        assert abs(r["score"] - 1 / (1 + np.exp(-(mean + 0.25)))) < 1e-6 and r["n"] == 1
    grams = collections.defaultdict(set)
    data = np.frombuffer(b"ab ab ab cd", dtype=np.uint8)
    (_, word), (_, pair), *_ = quality.features(data, np.array([0, 11]), 16)
    assert len(set(word.tolist())) == 2 and pair[0] == pair[1] != pair[2]
    same = list(quality.features(np.frombuffer(b"x x qq qq", dtype=np.uint8), np.array([0, 3, 9]), 16))[1][1]
    assert same[0] == same[1] and not grams


def test_quality_without_labels_and_rows(spark, awkward, nothing):
    none = spark.createDataFrame([(1, None), (None, 1), (3, 7)], "doc_id long, quality int")
    assert quality.learn(awkward, none) is None and quality.learn(nothing, nothing) is None
    assert {(r["score"], r["predicted"]) for r in quality.score(awkward, None).collect()} == {(0.5, 1)}
    assert quality.score(nothing, None).collect() == []
    free = [i for i in range(50) if zlib.crc32(str(i).encode()) % 3 != 1][:6]
    one = quality.learn(spark.createDataFrame([(i, "good words") for i in free], "doc_id long, text string"), spark.createDataFrame([(i, 1) for i in free] * 2, "doc_id long, quality int"))
    assert one is not None and quality.score(awkward, one).count() == awkward.count()
