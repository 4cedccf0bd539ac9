"""Page and vector operators against brute force."""

import html
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldbook.llm import dom, hnsw, htmlmain, queries, urltree

TEXT = "The quick brown fox jumps over the lazy dog, and then it sleeps for a while. " * 4


def brute_rule(url, rules):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host) :]).group()
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [r.name for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return host, path, max(fits, key=len) if fits else None


ODD_URLS = [
    None, "", "no scheme", "://", "http://", "HTTP://WWW.Example.COM/en/1", "https://example.com/en", "https://notexample.com/en/", "https://a.example.com?x=/en/", "http://a.net/es/#f",
    "http://a.net/ES/1", "http://net/fr/", "x://y://z.com/en/", "http://com/", "http://www.example.com/en/a/b/c/d/e/f/g", "http://É.com/é/", "http://h.org//a//", "http://h.org/" + "a/" * 2000, "http://h.org:80/en/",
]


def test_url_rules(spark):
    rows = [(i, u, "x", "y") for i, u in enumerate(ODD_URLS)] + [(None, ODD_URLS[5], None, None), (3, ODD_URLS[3], "x", "y")]
    out = urltree.judge_urls(spark.createDataFrame(rows, "page_id long, url string, host string, template string"), queries.RULES).collect()
    assert len(out) == len(rows)
    verdicts = {r.name: r.verdict for r in queries.RULES}
    for r in out:
        if r["page_id"] is not None:
            assert (r["host"], r["path"], r["rule"]) == brute_rule(ODD_URLS[r["page_id"]], queries.RULES)
        assert r["verdict"] in ("allow", "block") and (r["rule"] is None or r["verdict"] == verdicts[r["rule"]])


def test_url_templates(spark):
    """Ids become wildcards, sections that differ stay, unlabelled hosts follow the template's rate elsewhere."""
    rules = [urltree.Rule("a.com", "/spam/", "block"), urltree.Rule("a.com", "/news/", "allow")]
    urls = [f"http://a.com/{kind}/{i}" for i in range(40) for kind in ("spam", "news")] + [f"http://b.org/{kind}/{i}" for i in range(20) for kind in ("spam", "news")]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    out = {r["path"] + r["host"]: r for r in urltree.judge_urls(pages, rules).collect()}
    assert out["/spam/7a.com"]["template"] == "/spam/*" and out["/news/7a.com"]["template"] == "/news/*"
    assert out["/spam/7a.com"]["block_rate"] > 0.9 > 0.1 > out["/news/7a.com"]["block_rate"]
    assert urltree.judge_urls(pages.limit(0), rules).collect() == []
    assert {r["verdict"] for r in urltree.judge_urls(pages, []).collect()} == {"block"}  # nothing is known: ties block
    plan = urltree.judge_urls(pages, rules)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_unlabelled_sections_do_not_join_blocked_ones(spark):
    """On a host whose labelled urls are all blocked, other sections are judged by the same sections elsewhere."""
    rules = [urltree.Rule("net", "/es/", "block"), urltree.Rule("net", "/fr/", "block"), urltree.Rule("com", "/", "allow")]
    urls = [f"http://{host}/{lang}/{i}" for host in ("a.net", "b.net", "c.com") for lang in ("en", "de", "es", "fr") for i in range(30)]
    urls += [f"http://a.net/rare{i}/x" for i in range(3)]
    out = urltree.judge_urls(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"), rules).collect()
    assert len(out) == len(urls)
    for r in out:
        blocked = r["host"].endswith(".net") and r["path"].split("/")[1] in ("es", "fr")
        if "rare" not in r["path"]:
            assert r["verdict"] == ("block" if blocked else "allow"), r
    by = {(r["host"], r["path"].split("/")[1]): r["template"] for r in out}
    assert by["a.net", "es"] == by["a.net", "fr"] and by["a.net", "en"] == "/en/*" and by["a.net", "de"] == "/de/*"
    assert by["a.net", "rare0"] not in (by["a.net", "es"], by["a.net", "en"])


@pytest.fixture(scope="module")
def pages(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/pages.parquet")


@pytest.fixture(scope="module")
def forest(pages):
    return htmlmain.learn(pages)


def article(source):
    """The article element's blocks, read by pattern; enough for the test pages."""
    inside = re.search(r"<article>(.*?)</article>", source, re.S).group(1)
    parts = re.split(r"</?(?:p|h1)>", inside.replace("<br>", " "))
    blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", x)).split()) for x in parts]
    return "\n\n".join(b for b in blocks if b)


def test_main_text_of_pages(pages, forest):
    out = htmlmain.extract(pages.withColumn("text", F.lit(1)), forest).collect()
    want = {r["page_id"]: article(r["html"]) for r in pages.collect()}
    assert {r["page_id"]: r["text"] for r in out} == want
    assert all(r["n_chars"] == len(r["text"]) for r in out)


@pytest.mark.parametrize(
    ("source", "blocks"),
    [
        (f'<div class="nav"><a href=1>Home</a></div><div class="content"><h1>Title here</h1><p>{TEXT}<p>{TEXT}</div><div class="sidebar"><a>x</a></div>', 3),
        (f'<article><h1>Title here</h1><p>{TEXT}</p><div class="comments"><p>{TEXT}</p><p>{TEXT}</p></div></article>', 2),
        (f'<main><p>{TEXT}</p><p>{TEXT}</p></main><section id="comments"><p>{TEXT}</p></section>', 2),
        (f"<article><h1>Title here</h1><p>{TEXT}</p><form><p>Sign up for our mail</p></form><p>{TEXT}</p></article>", 3),
    ],
)
def test_main_text_of_layouts(forest, source, blocks):
    assert len(htmlmain.main_text(f"<html><body>{source}</body></html>", forest).split("\n\n")) == blocks


def test_pages_that_are_hardly_pages(spark, forest):
    odd = [None, "", "<", "<p", "<p>", "</p></div>", "<!-- ", "plain words", "<a href='x>", "<script>var a='<p>no</p>'", "<p>" * 3000, "&amp;&#0;&bogus;&#x41;", "<div>" * 500 + "deep", "\x00"]
    rows = [(i, None, t) for i, t in enumerate(odd)] + [(None, "u", "<p>x</p>"), (1, None, "")]
    out = htmlmain.extract(spark.createDataFrame(rows, "page_id long, url string, html string"), forest).collect()
    assert len(out) == len(rows) and all(r["text"] is not None for r in out)
    assert htmlmain.learn(spark.createDataFrame([], "page_id long, url string, html string")) is None
    assert htmlmain.extract(spark.createDataFrame(rows[:3], "page_id long, url string, html string"), None).collect()[2]["text"] == ""


def test_choices_do_not_contradict():
    page = dom.read("<div><p>a</p><div><p>b</p><p>c</p></div></div>")
    rng = np.random.default_rng(0)
    for _ in range(50):
        odds = rng.normal(0, 3, len(page.tag))
        keep = htmlmain.decode(page, odds, np.ones(len(odds)))
        # below a dropped part inside kept text nothing is kept
        for i, p in enumerate(page.parent):
            if keep[i] and p >= 0 and not keep[p]:
                above = p
                while above >= 0:
                    assert not keep[above]
                    above = page.parent[above]


def brute_nearest(rows, every, k):
    good = {i: np.array(v, dtype=np.float64) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and np.any(v)}
    out = {}
    for q, v in good.items():
        if q % every == 0:
            scores = sorted((-round(float(np.dot(v, w) / (np.linalg.norm(v) * np.linalg.norm(w))), 9), i) for i, w in good.items() if i != q and len(w) == len(v))
            out[q] = [(i, -s) for s, i in scores[:k]]
    return out


def test_nearest_small(spark):
    rng = np.random.default_rng(5)
    vectors = rng.normal(0, 1, (120, 8)).astype(np.float32)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    rows[7] = (7, None)
    rows[50] = (50, rows[0][1])
    rows[51], rows[52], rows[53] = (51, rows[0][1]), (52, [0.0] * 8), (53, [float("nan")] * 8)
    rows[54], rows[55], rows[56] = (54, [float("inf")] + [1.0] * 7), (55, []), (56, [None] * 8)
    rows += [(200, rows[0][1]), (200, rows[0][1]), (None, rows[1][1]), (250, [1.0, 2.0])] + [(300 + i, rows[0][1]) for i in range(20)]
    table = spark.createDataFrame([(i, v, 1, "r") for i, v in rows], "vec_id long, embedding array<float>, shard int, rank string").repartition(4)
    got = {}
    for r in hnsw.nearest(table).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], round(r["score"], 9)))
    want = {q: v for q, v in brute_nearest(rows, 50, 5).items() if v}
    assert {q: [i for i, _ in v] for q, v in got.items()} == {q: [i for i, _ in v] for q, v in want.items()}
    assert all(abs(a[1] - b[1]) < 1e-6 for q in want for a, b in zip(got[q], want[q]))
    assert hnsw.nearest(table.limit(0)).collect() == []


def test_nearest_recall_over_shards(spark):
    rng = np.random.default_rng(6)
    centres = rng.normal(0, 1, (20, 32))
    vectors = (centres[rng.integers(0, 20, 3000)] + rng.normal(0, 0.6, (3000, 32))).astype(np.float32)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    got = hnsw.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), settings=hnsw.Settings(shard_rows=1000)).collect()
    want = brute_nearest(rows, 50, 5)
    found = {(r["query_id"], r["vec_id"]) for r in got}
    assert len(got) == 300
    assert np.mean([(q, i) in found for q, v in want.items() for i, _ in v]) >= 0.9


# ---- urls at any depth


def test_sections_below_the_fourth_level_are_told_apart(spark):
    rules = [urltree.Rule(h, "/a/b/c/d/bad/", "block") for h in ("x.com", "y.com")] + [urltree.Rule(h, "/a/b/c/d/good/", "allow") for h in ("x.com", "y.com")]
    urls = [f"http://{h}/a/b/c/d/{kind}/{i}" for h, n in (("x.com", 40), ("y.com", 40), ("z.org", 20)) for kind in ("bad", "good") for i in range(n)]
    out = urltree.judge_urls(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"), rules).collect()
    for r in out:
        assert r["verdict"] == ("block" if "/bad/" in r["path"] else "allow"), r
    assert {r["template"] for r in out if r["host"] == "z.org"} == {"/a/b/c/d/bad/*", "/a/b/c/d/good/*"}


def test_a_small_blocked_section_among_many_stays_literal(spark):
    """Forty even sections have 2.5 % of the urls each; the blocked one is told by its labels."""
    rules = [urltree.Rule("x.com", f"/s{i:02}/", "block" if i == 7 else "allow") for i in range(40)]
    urls = [f"http://x.com/s{i:02}/{n}" for i in range(40) for n in range(10)]
    out = urltree.judge_urls(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"), rules).collect()
    rates = {r["path"].split("/")[1]: (r["template"], r["block_rate"]) for r in out}
    assert rates["s07"][0] == "/s07/*" and rates["s07"][1] > 0.5 > max(v for k, (_, v) in rates.items() if k != "s07")


def brute_templates(urls, rules, s):
    """Template and block rate of each (host, path), by a tree of dictionaries."""
    groups = {}
    for url in urls:
        host, path, rule = brute_rule(url, rules)
        blocked = rule is not None and next(r.verdict for r in rules if r.name == rule) == "block"
        g = groups.setdefault((host, path), [0, 0, 0, [x for x in path.split("/") if x]])
        g[0], g[1], g[2] = g[0] + 1, g[1] + blocked, g[2] + (rule is not None)

    def apart(b, n, all_b, all_n):
        if not (n > 0 and all_n - n > 0):
            return True
        rate = all_b / all_n
        return abs(b / n - (all_b - b) / (all_n - n)) > s.z * np.sqrt(rate * (1 - rate) * (1 / n + 1 / (all_n - n)))

    own = {k: [] for k in groups}
    level, left = 0, list(groups)
    while left:
        child, whole = {}, {}
        for k in left:
            u, b, n, segs = groups[k]
            if len(segs) > level:
                node = (k[0], *own[k])
                for into, key in ((child, (node, segs[level])), (whole, node)):
                    have = into.setdefault(key, [0, 0, 0])
                    for i, v in enumerate((u, b, n)):
                        have[i] += v
        nxt = []
        for k in left:
            segs, node = groups[k][3], (k[0], *own[k])
            if len(segs) <= level or whole[node][0] < s.min_urls:
                continue
            (u, b, n), (all_u, all_b, all_n) = child[node, segs[level]], whole[node]
            literal = u >= s.min_urls and (u >= s.min_share * all_u or (n > 0 and all_n > n and apart(b, n, all_b, all_n)))
            own[k] = [*own[k], segs[level] if literal else "*"]
            nxt.append(k)
        left, level = nxt, level + 1
    depth = max(map(len, own.values()))
    merged = {k: list(t) for k, t in own.items()}
    for at in range(depth - 1, -1, -1):
        branch, whole = {}, {}
        for k, t in own.items():
            if len(t) > at:
                node = (k[0], *t[:at])
                for into, key in ((branch, (node, t[at])), (whole, node)):
                    have = into.setdefault(key, [0, 0])
                    have[0], have[1] = have[0] + groups[k][1], have[1] + groups[k][2]
        for k, t in own.items():
            if len(t) > at:
                node = (k[0], *t[:at])
                wild = branch.get((node, "*"), [0, 0])
                if not apart(*branch[node, t[at]], *whole[node]):
                    merged[k][at] = "(*)" if apart(*wild, *whole[node]) else "*"
    rest = {k: len(groups[k][3]) - len(t) for k, t in own.items()}
    name = {k: "/" + "/".join([*m, *([f"+{rest[k]}"] if rest[k] else [])]) for k, m in merged.items()}

    def sums(key):
        out = {}
        for k in groups:
            have = out.setdefault(key(k), [0, 0])
            have[0], have[1] = have[0] + groups[k][1], have[1] + groups[k][2]
        return out

    keys = (lambda k: k[0], lambda k: (*own[k], "|", rest[k]), lambda k: (k[0], name[k]))
    tables = [sums(key) for key in keys]
    b, n = (sum(g[i] for g in groups.values()) for i in (1, 2))
    out = {}
    for k in groups:
        rate = (b + 0.5 * s.weight) / (n + s.weight)
        for key, table in zip(keys, tables, strict=True):
            rate = (table[key(k)][0] + s.weight * rate) / (table[key(k)][1] + s.weight)
        out[k] = (name[k], rate)
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_templates_equal_a_tree_of_dictionaries(spark, seed):
    rng = np.random.default_rng(seed)
    words = ["a", "b", "news", "shop", "x", "*"]
    urls = []
    for _ in range(500):
        deep = int(rng.integers(0, 8))
        parts = [words[int(rng.integers(0, 1 + int(rng.integers(0, 6))))] if rng.random() < 0.8 else f"id{rng.integers(0, 300)}" for _ in range(deep)]
        urls.append(f"http://{('h1.com', 'h2.com', 'n.h1.com', 'solo.org')[int(rng.choice(4, p=[0.5, 0.3, 0.195, 0.005]))]}/" + "/".join(parts))
    rules = [urltree.Rule("h1.com", "/a/", "block"), urltree.Rule("h1.com", "/a/b/", "allow"), urltree.Rule("h2.com", "/a/a/a/a/a/", "block"), urltree.Rule("h2.com", "/b", "allow"), urltree.Rule("com", "/a/a/b/", "allow")]
    want = brute_templates(urls, rules, urltree.Settings())
    out = urltree.judge_urls(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"), rules).collect()
    assert len(out) == len(urls)
    for r in out:
        template, rate = want[r["host"], r["path"]]
        assert r["template"] == template and abs(r["block_rate"] - rate) < 1e-9, (r, template, rate)


# ---- markup


def texts_of(source):
    return [run for _, run, _ in dom.read(source).runs]


def test_quotes_count_right_after_an_equals_sign_only():
    assert texts_of("<article><p title=don't>alpha</p><p>beta</p><p title=it's>gamma</p></article>") == ["alpha", "beta", "gamma"]
    assert texts_of("<p a='x>y' b=\"p>q\" c=z>one</p><p d = 'e'f>two</p><p \"odd'>three</p>") == ["one", "two", "three"]
    assert texts_of("<p title=\"never closed>four</p><p>five</p>") == ["four", "five"]
    assert dom.read("<div class=side-bar id='menu' CLASS=x>a</div>").away[0] == 2
    assert texts_of("1 < 2 and 3<4 x<br/>y<p>z</p") == ["1 < 2 and 3<4 x y", "z"]


def test_formulas_stay_and_comments_go():
    assert texts_of("<p>so <math><mi>x</mi><mo>=</mo><mn>1</mn></math> holds<!-- > no --> here</p><!-- open") == ["so x=1 holds here"]


@pytest.mark.parametrize(
    "piece",
    ["<div>|</p>", '<a title="x\' |', "<script |", "<p><li>|<b>|<div></div>", "<li><ul>|<div>|<li></li>", "<|", "<a b='|", "<td>|<tr>", "<em>x</b>|", "<!--|<!-"],
)
def test_hostile_markup_takes_time_in_proportion(piece):
    import time

    once, *many = piece.split("|") if piece.startswith(("<p>", "<li>")) else ("", *piece.split("|"))
    page = once + "".join(m * (500_000 // max(1, len("".join(many)))) for m in many)
    start = time.process_time()
    dom.features(dom.read(page))
    assert time.process_time() - start < 25  # it took minutes with a walk over open elements


def test_deep_and_long_pages_are_extracted(spark):
    body = "".join(f"<p>{TEXT} {i}</p>" for i in range(1500))
    rows = [(1, "u", f"<html><body>{'<div>' * 3000}<article>{body}</article></body></html>"), (2, "v", "<div>" * 20000 + "x")]
    learned = htmlmain.learn(spark.createDataFrame([(i, "u", f"<html><body><nav><a>menu {i}</a></nav><article>{'<p>' + TEXT + str(i) + '</p>'}</article></body></html>") for i in range(60)] * 2, "page_id long, url string, html string"))
    out = {r["page_id"]: r["text"] for r in htmlmain.extract(spark.createDataFrame(rows, "page_id long, url string, html string"), learned).collect()}
    assert len(out) == 2 and out[1].count(TEXT.strip()[:40]) in (0, 4 * 1500)


# ---- vectors at the ends of the range


def test_cosine_of_extreme_vectors(spark):
    rows = [(0, [1e200, 1e200]), (50, [1e-200, 0.0]), (1, [1.0, 1.0]), (2, [3e-310, 3e-310]), (3, [-1e300, 1e-300]), (4, [1.0, 0.0]), (5, [1e308, 1.7e308]), (100, [0.0, 0.0]), (6, [float("inf"), 1.0])]
    got = hnsw.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), every=50, k=10).collect()
    good = {i: np.array([float(x) / max(map(abs, v)) for x in v]) for i, v in rows if np.isfinite(v).all() and any(v)}
    want = {(q, i): float(good[q] @ good[i] / (np.linalg.norm(good[q]) * np.linalg.norm(good[i]))) for q in (0, 50) for i in good if i != q}
    assert {(r["query_id"], r["vec_id"]) for r in got} == set(want)
    for r in got:
        assert abs(r["score"] - want[r["query_id"], r["vec_id"]]) < 1e-12
    assert [r["vec_id"] for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])) if r["query_id"] == 50][0] == 4
