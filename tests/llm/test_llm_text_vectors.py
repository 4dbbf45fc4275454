"""Main text, centroids and importance resampling against plain versions."""

import hashlib
import math
import os
import re
import sys
import zlib
from collections import Counter

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from llm_cases import LOWER, empty, frame, texts  # noqa: E402
from oracle_compare import compare, duck  # noqa: E402
from skyframe.llm import importance  # noqa: E402
from skyframe.llm.centroids import bisectors, clusters, tournament  # noqa: E402
from skyframe.llm.html_labels import MARK, labelled_pages  # noqa: E402
from skyframe.llm.html_text import blocks, extract, features, is_text, learn, main_text  # noqa: E402
from skyframe.llm.importance import resample  # noqa: E402
from skyframe.llm.queries import ORACLE, QUERIES  # noqa: E402


@pytest.mark.parametrize("name", ["op11_html_text", "op12_centroid_clustering", "op13_importance_resampling"])
def test_queries_equal_their_sql(spark, sf_dir, name):
    problems, n = compare(QUERIES[name](spark, sf_dir), duck(sf_dir), ORACLE[name])
    assert problems == [] and n > 0


# ------------------------------------------------------------------ main text

@pytest.fixture(scope="module")
def tree():
    return learn(labelled_pages())


def test_the_tree_holds_on_pages_it_has_not_seen(tree):
    right = total = 0
    for page in labelled_pages(times=15, seed=77):
        found = blocks(page)
        for block, numbers in zip(found, features(found)):
            total += 1
            right += is_text(tree, numbers) == block.text.startswith(MARK)
    assert total > 1000 and right / total > 0.99


LONG = " ".join(f"word{i}" for i in range(60))
PAGES = {
    "article": ("<html><head><title>T</title></head><body><nav><a href=/>Home</a></nav><article><h1>Head &amp; line</h1><p>One\n two&nbsp;three.</p><p>x &lt;b&gt; &#233;</p></article><footer>end</footer></body></html>",
                "Head & line\nOne two three.\nx <b> é"),
    "no end tags": ("<body><div class=ad>buy this now<article><p>First <b>bold<p>Second one<ul><li>item a<li>item b</ul>", "First bold\nSecond one\nitem a\nitem b"),
    "scripts and markup": ("<article><script>var a='</p><p>no';</script><style>p{}</style><!-- <p>no</p> --><p title='a > b'>yes<br>and yes</p><![CDATA[no]]></article>", "yes and yes"),
    "readers' comments": ("<article><p>Main words here.</p><div id='comments'><article><p>I like it a lot, thanks for the words.</p></article></div></article>", "Main words here."),
    "forms and sidebars": ("<article><form>your name <input></form><p>Kept</p><div class='site-sidebar'><p>" + LONG + "</p></div><p>Also kept</p></article>", "Kept\nAlso kept"),
    "no article": ("<div><a href=/>a</a> <a href=/b>b</a></div><div class='cookie-banner'>" + LONG + "</div><h2>Some title of it</h2><p>" + LONG + "</p><p>" + LONG + "</p><div class='footer'>x y</div>",
                   "Some title of it\n" + LONG + "\n" + LONG),
    "cut off": ("<nav><a href=/>a</a></nav><article><h1>Title</h1><p>begins and <a href='x", "Title\nbegins and"),
    "empty": ("", ""), "null": (None, ""), "only markup": ("<p></p><div>  </div>", ""), "inline": ("<article><p>a<i>b</i>c <span>d</span></p></article>", "abc d"),
    "hidden": ("<article><p hidden>no</p><div style='display: none'>no</div><p>yes it is</p></article>", "yes it is"),
}


@pytest.mark.parametrize("name", PAGES)
def test_pages(tree, name):
    page, want = PAGES[name]
    assert extract(tree, page) == want


def test_very_long_and_deep_pages(tree):
    many = "<article>" + "".join(f"<p>paragraph number {i}</p>" for i in range(50_000)) + "</article>"
    assert extract(tree, many).count("\n") == 49_999
    deep = "<div>" * 100_000 + "<article><p>in the deep</p></article>" + "</div>" * 100_000
    assert extract(tree, deep) == "in the deep"
    assert [b.text for b in blocks("<" * 100_000 + "a='" * 100_000)] == ["<" * 99_999]


def test_main_text_rows(spark):
    rows = [(i, f"u{i}", page, "clash", 3) for i, (page, _) in enumerate(PAGES.values())] + [(None, None, None, None, None), (0, "u0", PAGES["article"][0], "again", 4)]
    schema = "page_id long, url string, html string, text string, n_chars long"
    got = sorted((tuple(r) for r in main_text(spark.createDataFrame(rows, schema)).collect()), key=str)
    want = [want for _, want in PAGES.values()]
    assert got == sorted([(i, f"u{i}", t, len(t)) for i, t in enumerate(want)] + [(None, None, "", 0), (0, "u0", want[0], len(want[0]))], key=str)
    assert main_text(spark.createDataFrame([], schema)).collect() == []


# ------------------------------------------------------------------ centroids

def plain_clusters(rows, k, rounds, dim, scale, seed):
    kept = [(i, tuple(math.floor(scale * x) for x in v)) for i, v in rows if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted((hashlib.sha256(f"{seed}:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)
    centroids = [v for _, v in first[:k]]
    if not centroids:
        return []

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        own = [nearest(v)[1] for _, v in kept]
        for n in range(len(centroids)):
            mine = [v for (_, v), o in zip(kept, own) if o == n]
            if mine:
                centroids[n] = tuple(sum(x) // len(mine) for x in zip(*mine))
    last = [(i, *nearest(v)) for i, v in kept]
    within = Counter()
    for _, d, n in last:
        within[n] += d
    return sorted([(i, n, d, within[n], sum(within.values()), hashlib.sha256(",".join(map(str, centroids[n])).encode()).hexdigest()) for i, d, n in last], key=str)


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 5, "c") for i, v in rows], "vec_id long, embedding array<double>, cluster int, distance string")


@pytest.mark.parametrize("k", [1, 4, 100])
def test_clusters_equal_a_plain_version(spark, k):
    r = np.random.default_rng(5)
    rows = [(i, r.integers(-3, 4, 3).astype(float).tolist()) for i in range(60)] + [(i, (r.normal(size=3) * 5).tolist()) for i in range(60, 90)]
    rows += [(7, [1.0, 1.0, 1.0]), (7, [1.0, 1.0, 1.0]), (200, None), (201, []), (202, [1.0, 2.0]), (203, [1.0, None, 2.0]), (204, [float("nan"), 0.0, 0.0]), (205, [float("inf"), 0.0, 0.0]), (None, [0.5, 0.5, 0.5])]
    got = clusters(vectors(spark, rows), k=k, rounds=3, dim=3, scale=2, seed=9).collect()
    assert sorted((tuple(g) for g in got), key=str) == plain_clusters(rows, k, 3, 3, 2, 9)


def test_clusters_of_nothing(spark):
    for rows in ([], [(1, None)], [(1, [1.0])]):
        assert clusters(vectors(spark, rows), dim=3).collect() == []


def test_too_large_components_fail_the_job(spark):
    with pytest.raises(Exception, match="component too large"):
        clusters(vectors(spark, [(1, [1e30, 0.0, 0.0])]), dim=3).collect()


def test_ties_and_large_numbers_of_the_tournament():
    centroids = np.array([[2, 0], [0, 2], [0, 0], [2, 0], [2**28, 0]], np.int64)
    x = np.array([[1, 1], [2, 0], [0, 0], [1, 0], [2**27 + 1, 0], [2**27, 0], [2**28, 5]], np.int64)
    want = [min((int(((v - c) ** 2).sum()), n) for n, c in enumerate(centroids))[1] for v in x]
    assert tournament(x, *bisectors(centroids)).tolist() == want


# ----------------------------------------------------------------- resampling

def plain_resample(rows, target, max_words, buckets, percent, min_words, seed):
    def runs(text):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
        return len(w), [" ".join(w[i:i + n]) for n in range(1, max_words + 1) for i in range(len(w) - n + 1)]

    place = lambda f: zlib.crc32(f.encode()) % buckets
    s = Counter(place(f) for _, t in rows for f in runs(t)[1])
    t = Counter(place(f) for text in target for f in runs(text)[1])
    total_s, total_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (total_s + buckets) / ((s[b] + 1) * (total_t + buckets)))) for b in range(buckets)]
    out = []
    for i, text in rows:
        n, found = runs(text)
        weight = sum(gain[place(f)] for f in found) // len(found) if found else 0
        noise = None if i is None else int(hashlib.sha256(f"{seed}:{i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(found), weight, None if i is None else weight + math.floor(-1000 * math.log(-math.log((noise + 0.5) / 4294967296))), n])
    fit = sorted((-o[3], o[0], n) for n, o in enumerate(out) if o[4] >= min_words and o[0] is not None)
    rank = {n: r for r, (_, _, n) in enumerate(fit[:percent * len(fit) // 100], 1)}
    return [(*o[:4], rank.get(n)) for n, o in enumerate(out)]


@pytest.mark.parametrize("max_words, percent", [(1, 10), (1, 60), (2, 100), (3, 33), (1, 0)])
def test_resample_equals_a_plain_version(spark, max_words, percent):
    rows = texts() + [(300 + i, "Ünder_score 9x " * (i + 7) + "y" * 100) for i in range(40)]
    target = [t for i, t in rows if i and i % 3 == 0] + [None, ""]
    got = resample(frame(spark, rows), spark.createDataFrame([(t,) for t in target], "text string"), max_words=max_words, buckets=97, percent=percent)
    want = plain_resample(rows, target, max_words, 97, percent, 20, 2024)
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted(want, key=str)


def test_resample_repeated_rows_and_empty_tables(spark):
    rows = [(1, "a few words of one text " * 9)] * 30 + [(None, "more words here " * 9)] * 5
    got = resample(frame(spark, rows), spark.createDataFrame([], "text string"), percent=50).collect()
    assert len(got) == 35 and sorted(r["rank"] for r in got if r["rank"]) == list(range(1, 16))
    assert resample(empty(spark), spark.createDataFrame([("a",)], "text string")).collect() == []


def test_brackets_are_widened_until_they_hold_the_cutoff(spark, monkeypatch):
    pool = spark.range(1, 1001).selectExpr("id * 7 % 1009 AS score")
    ranked = sorted((r.score for r in pool.collect()), reverse=True)
    monkeypatch.setattr(importance, "ACCURACY", 20)
    for want in (1, 5, 100, 500, 999, 1000):
        low, high, above = importance.bracket(pool, want, 1000)
        assert low <= ranked[want - 1] <= high and above == sum(s > high for s in ranked)
    ties = spark.range(1000).selectExpr("CAST(id % 3 AS BIGINT) AS score")
    for want in (1, 333, 334, 700, 1000):
        low, high, above = importance.bracket(ties, want, 1000)
        assert above < want <= above + ties.filter(f"score BETWEEN {low} AND {high}").count()
