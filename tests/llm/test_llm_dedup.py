"""Near-duplicates and shared passages against brute force."""

import itertools
import os
import sys
import time
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from llm_cases import edited, empty, frame, prose, shingle_set, texts, word_list  # noqa: E402
from skyframe.llm.graph import components  # noqa: E402
from skyframe.llm.near_dup import near_duplicates  # noqa: E402
from skyframe.llm.queries import QUERIES  # noqa: E402
from skyframe.llm.substring import compact_windows, near_passages, passages, text_windows, without_passages  # noqa: E402


def brute_components(sets: dict) -> dict:
    up = {i: i for i in sets}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    holders = defaultdict(list)
    for i in sorted(sets):
        for s in sets[i]:
            holders[s].append(i)
    shared = defaultdict(int)
    for ids in holders.values():
        for a, b in itertools.combinations(ids, 2):
            shared[a, b] += 1
    for (a, b), n in shared.items():
        if 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n):
            x, y = sorted((top(a), top(b)))
            up[y] = x
    return {i: top(i) for i in sets}


def test_near_duplicates_of_all_documents_equal_brute_force(spark, sf_dir):
    sets = {r.doc_id: shingle_set(r.text, 4) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    want = brute_components(sets)
    got = {r.doc_id: r for r in QUERIES["op6_minhash_near_dup"](spark, sf_dir).collect()}
    assert {i: (r.n_shingles, r.component_id, r.kept) for i, r in got.items()} == {i: (len(sets[i]), want[i], want[i] == i) for i in sets}


def test_near_duplicates_where_no_hub_is_near_all(spark):
    base = prose(77, 150)
    rows = [(i, edited(base, i, 24 + i % 20)) for i in range(1, 61)]
    got = {r.doc_id: r.component_id for r in near_duplicates(frame(spark, rows), k=4).collect()}
    assert got == brute_components({i: shingle_set(t, 4) for i, t in rows})
    assert 1 < len(set(got.values())) < 60


def test_near_duplicates_cases(spark):
    rows = near_duplicates(frame(spark), k=5).collect()
    assert len(rows) == len(texts())
    got = defaultdict(list)
    for r in rows:
        got[r.doc_id].append((r.n_shingles, r.component_id, r.kept))
    assert got[20] == [(0, 20, True)] and got[21] == [(0, 21, True)] and got[22] == [(0, 22, True)]
    assert got[24] == [(1, 23, False)] and got[25] == [(1, 23, False)]
    assert got[11][0][1:] == (10, False)
    assert got[50] == [(36, 50, True)] * 2
    assert {(c, k) for _, c, k in got[None]} == {(None, True)}
    assert near_duplicates(empty(spark)).collect() == []


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(1, 60)] + [(100, 101), (101, 102)], "a long, b long")
    got = {r.node: r.component for r in components(links, "a", "b").collect()}
    assert got == {**{i: 1 for i in range(1, 61)}, 100: 100, 101: 100, 102: 100}


def test_components_of_stars_need_no_round(spark, monkeypatch):
    from skyframe.llm import graph
    monkeypatch.setattr(graph, "_toward_least", None)
    links = spark.createDataFrame([(1, i) for i in range(2, 9)] + [(5, 1), (20, 21)], "a long, b long")
    assert {tuple(r) for r in graph.components(links, "a", "b").collect()} == {(i, 1) for i in range(1, 9)} | {(20, 20), (21, 20)}
    assert graph.components(links.limit(0), "a", "b").collect() == []


def test_compact_windows_cover_every_stretch_once():
    r = np.random.default_rng(1)
    for values in (r.integers(0, 50, 120).astype(np.uint64), np.zeros(40, np.uint64), np.arange(30).astype(np.uint64)):
        for least in (1, 2, 7, 30):
            found = compact_windows(values, least)
            for a in range(len(values)):
                for b in range(a + least, len(values) + 1):
                    hit = [w for w in found if w[0] <= a <= w[1] < b <= w[2] + 1]
                    assert hit and all(values[w[1]] == values[a:b].min() for w in hit)


def test_every_passage_of_fifty_words_is_found(spark, sf_dir):
    words = {r.doc_id: word_list(r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    first, starts = {}, []
    for i in sorted(words):
        for a in range(len(words[i]) - 49):
            if first.setdefault(tuple(words[i][a:a + 50]), i) != i:
                starts.append((i, a))
    spans = defaultdict(list)
    for r in QUERIES["op7_compact_windows"](spark, sf_dir).collect():
        spans[r.doc_id].append((r.start_word, r.end_word))
        x, y = words[r.doc_id][r.start_word:r.end_word], words[r.match_id][r.match_start:r.match_end]
        p, q = shingle_set(" ".join(x), 5), shingle_set(" ".join(y), 5)
        assert r.match_id < r.doc_id and len(x) >= 50 and len(p & q) >= 0.8 * len(p | q)
    assert starts and [s for s in starts if not any(a <= s[1] and s[1] + 50 <= b for a, b in spans[s[0]])] == []


def test_passages_cases(spark):
    docs = frame(spark)
    spans = near_passages(docs)
    got = {(r.doc_id, r.match_id): (r.start_word, r.end_word, r.match_start) for r in spans.collect()}
    assert got[31, 30] == (50, 110, 80)
    assert (11, 10) in got and not any(50 in p or None in p for p in got)
    rest = {r.doc_id: r for r in without_passages(docs, spans).collect()}
    assert rest[31].text.split() == prose(6, 50).split() + prose(7, 90).split() and rest[31].id == "z"
    assert rest[11].text.split() == [] and rest[30].text == docs.filter("doc_id = 30").first().text and rest[20].text is None
    assert without_passages(docs, spans).columns == docs.columns and without_passages(docs, spans).count() == len(texts())
    assert near_passages(empty(spark)).collect() == [] and without_passages(empty(spark), spans).collect() == []


def test_a_very_common_line_does_not_hide_a_passage(spark):
    line = prose(500, 14)
    rows = [(i, prose(600 + i, 60) + " " + line + " " + prose(900 + i, 60)) for i in range(1, 80)]
    passage = prose(501, 25) + " " + line + " " + prose(502, 25)
    rows += [(200, prose(503, 40) + " " + passage), (201, passage + " " + prose(504, 40))]
    got = {(r.doc_id, r.match_id) for r in near_passages(frame(spark, rows)).collect()}
    assert got == {(201, 200)}


def test_common_lines_in_many_texts_do_not_hide_a_near_copy(spark):
    rows, want = [], set()
    for n in range(10):
        lines = [prose(9000 + 10 * n + i, 14) for i in range(4)]
        rows += [(1000 * n + 10 * i + j, " ".join([prose(20000 + 1000 * n + 10 * i + j, 60), lines[i], prose(40000 + 1000 * n + 10 * i + j, 60)])) for i in range(4) for j in range(8)]
        passage = " ".join(lines).split()
        near = [*passage[:28], "changedword", *passage[29:]]
        rows += [(1000 * n + 100 + m, " ".join([prose(60000 + 2 * n + m, 60), *p, prose(70000 + 2 * n + m, 60)])) for m, p in enumerate((passage, near))]
        want.add((1000 * n + 101, 1000 * n + 100))
    got = {(r.doc_id, r.match_id) for r in near_passages(frame(spark, rows)).collect()}
    assert got <= want and len(got) >= 9


def test_every_copy_of_a_passage_in_a_text_is_found(spark):
    passage = prose(701, 80)
    rows = [(1, prose(702, 50) + " " + passage + " " + prose(703, 300)), (2, prose(704, 60) + " " + passage + " " + prose(705, 90) + " " + passage + " " + prose(706, 20))]
    got = sorted((r.doc_id, r.start_word, r.end_word, r.match_start) for r in near_passages(frame(spark, rows)).collect())
    assert got == [(2, 60, 140, 50), (2, 230, 310, 50)]


def test_a_near_copy_behind_an_exact_passage_is_found(spark):
    exact, other = prose(711, 200), prose(712, 60).split()
    changed = [w if i != 30 else "changedword" for i, w in enumerate(other)]
    rows = [(1, " ".join([prose(713, 40), *other, prose(714, 120), exact, prose(715, 50)])),
            (2, " ".join([prose(716, 70), exact, *changed, prose(717, 80)]))]
    got = sorted((r.doc_id, r.start_word, r.end_word, r.match_start) for r in near_passages(frame(spark, rows)).collect())
    assert got == [(2, 70, 270, 220), (2, 270, 330, 40)]


def test_a_part_of_a_passage_in_an_earlier_text_does_not_hide_it(spark):
    rows, want = [], set()
    for n, (size, part) in enumerate([(50, 40)] * 12 + [(60, 44)] * 12 + [(80, 60)] * 12):
        passage, i = prose(5000 + n, size).split(), 10 * n
        for of, held in enumerate([passage[(size - part) // 2:][:part], passage, passage]):
            rows.append((i + of, " ".join([prose(6000 + i + of, 60), *held, prose(7000 + i + of, 60)])))
        want |= {(i + 2, a) for a in range(60, 60 + size - 49)}
    spans = defaultdict(list)
    for r in near_passages(frame(spark, rows)).collect():
        spans[r.doc_id].append((r.start_word, r.end_word))
    assert [(i, a) for i, a in sorted(want) if not any(b <= a and a + 50 <= e for b, e in spans[i])] == []


def test_many_places_of_a_part_do_not_hide_a_passage(spark):
    rows, want = [], set()
    for n in range(12):
        passage, i, times = prose(8000 + n, 64).split(), 10 * n, (40, 66, 200)[n % 3]
        part = " ".join(passage[10:45])
        often = " ".join(part + " " + prose(8100 + 300 * n + j, 3) for j in range(times))
        if n % 2:
            rows.append((i, prose(8200 + n, 60) + " " + part + " " + prose(8300 + n, 60)))
        rows.append((i + 1, often + " " + " ".join(passage) + " " + prose(8400 + n, 30)))
        rows.append((i + 2, prose(8500 + n, 60) + " " + " ".join(passage) + " " + prose(8600 + n, 60)))
        want |= {(i + 2, a) for a in range(60, 60 + 15)}
    spans = defaultdict(list)
    for r in near_passages(frame(spark, rows)).collect():
        spans[r.doc_id].append((r.start_word, r.end_word))
    assert [(i, a) for i, a in sorted(want) if not any(b <= a and a + 50 <= e for b, e in spans[i])] == []


def test_frequent_tokens_vote_with_all_their_places():
    r, missed = np.random.default_rng(11), 0
    for at in range(0, 11_900, 700):
        common = r.integers(1, 2**62, 60).astype(np.uint64)  # each about 200 times in y
        y = common[r.integers(0, 60, 12_000)]
        x = np.concatenate([r.integers(1, 2**62, 80).astype(np.uint64), y[at:at + 60], r.integers(1, 2**62, 80).astype(np.uint64)])
        x[80 + 20], x[80 + 41] = 5, 6
        missed += not any(a < 90 and b > 130 and a - c == 80 - at for a, b, c, d, like in passages(x, y, np.zeros(0, np.int64), 46, 80))
    assert missed == 0


def test_equal_texts_of_pairs_are_split_into_words_once(monkeypatch):
    from skyframe.llm import substring
    one, two, seen, split = prose(801, 70), prose(802, 90), [], substring.words
    monkeypatch.setattr(substring, "words", lambda column: seen.append(len(column)) or split(column))
    got = substring._tokens_of(pa.array([one, two, one, "", one, "é " + two, two]), 5)
    assert seen == [4] and [len(t) for t in got] == [66, 86, 66, 0, 66, 87, 86]
    assert (got[0] == got[4]).all() and (got[1] == got[6]).all() and (got[5][1:] == got[1]).all()
    assert substring._tokens_of(pa.array([], pa.string()), 5) == []


def test_shuffle_files_of_a_landed_table_do_not_stay(spark):
    from skyframe.llm.scratch import CLEANUP, discard, landed
    before, sc = spark.conf.get(CLEANUP), spark.sparkContext
    there = lambda: sum(len([f for f in files if f.startswith("shuffle_")]) for d in local.split(",") for _, _, files in os.walk(d))
    local = ",".join(str(d) for d in sc._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString())
    had = there()
    table = landed(spark.range(5000).repartition(4, "id").groupBy((F.col("id") % 7).alias("g")).count(), "groups")
    for _ in range(50):
        if there() <= had:
            break
        time.sleep(0.1)
    assert there() <= had and spark.conf.get(CLEANUP) == before
    assert table.count() == 7
    discard(table)


def test_pairs_of_any_number_of_goes_give_the_same_passages(spark, monkeypatch):
    from skyframe.llm import substring
    rows = []
    for n in range(6):
        lines = [prose(9500 + 10 * n + i, 14) for i in range(4)]
        rows += [(1000 * n + 10 * i + j, " ".join([prose(25000 + 1000 * n + 10 * i + j, 60), lines[i], prose(45000 + 1000 * n + 10 * i + j, 60)])) for i in range(4) for j in range(3)]
        passage = " ".join(lines).split()
        rows += [(1000 * n + 100 + m, " ".join([prose(65000 + 4 * n + m, 60), *passage[:28], *([] if m == 0 else [f"changed{m}"]), *passage[28 + (m > 0):], prose(75000 + 4 * n + m, 60)])) for m in range(3)]
    want = sorted(near_passages(frame(spark, rows)).collect())
    verified, names = [], substring.landed
    monkeypatch.setattr(substring, "AT_ONCE", 1 / 16)
    monkeypatch.setattr(substring, "PARTS", 3)
    monkeypatch.setattr(substring, "FEW", 2)
    monkeypatch.setattr(substring, "landed", lambda df, name: verified.append(name) or names(df, name))
    assert sorted(near_passages(frame(spark, rows)).collect()) == want and want
    assert verified.count("common") == 6


def test_windows_of_texts_at_once_are_those_of_each_text():
    r = np.random.default_rng(4)
    for top in (2, 40, 2**62):
        values, at = r.integers(0, top, 900).astype(np.uint64), np.array([0, 0, 300, 310, 900])
        for least, reach in ((1, 4095), (7, 3), (7, 64), (30, 4095)):
            got = list(zip(*(c.tolist() for c in text_windows(values, at, least, reach))))
            want = [(int(a) + c, min(c - left, reach), min(right - c, reach)) for a, b in zip(at, at[1:]) for left, c, right in (compact_windows(values[a:b], least) if b - a >= least else [])]
            assert got == want
    began = time.process_time()
    text_windows(np.zeros(60_000, np.uint64), np.array([0, 60_000]), 46, 4095)  # equal tokens: about 10 s when neighbours were passed one by one
    assert time.process_time() - began < 3


def test_recall_of_near_copies(spark):
    """Copies of 80 to 95 % likeness with changed, dropped and added words, some behind an earlier text with a part."""
    rows, planted = [], {}
    for n in range(240):
        size, edits = [(60, 1), (80, 1), (100, 2), (150, 3), (200, 2)][n % 5]
        words, i = prose(20_000 + n, size).split(), 10 * n
        copy = list(words)
        for e in range(edits):
            at = (2 * e + 1) * size // (2 * edits)
            copy[at:at + 1] = [["changed" + str(n)], [], [copy[at], "added" + str(n)]][n % 3]
        p, q = shingle_set(" ".join(words), 5), shingle_set(" ".join(copy), 5)
        assert 0.8 <= len(p & q) / len(p | q) <= 0.96
        if n % 4 == 0:
            rows.append((i, " ".join([prose(30_000 + n, 50), *words[:size // 2], prose(31_000 + n, 50)])))
        rows.append((i + 1, " ".join([prose(32_000 + n, 60), *words, prose(33_000 + n, 60)])))
        rows.append((i + 2, " ".join([prose(34_000 + n, 40), *copy, prose(35_000 + n, 80)])))
        planted[i + 2] = (40, 40 + len(copy))
    held = defaultdict(set)
    for r in near_passages(frame(spark, rows)).collect():
        held[r.doc_id] |= set(range(r.start_word, r.end_word))
    found = sum(len(held[i] & set(range(a, b))) >= 0.9 * (b - a) for i, (a, b) in planted.items())
    print("near copies found:", found, "of", len(planted))
    assert found >= 0.9 * len(planted)
    assert all(i % 10 for i in held)


def test_passage_lengths_out_of_range_are_refused(spark):
    for bad in (4, 5000):
        try:
            near_passages(frame(spark), min_words=bad)
        except ValueError:
            continue
        raise AssertionError(bad)
