"""Exact top-k search, WARC archives, the registered queries and the pipeline."""

import gzip
import hashlib
import os
import random
import re
import subprocess
import sys
import zlib

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import __spark_entry__ as E  # noqa: E402
import corpus_pipeline  # noqa: E402
from llm_cases import empty, frame, texts  # noqa: E402
from oracle_compare import compare, duck  # noqa: E402
from skyframe.llm import topk  # noqa: E402
from skyframe.llm.queries import ORACLE, QUERIES  # noqa: E402
from skyframe.llm.stages import STAGES  # noqa: E402
from skyframe.llm.topk import top_k  # noqa: E402
from skyframe.llm.warc import member, read_archives, record, resolve, salvage, seek, starts, write_archives  # noqa: E402
from skyframe.session import scratch_path  # noqa: E402


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, sf_dir, name):
    problems, n = compare(QUERIES[name](spark, sf_dir), duck(sf_dir), ORACLE[name])
    assert problems == [] and n > 0


def brute(rows, asked, k):
    out = []
    for q, v in asked:
        hits = sorted((-int(np.dot(v, w)), i) for i, w in rows if i != q and len(w) == len(v))
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(hits[:k])]
    return sorted(out)


def test_top_k_with_ties_blocks_and_lengths(spark, monkeypatch):
    r = random.Random(4)
    rows = [(i, [r.randint(-3, 3) for _ in range(4)]) for i in range(300)] + [(1000 + i, [1, 1, 1, 1]) for i in range(200)] + [(2000 + i, [r.randint(-9, 9), 5]) for i in range(5)]
    table = spark.createDataFrame([(i, [x / 1024 for x in v], "a") for i, v in rows], "vec_id long, embedding array<double>, id string").repartition(7)
    for block in (1 << 20, 16):
        monkeypatch.setattr(topk, "BLOCK_VALUES", block)
        asked = [x for x in rows if x[0] in (0, 7, 1000, 2001)]
        got = top_k(table, table.filter("vec_id IN (0, 7, 1000, 2001)"), k=6).collect()
        assert sorted(map(tuple, got)) == brute(rows, asked, 6)


def test_top_k_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [0.5, -0.5]), (1, [1e5, 2.0]), (2, None), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, [None, 1.0]), (None, [1.0, 1.0]), (6, []), (7, [-1.0, 0.0]), (7, [-1.0, 0.0]), (8, [3e8, 1.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [tuple(r) for r in top_k(table, table.filter("vec_id = 0")).orderBy("rank").collect()]
    q = [512, -512]
    want = sorted([(8, 512 * int(3e8 * 1024) - 512 * 1024), (1, 512 * int(1e5 * 1024) - 512 * 2048), (7, -512 * 1024), (7, -512 * 1024)], key=lambda x: (-x[1], x[0]))
    assert got == [(0, n + 1, i, s) for n, (i, s) in enumerate(want)] and q
    assert top_k(table, table.limit(0)).collect() == [] and top_k(table.limit(0), table).collect() == []
    assert top_k(table, table.filter("vec_id = 6")).collect() == []
    big = spark.createDataFrame([(i, [float(2**20 + i)] * 2) for i in range(5)], "vec_id long, embedding array<double>")
    assert [r.score for r in top_k(big, big.filter("vec_id = 0")).orderBy("rank").collect()] == [2 * 1024 * 2**20 * 1024 * (2**20 + i) for i in (4, 3, 2, 1)]


def raw(i, body, refers=None):
    return record(i, "http://x/", body, len(body), hashlib.sha256(body).hexdigest(), refers)


BODIES = [os.urandom(300) if i % 2 else f"<p>{i} WARC/1.1 \x1f</p>".encode() * 20 for i in range(8)]


def read(data):
    """(start, end, page) of records; page is None for a gap, -1 where the record's name is damaged."""
    page = lambda f: None if f is None else int(m[1]) if (m := re.fullmatch(r"<urn:page:(\d+)>", f["warc-record-id"])) else -1
    return [(a, b, page(f)) for a, b, f, _ in salvage(data)]


@pytest.mark.parametrize("packed", [True, False])
def test_salvage_recovers_all_but_damaged_records(packed):
    parts = [member(raw(i, b)) + b"\0" if packed else raw(i, b) for i, b in enumerate(BODIES)]
    at = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).tolist()
    whole = b"".join(parts)
    assert [i for _, _, i in read(whole)] == list(range(8))
    r = random.Random(7)
    for _ in range(60):
        hit = r.randrange(8)
        data, kind = bytearray(whole), r.randrange(4)
        spot = at[hit] + r.randrange(len(parts[hit]) // 2)
        if kind == 0:
            data[spot:spot + 40] = os.urandom(40)
        elif kind == 1:
            del data[spot:spot + 30]
        elif kind == 2:
            data = data[:at[hit + 1] - 9]
        else:
            data[spot:spot] = b"\x1f\x8b\x08junk WARC/1.1\r\n\r\n"
        found = read(bytes(data))
        good = [i for _, _, i in found if i is not None and i != -1]
        assert set(good) >= set(range(hit if kind == 2 else 8)) - {hit} and good == sorted(set(good))
        gaps = [(a, b) for a, b, i in found if i is None]
        assert gaps or hit in good or not packed
        if not packed or kind != 2:
            covered = sorted((a, b) for a, b, _ in found)
            assert all(b >= c for (_, b), (c, _) in zip(covered, covered[1:])) and covered[0][0] == 0


def test_salvage_takes_one_member_and_foreign_records():
    plain = b"".join(raw(i, b) for i, b in enumerate(BODIES))
    assert [i for _, _, i in read(gzip.compress(plain))] == list(range(8))
    assert [i for _, _, i in read(b"noise" + plain[:-4] + gzip.compress(raw(9, b"q")))] == [None, *range(7), None, 9]
    assert read(b"") == [] and read(b"\0\0") == [] and read(b"abc") == [(0, 3, None)]
    foreign = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:page:5>\r\nContent-Length: 2\r\n\r\nok\r\n\r\n"
    assert read(foreign) == [(0, len(foreign), 5)]


def test_records_before_the_damage_of_one_member_are_kept():
    parts = [raw(i, b) for i, b in enumerate(BODIES)]
    data = gzip.compress(b"".join(parts))
    stop = zlib.compressobj(wbits=31)
    cut = stop.compress(b"".join(parts[:5])) + stop.flush(zlib.Z_FULL_FLUSH)
    for broken in (data[:-200], data[:-9], cut + parts[5][:9], cut + b"\xff" * 60, data[:-8] + b"12345678", cut + b"\xff" * 60 + gzip.compress(parts[7])):
        found = read(broken)
        good = [i for _, _, i in found if i is not None]
        assert good[:5] == [0, 1, 2, 3, 4] and good == sorted(set(good)), found
        assert all(b == c or b == f for (a, b, _), (c, f, _) in zip(found, found[1:])) and found[-1][1] == len(broken)
        assert {a for a, _, i in found if i is not None} <= {0, len(broken) - len(gzip.compress(parts[7]))}
    plain = b"".join(b"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:%d>\r\nContent-Length: 300\r\n\r\n%s\r\n\r\n" % (i, os.urandom(300)) for i in range(9))
    assert [i for _, _, i in read(gzip.compress(plain)[:-400])] == [*range(7), None]


def test_damaged_files_are_read_by_spark(spark, tmp_path):
    good = [member(raw(i, b)) + b"\0" for i, b in enumerate(BODIES)]
    (tmp_path / "a.warc.gz").write_bytes(good[0] + good[1][:50] + good[2])
    (tmp_path / "b.warc").write_bytes(b"")
    rows = read_archives(spark, str(tmp_path)).collect()
    assert sorted((r.start, r.record_id, r.quarantined) for r in rows) == [(0, "<urn:page:0>", False), (len(good[0]), None, True), (len(good[0]) + 50, "<urn:page:2>", False)]
    assert [bytes(r.body) for r in rows if r.record_id == "<urn:page:2>"] == [BODIES[2]]


@pytest.mark.parametrize("packed", [True, False])
def test_heads_of_any_length_are_read_back(packed):
    url = "http://h/" + "u" * 2_500_000
    many = [record(i, url if i == 1 else "u", b"body %d" % i, 6, hashlib.sha256(b"body %d" % i).hexdigest(), None) for i in range(3)]
    data = b"".join(member(r) + b"\0" if packed else r for r in many)
    found = list(salvage(data))
    assert [(f["warc-target-uri"], b) for _, _, f, b in found] == [("u", b"body 0"), (url, b"body 1"), ("u", b"body 2")]
    # a head that never ends is a gap, and what follows it is read
    cut = many[1].replace(b"\r\n\r\n", b"\r\n")
    assert [f and f["warc-record-id"] for _, _, f, _ in salvage(many[0] + cut + many[2])] == ["<urn:page:0>", None, "<urn:page:2>"]


def test_marks_across_pieces_are_found():
    for at in (0, 4089, 4095, 4096, 4097, 12287, (1 << 21) + 4095):
        data = memoryview(b"x" * at + b"WARC/1." + b"y" * 10)
        assert seek(data, b"WARC/1.", 0) == at and starts(data, b"WARC/1.", at) and seek(data, b"WARC/1.", at + 1) == -1


def test_members_end_in_a_zero():
    for size in (0, 1, 1 << 24, (1 << 24) + 5):
        assert zlib.decompressobj(31).decompress(member(b"x" * size) + b"\0") == b"x" * size


def test_archive_cases(spark):
    long, short = "ä" * 80, "same"
    rows = [(5, long, "u"), (3, long, None), (9, long, "u\r\nX: y"), (None, long, "u"), (3, long, "u"), (1, short, "u"), (2, short, "u"), (7, None, "u"), (8, "", "u"), (4, "z" * 3_000_000, "u"), (6, "far", "u" * 2_000_000)]
    pages = spark.createDataFrame([(i, t, u, "d", "e") for i, t, u in rows], "page_id long, html string, url string, id string, body string")
    got = sorted((str(r.id), r.payload_bytes, r.refers_to) for r in resolve(pages).collect())
    assert got == sorted([("3", 160, None), ("3", 160, None), ("5", 160, 3), ("9", 160, 3), ("None", 160, 3), ("1", 4, None), ("2", 4, None), ("7", 0, None), ("8", 0, None), ("4", 3_000_000, None), ("6", 3, None)])
    path = scratch_path(spark, "w")
    write_archives(pages, path)
    back = read_archives(spark, path).collect()
    assert len(back) == 11 and {len(r.url) for r in back if r.url} >= {1, 2_000_000} and not any(r.quarantined for r in back)
    assert sorted((r.record_id, r.record_type, r.payload_bytes, bytes(r.body).decode()) for r in back if r.record_type == "response" and r.payload_bytes > 160)[0][3] == "z" * 3_000_000
    nothing = scratch_path(spark, "w")
    write_archives(pages.limit(0), nothing)
    assert read_archives(spark, nothing).collect() == []


def test_pipeline_stages_take_all_cases(spark, sf_dir):
    docs = frame(spark).select("doc_id", "text", "lang", "source", "n_chars")
    for name, stage in STAGES:
        out, none = stage(spark, docs, sf_dir), stage(spark, empty(spark).select(docs.columns), sf_dir)
        assert none.count() == 0
        if name != "bpe":
            assert out.columns == docs.columns
        if name == "near_dedup":
            kept = [r.doc_id for r in out.collect()]
            assert 10 in kept and 11 not in kept and kept.count(50) == 2 and kept.count(None) == 2
        if name == "substring_dedup":
            assert out.count() == len(texts())


def test_pipeline_equals_its_stages(spark, sf_dir):
    """The near-duplicate stage keeps the least id of brute-force groups among what the network leaves; the last stage's
    ids decode to the texts of the stage before it."""
    from test_llm_dedup import brute_components
    from llm_cases import shingle_set

    docs, seen = spark.read.parquet(f"{sf_dir}/documents.parquet"), {}
    from skyframe.llm.scratch import landed
    for name, stage in STAGES[:-1]:
        docs = seen[name] = landed(stage(spark, docs, sf_dir), name)
    left = {r.doc_id: shingle_set(r.text, 5) for r in seen["toxicity"].collect()}
    want = brute_components(left)
    assert sorted(r.doc_id for r in seen["near_dedup"].collect()) == sorted(i for i in left if want[i] == i)
    assert seen["substring_dedup"].count() == seen["near_dedup"].count()
    end = {r.doc_id: r for r in corpus_pipeline.run(spark, sf_dir).collect()}
    assert {i: r.decoded for i, r in end.items()} == {r.doc_id: r.text for r in seen["mixing"].collect()}
    assert all(r.n_tokens == len(r.ids) for r in end.values())


def test_all_queries_are_registered():
    names = list(E.queries())
    assert sorted(int(n[2:].split("_")[0]) for n in names if n.startswith("op") and n[2].isdigit()) == list(range(1, 14)) and "pipeline" in names


def test_entry_works_without_the_subpackage(tmp_path):
    root = os.path.dirname(os.path.abspath(E.__file__))
    for name in os.listdir(root):
        if name not in ("corpus_pipeline.py", "skyframe", ".git"):
            os.symlink(os.path.join(root, name), tmp_path / name)
    os.mkdir(tmp_path / "skyframe")
    for name in os.listdir(os.path.join(root, "skyframe")):
        if name not in ("llm", "__pycache__"):
            os.symlink(os.path.join(root, "skyframe", name), tmp_path / "skyframe" / name)
    (tmp_path / "entry.py").write_text(open(E.__file__).read())
    code = "import sys; sys.path.insert(0, '.'); import entry; assert len(entry.queries()) > 40 and not any(n.startswith('op') for n in entry.queries())"
    env = {**os.environ, "PYTHONPATH": str(tmp_path)}
    subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, env=env, check=True)
