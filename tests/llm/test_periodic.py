"""Periodic runs against brute force, odd rows included."""

import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from wavepanel.llm import periodic
from wavepanel.llm.common import read
from wavepanel.llm.periodic import find_runs, op12_periodic_runs, runs_of

SMOKE = "/root/testdata/sf0.001"


def brute(ws, least=6, times=4):
    out = {}
    for q in range(1, len(ws) // times + 1):
        i = 0
        while i + q < len(ws):
            j = i
            while j + q < len(ws) and ws[j] == ws[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, times * q):
                out.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted((s, n, q) for (s, n), q in out.items())


def collapse(ws, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return [w for i, w in enumerate(ws) if i not in gone]


def some_words(rng):
    ws, size = [], rng.integers(0, 150)
    while len(ws) < size:
        if rng.random() < .5:
            ws += [b"%d" % x for x in rng.integers(0, rng.integers(1, 30), rng.integers(1, 10))]
        else:
            base = [b"%d" % x for x in rng.integers(0, rng.integers(1, 6), rng.integers(1, 9))]
            ws += (base * 9)[:rng.integers(1, 8 * len(base))]
    return ws


@pytest.mark.parametrize("least,times", [(6, 4), (10, 4), (2, 6)])
def test_runs_against_brute_force(least, times):
    rng = np.random.default_rng(least)
    for _ in range(250):
        texts = [some_words(rng) for _ in range(rng.integers(0, 6))]
        got = [[tuple(r) for r in x.tolist()] for x in runs_of(texts, least, times)]
        assert got == [brute(t, least, times) for t in texts]


def test_words_too_rare_in_their_segment_split_it_again():
    # x is common in the text but rare in each part that y leaves
    ws = "x x y x x z a a a a a a x x w x x".encode().split()
    place, segment = periodic.surviving(periodic.numbered(ws), np.array([0]), 6, 4)
    assert place.tolist() == list(range(6, 12)) and len(set(segment.tolist())) == 1


def test_long_texts_take_time_in_proportion():
    for ws, want in (([b"a"] * 400_000, (0, 400_000, 1)),
                     ([b"%d" % (i % 70_001) for i in range(400_000)], (0, 400_000, 70_001))):
        assert [tuple(r) for r in runs_of([ws])[0].tolist()] == [want]


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n\t "), (None, "a " * 9), (4, "a " * 9), (4, "a " * 9),
            (5, "é é " * 7), (6, "a\x0bb\x0ca\rb a b\na b"), (7, "a b c a b c a b c a b")]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, runs string")
    got = sorted((r.doc_id or -1, r.n_words, [tuple(x) for x in r.runs], r.collapsed)
                 for r in find_runs(docs).collect())
    want = []
    for i, t in rows:
        ws = (t or "").encode().split()
        runs = brute(ws)
        want.append((i or -1, len(ws), runs, b" ".join(collapse(ws, runs)).decode()))
    assert got == sorted(want)
    assert find_runs(docs.where("false")).count() == 0


def test_query_against_brute_force(spark):
    got = {r.doc_id: r for r in op12_periodic_runs(spark, SMOKE).collect()}
    docs = read(spark, SMOKE, "documents").collect()
    assert len(got) == len(docs)
    for r in docs:
        ws = (r.text or "").encode().split()
        h, n = zlib.crc32(str(r.doc_id).encode()), len(ws)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            ws = [ws[i] if i < a else ws[a + (i - a) % p] for i in range(n)]
        runs, x = brute(ws), got[r.doc_id]
        best = max(runs, key=lambda b: (b[1], -b[0], -b[2])) if runs else None
        assert (x.n_runs, x.start, x.length, x.period) == (len(runs), *(best or (None,) * 3))
        assert x.exponent_milli == (1000 * best[1] // best[2] if best else None)
        listed = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
        assert x.runs_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert x.collapsed_sha256 == hashlib.sha256(b" ".join(collapse(ws, runs))).hexdigest()


def test_periodic_tails_leave_null_ids_and_texts(spark):
    docs = spark.createDataFrame([(None, "a b c"), (28, None), (28, " ")], "doc_id long, text string")
    same = periodic.with_periodic_tails(docs)
    assert same.columns == docs.columns
    assert sorted(map(repr, same.collect())) == sorted(map(repr, docs.collect()))
    assert same.where(F.col("text").isNull()).count() == 1
