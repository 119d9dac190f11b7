"""Hard negatives against brute force, odd rows included."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from wavepanel.llm import hardnegatives as hn


def brute(rows, is_anchor, low=30, high=90, den=100):
    seen, fine = set(), []
    for i, v, label in rows:
        if i is None or label is None or not v or not all(
                x is not None and math.isfinite(x) for x in v):
            continue
        row = (i, label, tuple(math.floor(256 * float(np.float32(x))) for x in v))
        if row not in seen:
            seen.add(row)
            fine.append(row)
    out = []
    for i, label, v in fine:
        if not is_anchor(i):
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j, m) for j, m, w in fine
                        if j != i and len(w) == len(v))
        for s, j, _ in [x for x in scored if x[2] == label][:5]:
            hard = [(t, n) for t, n, m in scored if m != label
                    and low * -s <= den * -t <= high * -s][:10]
            out += [(i, j, r, n, -s, -t) for r, (t, n) in enumerate(hard, 1)]
    return sorted(out)


def mined(rows, spark, **kw):
    df = spark.createDataFrame([(i, v, m, "x", 1) for i, v, m in rows],
                               "vec_id long, embedding array<float>, label int, v string, dim int")
    whole = hn.integer_vectors(df, "vec_id", "embedding", "label")
    return sorted((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score,
                   r.negative_score) for r in hn.mine(whole, F.col("id") % 10 == 0, **kw).collect())


def some_rows(n, dim, seed, labels=4):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(labels, dim))
    return [(i, (0.6 * centre[i % labels] + rng.normal(size=dim)).tolist(), i % labels)
            for i in range(n)]


@pytest.mark.parametrize("dim,tile,leaf", [(1, 30, 4), (5, 40, 3), (16, 2048, 32)])
def test_against_brute_force(spark, dim, tile, leaf):
    rows = some_rows(260, dim, dim)
    got = mined(rows, spark, tile_rows=tile, leaf_rows=leaf, query_numbers=8 * dim)
    assert got == brute(rows, lambda i: i % 10 == 0)


def test_odd_rows_ties_and_copies(spark):
    rows = some_rows(60, 3, 9)
    same = [0.5, 0.25, -0.125]
    rows += [(100 + i, same, i % 2) for i in range(90)]             # a hot vector: ties
    rows += rows[:5] + [(7, same, 3), (7, same, 3)]                 # repeats, an id used twice
    rows += [(200, None, 1), (210, [1.0, None, 2.0], 1), (220, [float("nan"), 1.0, 1.0], 1),
             (230, [float("inf"), 1.0, 1.0], 2), (240, [1.0, 2.0, 3.0], None), (None, same, 1),
             (250, [], 1), (260, [1.0, 2.0], 1), (270, [1.0, 2.5], 1), (281, [1.0, 2.0], 2),
             (290, [0.0, 0.0, 0.0], 1)]
    got = mined(rows, spark, tile_rows=16, leaf_rows=4)
    assert got == brute(rows, lambda i: i % 10 == 0)


def test_too_large_numbers_take_no_part(spark):
    rows = some_rows(40, 2, 3)
    assert mined(rows + [(50, [1e30, 1.0], 1), (51, [3e38, 0.0], 2)], spark) == mined(rows, spark)


def test_empty_tables(spark):
    assert mined([], spark) == []
    assert mined([(1, [1.0], 1), (2, [1.0], 2)], spark) == []        # no anchor
    assert mined([(10, [1.0], 1), (2, [1.0], 2)], spark) == []       # no positive


def test_boxes_outside_the_window_are_not_opened(monkeypatch):
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.integers(0, 9, (400, 2)), rng.integers(500, 509, (400, 2))]).astype(float)
    label = np.repeat([0, 1], 400)
    order = hn.pack(x, label, 8)
    tree = hn.Tree(np.arange(800)[order], label[order], x[order], 8)
    opened = []
    pop = hn.heapq.heappop
    monkeypatch.setattr(hn.heapq, "heappop", lambda q: opened.append(pop(q)) or opened[-1])
    q = np.array([1.0, 1.0])
    found = hn.Found(np.array([1000.0, 1000.0]), np.array([2000.0, 1005.0]), 3)
    tree.search(q, 0, False, -1, found)
    assert len(opened) < 0.7 * len(tree.levels[0][0])
    for w, high in enumerate((2000, 1005)):
        want = sorted((-int(s), i) for i, s in enumerate(x @ q) if label[i] and 1000 <= s <= high)[:3]
        assert list(zip((-found.score[w]).tolist(), found.ids[w].tolist())) == want


def test_packing_fills_leaves():
    x = np.random.default_rng(2).normal(size=(1000, 6))
    order = hn.pack(x, np.zeros(1000), 25)
    assert sorted(order.tolist()) == list(range(1000))
    sides = [np.ptp(x[order[i:i + 25]], axis=0).prod() for i in range(0, 1000, 25)]
    assert np.mean(sides) < 0.1 * np.ptp(x, axis=0).prod()
