"""Cells of the Jaccard join: unrelated sets stay apart, linked ones meet."""

import random

import numpy as np
import pytest
from wavepanel.llm import jaccard
from wavepanel.llm.shingles import mix


def unrelated(seed, sizes, common=()):
    """Texts of as many words of their own, with ``common`` words before them."""
    rnd = random.Random(seed)
    return [" ".join([*common, *(f"{rnd.getrandbits(40):x}" for _ in range(n))]) for n in sizes]


def copies(texts):
    """Each text with its last word changed or gone, in turn."""
    return [" ".join(t.split()[:-1] + ["changed"] * (i % 2)) for i, t in enumerate(texts)]


def found(spark, monkeypatch, texts, num=80, k=3):
    """Results by id, and the numbers of sets that were dealt to regions."""
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    members, regions = [], jaccard._regions

    def counted(rows, t, region_rows):
        members.extend(r["count"] for r in rows.groupBy("cell").count().collect())
        return regions(rows, t, region_rows)

    monkeypatch.setattr(jaccard, "_regions", counted)
    out = {r.doc_id: (r.component_id, r.n_links) for r in
           jaccard.jaccard_components(docs, k=k, num=num).collect()}
    return out, members


def brute(texts, num, k=3):
    sets = [{tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))}
            for w in (t.split() for t in texts)]
    links = [[j for j, b in enumerate(sets) if j != i and 100 * len(a & b) >= num * len(a | b)]
             for i, a in enumerate(sets)]
    least = list(range(len(sets)))
    while (new := [min(least[j] for j in (i, *x)) for i, x in enumerate(links)]) != least:
        least = new
    return {i: (least[i], len(x)) for i, x in enumerate(links)}


def test_unrelated_short_texts_share_no_cell(spark, monkeypatch):
    texts = unrelated(1, [5 + i % 60 for i in range(240)])
    texts += copies(texts[40:60])
    out, members = found(spark, monkeypatch, texts)
    assert out == brute(texts, 80)
    assert sum(members) <= 40 and max(members) == 2


def test_common_text_in_a_fifth_of_each_document_connects_none(spark, monkeypatch):
    common = [f"c{i}" for i in range(60)]
    texts = unrelated(2, [240 + 5 * i for i in range(60)], common)
    texts += copies(texts[:4])
    out, members = found(spark, monkeypatch, texts)
    assert out == brute(texts, 80)
    assert len([x for x in out.values() if x[1]]) == 8
    assert sum(members) <= 16


@pytest.mark.parametrize("num", [60, 80, 90])
def test_links_of_all_sizes(spark, monkeypatch, num):
    texts = unrelated(3, [*range(3, 40, 2), 60, 90, 127, 128, 129, 130, 131, 140, 190, 300])
    texts += copies(texts) + [t + " one more" for t in texts]
    texts += [" ".join(t.split()[:int(len(t.split()) * num / 100) + 1]) for t in texts[:28]]
    assert found(spark, monkeypatch, texts, num)[0] == brute(texts, num)


@pytest.mark.parametrize("num", [60, 80, 90])
def test_sets_at_the_threshold_share_what_is_asked_of_one_kind(num):
    t, memo = jaccard.Threshold(num, 100), {}
    s = mix(np.arange(1, 6000, dtype=np.uint64))
    for n in [*range(2, 200, 3), 250, 400, 1000, 2500]:
        m = n * 100 // num
        # a part of the other, or as many shingles of its own on either side
        both = -(-num * 2 * n // (100 + num))
        for a, b in ((s[:n], s[:m]), (s[:n], np.concatenate((s[:both], s[len(s) - (n - both):])))):
            a, b = np.sort(a), np.unique(b)
            if np.array_equal(a, b):
                continue
            keys = [jaccard.slice_keys(x, t, memo) for x in (a, b)]
            kinds = np.intersect1d(*keys) & jaccard.KIND
            asked = {band + 1: x[2] for band, x in memo.items() if x[0]}
            asked[0] = t.least_size(max(len(a), len(b)))
            assert any((kinds == kind).sum() >= least for kind, least in asked.items()), (n, len(b))
