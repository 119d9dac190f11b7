"""License scan against brute force, odd rows included."""

import re

import pytest

from wavepanel.llm import licenses
from wavepanel.llm.licenses import PHRASES, TEMPLATES, scan_licenses

ROWS = [
    (1, None), (2, ""), (3, " \n\t "), (4, "Released under the MIT License."),
    (5, "GNU General Public License; gnu GENERAL public-license, Apache License"),
    (6, "cc by cc by-nc CC\nBY"), (None, "mit license"), (4, "Released under the MIT License."),
    (7, "x " * 70_000 + TEMPLATES[3][1] + " y" * 70_000),
    (8, TEMPLATES[12][1].replace("modify", "change").upper()),
    (9, "naïve Ünï 中文 " + TEMPLATES[14][1].replace(" ", "\n")),
    (10, " ".join(TEMPLATES[3][1].split()[:14]) + " " + "z " * 40 + "are met"),
    (11, "mitlicense mit_license mit 0license"),
]


def words_of(t):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(text, num=90, den=100):
    ws = words_of(text)
    places = [(i, label) for label, p in PHRASES for i in range(len(ws))
              if ws[i:i + len(p.split())] == p.split()]
    base, found = {x for _, x in places}, []
    for label, t in TEMPLATES:
        seq = words_of(t)
        want, window = set(seq), 8
        while window < len(seq):
            window *= 2
        for s in range(0, len(ws), window):
            both = len(want & set(ws[s:s + 2 * window]))
            if den * both >= num * len(want):
                found.append((label, both / len(want)))
    score = 1.0 if base else max((s for _, s in found), default=0.0)
    at = [i for i, _ in places]
    return (len(ws), len(at), min(at, default=None), max(at, default=None),
            ",".join(sorted(base)), ",".join(sorted(base | {x for x, _ in found})), score)


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame([(i, t, "taken", 1) for i, t in ROWS],
                                 "doc_id long, text string, labels string, N_WORDS int")


@pytest.mark.parametrize("num", [90, 70])
def test_against_brute_force(rows, num):
    got = sorted((r.doc_id or -1, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels,
                  r.labels, r.score) for r in scan_licenses(rows, num=num).collect())
    assert got == sorted((i or -1, *brute(t, num)) for i, t in ROWS)


def test_blocks_tell_where_the_template_stands(rows):
    found = {r.doc_id: r.blocks for r in scan_licenses(rows).where("doc_id in (7, 8, 1)").collect()}
    assert found[1] == []
    assert all(70_000 - 64 < b.start <= 70_000 and b.label == "bsd" for b in found[7])
    assert {(b.label, b.shared < b.of) for b in found[8]} == {("mit", True)}


def test_empty_table_and_no_templates(rows):
    assert scan_licenses(rows.where("false")).count() == 0
    assert {(r.labels, r.score) for r in scan_licenses(rows, [], []).collect()} == {("", 0.0)}


def test_prefix_holds_the_rarest_words():
    v = licenses.Vocabulary(licenses.parse_templates([("x", "the of rare")]), [])
    join = licenses.Join(v, {v.words.index(b"the"): 99, v.words.index(b"of"): 50,
                             v.words.index(b"rare"): 1}, 60, 100)
    (_, ranks, least, prefix), = join.by_window[8]
    assert least == 2 and len(prefix) == 2
    assert [v.words[list(join.rank).index(r)] for r in prefix] == [b"rare", b"of"]
