"""License scan: an exact set-similarity join of text blocks with templates.

A template is a set of words with a label.  A block is a window of 2w
neighbouring words that starts at a multiple of w, where w is the power of two
(8 at least) that holds the template's text; so every stretch as long as the
template lies wholly in a block.  A block matches when it holds at least
``num`` in ``den`` of the template's distinct words.

1. One pass over the texts keeps, of each document, the places of the words
   that occur in any template; no other word can join.
2. Those words are counted over all documents, and ordered by that count.
3. Join.  *Prefix filter*: a match must share one of the template's rarest
   words (as many as it may lack, and one more), so only blocks around those
   are looked at.  *Length filter*: a block needs as many template words as a
   match takes.  *Positional filter*: the words that come after the first
   shared one, in the block's order and in the template's, must still suffice.
   What is left is compared word for word.

The same pass finds the phrases, word sequences that name a license outright.
Nothing is shuffled but the counts of the template words.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .common import own_columns, read, schema, small_batches
from .shingles import words as hashed_words

# The phrases that name a license, and their labels.
PHRASES = [
    ("gpl", "gnu general public license"),
    ("apache", "apache license"),
    ("cc-by", "cc by"),
    ("mit", "mit license"),
]

# Notices that the licenses themselves ask to be used.
TEMPLATES = [
    ("agpl", "You should have received a copy of the GNU Affero General Public License "
             "along with this program"),
    ("apache", "Licensed under the Apache License, Version 2.0; you may not use this file except "
               "in compliance with the License. You may obtain a copy of the License at"),
    ("apache", "Unless required by applicable law or agreed to in writing, software distributed "
               "under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
               "CONDITIONS OF ANY KIND, either express or implied"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, "
            "are permitted provided that the following conditions are met"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc", "licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "licensed under CC BY-SA 4.0"),
    ("cc0", "has waived all copyright and related or neighboring rights to this work worldwide "
            "under the CC0 public domain dedication"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the "
            "terms of the GNU General Public License as published by the Free Software Foundation"),
    ("gpl-3", "licensed under the GNU General Public License, version 3"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose "
            "with or without fee is hereby granted, provided that the above copyright notice and "
            "this permission notice appear in all copies"),
    ("lgpl", "You should have received a copy of the GNU Lesser General Public License "
             "along with this library"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
            "software and associated documentation files, to deal in the Software without "
            "restriction, including without limitation the rights to use, copy, modify, merge, "
            "publish, distribute, sublicense, and/or sell copies of the Software"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
]

# Words are the runs of digits, letters and all characters beyond ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_FOLD = bytes(b if b >= 0x80 or chr(b).isdigit() or chr(b).islower()
              else b + 32 if chr(b).isupper() else 0x20 for b in range(256))
LEAST_WINDOW = 8


def folded(text: str | None) -> bytes:
    """Lower-cased bytes in which everything between words is a space."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD)


@dataclass(frozen=True)
class Template:
    name: int
    label: str
    words: tuple[bytes, ...]             # distinct
    window: int                          # blocks are twice as long

    def least(self, num: int, den: int) -> int:
        return max(1, -(-len(self.words) * num // den))


def parse_templates(pairs: Sequence[tuple[str, str]]) -> list[Template]:
    """Templates of (label, text); texts without words are left out."""
    out = []
    for label, text in pairs:
        seq = folded(text).split()
        if seq:
            window = max(LEAST_WINDOW, 1 << (len(seq) - 1).bit_length())
            out.append(Template(len(out), label, tuple(sorted(set(seq))), window))
    return out


class Vocabulary:
    """Numbers of the words of all templates and phrases."""

    def __init__(self, templates: list[Template], phrases: Sequence[tuple[str, str]]):
        self.phrase_words = [(label, folded(p).split()) for label, p in phrases]
        self.words = sorted({w for t in templates for w in t.words}
                            | {w for _, p in self.phrase_words for w in p})
        number = {w: i for i, w in enumerate(self.words)}
        self.templates = [(t, [number[w] for w in t.words]) for t in templates]
        self.phrases = [(label, [number[w] for w in p]) for label, p in self.phrase_words if p]

    @cached_property
    def table(self) -> tuple[np.ndarray, np.ndarray]:
        """Sorted hashes of the words and the words' numbers."""
        h = np.concatenate([x[:1] for x in hashed_words(self.words)])
        order = np.argsort(h)
        return h[order], order.astype(np.int32)

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places, numbers) of the vocabulary's words among ``hashes``."""
        known, number = self.table
        at = np.searchsorted(known, hashes)
        at[at == len(known)] = 0
        place = np.flatnonzero(known[at] == hashes)
        return place, number[at[place]]

    def phrase_places(self, place: np.ndarray, number: np.ndarray) -> list[tuple[str, np.ndarray]]:
        """(label, start places) of the phrases that stand in a document."""
        seen = np.bincount(number, minlength=len(self.words))
        out = []
        for label, phrase in self.phrases:
            if not all(seen[w] for w in phrase):
                continue
            starts = place[number == phrase[0]]
            for i, w in enumerate(phrase[1:], 1):
                starts = starts[np.isin(starts + i, place[number == w])]
            if len(starts):
                out.append((label, starts))
        return out


def _int_lists(parts: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    ends = np.cumsum([0, *(len(p) for p in parts)])
    flat = np.concatenate(parts) if parts else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, kind))


def _tokenise(vocabulary: Vocabulary):
    """Arrow function: (id, text) -> word count, phrases, template words."""
    def run(batches):
        for b in batches:
            n, base, first, last, labels, places, numbers = ([] for _ in range(7))
            for h in hashed_words([folded(t) for t in b.column(1).to_pylist()]):
                place, number = vocabulary.find(h)
                found = vocabulary.phrase_places(place, number) if len(place) else []
                n.append(len(h))
                base.append(sum(len(s) for _, s in found))
                first.append(min((int(s[0]) for _, s in found), default=None))
                last.append(max((int(s[-1]) for _, s in found), default=None))
                labels.append(sorted({label for label, _ in found}))
                places.append(place)
                numbers.append(number)
            long = pa.int64()
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, long), pa.array(base, long), pa.array(first, long),
                 pa.array(last, long), pa.array(labels, pa.list_(pa.string())),
                 _int_lists(places, pa.int64()), _int_lists(numbers, pa.int32())],
                names=["id", "n_words", "n_base", "first_word", "last_word", "_base",
                       "_place", "_number"])
    return run


class Join:
    """The templates against the blocks of one document at a time."""

    def __init__(self, vocabulary: Vocabulary, counts: dict[int, int], num: int, den: int):
        many = len(vocabulary.words)
        order = sorted(range(many), key=lambda w: (counts.get(w, 0), w))
        self.rank = np.empty(many, np.int32)      # 0: the rarest word
        self.rank[order] = np.arange(many, dtype=np.int32)
        self.by_window: dict[int, list] = {}
        for t, numbers in vocabulary.templates:
            ranks = np.sort(self.rank[numbers])
            least = t.least(num, den)
            self.by_window.setdefault(t.window, []).append(
                (t, ranks, least, ranks[:len(ranks) - least + 1]))

    def blocks(self, place: np.ndarray, number: np.ndarray) -> list[tuple]:
        """(template, start, shared words, template words) of each match."""
        ranks = self.rank[number]
        out = []
        for window, templates in self.by_window.items():
            prefix = np.unique(np.concatenate([p for _, _, _, p in templates]))
            rare = place[np.isin(ranks, prefix)] // window
            if not len(rare):
                continue
            near = np.unique(np.concatenate((rare, rare - 1)))
            for start in near[near >= 0].tolist():
                lo, hi = np.searchsorted(place, [start * window, (start + 2) * window])
                block = np.unique(ranks[lo:hi])
                for t, words, least, rarest in templates:
                    if len(block) < least:                              # length
                        continue
                    shared = rarest[np.isin(rarest, block)]
                    if not len(shared):                                 # prefix
                        continue
                    i = int(np.searchsorted(words, shared[0]))
                    j = int(np.searchsorted(block, shared[0]))
                    if min(len(words) - i, len(block) - j) < least:     # position
                        continue
                    both = int(np.isin(words, block).sum())
                    if both >= least:
                        out.append((t.name, start * window, both, len(words)))
        return sorted(out)


def _match(vocabulary: Vocabulary, counts: dict[int, int], num: int, den: int):
    def run(batches):
        join = Join(vocabulary, counts, num, den)
        label = [t.label for t, _ in vocabulary.templates]
        for b in batches:
            places, numbers = b.column("_place"), b.column("_number")
            found, labels, score = [], [], []
            for i, base in enumerate(b.column("_base").to_pylist()):
                place = places[i].values.to_numpy()
                got = join.blocks(place, numbers[i].values.to_numpy()) if len(place) else []
                found.append([{"template": t, "label": label[t], "start": s, "shared": c, "of": n}
                              for t, s, c, n in got])
                labels.append(",".join(sorted({*base, *(label[t] for t, *_ in got)})))
                score.append(1.0 if base else max((c / n for _, _, c, n in got), default=0.0))
            kind = pa.list_(pa.struct([("template", pa.int32()), ("label", pa.string()),
                                       ("start", pa.int64()), ("shared", pa.int32()),
                                       ("of", pa.int32())]))
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in ("id", "n_words", "n_base", "first_word", "last_word")),
                 pa.array([",".join(x) for x in b.column("_base").to_pylist()], pa.string()),
                 pa.array(labels, pa.string()), pa.array(score, pa.float64()),
                 pa.array(found, kind)],
                names=["id", "n_words", "n_base", "first_word", "last_word", "base_labels",
                       "labels", "score", "blocks"])
    return run


def scan_licenses(docs: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES,
                  phrases: Sequence[tuple[str, str]] = PHRASES, num: int = 90, den: int = 100,
                  text: str = "text", row_id: str = "doc_id") -> DataFrame:
    """Per row: n_words, n_base (places of phrases), first_word, last_word
    (their least and greatest start), base_labels, labels, score and blocks.

    ``blocks`` lists every block that holds ``num`` in ``den`` of a template's
    distinct words: template (its place in the list), label, start (a word
    number), shared and of (words).  ``labels`` adds their labels to those of
    the phrases.  score is 1 with a phrase, else the greatest share found, else
    0.  A text that holds a longer license which contains a shorter one gets
    both labels.

    A null text counts as empty: no words, no labels, score 0.  Repeated rows
    and rows with a null id are scanned each by itself.  An empty table gives
    an empty result.  Only ``row_id`` and ``text`` are read, so columns with
    the names of the results do no harm.
    """
    vocabulary = Vocabulary(parse_templates(templates), phrases)
    kind = docs.schema[row_id].dataType.simpleString()
    head = f"id {kind}, n_words long, n_base long, first_word long, last_word long, "
    rows = small_batches(docs).select(F.col(row_id).alias("id"), F.col(text).alias("text"))
    if not vocabulary.words:
        vocabulary = Vocabulary(parse_templates([("", "0")]), [])
        templates = []
    held = stage(rows.mapInArrow(_tokenise(vocabulary), schema(
        head + "_base array<string>, _place array<long>, _number array<int>")), "license-words")
    # one row per word of the templates, whatever the corpus holds
    counts = {r["w"]: r["n"] for r in
              held.select(F.explode("_number").alias("w")).groupBy("w")
              .agg(F.count(F.lit(1)).alias("n")).collect()}
    if not templates:
        vocabulary.templates = []
    ddl = (head + "base_labels string, labels string, score double, blocks array<struct<"
           "template:int, label:string, start:long, shared:int, of:int>>")
    return (held.mapInArrow(_match(vocabulary, counts, num, den), schema(ddl))
            .withColumnRenamed("id", row_id))


def op11_license_join(spark, sf_dir):
    docs = own_columns(read(spark, sf_dir, "documents"), ["n_words", "labels", "score"])
    return scan_licenses(docs).drop("blocks")


def _values(rows) -> str:
    def show(v):
        return "'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v)
    return ", ".join("(" + ", ".join(map(show, r)) + ")" for r in rows)


def license_sql(num: int = 90, den: int = 100) -> str:
    """The query by brute force: every block against every template."""
    templates = parse_templates(TEMPLATES)
    words = _values([(t.name, t.label, t.window, t.least(num, den), len(t.words), w.decode())
                     for t in templates for w in t.words])
    phrases = _values([(label, p) for label, p in PHRASES])
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""
        WITH d AS (
            SELECT doc_id, row_number() OVER () AS rid,
                   regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'),
                                      '{WORD}') AS ws
            FROM documents),
        w AS (SELECT rid, unnest(ws) AS word, generate_subscripts(ws, 1) - 1 AS pos FROM d),
        p(label, phrase) AS (VALUES {phrases}),
        q AS (SELECT label, unnest(string_split(phrase, ' ')) AS word,
                     generate_subscripts(string_split(phrase, ' '), 1) - 1 AS nth,
                     len(string_split(phrase, ' ')) AS many FROM p),
        base AS (
            SELECT rid, label, pos - nth AS start FROM w JOIN q USING (word)
            GROUP BY rid, label, pos - nth, many HAVING count(*) = many),
        bases AS (
            SELECT rid, count(*) AS n_base, min(start) AS first_word, max(start) AS last_word,
                   list(DISTINCT label) AS labels FROM base GROUP BY rid),
        t(template, label, win, least, total, word) AS (VALUES {words}),
        hit AS (
            SELECT rid, template, label, least, total, word, unnest([pos // win, pos // win - 1]) AS start
            FROM w JOIN t USING (word)),
        block AS (
            SELECT rid, label, count(DISTINCT word) / total AS share
            FROM hit WHERE start >= 0 GROUP BY rid, template, label, least, total, start
            HAVING count(DISTINCT word) >= least),
        blocks AS (SELECT rid, max(share) AS share, list(DISTINCT label) AS labels
                   FROM block GROUP BY rid)
        SELECT d.doc_id, CAST(len(d.ws) AS BIGINT) AS n_words,
               CAST(coalesce(b.n_base, 0) AS BIGINT) AS n_base,
               CAST(b.first_word AS BIGINT) AS first_word,
               CAST(b.last_word AS BIGINT) AS last_word,
               coalesce(array_to_string(list_sort(b.labels), ','), '') AS base_labels,
               array_to_string(list_sort(list_distinct(list_concat(
                   coalesce(b.labels, []), coalesce(k.labels, [])))), ',') AS labels,
               CASE WHEN b.rid IS NOT NULL THEN 1.0 ELSE coalesce(k.share, 0.0) END::DOUBLE AS score
        FROM d LEFT JOIN bases b USING (rid) LEFT JOIN blocks k USING (rid)
    """
