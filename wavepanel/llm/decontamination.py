"""Benchmark decontamination by latent semantic retrieval.

1. TF-IDF: words are hashed to buckets that the benchmark uses; the weight of a
   bucket comes from the number of corpus passages that hold it, counted over
   all documents.  Every word of the benchmark keeps a weight, however many
   passages hold it, so a leak in many documents does not hide itself.
2. Latent space: a distributed randomised SVD of the benchmark's TF-IDF
   passages.  Each power step multiplies by the matrix and its transpose in
   the tasks that hold the rows, and sums the partial products by bucket; only
   the buckets-by-rank factor is made orthogonal on the driver.
3. Search: overlapping windows of every document are projected (a running sum
   over the words gives all windows at once) and compared by cosine with the
   items, which come in blocks of a fixed size.
4. A candidate counts if the longest common subsequence of item and passage
   covers most of the item and of its answer, so that paraphrases with
   inserted, dropped or replaced words are found and shared vocabulary is not
   enough.  Pairs of item and passage that share too few words for that are
   passed over beforehand, by counts over the postings of the item words.
5. Items too short for a vector are looked up word for word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .common import give_back, own_columns, read, schema, small_batches
from .shingles import words

BUCKETS = 1 << 16
RANK = 64
POWER_STEPS = 2
WIDTH, STRIDE = 64, 32        # words of a window, and from one window to the next
COSINE = 0.35                 # of a candidate
COVER, ANSWER_COVER = 0.7, 0.5
SURE = 0.9                    # cover of the item that needs no answer check
MIN_WORDS = 8                 # shorter items count where all their words stand in order
ENOUGH = COVER * 0.8          # share of an item's distinct words that a passage must hold
ITEM_BLOCK = 20_000           # items that are sent to the tasks at a time

_PLAIN = bytes(0x20 if 0x21 <= c <= 0x2F or 0x3A <= c <= 0x40 or 0x5B <= c <= 0x60
               or 0x7B <= c <= 0x7E else c for c in range(256))


def plain_words(texts: list) -> list[np.ndarray]:
    """Word hashes without ASCII punctuation and without case."""
    return list(words([(t or "").lower().encode().translate(_PLAIN) for t in texts]))


def buckets_of(h: np.ndarray) -> np.ndarray:
    return (h & np.uint64(BUCKETS - 1)).astype(np.int64)


def passage_counts(docs: DataFrame, text: str, used: np.ndarray) -> tuple[int, np.ndarray]:
    """(passages, passages that hold each bucket) over all documents."""
    sent = docs.sparkSession.sparkContext.broadcast(np.packbits(used).tobytes())   # 8 KB

    def run(batches):
        mine = np.unpackbits(np.frombuffer(sent.value, np.uint8))[:BUCKETS].astype(bool)
        total, count = 0, np.zeros(BUCKETS, np.int64)
        for b in batches:
            parts, first = [], 0
            for h in plain_words(b.column(0).to_pylist()):
                n = -(-len(h) // WIDTH)
                if n:
                    bucket = buckets_of(h)
                    at = np.flatnonzero(mine[bucket])
                    parts.append((first + at // WIDTH) * BUCKETS + bucket[at])
                first += n
            total += first
            if parts:
                held = np.unique(np.concatenate(parts)) % BUCKETS
                count += np.bincount(held, minlength=BUCKETS)
        at = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(([-1], at)), pa.int64()),
             pa.array(np.concatenate(([total], count[at])), pa.int64())], names=["b", "n"])
        give_back()

    found = (docs.select(text).mapInArrow(run, schema("b long, n long"))
             .groupBy("b").agg(F.sum("n").alias("n")).collect())     # BUCKETS + 1 rows at most
    count = np.zeros(BUCKETS, np.int64)
    total = 0
    for r in found:
        if r["b"] < 0:
            total = r["n"]
        else:
            count[r["b"]] = r["n"]
    return total, count


def weights(total: int, count: np.ndarray, used: np.ndarray) -> np.ndarray:
    """Smoothed inverse passage frequency, at least 1; 0 for unused buckets."""
    w = 1 + np.log(max(total, 1) + 1) - np.log(count + 1)
    return np.where(used, np.maximum(w, 1), 0).astype(np.float32)


def randomised_svd(items: DataFrame, text: str, weight: np.ndarray, rank: int = RANK
                   ) -> tuple[np.ndarray, np.ndarray]:
    """(buckets in use, basis): the right singular directions of the TF-IDF rows.

    Halko's range finder on the transposed matrix: the basis starts random and
    is multiplied by A^T A a few times, made orthogonal in between.
    """
    live = np.flatnonzero(weight)
    place = np.full(BUCKETS, -1, np.int64)
    place[live] = np.arange(len(live))
    rank = min(rank, len(live))
    rng = np.random.default_rng(11)
    basis = np.linalg.qr(rng.standard_normal((len(live), rank)))[0] if rank else np.zeros((0, 1))
    spark = items.sparkSession
    for _ in range(POWER_STEPS + 1):
        if not rank:
            break
        sent = spark.sparkContext.broadcast((place, weight, basis.astype(np.float32)))  # 16 MB

        def run(batches):
            spot, w, q = sent.value
            acc: dict[int, np.ndarray] = {}
            for b in batches:
                for h in plain_words(b.column(0).to_pylist()):
                    bucket = buckets_of(h)
                    bucket = bucket[spot[bucket] >= 0]
                    if not len(bucket):
                        continue
                    at, tf = np.unique(spot[bucket], return_counts=True)
                    row = tf * w[np.unique(bucket)][np.argsort(np.argsort(at))]
                    row = row / np.linalg.norm(row)
                    y = row @ q[at]
                    for i, x in zip(at.tolist(), row.tolist()):
                        acc[i] = acc.get(i, 0) + x * y
            keys = sorted(acc)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int32()),
                 pa.array([acc[k].astype(np.float64).tolist() for k in keys],
                          pa.list_(pa.float64()))], names=["i", "y"])
            acc.clear()
            give_back()

        parts = items.select(text).mapInArrow(run, schema("i int, y array<double>"))
        summed = parts.groupBy("i").agg(F.array(*[F.sum(F.col("y")[j]) for j in range(rank)])
                                        .alias("y")).collect()     # buckets x rank numbers
        got = np.zeros((len(live), rank))
        for r in summed:
            got[r["i"]] = r["y"]
        basis = np.linalg.qr(got)[0]
    return live, basis.astype(np.float32)


def common_subsequence(a: list[int], b: list[int]) -> int:
    """Length of the longest common subsequence, a bit per word of ``a``."""
    where: dict[int, int] = {}
    for i, x in enumerate(a):
        where[x] = where.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for x in b:
        m = where.get(x)
        if m:
            u = row & m
            row = ((row + u) | (row - u)) & full
    return len(a) - row.bit_count()


class Searcher:
    """The items of a block in the latent space."""

    def __init__(self, items: list[tuple], weight: np.ndarray, live: np.ndarray,
                 basis: np.ndarray):
        self.ids = [i for i, _, _ in items]
        self.words = [w for _, w, _ in items]
        self.answers = [a for _, _, a in items]
        self.sets = [frozenset(w) for w in self.words]
        # a row per bucket in use, and a last one without weight
        self.factor = np.vstack((weight[live][:, None] * basis, np.zeros((1, basis.shape[1]))))
        self.factor = self.factor.astype(np.float32)
        self.place = np.full(BUCKETS, len(live), np.int32)
        self.place[live] = np.arange(len(live))
        vectors = np.array([self.factor[self.place[buckets_of(np.array(w, np.uint64))]].sum(0)
                            for w in self.words], np.float32)
        norm = np.linalg.norm(vectors, axis=1, keepdims=True)
        self.vectors = (vectors / np.where(norm > 0, norm, 1)).T.copy()
        # postings: the items that hold each distinct item word
        flat = np.array([w for s in self.sets for w in sorted(s)], np.uint64)
        item = np.repeat(np.arange(len(items)), [len(s) for s in self.sets])
        self.vocabulary, word = np.unique(flat, return_inverse=True)
        order = np.argsort(word, kind="stable")
        self.posted = item[order]
        self.posting = np.searchsorted(word[order], np.arange(len(self.vocabulary) + 1))
        self.need = np.array([ENOUGH * len(s) for s in self.sets])
        # blocks of STRIDE words that a passage reaches beyond its window
        self.span = np.array([-(-self.reach(i) // STRIDE) for i in range(len(items))], np.int64)

    def reach(self, i: int) -> int:
        return max(0, len(self.words[i]) - STRIDE // 2)

    def sharing(self, h: np.ndarray) -> tuple:
        """(items that share enough words with a document, its item words'
        places and numbers, which of these words each such item has)."""
        known = np.searchsorted(self.vocabulary, h)
        known[known == len(self.vocabulary)] = 0
        at = np.flatnonzero(self.vocabulary[known] == h) if len(self.vocabulary) else known[:0]
        here, number = np.unique(known[at], return_inverse=True)
        size = self.posting[here + 1] - self.posting[here]
        row = np.repeat(np.arange(len(here)), size)
        ends = np.cumsum(size)
        entry = np.arange(len(row)) + np.repeat(self.posting[here] - (ends - size), size)
        item = self.posted[entry]
        enough = np.flatnonzero(np.bincount(item, minlength=len(self.need)) >= self.need)
        column = np.full(len(self.need), -1, np.int64)
        column[enough] = np.arange(len(enough))
        mine = column[item] >= 0
        has = np.zeros((len(here), len(enough)), np.float32)
        has[row[mine], column[item[mine]]] = 1
        return enough, at, number, has

    def find(self, h: np.ndarray) -> dict[int, tuple[float, int]]:
        """{item index: (cover, first word)} of the items in a document."""
        found: dict[int, tuple[float, int]] = {}
        items, word_at, number, has = self.sharing(h)
        if not len(items):
            return found
        place = self.place[buckets_of(h)]
        at = np.flatnonzero(place < len(self.factor) - 1)
        if len(at) < 2:
            return found
        vectors = self.vectors[:, items]
        starts = np.arange(0, max(1, len(h) - STRIDE), STRIDE)
        for s in range(0, len(starts), 2048):
            some = starts[s:s + 2048]
            may = self.near(items, word_at, number, has, s, len(some))
            if not may.any():
                continue
            lo = np.searchsorted(at, some)
            hi = np.searchsorted(at, some + WIDTH)
            first, last = lo[0], hi[-1]
            run = np.zeros((last - first + 1, self.factor.shape[1]), np.float32)
            np.cumsum(self.factor[place[at[first:last]]], axis=0, out=run[1:])
            v = run[hi - first] - run[lo - first]
            keep = np.flatnonzero((hi - lo >= 2) & may.any(1))
            v = v[keep]
            norm = np.linalg.norm(v, axis=1, keepdims=True)
            close = (v @ vectors) >= COSINE * np.where(norm > 0, norm, np.inf)
            for w, c in zip(*np.nonzero(close & may[keep])):
                i, start = int(items[c]), int(some[keep[w]])
                if found.get(i, (0.0, 0))[0] >= SURE:
                    continue
                cover = self.check(i, h, start)
                if cover > found.get(i, (0.0, 0))[0]:
                    found[i] = (cover, start)
        return found

    def near(self, items: np.ndarray, word_at: np.ndarray, number: np.ndarray, has: np.ndarray,
             first: int, many: int) -> np.ndarray:
        """Which of the windows first, first + 1, ... may hold enough words of
        which items: their passages' blocks are looked at whole."""
        out = np.zeros((many, len(items)), bool)
        spans = self.span[items]
        for span in np.unique(spans):
            a, b = np.searchsorted(word_at, [(first - span) * STRIDE,
                                             (first + many + 1 + span) * STRIDE])
            held = np.zeros((many + 2 * span + 1, len(has)), np.float32)
            held[word_at[a:b] // STRIDE - (first - span), number[a:b]] = 1
            passage = held[:many].copy()
            for k in range(1, 2 * span + 2):
                np.maximum(passage, held[k:k + many], out=passage)
            mine = np.flatnonzero(spans == span)
            out[:, mine] = passage @ has[:, mine] >= self.need[items[mine]]
        return out

    def enough(self, i: int, held: set) -> bool:
        return len(self.sets[i] & held) >= self.need[i]

    def check(self, i: int, h: np.ndarray, start: int) -> float:
        """Share of item i that the passage around a window covers; 0 if it
        isn't the item."""
        item, answer = self.words[i], self.answers[i]
        reach = self.reach(i)
        text = h[max(0, start - reach):start + WIDTH + reach].tolist()
        if not self.enough(i, set(text)):
            return 0.0
        cover = common_subsequence(item, text) / len(item)
        if cover >= SURE:
            return cover
        if cover >= COVER and common_subsequence(answer, text) >= ANSWER_COVER * len(answer):
            return cover
        return 0.0


class ShortItems:
    """Items of fewer than MIN_WORDS words, found where all of them stand in order."""

    def __init__(self, items: list[tuple]):
        self.by_size: dict[int, dict[tuple, list]] = {}
        for i, words_, _ in items:
            self.by_size.setdefault(len(words_), {}).setdefault(tuple(words_), []).append(i)
        self.first = {n: np.unique(np.array([w[0] for w in m], np.uint64))
                      for n, m in self.by_size.items()}

    def find(self, h: np.ndarray) -> list[tuple]:
        """(item, first word) of each item in a document, where it first stands."""
        out = []
        for n, known in self.by_size.items():
            met = set()
            for at in np.flatnonzero(np.isin(h[:max(0, len(h) - n + 1)], self.first[n])).tolist():
                key = tuple(h[at:at + n].tolist())
                if key in known and key not in met:
                    met.add(key)
                    out += [(i, at) for i in known[key]]
        return out


def _search(sent, leak: str):
    """Pandas function: texts -> leaks of the sent items."""
    @F.pandas_udf(leak)
    def search(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        long, few, *rest = sent.value
        s, few = Searcher(long, *rest) if long else None, ShortItems(few)
        for texts in batches:
            out = []
            for h in plain_words(texts.tolist()):
                got = s.find(h) if s else {}
                out.append([{"item": s.ids[i], "cover": c, "word": w}
                            for i, (c, w) in sorted(got.items())]
                           + [{"item": i, "cover": 1.0, "word": w} for i, w in few.find(h)])
            yield pd.Series(out)
            del texts, out
        del s, few
        give_back()

    return search


def find_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text",
               item_text: str = "text", item_id: str = "item_id",
               answer: str | None = None) -> DataFrame:
    """``docs`` with leaked (boolean) and leaks (item, cover, first word).

    ``answer`` names a benchmark column with the answer; without one the last
    quarter of an item's words is its answer.  Items of fewer than MIN_WORDS
    words count only where all their words stand in order (cover 1).  Items
    that are null or without words are not searched; without items, and for
    null or empty texts, nothing is leaked.  Equal items are both reported.  An
    empty table stays empty, and a column named like an added one is replaced.
    """
    docs = own_columns(small_batches(docs), ["leaked", "leaks", "_leaks"])
    bench = stage(benchmark.where(F.col(item_text).isNotNull()).select(
        F.col(item_id).alias("id"), F.col(item_text).alias("t"),
        (F.col(answer) if answer else F.lit(None).cast("string")).alias("ans")), "benchmark")
    item_kind = bench.schema["id"].dataType.simpleString()
    leak = f"array<struct<item:{item_kind},cover:double,word:long>>"

    def held(batches):
        seen = np.zeros(BUCKETS, bool)
        for b in batches:
            for h in plain_words(b.column(0).to_pylist()):
                seen[buckets_of(h)] = True
        yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(seen), pa.int64())], names=["b"])

    used = np.zeros(BUCKETS, bool)
    for r in bench.select("t").mapInArrow(held, schema("b long")).distinct().collect():
        used[r["b"]] = True
    total, count = passage_counts(docs, text, used)
    weight = weights(total, count, used)
    live, basis = randomised_svd(bench, "t", weight)

    blocks = max(1, -(-bench.count() // ITEM_BLOCK))
    out = docs.withColumn("_leaks", F.array().cast(leak))
    for n in range(blocks):
        rows = bench.where(F.pmod(F.xxhash64("t"), F.lit(blocks)) == n).collect()
        items, short = [], []
        for r, h, a in zip(rows, plain_words([r["t"] for r in rows]),
                           plain_words([r["ans"] for r in rows])):
            if len(h) >= MIN_WORDS:
                tail = a if len(a) else h[-max(3, len(h) // 4):]
                items.append((r["id"], h.tolist(), tail.tolist()))
            elif len(h):
                short.append((r["id"], h.tolist(), None))
        if not items and not short:
            continue
        sent = docs.sparkSession.sparkContext.broadcast((items, short, weight, live, basis))
        out = out.withColumn("_leaks", F.concat("_leaks", _search(sent, leak)(text)))
    return (out.withColumn("leaks", F.col("_leaks")).drop("_leaks")
            .withColumn("leaked", F.size("leaks") > 0).select(*docs.columns, "leaked", "leaks"))


def op9_decontamination(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_leaks(docs, read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "leaked",
                        F.transform("leaks", lambda x: x["item"]).alias("item_ids"),
                        F.transform("leaks", lambda x: x["cover"]).alias("covers"))
