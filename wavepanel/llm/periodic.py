"""Periodic runs of words, by recursive frequency splitting and a lag scan.

A run is a stretch of neighbouring words whose smallest period is q (words q
apart are identical), with at least ``max(least, times * q)`` words, which no
neighbouring word extends keeping that period.

1. *Frequency splitting.*  Each word of a run occurs in it at least ``times``
   times, so a word that is rarer than that in its segment lies in no run and
   splits the segment.  The parts are counted and split again until nothing
   changes; parts shorter than ``least`` go.  Most texts end here.
2. *Lag scan.*  The surviving segments are scanned at lags 2^k to 2^(k+1) - 1
   for each k.  A run of four periods and more, whose period q is among them,
   holds a whole window of 2^k words that starts at a multiple of 2^k and
   recurs q words later; so each window is compared with the windows that start
   in the next 2^k places, one comparison per place and k.  Windows are named
   exactly, by prefix doubling.  Every hit is extended to both sides as far as
   the lag holds, in halving steps over the same names.
3. Stretches that are long enough stay; of several lags that give the same
   stretch the smallest is its period.

The work is a text's length times its logarithm, whatever the text repeats.
A text is the unit of work: one row, one task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import own_columns, read, schema, small_batches

LEAST, TIMES = 6, 4
# Words of texts that are split and scanned together.
GROUP_WORDS = 50_000


def numbered(words: list[bytes]) -> np.ndarray:
    """Numbers below len(words) that tell the words apart."""
    last = {w: i for i, w in enumerate(words)}
    return np.fromiter(map(last.__getitem__, words), np.int64, len(words))


def surviving(ids: np.ndarray, starts: np.ndarray, least: int, times: int
              ) -> tuple[np.ndarray, np.ndarray]:
    """(places, segment of each) of the words left by frequency splitting.

    ``ids`` name words (no id in two texts), ``starts`` are the texts' places.
    """
    place = np.arange(len(ids))
    segment = np.zeros(len(ids), np.int64)
    segment[starts[(starts > 0) & (starts < len(ids))]] = 1
    segment = np.cumsum(segment)
    done_place, done_segment, made = [], [], 0
    key = ids                                # the first segments are whole texts
    while len(place):
        rare = np.bincount(key)[key] < times
        keep = ~rare
        # a new segment starts after a gap and where the old one ended
        p, s = place[keep], segment[keep]
        if not len(p):
            break
        new = np.concatenate(([True], (np.diff(p) > 1) | (np.diff(s) > 0)))
        number = np.cumsum(new) - 1
        size = np.bincount(number)
        had = np.bincount(segment)                     # words the old segments had
        same = size == had[s[new]]                     # nothing was split off
        stable = (same & (size >= least))[number]
        done_place.append(p[stable])
        done_segment.append(number[stable] + made)
        made += len(size)
        again = (~same & (size >= least))[number]
        place, segment = p[again], number[again]
        _, key = np.unique(segment * (len(ids) + 1) + ids[place], return_inverse=True)
    if not done_place:
        return place[:0], segment[:0]
    place, segment = np.concatenate(done_place), np.concatenate(done_segment)
    order = np.argsort(place, kind="stable")
    return place[order], segment[order]


class LagScan:
    """All runs of a sequence of ids; negative ids match nothing."""

    def __init__(self, ids: np.ndarray, least: int, times: int):
        self.ids, self.least, self.times = ids, least, times
        self.n = n = len(ids)
        # names[k][i] names the 2^k ids from i; windows over the end match nothing
        _, first = np.unique(ids, return_inverse=True)
        self.names = [first.astype(np.int32)]
        self.names[0][ids < 0] = -1
        while times << (len(self.names) - 1) <= n:
            half, cur = 1 << (len(self.names) - 1), self.names[-1]
            if n <= 2 * half:
                break
            left, right = cur[:n - 2 * half + 1].astype(np.int64), cur[half:n - half + 1]
            whole = (left >= 0) & (right >= 0)
            nxt = np.full(n, -1, np.int32)
            _, name = np.unique(left[whole] * (n + 1) + right[whole], return_inverse=True)
            nxt[np.flatnonzero(whole)] = name
            self.names.append(nxt)
            if not whole.any():
                break

    def hits(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(start, lag) of the windows that recur at a lag of 2^k to 2^(k+1) - 1;
        of neighbouring windows with one lag only the first."""
        step, name = 1 << k, self.names[k]
        rows = -(-self.n // step) + 1
        padded = np.full(rows * step, -1, np.int32)
        padded[:self.n] = name
        grid = padded.reshape(rows, step)
        same = (grid[1:] == grid[:-1, :1]) & (grid[1:] >= 0)
        same[1:] &= ~same[:-1].copy()
        j, r = np.nonzero(same)
        return j * step, step + r

    def extended(self, start: np.ndarray, lag: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The greatest (from, to) around each hit on which the lag holds."""
        lo, hi = start.copy(), start + lag
        for forward in (False, True):
            at = hi.copy() if forward else lo.copy()
            top = len(self.names) - 1
            # the greatest step may hold many times, each smaller one once
            for k in range(top, -1, -1):
                step, name = 1 << k, self.names[k]
                live = np.arange(len(at))
                while len(live):
                    a = at[live] - lag[live] if forward else at[live] - step
                    b = a + lag[live]
                    fine = (a >= 0) & (b < self.n)
                    live, a, b = live[fine], a[fine], b[fine]
                    equal = (name[a] == name[b]) & (name[a] >= 0)
                    live = live[equal]
                    at[live] += step if forward else -step
                    if k < top:
                        break
            if forward:
                hi = at
            else:
                lo = at
        return lo, hi

    def runs(self) -> np.ndarray:
        """Rows (start, length, period), by start and period."""
        found = []
        for k in range(len(self.names)):
            start, lag = self.hits(k)
            if not len(start):
                continue
            lo, hi = self.extended(start, lag)
            long = hi - lo >= np.maximum(self.least, self.times * lag)
            found.append(np.stack([lo[long], hi[long] - lo[long], lag[long]], 1))
        if not found:
            return np.zeros((0, 3), np.int64)
        every = np.unique(np.concatenate(found), axis=0)
        if not len(every):
            return every
        first = np.concatenate(([True], (np.diff(every[:, :2], axis=0) != 0).any(1)))
        return every[first]


def runs_of(texts: list[list[bytes]], least: int = LEAST, times: int = TIMES
            ) -> list[np.ndarray]:
    """The runs (start, length, period) of each list of words."""
    sizes = np.array([len(t) for t in texts], np.int64)
    starts = np.cumsum(sizes) - sizes
    ids = np.concatenate([numbered(t) + s for t, s in zip(texts, starts)] or [np.zeros(0, np.int64)])
    out = [np.zeros((0, 3), np.int64)] * len(texts)
    place, segment = surviving(ids, starts, least, times)
    if not len(place):
        return out
    # one sequence of all segments, a place that matches nothing between them
    at = np.arange(len(place)) + np.concatenate(([0], np.cumsum(np.diff(segment) != 0)))
    line = np.full(at[-1] + 1, -1, np.int64)
    line[at] = ids[place]
    found = LagScan(line, least, times).runs()
    if not len(found):
        return out
    found[:, 0] = place[np.searchsorted(at, found[:, 0])]
    text = np.searchsorted(starts, found[:, 0], "right") - 1
    # of texts that start at one place all but the last are empty
    cut = np.flatnonzero(np.diff(text)) + 1
    for part, t in zip(np.split(found, cut), text[np.concatenate(([0], cut))]):
        part[:, 0] -= starts[t]
        out[t] = part[np.lexsort((part[:, 2], part[:, 0]))]
    return out


def collapsed(words: list[bytes], runs: np.ndarray) -> list[bytes]:
    """The words that no run holds after its first period."""
    if not len(runs):
        return words
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
    return [words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0)]


def _scan(least: int, times: int):
    """Arrow function: (id, text) -> words, runs and the collapsed text."""
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()),
                               ("period", pa.int64())]))

    def answer(texts):
        got = runs_of(texts, least, times)
        return ([len(t) for t in texts],
                [[{"start": s, "length": n, "period": q} for s, n, q in r.tolist()] for r in got],
                [b" ".join(collapsed(t, r)).decode("utf-8", "replace")
                 for t, r in zip(texts, got)])

    def run(batches):
        for b in batches:
            n, runs, left, group, size = [], [], [], [], 0
            for t in b.column(1).to_pylist():
                group.append((t or "").encode("utf-8", "surrogatepass").split())
                size += len(group[-1])
                if size >= GROUP_WORDS:
                    for a, x in zip((n, runs, left), answer(group)):
                        a += x
                    group, size = [], 0
            for a, x in zip((n, runs, left), answer(group)):
                a += x
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(runs, kind),
                 pa.array(left, pa.string())], names=["id", "n_words", "runs", "collapsed"])
    return run


def find_runs(docs: DataFrame, text: str = "text", row_id: str = "doc_id",
              least: int = LEAST, times: int = TIMES) -> DataFrame:
    """Per row: n_words, runs (start, length, period; by start, then period)
    and collapsed, the text's words joined by one space without those that a
    run holds after its first period.

    Words are what ASCII white space separates.  ``times`` is 4 at least: the
    scan needs four periods.  A null or blank text has no words, no runs and
    an empty collapsed text.  Repeated rows and null ids are rows like any
    other.  An empty table gives an empty result.  Only ``row_id`` and ``text``
    are read, so columns named like the results do no harm.
    """
    if times < 4:
        raise ValueError("times must be 4 at least")
    kind = docs.schema[row_id].dataType.simpleString()
    rows = small_batches(docs).select(F.col(row_id).alias("id"), F.col(text).alias("text"))
    ddl = (f"id {kind}, n_words long, "
           "runs array<struct<start:long, length:long, period:long>>, collapsed string")
    return rows.mapInArrow(_scan(least, times), schema(ddl)).withColumnRenamed("id", row_id)


def with_periodic_tails(docs: DataFrame, text: str = "text", row_id: str = "doc_id") -> DataFrame:
    """``docs`` in which every tenth text or so ends in a repeated stretch.

    With h the CRC-32 of the decimal id and g = floor(h / 10), a text of n > 0
    words with h % 10 = 0 has its words from a = g % n on replaced by word
    a + (i - a) % p, p = 1 + floor((n - a) / (3 + g % 8)); its words are then
    joined by one space.  Other texts, and those of null ids, stay.
    """
    h = F.crc32(F.col(row_id).cast("string").cast("binary"))
    g = F.floor(h / 10).cast("long")
    ws = F.filter(F.split(F.col(text), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    d = (docs.withColumn("_g", F.when(h % 10 == 0, g))
         .withColumn("_w", F.when(F.col("_g").isNotNull(), ws))
         .withColumn("_n", F.size("_w")).withColumn("_a", F.when(F.col("_n") > 0, F.expr("_g % _n")))
         .withColumn("_p", F.expr("1 + (_n - _a) div (3 + _g % 8)")))
    new = F.expr("array_join(transform(_w, (w, i) -> "
                 "IF(i < _a, w, _w[cast(_a + (i - _a) % _p AS int)])), ' ')")
    return (d.withColumn(text, F.when(F.col("_n") > 0, new).otherwise(F.col(text)))
            .drop("_g", "_w", "_n", "_a", "_p"))


def op12_periodic_runs(spark, sf_dir):
    docs = own_columns(read(spark, sf_dir, "documents"), ["runs", "collapsed"])
    found = find_runs(with_periodic_tails(docs.select("doc_id", "text")))
    # the greatest length, then the smallest start, then the smallest period
    best = F.expr("aggregate(runs, runs[0], (a, r) -> IF(r.length > a.length, r, a))")
    listed = F.array_join(F.transform("runs", lambda r: F.concat(
        F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    some = F.size("runs") > 0
    return (found.withColumn("_best", F.when(some, best))
            .select("doc_id", F.size("runs").cast("long").alias("n_runs"),
                    F.col("_best.start").alias("start"), F.col("_best.length").alias("length"),
                    F.col("_best.period").alias("period"),
                    F.expr("(1000 * _best.length) div _best.period").alias("exponent_milli"),
                    F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
                    F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256")))
