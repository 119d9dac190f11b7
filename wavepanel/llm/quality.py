"""Quality classifier from overlapping weak labellers.

1. Heuristic labellers read a document and vote bad, good, or abstain.  One of
   them looks for words that labelled toxic documents use and clean ones do
   not; that word list is fitted on a bounded sample of labelled rows.
2. A label model (expectation-maximisation over the counts of vote patterns of
   all documents) estimates each labeller's accuracy per hidden class without
   gold labels.  There are at most 3^labellers patterns, whatever the corpus.
3. The posterior of each pattern labels a bounded sample of documents, which
   trains a linear scorer on hashed features.  The scorer decides.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .common import give_back, own_columns, read, schema, small_batches

# Labelled rows that the word list, and distinct texts that the scorer is fitted
# on at most (arguments of ``classify``).
LABELLED_ROWS = 6_000
TRAINING_TEXTS = 4_000
HASH_BITS = 18
# Features of the word list: words and word beginnings of these lengths.
STEMS = (4, 5, 6)
GOOD, BAD, ABSTAIN = 1, 0, 2
# Share of good documents that a labeller may take for bad.
MOST_FALSE_ALARMS = 0.02
# Distinct raw tokens remembered per task; the memory starts anew beyond it.
TOKEN_CACHE = 300_000
THRESHOLD = 0.5

# Abusive words that need no fitting.
ABUSE = frozenset("idiot moron scum loser stupid pathetic worthless disgusting trash "
                  "clown vermin imbecile".split())
LABELLERS = ("shouting", "symbols", "stutter", "variety", "lists", "repeats", "shape", "abuse")


def stems(word: str) -> list[str]:
    """The word itself and its beginnings, as hashed features."""
    return ["=" + word, *(f"{n}{word[:n]}" for n in STEMS if len(word) > n)]


class AbuseList:
    """Counts abusive words; only tokens with a listed beginning are looked at."""

    def __init__(self, listed: frozenset[str]):
        self.listed = listed
        low = {w[:4] for w in ABUSE} | {s.lstrip("=456")[:4] for s in listed}
        cased = {f(w) for w in low for f in (str.lower, str.title, str.upper)}
        self.heads = cased | {q + w[:3] for w in cased for q in "\"'(*"}

    def hits(self, raw: list[str]) -> int:
        heads, n = self.heads, 0
        for t in [t for t in raw if t[:4] in heads]:
            word = normal(t)
            n += word in ABUSE or any(s in self.listed for s in stems(word))
        return n


def normal(token: str) -> str:
    return token.strip(".,;:!?\"'()*#&%$|").lower()


def measure(text: str, abuse: AbuseList) -> tuple[list[int], set[str]]:
    """Votes of the labellers, and the distinct raw tokens."""
    raw = text.split()
    n, kinds = len(raw), set(raw)
    if not n:
        return [ABSTAIN] * len(LABELLERS), kinds
    upper = sum(map(str.isupper, raw)) / n
    marks = sum(map(text.count, "!#&%$*^~=<>{}[]@_")) / n
    stutter = sum(map(str.__eq__, raw, raw[1:])) / n
    variety = len(kinds) / math.sqrt(n)
    bars = (text.count("|") + text.count("\t")) / n
    lines = [x for x in text.split("\n") if x and not x.isspace()]
    repeats = 1 - len(set(lines)) / len(lines)
    mean = len(text) / n
    hits = abuse.hits(raw)

    def vote(bad: bool, good: bool) -> int:
        return BAD if bad else GOOD if good else ABSTAIN

    return [vote(upper > 0.5, upper < 0.15),
            vote(marks > 0.3, marks < 0.05),
            vote(stutter > 0.1, stutter < 0.02),
            vote(n >= 50 and variety < 2, variety > 4),
            vote(bars > 0.2, bars < 0.02),
            vote(repeats > 0.5, repeats < 0.2 and len(lines) > 1),
            vote(mean > 20 or mean < 2.5, 4 <= mean <= 12),
            vote(hits >= 2 and hits / n >= 0.003, hits == 0 and n >= 10)], kinds


def pattern(votes: list[int]) -> int:
    p = 0
    for v in votes:
        p = 3 * p + v
    return p


def unpack(p: int) -> list[int]:
    out = []
    for _ in LABELLERS:
        out.append(p % 3)
        p //= 3
    return out[::-1]


# ------------------------------------------------------------- label model

def fit_label_model(counts: dict[int, int], rounds: int = 200) -> dict[int, float]:
    """Posterior of "good" per vote pattern, by expectation-maximisation.

    The hidden classes are "good" and one fault per labeller, since a document
    with one fault looks good to the labellers of the others.  A pattern
    starts in the class of its first bad vote; faults that several labellers
    see end up sharing their votes.
    """
    if not counts:
        return {}
    pats = sorted(counts)
    votes = np.array([unpack(p) for p in pats])
    n = np.array([counts[p] for p in pats], float)
    bad = votes == BAD
    start = np.where(bad.any(1), 1 + bad.argmax(1), 0)
    classes = 1 + len(LABELLERS)
    post = np.full((len(pats), classes), 0.1 / classes)
    post[np.arange(len(pats)), start] += 0.9
    onehot = (votes[:, :, None] == np.arange(2)).astype(float)    # abstaining says nothing
    before = post
    for _ in range(rounds):
        weight = post * n[:, None]
        prior = (weight.sum(0) + 1) / (n.sum() + classes)
        rates = np.einsum("pk,plv->klv", weight, onehot) + 0.5
        rates /= rates.sum(2, keepdims=True)
        # what the classes stand for: no labeller votes much of the good bad,
        # and each sees most of its own fault
        rates[0, :, BAD] = np.minimum(rates[0, :, BAD], MOST_FALSE_ALARMS)
        own = np.arange(len(LABELLERS))
        rates[1 + own, own, BAD] = np.maximum(rates[1 + own, own, BAD], 0.5)
        logp = np.log(prior) + np.einsum("plv,klv->pk", onehot, np.log(rates))
        post = np.exp(logp - logp.max(1, keepdims=True))
        post /= post.sum(1, keepdims=True)
        if np.abs(post - before).max() < 1e-6:
            break
        before = post
    return {p: float(q) for p, q in zip(pats, post[:, 0])}


# ---------------------------------------------------------------- word list

def fit_abuse_words(texts: list[str], toxic: list[int]) -> list[str]:
    """Stems that toxic documents use and clean ones do not.

    Near copies of one document would make its rare words look common, so of
    documents that share their three smallest word hashes one is counted.
    """
    met: set[tuple] = set()
    groups: tuple[list[str], list[str]] = ([], [])
    for t, y in zip(texts, toxic):
        words = set(map(normal, set(t.split()))) - {""}
        sketch = (bool(y), *sorted(zlib.crc32(w.encode()) for w in words)[:3])
        if sketch not in met:
            met.add(sketch)
            groups[bool(y)].append(t)

    def used(texts: list[str], among: set[str] | None) -> Counter:
        out: Counter = Counter()
        for t in texts:
            found = {s for w in set(map(normal, set(t.split()))) - {""} for s in stems(w)}
            out.update(found if among is None else found & among)
        return out

    clean, bad = groups
    if not clean or not bad:
        return []
    # only what enough toxic documents use is looked up in the clean ones
    often = {s: k for s, k in used(bad, None).items() if k >= max(4, 0.01 * len(bad))}
    other = used(clean, set(often))
    scored = sorted((-k, s) for s, k in often.items()
                    if (k / len(bad)) / ((other[s] + 0.5) / len(clean)) >= 20)
    return [s for _, s in scored]


# ------------------------------------------------------------ linear scorer

def _mask(feature: str) -> int:
    return zlib.crc32(feature.encode()) & ((1 << HASH_BITS) - 1)


def vote_features(votes: list[int]) -> list[int]:
    return [_mask(f"v{i}:{v}") for i, v in enumerate(votes)]


def fit_scorer(rows: Iterable[tuple[list[int], set[str], float]], rounds: int = 8) -> np.ndarray:
    """Logistic regression by AdaGrad over (votes, distinct tokens, target).

    Features are the votes and the stems of the tokens, hashed; the tokens of
    a document share a weight of one over the root of their number, so that
    long documents do not outvote the rest.
    """
    size = 1 << HASH_BITS
    w, g2 = np.zeros(size + 1), np.full(size + 1, 1e-3)
    data = []
    for votes, tokens, y in rows:
        idx = np.fromiter((_mask(s) for t in tokens for s in stems(normal(t))), np.int32)
        s, k = np.unique(idx, return_counts=True)
        data.append((np.array(vote_features(votes) + [size]), s,
                     (k / math.sqrt(max(1, len(tokens)))).astype(np.float32), y))
    order = np.arange(len(data))
    rng = np.random.default_rng(7)
    for _ in range(rounds):
        rng.shuffle(order)
        for i in order:
            v, s, k, y = data[i]
            z = w[v].sum() + k @ w[s]
            err = 1 / (1 + math.exp(-max(-30.0, min(30.0, z)))) - y
            if abs(err) < 1e-2:
                continue
            g2[v] += err * err
            w[v] -= 0.3 * err / np.sqrt(g2[v])
            g = err * k
            g2[s] += g * g
            w[s] -= 0.02 * g / np.sqrt(g2[s])
    return w.astype(np.float32)


class TokenWeights(dict):
    """Summed stem weights of a raw token, remembered."""

    def __init__(self, w: np.ndarray):
        super().__init__()
        self.w = w.tolist()

    def __missing__(self, token: str) -> float:
        if len(self) > TOKEN_CACHE:
            self.clear()
        got = sum(self.w[_mask(s)] for s in stems(normal(token)))
        self[token] = got
        return got


def score(weights: TokenWeights, votes: list[int], tokens: set[str]) -> float:
    z = weights.w[-1] + sum(weights.w[f] for f in vote_features(votes))
    if tokens:
        z += sum(map(weights.__getitem__, tokens)) / math.sqrt(len(tokens))
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


# ------------------------------------------------------------------- Spark

def _one_task(df: DataFrame, fit, out: str) -> list:
    """Runs ``fit(table)`` once, in one executor task, over a bounded sample."""
    def run(batches):
        parts = [b.to_pandas() for b in batches]
        yield from pa.Table.from_pandas(
            fit(pd.concat(parts) if parts else pd.DataFrame()), preserve_index=False).to_batches()
        parts.clear()
        give_back()

    return df.repartition(1).mapInArrow(run, schema(out)).collect()


def _sample(df: DataFrame, by: list[str], rows: int, total: int) -> DataFrame:
    """At most ``rows`` distinct rows of ``total``: those with the least hashes
    of ``by``.  Copies have one hash and count once, so a hot row weighs no
    more than another one, and nothing depends on the order of the rows.

    A share of the hash space a little larger than needed is cut out first, so
    that only about that many rows are sorted.
    """
    h = F.xxhash64(*by)
    place = (F.shiftrightunsigned(h, 11).cast("double") / float(1 << 53)).alias("_place")
    near = df.select("*", place)
    if total > rows:
        near = near.where(F.col("_place") < 1.3 * rows / total)
    return near.distinct().orderBy("_place", *by).limit(rows).drop("_place")


def abuse_words(docs: DataFrame, labels: DataFrame, text: str, row_id: str,
                rows: int = LABELLED_ROWS) -> frozenset[str]:
    marked = (labels.where(F.col("toxic").isNotNull() & F.col(row_id).isNotNull())
              .groupBy(row_id).agg(F.max("toxic").alias("_toxic")))
    marked = _sample(marked, [row_id], rows, marked.count())
    texts = (docs.select(row_id, text).where(F.col(text).isNotNull())
            .join(F.broadcast(marked), row_id).select(text, "_toxic"))

    def fit(pdf):
        found = fit_abuse_words(pdf[text].tolist(), pdf["_toxic"].tolist()) if len(pdf) else []
        return pd.DataFrame({"s": pd.Series(found, dtype="string")})

    return frozenset(r["s"] for r in _one_task(texts, fit, "s string"))


def classify(docs: DataFrame, labels: DataFrame | None = None, text: str = "text",
             row_id: str = "doc_id", threshold: float = THRESHOLD,
             labelled_rows: int = LABELLED_ROWS, training_texts: int = TRAINING_TEXTS
             ) -> DataFrame:
    """``docs`` with quality (score from 0 to 1), posterior (of the label model)
    and keep (quality >= threshold).

    ``labels`` (row_id, toxic) feeds the word list only, ``labelled_rows`` of
    them at most; the scorer is fitted on ``training_texts`` distinct texts at
    most.  Votes and their patterns are counted over all documents.  A null, empty or
    blank text has nothing to vote on; it gets the score 0 and is not kept.
    Equal texts get equal scores.  An empty table stays empty, and a column
    named like an added one is replaced.
    """
    docs = own_columns(small_batches(docs), ["quality", "posterior", "keep", "_votes"])
    listed = (abuse_words(docs, labels, text, row_id, labelled_rows) if labels is not None
              else frozenset())

    def vote(batches):
        abuse = AbuseList(listed)
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array(
                [pattern(measure(t, abuse)[0]) if t and not t.isspace() else -1
                 for t in b.column(0).to_pylist()], pa.int32())], names=["p"])
        give_back()

    counts = {r["p"]: r["count"] for r in
              docs.select(text).mapInArrow(vote, schema("p int")).groupBy("p").count().collect()
              if r["p"] >= 0}
    good = fit_label_model(counts)
    sample = _sample(docs.where(F.length(F.trim(F.col(text))) > 0).select(text), [text],
                     training_texts, sum(counts.values()))

    def train(pdf):
        abuse = AbuseList(listed)

        def rows():
            for t in sorted(pdf[text].tolist()) if len(pdf) else []:
                votes, tokens = measure(t, abuse)
                p = pattern(votes)
                if p in good:
                    yield votes, tokens, good[p]

        return pd.DataFrame({"w": [fit_scorer(rows()).tobytes()]})

    fitted = _one_task(sample, train, "w binary")             # 1 MB; none of an empty table
    weights = bytes(fitted[0]["w"]) if fitted else fit_scorer([]).tobytes()
    sent = docs.sparkSession.sparkContext.broadcast(weights)

    @F.pandas_udf("quality double, posterior double")
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        abuse, weights = AbuseList(listed), TokenWeights(np.frombuffer(sent.value, np.float32))
        for texts in batches:
            q, p = [], []
            for t in texts:
                if not t or t.isspace():
                    q.append(0.0)
                    p.append(None)
                    continue
                votes, tokens = measure(t, abuse)
                q.append(score(weights, votes, tokens))
                p.append(good.get(pattern(votes)))
            yield pd.DataFrame({"quality": q, "posterior": pd.Series(p, dtype="float64")})
        weights.clear()
        give_back()

    return (docs.withColumn("_j", judge(text))
            .withColumn("quality", F.col("_j.quality"))
            .withColumn("posterior", F.col("_j.posterior"))
            .withColumn("keep", F.col("quality") >= threshold).drop("_j"))


def op10_quality_classifier(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return classify(docs, read(spark, sf_dir, "labels")).drop("text")
