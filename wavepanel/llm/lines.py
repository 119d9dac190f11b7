"""Removal of repeated line runs with a suffix array over line ids.

A document is the sequence of its non-blank lines, each line named by an id.
A run of neighbouring lines with at least ``min_words`` words that already
occurs earlier (in doc_id order, then line order) is a later copy, and its
lines go.

How the runs are found:

1. Lines that occur once can lie in no repeated run; they cut the documents
   into islands of repeated lines.  Islands with too few words are done.
2. The suffixes of the islands are ranked by prefix doubling: rank 0 is the
   line's place among all repeated lines, and round k ranks pairs of ranks
   2^k lines apart.  Only the counts of distinct pairs are ordered, so a
   frequent line costs no more than a rare one.  A suffix needs to be told
   apart only as far as its window, the shortest prefix with ``min_words``
   words, or as an earlier window of its island reaches if the rest is too
   short for one; it leaves the rounds there, so their number depends on
   ``min_words`` and not on the data.
3. Neighbours in the suffix array with a longest common prefix at least as
   long as the window form an interval: the occurrences of one run.  All but
   the earliest are later copies.

Every line of a longer repeated run lies in the window that starts the run, in
one that starts later in it, or in one that ends at its last lines; so the same
is done for the reversed lines, and the union of both is exactly the union of
all maximal repeated runs.  Copies that overlap themselves (one line many
times) shrink to their first period.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage
from .common import give_back, own_columns, read, schema, small_batches
from .sharding import running_totals

MIN_WORDS = 50
# Span rows up to which the spans are broadcast to the documents (about 60
# bytes each); beyond it the join is shuffled.
BROADCAST_SPANS = 500_000


def _lines(docs: DataFrame, text: str, row_id: str) -> DataFrame:
    """(a, b, id, ord, line, words, h, g): the non-blank lines.

    (a, b) names a row by its id and text; (h, g) names a line by its text
    without surrounding white space.
    """
    blank = " \t\r\x0b\x0c"
    kept = F.filter(F.transform(F.split(F.col(text), "\n"), lambda x, i: F.struct(
        i.alias("line"), F.trim(x, F.lit(blank)).alias("x"))), lambda s: s["x"] != "")
    out = docs.where(F.col(text).isNotNull()).select(
        *row_key(text, row_id), F.col(row_id).alias("id"), F.posexplode(kept).alias("ord", "_s"))
    x = F.col("_s.x")
    # byte searches; a pattern or translate() would decode every line
    spaced = x.contains("  ")
    for c in "\t\r\x0b\x0c":
        spaced = spaced | x.contains(c)
    words = F.when(spaced, F.size(F.split(x, r"\s+"))).otherwise(
        F.octet_length(x) - F.octet_length(F.replace(x, F.lit(" "), F.lit(""))) + 1)
    return out.select("_a", "_b", "id", "ord", F.col("_s.line").alias("line"),
                      words.cast("int").alias("words"),
                      F.xxhash64(x).alias("h"), F.xxhash64(F.lit(11), x).alias("g"))


def row_key(text: str, row_id: str) -> list:
    """Two 64-bit hashes that name a row by its id and text."""
    return [F.xxhash64(F.col(row_id), F.col(text)).alias("_a"),
            F.xxhash64(F.lit(5), F.col(text), F.col(row_id)).alias("_b")]


def _islands(min_words: int, id_kind: str):
    """Arrow function: rows of sorted repeated lines -> lines with windows."""
    names = ["_a", "_b", "id", "island", "ord", "line", "r0",
             "mf", "tof", "winf", "reachf", "mb", "fromb", "winb", "reachb"]
    ddl = (f"_a long, _b long, id {id_kind}, island int, ord int, line int, r0 long, "
           "mf int, tof int, winf array<long>, reachf int, "
           "mb int, fromb int, winb array<long>, reachb int")

    def run(batches):
        # a line is a dictionary here: a few documents at a time
        for batch in (b.slice(i, 100) for b in batches for i in range(0, len(b), 100)):
            rows, out = [], []
            for i, items in enumerate(batch.column("items").to_pylist()):
                start = 0
                for end in range(1, len(items) + 1):
                    if end < len(items) and items[end]["ord"] == items[end - 1]["ord"] + 1:
                        continue
                    part = items[start:end]
                    if sum(x["words"] for x in part) >= min_words:
                        found = _windows(part, min_words)
                        rows += [i] * len(found)
                        out += [(start, *f) for f in found]
                    start = end
            take = pa.array(rows, pa.int64())
            cols = list(zip(*out)) if out else [[]] * 12
            la = pa.list_(pa.int64())
            kinds = [pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), la,
                     pa.int32(), pa.int32(), pa.int32(), la, pa.int32()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c).take(take) for c in ("_a", "_b", "id")]
                + [pa.array(c, k) for c, k in zip(cols, kinds)], names=names)
        give_back()

    return run, schema(ddl)


def _windows(part: list[dict], min_words: int) -> list[tuple]:
    """Per line of an island its shortest windows forward and backward, and how
    far any window that holds the line goes on from it."""
    n, upto = len(part), [0]
    for x in part:
        upto.append(upto[-1] + x["words"])
    ids = [x["r"] for x in part]
    forward, e = [0] * n, 0
    for j in range(n):
        e = max(e, j)
        while e < n and upto[e + 1] - upto[j] < min_words:
            e += 1
        forward[j] = e - j + 1 if e < n else 0
    backward, s = [0] * n, 0
    for j in range(n):
        while s < j and upto[j + 1] - upto[s + 1] >= min_words:
            s += 1
        backward[j] = j - s + 1 if upto[j + 1] - upto[s] >= min_words else 0
    # ends never fall, so a line with a window of its own is reached no further
    reachf, reachb = forward[:], backward[:]
    for j in range(1, n):
        reachf[j] = forward[j] or max(0, reachf[j - 1] - 1)
    for j in range(n - 2, -1, -1):
        reachb[j] = backward[j] or max(0, reachb[j + 1] - 1)
    out = []
    for j, x in enumerate(part):
        mf, mb = forward[j], backward[j]
        out.append((x["ord"], x["line"], x["r"],
                    mf, part[j + mf - 1]["line"] if mf else None, ids[j:j + mf] if mf else None,
                    reachf[j], mb, part[j - mb + 1]["line"] if mb else None,
                    ids[j - mb + 1:j + 1][::-1] if mb else None, reachb[j]))
    return out


def suffix_ranks(suffixes: DataFrame, reach: str, forward: bool) -> DataFrame:
    """Adds ``r``: ranks of the islands' suffixes (or reversed prefixes), told
    apart at least as far as the ``reach`` lines that windows hold of them."""
    ranked = suffixes.withColumn("r", F.col("r0"))
    order = Window.partitionBy("_a", "_b", "island").orderBy("ord")
    longest = suffixes.agg(F.max(reach)).first()[0] or 0
    k = 0
    while 1 << k < longest:
        step = 1 << k
        nxt = F.lead("r", step) if forward else F.lag("r", step)
        paired = ranked.withColumn("s", F.coalesce(nxt.over(order), F.lit(-1)))
        need = F.col(reach) > step
        counts = stage(paired.where(need).groupBy("r", "s").agg(F.count(F.lit(1)).alias("n")),
                       "line-pairs")
        here = Window.partitionBy("r").orderBy("s")
        places = counts.select("r", "s", (F.col("r") + F.sum("n").over(here) - F.col("n"))
                               .alias("r2"))
        finer = (paired.where(need).join(stage(places, "line-places"), ["r", "s"])
                 .withColumn("r", F.col("r2")).select(*ranked.columns))
        ranked = stage(paired.where(~need).select(*ranked.columns).unionByName(finer),
                       "line-ranks")
        k += 1
    return ranked


def later_copies(ranked: DataFrame, m: str, win: str) -> DataFrame:
    """The suffixes whose window occurs earlier, by the LCP intervals."""
    # null ids come last; (a, b) puts rows with one id in a fixed order
    place = F.struct(F.col("id").isNull().alias("no_id"), "id", "_a", "_b", "ord")
    ranks = (ranked.where(F.col(m) > 0).groupBy("r")
             .agg(F.min(place).alias("place"), F.first(win).alias("win")))
    first, last = F.col("win")[0], F.element_at("win", -1)
    near = Window.partitionBy(first, last, F.size("win")).orderBy("r")
    before = F.lag("win").over(near)
    differ = F.array_position(F.zip_with("win", before, lambda x, y: ~x.eqNullSafe(y)), True)
    lcp = F.when(differ == 0, F.size("win")).otherwise(differ - 1)
    cut = ranks.withColumn("lcp", F.coalesce(lcp, F.lit(0))).withColumn(
        "interval", F.sum(F.when(F.col("lcp") < F.size("win"), 1).otherwise(0)).over(near))
    whole = Window.partitionBy(first, last, F.size("win"), "interval")
    firsts = cut.select("r", F.min("place").over(whole).alias("first"))
    return (ranked.where(F.col(m) > 0).join(stage(firsts, "line-firsts"), "r")
            .where(place != F.col("first")))


def repeated_spans(docs: DataFrame, text: str = "text", row_id: str = "doc_id",
                   min_words: int = MIN_WORDS) -> DataFrame:
    """(a, b, spans): the line spans (from, to) of later copies, by row."""
    lines = stage(_lines(docs, text, row_id).dropDuplicates(["_a", "_b", "ord"]), "lines")
    names = (lines.groupBy("h", "g").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
             .select(F.struct("h", "g").alias("k"), "n"))
    ids = stage(running_totals(names, "k", "n").select("k.h", "k.g", F.col("before").alias("r")),
                "line-ids")
    known = lines.join(ids, ["h", "g"])
    by_row = known.groupBy("_a", "_b").agg(
        F.first("id").alias("id"),
        F.array_sort(F.collect_list(F.struct("ord", "line", "r", "words"))).alias("items"))
    run, out = _islands(min_words, lines.schema["id"].dataType.simpleString())
    suffixes = stage(by_row.mapInArrow(run, out), "line-suffixes")
    forward = later_copies(suffix_ranks(suffixes, "reachf", True), "mf", "winf")
    backward = later_copies(suffix_ranks(suffixes, "reachb", False), "mb", "winb")
    spans = (forward.select("_a", "_b", F.col("line").alias("from"), F.col("tof").alias("to"))
             .unionByName(backward.select("_a", "_b", F.col("fromb").alias("from"),
                                          F.col("line").alias("to"))).distinct())
    return spans.groupBy("_a", "_b").agg(
        F.array_sort(F.collect_list(F.struct("from", "to"))).alias("_spans"))


def drop_repeated_lines(docs: DataFrame, text: str = "text", row_id: str = "doc_id",
                        min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with later copies of repeated runs cut out of ``text``.

    Adds n_lines (lines of the whole text, blank ones too), n_removed and
    removed (the cut spans of line numbers from 0, ends included).  A null text stays
    null with 0 lines; an empty text has one line.  Rows equal in id and text
    are copies of each other: one keeps its lines, the others lose them if
    the text has ``min_words`` words.  Null ids count as the last documents.
    An empty table stays empty, other columns stay as they are, and a column
    named like an added one is replaced.
    """
    docs = own_columns(small_batches(docs),
                       ["n_lines", "n_removed", "removed", "_a", "_b", "_spans", "_copy"])
    found = stage(repeated_spans(docs, text, row_id, min_words), "line-spans")
    many = found.agg(F.sum(F.size("_spans"))).first()[0] or 0
    keyed = docs.select("*", *row_key(text, row_id))
    again = (keyed.groupBy("_a", "_b").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
             .select("_a", "_b", F.lit(True).alias("_copy")))
    if again.isEmpty():
        keyed = keyed.withColumn("_copy", F.lit(False))
    else:       # rows equal in id and text: number them, the first one is kept
        both = keyed.join(again, ["_a", "_b"], "left")
        nth = Window.partitionBy("_a", "_b").orderBy(F.lit(0))
        keyed = (both.where(F.col("_copy").isNull()).withColumn("_copy", F.lit(False))
                 .unionByName(both.where("_copy")
                              .withColumn("_copy", F.row_number().over(nth) > 1)))
    side = F.broadcast(found) if many <= BROADCAST_SPANS else found
    joined = keyed.join(side, ["_a", "_b"], "left")

    @F.pandas_udf("text string, removed array<struct<from:int,to:int>>, n int")
    def cut(texts, spans, copy):
        import pandas as pd
        out, gone, n = [], [], []
        for t, ss, again in zip(texts, spans, copy):
            if t is None:
                out.append(None)
                gone.append(None)
                n.append(0)
                continue
            rows = t.split("\n")
            if again and len(t.split()) >= min_words:
                ss = [{"from": 0, "to": len(rows) - 1}]
            drop = bytearray(len(rows))
            for s in ss if ss is not None else ():
                drop[s["from"]:s["to"] + 1] = b"\1" * (s["to"] - s["from"] + 1)
            merged, i = [], 0
            while i < len(rows):
                j = i
                while j < len(rows) and drop[j]:
                    j += 1
                if j > i:
                    merged.append({"from": i, "to": j - 1})
                i = j + 1
            out.append("\n".join(r for r, d in zip(rows, drop) if not d))
            gone.append(merged)
            n.append(sum(drop))
        return pd.DataFrame({"text": out, "removed": gone, "n": n})

    # Spark may copy a deterministic function into a filter on its results: each
    # task would run it twice, and each executor keep twice the Python workers
    cut = cut.asNondeterministic()
    touched = F.col("_spans").isNotNull() | F.col("_copy")
    new = cut(F.when(touched, F.col(text)), F.col("_spans"), F.col("_copy"))
    lines = (F.octet_length(F.col(text))
             - F.octet_length(F.replace(F.col(text), F.lit("\n"), F.lit(""))) + 1)
    none = F.array().cast("array<struct<from:int,to:int>>")
    return (joined.withColumn("_new", new)
            .withColumn("n_lines", F.coalesce(lines, F.lit(0)).cast("int"))
            .withColumn("n_removed", F.col("_new.n"))
            .withColumn("removed", F.coalesce(F.col("_new.removed"), none))
            .withColumn(text, F.when(touched & F.col(text).isNotNull(), F.col("_new.text"))
                        .otherwise(F.col(text)))
            .drop("_a", "_b", "_spans", "_copy", "_new")
            .select(*docs.columns, "n_lines", "n_removed", "removed"))


def op3_line_dedup(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return drop_repeated_lines(docs)
