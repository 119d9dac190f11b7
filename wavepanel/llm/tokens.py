"""Exact token counts of whole texts, with huge texts encoded in chunks.

Texts of ordinary length are counted where they are read.  The byte-level
pre-tokenizer always begins a piece at a space before a non-space, so a text
is cut there and the pieces' counts, which repeat a lot, come from a bounded
cache.

A huge text is cut into chunks that overlap.  Each chunk is encoded on its own
with offsets, by whichever task gets it, and neighbours are spliced where both
encodings have a pre-token boundary.  Why a shared boundary is safe: the
pre-tokenizer never looks back, so from a true boundary on, both encodings of
the same characters agree; and a boundary of the left chunk is true if it lies
more than MARGIN characters before that chunk's end (no special string or
look-ahead can still change it), by induction from the first chunk, which
begins where the text does.  Chunks without such a boundary are joined and
encoded again, so the overlap widens until they align.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage
from .common import own_columns, quiet_tokenizer, read, schema, small_batches, spans

CHUNK_CHARS = 32_768
OVERLAP_CHARS = 1_024
# more than the longest special string and the one character of look-ahead
MARGIN = 32
# distinct pieces kept per Python worker; the cache starts anew beyond it
CACHE = 400_000

# Boundaries inside a piece that hold wherever the piece stands: around a
# single line break between non-spaces, and between a letter and a stop.
_INNER = re.compile(r"(?<=\S)(?=\n\S)|(?<=\S\n)(?=\S)|(?<=[A-Za-z])(?=[.,!?;:])")
_counters: dict[str, "PieceCounter"] = {}


class PieceCounter:
    """Token counts of a byte-level BPE tokenizer through a cache of pieces."""

    def __init__(self, path: str):
        self.tok = quiet_tokenizer(path)
        self.pieces: dict[str, int] = {}
        self.parts: dict[str, int] = {}

    @classmethod
    def of(cls, path: str) -> "PieceCounter":
        if path not in _counters:
            _counters[path] = cls(path)
        return _counters[path]

    def cut(self, text: str) -> list[str]:
        """Pieces of ``text``; they begin at a space before a non-space."""
        raw = text.split(" ")
        out, hold = [raw[0]], []
        for p in raw[1:]:
            if p and not p[0].isspace():
                if hold:
                    out[-1] += "".join(hold)
                    hold = []
                out.append(" " + p)
            else:
                hold.append(" " + p)
        if hold:
            out[-1] += "".join(hold)
        return out

    def learn(self, wanted: set[str]) -> None:
        if len(self.pieces) > CACHE:
            self.pieces.clear()
        if len(self.parts) > CACHE:
            self.parts.clear()
        cut = {p: _INNER.split(p) for p in wanted if p not in self.pieces}
        new = list({x for parts in cut.values() for x in parts if x not in self.parts})
        for i in range(0, len(new), 20_000):
            some = new[i:i + 20_000]
            for x, e in zip(some, self.tok.encode_batch_fast(some, add_special_tokens=False)):
                self.parts[x] = len(e)
        for p, parts in cut.items():
            self.pieces[p] = sum(map(self.parts.__getitem__, parts))

    def counts(self, texts: list[str]) -> list[int]:
        out = [0] * len(texts)
        batch, size = [], 0
        for i, t in enumerate(texts):
            for s in spans(t):
                batch.append((i, self.cut(s)))
                size += len(s)
                if size > (1 << 22):
                    self._add(batch, out)
                    batch, size = [], 0
        self._add(batch, out)
        return out

    def _add(self, batch, out) -> None:
        self.learn({p for _, ps in batch for p in ps})
        for i, ps in batch:
            out[i] += sum(map(self.pieces.__getitem__, ps))


def _boundaries(enc) -> list[tuple[int, int]]:
    """(character, tokens before it) where a pre-token or special string begins."""
    out, last = [], object()
    for i, (w, (a, _)) in enumerate(zip(enc.word_ids, enc.offsets)):
        if w is None or w != last:
            out.append((a, i))
        last = w
    return out


def count_tokens(df: DataFrame, path: str, text: str = "text",
                 chunk_chars: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> DataFrame:
    """``df`` without ``text``, with n_bytes and n_tokens of each whole text.

    Counts are those of the tokenizer file at ``path`` (byte-level BPE) with no
    added special tokens.  A null text counts as empty: 0 bytes, 0 tokens.
    Repeated rows stay repeated; an empty table stays empty; a column of the
    input named like one that is added is replaced.
    """
    df = own_columns(small_batches(df),
                     ["n_bytes", "n_tokens", "_rid", "_chunk", "_from", "_text"])
    keep = [c for c in df.columns if c != text]
    rows = df.select(*keep, F.coalesce(F.col(text), F.lit("")).alias("_text"),
                     F.monotonically_increasing_id().alias("_rid"))
    kept_schema = df.select(*keep).schema
    out_schema = schema("_rid long, n_bytes long, n_tokens long, _chunk int, _from long, "
                        "_text string")
    first_schema = type(kept_schema)(list(kept_schema.fields) + list(out_schema.fields))

    def first(batches):
        counter = PieceCounter.of(path)
        for b in batches:
            texts, rids = b.column("_text").to_pylist(), b.column("_rid").to_pylist()
            short = [i for i, t in enumerate(texts) if len(t) <= chunk_chars + overlap]
            n = dict(zip(short, counter.counts([texts[i] for i in short])))
            idx, out = [], []
            for i, t in enumerate(texts):
                size = len(t.encode())
                if i in n:
                    idx.append(i)
                    out.append((rids[i], size, n[i], None, None, None))
                    continue
                starts = range(0, len(t) - overlap, chunk_chars)
                for k, s in enumerate(starts):
                    end = s + chunk_chars + overlap if k + 1 < len(starts) else len(t)
                    idx.append(i)
                    out.append((rids[i], size, None, k, s, t[s:end]))
            kept = [b.column(c).take(pa.array(idx, pa.int64())) for c in keep]
            cols = list(zip(*out)) if out else [[]] * 6
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                kept + [pa.array(c, k) for c, k in zip(cols, kinds)],
                names=keep + out_schema.names)

    got = stage(rows.mapInArrow(first, first_schema), "token-counts")
    done = got.where(F.col("_chunk").isNull()).drop("_rid", "_chunk", "_from", "_text")
    long_ids = got.where(F.col("_chunk") == 0).drop("_chunk", "_from", "_text", "n_tokens")
    chunks = got.where(F.col("_chunk").isNotNull()).select("_rid", "_chunk", "_from", "_text")
    if chunks.isEmpty():
        return done
    totals = spliced_counts(chunks, path, overlap)
    return done.unionByName(long_ids.join(totals, "_rid").drop("_rid"))


def spliced_counts(chunks: DataFrame, path: str, overlap: int) -> DataFrame:
    """(_rid, n_tokens) of texts given as overlapping chunks."""
    enc_schema = schema("_rid long, _chunk int, _from long, len long, n long, "
                        "lp array<long>, ln array<long>, rp array<long>, rn array<long>")

    def encode(batches):
        tok = PieceCounter.of(path).tok
        for b in batches:
            out = []
            for rid, k, start, t in zip(*(b.column(c).to_pylist() for c in
                                          ("_rid", "_chunk", "_from", "_text"))):
                e = tok.encode(t, add_special_tokens=False)
                bounds = [(a + start, i) for a, i in _boundaries(e)]
                left = bounds        # the neighbour keeps those it trusts
                if len(t) > 4 * overlap:
                    left = [x for x in bounds if x[0] <= start + 2 * overlap]
                right = [x for x in bounds if x[0] <= start + len(t) - MARGIN
                         and x[0] >= start + len(t) - 2 * overlap]
                out.append((rid, k, start, len(t), len(e.ids), [x[0] for x in left],
                            [x[1] for x in left], [x[0] for x in right], [x[1] for x in right]))
            cols = list(zip(*out)) if out else [[]] * 9
            la = pa.list_(pa.int64())
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), la, la, la, la]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                             names=enc_schema.names)

    results = []
    while True:
        dealt = chunks.repartition("_rid", "_chunk")
        enc = stage(dealt.mapInArrow(encode, enc_schema), "token-chunks")
        nxt = Window.partitionBy("_rid").orderBy("_chunk")
        pairs = (enc.withColumn("np", F.lead("lp").over(nxt)).withColumn("nn", F.lead("ln").over(nxt))
                 .withColumn("last", F.lead("_chunk").over(nxt).isNull())
                 .withColumn("at", F.array_min(F.array_intersect("rp", "np")))
                 .withColumn("gain", F.when(F.col("last"), F.col("n")).when(
                     F.col("at").isNotNull(),
                     F.element_at("rn", F.array_position("rp", F.col("at")).cast("int"))
                     - F.element_at("nn", F.array_position("np", F.col("at")).cast("int"))))
                 .withColumn("failed", ~F.col("last") & F.col("at").isNull()))
        judged = stage(pairs.select("_rid", "_chunk", "_from", "len", "gain", "failed"),
                       "token-splices")
        docs = judged.groupBy("_rid").agg(F.sum("gain").alias("n_tokens"),
                                          F.max("failed").alias("bad"))
        results.append(docs.where(~F.col("bad")).select("_rid", "n_tokens"))
        bad = docs.where("bad").select("_rid")
        if bad.isEmpty():
            break
        # join each failing pair into one chunk: its number is the count of
        # good splices before it, its text the pieces without their overlap
        upto = Window.partitionBy("_rid").orderBy("_chunk").rowsBetween(
            Window.unboundedPreceding, -1)
        redo = (judged.join(bad, "_rid", "left_semi")
                .withColumn("_new", F.coalesce(F.sum(F.when(F.col("failed"), 0).otherwise(1))
                                               .over(upto), F.lit(0)).cast("int"))
                .withColumn("_cut", F.when(F.col("failed"), F.lead("_from").over(nxt)
                                           - F.col("_from")).otherwise(F.col("len")))
                .select("_rid", "_chunk", "_new", "_cut"))
        chunks = stage(
            chunks.join(redo, ["_rid", "_chunk"])
            .withColumn("_part", F.expr("substring(_text, 1, cast(_cut as int))"))
            .groupBy("_rid", "_new")
            .agg(F.array_join(F.transform(F.array_sort(F.collect_list(
                F.struct("_chunk", "_part"))), lambda x: x["_part"]), "").alias("_text"),
                F.min("_from").alias("_from"))
            .select("_rid", F.col("_new").alias("_chunk"), "_from", "_text"), "token-rechunks")
    out = results[0]
    for r in results[1:]:
        out = out.unionByName(r)
    return out


def op2_token_counts(spark, sf_dir, limit: int = 1024):
    import public_tokenizers
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return (count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"))
            .withColumn("over_limit", F.col("n_tokens") > limit)
            .select("doc_id", "n_bytes", "n_tokens", "over_limit"))
