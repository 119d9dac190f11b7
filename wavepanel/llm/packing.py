"""Packing of token pieces into few sequences of a fixed capacity.

Texts become pieces of at most ``capacity`` tokens.  Pieces are dealt by a hash
to groups of bounded size.  Each group is packed best-fit decreasing and then
improved by local search: moves, one-for-one and two-for-one exchanges between
underfull bins that raise the sum of squared fills, with every underfull bin as
a source, until nothing improves within its block of bins.  The poorly filled bins of all groups go to the next
round, with fewer groups, until one group is left; so no task sees more than a
group, and the groups cost almost no sequence.
"""

from __future__ import annotations

import re
import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .common import give_back, quiet_tokenizer, read, schema, small_batches, spans

CAPACITY = 4096
# Pieces that one task packs at a time.
GROUP_PIECES = 200_000
# Bins filled to less than this share are opened again in the next round.
REOPEN = 0.98
# Distinct words kept per Python worker, and their bytes; beyond either, the
# half used last stays.
CACHE, CACHE_BYTES = 500_000, 32 << 20
# Characters that are cut into words at a time.
BATCH_CHARS = 1 << 20
# New words that the tokenizer encodes at a time; each is a large object meanwhile.
ENCODED = 2_000
# Underfull bins that exchange with each other at a time.
SEARCH_BINS = 256

# The word tokenizer file's pre-tokens, in the characters below: a run of
# letters, a contraction's end, one number sign, a run of anything else.
_LETTERS, _NUMBERS = "A-Za-zªµºÀ-ÖØ-öø-įı-ſ", "0-9²³¹¼-¾"
_WORD = re.compile(f"[{_LETTERS}]+|'(?:[stmd]|re|ve|ll)|[{_NUMBERS}]|[^ {_LETTERS}{_NUMBERS}]+")
# Elsewhere lower-casing and NFC may differ between libraries; a special string
# may start with the two last ones.
_ODD = re.compile(r"[^ \x21-\x7e¡-įı-ſ]|<\|")
_words: dict[str, "WordIds"] = {}


def _cut(text: str) -> list[str]:
    """The pre-tokens of ``text`` in order; a word with odd characters is whole
    and has a newline before it, which no pre-token has."""
    text = text.replace("\n", " ").replace("\t", " ").replace("\r", " ")
    out, at = [], 0
    for m in _ODD.finditer(text):
        if m.start() < at:
            continue
        a = text.rfind(" ", at, m.start()) + 1 or at
        b = text.find(" ", m.start())
        b = len(text) if b < 0 else b
        out += _WORD.findall(text[at:a].lower())
        out.append("\n" + text[a:b])
        at = b
    out += _WORD.findall(text[at:].lower())
    return out


def _gather(flat: np.ndarray, start: np.ndarray, n: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The parts ``at`` of ``flat`` one after another."""
    kind = np.int32 if len(flat) < 1 << 31 else np.int64
    size = n[at]
    first = np.cumsum(size) - size
    place = np.repeat((start[at] - first).astype(kind), size)
    place += np.arange(len(place), dtype=kind)
    return flat[place]


class WordIds:
    """Token ids of whole texts through a cache of words.

    The tokenizer drops white space and never joins what stands on both sides
    of it, nor two pre-tokens, so the ids of a text are those of its pre-tokens
    one after another.  Arrow numbers the distinct ones of many texts, and only
    new ones are encoded.
    """

    def __init__(self, path: str):
        from tokenizers import pre_tokenizers
        self.tok = quiet_tokenizer(path)
        self.whole = (self.tok.normalizer, self.tok.pre_tokenizer)
        # for words that are lower-case and cut already
        self.bare = (None, pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False))
        self.forget()

    def forget(self, stay: np.ndarray | None = None) -> None:
        """Keeps the words ``stay`` only."""
        if stay is None:
            self.known = pa.array([], pa.large_string())
            self.flat, self.n, self.used = (np.zeros(0, t) for t in ("<u4", np.int64, np.int64))
            self.turn = 0
        else:
            self.known = self.known.take(pa.array(stay))
            self.flat = _gather(self.flat, np.cumsum(self.n) - self.n, self.n, stay)
            self.n, self.used = self.n[stay], self.used[stay]

    @classmethod
    def of(cls, path: str) -> "WordIds":
        if path not in _words:
            _words[path] = cls(path)
        return _words[path]

    def numbered(self, words: pa.Array) -> np.ndarray:
        """Places of distinct words in the cache, where all are then."""
        if len(self.known) > CACHE or self.known.nbytes > CACHE_BYTES:
            self.forget(np.argsort(-self.used, kind="stable")[:CACHE // 2])
            if self.known.nbytes > CACHE_BYTES:
                self.forget()
        at = pc.index_in(words, value_set=self.known)
        new = np.flatnonzero(at.is_null().to_numpy(zero_copy_only=False))
        at = at.fill_null(-1).to_numpy().astype(np.int64)
        if len(new):
            added = words.take(pa.array(new))
            at[new] = len(self.known) + np.arange(len(new))
            ids: list[list[int]] = [[]] * len(new)
            odd = pc.starts_with(added, "\n").to_numpy(zero_copy_only=False)
            texts = added.to_pylist()
            for way, some in ((self.bare, np.flatnonzero(~odd)), (self.whole, np.flatnonzero(odd))):
                if not len(some):
                    continue
                self.tok.normalizer, self.tok.pre_tokenizer = way
                for k in range(0, len(some), ENCODED):
                    part = some[k:k + ENCODED].tolist()
                    for i, e in zip(part, self.tok.encode_batch_fast(
                            [texts[i].removeprefix("\n") for i in part],
                            add_special_tokens=False)):
                        ids[i] = e.ids
            self.known = pa.concat_arrays([self.known, added])
            self.n = np.concatenate((self.n, np.fromiter(map(len, ids), np.int64, len(ids))))
            self.flat = np.concatenate((self.flat, np.fromiter(chain.from_iterable(ids), "<u4")))
            self.used = np.concatenate((self.used, np.zeros(len(new), np.int64)))
        self.turn += 1
        self.used[at] = self.turn
        return at

    def of_parts(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all parts, where each part's ids start and the last ones end)."""
        coded = pa.array(parts, pa.large_string()).dictionary_encode()
        at = self.numbered(coded.dictionary)[coded.indices.to_numpy()]
        ends = np.concatenate(([0], np.cumsum(self.n[at])))
        return _gather(self.flat, np.cumsum(self.n) - self.n, self.n, at), ends

    def ids(self, texts: list[str], end: bytes) -> list[bytes]:
        """Little-endian 32-bit ids of each text, then ``end``."""
        out: list[bytes] = []
        parts: list[str] = []
        upto = [0]
        size = 0

        def flush():
            nonlocal parts, upto, size
            ids, ends = self.of_parts(parts)
            for a, b in zip(ends[upto[:-1]], ends[upto[1:]]):
                out.append(ids[a:b].tobytes() + end)
            parts, upto, size = [], [0], 0

        for t in texts:
            if len(t) > 2 * BATCH_CHARS:           # a huge text: in spans
                flush()
                out.append(b"".join([self.of_parts(_cut(s))[0].tobytes() for s in spans(t)]) + end)
                continue
            parts += _cut(t)
            upto.append(len(parts))
            size += len(t)
            if size > BATCH_CHARS:
                flush()
        flush()
        return out


def token_pieces(df: DataFrame, path: str, text: str = "text", row_id: str = "doc_id",
                 capacity: int = CAPACITY, end_id: int = 1) -> DataFrame:
    """One row per piece of a text: (row_id, piece, start, length, ids_crc32).

    A text is the ids of the tokenizer at ``path`` and then ``end_id``; a null
    text is empty and so has one token.  Only texts longer than ``capacity``
    are cut, into full pieces and a last one.
    """
    df = small_batches(df)
    kind = df.schema[row_id].dataType.simpleString()
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches):
        words = WordIds.of(path)
        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            rows, piece, start, length, crc = [], [], [], [], []
            for i, ids in enumerate(words.ids(texts, end)):
                for k in range(0, len(ids), 4 * capacity):
                    part = ids[k:k + 4 * capacity]
                    rows.append(i)
                    piece.append(k // (4 * capacity))
                    start.append(k // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(rows, pa.int64())), pa.array(piece, pa.int32()),
                 pa.array(start, pa.int64()), pa.array(length, pa.int64()),
                 pa.array(crc, pa.int64())],
                names=[row_id, "piece", "start", "length", "ids_crc32"])
            # words come and go by the million: after each batch, not each task
            texts = ids = part = None
            give_back()

    return df.select(row_id, text).mapInArrow(
        cut, schema(f"`{row_id}` {kind}, piece int, start long, length long, ids_crc32 long"))


def best_fit(sizes: list[int], capacity: int) -> list[int]:
    """Bin of each size; sizes come in falling order.

    ``free`` has a bit for each amount of room that some bin has, so the bin
    with the least sufficient room is found by one shift.
    """
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    free, bins, out = 0, 0, []
    for s in sizes:
        fits = free >> s
        if fits:
            room = s + (fits & -fits).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                free &= ~(1 << room)
        else:
            b, room = bins, capacity
            bins += 1
        out.append(b)
        left = room - s
        if left:
            by_room[left].append(b)
            free |= 1 << left
    return out


def _back_sizes(members: list[tuple[int, int]]) -> np.ndarray:
    """What a bin may give back: nothing or one of its pieces."""
    return np.array(sorted({0, *(x[0] for x in members)}), np.int64)


def _best_step(bins: list[list[tuple[int, int]]], fill: list[int], backs: list[np.ndarray],
               t: int, among, capacity: int) -> tuple | None:
    """(pieces off bin ``t``, target, pieces back) of the step to a bin of
    ``among`` that raises the squared fills most; None if no step raises them."""
    among = [b for b in among if b != t and bins[b] and fill[t] <= fill[b] < capacity]
    if not among:
        return None
    mine = np.array(sorted(x[0] for x in bins[t]), np.int64)
    loads = np.unique(mine)
    if len(mine) > 1:                          # pairs, a size at most twice
        twice = mine[2:] != mine[:-2]
        few = mine[np.concatenate(([True, True], twice))]
        i, j = np.triu_indices(len(few), 1)
        loads = np.unique(np.concatenate((loads, few[i] + few[j])))
    of = np.repeat(among, [len(backs[b]) for b in among])
    back = np.concatenate([backs[b] for b in among])
    filled = np.array(fill, np.int64)[of]
    # the largest load that fits is the best one for what comes back
    at = np.searchsorted(loads, back + capacity - filled, "right") - 1
    gain = np.where(at >= 0, loads[at] - back, 0)
    rise = np.where(gain > 0, gain * (filled - fill[t] + gain), 0)
    best = int(rise.argmax())
    if not rise[best]:
        return None
    return (_pieces(bins[t], int(loads[at[best]])), int(of[best]),
            _pieces(bins[of[best]], int(back[best])))


def _pieces(members: list[tuple[int, int]], load: int) -> list[tuple[int, int]]:
    """At most two pieces of this total."""
    if not load:
        return []
    for x in members:
        if x[0] == load:
            return [x]
    for i, x in enumerate(members):
        for y in members[i + 1:]:
            if x[0] + y[0] == load:
                return [x, y]
    raise ValueError(load)


def _swap(bins, fill, t, xs, b, ys) -> bool:
    for x in xs:
        bins[t].remove(x)
        bins[b].append(x)
    for y in ys:
        bins[b].remove(y)
        bins[t].append(y)
    gain = sum(x[0] for x in xs) - sum(y[0] for y in ys)
    fill[t] -= gain
    fill[b] += gain
    return True


def _search_block(bins: list[list[tuple[int, int]]], capacity: int
                  ) -> list[list[tuple[int, int]]]:
    """Steps among ``bins`` until none has one or they are as few as can be."""
    bins = [list(b) for b in bins]
    fill = [sum(x[0] for x in b) for b in bins]
    least, alive = -(-sum(fill) // capacity), len(bins)
    backs = [_back_sizes(b) for b in bins]
    changed: list[int] = []                    # bins in the order of their changes
    tried = [-1] * len(bins)                   # changes seen when a source had no step
    moved = True
    while moved and alive > least:
        moved = False
        for t in sorted(range(len(bins)), key=lambda i: fill[i]):
            while bins[t] and alive > least and tried[t] < len(changed):
                among = range(len(bins)) if tried[t] < 0 else sorted(set(changed[tried[t]:]))
                step = _best_step(bins, fill, backs, t, among, capacity)
                if step is None:
                    tried[t] = len(changed)
                    break
                b = step[1]
                _swap(bins, fill, t, *step)
                moved = True
                changed += [t, b]
                tried[t] = tried[b] = -1
                backs[t], backs[b] = _back_sizes(bins[t]), _back_sizes(bins[b])
                alive -= not bins[t]
    return [b for b in bins if b]


def local_search(bins: list[list[tuple[int, int]]], capacity: int) -> list[list[tuple[int, int]]]:
    """Empties bins of (size, item) lists while exchanges allow it.

    Each step moves load from a bin to a fuller one, so the sum of squared
    fills rises and the search ends.  All underfull bins are walked, emptiest
    first, in blocks of SEARCH_BINS; the emptiest eighth of a block goes on into
    the next one.  In a block every bin is a source until none has a step.
    Walks are repeated while they empty a bin, and stop when the bins are as
    few as their total needs.
    """
    def load(b):
        return sum(x[0] for x in b)

    full = [b for b in bins if load(b) >= capacity]
    work = [b for b in bins if load(b) < capacity]
    while len(work) > -(-sum(map(load, work)) // capacity):
        before, left, done = len(work), sorted(work, key=load), []
        carried: list[list[tuple[int, int]]] = []
        while left:
            take = SEARCH_BINS - len(carried)
            block = sorted(_search_block(carried + left[:take], capacity), key=load)
            left = left[take:]
            some = SEARCH_BINS // 8 if left else 0
            carried = block[:some]
            done += block[some:]
        work = [b for b in done if load(b) < capacity]
        full += [b for b in done if load(b) >= capacity]
        if len(done) >= before:
            break
    return full + work


def pack_group(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bin, offset, fill of the bin) of each size."""
    order = np.argsort(-sizes, kind="stable")
    ordered = sizes[order].tolist()
    placed = best_fit(ordered, capacity)
    bins: list[list[tuple[int, int]]] = [[] for _ in range(max(placed, default=-1) + 1)]
    for i, (s, b) in enumerate(zip(ordered, placed)):
        bins[b].append((s, i))
    bins = local_search(bins, capacity)
    of, offset, fill = (np.zeros(len(sizes), np.int64) for _ in range(3))
    for k, members in enumerate(bins):
        at, total = 0, sum(s for s, _ in members)
        for s, i in members:
            j = order[i]
            of[j], offset[j], fill[j] = k, at, total
            at += s
    return of, offset, fill


def pack(pieces: DataFrame, length: str = "length", capacity: int = CAPACITY,
         group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Adds sequence_id and offset to staged pieces of 1 .. capacity tokens.

    Every row gets a place, repeated rows each their own.  An empty table
    stays empty.
    """
    rows = stage(pieces.withColumn("_uid", F.monotonically_increasing_id()), "pack-pieces")
    whole = F.col(length) >= capacity
    placed = [rows.where(whole).select("_uid", (-F.col("_uid") - 1).alias("sequence_id"),
                                       F.lit(0).cast("long").alias("offset"))]
    open_ = rows.where(~whole).select("_uid", F.col(length).cast("long").alias("size"))
    left = open_.count()
    groups = -(-left // group_pieces)
    out = "_uid long, size long, sequence_id long, offset long, fill long"
    for turn in range(1, 64):
        if not left:
            break
        first = turn << 56

        def packed(pdf):
            pdf = pdf.sort_values(["size", "_uid"], ascending=[False, True], kind="stable")
            b, off, fill = pack_group(pdf["size"].to_numpy(), capacity)
            base = first + (int(pdf["_g"].iloc[0]) << 24)
            give_back()
            return pdf.assign(sequence_id=base + b, offset=off, fill=fill)[
                ["_uid", "size", "sequence_id", "offset", "fill"]]

        got = stage(open_.withColumn("_g", F.pmod(F.xxhash64("_uid", F.lit(turn)),
                                                  F.lit(groups)).cast("int"))
                    .groupBy("_g").applyInPandas(packed, out), "pack-round")
        again = F.col("fill") < REOPEN * capacity
        last = groups == 1
        placed.append((got if last else got.where(~again)).select("_uid", "sequence_id", "offset"))
        if last:
            break
        open_ = got.where(again).select("_uid", "size")
        before, left = groups, open_.count()
        groups = min(max(1, before // 2), -(-left // group_pieces)) if left else 0
    out_df = placed[0]
    for p in placed[1:]:
        out_df = out_df.unionByName(p)
    return rows.join(out_df, "_uid").drop("_uid")


def pack_texts(docs: DataFrame, path: str, text: str = "text", row_id: str = "doc_id",
               capacity: int = CAPACITY) -> DataFrame:
    """Whole texts packed: (row_id, piece, start, length, ids_crc32, sequence_id, offset).

    Null and empty texts have one token.  Null and repeated row ids are packed
    as rows of their own.  Other columns of ``docs`` are not read.
    """
    return pack(token_pieces(docs, path, text, row_id, capacity), "length", capacity)


def op8_packed_sequences(spark, sf_dir):
    import public_tokenizers
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return pack_texts(docs, public_tokenizers.path("word_bpe_49k.json"))
