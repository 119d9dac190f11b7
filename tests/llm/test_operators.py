"""The operators against brute force on small fixtures, odd rows included."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from wavepanel.llm import decontamination, jaccard, lines, neighbours, packing, pii, quality
from wavepanel.llm import sharding, tokens, warc
from wavepanel.llm.common import read

SMOKE = "/root/testdata/sf0.001"
ODD = [(1, "same text here"), (2, "same text here"), (2, "same text here"), (3, None), (4, ""),
       (None, "no id"), (5, " \n\t "), (6, "naïve Ünïcode — “x” 中文"), (7, "<|endoftext|> in it")]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, "x", 9) for i, t in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, size string, n_tokens int")


@pytest.fixture(scope="module")
def docs(spark):
    return read(spark, SMOKE, "documents").select("doc_id", "text")


@pytest.fixture(scope="module")
def none(docs):
    return docs.where("false")


# ------------------------------------------------------------------ 1 shards

def best_capacity(sizes, k):
    low, high = max(sizes), sum(sizes)
    while low < high:
        mid, used, room = (low + high) // 2, 1, (low + high) // 2
        for s in sizes:
            if s > room:
                used, room = used + 1, mid
            room -= s
        low, high = (low, mid) if used <= k else (mid + 1, high)
    return low


@pytest.mark.parametrize("seed,hot", [(1, 1), (2, 400), (3, 40)])
def test_minimax_capacity_is_the_least(spark, monkeypatch, seed, hot):
    monkeypatch.setattr(sharding, "PIECES", 12)        # forces several looks
    rng = np.random.default_rng(seed)
    sizes = rng.integers(1, 50, 300).tolist()
    sizes[17] *= hot
    g = spark.createDataFrame([(f"{i:04d}", s) for i, s in enumerate(sizes)], "k string, s long")
    capacity, cuts = sharding.minimax_cuts(g, "k", "s", 8)
    assert capacity == best_capacity(sizes, 8)
    got = g.withColumn("shard", sharding.shard_of(F.col("k"), cuts))
    assert max(r["t"] for r in got.groupBy("shard").agg(F.sum("s").alias("t")).collect()) == capacity


class Listed(sharding.Boundaries):
    """Boundaries in a list; counts the looks and the rows of each."""

    def __init__(self, ends):
        super().__init__(None, int(ends[-1]))
        self.ends, self.rows = ends, []

    def look_into(self, gaps):
        ends, seen = self.ends, []

        class Totals:                                  # stands in for the running totals
            def where(self, _): return self
            def groupBy(self, _): return self
            def agg(self, *_): return self

            def collect(self):
                return seen

        spans = [(self.known[g - 1], self.known[g]) for g in gaps]
        each = max(2, sharding.PIECES // len(gaps))
        fixed = np.array(sorted({a + (b - a) * j // each for a, b in spans
                                 for j in range(each + 1)}))
        inside = ends[(ends > fixed[0]) & (ends <= fixed[-1])]
        at = np.searchsorted(fixed, inside, "left")
        for p in np.unique(at):
            part = inside[at == p]
            seen.append({"a": int(part[0]), "b": int(part[-1]), "n": len(part)})
        self.rows.append(len(seen))
        self.totals = Totals()
        super().look_into(gaps)


@pytest.mark.parametrize("seed,hot", [(1, 0.3), (2, 0.15), (3, 0.0), (4, 0.6)])
def test_minimax_search_ends_on_a_hot_text(spark, seed, hot):
    rng = np.random.default_rng(seed)
    sizes = rng.integers(1, 4000, 200_000)
    sizes[rng.integers(0, len(sizes))] += int(hot / (1 - hot) * sizes.sum())
    sizes[rng.integers(0, len(sizes), 1000)] = 0
    known = Listed(np.cumsum(sizes))
    capacity, cuts = known.solve(8, int(sizes.max()))
    assert capacity == best_capacity(sizes.tolist(), 8)
    assert len(known.rows) < 30 and max(known.rows) <= 2 * sharding.PIECES + 1
    ends = np.cumsum(sizes)
    assert np.isin(cuts, np.concatenate(([0], ends))).all()
    assert np.diff([0, *cuts, ends[-1]]).max() == capacity


def test_shards_of_odd_rows(spark, odd, none):
    got = sharding.shard_texts(odd, 3).collect()
    assert len(got) == len(ODD)
    by_text = defaultdict(set)
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
        by_text[r.text_crc32, r["size"]].add(r.shard)
    assert all(len(s) == 1 for s in by_text.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.shard_texts(none).count() == 0


# ------------------------------------------------------------------ 2 tokens

@pytest.mark.parametrize("chunk,overlap", [(200, 64), (1000, 100)])
def test_token_counts(spark, docs, odd, chunk, overlap):
    path = public_tokenizers.path("byte_bpe_50k.json")
    tok = Tokenizer.from_file(path)
    tricky = [(900, "a" * 3000), (901, "x \n\n  y" * 300), (902, " " * 1500 + "z"),
              (903, "it's <|endoftext|> " * 150), (904, "word " * 700), (905, "\n" * 900)]
    df = docs.unionByName(odd.select("doc_id", "text")).unionByName(
        spark.createDataFrame(tricky, "doc_id long, text string"))
    want = sorted((r.doc_id or -1, len((r.text or "").encode()),
                   len(tok.encode(r.text or "", add_special_tokens=False).ids)) for r in df.collect())
    got = sorted((r.doc_id or -1, r.n_bytes, r.n_tokens)
                 for r in tokens.count_tokens(df, path, chunk_chars=chunk, overlap=overlap).collect())
    assert got == want
    assert tokens.count_tokens(odd, path).columns == ["doc_id", "size", "n_bytes", "n_tokens"]


# ------------------------------------------------------------- 3 line dedup

def brute_lines(rows, least):
    seqs = [(d, t, [(i, x.strip(" \t\r")) for i, x in enumerate(t.split("\n")) if x.strip(" \t\r")])
            for d, t in sorted(rows)]
    places = [(a, j) for a, (_, _, s) in enumerate(seqs) for j in range(len(s))]
    out = {}
    for a, (d, t, s) in enumerate(seqs):
        gone = set()
        for j in range(len(s)):
            best = 0
            for b, i in places:
                if (b, i) >= (a, j):
                    break
                q, n = seqs[b][2], 0
                while j + n < len(s) and i + n < len(q) and s[j + n][1] == q[i + n][1]:
                    n += 1
                best = max(best, n)
            if best and sum(len(x.split()) for _, x in s[j:j + best]) >= least:
                gone.update(range(s[j][0], s[j + best - 1][0] + 1))
        out[d] = "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone)
    return out


def test_line_runs_against_brute_force(spark):
    rng = np.random.default_rng(5)
    words = ["a b c", "d e", "f", "g h i j", "k k k k k k", "l m", "n", "", "  "]
    rows = [(i, "\n".join(rng.choice(words, rng.integers(0, 14)))) for i in range(50)]
    rows += [(100, rows[5][1] + "\nx y z"), (101, rows[5][1])]
    got = lines.drop_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string"),
                                    min_words=7).collect()
    assert {r.doc_id: r.text for r in got} == brute_lines(rows, 7)


def test_runs_that_differ_near_the_end_of_an_island(spark):
    line = {k: " ".join(f"{k}{i}" for i in range(10)) for k in "abcdexy"}
    runs = ["abcde", "abcxe", "abcde", "abcxe", "yabcde", "eabxde"]
    rows = [(i, "\n".join(line[k] for k in run)) for i, run in enumerate(runs)]
    rng = np.random.default_rng(8)
    rows += [(100 + i, "\n".join(rng.choice(["p q", "r", "s t", "u"], rng.integers(5, 12))))
             for i in range(60)]
    for least in (50, 11):
        got = lines.drop_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string"),
                                        min_words=least).collect()
        assert {r.doc_id: r.text for r in got} == brute_lines(rows, least)


def test_filtered_lines_are_cut_once(spark):
    """A filter on the results leaves one Python step in the task, not two."""
    run = "\n".join(f"line {i} has a few words of its own" for i in range(8))
    docs = spark.createDataFrame([(1, run, "x", "y", 1), (2, run, "x", "y", 1), (3, f"end\n{run}", "x", "y", 1),
                                  (4, None, "x", "y", 1)], corpus_pipeline.COLUMNS)
    kept = corpus_pipeline.line_dedup(spark, docs, SMOKE)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"ArrowEvalPython \[", plan)) == 1
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == [(1, run), (3, "end"), (4, None)]


def test_lines_of_odd_rows(odd, none):
    got = lines.drop_repeated_lines(odd, min_words=3).collect()
    texts = Counter((r.doc_id, r.text) for r in got)
    assert texts[1, "same text here"] == 1 and texts[2, ""] == 2 and texts[3, None] == 1
    assert texts[None, "no id"] == 1 and "size" in got[0].asDict()
    assert lines.drop_repeated_lines(none).count() == 0


# --------------------------------------------------------------------- 4 PII

def test_pseudonyms_keep_format_and_links(spark):
    card, phone, mail = "4111 1111 1111 1111", "+1 (212) 555-0123", "jane.d0e@example.org"
    text = f"{card}, {phone} {mail} 10.1.2.3 on 2001-02-03 or 3/2/2001; 999.1.1.1 4111111111111112"
    df = spark.createDataFrame([(1, text), (2, text), (3, None), (4, ""), (5, "clean 12")],
                               "doc_id int, text string")
    got = {r.doc_id: r for r in pii.pseudonymise(df, pii.DEMO_KEY).collect()}
    assert got[1].text == got[2].text and got[1].n_replaced == 6
    assert (got[3].text, got[4].text, got[5].text) == (None, "", "clean 12")
    for old in (card, phone, mail, "10.1.2.3", "2001-02-03"):
        assert old not in got[1].text
    assert "999.1.1.1 4111111111111112" in got[1].text          # not valid, so kept
    digits = [int(c) for c in re.match(r"[\d ]+", got[1].text)[0] if c != " "]
    luhn = sum(d if i % 2 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits))
    assert len(digits) == 16 and luhn % 10 == 0


def test_numbers_next_to_short_numbers_and_words(spark):
    card, amex, iban = "4111 1111 1111 1111", "3782 822463 10005", "BE68 5390 0754 7034"
    cases = [(card, "", " 123"), (card, "", " 12/27"), (card, "", " 2 items"), (card, "", "-2 x"),
             (card, "12 ", ""), (amex, "", " 1234"), ("4111111111111111", "", " 123"),
             (iban, "", " IN"), (iban, "", " EURO CASH"), ("BE68539007547034", "", " OR 5")]
    df = spark.createDataFrame([(i, f"pay {a}{x}{b}.") for i, (x, a, b) in enumerate(cases)]
                               + [(90, f"pay {card} 3/2/2001."), (91, "pay 4111 1111 1111 1112 123.")],
                               "doc_id int, text string")
    got = {r.doc_id: r for r in pii.pseudonymise(df, pii.DEMO_KEY).collect()}
    alone = {r.text: r.new for r in spark.createDataFrame([(x,) for x, _, _ in cases], "text string")
             .select("text", pii.pseudonym(F.col("text"), F.lit(pii.DEMO_KEY)).alias("new")).collect()}
    for i, (x, a, b) in enumerate(cases):
        assert alone[x] != x and got[i].text == f"pay {a}{alone[x]}{b}." and got[i].n_replaced == 1
    assert got[90].n_replaced == 2 and "3/2/2001" not in got[90].text
    assert got[91].n_replaced == 0


def test_dates_of_a_century_keep_apart(spark):
    days = spark.range(36_525).select(F.date_add(F.lit("1950-01-01").cast("date"),
                                                 F.col("id").cast("int")).alias("d"))
    late = F.dayofmonth("d") > 12
    rows = (days.select(F.date_format("d", "dd/MM/yyyy").alias("text"))
            .unionByName(days.where(late).select(F.date_format("d", "MM/dd/yyyy").alias("text")))
            .unionByName(days.select(F.date_format("d", "yyyy-MM-dd").alias("text")))
            .unionByName(days.where(late).select(F.date_format("d", "M.d.yyyy").alias("text"))
                         .where("length(text) < 10")))
    out = pii.pseudonymise(rows.select("text", F.col("text").alias("was")), "any key").collect()
    assert all(r.n_replaced == 1 for r in out)
    dotted = [r for r in out if "." in r.was]
    whole = [r for r in out if "." not in r.was]
    for part in (dotted, whole):
        assert len({r.text for r in part}) == len({r.was for r in part}) == len(part)
    for r in out:
        if "/" in r.was and int(r.was[3:5]) > 12:
            assert int(r.text[3:5]) > 12 and 1900 <= int(r.text[6:]) <= 2099
    assert len({r.text for r in pii.pseudonymise(rows.limit(50), "one").collect()}
               & {r.text for r in pii.pseudonymise(rows.limit(50), "other").collect()}) < 25


def test_feistel_is_a_permutation(spark):
    pairs = spark.range(17 * 23).select(F.floor(F.col("id") / 23).alias("l"), (F.col("id") % 23).alias("r"))
    f = pii.feistel(F.col("l"), F.col("r"), F.lit(17), F.lit(23), F.lit("key"), "t")
    got = {(r.f.l, r.f.r) for r in pairs.select(f.alias("f")).collect()}
    assert len(got) == 17 * 23 and max(got)[0] < 17 and max(b for _, b in got) < 23


# ------------------------------------------------------------- 5 n-gram join

@pytest.mark.parametrize("many,step", [(3, 80), (40, 10), (200, 7)])
def test_pivots_cut_regions_and_keep_links(many, step):
    """Sets that drift away from each other: many regions, every link in one."""
    sets = [np.arange(i * step, i * step + 100, dtype=np.int64) for i in range(many)]
    home = np.arange(many) % 5 != 4
    regions = list(jaccard.voronoi(sets, home, 0.2, np.full(many, 100)))
    assert len(regions) > 1
    owners = np.concatenate([at[own] for at, own in regions])
    assert sorted(owners) == np.flatnonzero(home).tolist()
    seen = {(a, b) for at, own in regions for a in at[own] for b in at}
    for a in np.flatnonzero(home):
        for b in range(many):
            both = max(0, 100 - abs(int(a) - b) * step)
            if 100 * both >= 80 * (200 - both):
                assert (a, b) in seen
    assert many == 3 or len(seen) < many * many / 2


def brute_jaccard(rows, k, num, den):
    sets = []
    for d, t in rows:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
        w = re.findall(r"[^\x20\x09-\x0D]+", low)
        sets.append(frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))) if w
                    else frozenset())
    root, links = list(range(len(rows))), Counter()

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and den * both >= num * len(sets[i] | sets[j]):
                links[i] += 1
                links[j] += 1
                root[top(i)] = top(j)
    ids = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        ids[top(i)].append(d)
    least = {r: min((d for d in v if d is not None), default=None) for r, v in ids.items()}
    return sorted((d if d is not None else -1, len(sets[i]),
                   -1 if least[top(i)] is None else least[top(i)], links[i])
                  for i, (d, _) in enumerate(rows))


@pytest.mark.parametrize("num,region", [(90, 1500), (60, 4)])
def test_jaccard_against_brute_force(spark, docs, odd, num, region):
    base = docs.orderBy("doc_id").first().text.split()
    near = [(1000 + i, " ".join(base[:40 + i // 2] + [f"w{i}"])) for i in range(24)]
    df = docs.unionByName(odd.select("doc_id", "text")).unionByName(
        spark.createDataFrame(near, "doc_id long, text string"))
    got = jaccard.jaccard_components(df, k=3, num=num, den=100, region_rows=region).collect()
    want = brute_jaccard([tuple(r) for r in df.collect()], 3, num, 100)
    assert sorted(tuple(-1 if x is None else x for x in r) for r in got) == want


def test_linked_sets_of_any_size_bands_share_keys():
    t = jaccard.Threshold(60, 100)
    s = jaccard.mix(np.arange(1, 401, dtype=np.uint64))
    for small, large in ((30, 39), (26, 39), (18, 28), (60, 100), (200, 333)):
        a, b = (set(jaccard.slice_keys(np.sort(s[:n]), t, {}).tolist()) for n in (small, large))
        assert len(a & b) >= jaccard.SHARED
    assert [len(jaccard.slice_keys(np.sort(s[:n]), jaccard.Threshold(80, 100), {})) > 0
            for n in (1, 30)] == [False, True]


def test_links_of_a_group_joined_block_by_block(spark):
    # 24 sets, all linked, and a window row that has its home elsewhere
    rows = [(1, i < 24, i, 1 + i % 2, [*range(100), 1000 + i]) for i in range(25)]
    cells = spark.createDataFrame(rows, "cell long, home boolean, name long, copies long, set array<long>")
    sizes = spark.createDataFrame([(1, 25)], "cell long, rows long")
    regions = jaccard._blocks(cells, sizes, 4).withColumnRenamed("cell", "region")
    got = (jaccard._joined(regions, jaccard.Threshold(90, 100)).groupBy("name")
           .agg(F.sum("links").alias("links")).collect())
    copies = {r[2]: r[3] for r in rows}
    want = {i: sum(copies.values()) - copies[i] for i in range(24)}
    assert {r["name"]: r.links for r in got if r["name"] < 24} == want


def test_one_of_each_group_stays(odd, none):
    got = sorted((r.doc_id or -1, r.text or "") for r in jaccard.without_near_copies(odd).collect())
    assert got == sorted((i or -1, t or "") for i, t in ODD if i != 2)
    assert jaccard.without_near_copies(none).count() == 0


def test_pseudonyms_are_native(spark):
    plan = pii.op4_feistel_pseudonyms(spark, SMOKE)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "ExistingRDD"))


# -------------------------------------------------------------- 6 neighbours

def test_neighbours_recall(spark):
    rows = read(spark, SMOKE, "embeddings").select("vec_id", "embedding")
    bad = spark.createDataFrame([(9001, None), (9002, [0.0] * 64), (9003, [float("nan")] * 64),
                                 (9004, [None] * 64), (9100, [1.0, 2.0])],
                                "vec_id long, embedding array<float>")
    got = neighbours.nearest_neighbours(rows.unionByName(bad), F.col("id") % 100 == 0).collect()
    x = {r.vec_id: np.array(r.embedding, float) for r in rows.collect()}
    found, right = defaultdict(dict), 0
    for r in got:
        found[r.query_id][r["rank"]] = (r.score, r.vec_id)
    for q, best in found.items():
        d = sorted((float(np.sqrt(((v - x[q]) ** 2).sum())), i) for i, v in x.items() if i != q)[:10]
        assert [best[i] for i in sorted(best)] == sorted(best.values()) and len(best) == 10
        right += len({i for _, i in d} & {i for _, i in best.values()})
    assert right >= 0.9 * 10 * len(found) and set(found) == {i for i in x if i % 100 == 0}


def test_neighbours_among_equal_vectors():
    rng = np.random.default_rng(0)
    lines = np.random.default_rng(3).standard_normal((64, neighbours.PROJECTIONS))
    for n, scale in ((2, 1.0), (5, 1.0), (50, 1e-200), (400, 1.0), (5, 1e306)):
        q = rng.standard_normal(64) * scale
        with np.errstate(all="ignore"):
            rows, dist = neighbours.Block(np.arange(n), list(range(n)), np.tile(q, (n, 1)),
                                          lines).nearest(0, q, q @ lines, 10)
        assert len(rows) >= min(n - 1, 10) and 0 not in rows and not dist.any()


# -------------------------------------------------------------------- 7 WARC

def test_archives_round_trip(spark):
    big = "<p>" + "long page " * 40
    rows = [(5, "http://WWW.Example.com/b?q=1", big), (3, "http://example.com/a", big),
            (9, None, big), (4, "http://x.org/", None), (6, "http://x.org/", "short"),
            (7, "http://x.org/", "short"), (8, "not a url\r\n", "é" * 60)]
    got = warc.archive_round_trip(spark.createDataFrame(
        rows, "page_id long, url string, html string")).collect()
    want = {}
    for i, _, h in rows:
        data = (h or "").encode()
        revisit = h == big and i != 3
        want[i] = (len(data), hashlib.sha256(data).hexdigest(),
                   "revisit" if revisit else "response", 3 if revisit else None)
    assert {r.page_id: tuple(r)[1:] for r in got} == want


def test_archives_of_repeated_ids(spark):
    rows = [(1, "A" * 200), (1, "B" * 200), (2, "A" * 200), (3, "B" * 200), (3, "B" * 200), (4, None),
            (1, "A" * 200)]
    pages = spark.createDataFrame([(i, "http://x.org/", h) for i, h in rows],
                                  "page_id long, url string, html string")
    got = warc.archive_round_trip(pages).collect()
    assert sorted((r.page_id, r.payload_digest) for r in got) == sorted(
        (i, hashlib.sha256((h or "").encode()).hexdigest()) for i, h in rows)
    kinds = Counter(r.record_type for r in got)
    # copies that share the smallest id are responses both
    assert kinds["response"] == 4 and all(r.refers_to == 1 for r in got if r.record_type == "revisit")
    assert all(r.payload_bytes == (200 if r.page_id != 4 else 0) for r in got)
    assert warc.archive_round_trip(pages.where("page_id > 9")).count() == 0


def test_url_keys():
    assert warc.url_key("https://WWW.Example.com/a?b=1#c") == "com,example,www)/a?b=1"
    assert warc.url_key(None) == ")" and " " not in warc.url_key("no url at all")


# ----------------------------------------------------------------- 8 packing


def test_packing_tasks_give_memory_back(spark, monkeypatch):
    """After a batch its words' memory is with the system again, not with the worker."""
    import gc

    import pyarrow as pa
    from wavepanel.llm.common import give_back

    def held():
        text = open("/proc/self/smaps_rollup").read()
        return sum(map(int, re.findall(r"\nPss_Anon:\s+(\d+)", text))) / 1024

    df = spark.createDataFrame([(0, "a")], "doc_id long, text string")
    monkeypatch.setattr(type(df), "mapInArrow", lambda self, f, kinds: f)
    cut = packing.token_pieces(df, public_tokenizers.path("word_bpe_49k.json"))
    letters = np.random.default_rng(3).integers(97, 123, (60_000, 8), np.uint8)
    texts = [" ".join(bytes(w).decode() for w in letters[i:i + 200]) for i in range(0, 60_000, 200)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)],
                                       names=["doc_id", "text"])
    tasks = cut(iter([batch, batch.slice(0, 1), batch.slice(0, 0)]))
    assert [b.num_rows for b in tasks][1:] == [1, 0]
    gc.collect()
    before = held()
    give_back()
    assert before - held() < 15


def test_packed_pieces(spark, docs, odd):
    path = public_tokenizers.path("word_bpe_49k.json")
    tok = Tokenizer.from_file(path)
    df = docs.unionByName(odd.where("doc_id is null or doc_id != 2").select("doc_id", "text"))
    df = df.where("doc_id is null or doc_id > 7").unionByName(odd.where(
        "doc_id is not null and doc_id != 2").select("doc_id", "text"))
    ids = {r.doc_id: tok.encode(r.text or "", add_special_tokens=False).ids + [1] for r in df.collect()}
    got = packing.pack_texts(df, path, capacity=512).collect()
    fill = defaultdict(list)
    for r in got:
        part = ids[r.doc_id][r.start:r.start + r.length]
        assert zlib.crc32(np.array(part, "<u4").tobytes()) == r.ids_crc32 and len(part) == r.length
        fill[r.sequence_id].append((r.offset, r.length))
    for places in fill.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 512
    total = sum(map(len, ids.values()))
    # the total alone bounds the bins from below; few pieces are small at this capacity
    assert sum(r.length for r in got) == total and len(fill) <= 1.02 * total / 512 + 1


def test_local_search_empties_a_bin():
    bins = [[(6, 0), (2, 1)], [(5, 2), (3, 3)], [(2, 4), (2, 5)]]
    out = packing.local_search(bins, 10)
    assert len(out) == 2 and sorted(x for b in out for x in b) == sorted(x for b in bins for x in b)
    assert all(sum(s for s, _ in b) <= 10 for b in out)


def test_local_search_tries_every_underfull_bin(monkeypatch):
    rng = np.random.default_rng(4)
    for n, most, block in ((600, 0.97, 256), (900, 0.99, 64)):
        monkeypatch.setattr(packing, "SEARCH_BINS", block)
        sizes = np.sort(rng.integers(900, 1700, n))[::-1]
        placed = packing.best_fit(sizes.tolist(), 4096)
        of, offset, fill = packing.pack_group(sizes, 4096)
        assert of.max() + 1 <= most * (max(placed) + 1)
        assert np.bincount(of, sizes).max() <= 4096 and (offset + sizes <= fill).all()
        assert sorted(zip(of, offset)) == sorted(set(zip(of, offset)))


# --------------------------------------------------------- 9 decontamination

def test_leaks_and_paraphrases(spark, docs):
    bench = read(spark, SMOKE, "benchmark")
    item = bench.orderBy("item_id").first()
    words = item.text.split()
    para = " ".join(w for i, w in enumerate(words) if i % 9)
    clean = "entirely other words that no benchmark item holds " * 5
    extra = [(5001, clean + item.text + clean), (5002, clean + para), (5003, clean),
             (5004, None), (5005, ""), (5006, item.text.upper())]
    df = docs.unionByName(spark.createDataFrame(extra, "doc_id long, text string"))
    got = {r.doc_id: {x["item"] for x in r.leaks} for r in decontamination.find_leaks(df, bench).collect()}
    assert item.item_id in got[5001] & got[5002] & got[5006]
    assert not got[5003] and not got[5004] and not got[5005]
    flat = {r.item_id: " ".join(r.text.split()) for r in bench.collect()}
    for r in docs.collect():
        assert {i for i, t in flat.items() if t in " ".join(r.text.split())} <= got[r.doc_id]
    assert not any(r.leaked for r in decontamination.find_leaks(df, bench.where("false")).collect())


def test_short_items_are_found_word_for_word(spark):
    bench = spark.createDataFrame([(1, "What is the capital of Peru Lima"), (2, "two words"),
                                   (3, None), (4, "..."), (5, "the capital of")],
                                  "item_id long, text string")
    docs = spark.createDataFrame([
        (1, "so: what is the CAPITAL of Peru? Lima!"), (2, "what is the capital of Lima Peru"),
        (3, "Two, words two words"), (4, "two other words"), (5, None)], "doc_id long, text string")
    got = {r.doc_id: [(x["item"], x["cover"], x.word) for x in r.leaks]
           for r in decontamination.find_leaks(docs, bench).collect()}
    assert sorted(got[1]) == [(1, 1.0, 1), (5, 1.0, 3)] and got[2] == [(5, 1.0, 2)]
    assert got[3] == [(2, 1.0, 0)] and got[4] == [] and got[5] == []


def test_items_passed_over_are_no_leaks(monkeypatch):
    rng = np.random.default_rng(6)
    common = rng.integers(1, 1 << 62, 40).astype(np.uint64)
    items = [(i, rng.choice(common, n).tolist(), rng.choice(common, 4).tolist())
             for i, n in enumerate((9, 20, 36, 36, 70, 150))]
    weight = np.zeros(decontamination.BUCKETS, np.float32)
    weight[decontamination.buckets_of(common)] = 1
    live = np.flatnonzero(weight)
    search = decontamination.Searcher(items, weight, live, np.eye(len(live)))
    monkeypatch.setattr(decontamination, "COSINE", -2.0)         # every window is a candidate
    for n in (3, 30, 64, 65, 400, 90_000):
        h = rng.choice(np.concatenate((common, rng.integers(1, 1 << 62, 30).astype(np.uint64))), n)
        for k, (_, w, a) in enumerate(items):
            at = n * k // 6
            if n > 300:
                h[at:at + len(w)] = w[:n - at]
        want = {}
        for start in range(0, max(1, n - decontamination.STRIDE), decontamination.STRIDE):
            for i in range(len(items)):
                if want.get(i, (0.0, 0))[0] < decontamination.SURE and n < 1_000:
                    cover = search.check(i, h, start)
                    if cover > want.get(i, (0.0, 0))[0]:
                        want[i] = (cover, start)
        got = search.find(h)
        assert got == want if n < 1_000 else set(got) == set(range(6))


def test_an_item_in_a_third_of_the_documents(spark):
    items = read(spark, SMOKE, "benchmark").orderBy("item_id").limit(11).collect()
    clean = "entirely other words that no benchmark item holds " * 5
    many = 30
    rows = [(i, f"{clean} {i} {clean}") for i in range(2 * many)]
    rows += [(10_000 + i, f"{clean} {i} {items[0].text} {clean}") for i in range(many)]
    rows += [(20_000 + i, clean + x.text + clean) for i, x in enumerate(items)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame(items)
    got = {r.doc_id: {x["item"] for x in r.leaks}
           for r in decontamination.find_leaks(df, bench).collect()}
    assert all(items[0].item_id in got[10_000 + i] for i in range(many))
    assert all(x.item_id in got[20_000 + i] for i, x in enumerate(items))


# --------------------------------------------------------------- 10 quality

def test_sample_is_bounded_at_any_size(spark):
    rows = spark.range(3000).select(F.when(F.col("id") % 3 == 0, "hot")
                                    .otherwise(F.col("id").cast("string")).alias("t"))
    for rows_, total in ((200, 3000), (5000, 3000)):
        got = [r.t for r in quality._sample(rows, ["t"], rows_, total).collect()]
        assert min(0.5 * rows_, 2001) <= len(got) == len(set(got)) <= rows_
        assert got == [r.t for r in quality._sample(rows.repartition(5), ["t"], rows_, total).collect()]
    # a share of two in a billion is none of a millionth's grid
    plan = quality._sample(rows, ["t"], 4_000, 2_000_000_000_000)._jdf.queryExecution().toString()
    assert "2.6E-9" in plan


def test_quality_on_held_labels(spark, odd, none):
    sf = "/root/testdata/sf0.01"
    labels = read(spark, sf, "labels")
    fit, held = labels.where("doc_id % 2 = 0"), labels.where("doc_id % 2 = 1")
    got = quality.classify(read(spark, sf, "documents").select("doc_id", "text"), fit)
    truth = held.select("doc_id", ((F.col("quality") == 1) & (F.col("toxic") == 0)).alias("fine"))
    rows = got.join(truth, "doc_id").collect()
    assert sum(r.keep == r.fine for r in rows) >= 0.93 * len(rows)
    few = {(r.doc_id, r.text): r for r in quality.classify(odd, labels.where("false")).collect()}
    assert not few[3, None].keep and not few[4, ""].keep and few[3, None].quality == 0
    assert quality.classify(none, labels).count() == 0
    assert quality.classify(odd.where("doc_id > 99"), labels).count() == 0
    assert quality.classify(none).count() == 0
