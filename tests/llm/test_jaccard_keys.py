"""Keys of the Jaccard join: made for one shuffle, never written whole."""

from wavepanel.llm import jaccard


def test_keys_are_dealt_once_and_not_staged(spark, monkeypatch, capsys):
    words = [f"w{i}" for i in range(120)]
    texts = [" ".join(words), " ".join(words), " ".join(words[:-1] + ["x"]),
             " ".join(words[60:] + words[:60]), " ".join(f"v{i}" for i in range(120)),
             "one", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    staged, stage = {}, jaccard.stage

    def seen(df, name):
        df.explain()
        staged[name] = (df.schema.simpleString(), capsys.readouterr().out)
        return stage(df, name)

    monkeypatch.setattr(jaccard, "stage", seen)
    monkeypatch.setattr(jaccard, "BROADCAST_ROWS", 0)         # as with very many keys
    found = {r.doc_id: (r.component_id, r.n_links)
             for r in jaccard.jaccard_components(docs, num=80).collect()}
    sets = [set(zip(*[t.split()[i:] for i in range(3)])) if t and t != "one" else {t} - {None}
            for t in texts]
    links = {i: [j for j in range(len(sets)) if j != i and sets[i] and sets[j] and
                 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
             for i in range(len(sets))}
    assert {i: n for i, (_, n) in found.items()} == {i: len(x) for i, x in links.items()}
    assert [found[i][0] for i in range(7)] == [0, 0, 0, 0, 4, 5, 6]
    assert not [n for n, (kind, _) in staged.items() if "array" in kind and "set:" not in kind]
    assert sum(p.count("Exchange hashpartitioning(key") for n, (_, p) in staged.items()
               if n not in ("key-least", "edges")) == 1


def test_a_cell_that_pivots_do_not_cut_goes_into_blocks_once(spark, monkeypatch):
    words = [f"w{i}" for i in range(200)]
    texts = [" ".join(words[:i] + [f"x{i}"] + words[i + 1:]) for i in range(100)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows, joined = [], jaccard._joined

    def counted(regions, t):
        rows.append(regions.count())
        return joined(regions, t)

    monkeypatch.setattr(jaccard, "_joined", counted)
    monkeypatch.setattr(jaccard, "REGION_ROWS", 20)
    found = jaccard.jaccard_components(docs, num=80, region_rows=20).collect()
    assert {(r.component_id, r.n_links) for r in found} == {(0, 99)} and len(found) == 100
    assert rows[0] <= 100 * 2 * 10            # each of ten blocks meets every block
