"""The similarity join against brute force."""

import random
import re

import numpy as np
import pytest

from addrlink.llm import graph, jaccard, shingles


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def sets_of(t, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", lower(t))
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def plain(docs, k, percent):
    sets = [sets_of(t, k) for _, t in docs]
    root = list(range(len(docs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(docs)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    low = {}
    for n, (i, _) in enumerate(docs):
        if i is not None:
            low[find(n)] = min(i, low.get(find(n), i))
    return sorted((str(i), len(sets[n]), str(low.get(find(n)))) for n, (i, _) in enumerate(docs))


def corpus(seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + [f"rare{i}" for i in range(4000)]
    fresh = lambda n: [rng.choice(words) for _ in range(n)]
    docs = []
    for _ in range(25):
        base = fresh(rng.choice([1, 3, 4, 6, 9, 12, 20, 45, 100, 130, 400]))
        for _ in range(rng.choice([1, 2, 6])):
            w = list(base)
            for _ in range(rng.randint(0, max(1, len(w) // 25))):
                i = rng.randrange(len(w) + 1)
                w[i : i + rng.randint(0, 2)] = fresh(rng.randint(0, 2))
            docs.append(" ".join(w))
    drift = fresh(150)
    for _ in range(12):  # each near the one before, the ends far apart
        drift = list(drift)
        i = rng.randrange(len(drift))
        drift[i : i + 3] = fresh(3)
        docs.append(" ".join(drift))
    docs += [None, "", " \n", "a", "A", "a b c", "A b C", docs[0].upper(), " ".join(["x"] * 50), " ".join(["x", "y"] * 30)]
    rng.shuffle(docs)
    return list(enumerate(docs))


@pytest.mark.parametrize(("seed", "k", "percent"), [(1, 4, 85), (2, 5, 80)])
def test_components(spark, seed, k, percent):
    docs = corpus(seed)
    docs += [docs[5], (None, docs[6][1]), (7, "another text of the same id"), (None, None)]
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, n int, cls string").repartition(3)
    got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in jaccard.join(df, k, percent).collect())
    assert got == plain(docs, k, percent)


@pytest.mark.parametrize(("k", "percent"), [(4, 85), (5, 80), (3, 60)])
def test_short_texts_with_a_word_more(spark, k, percent):
    rng = random.Random(4)
    docs = []
    for n in range(1, 16):
        for _ in range(6):
            w = [f"w{rng.randrange(10**6)}" for _ in range(n)]
            docs += [" ".join(w), " ".join([*w, "more"]), " ".join(["more", *w])]
    docs = list(enumerate(docs))
    got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in jaccard.join(spark.createDataFrame(docs, "doc_id long, text string"), k, percent).collect())
    assert got == plain(docs, k, percent)


@pytest.mark.parametrize("percent", [60, 80, 85])
def test_keys_of_short_similar_sets_meet(percent):
    rng = np.random.default_rng(1)
    for n in list(range(shingles.least(percent), 12)) * 300:
        b = np.unique(rng.integers(0, 2**63, n + 1, dtype=np.uint64))
        a = np.delete(b, rng.integers(n + 1))
        ka, kb = (np.concatenate([x for _, x in shingles.keys(s, percent)]) for s in (a, b))
        assert len(np.intersect1d(ka, kb))


def test_one_of_each_component_stays(spark):
    docs = corpus(3)
    df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in docs] + [(3, docs[3][1], "en", "s", 0)], "doc_id long, text string, lang string, source string, n_chars long")
    kept = jaccard.keep_one(df)
    assert kept.columns == df.columns
    want = sorted({i for i, n, c in plain(docs, 5, 80) if i == c})
    assert sorted(str(r.doc_id) for r in kept.collect()) == want


def test_rows_of_null_and_repeated_ids_go_one_by_one(spark):
    text = lambda x: " ".join(f"{x}{i}" for i in range(30))
    docs = [(1, text("a")), (2, text("a")), (2, text("b")), (None, text("a")), (None, text("c")), (None, text("c")), (None, text("c") + " more"), (None, text("d")), (-1, text("e")), (-2, text("e")), (5, text("f")), (5, text("f")), (5, text("f") + " more"), (None, None), (None, "")]
    kept = jaccard.keep_one(spark.createDataFrame(docs, "doc_id long, text string").repartition(3)).collect()
    got = sorted((str(r.doc_id), str(r.text)) for r in kept)
    want = [(1, text("a")), (2, text("b")), (None, text("c")), (None, text("d")), (-2, text("e")), (5, text("f")), (None, None), (None, "")]
    assert got == sorted((str(i), str(t)) for i, t in want)


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert jaccard.join(df).count() == 0 and jaccard.keep_one(df).count() == 0


def test_blocks_of_large_buckets(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 3)
    docs = corpus(5)
    df = spark.createDataFrame([(i, t) for i, t in docs], "doc_id long, text string")
    got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in jaccard.join(df).collect())
    assert got == plain(docs, 4, 85)


def test_families_are_not_tied_together(spark, monkeypatch, tmp_path):
    """Texts that share a passage with the next one only: each is searched against its neighbours, not the whole chain."""
    rng = random.Random(8)
    words = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    passages = [words(84) for _ in range(121)]
    docs = [(i, " ".join([*passages[i], *passages[i + 1]])) for i in range(120)]
    docs += [(200 + i, f"{docs[i][1]} and more") for i in range(0, 120, 10)]
    search, log = jaccard._search, tmp_path / "rows"

    def counted(percent):
        def run(batches):
            held = list(batches)
            with open(log, "a") as f:
                f.write("".join(f"{b.num_rows}\n" for b in held))
            return search(percent)(iter(held))

        return run

    monkeypatch.setattr(jaccard, "_search", counted)
    monkeypatch.setattr(jaccard, "BLOCK", 3)
    got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in jaccard.join(spark.createDataFrame(docs, "doc_id long, text string")).collect())
    assert got == plain(docs, 4, 85)
    assert sum(map(int, log.read_text().split() if log.exists() else [])) <= len(docs)


@pytest.mark.parametrize("percent", [60, 80, 85])
def test_rarest_key_of_similar_sets_is_kept_by_both(percent):
    rng, left_out = np.random.default_rng(2), 0
    for n in list(range(shingles.least(percent), 40)) * 8 + [100, 170, 230, 400, 900] * 10:
        a = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
        b = np.unique(np.r_[a[: n - rng.integers(0, n // 10 + 1)], rng.integers(0, 2**63, rng.integers(0, n // 10 + 1), dtype=np.uint64)])
        same = len(np.intersect1d(a, b))
        if 100 * same < percent * (len(a) + len(b) - same):
            continue
        held = {int(x): rng.integers(1, 9) for s in (a, b) for _, ks, _ in shingles.keyed(s, percent) for x in ks}
        kept = []
        for s in (a, b):
            kept.append({int(x) for _, ks, spare in shingles.keyed(s, percent) for x in sorted(ks, key=lambda x: (-held[int(x)], int(x)))[spare:]})
            left_out += sum(spare for _, _, spare in shingles.keyed(s, percent))
        assert kept[0] & kept[1]
    assert left_out


def test_keys_travel_in_few_bytes():
    """A key takes 4 bytes, and the entry of its set in a bucket 18."""
    import pyarrow as pa

    rng = random.Random(6)
    texts = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(300)) for _ in range(100)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(100)), pa.array(texts), pa.array(range(100))], names=["doc_id", "text", "row"])
    keys = sum(len(x) for s in shingles.sets(jaccard.Words(pa.array(texts, pa.large_string()), lower=True), 4) for _, x in shingles.keys(s, 85))
    raws = [r for b in jaccard._describe(4, 85, 30, True)(iter([batch])) for r in b.column(1).to_pylist()]
    assert sum(map(len, raws)) - 48 * len(raws) <= 12 * keys


def test_keys_of_similar_sets_meet():
    rng = np.random.default_rng(0)
    for _ in range(3000):
        n = int(rng.integers(7, 300))
        a = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
        b = a[rng.random(len(a)) > rng.random() * 0.15]
        b = np.unique(np.r_[b, rng.integers(0, 2**63, int(rng.integers(0, n // 10 + 1)), dtype=np.uint64)])
        same = len(np.intersect1d(a, b))
        if len(b) >= 7 and 100 * same >= 85 * (len(a) + len(b) - same) and len(a) + len(b) - 2 * same:
            ka, kb = (np.concatenate([x for _, x in shingles.keys(s, 85)]) for s in (a, b))
            assert len(np.intersect1d(ka, kb))


def test_tree_finds_all_pairs():
    rng = np.random.default_rng(1)
    v = rng.poisson(4, (300, 40)).astype(np.uint16)
    v[200:] = v[:100] + (rng.random((100, 40)) < 0.05)
    size = v.sum(1).astype(np.int64)
    tree = jaccard.Tree(v, size)
    got = {(int(x), int(y)) for a, b in tree.join(tree, 85) for x, y in zip(a, b, strict=True)}
    over = np.minimum(v[:, None], v[None]).sum(2)
    assert got == {(int(x), int(y)) for x, y in zip(*np.nonzero(over >= jaccard.needed(size[:, None], size[None], 85)), strict=True)}


def test_graph(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (200, 150), (150, 175)]
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), 100: 100, 101: 100, 200: 150, 150: 150, 175: 150}


def test_search_gives_fewer_links_than_components(spark, monkeypatch):
    """A large group that shares many families: the search lists links that connect components, not pairs."""
    rng = random.Random(12)
    base = [f"w{i}" for i in range(200)]
    docs = []
    for _ in range(160):
        w = list(base)
        for _ in range(rng.randint(1, 3)):
            w[rng.randrange(len(w))] = f"r{rng.randrange(10**6)}"
        docs.append(" ".join(w))
    docs = list(enumerate(docs))
    given, kept = [], jaccard.materialize

    def counted(df, name, *more):
        out = kept(df, name, *more)
        if name in ("survivors", "links"):
            given.append((name, out.count()))
        return out

    monkeypatch.setattr(jaccard, "materialize", counted)
    got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in jaccard.join(spark.createDataFrame(docs, "doc_id long, text string").repartition(3)).collect())
    assert got == plain(docs, 4, 85)
    assert len({c for _, _, c in got}) < len(docs) - 20
    assert len(given) == 2 and given[1][0] == "links"  # of the stars, of the search
    tasks = 8
    assert given[1][1] < tasks * len(docs) and all(n < tasks * len(docs) for _, n in given)


def test_small_tables_are_written_in_few_files(spark, monkeypatch):
    """Sets and links come from many tasks; on a local disk a file for each would start three processes each."""
    written, kept = [], jaccard.materialize

    def counted(df, name, *more, **also):
        out = kept(df, name, *more, **also)
        if name in ("sets", "likely", "links"):
            written.append((name, len(out.inputFiles())))
        return out

    monkeypatch.setattr(jaccard, "materialize", counted)
    docs = corpus(9)
    got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in jaccard.join(spark.createDataFrame(docs, "doc_id long, text string").repartition(24)).collect())
    assert got == plain(docs, 4, 85)
    assert [name for name, _ in written] == ["sets", "likely", "links", "links"]
    assert all(n <= 4 for _, n in written), written
