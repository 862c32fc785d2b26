"""The toxicity chain, and the pipeline against its stages done by brute force."""

import random
import re
import zlib

import public_tokenizers
import pytest

import corpus_pipeline
from addrlink.llm import pii, stages, toxicity
from tests.llm.test_jaccard import plain as plain_components
from tests.llm.test_text_ops import plain_contamination

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def test_toxicity(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(400)]
    bad, junk = ["vile", "rotten", "awful"], ["###", "%%"]
    docs, labels = [], []
    for i in range(600):
        w = [rng.choice(words) for _ in range(rng.randint(5, 60))]
        is_junk, toxic = rng.random() < 0.2, rng.random() < 0.25
        if is_junk:
            w = [x + rng.choice(junk) for x in w]
        if toxic:
            w += rng.sample(bad, 2)
        rng.shuffle(w)
        docs.append((i, " ".join(w), 9))
        if i < 400:
            labels.append((i, int(is_junk), int(toxic)))
    truth = {i: bool(set(re.findall("[a-z]+", t)) & set(bad)) for i, t, _ in docs}
    docs += [(1000, None, 0), (1001, "", 0), (None, "so vile and rotten", 0), (7, "vile rotten awful", 0)]
    df = spark.createDataFrame(docs, "doc_id long, text string, toxic int")
    lab = spark.createDataFrame([*labels, (1, None, 1), (None, 0, 1), labels[0]], "doc_id long, junk int, toxic int")
    rows = toxicity.classify(df, lab, ("junk", "toxic")).collect()
    assert len(rows) == len(docs) and all(0 <= r.p_junk <= 1 and r.toxic == (r.p_toxic > 0.5) for r in rows)
    held = [r for r in rows if r.doc_id is not None and 400 <= r.doc_id < 600]
    assert sum(r.toxic == truth[r.doc_id] for r in held) / len(held) > 0.97
    assert [r.toxic for r in rows if r.doc_id is None] == [True] and not any(r.toxic for r in rows if r.doc_id in (1000, 1001))
    none = toxicity.classify(df, lab.limit(0), ("junk", "toxic")).collect()
    assert {(r.p_junk, r.toxic) for r in none} == {(0.5, False)}
    assert toxicity.classify(df.limit(0), lab, ("junk", "toxic")).count() == 0


def test_chain_uses_earlier_categories():
    import numpy as np

    rng = np.random.default_rng(0)
    n = 900
    first = (rng.random(n) < 0.5).astype(float)
    rows = np.flatnonzero(first)
    chain = toxicity.Chain(rows, np.full(len(rows), 5), np.c_[first, first], np.arange(n) % 3)
    assert chain.models[1].c[0] > 0.5


def corpus():
    rng = random.Random(11)
    parts = {"en": ["the", "ing", "and"], "fr": ["eau", "oi", "é"]}
    bench = [(i, " ".join(f"item{i}word{j}" for j in range(14))) for i in range(4)]
    docs = []
    for i in range(60):
        lang = rng.choice(["en", "fr"])
        w = ["".join(rng.choice(parts[lang]) for _ in range(4)) + str(rng.randint(0, 99)) for _ in range(rng.randint(8, 120))]
        if i % 9 == 0:
            w[3:3] = bench[i % 4][1].split()[1:13]
        if i % 7 == 0:
            w.insert(2, f"me{i}@mail.example.com")
        docs.append((i, " ".join(w), lang))
    docs += [(100 + i, docs[i][1] + (" extra" if i % 2 else ""), docs[i][2]) for i in range(20)]
    docs += [(200, None, "en"), (201, "", None), (202, "12 34 !!", "en"), (203, "mail a@b.cd", "en")]
    return [(i, t, lang, "s", len(t or "")) for i, t, lang in docs], bench


def test_pipeline(spark, tmp_path):
    docs, bench = corpus()
    spark.createDataFrame(docs, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    held = spark.read.parquet(f"{tmp_path}/documents.parquet")
    want = [d for d in docs if d[1] and any(c.isalpha() for c in d[1])]
    one = stages.language(spark, held, str(tmp_path))
    assert sorted(r.doc_id for r in one.collect()) == sorted(d[0] for d in want) and one.columns == held.columns
    tops = {(i, c) for i, _, c in plain_components([(d[0], d[1]) for d in want], 5, 80)}
    want = [d for d in want if (str(d[0]), str(d[0])) in tops]
    two = stages.near_duplicates(spark, one, str(tmp_path))
    assert sorted(r.doc_id for r in two.collect()) == sorted(d[0] for d in want) and two.columns == held.columns
    dirty = plain_contamination([(d[0], d[1]) for d in want], bench)
    want = [d for d in want if not dirty[d[0]][4]]
    three = stages.benchmarks(spark, two, str(tmp_path))
    assert sorted(r.doc_id for r in three.collect()) == sorted(d[0] for d in want) and three.columns == held.columns
    want = {d[0]: re.sub(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "<email>", d[1]) for d in want}
    four = stages.personal_data(spark, three, str(tmp_path))
    got = {r.doc_id: r for r in four.collect()}
    assert {i: r.text for i, r in got.items()} == want and all(r.n_chars == len(r.text) for r in got.values())
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    ids = {i: [*whole.encode(t, add_special_tokens=False).ids, 2] for i, t in want.items()}
    assert sum(r.length for r in rows) == sum(map(len, ids.values()))
    for r in rows:
        cut = ids[r.doc_id][r.start : r.start + r.length]
        assert len(cut) == r.length and r.doc_tokens == len(ids[r.doc_id]) and zlib.crc32(b"".join(x.to_bytes(4, "little") for x in cut)) == r.ids_crc32


def test_language_decides_what_is_packed_together(spark, tmp_path):
    """Wrong and missing labels become the predicted language, and no sequence mixes two."""
    rng = random.Random(5)
    parts = {"en": ["the", "ing", "and"], "fr": ["eau", "oi", "é"]}
    docs, truth = [], {}
    for i in range(200):
        lang = "en" if i % 2 else "fr"
        truth[i] = lang
        told = lang if i < 150 else None if i < 175 else "en"
        docs.append((i, " ".join("".join(rng.choice(parts[lang]) for _ in range(4)) for _ in range(60)), told, "s", 1))
    df = spark.createDataFrame(docs, DOCS).coalesce(1)
    one = stages.language(spark, df, str(tmp_path))
    got = {r.doc_id: r.lang for r in one.collect()}
    assert sum(got[i] == truth[i] for i in truth) >= 195
    held = {}
    for r in stages.sequences(spark, one, str(tmp_path)).collect():
        held.setdefault(r.sequence_id, set()).add(got[r.doc_id])
    assert len(held) > 1 and all(len(x) == 1 for x in held.values())


def test_stage_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "benchmarks", "personal_data", "packing"]


@pytest.mark.parametrize("n", [0])
def test_empty_stages(spark, n, tmp_path):
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.createDataFrame([], DOCS)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, str(tmp_path)).count() == n


def test_mask_keeps_other_columns(spark):
    df = spark.createDataFrame([(1, "a@b.cd x", "en", "s", 8), (2, None, None, None, None)], DOCS)
    rows = {r.doc_id: r for r in pii.mask(df).collect()}
    assert rows[1].text == "<email> x" and rows[1].n_chars == 9 and rows[2].text is None and rows[2].n_chars is None
