"""Repeated windows against brute force."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from addrlink.llm import substring
from addrlink.llm.tokens import Words, slices


def plain(docs, window):
    at = {}
    split = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in docs]
    for d, w in enumerate(split):
        for s in range(len(w) - window + 1):
            at.setdefault(tuple(w[s : s + window]), []).append((d, s))
    cut = [[False] * len(w) for w in split]
    for places in at.values():
        if len(places) > 1:
            for d, s in places:
                cut[d][s : s + window] = [True] * window
    return sorted((str(i), len(w), sum(c), hashlib.sha256(" ".join(x for x, gone in zip(w, c, strict=True) if not gone).encode()).hexdigest()) for (i, _), w, c in zip(docs, split, cut, strict=True))


def check(spark, docs, window):
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, key string, f int").repartition(3)
    got = sorted((str(r[0]), *tuple(r)[1:]) for r in substring.dedup(df, window).collect())
    assert got == plain(docs, window)


def corpus(seed):
    rng = random.Random(seed)
    common = ["a", "b", "of", "the"]
    fresh = lambda n: [rng.choice(common) if rng.random() < 0.4 else f"w{rng.randint(0, 5000)}" for _ in range(n)]
    passages = [fresh(n) for n in (34, 35, 36, 50, 80, 200)]
    docs = []
    for _ in range(80):
        words = fresh(rng.randint(0, 60))
        for _ in range(rng.randint(0, 3)):
            p = list(rng.choice(passages))
            if rng.random() < 0.4:
                p[rng.randrange(len(p))] = "changed"
            a = rng.randint(0, 10)
            words += p[a:] + fresh(rng.randint(0, 5))
        docs.append(rng.choice([" ", "\n", "  "]).join(words))
    docs += [" ".join(["x"] * n) for n in (10, 35, 36, 90)] + [" ".join(["x", "y"] * 40), " ".join(["p", "q", "r"] * 15), None, "", docs[3], docs[4] + " é"]
    return list(enumerate(docs))


@pytest.mark.parametrize("seed", [1, 2])
def test_windows(spark, seed):
    check(spark, corpus(seed), 35)


def test_repeated_rows_null_ids_and_few_letters(spark):
    rng = random.Random(6)
    docs = [(i % 9, " ".join(rng.choice("ab") for _ in range(rng.choice([20, 60, 90])))) for i in range(60)]
    check(spark, [*docs, docs[0], docs[0], (None, "q " * 50), (None, None)], 35)


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert substring.dedup(df).count() == 0


@pytest.mark.parametrize("window", [1, 2, 10, 100])
def test_other_windows(spark, window):
    rng = random.Random(window)
    docs = corpus(4)[:50]
    check(spark, [*docs, (90, " ".join(["x"] * 250)), (91, " ".join(["x", "y"] * 90)), (92, " ".join(rng.choice("ab") for _ in range(400)))], window)


def test_very_long_text(spark):
    rng = random.Random(3)
    passage = [f"p{rng.random()}" for _ in range(60)]
    long = [rng.choice(["a", "b", f"u{rng.random()}"]) for _ in range(250_000)]
    long[1000:1060] = long[200_000:200_060] = passage
    check(spark, [(1, " ".join(long)), (2, " ".join(passage)), (3, "x " * 200_000), (4, "w" * 3_000_000)], 35)


def symbols(text, level):
    ((_, part),) = slices(pa.array([text]))
    return substring.parse(Words(part), level)[level]


@pytest.mark.parametrize("level", [1, 2, 3, 4])
def test_interior_symbols_are_the_same_in_every_context(level):
    rng = random.Random(8)
    ws = [rng.choice(["a", "a", "b", "c", f"u{rng.random()}"]) for _ in range(3000)]
    whole, part = symbols(" ".join(ws), level), symbols(" ".join(["q", *ws[100:400], "r", "s"]), level)
    inside = lambda x, shift: {(int(n), int(a) + shift, int(lo) + shift, int(hi) + shift) for n, a, lo, hi in zip(*x, strict=True) if lo + shift >= 100 and hi + shift <= 400}
    assert inside(whole, 0) == inside(part, 99) and len(inside(whole, 0)) > 10
    for x in (whole, part):
        assert (np.diff(x.low) >= 0).all() and (np.diff(x.high) >= 0).all() and (np.diff(x.at) > 0).all()


def test_runs_are_one_symbol():
    a, b, c = (symbols(f"x y {'a ' * n}z x", 1) for n in (30, 30, 31))
    assert len(a.at) <= 5 and a.name.tolist() == b.name.tolist() != c.name.tolist()
