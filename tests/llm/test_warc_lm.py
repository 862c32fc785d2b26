"""WARC round trips and language-model scores against brute force."""

import base64
import glob
import gzip
import hashlib
import math
import random
import re
import zlib

import public_tokenizers
import pytest

from addrlink.llm import lattice, lmscore, warc

VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "x") for i, u, h in rows], "page_id long, url string, html string, digest string")


def want_records(rows):
    top = {}
    for i, _, h in rows:
        if i is not None:
            top[h or ""] = max(i, top.get(h or "", i))
    out, seen = [], set()
    for i, _, h in rows:
        raw = (h or "").encode()
        first = i is None or (i == top[h or ""] and (i, h or "") not in seen)
        seen.add((i, h or ""))
        out.append((i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "response" if first else "revisit", None if first else top[h or ""]))
    return out


def key(r):
    return tuple(str(x) for x in r)


def test_warc_round_trip(spark, tmp_path):
    rng = random.Random(1)
    bodies = [None, "", "a", "é\r\n\r\nWARC/1.1", "x" * 50000] + [f"<p>{i}</p>" * rng.randint(1, 50) for i in range(10)]
    rows = [(i, f"http://h/{i} %é\n", rng.choice(bodies)) for i in range(200)] + [(7, "u", "twice"), (7, "u", "twice"), (7, None, "other"), (None, "n", "a"), (500, None, None)]
    folder = f"file://{tmp_path}/w"
    manifest = warc.write(pages(spark, rows), folder, roll_bytes=2000, shards=3)
    got = [tuple(r) for r in warc.read(spark, folder).collect()]
    assert sorted(got, key=key) == sorted(want_records(rows), key=key)
    files = sorted(glob.glob(f"{tmp_path}/w/*.warc.gz"))
    assert len(files) == manifest.count() > 3 and not glob.glob(f"{tmp_path}/w/*.tmp")
    assert {hashlib.sha256(open(f, "rb").read()).hexdigest() for f in files} == {r.sha256 for r in manifest.collect()}
    assert sum(gzip.decompress(open(f, "rb").read()).count(b"WARC-Record-ID") for f in files) == len(rows)
    whole = {r.page_id: (r.url, r.payload) for r in warc.read(spark, folder, with_payload=True).collect() if r.record_type == "response" and r.page_id not in (7, None)}
    assert all((u or "", h or "") == whole[i] for i, u, h in rows if i in whole)
    again = f"file://{tmp_path}/again"
    warc.write(pages(spark, rows[::-1]), again, roll_bytes=2000, shards=3)
    assert sorted(hashlib.sha256(open(f, "rb").read()).hexdigest() for f in glob.glob(f"{tmp_path}/again/*.gz")) == sorted(hashlib.sha256(open(f, "rb").read()).hexdigest() for f in files)


def test_warc_empty_and_damaged(spark, tmp_path):
    warc.write(pages(spark, []), f"file://{tmp_path}/e")
    assert warc.read(spark, f"file://{tmp_path}/e").count() == 0
    warc.write(pages(spark, [(1, "u", "body")]), f"file://{tmp_path}/d", level=0)
    (name,) = glob.glob(f"{tmp_path}/d/*.gz")
    raw = gzip.decompress(open(name, "rb").read()).replace(b"body", b"bodi")
    open(name, "wb").write(gzip.compress(raw))
    with pytest.raises(Exception, match="digest"):
        warc.read(spark, f"file://{tmp_path}/d").collect()


def plain_word(word, logp, voc):
    raw = b" " + word.encode()
    weight = {p: w for p, w in zip(voc.pieces, logp, strict=True)}
    alpha = [0.0] + [-math.inf] * len(raw)
    for i in range(len(raw)):
        for k in range(i + 1, min(len(raw), i + 30) + 1):
            if raw[i:k] in weight:
                a, b = alpha[k], alpha[i] + weight[raw[i:k]]
                hi, lo = max(a, b), min(a, b)
                alpha[k] = hi + math.log1p(math.exp(lo - hi)) if lo > -math.inf else hi
    return alpha[-1] / math.log(10)


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def test_scores(spark):
    rng = random.Random(4)
    vocabulary = ["the", "The", "naïve", "中文", "end", "token" * 20, "a", "b\x0bc", "Zz,"]
    docs = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([0, 1, 4, 30])))) for i in range(120)] + [(120, None), (121, ""), (5, "the the"), (None, "the new"), (130, "q" * 3000)]
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, run int, bucket string").repartition(3)
    got = sorted((tuple(r) for r in lmscore.score(df, VOCABULARY).collect()), key=key)
    split = {n: re.findall(r"[^\x20\x09-\x0D]+", lower(t)) for n, (_, t) in enumerate(docs)}
    held = {n: zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0 for n, (i, _) in enumerate(docs)}
    c, ends = {}, 0
    for n in split:
        if not held[n]:
            ends += 1
            for w in split[n]:
                c[w] = c.get(w, 0) + 1
    total, types = sum(c.values()) + ends, len(c) + 1
    voc = lattice.vocabulary(VOCABULARY)
    weights, end = lmscore.learn(df.withColumn("held_out", lmscore.remainder(10) == 0), VOCABULARY)
    want = []
    for n, (i, _) in enumerate(docs):
        counts = [c.get(w, 0) for w in split[n]] + [ends]
        base = sum(math.log10((x + 0.1) / (total + 0.1 * (types + 1))) for x in counts)
        model = sum(plain_word(w, weights, voc) for w in split[n]) + end / math.log(10)
        want.append((i, held[n], len(counts), sum(x > 0 for x in counts), total, base, model))
    want.sort(key=key)
    assert [r[:5] for r in got] == [w[:5] for w in want]
    for r, w in zip(got, want, strict=True):
        assert r[5] == pytest.approx(w[5], rel=1e-9) and r[6] == pytest.approx(w[6], rel=1e-9)
    assert abs(math.exp(end) + sum(math.exp(x) for x in weights) - 1) < 1e-9
    assert lmscore.score(df.limit(0), VOCABULARY).count() == 0


def test_expected_counts_add_up():
    import numpy as np
    import pyarrow as pa

    from addrlink.llm.tokens import Words, slices

    voc = lattice.vocabulary(VOCABULARY)
    ((_, part),) = slices(pa.array(["the theory of éclairs"]))
    words = Words(part, lower=True)
    counts = np.zeros(len(voc.pieces))
    for group, chars in voc.groups(words, np.arange(words.n)):
        voc.expected(chars, voc.first, np.ones(len(group)), counts)
    sizes = np.array([len(p) for p in voc.pieces])
    assert (counts * sizes).sum() == pytest.approx(sum(len(w.encode()) + 1 for w in "the theory of éclairs".split()))


def test_long_words_give_expected_counts(spark, monkeypatch):
    import numpy as np
    import pyarrow as pa

    from addrlink.llm.tokens import Words, slices

    voc = lattice.vocabulary(VOCABULARY)
    long = "theoryofunbrokenstringsé中文" * 90
    ((_, part),) = slices(pa.array([long]))
    ((_, chars),) = voc.groups(Words(part, lower=True), np.arange(1))
    assert chars.shape[1] > lmscore.LONGEST
    one, all_at_once = np.zeros(len(voc.pieces)), np.zeros(len(voc.pieces))
    voc.expected_long(chars[0], voc.first, 2.0, one)
    voc.expected(chars, voc.first, np.array([2.0]), all_at_once)
    assert one == pytest.approx(all_at_once, rel=1e-9, abs=1e-12)
    df = spark.createDataFrame([(1, long), (1, long)], "doc_id long, text string").selectExpr("*", "false AS held_out")
    weights, end = lmscore.learn(df, VOCABULARY)
    counts = np.exp(voc.first) * 100 + all_at_once
    assert np.exp(weights) * (counts.sum() + 3) == pytest.approx(counts, rel=1e-9)


def test_ids_far_apart(spark, tmp_path):
    ids = [-(2**63), -(2**62), -1, 0, 5, 2**62, 2**63 - 1]
    df = spark.createDataFrame([(i, "u", f"<p>{n % 3}</p>") for n, i in enumerate(ids)], "page_id long, url string, html string")
    warc.write(df, str(tmp_path / "far"))
    got = {r.page_id: r.refers_to for r in warc.read(spark, str(tmp_path / "far")).collect()}
    top = {n % 3: i for n, i in enumerate(ids)}
    assert got == {i: None if top[n % 3] == i else top[n % 3] for n, i in enumerate(ids)}
