"""PII, decontamination, packing and language ID against brute force."""

import hashlib
import random
import re
import zlib

import public_tokenizers
import pytest

from addrlink.llm import decontaminate, langid, packing, pii

DOCS = "doc_id long, text string, lang string, doc int, key string"
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_pii(text):
    def luhn(d):
        return sum(int(c) if i % 2 == 0 else (int(c) * 2 - 9 * (int(c) > 4)) for i, c in enumerate(reversed(d))) % 10 == 0

    def digits(s):
        return re.sub("[^0-9]", "", s)

    out = {
        "email": [m.span() for m in EMAIL.finditer(text)],
        "ip": [m.span() for m in IP.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))],
        "card": [m.span() for m in CARD.finditer(text) if 16 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))],
        "phone": [m.span() for m in PHONE.finditer(text) if 8 <= len(digits(m[0])) <= 15],
    }
    return out


def frame(spark, texts):
    return spark.createDataFrame([(i, t, None, 1, "k") for i, t in texts], DOCS)


def test_pii_parsers_agree_with_patterns():
    rng, parse = random.Random(3), pii.Parser()
    alphabet = "a1234567890.@+- ()%_é\n4" * 2
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 80))) for _ in range(20000)]
    texts += ["4111 1111 1111 1111", "x@y.z@w.v", "1.2.3.4.5.6.7.8.9", "+1 (017) 555-7713 a", "a@b.c-@d.e", "+12", "+1 2", "00255.1.1.1", "256.1.1.1"]
    for t in texts:
        got = parse(t)
        want = plain_pii(t)
        assert {k: got[k] for k in pii.BASE} == want, t


def test_pii_added_kinds_and_mask():
    t = 'see https://a.b/c?d token = "04dbebab91ab85687d33eeaa" IBAN GB82 WEST 1234 5698 7654 32.'
    got = pii.Parser()(t)
    assert [t[a:b] for a, b in got["url"]] == ["https://a.b/c?d"]
    assert [t[a:b] for a, b in got["secret"]] == ["04dbebab91ab85687d33eeaa"]
    assert [t[a:b] for a, b in got["account"]] == ["GB82 WEST 1234 5698 7654 32"]
    assert pii.masked("mail a@b.cd now", pii.Parser()("mail a@b.cd now")) == "mail <email> now"


def test_pii_rows(spark):
    rows = pii.find(frame(spark, [(1, None), (2, ""), (2, "a@b.cd 1.2.3.4"), (None, "x" * 300000 + "@y.zz")])).collect()
    by = {(r.doc_id, r.n_email) for r in rows}
    assert by == {(1, 0), (2, 0), (2, 1), (None, 1)}
    assert {r.base_sha256 for r in rows if r.n_email == 0} == {hashlib.sha256(b"").hexdigest()}
    assert [r.spans for r in rows if r.n_ip] == ["email:0:6,ip:7:14"]
    assert pii.find(frame(spark, [])).count() == 0
    assert pii.mask(frame(spark, [(1, "a@b.cd"), (2, None)])).columns == ["doc_id", "text", "lang", "doc", "key"]


def plain_contamination(docs, items, k=10):
    split = decontaminate.words
    out = {}
    wins = {}
    for i, t in items:
        w = split(t)
        for j in range(max(1, len(w) - k + 1)) if w else []:
            wins.setdefault(tuple(w[j : j + k]), set()).add(str(i))
    for d, t in docs:
        w, hit, found = split(t), set(), set()
        for size in {len(x) for x in wins}:
            for j in range(len(w) - size + 1):
                if (x := tuple(w[j : j + size])) in wins:
                    hit |= set(range(j, j + size))
                    found |= wins[x]
        out[d] = (len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit))
    return out


@pytest.mark.parametrize("block", [20_000_000, 300])
def test_contamination(spark, block):
    rng = random.Random(5)
    vocabulary = ["a", "b", "C", "é", "7"]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([0, 1, 3, 9, 10, 14])))) for i in range(12)] + [(12, None), (3, "b b, b a-a a a b 7 7 7 7")]
    docs = [(i, " ".join(rng.choice(vocabulary + ["zz", "q"]) for _ in range(rng.randint(0, 60)))) for i in range(60)]
    docs += [(100 + i, "zz; " + (items[i][1] or "").upper() + "! q") for i in range(12)] + [(200, None), (201, "")]
    want = plain_contamination(docs, items)
    bench = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, doc_id int")
    got = {r[0]: tuple(r)[1:] for r in decontaminate.decontaminate(frame(spark, docs), bench, block_chars=block).collect()}
    assert got == want
    assert all(r.n_hit == 0 for r in decontaminate.decontaminate(frame(spark, docs), bench.limit(0)).collect())
    assert decontaminate.decontaminate(frame(spark, []), bench).count() == 0


@pytest.mark.parametrize("block", [20_000_000, 40])
def test_drop_decides_by_row(spark, block):
    items = [(i, " ".join(f"item{i}word{j}" for j in range(12))) for i in range(4)]
    docs = [(None, items[0][1]), (None, "clean one"), (7, "x " + items[3][1]), (7, "clean two"), (8, items[1][1] + " y"), (9, None)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    kept = decontaminate.drop(frame(spark, docs), bench, block_chars=block)
    assert sorted((str(r.doc_id), str(r.text)) for r in kept.collect()) == [("7", "clean two"), ("9", "None"), ("None", "clean one")]
    assert kept.columns == frame(spark, docs).columns


def test_contamination_spans(spark):
    text = "Zz, Alpha  beta-GAMMA! delta e f g h i j k q"
    bench = spark.createDataFrame([(1, "alpha beta gamma delta e f g h i j k")], "item_id long, text string")
    row = decontaminate.decontaminate(frame(spark, [(1, text)]), bench, with_spans=True).first()
    a, b = map(int, row.spans.split(":"))
    assert text[a:b] == "Alpha  beta-GAMMA! delta e f g h i j k" and row.n_items == 1


def test_packing_round_trip(spark):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rng = random.Random(9)
    vocabulary = ["the", "It's", "naïve", "中文字", "x1y2", "<|endoftext|>", "!!", "don't,", "é", "İ"]
    docs = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([0, 1, 5, 40, 200])))) for i in range(80)] + [(80, None), (81, ""), (1, "again")]
    rows = packing.pack(frame(spark, docs), public_tokenizers.path("word_bpe_49k.json"), window=64, with_ids=True).collect()
    want = sorted((d, [*whole.encode(t or "", add_special_tokens=False).ids, 2]) for d, t in docs)
    left = {}
    for r in sorted(rows, key=lambda r: (r.doc_id, r.doc_tokens, r.start)):
        assert zlib.crc32(b"".join(i.to_bytes(4, "little") for i in r.ids)) == r.ids_crc32 and len(r.ids) == r.length
        left.setdefault((r.doc_id, r.doc_tokens), []).append(r)
    got = []
    for (d, n), pieces in left.items():
        ids = [i for r in pieces for i in r.ids]
        assert len(ids) == n
        got.append((d, ids))
    assert sorted(got) == want
    seq = {}
    for r in rows:
        seq.setdefault(r.sequence_id, []).append(r)
    for pieces in seq.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at == 64 or at & (at - 1) == 0
    assert packing.pack(frame(spark, []), public_tokenizers.path("word_bpe_49k.json")).count() == 0


def test_sum_of_squares_choice():
    import numpy as np

    p = packing.Packer(8)
    for n in (5, 5, 3):
        p.add(0, np.zeros(n, np.int32))
    assert len(p.closed) == 1 and p.level[5] == 1  # 3 fills one of the two windows at level 5


def test_language(spark):
    rng = random.Random(2)
    parts = {"en": ["the", "ing", "and", "wh"], "de": ["sch", "ung", "der", "ü"], "fr": ["eau", "oi", "é", "les"]}

    def text(k, n):
        return " ".join("".join(rng.choice(parts[k]) for _ in range(3)) for _ in range(n))

    docs = [(i, text(k := ("en", "de", "fr")[i % 3], rng.randint(2, 40)), k, 1, "k") for i in range(240)] + [(900, None, "en", 1, ""), (901, "12 34 !", None, 1, ""), (902, "", "de", 1, ""), (None, text("en", 9), None, 1, "")]
    df = spark.createDataFrame(docs, DOCS)
    rows = langid.identify(df).collect()
    assert len(rows) == len(docs)
    truth = {d[0]: d[2] for d in docs}
    for r in rows:
        assert r.held_out == (zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode()) % 3 == 1) and 0 <= r.score <= 1
    held = [r for r in rows if r.held_out and r.doc_id is not None and r.doc_id < 240]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) / len(held) > 0.95
    assert {r.lang_pred for r in rows if r.doc_id in (900, 901, 902)} == {"und"}
    assert langid.keep_known(df).count() == len(docs) - 3
    assert langid.identify(df.limit(0)).count() == 0
    assert {r.lang_pred for r in langid.identify(df.withColumn("lang", df.lang.substr(9, 1)).where("lang is null")).collect()} == {"und"}


def test_codewords_are_apart():
    for n in (2, 3, 4, 7, 12, 40):
        code = langid.codewords(n)
        assert all((code[i] != code[j]).any() for i in range(n) for j in range(i))


def test_decoding_by_brute_force():
    """The nearest codeword by weighted loss, bit by bit, for each text."""
    import math

    import numpy as np
    import pyarrow as pa

    from addrlink.llm.tokens import slices

    rng = random.Random(2)
    parts = {"en": ["the", "ing", "and"], "fr": ["eau", "oi", "les"], "de": ["sch", "ung", "ei"], "es": ["cion", "los", "que"]}
    made = [(k, " ".join("".join(rng.choice(v) for _ in range(3)) for _ in range(12))) for k, v in parts.items() for _ in range(25)]
    names = sorted(parts)
    ((_, part),) = slices(pa.array([t for _, t in made]))
    x = langid.features(part)
    model = langid.Model(names, x, np.array([names.index(k) for k, _ in made]))
    got, score, margin = model.predict(x)
    for i in range(len(made)):
        bits = [sum(float(a) * float(w) for a, w in zip([*x[i], 0.3], model.w[:, b], strict=True) if a) for b in range(model.code.shape[1])] if i % 10 == 0 else (np.r_[x[i], 0.3] @ model.w).tolist()
        loss = [sum(float(model.weight[k, b]) * math.log1p(math.exp(-model.code[k, b] * v)) for b, v in enumerate(bits)) for k in range(len(names))]
        order = sorted(range(len(names)), key=loss.__getitem__)
        assert names[got[i]] == made[i][0] and got[i] == order[0]
        assert abs(margin[i] - (loss[order[1]] - loss[order[0]])) < 1e-4
        assert abs(score[i] - 1 / sum(math.exp(-len(bits) * (v - loss[order[0]])) for v in loss)) < 1e-3


def test_cues_in_any_case():
    found = pii.parser()("Api_Key: abcDEF1234567890XYZ and API_KEY=abcDEF1234567890XYZ, HtTp://x.example/é İ")
    assert len(found["secret"]) == 2 and len(found["url"]) == 1


def test_words_that_polynomials_confuse():
    import numpy as np
    import pyarrow as pa

    from addrlink.llm.tokens import Words, slices

    a, b = "a", "b"
    for _ in range(12):
        a, b = a + b, b + a
    ((_, part),) = slices(pa.array([f"{a} {b}"]))
    words = Words(part)
    assert len(np.unique(words.hash)) == 2 and len(np.unique(words.second())) == 2


def test_words_of_one_slice_stay_known_in_the_next():
    import pyarrow as pa

    from addrlink.llm.bpe import Encoder

    rng = random.Random(4)
    words = ["".join(rng.choices("abcdefghij", k=9)) for _ in range(160_000)]
    encode = Encoder(public_tokenizers.path("word_bpe_49k.json"))
    once = encode(pa.array([" ".join(words)], pa.large_string()))
    asked, word = [], encode.word
    encode.word = lambda raw: asked.append(raw) or word(raw)
    again = encode(pa.array([" ".join(words)], pa.large_string()))
    assert not asked and (once[0] == again[0]).all()


def test_words_are_encoded_in_bulk_as_one_by_one(monkeypatch):
    """Ids of many new words reach the cache with one write a slice, and are those of the library."""
    import numpy as np
    import pyarrow as pa

    from addrlink.llm import bpe

    words = ["plain", "UPPER", "it's", "x1y22", "a-b", "...", "é", "Ünï", "don't!", "中文", "\x01ctl", "tab\x7f", "ſ", "İx", "🙂", "naïve-1"]
    texts = [" ".join(f"{w}{i}" for w in words for i in range(k, k + 40)) for k in range(0, 2000, 40)] + ["", " ".join(words)]
    encode = bpe.Encoder(public_tokenizers.path("word_bpe_49k.json"))
    encode.flat, encode.bound, calls = np.empty(4, np.int32), np.zeros(4, np.int64), []

    class Counted(dict):
        def update(self, *x):
            calls.append(1)
            super().update(*x)

    encode.at = Counted()
    for part in (pa.array(texts[:20], pa.large_string()), pa.array(texts[10:], pa.large_string())):
        for text, ids in zip(part.to_pylist(), encode(part), strict=True):
            assert ids.tolist() == encode.full.encode(text, add_special_tokens=False).ids
    assert len(calls) == 2
