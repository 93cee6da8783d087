"""Language identification: against plain naive Bayes over a dictionary, held-out accuracy, hostile rows."""

import math
import random
import zlib
from collections import Counter

import pytest

from nestwork.llm import language_id as L
from nestwork.sources.tables import table

from ..conftest import SF_SMALL
from .helpers import docs_frame

SYLLABLES = {"aa": ["ka", "tu", "mo", "éri"], "bb": ["sch", "ung", "ka", "öl"], "cc": ["ña", "tu", "ción", "lo"]}


def words(lang, n, seed):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(n))


def plain_grams(text):
    """Every n-gram of the padded text, by slicing."""
    marked = [0, *(ord(c) if c.isalpha() else 0 for c in text.lower()), 0]
    out = []
    for n in range(1, L.LONGEST + 1):
        for i in range(len(marked) - n + 1):
            g = marked[i:i + n]
            if any(g) and not any(a == b == 0 for a, b in zip(g, g[1:])):
                h = 0
                for c in g:
                    h = (h * L.STEP + c) % 2 ** 64
                out.append(((h ^ n) * L.MIX % 2 ** 64) >> (64 - L.BUCKET_BITS))
    return out


def plain_model(rows):
    grams, texts = {}, Counter()
    for text, lang in rows:
        if lang is not None and text and any(c.isalpha() for c in text):
            grams.setdefault(lang, Counter()).update(plain_grams(text))
            texts[lang] += 1
    return grams, texts


def plain_prediction(text, grams, texts):
    if not text or not any(c.isalpha() for c in text) or not texts:
        return "und", 0.0
    score = {}
    for lang in sorted(texts):
        size = sum(grams[lang].values()) + L.SMOOTHING * L.BUCKETS
        s = round(math.log(texts[lang] / sum(texts.values())) * L.SCALE)
        for g in plain_grams(text):
            s += round((math.log(grams[lang][g] + L.SMOOTHING) - math.log(size)) * L.SCALE)
        score[lang] = s
    best = max(sorted(score), key=score.get)
    return best, 1 / sum(math.exp((s - score[best]) / L.SCALE) for s in score.values())


def test_features_equal_plain_slicing(monkeypatch):
    texts = ["", None, "a", "ab cd", "!!", "  Été 12x,,y ", words("aa", 60, 1), "İstanbul ΣΑΣ", "x" * 50]
    for piece in (1 << 18, 7, 16):
        monkeypatch.setattr(L, "PIECE", piece)
        got = {i: Counter() for i in range(len(texts))}
        for owner, buckets in L.features(texts):
            assert list(owner) == sorted(owner)
            for i, b in zip(owner, buckets):
                got[i][int(b)] += 1
        assert [got[i] for i in range(len(texts))] == [Counter(plain_grams(t or "")) for t in texts]


@pytest.mark.parametrize("labels", [64, 2, 1])
def test_predictions_equal_plain_naive_bayes(spark, monkeypatch, labels):
    monkeypatch.setattr(L, "LABELS", labels)
    rows = [(i, words(lang, 1 + i % 9, i), lang, "s") for i, lang in enumerate(["aa", "bb", "cc"] * 25)]
    rows += [(200, None, "aa", "s"), (201, "", "bb", "s"), (202, "12 !?", "cc", "s"), (203, words("aa", 5, 9), None, "s"),
             (204, "tu", "zz", None), (None, "ka ka", "aa", "s"), (205, words("bb", 3000, 5), "bb", "s"), (206, "ка", None, "s")]
    rows += [(300 + i, words("cc", 8, 77), "cc", "hot") for i in range(40)]  # one text again and again
    docs = docs_frame(spark, rows)
    out = lambda i: zlib.crc32(str("" if i is None else i).encode()) % 5 == 0
    grams, texts = plain_model([(r[1], r[2]) for r in rows if not out(r[0])])
    got = sorted(((r["doc_id"], r["held_out"], r["lang_pred"], r["score"]) for r in L.language_table(docs).collect()), key=str)
    want = sorted(((r[0], out(r[0]), *plain_prediction(r[1], grams, texts)) for r in rows), key=str)
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert all(abs(g[3] - w[3]) < 1e-9 and 0 <= g[3] <= 1 for g, w in zip(got, want))


def test_nothing_learned_and_empty(spark):
    docs = docs_frame(spark, [(1, "some text", None, "s"), (2, None, "en", "s")])
    assert {(r["doc_id"], r["lang_pred"], r["score"]) for r in L.language_table(docs).collect()} == {(1, "und", 0.0), (2, "und", 0.0)}
    assert L.language_table(docs.limit(0)).collect() == []


def test_any_columns_are_kept(spark):
    docs = spark.createDataFrame([("ka tu", "aa", 1), ("schung", "bb", 2)], "`my``text` string, `the lang` string, k0 int")
    blocks = L.model(L.train(docs, "my`text", "the lang"))
    got = L.predict(docs, blocks, "my`text", keep=["k0", "my`text", "the lang"])
    assert got.columns == ["k0", "my`text", "the lang", "lang_pred", "score"]
    assert {r["lang_pred"] == r["the lang"] for r in got.collect()} == {True}


def test_held_out_accuracy(spark):
    docs = table(spark, SF_SMALL.replace("0.001", "0.01"), "documents")
    got = L.language_table(docs).where("held_out").join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(got) > 100
    assert sum(r["lang"] == r["lang_pred"] for r in got) >= 0.98 * len(got)
