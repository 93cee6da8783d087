"""BagMinHash: unbiased signatures, classes against brute force."""

import random
from collections import Counter, defaultdict

import numpy as np

from nestwork.llm import bagminhash as B

from .helpers import docs_frame, overlap, prose, shingle_bag, words_of


def brute_classes(rows):
    """Least doc_id of each row's class, by all pairs."""
    texts = sorted({t or "" for _, t, *_ in rows})
    bags = [shingle_bag(t) for t in texts]
    top = list(range(len(texts)))

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            if overlap(bags[i], bags[j]) >= 0.8:
                top[find(i)] = find(j)
    at = {t: find(i) for i, t in enumerate(texts)}
    least = defaultdict(list)
    for d, t, *_ in rows:
        least[at[t or ""]].append(d)
    first = {c: min((d for d in ds if d is not None), default=None) for c, ds in least.items()}
    return Counter((d, first[at[t or ""]]) for d, t, *_ in rows)


def edited(text, changes, seed):
    rng = random.Random(seed)
    words = text.split(" ")
    for i in rng.sample(range(len(words)), changes):
        words[i] = f"new{rng.randrange(10 ** 6)}"
    return " ".join(words)


def hostile():
    base = prose(200, 1, line=10 ** 6)
    rows = [(1000 + i, edited(base, i % 9, i)) for i in range(60)]  # near copies of one text, many not alike to each other
    chain = [prose(100, 50, line=10 ** 6)]
    for i in range(6):
        chain.append(edited(chain[-1], 2, 70 + i))  # each alike to the next, the ends are not
    rows += [(2000 + i, t) for i, t in enumerate(chain)]
    rows += [(i, prose(60 + i, 500 + i)) for i in range(60)]
    shared = prose(60, 3, line=10 ** 6)
    rows += [(3000 + i, shared + " " + prose(40, 900 + i, line=10 ** 6)) for i in range(40)]  # half in common
    rows += [(4000, None), (4001, ""), (4002, " "), (4003, "a b"), (4004, "a  b"), (4005, "a b c d e"), (4006, "a b c d e f"),
             (4007, "go " * 300), (4008, "go " * 310), (4009, "go " * 100), (4010, prose(9000, 5)), (4011, prose(9000, 5) + " x"),
             (None, "no id but text of five words"), (None, "no id but text of five words"), (1001, base)]
    return rows + [(1000, rows[0][1])] * 3  # repeated rows


def test_signature_is_unbiased():
    rng = np.random.default_rng(0)
    off = []
    for _ in range(80):
        a = np.sort(rng.integers(0, 2 ** 63, 150).astype(np.uint64).repeat(rng.integers(1, 7, 150)))
        b = np.sort(np.concatenate([a[rng.random(len(a)) < 0.8], rng.integers(0, 2 ** 63, 40).astype(np.uint64)]))
        off.append((B.bag_signature(a) == B.bag_signature(b)).mean() - B.weighted_jaccard(a, b))
    assert abs(np.mean(off)) < 4 * 0.04 / np.sqrt(80)


def test_word_hashes_split_like_the_words():
    for text in ("", " a", "é  b\tc\r\nd ", "x" * 70_000 + " y", "a b"):
        assert len(B.word_hashes(text.encode())) == len(words_of(text))
    assert B.word_hashes(b"ab ba ab")[0] == B.word_hashes(b"ab")[0] != B.word_hashes(b"ba")[0]


def test_classes_equal_brute_force(spark):
    rows = hostile()
    got = B.near_dup_table(docs_frame(spark, rows)).collect()
    assert Counter(map(tuple, got)) == brute_classes(rows)


def test_small_blocks_find_the_same(spark, monkeypatch):
    monkeypatch.setattr(B, "BLOCK_TEXTS", 8)
    rows = hostile()
    got = B.near_dup_table(docs_frame(spark, rows)).collect()
    assert Counter(map(tuple, got)) == brute_classes(rows)


def test_one_of_each_class_stays(spark):
    rows = hostile()
    docs = docs_frame(spark, rows)
    kept = B.keep_first(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    want = {c for _, c in brute_classes(rows)}
    assert Counter(ids) == Counter(want)


def test_empty_table(spark):
    assert B.near_dup_table(docs_frame(spark, [])).count() == 0
    assert B.keep_first(docs_frame(spark, [])).count() == 0
    assert B.near_dup_table(docs_frame(spark, [(1, None), (2, "x")])).count() == 2
