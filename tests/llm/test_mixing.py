"""Mixing against Poisson quantiles computed in plain Python."""

import hashlib
import math
from collections import Counter, defaultdict

from nestwork.llm import mixing

from .helpers import docs_frame, prose


def brute(rows, weights=None):
    size = defaultdict(int)
    for r in rows:
        size[r[3]] += len((r[1] or "").encode())
    weight = {s: (size[s] ** 0.5 if weights is None else weights.get(s, 0.0)) for s in size}
    total, mass = sum(size.values()), sum(w for s, w in weight.items() if size[s])
    out = Counter()
    for r in rows:
        rate = weight[r[3]] / mass * total / size[r[3]] if size[r[3]] else 1.0
        key = "null" if r[0] is None else r[0]
        u = (int(hashlib.md5(f"mix-1:{key}".encode()).hexdigest()[:13], 16) + 0.5) / 2 ** 52
        n, c, term = 0, math.exp(-rate), -rate  # in logarithms, as exp(-rate) may be zero
        while rate and c < u:
            n += 1
            term += math.log(rate) - math.log(n)
            c += math.exp(term)
        for i in range(n):
            out[r[0], r[3], i, int(hashlib.md5(f"mix-1:{key}:{i}".encode()).hexdigest()[:15], 16)] += 1
    return out


ROWS = ([(i, prose(30, i), "en", "hot") for i in range(300)] + [(1000 + i, prose(12, i), "en", f"s{i % 5}") for i in range(60)]
        + [(2000, "tiny", "en", "one"), (2001, None, "en", "blank"), (2002, "", "en", "blank"), (2003, "né", None, None),
           (None, prose(20, 3), "en", "s1"), (None, None, None, None)] + [(7, prose(30, 7), "en", "hot")] * 3)


def test_counts_equal_brute_force(spark):
    got = Counter(tuple(r) for r in mixing.mix_table(docs_frame(spark, ROWS)).collect())
    assert got == brute(ROWS)


def test_explicit_weights_and_many_copies(spark):
    weights = {"hot": 1.0, "one": 1.0, "s1": 2.0}
    docs = docs_frame(spark, ROWS)
    copies = mixing.replicate(docs, mixing.source_rates(docs, weights)).select("row.doc_id", "row.source", "copy", "mix_key")
    got = Counter(tuple(r) for r in copies.collect())
    assert got == brute(ROWS, weights)
    assert max(r[2] for r in got) > mixing.BLOCK  # a tiny source is repeated very often


def test_all_columns_and_shuffled_order(spark):
    docs = docs_frame(spark, ROWS)
    out = mixing.mix_sources(docs)
    assert out.columns == docs.columns
    assert Counter(r["doc_id"] for r in out.collect()) == Counter(
        {d: n for d, n in Counter(r[0] for r in brute(ROWS).elements()).items()})
    ids = [r["doc_id"] for r in mixing.mix_table(docs).where("doc_id is not null").collect()]
    assert sum(a < b for a, b in zip(ids, ids[1:])) < 0.7 * len(ids)  # not in the order of the documents


def test_high_rates_equal_exact_quantiles(spark):
    """The counts at rates up to a million, within seconds, against sums of exact terms."""
    import time

    from pyspark.sql import functions as F

    rates = [0.0, 1e-9, 0.5, 19.9, 20.0, 333.3, 40_000.0, 1_000_000.0]
    units = [1e-9, 0.0312, 0.5, 0.731, 0.99999]
    began = time.time()
    df = spark.createDataFrame([(r,) for r in rates], "rate double").select("rate", mixing._lowest().alias("lowest"), mixing._distribution().alias("cdf"))
    got = {r["rate"]: [r["lowest"] + n for n in r["n"]] for r in df.select("rate", "lowest", F.array(*[
        F.expr(f"size(filter(cdf, c -> c < {u!r}D))") for u in units]).alias("n")).collect()}
    assert time.time() - began < 30
    for rate in rates:
        k, c, want = 0, 0.0, []
        if rate:
            k = max(0, int(rate - 14 * rate ** 0.5))
        left = list(units)
        while left and rate:
            c += math.exp(k * math.log(rate) - rate - math.lgamma(k + 1)) if rate < 1000 else math.exp(
                k * math.log1p((rate - k) / k) + k - rate - (math.lgamma(k + 1) - (k * math.log(k) - k)))
            while left and c >= left[0]:
                want.append(k)
                left.pop(0)
            k += 1
        assert got[rate] == (want or [0] * len(units))


def test_empty_table(spark):
    assert mixing.mix_table(docs_frame(spark, [])).count() == 0
    assert mixing.mix_sources(docs_frame(spark, [])).count() == 0
