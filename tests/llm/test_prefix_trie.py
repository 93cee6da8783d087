"""The prefix trie against plain dictionaries of prefixes, with tiny shards, bands and queues."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from nestwork.llm import prefix_scan as S
from nestwork.llm import prefix_trie as P

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


@pytest.fixture(autouse=True)
def spread(spark):
    """Small exchanges stay spread, as large ones are."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def mark(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{len(text)}:{text}".encode()).hexdigest()


def plain_rebuilt(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", mark(role or "", text or ""), text or ""))
    own = {c: [(t[2], t[4]) for t in sorted(ts)] for c, ts in own.items()}
    out = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        base = c - int(c % 5 if c >= 0 else -(-c % 5))
        out[c] = own.get(base, [])[:h] + own[c][h:]
    return out


def plain_trie(convs):
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    leaves, saved, kids = (dict.fromkeys(members, 0) for _ in range(3))
    for node, cs in members.items():
        if node:
            kids[node[:-1]] += 1
    for node, cs in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += not kids[node]
            saved[node[:d]] += (len(cs) - 1) * len(node[-1][1].encode()) if node else 0
    return sorted((min(cs), len(n), min(members[n[:-1]]) if n else None, len(cs), kids[n], leaves[n], saved[n],
                   hashlib.sha256(",".join(str(c) for c in sorted(cs) if len(convs[c]) == len(n)).encode()).hexdigest())
                  for n, cs in members.items())


def frame(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    for c in ("pos", "part", "digest", "depth", "size", "k1", "base", "head"):
        df = df.withColumn(c, F.lit("extra"))
    return df


def hostile():
    rng = random.Random(12)
    rows = []
    for c in range(120):
        same = rng.random() < 0.5
        for t in range(rng.randrange(0, 7)):
            text = f"turn {t}" if same else rng.choice(["a", "b", "é" * 30, "", None])
            rows.append((c, t, rng.choice(["user", None]) if not same else "user", text))
    rows += [(1000 + 5 * i, t, "user", f"common {t}") for i in range(60) for t in range(12)]  # one conversation again and again
    rows += [(2000 + 5 * i, 0, "user", "hello") for i in range(80)] + [(2000 + 5 * i, 1, "user", f"{i}") for i in range(80)]
    rows += [(5000, t, "user", f"long {t % 7}") for t in range(900)]  # a very long one
    rows += [(5005, t, "user", f"long {t % 7}") for t in range(450)] + [(5005, 900 + t, "user", "x" * t) for t in range(40)]
    rows += [(6000, None, "user", "same")] * 300 + [(6000, 1, "b", "tie"), (6000, 1, "a", "tie"), (6000, 1, "a", "ti")]
    rows += [(-3, 0, "user", "negative"), (-5, 0, "user", "n"), (None, 0, "user", "no id"), (None, 1, "user", "no id")]
    return rows


@pytest.mark.parametrize("shard,band,queue", [(4096, 1024, 500_000), (30, 4, 3), (1, 1, 2)])
def test_trie_equals_plain_dictionaries(spark, monkeypatch, shard, band, queue):
    monkeypatch.setattr(P, "SHARD", shard)
    monkeypatch.setattr(P, "BAND", band)
    monkeypatch.setattr(P, "PART", 50 if shard > 1 else 7)
    monkeypatch.setattr(P.SpillingQueue.__init__, "__defaults__", (queue,))
    rows = hostile()
    got = P.conversation_trie(frame(spark, rows))
    assert got.columns == COLUMNS
    key = lambda r: str(r)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(plain_trie(plain_rebuilt(rows)), key=key)


def test_empty_table(spark):
    got = P.conversation_trie(frame(spark, hostile()).limit(0))
    assert got.columns == COLUMNS and got.collect() == []


def test_queue_spills_and_keeps_order():
    rng = random.Random(1)
    q, items = P.SpillingQueue(7), [(rng.randrange(20), rng.randrange(3), i) for i in range(500)]
    for x in items:
        q.push(x)
    assert q.runs
    out = [x for key in sorted({x[:2] for x in items}) for x in q.pop_equal(key)]
    assert [x[:2] for x in out] == sorted(x[:2] for x in items) and sorted(out) == sorted(items)
    assert not q.heap and not q.runs


def test_scan_over_many_tasks(spark):
    """Places and prefix hashes of a sequence that is spread over tasks."""
    rows = spark.range(2000).select(F.when(F.col("id") < 1500, 1).otherwise(F.col("id")).cast("long").alias("c"), "id",
                                    F.substring(F.sha2(F.col("id").cast("string").cast("binary"), 256), 1, 32).alias("digest"))
    got = S.scan(rows.repartition(3), "c", [F.col("id")], "scan-test").collect()
    assert len({r["part"] for r in got if r["c"] == 1}) > 1
    h, n = S.EMPTY, 0
    for r in sorted((r for r in got if r["c"] == 1), key=lambda r: r["id"]):
        before, h, n = h, S.extended(h, S.values(r["digest"])), n + 1
        assert (r["pos"], r["k1"], r["k2"], r["p1"], r["p2"]) == (n, *h, *before)
    assert all(r["pos"] == 1 and r["p1"] == 0 for r in got if r["c"] != 1)
