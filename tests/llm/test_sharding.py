"""Sharding: even counts, whole groups, exact figures."""

import zlib
from collections import Counter, defaultdict

import pytest

from nestwork.llm import sharding

from .helpers import docs_frame, prose


def check(out, rows, shards):
    counts = Counter(r["shard"] for r in out)
    assert len(out) == len(rows)
    assert set(counts) <= set(range(shards))
    sizes = [counts.get(s, 0) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1
    slots = defaultdict(list)
    for r in out:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    want = Counter((d, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t, *_ in rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in out) == want


def test_groups_stay_whole_and_counts_even(spark):
    rows = [(i, prose(5 + i % 7, i)) for i in range(900)] + [(1000 + i, f"copy {i % 60}") for i in range(300)]
    rows += [(5000, None), (5001, ""), (None, "x"), (None, "y" * 100_000)] + [(7, "same row")] * 3
    out = sharding.assign_shards(docs_frame(spark, rows)).collect()
    check(out, rows, 40)
    group = {zlib.crc32(f"copy {i}".encode()) for i in range(60)}
    where = defaultdict(set)
    for r in out:
        if r["text_crc32"] in group:
            where[r["text_crc32"]].add(r["shard"])
    assert sum(len(v) > 1 for v in where.values()) <= 3


def test_a_group_of_a_third_of_all_rows(spark):
    rows = [(i, "the same text") for i in range(400)] + [(1000 + i, f"other {i}") for i in range(800)]
    out = sharding.assign_shards(docs_frame(spark, rows)).collect()
    check(out, rows, 40)
    hot = zlib.crc32(b"the same text")
    assert len({r["shard"] for r in out if r["text_crc32"] == hot}) <= 20  # 14 shards would hold it exactly


def test_pairs_come_together_when_every_document_has_a_copy(spark):
    rows = [(i, f"text {i // 2}") for i in range(8000)]
    out = sharding.assign_shards(docs_frame(spark, rows)).collect()
    check(out, rows, 40)
    where = defaultdict(set)
    for r in out:
        where[r["doc_id"] // 2].add(r["shard"])
    assert sum(len(v) > 1 for v in where.values()) <= 200  # of 4,000 pairs, about 3,900 of which start apart


def test_rows_that_repeat_id_and_text_are_spread(spark):
    """A third of all rows without id and text: no unit, bucket or window holds them all."""
    rows = [(None, None)] * 700 + [(i, prose(6, i)) for i in range(1400)]
    docs = docs_frame(spark, rows)
    start = sharding._rows(docs, 40).where("doc_id IS NULL").groupBy("start").count().collect()
    assert len(start) == 40 and max(r["count"] for r in start) < 60
    check(sharding.assign_shards(docs).collect(), rows, 40)


@pytest.mark.parametrize("rows", [[], [(1, "a")], [(1, "a")] * 90])
def test_small_and_uniform_tables(spark, rows):
    table = sharding.shard_table(docs_frame(spark, rows))
    assert table.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard", "linked"]
    check(table.collect(), rows, 40)
