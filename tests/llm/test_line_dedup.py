"""Line dedup against brute force, with runs that cross partitions."""

import hashlib
from collections import defaultdict

import pytest

from nestwork.llm import line_dedup

from .helpers import docs_frame, prose

LIMITS = " \t\n\v\f\r"


def key_of(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(LIMITS))


def brute(rows):
    """One (doc_id, n_lines, n_dropped, kept) for each row; a null id is one document after all others."""
    where = defaultdict(set)
    order = lambda d: float("inf") if d is None else d
    for d, t, *_ in rows:
        for line in (t or "").split("\n"):
            if len(key_of(line)) >= 10:
                where[key_of(line)].add(order(d))
    out = []
    for d, t, *_ in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(where[key_of(x)]) < 2 or min(where[key_of(x)]) == order(d)]
        out.append((d, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def hostile():
    common = "A Very Common Line of Text"
    rows = [(i, f"{common}\n{prose(20, i)}\n  {common.upper()}\t\nshort") for i in range(100, 400)]
    rows += [(5, None), (6, ""), (7, "\n\n"), (8, "ÄÖÜÄÖÜÄÖÜÄ\näöüäöüäöüä"), (9, "äöüäöüäöüä"), (10, "tiny\ntiny"), (11, "tiny"),
             (12, f"x\n{common}\n{common}"), (None, f"{common}\nonly nulls have this one"), (None, "only nulls have this one"),
             (13, "exactly10!"), (14, "EXACTLY10! "), (15, "line of doc\n" * 3000), (16, "line of doc"), (17, "y" * 300_000),
             (18, " nbsp is no space "), (19, "nbsp is no space")]
    rows += [(20, "same id, other text\nA line that is shared"), (20, "A line that is shared\nsecond")]
    rows += [(21, f"{common}\nrepeated row here")] * 4
    return rows


@pytest.mark.parametrize("parts", [1, 7, 60])
def test_equals_brute_force(spark, parts):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else all rows fit one partition
    try:
        rows = hostile()
        got = line_dedup.line_dedup_table(docs_frame(spark, rows)).collect()
        want = [(d, n, k, hashlib.sha256(t.encode()).hexdigest()) for d, n, k, t in brute(rows)]
        assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
        texts = line_dedup.dedup_lines(docs_frame(spark, rows))
        assert texts.columns == docs_frame(spark, []).columns
        assert sorted(repr((r["doc_id"], r["text"], r["n_chars"])) for r in texts.collect()) == sorted(
            repr((d, t, len(t))) for d, _, _, t in brute(rows))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_empty_table(spark):
    assert line_dedup.line_dedup_table(docs_frame(spark, [])).count() == 0
    assert line_dedup.dedup_lines(docs_frame(spark, [])).count() == 0
