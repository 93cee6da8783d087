"""Property tests (round trips): chunking and split-by-field keep every element
in document order, for random arrays, chunk sizes and categories."""

import json
import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from nestwork.operators import chunking as ch

DOCS = st.lists(st.lists(st.tuples(st.integers(0, 10**6), st.sampled_from(["a", "b", "c/d", None])),
                         max_size=25), min_size=1, max_size=6)


def _frame(spark, docs):
    rows = [(f"f{i}", json.dumps({"data": {"rows": [{"v": v, "t": t} for v, t in d]}})) for i, d in enumerate(docs)]
    return spark.createDataFrame(rows, "file_path string, t string").select(
        "file_path", F.try_parse_json("t").alias("doc"))


def _values(chunks):
    out = {}
    for r in chunks.select("file_path", "chunk_id", F.to_json("items").alias("j"), *(
            ["category"] if "category" in chunks.columns else [])).collect():
        key = (r.file_path, r["category"]) if "category" in r else r.file_path
        out.setdefault(key, []).append((r.chunk_id, [x["v"] for x in json.loads(r.j)]))
    return {k: [v for _, part in sorted(parts) for v in part] for k, parts in out.items()}, out


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(docs=DOCS, size=st.integers(1, 7))
def test_array_chunks_round_trip(spark, docs, size):
    chunks = ch.array_chunks(_frame(spark, docs), "data.rows.item", size)
    joined, parts = _values(chunks)
    for i, d in enumerate(docs):
        want = [v for v, _ in d]
        assert joined.get(f"f{i}", []) == want
        got_parts = parts.get(f"f{i}", [])
        assert len(got_parts) == math.ceil(len(want) / size)
        assert all(len(p) == size for _, p in sorted(got_parts)[:-1])


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(docs=DOCS, size=st.integers(1, 5))
def test_split_by_field_round_trip(spark, docs, size):
    chunks = ch.split_by_field(_frame(spark, docs), "data.rows.item", "t", size)
    joined, parts = _values(chunks)
    for i, d in enumerate(docs):
        for cat in {("null" if t is None else t) for _, t in d}:
            want = [v for v, t in d if ("null" if t is None else t) == cat]
            assert joined[(f"f{i}", cat)] == want
            assert len(parts[(f"f{i}", cat)]) == math.ceil(len(want) / size)
    assert sum(len(v) for v in joined.values()) == sum(len(d) for d in docs)
