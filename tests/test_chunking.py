"""Chunking: exact multiples, empty arrays, round trip, categories."""

import json
from collections import Counter

from pyspark.sql import functions as F

from nestwork.operators import chunking as ch


def vdocs(spark, docs):
    df = spark.createDataFrame([(f"f{i}", json.dumps(d)) for i, d in enumerate(docs)], "file_path string, t string")
    return df.select("file_path", F.try_parse_json("t").alias("doc"))


def test_exact_multiple_and_empty(spark):
    d = vdocs(spark, [{"data": {"items": list(range(6))}}, {"data": {"items": []}}])
    c = ch.array_chunks(d, "data.items.item", 3).collect()
    assert [(r.file_path, r.chunk_id, r.n_objects, r.chunk_name) for r in c] == [
        ("f0", 1, 3, "chunk_0001.json"), ("f0", 2, 3, "chunk_0002.json")]


def test_nested_path_crosses_parents_in_document_order(spark):
    d = vdocs(spark, [{"a": [{"b": [1, 2]}, {"b": [3]}, {"c": 1}, {"b": [4, 5]}]}])
    c = ch.array_chunks(d, "a.item.b.item", 2).collect()
    assert [json.loads(ch_.j) for ch_ in d.sparkSession.createDataFrame(
        [(r.chunk_id, r.items) for r in c], "id int, items array<variant>").select(
        F.to_json("items").alias("j")).collect()] == [[1, 2], [3, 4], [5]]


def test_root_array_path(spark):
    d = vdocs(spark, [[{"x": 1}, {"x": 2}, {"x": 3}]])
    assert [r.n_objects for r in ch.array_chunks(d, "item", 2).collect()] == [2, 1]


def test_round_trip_keeps_multiset(spark):
    items = [{"k": i % 3, "v": i} for i in range(11)]
    d = vdocs(spark, [{"rows": items}])
    c = ch.array_chunks(d, "rows.item", 4).select(F.explode("items").alias("x"))
    back = Counter(r.x for r in c.select(F.to_json("x").alias("x")).collect())
    assert back == Counter(json.dumps(i, separators=(",", ":")) for i in items)


def test_structured_chunk_wraps_parent_keys(spark):
    d = vdocs(spark, [{"data": {"items": [1, 2, 3]}}])
    r = ch.structured_chunks(d, "data.items.item", 2).collect()
    assert [json.loads(x.json) for x in r] == [{"data": {"items": [1, 2]}}, {"data": {"items": [3]}}]
    assert r[0].chunk_name == "structured_0001.json"


def test_split_by_field_categories_null_and_sanitised_names(spark):
    items = [{"t": "a/b"}, {"t": "ab"}, {"t": None}, {"u": 1}, {"t": "a/b"}, {"t": "ab"}]
    d = vdocs(spark, [{"rows": items}])
    r = ch.split_by_field(d, "rows.item", "t", 1).collect()
    dirs = {x.category: x.category_dir for x in r}
    assert set(dirs) == {"a/b", "ab", "null"}
    assert dirs["ab"] == "category_ab" and dirs["a/b"].startswith("category_ab_") and dirs["null"] == "category_null"
    assert Counter(x.category for x in r) == {"a/b": 2, "ab": 2, "null": 2}
    first = [x for x in r if x.category == "ab"]
    assert sorted(x.first_pos for x in first) == [1, 5]


def test_multi_path_single_pass(spark):
    d = vdocs(spark, [{"users": [1, 2, 3], "posts": [1]}])
    r = ch.multi_path_chunks(d, [{"path": "users.item", "output_subdir": "users", "chunk_size": 2},
                                 {"path": "posts.item", "chunk_size": 5}]).collect()
    assert sorted((x.output_subdir, x.chunk_id, x.n_objects) for x in r) == [
        ("posts_item", 1, 1), ("users", 1, 2), ("users", 2, 1)]
