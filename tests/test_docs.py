"""Table-derived documents: forcing small pieces (as a hot key would) keeps every row."""

import duckdb
from pyspark.sql import functions as F

from nestwork.functions.keys import hash_key
from nestwork.operators import flatten as fl
from nestwork.plans.profile_plans import plan_file_links
from nestwork.sources.index_docs import index_documents
from nestwork.sources.rates_docs import rates_documents

from .conftest import SF_SMALL


def _counts():
    con = duckdb.connect()
    q = lambda s: con.execute(s).fetchone()[0]
    return (q(f"SELECT count(*) FROM '{SF_SMALL}/lineitem.parquet'"),
            q(f"SELECT count(*) FROM '{SF_SMALL}/orders.parquet'"),
            q(f"SELECT count(*) FROM '{SF_SMALL}/orders.parquet' WHERE o_orderstatus = 'F'"))


def test_split_index_documents_keep_every_entry(spark):
    docs = index_documents(spark, SF_SMALL, entries_per_element=3, elements_per_doc=2)
    bronze = docs.select(hash_key("file_path").alias("index_file_source_id"), "value")
    flat = fl.flatten_index(bronze)
    n_lines, n_orders, n_f = _counts()
    by_type = {r.file_type: r["count"] for r in flat.groupBy("file_type").count().collect()}
    n_pieces = duckdb.sql(f"SELECT sum(p)::INT FROM (SELECT ceil(count(*) / 3.0) p FROM '{SF_SMALL}/lineitem.parquet' "
                          "GROUP BY l_orderkey)").fetchall()[0][0]
    lineless = n_orders - duckdb.sql(f"SELECT count(DISTINCT l_orderkey) FROM '{SF_SMALL}/lineitem.parquet'").fetchall()[0][0]
    assert by_type == {"in_network_files": n_lines, "reporting_plans": n_pieces + lineless, "allowed_amount_file": n_f}
    # no file of a split order loses its plan
    links = plan_file_links(bronze.select("index_file_source_id", F.try_parse_json("value").alias("doc")))
    assert {r.n_plans: r["count"] for r in links.groupBy("n_plans").count().collect()} == {1: n_lines}
    assert docs.select("file_path").distinct().count() == docs.count() > 0


def test_split_rate_documents_keep_every_rate(spark):
    docs = rates_documents(spark, SF_SMALL, rates_per_doc=2)
    n = docs.select(F.try_parse_json("value").alias("v")).select(F.explode(F.expr(
        "try_cast(try_variant_get(v, '$.in_network[0].negotiated_rates', 'variant') AS ARRAY<VARIANT>)"))).count()
    assert n == _counts()[0]


def test_bronze_tasks_grow_with_the_tables(spark, monkeypatch):
    """Tables of more rows are grouped and written by more tasks, with the same documents."""
    from nestwork.sources import bronze, tables

    monkeypatch.setattr(bronze, "_WRITTEN", {})
    read = {"index": bronze.index_bronze_table, "rates": bronze.rates_bronze_table, "change_log": bronze.change_log_table}
    few = {k: f(spark, SF_SMALL) for k, f in read.items()}
    monkeypatch.setattr(bronze, "_WRITTEN", {})
    monkeypatch.setattr(tables, "ROWS_PER_TASK", 100)
    for k, f in read.items():
        many, by = f(spark, SF_SMALL), ["event_id"] if k == "change_log" else ["file_path", "value"]
        assert len(many.inputFiles()) > 2 * len(few[k].inputFiles())
        assert sorted(map(tuple, many.select(by).collect())) == sorted(map(tuple, few[k].select(by).collect()))


def test_part_names_join_the_grouped_rate_files_without_moving_them(spark):
    """However many parts there are, nothing that was grouped to documents is shuffled again."""
    from nestwork.session import with_settings

    with with_settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        plan = rates_documents(spark, SF_SMALL)._jdf.queryExecution().sparkPlan().toString()
        done = rates_documents(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan
    before = done[:done.index("ObjectHashAggregate")]  # between the join and the documents
    assert "Exchange" not in before and "Sort" not in before


def test_repeated_parts_and_pieces_keep_their_documents(spark, scratch):
    """A part that stands twice gives each piece of its files twice, as a join does."""
    con = duckdb.connect()
    import os
    os.makedirs(scratch)
    con.execute(f"COPY (SELECT * FROM '{SF_SMALL}/lineitem.parquet') TO '{scratch}/lineitem.parquet'")
    con.execute(f"COPY (SELECT * FROM '{SF_SMALL}/part.parquet' UNION ALL SELECT * FROM '{SF_SMALL}/part.parquet' WHERE p_partkey % 3 = 0) TO '{scratch}/part.parquet'")
    docs = rates_documents(spark, scratch, rates_per_doc=2).groupBy("file_path").count().collect()
    assert len(docs) > 0
    assert all(r["count"] == (2 if int(r.file_path.split("/")[1]) % 3 == 0 else 1) for r in docs)


def test_stored_variants_are_whole_and_forms_are_written_when_read(spark, monkeypatch):
    from nestwork.sources import bronze

    monkeypatch.setattr(bronze, "_WRITTEN", {})
    import pyarrow.parquet as pq
    table_ = bronze.rates_variant_table(spark, SF_SMALL)
    assert {name for _, name, _ in bronze._WRITTEN} == {"rates", "rates_variant"}
    stored = pq.read_schema(table_.inputFiles()[0].removeprefix("file:").replace("///", "/")).field("vdoc").type
    assert sorted(f.name for f in stored) == ["metadata", "value"]
    assert bronze.rates_typed_table(spark, SF_SMALL).count() == table_.count()


def _tables(scratch, **rows):
    import os

    con = duckdb.connect()
    os.makedirs(scratch)
    for name, select in rows.items():
        con.execute(f"COPY ({select}) TO '{scratch}/{name}.parquet'")


def test_repeated_and_null_rows_of_index_files(spark, scratch):
    """Orders and customers that stand twice give their entries twice, orders without lines an empty list; a null is left out."""
    _tables(scratch,
            lineitem="SELECT * FROM (VALUES (1, 7, 8, 2), (1, 7, 8, 10), (1, NULL, 8, 1), (2, -5, 6, NULL), (NULL, 1, 1, 1), (9, 1, 1, 1)) "
                     "t(l_orderkey, l_partkey, l_suppkey, l_linenumber)",
            orders="SELECT * FROM (VALUES (1, 1, 'F', 'a'), (1, 1, 'O', 'b'), (2, 2, NULL, NULL), (3, 2, 'F', 'c'), (NULL, 2, 'O', 'd'), (4, NULL, 'F', 'e'), (5, 8, 'F', 'f')) "
                   "t(o_orderkey, o_custkey, o_orderstatus, o_orderpriority)",
            customer="SELECT * FROM (VALUES (1, 'x', 's'), (2, 'y', NULL), (2, 'y', NULL), (3, 'z', 's'), (NULL, 'n', 's')) t(c_custkey, c_name, c_mktsegment)")
    import json
    docs = {r.file_path: json.loads(r.value) for r in index_documents(spark, scratch).collect()}
    plan = lambda name, key, kind: {k: v for k, v in zip(
        ("plan_name", "plan_id_type", "plan_id", "plan_market_type"), (name, "EIN", key, kind)) if v is not None}
    file = lambda text, place: {k: v for k, v in (("description", text), ("location", place)) if v is not None}
    allowed = lambda key: {"description": "allowed amount file", "location": f"https://h/allowed/{key}.json"}
    one = [file("1", None), file("10", "https://h/7-8.json.gz"), file("2", "https://h/7-8.json.gz")]
    assert docs == {
        "index/1/part-0.json": {"reporting_entity_name": "x", "reporting_entity_type": "s", "reporting_structure": [
            {"reporting_plans": [plan("a", "1", "F"), plan("b", "1", "O")], "in_network_files": [f for f in one for _ in range(2)],
             "allowed_amount_file": allowed(1)}]},
        "index/2/part-0.json": {"reporting_entity_name": "y", "reporting_structure": [
            {"reporting_plans": [plan("d", None, "O")] * 2, "in_network_files": []},
            {"reporting_plans": [plan(None, "2", None)] * 2, "in_network_files": [file(None, "https://h/-5-6.json.gz")] * 2},
            {"reporting_plans": [plan("c", "3", "F")] * 2, "in_network_files": [], "allowed_amount_file": allowed(3)}]},
    }


def test_lines_move_to_index_files_as_packed_numbers(spark):
    """No name, prefix or row number goes with a line to its order and its document."""
    from nestwork.sources.index_docs import index_elements

    elements, customer = index_elements(spark, SF_SMALL)
    kinds = dict(elements.dtypes)
    assert kinds["lines"] == "binary" and not {"c_name", "c_mktsegment", "salt"} & set(kinds)
    n, size = elements.agg(F.sum(F.size("plans")), F.sum(F.length("lines"))).first()
    n_lines = _counts()[0]
    assert n == _counts()[1] and size <= 8 * n_lines
    assert {"c_name", "c_mktsegment"} <= set(customer.columns)


def test_packed_texts_come_back(spark):
    from nestwork.sources.index_docs import packed, unpacked

    texts = ["1,12-3;", "12,-1--2;", "x,x;", "4,9223372036854775807-0;", "3,x;"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    assert [r.u for r in df.orderBy("i").select(unpacked(packed(F.col("t"))).alias("u")).collect()] == texts
    both = df.groupBy().agg(F.listagg(packed(F.col("t"))).alias("b")).select(unpacked(F.col("b")).alias("u")).first().u
    assert sorted(both.split(";")) == sorted(["", *(t[:-1] for t in texts)])


def test_heavy_keys_are_exact_and_few(spark):
    """Keys above the size with their sums, however the others share their buckets."""
    from nestwork.sources.index_docs import heavy_keys

    rows = spark.range(5000).select(F.when(F.col("id") < 3000, F.col("id") % 3).otherwise(F.col("id")).alias("k"), F.lit(1).alias("n"))
    assert {(r.k, r.n) for r in heavy_keys(rows, "k", 999, 5000).collect()} == {(0, 1000), (1, 1000), (2, 1000)}
    assert heavy_keys(rows, "k", 1000, 5000).count() == 0
    assert {(r.k, r.n) for r in heavy_keys(rows, "k", 999, 1).collect()} == {(0, 1000), (1, 1000), (2, 1000)}


def test_index_bronze_stores_the_text_only(spark, monkeypatch):
    import pyarrow.parquet as pq

    from nestwork.sources import bronze

    monkeypatch.setattr(bronze, "_WRITTEN", {})
    stored = bronze.index_bronze_table(spark, SF_SMALL)
    meta = pq.ParquetFile(stored.inputFiles()[0].removeprefix("file:").replace("///", "/"))
    assert meta.schema_arrow.names == ["index_file_source_id", "file_path", "value"]
    assert meta.metadata.row_group(0).column(2).compression == "ZSTD"
    assert stored.where(F.col("doc").isNull()).count() == 0
