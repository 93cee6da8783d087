"""SCD1 apply: order independence, replays, tombstones, truncate; change feed."""

import datetime as dt

from pyspark.sql import functions as F

from nestwork.operators import cdc
from nestwork.streaming.scd1 import Scd1Target

T = dt.datetime(2024, 1, 1)
SCHEMA = "k long, seq long, v string, _change_type string"


def rows(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def current(df):
    return {r.k: r.v for r in cdc.apply_scd1(df, ["k"], ["seq"]).collect()}


def test_latest_wins_in_any_order_and_replayed(spark):
    data = [(1, 1, "a", "insert"), (1, 3, "c", "update_postimage"), (1, 2, "b", "update_postimage"),
            (2, 1, "x", "insert")]
    a = current(rows(spark, data))
    b = current(rows(spark, list(reversed(data)) + data))  # shuffled and replayed
    assert a == b == {1: "c", 2: "x"}


def test_delete_holds_against_late_lower_sequence_update(spark):
    data = [(1, 1, "a", "insert"), (1, 5, None, "delete"), (1, 3, "late", "update_postimage")]
    assert current(rows(spark, data)) == {}


def test_truncate_drops_rows_at_or_below_its_sequence(spark):
    data = [(1, 1, "a", "insert"), (2, 2, "b", "insert"), (0, 3, None, "truncate"), (2, 4, "b2", "update_postimage")]
    assert current(rows(spark, data)) == {2: "b2"}


def test_preimage_rows_are_ignored(spark):
    data = [(1, 1, "a", "insert"), (1, 2, "old", "update_preimage")]
    assert current(rows(spark, data)) == {1: "a"}


def test_snapshot_diff(spark):
    before = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k long, v string")
    after = spark.createDataFrame([(1, "a"), (2, "B"), (4, "d")], "k long, v string")
    got = sorted((r.k, r.v, r._change_type) for r in cdc.snapshot_diff(before, after, ["k"], ["v"]).collect())
    assert got == [(2, "B", "update_postimage"), (2, "b", "update_preimage"), (3, "c", "delete"), (4, "d", "insert")]


def test_stream_target_batches_replays_and_truncate(spark, scratch):
    t = Scd1Target(spark, scratch, ["k"], ["seq"], ["k", "seq", "v", "_change_type"], n_buckets=4)
    b0 = rows(spark, [(1, 1, "a", "insert"), (2, 1, "b", "insert"), (3, 1, "c", "insert")])
    b1 = rows(spark, [(1, 2, "a2", "update_postimage"), (2, 2, None, "delete")])
    b2 = rows(spark, [(2, 0, "late", "update_postimage")])
    t.apply_batch(b0, 0)
    t.apply_batch(b1, 1)
    t.apply_batch(b1, 1)  # the same micro-batch replayed after a failure
    t.apply_batch(b2, 2)  # late, lower-sequence update of a deleted key
    got = {r.k: r.v for r in t.current().collect()}
    assert got == {1: "a2", 3: "c"}
    t.apply_batch(rows(spark, [(0, 5, None, "truncate"), (4, 6, "d", "insert")]), 3)
    assert {r.k: r.v for r in t.current().collect()} == {4: "d"}


def test_single_pass_change_feed_equals_two_snapshot_diff(spark):
    schema = "k long, seq long, v string, _change_type string, _commit_version long"
    log = spark.createDataFrame([
        (1, 1, "a", "insert", 0), (2, 1, "b", "insert", 0), (3, 1, "c", "insert", 0),
        (1, 2, "a2", "update_postimage", 1), (2, 2, None, "delete", 1), (4, 2, "d", "insert", 1),
        (3, 3, "c", "update_postimage", 1), (5, 1, "e", "insert", 0), (5, 4, None, "delete", 2)], schema)
    one = cdc.changes_between(log, ["k"], ["seq"], ["v"], 0)
    before = cdc.apply_scd1(log.where("_commit_version <= 0"), ["k"], ["seq"])
    after = cdc.apply_scd1(log, ["k"], ["seq"])
    two = cdc.snapshot_diff(before, after, ["k"], ["v"])
    norm = lambda df: sorted((r.k, r.v, r._change_type) for r in df.collect())
    assert norm(one) == norm(two) == [
        (1, "a", "update_preimage"), (1, "a2", "update_postimage"), (2, "b", "delete"), (4, "d", "insert"),
        (5, "e", "delete")]


def test_stream_target_empty_batch_and_pointer_fallback(spark, scratch):
    t = Scd1Target(spark, scratch, ["k"], ["seq"], ["k", "seq", "v", "_change_type"], n_buckets=4)
    t.apply_batch(rows(spark, [(1, 1, "a", "insert"), (2, 1, "b", "insert")]), 0)
    t.apply_batch(rows(spark, []), 1)  # no rows: the bucket map is carried forward
    t.apply_batch(rows(spark, [(1, 2, "a2", "update_postimage")]), 2)
    assert {r.k: r.v for r in t.current().collect()} == {1: "a2", 2: "b"}
    # batch ids with a gap (no pointer for id 4): the latest pointer is found by listing
    t.apply_batch(rows(spark, [(3, 1, "c", "insert")]), 5)
    assert {r.k: r.v for r in t.current().collect()} == {1: "a2", 2: "b", 3: "c"}


def test_changes_between_sees_a_truncate(spark):
    from nestwork.operators import cdc

    log = spark.createDataFrame(
        [(1, 1, "a", "insert", 0), (2, 2, "b", "insert", 0), (None, 3, None, "truncate", 1), (3, 4, "c", "insert", 2), (2, 1, "x", "insert", 2)],
        "k int, s int, v string, _change_type string, _commit_version long")
    got = {(r["k"], r["v"], r["_change_type"]) for r in cdc.changes_between(log, ["k"], ["s"], ["v"], 0).collect()}
    assert got == {(1, "a", "delete"), (2, "b", "delete"), (3, "c", "insert")}
    after = {(r["k"], r["v"], r["_change_type"]) for r in cdc.changes_between(log, ["k"], ["s"], ["v"], 1).collect()}
    assert after == {(3, "c", "insert")}
    assert {r["k"] for r in cdc.latest_per_key(log, ["k"], ["s"]).collect()} == {1, 2, 3}


def test_latest_per_key_of_ordered_columns_moves_them_once(spark):
    """Where the order holds every kept column, the greatest order is the row: no second copy and no hash."""
    rows = spark.createDataFrame([(1, 1, "b"), (1, 2, "a"), (1, 2, None), (2, None, "x"), (2, None, "y")], "k int, a int, s string")
    out = cdc.latest_per_key(rows, ["k"], ["a", "s"], ["s", "a"])
    assert out.columns == ["k", "s", "a"] and {tuple(r) for r in out.collect()} == {(1, "a", 2), (2, "y", None)}
    assert "max_by" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_file_keys_move_as_bytes(spark):
    """The joins with download results move keys of 32 bytes and give them back as they were."""
    from nestwork.operators import flatten as fl
    from nestwork.plans import file_plans as fp

    from .conftest import SF_SMALL

    rows = fp.located_files(spark, SF_SMALL)
    assert dict(rows.dtypes)["id"] == "binary" and rows.where(F.length("id") != 32).count() == 0
    want = fl.in_network_file_index(fp.flat_index(spark, SF_SMALL)).select("in_network_file_index_id")
    got = fp.q_file_status(spark, SF_SMALL).select("in_network_file_index_id")
    assert sorted(r[0] for r in got.collect()) == sorted(r[0] for r in want.collect())
    assert got.where(F.length("in_network_file_index_id") != 64).count() == 0
