"""Change data: latest row per key, SCD type 1 apply, change-feed production
(T4-T8, W1, S12).

``apply_scd1`` is a keyed reduction, ``max_by(row, order)`` per key, so it is
a two-phase aggregation: a hot key collapses map-side to one row per
partition before the shuffle.  The order is (sequence..., operation rank,
row hash): total, so shuffled and replayed input give one answer.  Deletes are
kept as tombstones while reducing (so a late, lower-sequence update cannot
revive a deleted key) and dropped on output.  A truncate removes every row
whose sequence is at or below the latest truncate; it is a scalar subquery,
not a join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Change types and their rank when two rows share a sequence.
OP_RANK = {"insert": 0, "update_postimage": 1, "update": 1, "delete": 2}


def op_rank(change_col: str = "_change_type") -> Column:
    out = F.lit(1)
    for k, v in OP_RANK.items():
        out = F.when(F.col(change_col) == k, F.lit(v)).otherwise(out)
    return out


def not_preimage(change_col: str = "_change_type") -> Column:
    """Rows to apply: everything but the image before an update; a row without a type counts."""
    return ~F.coalesce(F.col(change_col) == "update_preimage", F.lit(False))


def sequence_struct(sequence_by: Sequence[str]) -> Column:
    return F.struct(*[F.col(c).alias(f"s{i}") for i, c in enumerate(sequence_by)])


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str],
                   columns: Sequence[str] | None = None) -> DataFrame:
    """The row with the greatest ``order_by`` per key (partial aggregation).

    Truncate marks and update preimages are not rows of a key and are left out.  Where ``order_by`` holds every
    column kept, the greatest ``order_by`` is the row, and nothing else moves."""
    if "_change_type" in df.columns:
        df = df.where(~F.coalesce(F.col("_change_type").isin("truncate", "update_preimage"), F.lit(False)))
    columns = [c for c in (columns or df.columns) if c not in keys]
    if set(columns) <= set(order_by):
        return df.groupBy(*keys).agg(F.max(F.struct(*order_by)).alias("_r")).select(*keys, *[F.col("_r")[c].alias(c) for c in columns])
    order = F.struct(*[F.col(c) for c in order_by], F.xxhash64(*[F.col(c) for c in df.columns]))
    return (df.groupBy(*keys).agg(F.max_by(F.struct(*columns), order).alias("_r"))
            .select(*keys, "_r.*"))


def apply_scd1(changes: DataFrame, keys: Sequence[str], sequence_by: Sequence[str],
               delete_when: str | None = "_change_type = 'delete'",
               truncate_when: str | None = "_change_type = 'truncate'",
               except_columns: Sequence[str] = ("_change_type", "_commit_version", "_commit_timestamp"),
               keep_tombstones: bool = False) -> DataFrame:
    """Current state (SCD type 1) from a change log in any order."""
    seq = sequence_struct(sequence_by)
    if truncate_when:
        is_trunc = F.coalesce(F.expr(truncate_when), F.lit(False))
        cut = changes.where(is_trunc).agg(F.max(seq)).scalar()
        changes = changes.where(~is_trunc).where(cut.isNull() | (seq > cut))
    changes = changes.where(not_preimage()) if "_change_type" in changes.columns else changes
    is_delete = F.coalesce(F.expr(delete_when), F.lit(False)) if delete_when else F.lit(False)
    rank = op_rank() if "_change_type" in changes.columns else F.lit(1)
    value_cols = [c for c in changes.columns if c not in keys and c not in except_columns]
    order = F.struct(seq.alias("seq"), rank.alias("rank"), F.xxhash64(*[F.col(c) for c in changes.columns]).alias("h"))
    reduced = changes.groupBy(*keys).agg(
        F.max_by(F.struct(*[F.col(c) for c in value_cols], is_delete.alias("_deleted"), seq.alias("_seq")), order)
        .alias("_r"))
    out = reduced.select(*keys, "_r.*")
    if keep_tombstones:
        return out
    return out.where(~F.col("_deleted")).drop("_deleted", "_seq")


def changes_since(log: DataFrame, version: int, version_col: str = "_commit_version") -> DataFrame:
    """The change feed from version ``version`` on (prunes a partitioned log)."""
    return log.where(F.col(version_col) >= F.lit(version))


def snapshot_diff(before: DataFrame, after: DataFrame, keys: Sequence[str],
                  value_cols: Sequence[str]) -> DataFrame:
    """T4: change rows between two snapshots (insert, delete, update pre/post image).

    A full outer join on the key; each changed key yields two rows through one
    ``explode`` (no pairing beyond the key)."""
    b = before.select(*keys, F.struct(*value_cols).alias("_b"))
    a = after.select(*keys, F.struct(*value_cols).alias("_a"))
    j = b.join(a, list(keys), "full_outer")
    rows = F.when(F.col("_b").isNull(), F.array(F.struct(F.lit("insert").alias("ct"), F.col("_a").alias("v")))) \
        .when(F.col("_a").isNull(), F.array(F.struct(F.lit("delete").alias("ct"), F.col("_b").alias("v")))) \
        .when(~F.col("_a").eqNullSafe(F.col("_b")),
              F.array(F.struct(F.lit("update_preimage").alias("ct"), F.col("_b").alias("v")),
                      F.struct(F.lit("update_postimage").alias("ct"), F.col("_a").alias("v"))))
    return (j.select(*keys, F.explode(rows).alias("_x"))
            .select(*keys, "_x.v.*", F.col("_x.ct").alias("_change_type")))


def changes_between(log: DataFrame, keys: Sequence[str], sequence_by: Sequence[str], value_cols: Sequence[str],
                    from_version, version_col: str = "_commit_version",
                    delete_when: str | None = "_change_type = 'delete'",
                    truncate_when: str | None = "_change_type = 'truncate'") -> DataFrame:
    """T4 from ONE aggregation: the state after ``from_version`` and the latest
    state come from two conditional ``max_by`` in the same partial aggregation
    (rows past ``from_version`` have a NULL order for the first and are
    skipped), then each key yields its change rows.  No second pass, no join.
    ``from_version`` may be a literal or a scalar-subquery Column.  A truncate ends every row at
    or below its sequence, in the first state only if it was committed by then; the two cuts are
    scalar subqueries."""
    if "_change_type" in log.columns:
        log = log.where(not_preimage())
    seq = sequence_struct(sequence_by)
    in_before = F.col(version_col) <= (from_version if isinstance(from_version, Column) else F.lit(from_version))
    alive_b = alive_a = F.lit(True)
    if truncate_when and "_change_type" in log.columns:
        is_trunc = F.coalesce(F.expr(truncate_when), F.lit(False))
        cut_b = log.where(is_trunc & in_before).agg(F.max(seq)).scalar()
        cut_a = log.where(is_trunc).agg(F.max(seq)).scalar()
        log = log.where(~is_trunc)
        alive_b, alive_a = cut_b.isNull() | (seq > cut_b), cut_a.isNull() | (seq > cut_a)
    rank = op_rank() if "_change_type" in log.columns else F.lit(1)
    order = F.struct(seq.alias("seq"), rank.alias("rank"), F.xxhash64(*[F.col(c) for c in log.columns]).alias("h"))
    is_delete = F.coalesce(F.expr(delete_when), F.lit(False)) if delete_when else F.lit(False)
    row = F.struct(*[F.col(c) for c in value_cols], is_delete.alias("_deleted"))
    both = log.groupBy(*keys).agg(F.max_by(row, F.when(in_before & alive_b, order)).alias("_b"),
                                  F.max_by(row, F.when(alive_a, order)).alias("_a"))
    live_b = F.col("_b").isNotNull() & ~F.col("_b._deleted")
    live_a = F.col("_a").isNotNull() & ~F.col("_a._deleted")
    vb = F.struct(*[F.col(f"_b.{c}").alias(c) for c in value_cols])
    va = F.struct(*[F.col(f"_a.{c}").alias(c) for c in value_cols])
    rows = (F.when(~live_b & live_a, F.array(F.struct(F.lit("insert").alias("ct"), va.alias("v"))))
            .when(live_b & ~live_a, F.array(F.struct(F.lit("delete").alias("ct"), vb.alias("v"))))
            .when(live_b & live_a & ~va.eqNullSafe(vb),
                  F.array(F.struct(F.lit("update_preimage").alias("ct"), vb.alias("v")),
                          F.struct(F.lit("update_postimage").alias("ct"), va.alias("v")))))
    return (both.select(*keys, F.explode(rows).alias("_x"))
            .select(*keys, "_x.v.*", F.col("_x.ct").alias("_change_type")))
