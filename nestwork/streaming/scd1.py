"""Streaming SCD type 1 target without MERGE (T5-T8 in a stream), kept as a log of deltas.

The target is a folder on shared storage.  Keys hash into ``n_buckets`` buckets; a bucket is a base and the
deltas after it.  For micro-batch ``b`` the sink:

1. reduces the batch per key (``max_by`` on sequence, partial aggregation) and writes the winners
   to ``data/_version=b/_bucket=k``: deltas, so a batch costs what its rows cost, not what the state does;
2. a touched bucket that has ``max_deltas`` deltas is compacted in the same write: its base and deltas
   are reduced together with the batch's rows and become its new base;
3. writes a small pointer ``pointer/v=b``: for each bucket its base and deltas, and the highest truncate so far.

Batch ``b+1`` reads that one pointer.  A reader takes the files that the latest pointer names and reduces
them once more; ``max_by`` is associative, so this equals reducing the whole history.

Reads only ever look at versions below the running batch, and a replayed
batch overwrites its own version, so a retried or replayed batch is
idempotent and the file sink's commit protocol keeps partial output invisible.
Deletes stay as tombstones, so a late lower-sequence row cannot revive a
deleted key; a truncate hides every row at or below its sequence, also one that only arrives in a later
batch: it is one value in the pointer, no bucket is rewritten for it.  ``retire`` deletes versions that no
recent pointer names.  The number of buckets is stored with the
target, and another number is refused.  Only a missing path means "no batch
yet"; any other failure of a read is raised.  The driver only ever handles
bucket numbers, version numbers and one sequence value.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.cdc import not_preimage, op_rank, sequence_struct


def _none_first(sequence) -> tuple:
    """A sequence value that Python can compare, nulls lowest."""
    return tuple((v is not None, v) if v is not None else (False, 0) for v in sequence)


class Pointer:
    """What a batch left behind: bucket -> (base version or None, delta versions), and the highest truncate."""

    def __init__(self, buckets: dict[int, tuple[int | None, list[int]]], cut: tuple | None):
        self.buckets, self.cut = buckets, cut

    def files(self, buckets: Sequence[int] | None = None) -> list[tuple[int, int]]:
        """(version, bucket) of everything that counts."""
        return [(v, b) for b, (base, deltas) in sorted(self.buckets.items()) if buckets is None or b in buckets
                for v in ([] if base is None else [base]) + deltas]


class Scd1Target:
    """SCD type 1 target folder.  Size ``n_buckets`` so one bucket of state is
    roughly 128-512 MB (state bytes / 256 MB): a compacted bucket is rewritten by
    one task, and a micro-batch writes only deltas of the buckets its keys hash to."""

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str], sequence_by: Sequence[str],
                 columns: Sequence[str], n_buckets: int = 16,
                 delete_when: str = "_change_type = 'delete'", truncate_when: str = "_change_type = 'truncate'",
                 max_deltas: int = 8):
        self.spark, self.root = spark, root.rstrip("/")
        self.keys, self.sequence_by, self.columns = list(keys), list(sequence_by), list(columns)
        self.n_buckets, self.delete_when, self.truncate_when = n_buckets, delete_when, truncate_when
        self.max_deltas = max_deltas

    # ---------------------------------------------------------------- layout
    def _bucket(self):
        return F.pmod(F.xxhash64(*[F.col(k) for k in self.keys]), F.lit(self.n_buckets)).cast("int")

    def _read_or_none(self, path: str) -> DataFrame | None:
        """The table at ``path``, None if there is no such path; other failures are raised."""
        try:
            return self.spark.read.parquet(path)
        except AnalysisException as e:
            if e.getCondition() == "PATH_NOT_FOUND":
                return None
            raise

    def _check_buckets(self, store: bool) -> None:
        """The number of buckets belongs to the target's layout."""
        meta = self._read_or_none(f"{self.root}/meta")
        if meta is None:
            if store:
                self.spark.createDataFrame([(self.n_buckets,)], "n_buckets int").write.mode("overwrite").parquet(f"{self.root}/meta")
            return
        stored = meta.first()["n_buckets"]
        if stored != self.n_buckets:
            raise ValueError(f"the target has {stored} buckets, not {self.n_buckets}")

    def _pointer_at(self, version: int) -> Pointer | None:
        table = self._read_or_none(f"{self.root}/pointer/v={version}")
        if table is None:
            return None
        rows = table.collect()  # a row for each bucket, and one for the truncate
        cut = next((r["cut"] for r in rows if r["bucket"] < 0), None)
        return Pointer({r["bucket"]: (r["base"], list(r["deltas"])) for r in rows if r["bucket"] >= 0}, None if cut is None else tuple(cut))

    def _versions(self) -> list[int]:
        table = self._read_or_none(f"{self.root}/pointer")
        return [] if table is None else [r["v"] for r in table.select(F.col("v").cast("long").alias("v")).distinct().collect()]

    def _latest_pointer(self, below: int | None) -> Pointer:
        """The pointer before batch ``below``: the previous batch's (one small read), else the latest one found by listing."""
        if below:
            found = self._pointer_at(below - 1)
            if found is not None:
                return found
        known = [v for v in self._versions() if below is None or v < below]
        return (self._pointer_at(max(known)) if known else None) or Pointer({}, None)

    def _read_state(self, pointer: Pointer, buckets: Sequence[int] | None = None) -> DataFrame | None:
        """Rows of the files that count, truncated ones left out; not yet reduced."""
        files = pointer.files(None if buckets is None else set(buckets))
        if not files:
            return None
        by_version: dict[int, list[int]] = {}
        for v, b in files:
            by_version.setdefault(v, []).append(b)
        rows = self.spark.read.option("basePath", f"{self.root}/data").parquet(*[f"{self.root}/data/_version={v}" for v in sorted(by_version)])
        counts = F.lit(False)
        for v, bs in sorted(by_version.items()):  # partition filters: other folders are not read
            counts = counts | ((F.col("_version") == v) & F.col("_bucket").isin(bs))
        return self._cut(rows.where(counts).drop("_version", "_bucket"), pointer.cut)

    def _cut(self, rows: DataFrame, cut: tuple | None) -> DataFrame:
        if cut is None:
            return rows
        return rows.where(F.col("_seq") > F.struct(*[F.lit(c).alias(f"s{i}") for i, c in enumerate(cut)]))

    # --------------------------------------------------------------- reduce
    def _reduce(self, rows: DataFrame) -> DataFrame:
        """Latest row per key over batch and state rows together: one shuffle, partial aggregation."""
        order = F.struct(F.col("_seq"), F.col("_rank"),
                         F.xxhash64(*[F.col(c) for c in rows.columns]).alias("h"))
        vals = [c for c in rows.columns if c not in self.keys]
        return (rows.groupBy(*self.keys).agg(F.max_by(F.struct(*[F.col(c) for c in vals]), order).alias("_r"))
                .select(*self.keys, "_r.*"))

    def apply_batch(self, batch: DataFrame, batch_id: int) -> None:
        self._check_buckets(store=True)
        batch = batch.select(*self.keys, *[c for c in self.columns if c not in self.keys],
                             *[c for c in ("_change_type",) if c in batch.columns and c not in self.columns])
        # the micro-batch is read twice (facts, merge): keep it for this batch only;
        # a lost executor recomputes it from the micro-batch source
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        seq = sequence_struct(self.sequence_by)
        is_trunc = F.coalesce(F.expr(self.truncate_when), F.lit(False)) if self.truncate_when else F.lit(False)
        # one small job: the latest truncate and the touched buckets (<= n_buckets ids)
        facts = batch.agg(F.max(F.when(is_trunc, seq)).alias("cut"),
                          F.collect_set(F.when(~is_trunc, self._bucket())).alias("buckets")).first()
        before, new = self._latest_pointer(batch_id), facts["cut"]
        raised = new is not None and (before.cut is None or _none_first(new) > _none_first(before.cut))
        cut = tuple(new) if raised else before.cut
        touched = sorted(facts["buckets"])
        after = dict(before.buckets)
        if touched:
            changes = batch.where(~is_trunc)
            has_type = "_change_type" in changes.columns
            if has_type:
                changes = changes.where(not_preimage())
            is_delete = F.coalesce(F.expr(self.delete_when), F.lit(False)) if self.delete_when else F.lit(False)
            values = [c for c in changes.columns if c not in self.keys and c != "_change_type"]
            rows = changes.select(*self.keys, *values, is_delete.alias("_deleted"), seq.alias("_seq"),
                                  (op_rank() if has_type else F.lit(1)).alias("_rank"))
            full = [b for b in touched if len(before.buckets.get(b, (None, []))[1]) >= self.max_deltas]
            old = self._read_state(Pointer(before.buckets, cut), full) if full else None
            rows = self._cut(rows, cut)
            if old is not None:
                rows = rows.unionByName(old.select(*rows.columns))
            (self._reduce(rows).withColumn("_bucket", self._bucket()).repartitionByRange(len(touched), "_bucket")
             .write.mode("overwrite").partitionBy("_bucket").parquet(f"{self.root}/data/_version={batch_id}"))
            for b in touched:
                base, deltas = after.get(b, (None, []))
                after[b] = (batch_id, []) if b in full else (base, [*deltas, batch_id])
        self._write_pointer(batch_id, after, cut, batch)
        batch.unpersist()

    def _write_pointer(self, batch_id: int, buckets: dict, cut: tuple | None, batch: DataFrame) -> None:
        """Written after the data; readers need only this file."""
        cut_type = T.StructType([T.StructField(f"s{i}", batch.schema[c].dataType) for i, c in enumerate(self.sequence_by)])
        schema = T.StructType([T.StructField("bucket", T.IntegerType()), T.StructField("base", T.LongType()),
                               T.StructField("deltas", T.ArrayType(T.LongType())), T.StructField("cut", cut_type)])
        rows = [(-1, None, [], cut)] + [(b, base, deltas, None) for b, (base, deltas) in sorted(buckets.items())]
        self.spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(f"{self.root}/pointer/v={batch_id}")

    # ----------------------------------------------------------------- read
    def current(self, keep_tombstones: bool = False) -> DataFrame:
        self._check_buckets(store=False)
        pointer = self._latest_pointer(None)
        state = self._read_state(pointer)
        if state is None:
            raise ValueError("no batch has been applied yet")
        state = self._reduce(state)
        if keep_tombstones:
            return state
        return state.where(~F.col("_deleted")).drop("_deleted", "_seq", "_rank")

    def retire(self, keep: int = 2) -> list[int]:
        """Delete data and pointers that the last ``keep`` pointers don't need; returns the deleted data versions.

        Run it between batches: a reader that began on an older pointer may still need its files."""
        known = sorted(self._versions())
        recent = known[-max(1, keep):]
        needed = {v for p in recent for v, _ in self._pointer_at(p).files()}
        gone = [v for v in known if v not in needed and v not in recent]
        for v in gone:
            self._delete(f"{self.root}/data/_version={v}")
        for v in known[:-max(1, keep)]:
            self._delete(f"{self.root}/pointer/v={v}")
        return gone

    def _delete(self, path: str) -> None:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).delete(p, True)

    def foreach_batch(self):
        return lambda df, batch_id: self.apply_batch(df, batch_id)
