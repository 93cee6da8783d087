"""Prefix scan of long sequences that are spread over many tasks: places and prefix hashes.

Rows are range-partitioned by sequence and order, so a sequence with a third of all rows is
spread over many tasks.  Each task walks its rows once and gives every row its place and the
hash of its prefix, counted from the task's first row of that sequence.  Hashes are
polynomials modulo the prime 2^61 - 1 under two bases, so the prefix of what came before can be
put in front afterwards: only the last sequence of a task can go on in the next one, so one row for
each task, with its length and hash there, tells what came before.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import written

# The prime and the two bases of the hashes.
PRIME = (1 << 61) - 1
BASES = (0x1F3D5B79A2C4E681 % PRIME, 0x0B7E151628AED2A6 % PRIME)
#: The hash of the empty prefix.
EMPTY = (0, 0)


def digest_of(*columns: Column) -> Column:
    """32 hex digits that stand for the columns' texts; each length goes before its text."""
    parts = [x for c in columns for x in (F.length(c).cast("string"), F.lit(":"), c)]
    return F.substring(F.sha2(F.concat(*parts).cast("binary"), 256), 1, 32)


def values(digest: str) -> tuple[int, int]:
    """The two numbers of an element; never 0, so a longer prefix never keeps its hash."""
    return int(digest[:16], 16) % (PRIME - 1) + 1, int(digest[16:], 16) % (PRIME - 1) + 1


def extended(h: tuple[int, int], x: tuple[int, int]) -> tuple[int, int]:
    return (h[0] * BASES[0] + x[0]) % PRIME, (h[1] * BASES[1] + x[1]) % PRIME


def joined(before: tuple[int, int], after: tuple[int, int], n: int) -> tuple[int, int]:
    """The hash of a prefix followed by ``n`` elements with the hash ``after``."""
    return tuple((b * pow(base, n, PRIME) + a) % PRIME for b, a, base in zip(before, after, BASES))


def _walk(key: str, hashed: bool) -> Callable:
    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        now, n, h = object(), 0, EMPTY
        for batch in batches:
            keys = batch.column(key).to_pylist()
            digests = batch.column("digest").to_pylist() if hashed else keys
            place, own, above = [], [], []
            for k, d in zip(keys, digests):
                if k != now:
                    now, n, h = k, 0, EMPTY
                n += 1
                place.append(n)
                if hashed:
                    above.append(h)
                    h = extended(h, values(d))
                    own.append(h)
            more = {"part": pa.array([part] * len(keys), pa.int32()), "pos": pa.array(place, pa.int64())}
            if hashed:
                more |= {f"{name}{i + 1}": pa.array([x[i] for x in column], pa.int64()) for name, column in (("k", own), ("p", above)) for i in (0, 1)}
            yield pa.RecordBatch.from_arrays([*batch.columns, *more.values()], names=[*batch.schema.names, *more])
    return walk


def _shift(key: str, before, hashed: bool) -> Callable:
    def shift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = before.value
        for batch in batches:
            part = batch.column("part").to_pylist()
            keys = batch.column(key).to_pylist()
            at = [(i, table[x]) for i, x in enumerate(zip(keys, part)) if x in table]
            columns = {c: batch.column(c) for c in batch.schema.names}
            if at:
                pos = columns["pos"].to_pylist()
                hashes = {c: columns[c].to_pylist() for c in ("k1", "k2", "p1", "p2") if hashed}
                for i, (n, h) in at:
                    if hashed:
                        for name, m in (("k", pos[i]), ("p", pos[i] - 1)):
                            hashes[name + "1"][i], hashes[name + "2"][i] = joined(h, (hashes[name + "1"][i], hashes[name + "2"][i]), m)
                    pos[i] += n
                columns |= {c: pa.array(v, pa.int64()) for c, v in {"pos": pos, **hashes}.items()}
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))
    return shift


def scan(rows: DataFrame, key: str, order: list[Column], name: str, hashed: bool = True) -> DataFrame:
    """``rows`` with ``part``, ``pos`` (from 1 in its sequence) and, if ``hashed``, ``k1, k2`` (the hash of
    the prefix up to the row, from its ``digest``) and ``p1, p2`` (of the one before).

    The result is stored in order: all rows of a sequence with equal ``part`` stand together.
    """
    longs = ["k1", "k2", "p1", "p2"] if hashed else []
    schema = T.StructType([*rows.schema.fields, T.StructField("part", T.IntegerType()),
                           *[T.StructField(c, T.LongType()) for c in ["pos", *longs]]])
    order = [F.col(key), *order]
    walked = written(rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_walk(key, hashed), schema), name)
    # one row for each task: its first sequence, and its last one with place and hash
    bounds = sorted(walked.groupBy("part").agg(F.min(F.struct(key)).alias("first"), F.max(F.struct(key, "pos", *longs[:2])).alias("last")).collect())
    before, open_, n, h = {}, object(), 0, EMPTY
    for b in bounds:
        first, last = b["first"][0], b["last"]
        if first == open_:
            before[first, b["part"]] = (n, h)
        else:
            n, h = 0, EMPTY
        if last[0] != first:
            n, h = 0, EMPTY
        if hashed:
            h = joined(h, (last["k1"], last["k2"]), last["pos"])
        open_, n = last[0], n + last["pos"]
    if not before:
        return walked
    return walked.mapInArrow(_shift(key, rows.sparkSession.sparkContext.broadcast(before), hashed), schema)
