"""Line dedup (operator 6): sorted hashes, first occurrences, keep bitmaps.

Lines become 128-bit hashes of their keys.  The hashes are range-partitioned on (key,
document, row, position) and sorted inside each partition, so one very common line spreads
over as many partitions as its rows need.  Each partition is streamed: inside a run of one
key, rows of the run's first document stay and all others go.  Only a partition's leading
run may have begun in an earlier partition; its first document's rows stay undecided and are
settled by a join with the first and last runs of all partitions (two rows for each).

The result holds no text: per document a zlib-compressed bitmap with one bit for each line.

Defined cases: a null or empty text is one empty line; a null doc_id is a document of its own
after all others; rows that repeat doc_id and text are one document and get equal bitmaps;
rows that share a doc_id but not the text are told apart by a text hash, and count as the
same document for "found in at least 2 documents"; an empty table gives empty results; extra
columns are ignored or, by ``dedup_lines``, returned as they are.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import quoted, row_struct, small_batches, text_of, written

#: Keys with fewer code points never count as repeated.
MIN_KEY = 10
# The bytes stripped from both ends of a line.
STRIP = b"\x20\x09\x0a\x0b\x0c\x0d"
_ROW = ["ld_doc", "ld_row"]


def _identity(text: Column) -> list[Column]:
    """A document's sort key (null last) and a hash that tells rows of one doc_id apart."""
    return [F.coalesce(F.col("doc_id"), F.lit(2 ** 63 - 1)).alias("ld_doc"), F.xxhash64(text).alias("ld_row")]


def _line_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(document, row, position, key) of every line whose key is long enough."""
    for batch in batches:
        docs, rows, where, pos, keys = batch.column(0), batch.column(1), [], [], []
        for n, text in enumerate(batch.column(2).to_pylist()):
            for i, line in enumerate(text.lower().split(b"\n")):  # bytes.lower() touches A-Z only
                line = line.strip(STRIP)
                if len(line) >= 4 * MIN_KEY or len(line) >= MIN_KEY and len(line.decode("utf-8", "replace")) >= MIN_KEY:
                    where.append(n)
                    pos.append(i)
                    keys.append(hashlib.blake2b(line, digest_size=16).digest())
        at = pa.array(where, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [docs.take(at), rows.take(at), pa.array(pos, pa.int32()), pa.array(keys, pa.binary())],
            names=["ld_doc", "ld_row", "pos", "key"])


def _first_occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stream one sorted partition.  kind 0: a line to drop; 1: undecided; 2: a run at the partition's edge.

    Holds the key and first document of the current run, no more.
    """
    names = ["kind", "ld_doc", "ld_row", "pos", "key"]
    key = first = None
    leading = True

    def rows(kind: int, batch: pa.RecordBatch, mask: np.ndarray) -> pa.RecordBatch:
        part = batch.filter(pa.array(mask))
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(part), kind, np.int32)), *part.columns], names=names)

    def edge() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([2], pa.int32()), pa.array([first], pa.int64()), pa.array([0], pa.int64()),
             pa.array([0], pa.int32()), pa.array([key], pa.binary())], names=names)

    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        doc = batch.column("ld_doc").to_numpy()
        col = batch.column("key")
        keys = np.frombuffer(b"".join(col.to_pylist()), dtype="S16").view("<u8").reshape(n, 2)
        new = np.ones(n, bool)
        new[1:] = (keys[1:] != keys[:-1]).any(axis=1)
        new[0] = key is None or col[0].as_py() != key
        start = np.maximum.accumulate(np.where(new, np.arange(n), -1))
        firsts = np.where(start >= 0, doc[np.maximum(start, 0)], first if first is not None else 0)
        lead = np.zeros(n, bool)
        if leading:
            later = np.flatnonzero(new[1:] if key is None else new)
            end = (later[0] + (key is None)) if len(later) else n
            lead[:end] = True
        yield rows(0, batch, doc != firsts)
        yield rows(1, batch, lead & (doc == firsts))
        if leading and end < n:  # the leading run is over
            key, first = (col[0].as_py(), int(doc[0])) if key is None else (key, first)
            yield edge()
            leading = False
        key, first = col[n - 1].as_py(), int(firsts[n - 1])
    if key is not None:
        yield edge()


def _bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From the dropped positions of each document its compressed keep bitmap."""
    for batch in batches:
        maps, n_dropped = [], []
        for n, drop in zip(batch.column("n_lines").to_pylist(), batch.column("dropped").to_pylist()):
            keep = np.ones(n, bool)
            keep[drop or []] = False
            n_dropped.append(n - int(keep.sum()))
            maps.append(zlib.compress(np.packbits(keep).tobytes(), 1))
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in (*_ROW, "n_lines")), pa.array(n_dropped, pa.int64()), pa.array(maps, pa.binary())],
            names=[*_ROW, "n_lines", "n_dropped", "keep"])


def keep_bitmaps(docs: DataFrame) -> DataFrame:
    """One row per document (ld_doc, ld_row): n_lines, n_dropped and the compressed bitmap ``keep``."""
    spark = docs.sparkSession
    small_batches(spark)
    text = text_of()
    lines = written(
        docs.select(*_identity(text), text.cast("binary").alias("text"))
        .mapInArrow(_line_keys, "ld_doc long, ld_row long, pos int, key binary"), "line-keys")
    order = ["key", "ld_doc", "ld_row", "pos"]
    found = written(
        lines.repartitionByRange(*order).sortWithinPartitions(*order)
        .mapInArrow(_first_occurrences, "kind int, ld_doc long, ld_row long, pos int, key binary"), "line-first")
    # at most two edge rows for each partition, whatever the input
    heads = found.where("kind = 2").groupBy("key").agg(F.min("ld_doc").alias("first"))
    settled = found.where("kind = 1").join(heads, "key").where("ld_doc > first").select(*_ROW, "pos")
    dropped = (found.where("kind = 0").select(*_ROW, "pos").unionAll(settled)
               .groupBy(*_ROW).agg(F.collect_set("pos").alias("dropped")))
    count = (F.octet_length(text) - F.octet_length(F.replace(text, F.lit("\n"), F.lit(""))) + 1).cast("long")
    sizes = docs.select(*_identity(text), count.alias("n_lines")).groupBy(*_ROW).agg(F.max("n_lines").alias("n_lines"))
    return sizes.join(dropped, _ROW, "left").mapInArrow(
        _bitmaps, "ld_doc long, ld_row long, n_lines long, n_dropped long, keep binary")


@F.pandas_udf(T.StringType())
def _kept_lines(text: pd.Series, keep: pd.Series) -> pd.Series:
    out = []
    for t, k in zip(text, keep):
        if t is None:
            out.append(None)
            continue
        lines = t.split("\n")
        bits = np.unpackbits(np.frombuffer(zlib.decompress(k), np.uint8), count=len(lines))
        out.append("\n".join(compress(lines, bits.tolist())))
    return pd.Series(out, dtype=object)


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """row (struct of the document's columns), n_lines, n_dropped and ``kept``, the text of the kept lines."""
    text = F.coalesce(F.col("row.text"), F.lit(""))
    keyed = docs.select(row_struct(docs), *_identity(text_of()))
    joined = keyed.join(bitmaps, _ROW)
    some = F.col("n_dropped") > 0
    kept = _kept_lines(F.when(some, text), F.when(some, F.col("keep")))  # other texts never leave the JVM
    return joined.select("row", "n_lines", "n_dropped", F.when(some, kept).otherwise(text).alias("kept"))


def dedup_lines(docs: DataFrame) -> DataFrame:
    """The documents with the text of their kept lines and n_chars to match; all columns stay, null texts become empty."""
    done = apply_bitmaps(docs, keep_bitmaps(docs))
    new = {"text": F.col("kept"), "n_chars": F.length("kept").cast("long")}
    return done.select(*[new[c].alias(c) if c in new else F.col(f"row.{quoted(c)}").alias(c) for c in docs.columns])


def line_dedup_table(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_dropped and the hash of the kept text of every document."""
    narrow = docs.select("doc_id", "text")
    done = apply_bitmaps(narrow, keep_bitmaps(narrow))
    return done.select(F.col("row.doc_id").alias("doc_id"), "n_lines", "n_dropped",
                       F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


#: DuckDB's view of the same rows.
ORACLE = r"""
WITH lines AS (
  SELECT doc_id, t.pos, t.line FROM documents,
    LATERAL (SELECT unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos) t),
keyed AS (
  SELECT doc_id, pos, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines),
firsts AS (
  SELECT k, min(doc_id) AS first_id FROM keyed WHERE length(k) >= 10
  GROUP BY k HAVING count(DISTINCT doc_id) >= 2),
marked AS (
  SELECT doc_id, pos, line, first_id IS NOT NULL AND first_id <> doc_id AS dropped
  FROM keyed LEFT JOIN firsts USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
