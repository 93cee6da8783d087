"""Language identification (operator 11): multinomial naive Bayes over hashed character n-grams.

A text is lower-cased and every code point that is no letter becomes a border, as do both ends.
Its features are the runs of 1 to 4 code points that hold a letter and no two borders side by
side, hashed into ``BUCKETS`` buckets.  ``train`` counts them per label over all its rows: each
task sums its own rows in numpy and gives one row per label and bucket, so the shuffle is
bounded by tasks x labels x buckets and a hot label is summed before it moves.  ``model`` turns
the counts into smoothed log probabilities, scaled to whole numbers: sums of these don't
depend on the order of the addends, so a prediction is the same however the rows are dealt out.

``predict`` scores whole batches: the n-grams of all texts of a batch index the broadcast
matrix, and the looked-up rows are summed text by text, a bounded piece at a time.  A matrix holds
``LABELS`` labels at most (4 bytes x ``BUCKETS`` x ``LABELS``, 8 MB); more labels are scored in
further passes, each of which carries on the best label and the sum of the others so far.

Defined cases: a null text, or one without a letter, is ``und`` with score 0, and teaches nothing;
null labels teach nothing; if nothing was learned, every text is ``und`` with score 0; ties go to
the smaller label; repeated rows count each time; a very long text is cut into overlapping pieces
whose n-grams are exactly those of the whole; extra columns are ignored or kept as asked.
A null doc_id is held out (as the crc32 of an empty text).
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import quoted, written

#: Longest n-gram, number of hash buckets (a power of two), added count of each bucket, labels scored at once.
LONGEST, BUCKET_BITS, SMOOTHING, LABELS = 4, 15, 0.1, 64
BUCKETS = 1 << BUCKET_BITS
#: Log probabilities are kept in these fractions of one.
SCALE = 1 << 16
#: Code points whose n-grams are hashed at once, and matrix cells that are looked up at once.
PIECE, CELLS = 1 << 18, 1 << 21
UNKNOWN = "und"
# Odd 64-bit multipliers of the hash.
STEP, MIX = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F


_LETTERS: dict[str, np.ndarray] = {}


def _letters() -> np.ndarray:
    """Each code point itself if it is a letter, else 0; made once for each task."""
    if "all" not in _LETTERS:
        _LETTERS["all"] = np.fromiter((i if chr(i).isalpha() else 0 for i in range(0x110000)), np.uint32, 0x110000)
    return _LETTERS["all"]


def _pieces(texts: Sequence[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(code points, text number, counts here?) of the padded texts, about ``PIECE`` at a time.

    A piece of a longer text repeats the last code points of the one before it, whose n-grams begin
    there; those that begin past a piece are not counted in it.
    """
    codes: list[np.ndarray] = []
    owner: list[np.ndarray] = []
    own: list[np.ndarray] = []
    size = 0
    for i, text in enumerate(texts):
        if not text:
            continue
        c = _letters()[np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)]
        c = np.concatenate([[0], c, [0]]).astype(np.uint64)
        for at in range(0, len(c), PIECE):
            piece = c[at:at + PIECE + LONGEST - 1]
            # two borders part the pieces, so no n-gram spans them
            codes += [piece, np.zeros(2, np.uint64)]
            owner.append(np.full(len(piece) + 2, i))
            own.append(np.arange(len(piece) + 2) < PIECE)
            size += len(piece) + 2
            if size >= PIECE:
                yield np.concatenate(codes), np.concatenate(owner), np.concatenate(own)
                codes, owner, own, size = [], [], [], 0
    if size:
        yield np.concatenate(codes), np.concatenate(owner), np.concatenate(own)


def features(texts: Sequence[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text number, bucket) of every n-gram, in the order of the texts, in bounded pieces."""
    for codes, owner, own in _pieces(texts):
        letter = codes != 0
        good, some, h = own.copy(), letter.copy(), codes
        parts = []
        for n in range(1, LONGEST + 1):
            if n > 1:
                m = len(codes) - n + 1
                good = good[:m] & (letter[n - 2:n - 2 + m] | letter[n - 1:])
                some = some[:m] | letter[n - 1:]
                h = h[:m] * np.uint64(STEP) + codes[n - 1:]
            at = np.flatnonzero(good & some)
            parts.append((owner[at], ((h[at] ^ np.uint64(n)) * np.uint64(MIX)) >> np.uint64(64 - BUCKET_BITS)))
        texts_, buckets = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
        order = np.argsort(texts_, kind="stable")
        yield texts_[order], buckets[order].astype(np.int64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of a task's rows; handed on whenever ``LABELS`` labels are held."""
    held: dict[str, np.ndarray] = {}

    def out() -> Iterator[pa.RecordBatch]:
        for label, counts in held.items():
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array([label] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(counts[at])],
                                             names=["label", "bucket", "n"])
        held.clear()

    for batch in batches:
        labels, texts = batch.column("label").to_pylist(), batch.column("text").to_pylist()
        for label in dict.fromkeys(labels):
            if label not in held and len(held) == LABELS:
                yield from out()
            counts = held.setdefault(label, np.zeros(BUCKETS, np.int64))
            for _, buckets in features([t for t, x in zip(texts, labels) if x == label]):
                counts += np.bincount(buckets, minlength=BUCKETS)
    yield from out()


def train(rows: DataFrame, text: str = "text", label: str = "lang") -> DataFrame:
    """Counts of all labelled rows: label, bucket (-1: the number of its texts with a letter), n."""
    some = rows.select(F.col(quoted(label)).cast("string").alias("label"), F.col(quoted(text)).cast("string").alias("text")).where(
        F.col("label").isNotNull() & F.col("text").rlike(r"\p{L}"))
    grams = some.mapInArrow(_count, "label string, bucket int, n long")
    texts = some.groupBy("label").agg(F.count(F.lit(1)).alias("n")).select("label", F.lit(-1).alias("bucket"), "n")
    return grams.groupBy("label", "bucket").agg(F.sum("n").alias("n")).unionByName(texts)


@dataclass
class Block:
    """Scaled log probabilities of some labels: ``matrix`` is buckets x labels, ``prior`` one for each label."""

    labels: list[str]
    prior: np.ndarray
    matrix: np.ndarray


def model(counts: DataFrame) -> list[Block]:
    """The blocks of ``LABELS`` labels, made one after the other from the stored counts.

    The driver holds the label names with two numbers each, and the matrices it hands out.
    """
    totals = sorted((r["label"], r["texts"], r["grams"]) for r in counts.groupBy("label").agg(
        F.sum(F.when(F.col("bucket") < 0, F.col("n"))).alias("texts"),
        F.coalesce(F.sum(F.when(F.col("bucket") >= 0, F.col("n"))), F.lit(0)).alias("grams")).collect())
    texts = sum(t[1] for t in totals)
    blocks = []
    for at in range(0, len(totals), LABELS):
        part = totals[at:at + LABELS]
        names = [t[0] for t in part]
        found = counts.where((F.col("bucket") >= 0) & F.col("label").between(names[0], names[-1])).toArrow()
        n = np.zeros((BUCKETS, len(part)))
        column = {x: i for i, x in enumerate(names)}
        n[found["bucket"].to_numpy(), [column[x] for x in found["label"].to_pylist()]] = found["n"].to_numpy()
        grams = np.array([t[2] for t in part], float)
        logs = np.log(n + SMOOTHING) - np.log(grams + SMOOTHING * BUCKETS)
        blocks.append(Block(names, np.array([round(math.log(t[1] / texts) * SCALE) for t in part], np.int64),
                            np.rint(logs * SCALE).astype(np.int32)))
    return blocks


def scores(texts: Sequence[str | None], block: Block) -> tuple[np.ndarray, np.ndarray]:
    """(does the text hold a letter?, texts x labels scaled log likelihoods with priors)."""
    out = np.tile(block.prior, (len(texts), 1))
    known = np.zeros(len(texts), bool)
    step = max(1, CELLS // len(block.labels))
    for owner, buckets in features(texts):
        for at in range(0, len(owner), step):
            own = owner[at:at + step]
            first = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
            out[own[first]] += np.add.reduceat(block.matrix[buckets[at:at + step]], first, axis=0, dtype=np.int64)
            known[own[first]] = True
    return known, out


def _scorer(block, keep: list[str], last: bool) -> Callable:
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b = block.value
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            known, s = scores(batch.column("_text").to_pylist(), b)
            best = s.argmax(axis=1)  # the first, so the smaller label
            top = s[np.arange(n), best]
            rest = np.exp((s - top[:, None]) / SCALE).sum(axis=1)
            name = [b.labels[i] for i in best]
            # the best so far, and the sum of all likelihoods in units of it
            old_name, old_top, old_rest = (batch.column(c).to_pylist() for c in ("_name", "_top", "_rest"))
            for i in range(n):
                if old_name[i] is not None:
                    wins = top[i] > old_top[i]
                    both = max(int(top[i]), old_top[i])
                    rest[i] = rest[i] * math.exp((int(top[i]) - both) / SCALE) + old_rest[i] * math.exp((old_top[i] - both) / SCALE)
                    if not wins:
                        name[i], top[i] = old_name[i], old_top[i]
            columns = {c: batch.column(c) for c in keep}
            if last:
                columns["_label"] = pa.array([x if k else UNKNOWN for x, k in zip(name, known)], pa.string())
                columns["_score"] = pa.array(np.where(known, 1 / rest, 0.0))
            else:
                columns |= {"_text": batch.column("_text"), "_name": pa.array(name, pa.string()), "_top": pa.array(top), "_rest": pa.array(rest)}
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))
    return score


def predict(rows: DataFrame, blocks: list[Block], text: str = "text", keep: Sequence[str] = ()) -> DataFrame:
    """The ``keep`` columns of all rows with ``lang_pred`` and ``score``."""
    spark, keep = rows.sparkSession, list(keep)
    kept = [F.col(quoted(c)) for c in keep]
    if not blocks:
        return rows.select(*kept, F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    inner = [f"k{i}" for i in range(len(keep))]  # helper names never clash with kept ones
    work = rows.select(*[c.alias(n) for c, n in zip(kept, inner)], F.col(quoted(text)).cast("string").alias("_text"),
                       F.lit(None).cast("string").alias("_name"), F.lit(None).cast("long").alias("_top"), F.lit(None).cast("double").alias("_rest"))
    fields = work.schema.fields
    for n, block in enumerate(blocks):
        last = n == len(blocks) - 1
        out = fields[:len(keep)] + [T.StructField("_label", T.StringType()), T.StructField("_score", T.DoubleType())] if last else fields
        scored = work.mapInArrow(_scorer(spark.sparkContext.broadcast(block), inner, last), T.StructType(out))
        work = scored if last else written(scored, "language-pass")
    return work.select(*[F.col(n).alias(c) for n, c in zip(inner, keep)], F.col("_label").alias("lang_pred"), F.col("_score").alias("score"))


def held_out(doc_id: str = "doc_id") -> Column:
    """The fixed fifth of the documents that nothing is learned from."""
    return F.crc32(F.coalesce(F.col(quoted(doc_id)).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def language_table(documents: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred, score.  Labels are read from the other four fifths only."""
    counts = written(train(documents.where(~held_out())), "language-counts")
    rows = documents.select(F.col("doc_id"), held_out().alias("held_out"), "text")
    return predict(rows, model(counts), keep=["doc_id", "held_out"])
