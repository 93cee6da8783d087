"""MinHash near-dedup (operator 9): BagMinHash signatures, bands, exact multiset overlap.

A text is the multiset of its five-word shingles (white-space words; fewer than five words
are one shingle).  BagMinHash gives each shingle a hierarchy of Poisson processes over its
discretised weight (its count): strips [0,1), [1,2), [2,4), [4,8) ... with the strip's width
as rate; points of the topmost, partly covered strip count only below the weight.  Each
point has a time and one of ``M`` registers; a register keeps its earliest point, so two
texts agree in a register with a probability equal to their weighted Jaccard similarity.
Points are made in order of time, and a process stops once it is later than every register.

``BANDS`` bands of ``ROWS`` registers make buckets (a pair at 0.8 is missed with probability
5e-8).  Links are checked on the exact multisets:

1. every text against the first text of each of its buckets; verified links give classes;
2. buckets that still hold several classes are cut into blocks; inside each pair of blocks
   all texts of different classes are compared, and links that join classes are returned.

So no link that could join two classes is lost.  Copies and linked groups cost one check for
each text and bucket; only buckets full of texts that are alike but not linked are compared
wholly, block by block, in tasks of bounded memory.

Equal texts share one node (64-bit hash), so exact copies never meet as pairs.  Buckets are
counted by partial aggregates; joins on buckets, nodes and classes can be split by AQE.

Defined cases: a null text is an empty one; texts without words are in one class only with
equal texts; repeated rows share a class; class_id is the least doc_id of the class (null if
it has none); an empty table gives an empty result; extra columns pass through ``keep_first``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import row_struct, small_batches, text_of, unpacked, written

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 32, 4
M = BANDS * ROWS
#: Bounds of a block of one bucket, in texts and shingles.
BLOCK_TEXTS, BLOCK_TOKENS = 512, 500_000

_U = np.uint64
_SOLID = np.ones(256, bool)
_SOLID[[0x20, *range(0x09, 0x0E)]] = False
_POW = np.cumprod(np.full(1 << 16, 0x9E3779B97F4A7C15 | 1, _U))
_STEP = np.array([0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3,
                  0x589965CC75374CC3], _U)


def _mix(x: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of SplitMix."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def word_hashes(text: bytes) -> np.ndarray:
    """A 64-bit hash of every word, computed over the whole byte buffer at once."""
    raw = np.frombuffer(text, np.uint8)
    solid = _SOLID[raw]
    edges = np.flatnonzero(np.diff(solid, prepend=False, append=False))
    starts, lengths = edges[::2], edges[1::2] - edges[::2]
    if not len(starts):
        return np.empty(0, _U)
    first = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    inside = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
    terms = (raw[solid].astype(_U) + _U(1)) * _POW[inside & 0xFFFF]
    return _mix(np.add.reduceat(terms, first) + lengths.astype(_U))


def shingles(text: bytes) -> np.ndarray:
    """Sorted hashes of the text's shingles, one for each occurrence."""
    words = word_hashes(text)
    n = len(words) - SHINGLE + 1
    if n >= 1:
        return np.sort(_mix(sum((words[i:i + n] * _STEP[i] for i in range(SHINGLE)), np.zeros(n, _U))))
    if not len(words):
        return words
    return _mix(np.array([np.sum(words * _STEP[:len(words)]) + _U(len(words))], _U))


def weighted_jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Multiset overlap of two sorted arrays: sum of least counts over sum of largest."""
    if not len(a) or not len(b):
        return 0.0
    ka, ca = np.unique(a, return_counts=True)
    kb, cb = np.unique(b, return_counts=True)
    _, ia, ib = np.intersect1d(ka, kb, assume_unique=True, return_indices=True)
    both = int(np.minimum(ca[ia], cb[ib]).sum())
    return both / (len(a) + len(b) - both)


def bag_signature(sorted_shingles: np.ndarray, m: int = M) -> np.ndarray:
    """The BagMinHash signature: the identity (64 bits) of the earliest point of each register."""
    element, weight = np.unique(sorted_shingles, return_counts=True)
    bases, rates, lows, tops = [element], [np.ones(len(element))], [np.zeros(len(element), np.int64)], [weight]
    low = 1
    while low < int(weight.max()):
        over = weight > low
        bases.append(_mix(element[over] + _U(low * 0x9FB21C651E98DF25 & (1 << 64) - 1)))
        rates.append(np.full(int(over.sum()), float(low)))
        lows.append(np.full(int(over.sum()), low, np.int64))
        tops.append(weight[over])
        low *= 2
    base, rate, low, top = (np.concatenate(x) for x in (bases, rates, lows, tops))
    time, at = np.full(m, np.inf), np.zeros(m, _U)
    clock, k = np.zeros(len(base)), 0
    while len(base):
        points = max(1, 1024 // len(base))  # several points of each process at a time, if there are few
        draw = _mix(base[:, None] + np.arange(k + 1, k + points + 1, dtype=_U)[None, :] * _U(0x9E3779B97F4A7C15))
        gap = -np.log(((draw >> _U(11)).astype(np.float64) + 0.5) * 2.0 ** -53) / rate[:, None]
        when = clock[:, None] + np.cumsum(gap, axis=1)
        more = _mix(draw ^ _U(0x2545F4914F6CDD1D))
        level = low[:, None] + ((more >> _U(32)).astype(np.float64) * 2.0 ** -32 * rate[:, None]).astype(np.int64)
        ok = level < top[:, None]
        register, t, who = (more % _U(m)).astype(np.int64)[ok], when[ok], draw[ok]
        better = t < time[register]
        register, t, who = register[better], t[better], who[better]
        late_first = np.argsort(-t, kind="stable")
        time[register[late_first]], at[register[late_first]] = t[late_first], who[late_first]
        clock, k = when[:, -1], k + points
        going = clock < time.max()
        base, rate, low, top, clock = base[going], rate[going], low[going], top[going], clock[going]
    return at


def band_hashes(signature: np.ndarray) -> np.ndarray:
    """One 64-bit bucket for each band; the band's number is part of it."""
    rows = signature.reshape(BANDS, ROWS)
    out = np.arange(1, BANDS + 1, dtype=_U)
    for r in range(ROWS):
        out = _mix(out * _U(0x9E3779B97F4A7C15) + rows[:, r])
    return out.view(np.int64)


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        nodes, sizes, buckets, seen = [], [], [], set()
        for node, text in zip(batch.column("node").to_pylist(), batch.column("text").to_pylist()):
            if node in seen:
                continue
            seen.add(node)
            if len(s := shingles(text)):
                nodes.append(node)
                sizes.append(len(s))
                buckets.append(band_hashes(bag_signature(s)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.array(nodes, np.int64), BANDS)),
             pa.array(np.concatenate(buckets) if buckets else np.empty(0, np.int64)),
             pa.array(np.repeat(np.array(sizes, np.int32), BANDS))], names=["node", "bucket", "size"])


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs whose exact multiset overlap reaches the threshold."""
    last, held = None, None
    for batch in batches:
        ok = []
        for b, text_a, text_b in zip(*(batch.column(c).to_pylist() for c in ("b", "text_a", "text_b"))):
            if b != last:
                last, held = b, shingles(text_b)
            own = shingles(text_a)
            # the overlap is at most the ratio of sizes
            near = min(len(own), len(held)) >= THRESHOLD * max(len(own), len(held))
            ok.append(near and weighted_jaccard(own, held) >= THRESHOLD)
        mask = pa.array(ok, pa.bool_())
        yield pa.RecordBatch.from_arrays([batch.column(c).filter(mask) for c in ("a", "b")], names=["a", "b"])


def _linked(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Verified (a, b) of the candidate pairs."""
    side = lambda k: texts.select(F.col("node").alias(k), F.col("text").alias(f"text_{k}")).hint("merge")
    joined = pairs.join(side("a"), "a").join(side("b"), "b")
    return joined.select("a", "b", "text_a", "text_b").mapInArrow(_verify, "a long, b long")


def _narrow(df: DataFrame) -> DataFrame:
    """Two numbers for each linked text need no more files than the cluster has cores."""
    return written(df.coalesce(df.sparkSession.sparkContext.defaultParallelism), "near-labels")


def components(edges: DataFrame) -> DataFrame:
    """(node, comp): the least node of each linked group, by least-label steps with pointer jumping.

    Each step is written; only whether a label changed comes to the driver.  ``edges`` is a
    written table.
    """
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    labels = _narrow(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("comp"))
                     .select(F.col("a").alias("node"), "comp"))
    while True:
        offers = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("comp").alias("offer"))
        better = labels.join(offers, labels["node"] == offers["a"], "left").select(
            "node", F.col("comp").alias("old"), F.least("comp", "offer").alias("comp"))
        up = labels.select(F.col("node").alias("comp"), F.col("comp").alias("up"))
        new = _narrow(better.join(up, "comp", "left").select("node", "old", F.least("comp", "up").alias("comp")))
        changed = new.where("old <> comp").limit(1).count()
        labels = new.select("node", "comp")
        if not changed:
            return labels


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shingles as a set: the n-th occurrence of one is a token of its own."""
    for batch in batches:
        tokens = []
        for text in batch.column("text").to_pylist():
            s = shingles(text)
            run = np.arange(len(s)) - np.searchsorted(s, s)
            tokens.append(_mix(s + run.astype(_U) * _U(0x9E3779B97F4A7C15)).tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch.column("node"), pa.array(tokens, pa.binary())], names=["node", "tokens"])


def _bucket_links(part: pa.Table) -> pa.Table:
    """Links between different classes of each bucket (or pair of its blocks) in ``part``.

    The overlap of one text with all others is one pass over their tokens.  Found links join
    classes at once, so only links that still join two classes are looked for and returned.
    """
    bucket, node, comp = (part.column(c).to_numpy() for c in ("bucket", "node", "comp"))
    block, left, right = (part.column(c).to_numpy() for c in ("block", "i", "j"))
    tokens = [np.frombuffer(x, _U) for x in part.column("tokens").to_pylist()]
    found: list[tuple[int, int]] = []
    order = np.argsort(bucket, kind="stable")
    for rows in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1):
        root = {c: c for c in comp[rows].tolist()}

        def top(c: int) -> int:
            while root[c] != c:  # noqa: B023
                root[c] = c = root[root[c]]  # noqa: B023
            return c

        one = left[rows[0]] == right[rows[0]]
        ours, theirs = (rows, rows) if one else (rows[block[rows] == left[rows[0]]], rows[block[rows] == right[rows[0]]])
        if not len(ours) or not len(theirs):
            continue
        size = np.array([len(tokens[r]) for r in theirs])
        starts = np.concatenate([[0], np.cumsum(size)[:-1]])
        names, ids = np.unique(np.concatenate([tokens[r] for r in theirs]), return_inverse=True)
        mark = np.zeros(len(names) + 1, bool)
        for n, a in enumerate(ours):
            classes = np.array([top(c) for c in comp[theirs].tolist()])
            wanted = (classes != top(int(comp[a]))) & (np.minimum(size, len(tokens[a])) >= THRESHOLD * np.maximum(size, len(tokens[a])))
            if one:
                wanted[: n + 1] = False
            if not wanted.any():
                continue
            at = np.minimum(np.searchsorted(names, tokens[a]), len(names) - 1)
            at = at[names[at] == tokens[a]]
            mark[at] = True
            both = np.add.reduceat(mark[ids].astype(np.int64), starts)
            mark[at] = False
            for h in np.flatnonzero(wanted & (both / (len(tokens[a]) + size - both) >= THRESHOLD)):
                x, y = top(int(comp[a])), top(int(comp[theirs[h]]))
                if x != y:
                    root[max(x, y)] = min(x, y)
                    found.append((int(node[a]), int(node[theirs[h]])))
    return pa.table({"a": pa.array([x for x, _ in found], pa.int64()), "b": pa.array([y for _, y in found], pa.int64())})


def _late_links(placed: DataFrame, texts: DataFrame) -> DataFrame:
    """Links that join classes inside buckets which still hold several.

    ``placed`` leaves out each bucket's first text, which all others were checked against;
    buckets with the same texts are looked at once.  A bucket is cut into blocks of at most about ``BLOCK_TEXTS`` texts and ``BLOCK_TOKENS``
    shingles, and each pair of blocks is a group of its own; small buckets share groups.
    """
    digest = F.struct(F.count(F.lit(1)), F.bit_xor(F.xxhash64("node")), F.sum(F.shiftright(F.xxhash64(F.lit(1), "node"), 20)))
    blocks = F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK_TEXTS), F.ceil(F.sum("size") / BLOCK_TOKENS))
    mixed = (placed.groupBy("bucket").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), digest.alias("digest"), blocks.alias("blocks"))
             .where("lo < hi").groupBy("digest").agg(F.min("bucket").alias("bucket"), F.max("blocks").alias("blocks")))
    held = written(placed.join(mixed.select("bucket", "blocks"), "bucket"), "near-open")
    nodes = held.select("node").distinct()
    tokens = written(texts.join(nodes, "node", "left_semi").mapInArrow(_tokens, "node long, tokens binary"), "near-tokens")
    groups = F.lit(max(1, held.count() // BLOCK_TEXTS))
    cut = held.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
    cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    single = F.col("blocks") == 1
    parts = cut.select(
        "bucket", "node", "comp", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
        single.alias("single"), F.when(single, F.pmod(F.xxhash64("bucket"), groups)).otherwise(F.col("bucket")).alias("part"))
    return written(parts.join(tokens, "node").groupBy("single", "part", "i", "j")
                   .applyInArrow(_bucket_links, "a long, b long"), "near-late")


def near_classes(docs: DataFrame) -> DataFrame:
    """(doc_id, node, comp) of every row: rows with equal ``comp`` are one class of near copies."""
    spark = docs.sparkSession
    small_batches(spark)
    base = docs.select("doc_id", F.xxhash64(text_of()).alias("node"), text_of().cast("binary").alias("text"))
    bands = written(base.select("node", "text").mapInArrow(_bands, "node long, bucket long, size int"), "near-bands")
    shared = bands.groupBy("bucket").agg(F.min("node").alias("first"), F.max("node").alias("last")).where("first < last")
    members = written(bands.join(shared.select("bucket", "first"), "bucket").distinct(), "near-members")
    # the texts in shared buckets: copies collapse before they are dealt out by node.  A merge join
    # at any size, so its cost grows as the input
    wanted = members.select("node").distinct().hint("merge")
    texts = written(base.select("node", "text").groupBy("node").agg(F.first("text").alias("text")).join(wanted, "node"), "near-texts")
    stars = members.where("node <> first").select(F.col("node").alias("a"), F.col("first").alias("b")).distinct()
    links = written(_linked(stars, texts), "near-links")
    # the least linked first text: labels that mean one class, and so save comparisons
    labels = links.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("comp"))
    placed = members.where("node <> first").join(labels, "node", "left").select("bucket", "node", "size", F.coalesce("comp", "node").alias("comp"))
    labels = components(links.unionAll(_late_links(placed, texts)))
    return base.select("doc_id", "node").join(labels, "node", "left").select("doc_id", "node", F.coalesce("comp", "node").alias("comp"))


def near_dup_table(docs: DataFrame) -> DataFrame:
    """doc_id and class_id, the least doc_id among its near copies, of every document."""
    rows = written(near_classes(docs), "near-classes")
    least = rows.groupBy("comp").agg(F.min("doc_id").alias("class_id"))
    return rows.join(least, "comp").select("doc_id", "class_id")


def keep_first(docs: DataFrame) -> DataFrame:
    """The documents with one of each class kept: the row of its least doc_id (nulls last)."""
    rows = near_classes(docs)
    key = F.coalesce(F.col("doc_id"), F.lit(2 ** 63 - 1))
    first = rows.groupBy("comp").agg(F.min(F.struct(key.alias("nd_doc"), F.col("node").alias("nd_node"))).alias("f"))
    stay = written(first.select("f.*"), "near-stay")
    keyed = docs.select(row_struct(docs), key.alias("nd_doc"), F.xxhash64(text_of()).alias("nd_node"))
    # rows that repeat doc_id and text are one document
    kept = keyed.join(stay, ["nd_doc", "nd_node"]).dropDuplicates(["nd_doc", "nd_node"])
    return kept.select(*unpacked(kept, docs.columns))
