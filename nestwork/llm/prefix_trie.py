"""Conversation prefix trie (operator 12): totals of every shared prefix by time-forward processing.

A node is a distinct sequence of the first d turns of some conversations, from the textless root
(d = 0).  Turns are narrowed to digests and byte counts before anything moves, and prefixes get
hashes by a scan (``prefix_scan``), so one long conversation is spread over many tasks; rows with
equal (depth, prefix hash) are summed into nodes, partly before the shuffle, however hot a node is.

Totals of subtrees then go from children to parents in the manner of time-forward processing.  Nodes are
sorted by reverse level order by Spark's external sort; a task walks them once, takes what was sent
to the node from a priority queue ordered in the same way, and sends the node's totals to its
parent through the queue.  The queue writes sorted runs to the task's temporary folder when it grows
past ``QUEUE`` messages.

Shards are whole subtrees of at most ``rows / tasks / 8`` rows (at least ``SHARD``): a node's number
of rows below it is known before its totals are, as the sum of the lengths that its members have
left.  A node above all of them (the crown: few at each depth, since the rows of the nodes of a depth add up to
no more than all rows) is a shard root's parent.  The crown is cut into bands of ``BAND`` levels.
Each band is walked for itself, the band roots' partial totals are passed on across bands by the same
walk over the band roots, and the bands are walked again with what comes from below.  Messages of shard roots
to one parent are summed before they move.

Defined cases of ``conversation_trie``: null roles and texts are empty; turns are ordered by number, nulls
first, equal ones by role and a hash of their text; repeated rows are turns of their own; rows without a conv_id
belong to no conversation and are left out; an empty table gives no nodes, not even a root; texts of any length count
only by digest and bytes; extra columns are ignored.  Prefixes are equal if their 122-bit hashes are (of 10^12
different prefixes, two agree with a chance below 10^-12).
"""

from __future__ import annotations

import hashlib
import heapq
import pickle
import tempfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import text_of, written
from .prefix_scan import digest_of, scan

#: Least rows below a shard's root, levels of a band of the crown, messages that a queue holds in memory.
SHARD, BAND, QUEUE = 4096, 1024, 500_000
#: Ids of a part of a list: those that agree when divided by it.
PART = 1 << 16
# Fixed values of the contract: conversations of five ids share a head of up to eight turns.
FAMILY, HEADS = 5, 9

_FORWARD = "depth long, k1 long, k2 long, p1 long, p2 long, top boolean, conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long"


class SpillingQueue:
    """A priority queue of tuples: past ``limit`` tuples a sorted run goes to a temporary file."""

    def __init__(self, limit: int = QUEUE):
        self.limit, self.heap, self.runs = limit, [], []

    def push(self, item: tuple) -> None:
        heapq.heappush(self.heap, item)
        if len(self.heap) >= self.limit:
            self._spill()

    def _spill(self) -> None:
        run = tempfile.TemporaryFile()  # gone when it is closed, or with the process
        for item in sorted(self.heap):
            pickle.dump(item, run)
        run.seek(0)
        self.heap = []
        self._advance(run)

    def _advance(self, run) -> None:
        try:
            heapq.heappush(self.runs, (pickle.load(run), id(run), run))
        except EOFError:
            run.close()

    def pop_equal(self, key: tuple) -> Iterator[tuple]:
        """Takes all tuples that begin with ``key``; none that is less is left, as keys come in order."""
        n = len(key)
        while self.heap and self.heap[0][:n] == key:
            yield heapq.heappop(self.heap)
        while self.runs and self.runs[0][0][:n] == key:
            item, _, run = heapq.heappop(self.runs)
            yield item
            self._advance(run)


def _forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes in reverse level order, with their own values and what came from outside; out come their totals."""
    names = ["depth", "k1", "k2", "p1", "p2", "top", "n_children", "n_leaves", "saved_tokens"]
    queue = SpillingQueue()
    for batch in batches:
        totals: list[list[int]] = [[], [], []]
        for depth, k1, k2, p1, p2, top, children, leaves, saved in zip(*(batch.column(c).to_pylist() for c in names)):
            for message in queue.pop_equal((-depth, k1, k2)):
                children += 1
                leaves += message[3]
                saved += message[4]
            if not top:
                queue.push((1 - depth, p1, p2, leaves, saved))
            for column, value in zip(totals, (children, leaves, saved)):
                column.append(value)
        kept = [*names[:6], "conv_id", "n_convs"]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *(pa.array(t, pa.int64()) for t in totals)], names=kept + names[6:])


def forward(nodes: DataFrame, *shard: str) -> DataFrame:
    """Totals of all nodes within their shards; ``top`` nodes send nothing, their parents are elsewhere."""
    order = [F.desc("depth"), "k1", "k2"]
    dealt = nodes.repartition(*shard) if shard else nodes.repartition(1)
    return dealt.sortWithinPartitions(*order).select(*[c.split()[0] for c in _FORWARD.split(", ")]).mapInArrow(_forward, _FORWARD)


def _sent_up(tops: DataFrame) -> DataFrame:
    """What the roots of shards send to each parent, summed before it moves."""
    return tops.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(
        F.count(F.lit(1)).alias("in_children"), F.sum("n_leaves").alias("in_leaves"), F.sum("saved_tokens").alias("in_saved"))


def _received(nodes: DataFrame, inbox: DataFrame) -> DataFrame:
    """Nodes whose values also hold what was sent to them."""
    sums = {"n_children": "in_children", "n_leaves": "in_leaves", "saved_tokens": "in_saved"}
    out = nodes.join(inbox, ["depth", "k1", "k2"], "left")
    return out.withColumns({a: F.col(a) + F.coalesce(F.col(b), F.lit(0)) for a, b in sums.items()}).drop(*sums.values())


def _ends_digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One SHA-256 per node over its parts in order."""
    names = ["depth", "k1", "k2", "ends_sha256"]
    now, sha = None, None
    for batch in batches:
        done = []
        for *node, ids in zip(*(batch.column(x).to_pylist() for x in ("depth", "k1", "k2", "ids"))):
            if node != now:
                if now is not None:
                    done.append((*now, sha.hexdigest()))
                now, sha = node, hashlib.sha256()
            else:
                sha.update(b",")
            sha.update(ids.encode())
        yield pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], pa.string() if i == 3 else pa.int64()) for i in range(4)], names=names)
    if now is not None:
        yield pa.RecordBatch.from_arrays([pa.array([v]) for v in (*now, sha.hexdigest())], names=names)


def ends(rows: DataFrame) -> DataFrame:
    """SHA-256 of the ascending ids of the conversations that end at each node.

    The ids of a node are first joined in parts of ``PART`` possible ids, so a node with a third of all ends is read by
    many tasks; one task then hashes its parts in order (a hash is a sequence), one string for each part.
    """
    key = ["depth", "k1", "k2"]
    parts = rows.where("depth = size").groupBy(*key, F.floor(F.col("conv_id") / PART).alias("part")).agg(
        F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"))
    return parts.repartition(*key).sortWithinPartitions(*key, "part").mapInArrow(
        _ends_digest, "depth long, k1 long, k2 long, ends_sha256 string")


def trie(turns: DataFrame, sizes: DataFrame) -> DataFrame:
    """The nodes of all conversations.

    ``turns``: conv_id, depth (1 to size, no gap), digest (of the turn), bytes (of its text), size.
    ``sizes``: conv_id (unique), size; conversations of size 0 are members of the root only.
    """
    spark, key = turns.sparkSession, ["depth", "k1", "k2"]
    scanned = scan(turns.select("conv_id", "depth", "digest", "bytes", "size"), "conv_id", [F.col("depth")], "trie-scan")
    zero = [F.lit(0).cast("long").alias(c) for c in ("depth", "k1", "k2", "p1", "p2", "bytes")]
    rows = scanned.select("conv_id", "size", *key, "p1", "p2", "bytes").unionByName(sizes.select("conv_id", "size", *zero))
    nodes = written(rows.groupBy(*key).agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("p1").alias("p1"), F.max("p2").alias("p2"),
        F.max("bytes").alias("bytes"), F.sum(F.col("size") - F.col("depth")).alias("below"),
        F.count_if(F.col("size") == F.col("depth")).alias("n_ends")), "trie-nodes")
    root = nodes.where("depth = 0").first()
    if root is None:
        return nodes.select("conv_id", "depth", F.col("conv_id").alias("parent_conv_id"), "n_convs", "n_convs", "n_convs", "n_convs", F.lit("")).toDF(
            "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    most = max(SHARD, root["below"] // (8 * int(spark.conf.get("spark.sql.shuffle.partitions"))))
    own = nodes.withColumns({
        "n_children": F.lit(0).cast("long"), "n_leaves": (F.col("n_ends") == F.col("n_convs")).cast("long"),
        "saved_tokens": (F.col("n_convs") - 1) * F.col("bytes")})
    if root["below"] <= most:
        done = forward(own.withColumn("top", F.col("depth") == 0))
    else:
        done = _sharded(rows, own, most)
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    out = done.join(ends(rows), key, "left").join(parents, ["depth", "p1", "p2"], "left")
    nothing = hashlib.sha256(b"").hexdigest()
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                      F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"))


def _sharded(rows: DataFrame, own: DataFrame, most: int) -> DataFrame:
    """Totals of all nodes ``own``: of the shards (at most ``most`` rows below a root) first, then of the crown above them."""
    key = ["depth", "k1", "k2"]
    crown, light = own.where(F.col("below") > most), own.where(F.col("below") <= most)
    # the shard of a node is the first node below the crown on the way to its smallest member's end
    first = rows.join(crown.select(*key), key, "left_anti").groupBy("conv_id").agg(F.min(F.struct(*key)).alias("s"))
    shards = first.select("conv_id", *[F.col(f"s.{c}").alias(f"s_{c}") for c in key])
    light = light.join(shards, "conv_id").withColumn(
        "top", (F.col("depth") == F.col("s_depth")) & (F.col("k1") == F.col("s_k1")) & (F.col("k2") == F.col("s_k2")))
    light = written(forward(light, "s_depth", "s_k1", "s_k2"), "trie-light")
    crown = written(_received(crown, _sent_up(light.where("top"))).withColumns(
        {"band": F.floor(F.col("depth") / BAND), "top": F.col("depth") % BAND == 0}), "trie-crown")
    if crown.agg(F.max("depth")).first()[0] < BAND:
        return light.unionByName(forward(crown))
    # totals of band roots go up from band to band, then each band is walked again with what they bring
    roots = forward(crown, "band").where("top")
    above = rows.select("conv_id", F.col("depth").alias("up_depth"), F.col("k1").alias("up_k1"), F.col("k2").alias("up_k2"))
    roots = written(roots.withColumn("up_depth", F.col("depth") - BAND).join(above, ["conv_id", "up_depth"], "left"), "trie-bands")
    across = forward(roots.withColumns({"depth": (F.col("depth") / BAND).cast("long"), "p1": F.col("up_k1"), "p2": F.col("up_k2"),
                                        "top": F.col("depth") == 0}))
    whole = across.select((F.col("depth") * BAND).alias("depth"), "k1", "k2", "n_leaves", "saved_tokens").join(
        roots.select(*key, "p1", "p2"), key)
    return light.unionByName(forward(_received(crown, _sent_up(whole)), "band"))


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, pos (from 1), digest, bytes of every turn; no text moves."""
    role, text = text_of("role"), text_of()
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"),
        digest_of(role, text).alias("digest"), F.octet_length(text).cast("long").alias("bytes"),
        # equal rows are interchangeable; their numbers only keep a run of them from meeting in one task
        F.monotonically_increasing_id().alias("number"))
    order = [F.asc_nulls_first("turn"), F.col("role"), F.col("digest"), F.col("number")]
    return scan(rows, "conv_id", order, "turns", hashed=False).select("conv_id", "pos", "digest", "bytes")


def rebuilt(own: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The contract's conversations: a shared head from the first of five ids, then the own turns after as many.

    Returns (turns, sizes) as ``trie`` takes them.
    """
    per = own.groupBy("conv_id").agg(F.max("pos").alias("n_own")).select(
        "conv_id", "n_own", (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("base"),
        (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS).alias("h"))
    bases = per.select(F.col("conv_id").alias("base"), F.col("n_own").alias("n_base"))
    plan = written(per.join(bases, "base", "left").withColumn(
        "head", F.least("h", F.coalesce("n_base", F.lit(0)))).select(
        "conv_id", "base", "h", "head", (F.col("head") + F.greatest(F.col("n_own") - F.col("h"), F.lit(0))).alias("size")), "trie-plan")
    first = own.where((F.col("pos") < HEADS) & (F.col("conv_id") % FAMILY == 0)).withColumnRenamed("conv_id", "base")
    heads = plan.join(first, "base").where(F.col("pos") <= F.col("head")).select(
        "conv_id", F.col("pos").alias("depth"), "digest", "bytes", "size")
    tails = own.join(plan, "conv_id").where(F.col("pos") > F.col("h")).select(
        "conv_id", (F.col("head") + F.col("pos") - F.col("h")).alias("depth"), "digest", "bytes", "size")
    return heads.unionByName(tails), plan.select("conv_id", "size")


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The nodes of the trie of all rebuilt conversations."""
    return trie(*rebuilt(ordered_turns(conversations)))


#: CRC-32 of a text, bit by bit.
CRC32 = """xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(string_split({0}, ''), lambda c: ascii(c)::BIGINT)),
    lambda a, b: list_reduce(list_prepend(xor(a, b), [1, 1, 1, 1, 1, 1, 1, 1]::BIGINT[]),
        lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)))"""

ORACLE = f"""
WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''),
                      sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || length(coalesce(text, '')) || ':' || coalesce(text, ''))) AS pos
           FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT DISTINCT conv_id, conv_id - conv_id % 5 AS base, {CRC32.format("conv_id::VARCHAR")} % 9 AS h FROM t),
heads AS (SELECT c.conv_id, t.pos AS depth, role, text FROM c JOIN t ON t.conv_id = c.base AND t.pos <= c.h),
n AS (SELECT c.conv_id, c.h, count(heads.depth) AS head FROM c LEFT JOIN heads USING (conv_id) GROUP BY 1, 2),
turns AS (SELECT * FROM heads UNION ALL
          SELECT n.conv_id, head + pos - h, role, text FROM n JOIN t ON t.conv_id = n.conv_id AND pos > h),
size AS (SELECT n.conv_id, count(turns.depth) AS size FROM n LEFT JOIN turns USING (conv_id) GROUP BY 1),
p AS (SELECT conv_id, depth, strlen(text) AS bytes,
             string_agg(length(role) || ':' || role || length(text) || ':' || text, '') OVER (PARTITION BY conv_id ORDER BY depth) AS path
      FROM turns UNION ALL SELECT conv_id, 0, 0, '' FROM c),
r AS (SELECT p.*, size, min(p.conv_id) OVER (PARTITION BY depth, path) AS owner FROM p JOIN size USING (conv_id)),
node AS (SELECT owner, depth, count(*) AS n_convs, max(bytes) AS bytes, count(*) FILTER (WHERE size = depth) AS n_ends,
                sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE size = depth), '')) AS ends_sha256
         FROM r GROUP BY 1, 2),
up AS (SELECT DISTINCT r.owner, r.depth, a.owner AS a_owner, a.depth AS a_depth
       FROM r JOIN r a ON a.conv_id = r.owner AND a.depth <= r.depth WHERE r.conv_id = r.owner),
total AS (SELECT a_owner AS owner, a_depth AS depth, count(*) FILTER (WHERE n_ends = n_convs) AS n_leaves,
                 sum((n_convs - 1) * bytes)::BIGINT AS saved_tokens, count(*) FILTER (WHERE up.depth = a_depth + 1) AS n_children
          FROM up JOIN node USING (owner, depth) GROUP BY 1, 2)
SELECT node.owner AS conv_id, node.depth, up.a_owner AS parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256
FROM node JOIN total USING (owner, depth) LEFT JOIN up ON up.owner = node.owner AND up.depth = node.depth AND up.a_depth = node.depth - 1
"""
