"""Sharding (operator 4, DataFrame functions only): balanced label propagation.

Documents with equal texts are linked.  Every document starts at a shard hashed from its
doc_id, checksum and place in the input (so rows that repeat all of these are spread too).  The documents of one group and one start shard move together as a unit, so the
iterations work on at most ``shards`` rows for each linked group, however many copies it has.
In each step every unit proposes the shard where most of its neighbours are (a group larger
than a shard has as many such centres as it needs; units outside them propose the emptier ones first), and shards accept proposals up to their
free capacity plus what leaves them in the same step, so full shards swap units.  Units move
with the chance that these quotas leave; they come from the flows between shards, ``shards``
times ``shards`` numbers at most.  Steps go on until hardly any document wishes to move.

Counts are then made exact: each shard ranks its documents, linked ones first; those beyond
its quota take the free places of other shards in order.  Law ``rows``: shard counts are at
most one apart.  Documents without links go where there is room and cost no cut edge.

Scale: text is read once, for size, checksum and a digest; ranks are prefix sums over hash
buckets, so no window holds a whole shard or group.

Defined cases: null texts count as empty (equal to empty texts); doc_id may be null or
repeated; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import text_of, written

SHARDS = 40
#: Most steps, and the share of all rows that still wish to move at which no further step is made.
STEPS, SETTLED = 16, 0.0005
#: Rounds in which the chances of one step settle.
ROUNDS = 100
#: Share of a shard that the centres of a large group are planned to fill.
FILL = 0.9
#: Rows for which one hash bucket of the ranking is planned.
BUCKET_ROWS = 2000


def _rows(docs: DataFrame, shards: int) -> DataFrame:
    """doc_id, size, checksum, text digest and start shard; the texts are read for this only."""
    text = text_of()
    out = docs.select("doc_id", (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
                      F.unhex(F.sha2(text.cast("binary"), 256)).alias("g"), F.monotonically_increasing_id().alias("number"))
    # the number spreads rows that repeat doc_id and text, which no other column tells apart
    return out.withColumn("start", F.pmod(F.xxhash64("doc_id", "size", "text_crc32", "number"), F.lit(shards)).cast("int"))


def _chances(flows: list, loads: dict[int, int], target: float) -> dict[int, float]:
    """For each wished shard the greatest chance of its proposals at which no shard's expected load passes ``target``.

    Chances start at 1 and fall until what a shard takes in is its room plus its own departures;
    a shard beyond ``target`` takes in less than it gives.
    """
    wish, leaving = defaultdict(float), defaultdict(list)
    for r in flows:
        wish[r["to"]] += r["n"]
        leaving[r["shard"]].append((r["to"], r["n"]))
    chance = dict.fromkeys(wish, 1.0)
    for _ in range(ROUNDS):
        chance = {t: min(1.0, max(0.0, target - loads.get(t, 0) + sum(n * chance[u] for u, n in leaving[t])) / w)
                  for t, w in wish.items()}
    return chance


def _step(units: DataFrame, total: int, shards: int, number: int) -> tuple[DataFrame, int]:
    """One step of label propagation over units (g, start, n, shard): (units after it, rows that wished to move)."""
    cells = units.groupBy("g", "shard").agg(F.sum("n").alias("n"))
    by_group = Window.partitionBy("g")  # at most ``shards`` rows each
    order = by_group.orderBy(F.desc("n"), F.xxhash64("g", "shard", F.lit(~number)), "shard")  # ties fall anew in each step
    ranked = cells.select(
        "g", "shard", "n", F.row_number().over(order).alias("rank"),
        F.greatest(F.ceil(F.sum("n").over(by_group) * shards / (FILL * total)), F.lit(1)).alias("centres"))
    ranked = ranked.withColumn("ranking", F.collect_list("shard").over(
        order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    moves = (ranked.where("rank > centres")
             .select("g", "shard", "n", F.element_at(
                 "ranking", (F.col("centres") - F.pmod(F.col("rank") - 1, F.col("centres"))).cast("int")).alias("to")))
    moves = written(moves, "shard-moves")
    loads = {r["shard"]: r["n"] for r in units.groupBy("shard").agg(F.sum("n").alias("n")).collect()}  # at most ``shards`` rows
    flows = moves.groupBy("shard", "to").agg(F.sum("n").alias("n")).collect()  # at most ``shards`` squared
    chance = _chances(flows, loads, total / shards)
    quota = F.create_map(*[F.lit(x) for t in sorted(chance) for x in (t, chance[t])]).cast("map<int,double>")
    draw = F.pmod(F.xxhash64("g", "shard", F.lit(number)), F.lit(1_000_000)) / 1_000_000
    accepted = moves.where(draw < F.element_at(quota, F.col("to"))).select("g", "shard", "to")
    wished = sum(r["n"] for r in flows)
    return written(units.join(accepted, ["g", "shard"], "left").select("g", "start", "n", F.coalesce("to", "shard").alias("shard")),
                   "shard-units"), wished


def _prefix(counts: DataFrame, by: list[str], order: list[str]) -> Column:
    """Rows before each (by, order) cell among its ``by``; the table has one row for each bucket."""
    window = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum("n").over(window), F.lit(0))


def assign_shards(docs: DataFrame, shards: int = SHARDS, steps: int = STEPS) -> DataFrame:
    """doc_id, size, text_crc32, linked, shard and slot of every document; counts differ by at most one."""
    rows = written(_rows(docs, shards), "shard-rows")
    total = rows.count()
    cells = rows.groupBy("g", "start").agg(F.count(F.lit(1)).alias("n"))
    units = written(cells.withColumn("all", F.sum("n").over(Window.partitionBy("g"))).where("all > 1")
                    .select("g", "start", "n", F.col("start").alias("shard")), "shard-units")
    before = None
    for number in range(steps):
        units, wished = _step(units, total, shards, number)
        if wished <= SETTLED * total or wished == before:
            break
        before = wished
    labelled = rows.join(units.select("g", "start", F.col("shard").alias("label")), ["g", "start"], "left")
    buckets = max(1, total // (shards * BUCKET_ROWS))
    placed = written(labelled.select(
        "doc_id", "size", "text_crc32", "number", F.col("label").isNotNull().alias("linked"), F.coalesce("label", "start").alias("shard"),
        F.col("label").isNull().cast("int").alias("late"),
        F.pmod(F.xxhash64(F.lit(7), "doc_id", "text_crc32", "number"), F.lit(buckets)).cast("int").alias("bucket")), "shard-labels")
    cell = ["shard", "late", "bucket"]
    counts = written(placed.groupBy(*cell).agg(F.count(F.lit(1)).alias("n")), "shard-counts")
    starts = written(counts.select(*cell, _prefix(counts, ["shard"], ["late", "bucket"]).alias("before")), "shard-starts")
    inside = F.row_number().over(Window.partitionBy(*cell).orderBy("doc_id", "size", "text_crc32", "number"))
    ranked = placed.withColumn("inside", inside).join(starts, cell).withColumn("rank", F.col("before") + F.col("inside") - 1).drop("inside", "before")
    # quotas and free places of the shards: arrays of ``shards`` numbers
    loads = counts.groupBy("shard").agg(F.sum("n").alias("n")).agg(
        F.map_from_entries(F.collect_list(F.struct("shard", "n"))).alias("m")).scalar()
    quota = F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), lambda s: F.lit(total // shards) + (s < total % shards).cast("int"))
    load = F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), lambda s: F.coalesce(F.element_at(F.col("loads"), s), F.lit(0).cast("long")))
    ranked = ranked.withColumn("loads", loads).withColumns({"quota": quota, "load": load})
    over = F.col("rank") >= F.get("quota", F.col("shard"))
    marked = written(ranked.select("doc_id", "size", "text_crc32", "linked", *cell, "rank", over.alias("over")), "shard-ranks")
    stay = marked.where("NOT over").select("doc_id", "size", "text_crc32", "linked", "shard", F.col("rank").cast("long").alias("slot"))
    # the others are numbered over all shards and take the free places in order
    spare = marked.where("over")
    spare_cells = spare.groupBy(*cell).agg(F.count(F.lit(1)).alias("n"), F.min("rank").alias("first"))
    by_shard = spare_cells.groupBy("shard").agg(F.sum("n").alias("n"))  # ``shards`` rows
    shard_starts = by_shard.select("shard", _prefix(by_shard, [], ["shard"]).alias("start"))
    firsts = (spare_cells.withColumn("before", _prefix(spare_cells, ["shard"], ["late", "bucket"]))
              .join(shard_starts, "shard").select(*cell, "first", (F.col("before") + F.col("start")).alias("before")))
    free = F.zip_with(quota, "load", lambda q, n: F.greatest(q - n, F.lit(0)))
    ends = F.aggregate("free", F.array(F.lit(0).cast("long")), lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x)))
    numbered = (spare.join(firsts, cell).withColumn("k", F.col("before") + F.col("rank") - F.col("first"))
                .withColumn("loads", loads).withColumn("load", load).withColumn("free", free).withColumn("ends", ends))
    to = (F.size(F.filter("ends", lambda e: e <= F.col("k"))) - 1).cast("int")
    moved = numbered.withColumn("to", to).select(
        "doc_id", "size", "text_crc32", "linked", F.col("to").alias("shard"),
        (F.get("load", F.col("to")) + F.col("k") - F.get("ends", F.col("to"))).cast("long").alias("slot"))
    return stay.unionAll(moved)


def shard_table(docs: DataFrame) -> DataFrame:
    """The contract's columns under law ``rows``."""
    return assign_shards(docs).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "linked")
