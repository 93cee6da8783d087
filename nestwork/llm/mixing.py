"""Mixing sources to target weights (operator 7, DataFrame functions only): Poisson replication.

Each source gets a rate: its target share of the mixture's bytes over its own bytes.  A
document's number of copies inverts the Poisson distribution with that mean at a uniform
value hashed from the seed and doc_id, so reruns and lost executors give the same mixture.
Documents are exploded by their count and shuffled globally: every copy goes to a partition
by its own random key, and partitions are sorted by it.

Scale: rates and distributions are one row per source in a written table, which the planner
broadcasts only when its known size is small; a source with a third of all rows is then no
key of any shuffle (beyond that size, AQE splits the join).  Large counts are exploded in two
steps of bounded arrays.  The distribution is an array of about 24 sqrt(rate) numbers, far fewer than the ``rate`` copies that a row
of such a source becomes.

Defined cases: a null source is a source of its own; sources without any text keep rate 1; a
null doc_id is hashed as "null"; rows that repeat a doc_id get equal counts; sources missing
from explicit weights get none; an empty table gives an empty result; all columns stay.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import row_struct, text_of, unit_hash, unpacked, written

SEED = "mix-1"
#: Without explicit weights, a source's weight is its bytes to this power.
TEMPERATURE = 0.5
#: Copies made by one step of the two-step explode.
BLOCK = 1024


def _source(column: str = "source") -> Column:
    return F.coalesce(F.col(column), F.lit("\x1e"))


def source_rates(docs: DataFrame, weights: dict[str, float] | None = None, temperature: float = TEMPERATURE) -> DataFrame:
    """(mx_source, rate, lowest, cdf) per source: mean repetitions, and the Poisson distribution function from ``lowest`` on."""
    volume = written(docs.select(_source().alias("mx_source"), F.octet_length(text_of()).cast("long").alias("b"))
                     .groupBy("mx_source").agg(F.sum("b").alias("bytes")), "mix-bytes")
    if weights is None:
        weighted = volume.withColumn("weight", F.pow(F.col("bytes").cast("double"), F.lit(temperature)))
    else:
        given = docs.sparkSession.createDataFrame(list(weights.items()) or [("", 0.0)], "mx_source string, weight double")
        weighted = volume.join(given, "mx_source", "left").withColumn("weight", F.coalesce("weight", F.lit(0.0)))
    sums = weighted.agg(F.sum("bytes").alias("bytes"), F.sum(F.when(F.col("bytes") > 0, F.col("weight"))).alias("weight"))
    total = sums.select(F.struct("*")).scalar()
    rate = F.when(F.col("bytes") > 0, F.col("weight") / total["weight"] * total["bytes"] / F.col("bytes")).otherwise(1.0)
    rated = written(weighted.select("mx_source", rate.alias("rate")), "mix-rates")
    return written(rated.select("mx_source", "rate", _lowest().alias("lowest"), _distribution().alias("cdf")), "mix-cdf")


def _lowest() -> Column:
    """The least count in the window about the mean; below it lies less than 1e-30."""
    return F.greatest(F.floor(F.col("rate") - 12 * F.sqrt("rate") - 20), F.lit(0)).cast("int")


def _distribution(chunk: int = 256) -> Column:
    """The Poisson distribution function from the lowest count to 12 deviations beyond the mean (the rest is below 1e-16).

    Every term is a closed form, so none rests on the one before: for small counts by the logarithm of the factorial, for others by
    Stirling's series with the large parts taken together (k log(rate / k) + k - rate), which loses no digits at any rate.
    Sums run in chunks, so the work is linear in the window, about 24 sqrt(rate) counts.
    """
    rate = F.col("rate")
    first, last = _lowest(), (F.ceil(rate + 12 * F.sqrt("rate")) + 20).cast("int")
    exact = F.array(*[F.lit(math.lgamma(k + 1)) for k in range(20)])

    def term(k: Column) -> Column:
        x = k.cast("double")
        small = x * F.log("rate") - rate - F.element_at(exact, F.least(k + 1, F.lit(20)).cast("int"))
        large = (x * F.log1p((rate - x) / x) + (x - rate) - F.log(2 * math.pi * x) / 2
                 - 1 / (12 * x) + 1 / (360 * x * x * x) - 1 / (1260 * x * x * x * x * x))
        return F.exp(F.when(k < 20, small).otherwise(large))

    none = F.array().cast("array<double>")

    def running(values: Column, start: Column) -> Column:
        return F.aggregate(values, F.struct(start.alias("s"), none.alias("out")), lambda a, x: F.struct(
            (a["s"] + x).alias("s"), F.concat(a["out"], F.array(a["s"] + x)).alias("out")), lambda a: a["out"])

    zero = F.lit(0.0)
    starts = F.sequence(first, last, F.lit(chunk))
    pieces = F.transform(starts, lambda s: F.transform(F.sequence(s, F.least(s + chunk - 1, last)), term))

    def summed(p: Column) -> Column:
        totals = F.transform(p, lambda c: F.aggregate(c, zero, lambda a, x: a + x))
        before = F.concat(F.array(zero), running(totals, zero))
        return F.flatten(F.zip_with(p, F.slice(before, F.lit(1), F.size(p)), running))

    # bound once, as Catalyst would else compute the terms in each place they are used
    cdf = F.transform(F.array(pieces), summed)[0]
    return F.when(rate > 0, cdf).otherwise(F.array(F.lit(1.0)))


def replicate(docs: DataFrame, rates: DataFrame, seed: str = SEED) -> DataFrame:
    """row (struct), copy (from 0) and mix_key of every copy, not yet shuffled."""
    keyed = docs.select(row_struct(docs), _source().alias("mx_source"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")).alias("mx_id"))
    joined = keyed.join(rates, "mx_source").withColumn("mx_u", unit_hash(F.lit(seed), F.col("mx_id")))
    counted = joined.withColumn("mx_n", F.col("lowest") + F.size(F.filter("cdf", lambda c: c < F.col("mx_u")))).drop("cdf", "lowest", "mx_u")
    blocks = counted.where("mx_n > 0").withColumn(
        "mx_b", F.explode(F.sequence(F.lit(0), F.floor((F.col("mx_n") - 1) / BLOCK).cast("int"))))
    copies = blocks.withColumn("copy", F.explode(F.sequence(
        F.col("mx_b") * BLOCK, F.least(F.col("mx_n"), (F.col("mx_b") + 1) * BLOCK) - 1)))
    digits = F.substring(F.md5(F.concat_ws(":", F.lit(seed), F.col("mx_id"), F.col("copy")).cast("binary")), 1, 15)
    return copies.select("row", "copy", F.conv(digits, 16, 10).cast("long").alias("mix_key"))


def shuffled(copies: DataFrame) -> DataFrame:
    """Deal out copies by their random keys and sort each partition by them."""
    return copies.repartition("mix_key").sortWithinPartitions("mix_key")


def mix_sources(docs: DataFrame, weights: dict[str, float] | None = None, seed: str = SEED) -> DataFrame:
    """The mixture: the documents' own columns, a row for each copy, in shuffled order."""
    copies = shuffled(replicate(docs, source_rates(docs, weights), seed))
    return copies.select(*unpacked(copies, docs.columns))


def mix_table(docs: DataFrame) -> DataFrame:
    """doc_id, source, copy and mix_key of every row of the mixture; no text is moved."""
    narrow = docs.select("doc_id", "source")
    copies = shuffled(replicate(narrow, source_rates(docs)))
    return copies.select("row.doc_id", "row.source", "copy", "mix_key")


#: DuckDB's view of the same rows.
ORACLE = """
WITH RECURSIVE vol AS (
  SELECT coalesce(source, chr(30)) AS s, sum(strlen(coalesce(text, ''))) AS bytes FROM documents GROUP BY 1),
rates AS (
  SELECT s, CASE WHEN bytes > 0 THEN pow(bytes::DOUBLE, 0.5) / sum(pow(bytes::DOUBLE, 0.5)) OVER ()
                                     * (sum(bytes) OVER ())::DOUBLE / bytes ELSE 1.0 END AS rate FROM vol),
cdf AS (
  SELECT s, rate, 0 AS k, -rate AS lp, exp(-rate) AS c FROM rates
  UNION ALL
  SELECT s, rate, k + 1, lp + ln(rate) - ln((k + 1)::DOUBLE), c + exp(lp + ln(rate) - ln((k + 1)::DOUBLE))
  FROM cdf WHERE k < ceil(rate + 12 * sqrt(rate)) + 20),
docs AS (
  SELECT doc_id, source, coalesce(source, chr(30)) AS s, coalesce(doc_id::VARCHAR, 'null') AS id,
         (('0x' || md5('mix-1:' || coalesce(doc_id::VARCHAR, 'null'))[1:13])::BIGINT::DOUBLE + 0.5) / 4503599627370496.0 AS u
  FROM documents),
counts AS (
  SELECT d.doc_id, d.source, d.id, count(*) AS n FROM docs d JOIN cdf ON cdf.s = d.s AND cdf.c < d.u
  GROUP BY ALL),
copies AS (
  SELECT doc_id, source, id, unnest(range(n))::INTEGER AS copy FROM counts)
SELECT doc_id, source, copy, ('0x' || md5('mix-1:' || id || ':' || copy)[1:15])::BIGINT AS mix_key FROM copies
"""
