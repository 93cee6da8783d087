"""Rate-file operators.

Parsing is the built-in JSON reader logic (``from_json`` with the declared
schema, PERMISSIVE, corrupt-record column), so text that does not fit is kept
aside instead of vanishing.  Flattening is ``posexplode`` over typed arrays
with no exchange; only provider-reference resolution (M2) shuffles, as an
equi-join on (file, provider_group_id).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.schemas import CORRUPT_COLUMN, RATES_SCHEMA_WITH_CORRUPT

JSON_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COLUMN}


def parse_rates(bronze: DataFrame, value_col: str = "value", keep=("file_path",)) -> DataFrame:
    """Add ``doc`` (typed struct) with ``doc._corrupt_record`` set for text that does not fit."""
    return bronze.select(*keep, F.from_json(F.col(value_col), RATES_SCHEMA_WITH_CORRUPT, JSON_OPTIONS).alias("doc"))


def is_valid(doc: str = "doc"):
    """Q2 rule: the text parsed and nothing was rescued."""
    return F.col(doc).isNotNull() & F.col(f"{doc}.{CORRUPT_COLUMN}").isNull()


def split_valid(parsed: DataFrame, doc: str = "doc") -> tuple[DataFrame, DataFrame]:
    """Expect-or-drop: (kept rows, quarantined rows)."""
    return parsed.where(is_valid(doc)), parsed.where(~is_valid(doc))


def rates_fact(docs: DataFrame, keep=("file_path",)) -> DataFrame:
    """M1: one row per (in_network item, negotiated rate, negotiated price) with every item and price field.

    Lists of codes stay arrays; ``n_inline_groups`` counts the provider groups that the rate itself holds."""
    keep = list(keep)
    item = ["billing_code", "billing_code_type", "billing_code_type_version", "negotiation_arrangement", "name",
            "description", "bundled_codes", "covered_services"]
    items = docs.select(*keep, F.posexplode("doc.in_network").alias("in_network_pos", "item"))
    rates = items.select(*keep, "in_network_pos", *[f"item.{c}" for c in item],
                         F.posexplode("item.negotiated_rates").alias("rate_pos", "rate"))
    prices = rates.select(*keep, "in_network_pos", *item, "rate_pos", F.col("rate.provider_references").alias("refs"),
                          F.coalesce(F.size("rate.provider_groups"), F.lit(0)).alias("inline"),
                          F.posexplode("rate.negotiated_prices").alias("price_pos", "price"))
    return prices.select(
        *keep,
        F.col("in_network_pos").cast("bigint").alias("in_network_pos"),
        F.col("rate_pos").cast("bigint").alias("rate_pos"),
        F.col("price_pos").cast("bigint").alias("price_pos"), *item,
        "price.negotiated_type", "price.negotiated_rate", "price.expiration_date", "price.billing_class",
        "price.service_code", "price.billing_code_modifier", "price.additional_information",
        F.array_join(F.transform("refs", lambda r: r.cast("string")), ",").alias("provider_references"),
        F.greatest(F.col("inline"), F.lit(0)).alias("n_inline_groups"),
    )


def _group_fields(group: str = "grp") -> list:
    return [F.array_join(f"{group}.npi", ",").alias("npi"), F.size(f"{group}.npi").alias("n_npi"),
            F.col(f"{group}.tin.type").alias("tin_type"), F.col(f"{group}.tin.value").alias("tin_value")]


def _rates(docs: DataFrame, keep: list) -> DataFrame:
    """One row per negotiated rate, with its provider fields."""
    items = docs.select(*keep, F.posexplode("doc.in_network").alias("in_network_pos", "item"))
    rates = items.select(*keep, F.col("in_network_pos").cast("bigint").alias("in_network_pos"), "item.billing_code",
                         F.posexplode("item.negotiated_rates").alias("rate_pos", "rate"))
    return rates.select(*keep, "in_network_pos", "billing_code", F.col("rate_pos").cast("bigint").alias("rate_pos"),
                        "rate.provider_references", "rate.provider_groups")


def provider_groups(docs: DataFrame, keep=("file_path",)) -> DataFrame:
    """The groups of the provider references (kept even when empty) and those that stand in the rates themselves.

    ``source`` tells them apart; a referenced group has its reference's position and id, an inline one
    the positions of its item and rate.  No exchange: the two are read side by side."""
    keep = list(keep)
    refs = docs.select(*keep, F.posexplode("doc.provider_references").alias("ref_pos", "ref"))
    groups = refs.select(*keep, "ref_pos", "ref.provider_group_id", "ref.location",
                         F.posexplode_outer("ref.provider_groups").alias("group_pos", "grp"))
    none = F.lit(None).cast("bigint")
    referenced = groups.select(
        *keep, F.lit("reference").alias("source"), F.col("ref_pos").cast("bigint").alias("ref_pos"), "provider_group_id",
        none.alias("in_network_pos"), none.alias("rate_pos"), F.col("group_pos").cast("bigint").alias("group_pos"), *_group_fields())
    inline = _rates(docs, keep).select(*keep, "in_network_pos", "rate_pos", F.posexplode("provider_groups").alias("group_pos", "grp"))
    inline = inline.select(
        *keep, F.lit("inline").alias("source"), none.alias("ref_pos"), none.alias("provider_group_id"),
        "in_network_pos", "rate_pos", F.col("group_pos").cast("bigint").alias("group_pos"), *_group_fields())
    return referenced.unionByName(inline)


def resolved_rates(docs: DataFrame, keep=("file_path",)) -> DataFrame:
    """M2: each negotiated rate with its provider groups: those it holds itself (``inline``) and those its
    references point at (``reference``).

    References are resolved by an equi-join on (file, provider_group_id) between the exploded rate
    references and the exploded reference table of the same file.  Both sides
    are hash-partitioned on the pair, so one big file spreads over many tasks;
    AQE splits a hot group id (skew join) and turns the join into a broadcast
    only when it measures a small side at run time.  Spark map lookups scan
    linearly, so a per-row map would cost rates x references per file.
    Inline groups need no join and are added beside it, under their own positions.
    An ``unresolved`` reference, and a rate with neither kind (``none``), keep a row with NULL provider fields.
    """
    keep = list(keep)
    rates = _rates(docs, keep)
    has_inline = F.coalesce(F.size("provider_groups"), F.lit(0)) > 0
    has_refs = F.coalesce(F.size("provider_references"), F.lit(0)) > 0
    refs = rates.where(has_refs | ~has_inline).select(
        *keep, "in_network_pos", "billing_code", "rate_pos", has_refs.alias("_has"),
        F.explode_outer("provider_references").alias("provider_group_id"))
    table_ = (docs.select(*keep, F.explode("doc.provider_references").alias("ref"))
              .select(*[F.col(k).alias(f"_r_{k}") for k in keep], F.col("ref.provider_group_id").alias("_r_id"),
                      F.posexplode_outer("ref.provider_groups").alias("group_pos", "grp")))
    cond = [F.col(k) == F.col(f"_r_{k}") for k in keep] + [F.col("provider_group_id") == F.col("_r_id")]
    source = F.when(~F.col("_has"), "none").when(F.col("_r_id").isNull(), "unresolved").otherwise("reference")
    out = ["in_network_pos", "rate_pos", "billing_code", "provider_group_id"]
    joined = refs.join(table_, cond, "left").select(
        *keep, *out, source.alias("source"), F.col("group_pos").cast("bigint").alias("group_pos"), "grp")
    inline = rates.where(has_inline).select(
        *keep, "in_network_pos", "rate_pos", "billing_code", F.lit(None).cast("bigint").alias("provider_group_id"),
        F.lit("inline").alias("source"), F.posexplode("provider_groups").alias("group_pos", "grp"))
    both = joined.unionByName(inline.withColumn("group_pos", F.col("group_pos").cast("bigint")))
    npi, _, tin_type, tin_value = _group_fields()
    return both.select(*keep, *out, "source", "group_pos", npi, tin_type, tin_value)
