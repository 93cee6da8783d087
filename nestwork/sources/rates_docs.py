"""In-network rate documents built inside Spark from the driver tables (F2).

One logical file per part (split into pieces of at most ``rates_per_doc``
negotiated rates), one negotiated rate per lineitem.  Its provider groups stand in the rate
itself, or it refers to a group of the file (one per supplier so used), or to one that is missing.  Contract faults are seeded from row values so an
oracle can count them (``SEEDED_FAULTS``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .index_docs import _piece, heavy_keys, n_pieces, row_salt
from .tables import table, tasks_for

# Fixed values of the fixture layout.
ENTITY_TYPE = "health insurance issuer"
VERSION = "1.0.0"
NPI_BASES = (1_000_000_000, 3_000_000_000)  # the second is above 2^31-1 on purpose

#: Wrong JSON types by part number modulo 20, as pattern and replacement (the oracle counts them by the same numbers).
TYPE_FAULTS = {5: (r'"negotiated_rate":([0-9.E]+)', r'"negotiated_rate":"$1"'), 6: (r'"version":"[^"]*"', r'"version":1'),
               7: (r'"service_code":\["([0-9]+)"\]', r'"service_code":"$1"'), 8: (r'"npi":\[([0-9]+),', r'"npi":["$1",')}

# Seeded contract faults (documented so the audit oracle can count them).
SEEDED_FAULTS = {
    "billing_class 'BAD'": "l_linenumber = 7",
    "expiration_date missing": "l_partkey % 50 = 0",
    "expiration_date not YYYY-MM-DD": "l_linenumber = 6",
    "professional price without service_code": "l_quantity = 1 and billing_class = professional",
    "billing_code_modifier repeated": "l_linenumber = 5",
    "plan_name without the other plan fields": "p_size = 50",
}

# How a rate names its providers, and which items hold further codes (read by the oracles too).
INLINE = "l_linenumber = 3"  # groups in the rate itself
UNRESOLVED = "l_linenumber = 4"  # a reference to a group that the file does not hold
BUNDLED, COVERED = "p_size = 10", "p_size = 11"


def rates_file_path(partkey: Column, piece: Column) -> Column:
    return F.concat(F.lit("rates/"), partkey.cast("string"), F.lit("/part-"), piece.cast("string"), F.lit(".json"))


def _billing_class() -> Column:
    return (F.when(F.col("l_linenumber") == 7, F.lit("BAD"))
            .when(F.col("l_returnflag") == "R", F.lit("institutional"))
            .when(F.col("l_returnflag") == "A", F.lit("professional"))
            .otherwise(F.lit("both")))


def _price() -> Column:
    ship = F.col("l_shipdate")
    expiration = (F.when(F.col("l_partkey") % 50 == 0, F.lit(None).cast("string"))
                  .when(F.col("l_linenumber") == 6, F.date_format(ship, "MM/dd/yyyy"))
                  .otherwise(F.date_format(ship, "yyyy-MM-dd")))
    service = F.when(
        ~((F.col("l_quantity") == 1) & (F.col("l_returnflag") == "A")),
        F.array(F.lpad(F.col("l_linenumber").cast("string"), 2, "0")))
    modifier = F.when(F.col("l_linenumber") == 5, F.array(F.lit("26"), F.lit("26"))).otherwise(
        F.array().cast("array<string>"))
    return F.struct(
        F.lit("negotiated").alias("negotiated_type"),
        F.col("l_extendedprice").alias("negotiated_rate"),
        expiration.alias("expiration_date"),
        _billing_class().alias("billing_class"),
        service.alias("service_code"),
        modifier.alias("billing_code_modifier"),
        F.when(F.col("l_linenumber") == 2, F.concat(F.lit("order "), F.col("l_orderkey").cast("string"))).alias("additional_information"),
    )


def rate_sort_key() -> list[str]:
    """Order of negotiated rates inside a file (also used by the oracles)."""
    return ["l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice", "l_shipdate", "l_returnflag", "l_quantity"]


def rates_documents(spark: SparkSession, sf_dir: str, rates_per_doc: int = 1000) -> DataFrame:
    """Rows of (file_path, value) with ``value`` the JSON text of one rate file.

    Which parts need several pieces is known before lines move (``heavy_keys``), so lines move once: they are spread by
    (part, piece) as plain columns over tasks that grow with them, and grouped there;
    part names, one row for each piece, are spread alike and join the grouped files where they are.
    Provider fields all derive from the supplier key on the line, so no
    supplier join is needed."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_returnflag", "l_shipdate", row_salt().alias("salt"))
    n_tasks = tasks_for(lines)
    parts = table(spark, sf_dir, "lineitem").select("l_partkey", F.lit(1).alias("n")).where(F.col("l_partkey").isNotNull())
    heavy = heavy_keys(parts, "l_partkey", rates_per_doc, lines.count())
    groups = F.array(F.struct(
        F.array(*[F.lit(b) + F.col("l_suppkey") for b in NPI_BASES]).alias("npi"),
        F.struct(F.lit("ein").alias("type"), F.lpad(F.col("l_suppkey").cast("string"), 9, "0").alias("value")).alias("tin"),
    ))
    inline, unresolved = F.expr(INLINE), F.expr(UNRESOLVED)
    rate = F.struct(
        F.array(_price()).alias("negotiated_prices"),
        F.when(~inline, F.array(F.when(unresolved, -1 - F.col("l_suppkey")).otherwise(F.col("l_suppkey")))).alias("provider_references"),
        F.when(inline, groups).alias("provider_groups"),
    )
    provider = F.when(~inline & ~unresolved, F.struct(F.col("l_suppkey").alias("provider_group_id"), groups.alias("provider_groups")))
    keyed = (
        lines.where(F.col("l_partkey").isNotNull()).join(heavy, "l_partkey", "left")
        .withColumn("piece", F.coalesce(_piece(F.col("n"), F.col("salt"), rates_per_doc), F.lit(0))).drop("n", "salt")
        .repartition(n_tasks, "l_partkey", "piece")
        .select(
            "l_partkey",
            "piece",
            F.struct(*[F.col(c) for c in rate_sort_key()], rate.alias("r")).alias("keyed_rate"),
            provider.alias("provider"),
            F.col("l_shipdate"),
        )
    )
    docs = keyed.groupBy("l_partkey", "piece").agg(
        F.transform(F.sort_array(F.collect_list("keyed_rate")), lambda x: x["r"]).alias("negotiated_rates"),
        F.sort_array(F.collect_set("provider")).alias("provider_references"),
        F.date_format(F.max("l_shipdate"), "yyyy-MM-dd").alias("last_updated_on"),
    )
    part = (table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
            .join(heavy.withColumnRenamed("l_partkey", "p_partkey"), "p_partkey", "left")
            .withColumn("part_piece", F.explode(F.sequence(F.lit(0), F.coalesce(n_pieces(F.col("n"), rates_per_doc), F.lit(1)).cast("int") - 1)))
            .drop("n").repartition(n_tasks, "p_partkey", "part_piece").hint("shuffle_hash"))
    code = F.array(F.struct(F.lit("LOCAL").alias("billing_code_type"), F.lit("1").alias("billing_code_type_version"),
                            F.col("p_brand").alias("billing_code"), F.col("p_type").alias("description")))
    bundled, covered = F.expr(BUNDLED), F.expr(COVERED)
    item = F.struct(
        F.when(bundled, "bundle").when(covered, "capitation").otherwise("ffs").alias("negotiation_arrangement"),
        F.col("p_name").alias("name"),
        F.lit("LOCAL").alias("billing_code_type"),
        F.lit("1").alias("billing_code_type_version"),
        F.col("p_partkey").cast("string").alias("billing_code"),
        F.col("p_type").alias("description"),
        F.col("negotiated_rates"),
        F.when(bundled, code).alias("bundled_codes"), F.when(covered, code).alias("covered_services"),
    )
    return docs.join(part, (docs.l_partkey == part.p_partkey) & (docs.piece == part.part_piece)).select(
        rates_file_path(F.col("l_partkey"), F.col("piece")).alias("file_path"),
        F.to_json(F.struct(
            F.col("p_brand").alias("reporting_entity_name"),
            F.lit(ENTITY_TYPE).alias("reporting_entity_type"),
            F.when(F.col("p_size") == 50, F.col("p_name")).alias("plan_name"),
            F.col("last_updated_on"),
            F.lit(VERSION).alias("version"),
            F.col("provider_references"),
            F.array(item).alias("in_network"),
        )).alias("value"),
    )


def with_type_faults(docs: DataFrame) -> DataFrame:
    """Rate files of which some hold values of a wrong JSON type (``TYPE_FAULTS``)."""
    part, value = F.split("file_path", "/")[1].cast("long"), F.col("value")
    for n, (old, new) in TYPE_FAULTS.items():
        value = F.when(part % 20 == n, F.regexp_replace("value", old, new)).otherwise(value)
    return docs.withColumn("value", value)
