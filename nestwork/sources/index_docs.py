"""Index documents built inside Spark from the driver tables (fixture F1).

One logical file per customer (split into parts of at most ``elements_per_doc``
structure elements), each holding one ``reporting_structure`` element per order
(split into pieces of at most ``entries_per_element`` in-network files).

No group is ever collected whole: orders with more lines than
``entries_per_element`` are spread over several elements by a row hash, and
customers with more orders than ``elements_per_doc`` over several documents, so
a hot key is cut into bounded pieces before any ``collect_list``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .tables import table, tasks_for

# Fixed values of the fixture layout.
LOCATION_PREFIX = "https://h/"
ALLOWED_PREFIX = "https://h/allowed/"
ALLOWED_DESCRIPTION = "allowed amount file"
PLAN_ID_TYPE = "EIN"


def n_pieces(count: Column, size: int) -> Column:
    """Pieces of a group of ``count`` rows, ``size`` rows each on average at most."""
    return F.greatest(F.lit(1), F.ceil(count / F.lit(size)))


def _piece(count: Column, salt: Column, size: int) -> Column:
    """Piece number in [0, ceil(count/size)): 0 for every small group."""
    return F.pmod(F.xxhash64(salt), n_pieces(count, size)).cast("int")


def row_salt() -> Column:
    """A per-row value that is unique and identical on every task retry: the
    source file and the row's position in it (exact copies of a row still get
    different salts, so a group of copies is spread too)."""
    return F.xxhash64(F.col("_metadata.file_path"), F.col("_metadata.row_index"))


def index_file_path(custkey: Column, part: Column) -> Column:
    return F.concat(F.lit("index/"), custkey.cast("string"), F.lit("/part-"), part.cast("string"), F.lit(".json"))


def packed(text: Column) -> Column:
    """A text of digits and ``,-;x`` with two characters in a byte (shuffles don't shorten digits)."""
    codes = F.translate(text, ",-;x", "abcd")
    return F.unhex(F.when(F.length(codes) % 2 == 1, F.concat(codes, F.lit("e"))).otherwise(codes))


def unpacked(binary: Column) -> Column:
    """The text, or texts one after another, that ``packed`` gave."""
    return F.translate(F.hex(binary), "ABCDE", ",-;x")


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def heavy_keys(rows: DataFrame, key: str, size: int, n_rows: int) -> DataFrame:
    """(``key``, ``n``) of the keys whose ``n`` of ``rows`` add up to more than ``size``; about ``n_rows`` are expected.

    Sums are built by hash buckets that hold a quarter of ``size`` on average, and by key only in buckets that hold more, so few
    rows move.  Buckets and keys are stored: the size on disk decides whether they join by broadcast."""
    bucket = F.pmod(F.xxhash64(key), F.lit(max(1, 4 * n_rows // size)))
    full = _stored(rows.groupBy(bucket.alias("bucket")).agg(F.sum("n").alias("n")).where(F.col("n") > size).select("bucket"), f"buckets-{key}")
    found = rows.withColumn("bucket", bucket).join(full, "bucket").groupBy(key).agg(F.sum("n").alias("n"))
    return _stored(found.where(F.col("n") > size), f"heavy-{key}")


def _pieces_of_orders(spark: SparkSession, sf_dir: str, entries_per_element: int) -> tuple[DataFrame, DataFrame]:
    """Orders with their customer and number of pieces, and the orders of more than one piece with their lines (``n``)."""
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    heavy = heavy_keys(lines.where(F.col("o_orderkey").isNotNull()).withColumn("n", F.lit(1)), "o_orderkey", entries_per_element, lines.count())
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    orders = (orders.where(F.col("o_custkey").isNotNull()).join(heavy, "o_orderkey", "left")
              .withColumn("n_pieces", F.coalesce(n_pieces(F.col("n"), entries_per_element), F.lit(1))).drop("n"))
    return orders, heavy


def _heavy_customers(spark: SparkSession, sf_dir: str, orders: DataFrame, elements_per_doc: int) -> DataFrame:
    """Customers of more than one document with their elements (``n``); one that stands twice has each element twice."""
    customer = table(spark, sf_dir, "customer").groupBy(F.col("c_custkey").alias("o_custkey")).agg(F.count(F.lit(1)).alias("times"))
    twice = _stored(customer.where((F.col("times") > 1) & F.col("o_custkey").isNotNull()), "repeated-customers")
    elements = orders.join(twice, "o_custkey", "left").select(
        "o_custkey", (F.col("n_pieces") * F.coalesce("times", F.lit(1))).alias("n"))
    return heavy_keys(elements, "o_custkey", elements_per_doc, table(spark, sf_dir, "orders").count())


def index_elements(spark: SparkSession, sf_dir: str, entries_per_element: int = 1000, elements_per_doc: int = 1000) -> tuple[DataFrame, DataFrame]:
    """Rows of the reporting_structure elements, with their document: (o_custkey, doc_part, o_orderkey, piece, plans, lines),
    and the documents of each customer: (o_custkey, doc_part, c_name, c_mktsegment, times).

    Lines move to their order as packed numbers, over tasks that grow with the lines and orders, and with it to its
    document; names of customers, one row for each document, are spread alike and join the grouped documents where they are.
    Which line goes to which piece, and which piece to which document, is known before they move (``heavy_keys``), so the
    rows of a hot order or customer go to many tasks."""
    n_tasks = tasks_for(table(spark, sf_dir, "lineitem").select("l_orderkey").unionAll(table(spark, sf_dir, "orders").select("o_orderkey")))
    orders, heavy_orders = _pieces_of_orders(spark, sf_dir, entries_per_element)
    heavy_customers = _heavy_customers(spark, sf_dir, orders, elements_per_doc)
    none = F.lit("x")
    line = F.concat(F.coalesce(F.col("l_linenumber").cast("string"), none), F.lit(","),
                    F.coalesce(F.concat(F.col("l_partkey").cast("string"), F.lit("-"), F.col("l_suppkey").cast("string")), none), F.lit(";"))
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), packed(line).alias("line"), row_salt().alias("salt"))
    lines = (lines.where(F.col("o_orderkey").isNotNull()).join(heavy_orders, "o_orderkey", "left")
             .select("o_orderkey", F.coalesce(_piece(F.col("n"), F.col("salt"), entries_per_element), F.lit(0)).alias("piece"), "line")
             .repartition(n_tasks, "o_orderkey", "piece")
             .groupBy("o_orderkey", "piece").agg(F.listagg("line").alias("lines")))
    # every piece of a split order carries its plan
    pieces = orders.withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("n_pieces").cast("int") - 1))).join(heavy_customers, "o_custkey", "left")
    doc_part = F.coalesce(_piece(F.col("n"), F.struct("o_orderkey", "piece"), elements_per_doc), F.lit(0))
    pieces = (pieces.select("o_orderkey", "piece", "o_custkey", doc_part.alias("doc_part"), F.struct("o_orderpriority", "o_orderstatus").alias("plan"))
              .repartition(n_tasks, "o_orderkey", "piece")
              .groupBy("o_orderkey", "piece", "o_custkey", "doc_part").agg(F.collect_list("plan").alias("plans")))
    elements = pieces.join(lines, ["o_orderkey", "piece"], "left").repartition(n_tasks, "o_custkey", "doc_part")
    customer = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment")
    n_docs = F.coalesce(n_pieces(F.col("n"), elements_per_doc), F.lit(1)).cast("int")
    customer = (customer.join(heavy_customers, "o_custkey", "left")
                .withColumn("doc_part", F.explode(F.sequence(F.lit(0), n_docs - 1)))
                .select("o_custkey", "doc_part", "c_name", "c_mktsegment").repartition(n_tasks, "o_custkey", "doc_part")
                .groupBy("o_custkey", "doc_part", "c_name", "c_mktsegment").agg(F.count(F.lit(1)).alias("times")))
    return elements, customer


def _element(x: Column, times: Column) -> Column:
    """The reporting_structure element of a row of ``index_elements``."""
    plan = F.transform(x["plans"], lambda p: F.struct(
        p["o_orderpriority"].alias("plan_name"), F.lit(PLAN_ID_TYPE).alias("plan_id_type"),
        x["o_orderkey"].cast("string").alias("plan_id"), p["o_orderstatus"].alias("plan_market_type")))
    texts = F.filter(F.split(F.coalesce(unpacked(x["lines"]), F.lit("")), ";"), lambda t: t != "")
    none = F.lit("x")
    entry = F.transform(texts, lambda t: F.struct(
        F.nullif(F.substring_index(t, ",", 1), none).alias("description"),
        F.concat(F.lit(LOCATION_PREFIX), F.nullif(F.substring_index(t, ",", -1), none), F.lit(".json.gz")).alias("location")))
    # the allowed-amount file stands on the first piece only
    allowed = F.when((x["piece"] == 0) & F.exists(x["plans"], lambda p: p["o_orderstatus"] == "F"), F.struct(
        F.lit(ALLOWED_DESCRIPTION).alias("description"), F.concat(F.lit(ALLOWED_PREFIX), x["o_orderkey"].cast("string"), F.lit(".json")).alias("location")))
    return F.struct(F.sort_array(_repeated(plan, times)).alias("reporting_plans"),
                    F.sort_array(_repeated(entry, times * F.size(x["plans"]))).alias("in_network_files"),
                    allowed.alias("allowed_amount_file"))


def _repeated(items: Column, times: Column) -> Column:
    """Orders and customers that stand twice give each entry twice, as a join does."""
    return F.when(times == 1, items).otherwise(F.flatten(F.array_repeat(items, times.cast("int"))))


def index_documents(spark: SparkSession, sf_dir: str, entries_per_element: int = 1000,
                    elements_per_doc: int = 1000) -> DataFrame:
    """Rows of (file_path, value) where ``value`` is the JSON text of one index file."""
    elements, customer = index_elements(spark, sf_dir, entries_per_element, elements_per_doc)
    docs = (elements.groupBy("o_custkey", "doc_part")
            .agg(F.sort_array(F.collect_list(F.struct("o_orderkey", "piece", "plans", "lines"))).alias("rs")))
    return docs.join(customer.hint("shuffle_hash"), ["o_custkey", "doc_part"]).select(
        index_file_path(F.col("o_custkey"), F.col("doc_part")).alias("file_path"),
        F.to_json(F.struct(
            F.col("c_name").alias("reporting_entity_name"),
            F.col("c_mktsegment").alias("reporting_entity_type"),
            F.transform("rs", lambda x: _element(x, F.col("times"))).alias("reporting_structure"),
        )).alias("value"),
    )


#: Faults of index files by customer number, as text replacements (the oracles count them by the same numbers).
INDEX_FAULTS = {7: ('"in_network_files":', '"in_network_file":'), 5: ('"location":', '"url":'), 11: ('"plan_id_type":', '"location":"x","plan_id_type":')}


def with_index_faults(docs: DataFrame) -> DataFrame:
    """Index files of which some have a misnamed type (customers divisible by 7), no locations (by 5), or plans with one (by 11, not 5)."""
    custkey = F.split("file_path", "/")[1].cast("long")
    value = F.col("value")
    for n, (old, new) in INDEX_FAULTS.items():
        on = (custkey % n == 0) & (custkey % 5 != 0) if n == 11 else custkey % n == 0
        value = F.when(on, F.replace(value, F.lit(old), F.lit(new))).otherwise(value)
    return docs.withColumn("value", value)
