"""Streaming queries.

Each query lands table-derived files in a fresh folder under the shared
checkpoint folder, runs a triggered (``availableNow``) stream over them, and
returns the table the stream wrote.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import flatten as fl
from ..operators import quality as qa
from ..operators import rates as rt
from ..operators import rescue
from ..operators import reshape as rs
from ..functions.keys import hash_key
from ..session import NO_OLD_SHUFFLES, scratch_path, with_settings
from ..sources.change_log import change_log, with_truncate_at_middle
from ..sources.chain import StreamDefinition, run_chain
from ..sources.declared import Check, DeclaredColumn, DeclaredTable
from ..sources.files import read_lines, stream_all_strings, stream_lines, stream_whole_files
from ..sources.index_docs import with_index_faults
from ..sources.bronze import index_bronze_table, rates_bronze_table
from ..sources.schemas import RATES_SCHEMA
from ..sources.sinks import FILES_PER_TASK, stream_to_table, write_document_files
from ..sources.tables import table, tasks_for
from ..streaming.scd1 import Scd1Target
from ..streaming.metrics import run_with_metrics
from ..streaming.windows import closed_windows, latest_updates, tumbling_counts, updates_to_folder
from .cdc_plans import KEYS, SEQ, VALUES
from .cdc_plans import ORACLE as CDC_ORACLE
from .index_plans import INDEX_RULES, ORDER_KEYS
from .index_plans import ORACLE as INDEX_ORACLE
from .rates_plans import ORACLE as RATES_ORACLE

FLAT_OUT = ["reporting_entity_name", "reporting_entity_type", "file_type", "file_description", "file_location",
            "structure_pos", "entry_pos"]


def q_stream_flatten(spark, sf_dir):
    """JSON Lines index files -> stream -> in-network rows with their file's source id and their key.

    The landed files are listed beside the result: every row's source id must be the key of one of them, and every
    row key that of its fields."""
    root = scratch_path(spark, "stream_flatten")
    index_bronze_table(spark, sf_dir).select("value").write.option("compression", "gzip").text(f"{root}/landing")
    src = stream_lines(spark, f"{root}/landing", max_files_per_trigger=4).select("index_file_source_id", "value")
    # a gzipped file is read by one task: the documents of a micro-batch are flattened by all
    src = src.repartition(2 * spark.sparkContext.defaultParallelism, "value")
    rows = fl.in_network_file_index(fl.flatten_index(src))
    with with_settings(spark, NO_OLD_SHUFFLES):
        stream_to_table(rows, f"{root}/in_network", f"{root}/_checkpoints/in_network")
    out = spark.read.schema(rows.schema).parquet(f"{root}/in_network")
    landed = read_lines(spark, f"{root}/landing").groupBy("index_file_source_id").agg(F.count(F.lit(1)).alias("n_documents"))
    # a row for each landed file: stored, its size tells before the join that the rows need not move to it
    landed.write.parquet(f"{root}/landed")
    known = out.join(spark.read.schema(landed.schema).parquet(f"{root}/landed"), "index_file_source_id", "left")
    return known.select(*FLAT_OUT, F.col("n_documents").isNotNull().alias("source_known"),
                        F.col("in_network_file_index_id").eqNullSafe(hash_key(
                            "index_file_source_id", "reporting_entity_name", "reporting_entity_type", "file_type", "file_description",
                            "file_location", "structure_pos", "entry_pos")).alias("key_holds"))


def q_stream_expectations(spark, sf_dir):
    """Q1 on a stream: index files with seeded faults; the failures that each micro-batch observed are gathered by a
    listener into a table and summed."""
    root = scratch_path(spark, "stream_expectations")
    with_index_faults(index_bronze_table(spark, sf_dir).select("file_path", "value")).select("value").write.text(f"{root}/landing")
    src = stream_lines(spark, f"{root}/landing", max_files_per_trigger=3)
    flat = qa.observe_specs(fl.flatten_index(src.select("index_file_source_id", "value")), "index_rules", INDEX_RULES)
    writer = (flat.writeStream.format("parquet").outputMode("append").option("path", f"{root}/flat")
              .option("checkpointLocation", f"{root}/_checkpoints/flat").trigger(availableNow=True))
    per_batch = qa.observed_counts(run_with_metrics(spark, writer, f"{root}/metrics"), INDEX_RULES)
    return per_batch.groupBy("table_name", "rule").agg(F.sum("n_rows").alias("n_rows"), F.sum("n_failed").alias("n_failed"))


def q_stream_all_strings(spark, sf_dir):
    """Event documents that differ in their fields (users, lists and props by type), streamed with an inferred schema of strings."""
    root = scratch_path(spark, "stream_all_strings")
    ev = table(spark, sf_dir, "events")
    doc = F.to_json(F.struct(
        F.col("event_id"), F.when(F.col("event_type") != "view", F.struct(F.col("user_id").alias("id"))).alias("user"),
        F.when(F.col("event_type") == "click", F.array(F.col("user_id"), F.col("event_id"))).alias("tags"),
        F.when(F.col("event_type") == "purchase", "once").alias("odd-name")))
    # the same field is a number in some documents and text in others
    doc = F.when(F.col("event_type") == "error", F.replace(doc, F.lit('{"event_id":'), F.lit('{"user_flag":true,"event_id":'))).otherwise(doc)
    ev.select(doc.alias("value")).write.text(f"{root}/landing")
    src = stream_all_strings(spark, f"{root}/landing", max_files_per_trigger=2)
    stream_to_table(src, f"{root}/events", f"{root}/_checkpoints/events")
    out = spark.read.schema(src.schema).parquet(f"{root}/events")
    return out.select("event_id", F.col("user.id").alias("user_id"), F.array_join("tags", ",").alias("tags"),
                      F.col("`odd-name`").alias("odd_name"), "user_flag", F.col("_corrupt_record").alias("corrupt"))


#: The plans table as declared: keys must be there, a missing market type is a group plan, a plan has no location.
PLANS_TABLE = DeclaredTable(
    [DeclaredColumn("index_file_source_id", "string", not_null="fail"), DeclaredColumn("file_type", "string", not_null="fail"),
     DeclaredColumn("reporting_entity_name", "string"), DeclaredColumn("reporting_plan_id", "string", not_null="drop"),
     DeclaredColumn("reporting_plan_market_type", "string", default="'group'"), DeclaredColumn("file_downloaded", "map<string,string>", default="map()"),
     DeclaredColumn("file_location", "string")],
    [Check("valid_file_type", "file_type = 'reporting_plans'", "drop"), Check("file_location_is_null", "file_location IS NULL")])


def q_stream_declared_plans(spark, sf_dir):
    """K2, Q3: reporting plans streamed into a declared table; files of customers divisible by 3 lack market types, those
    divisible by 13 plan ids (their plans are dropped), those divisible by 11 (not 5) have plans with a location (kept)."""
    root = scratch_path(spark, "stream_declared")
    docs = with_index_faults(index_bronze_table(spark, sf_dir).select("file_path", "value"))
    pk = F.split("file_path", "/")[1].cast("long")
    value = F.when(pk % 3 == 0, F.replace("value", F.lit('"plan_market_type":'), F.lit('"market":'))).otherwise(F.col("value"))
    value = F.when(pk % 13 == 0, F.replace(value, F.lit('"plan_id":'), F.lit('"plan":'))).otherwise(value)
    docs.select(value.alias("value")).write.text(f"{root}/landing")
    src = stream_lines(spark, f"{root}/landing", max_files_per_trigger=4)
    plans = fl.flatten_index(src.select("index_file_source_id", "value")).where(F.col("file_type").startswith("reporting"))
    rows = PLANS_TABLE.rows(plans, observe="plans")
    stream_to_table(rows, f"{root}/plans", f"{root}/_checkpoints/plans")
    return spark.read.schema(rows.schema).parquet(f"{root}/plans").select(
        "reporting_entity_name", "reporting_plan_id", "reporting_plan_market_type", F.size("file_downloaded").alias("n_downloaded"), "file_location")


def q_chained_streams(spark, sf_dir):
    """Landed files -> bronze table -> flat table -> in-network and plans tables, each a stream of the one before.

    More files land between two runs; the second run reads only these, and a third one nothing."""
    root = scratch_path(spark, "chain")
    prefix = root.rsplit("/", 1)[1].replace("-", "_") + "_"
    docs = index_bronze_table(spark, sf_dir).select(F.split("file_path", "/")[1].cast("long").alias("pk"), "value")
    chain = [
        StreamDefinition("plans", lambda d: fl.reporting_plans(d), source_table="flat"),
        StreamDefinition("flat", lambda d: fl.flatten_index(d), source_table="bronze"),
        StreamDefinition("in_network", lambda d: fl.in_network_file_index(d), source_table="flat"),
        StreamDefinition("bronze", lambda d: d.select("index_file_source_id", "value"), source_folder=f"{root}/landing"),
    ]
    runs = []
    for part in (0, 1, None):
        if part is not None:
            docs.where(F.col("pk") % 2 == part).select("value").write.mode("append").text(f"{root}/landing")
        runs.append(run_chain(spark, chain, root, prefix))
    counts = [spark.table(prefix + t).select(F.lit(t).alias("table_name")) for t in ("bronze", "flat", "in_network", "plans")]
    both = counts[0].unionByName(counts[1]).unionByName(counts[2]).unionByName(counts[3])
    third = F.create_map(*[x for t, n in runs[2].items() for x in (F.lit(t), F.lit(n).cast("long"))])
    return both.groupBy("table_name").agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_read_again", third[F.col("table_name")])


#: Events of the second landed file, and those of the last one, which come late: one in ten each.
SECOND, LATE = "event_id % 10 = 4", "event_id % 10 = 3"


def _stream_late(spark, sf_dir):
    """The events that come in time land in two files, the late ones in a third after them.

    One file is one micro-batch, and files come in the order of their times.  Spark drops rows behind the watermark that
    the batch before was run with, which is two hours behind the latest time of the first file when the third comes."""
    root = scratch_path(spark, "stream_late")
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "event_type")
    for n, part in enumerate((ev.where(f"NOT ({SECOND}) AND NOT ({LATE})"), ev.where(SECOND), ev.where(LATE))):
        part.coalesce(1).write.parquet(f"{root}/landing/part={n}")
    src = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/landing/*")
    agg = closed_windows(src, "ts", "1 day", "2 hours", ["event_type"], ["event_id"])
    writer = (agg.writeStream.format("parquet").outputMode("append").option("path", f"{root}/windows")
              .option("checkpointLocation", f"{root}/_checkpoints/windows").trigger(availableNow=True))
    metrics = run_with_metrics(spark, writer, f"{root}/metrics")
    return spark.read.schema(agg.schema).parquet(f"{root}/windows"), metrics


def q_stream_closed_windows(spark, sf_dir):
    """Closed daily windows per event type, without the rows that came too late."""
    return _stream_late(spark, sf_dir)[0]


def q_stream_late_rows(spark, sf_dir):
    """How many rows were read, and how many the watermark dropped, from the stored metrics of the stream."""
    metrics = _stream_late(spark, sf_dir)[1]
    total = lambda m: F.coalesce(F.sum(F.when(F.col("metric") == m, F.col("value"))), F.lit(0))
    return metrics.agg(total("rows_read").alias("n_read"), total("rows_dropped_by_watermark").alias("n_dropped"))


#: Keys in one bucket of an SCD1 target, at most and about.
ROWS_PER_BUCKET = 500_000


def q_stream_pivot(spark, sf_dir):
    """(order, key, value) rows stream in by key, so the keys of an order come in different micro-batches; the pivot is
    streaming aggregation state in update mode, and its updates go to a keyed target, the latest batch winning.

    Values are text, which Spark aggregates over sorted rows: those of a micro-batch are spread over tasks that grow with
    them before they are sorted."""
    root = scratch_path(spark, "stream_pivot")
    docs = table(spark, sf_dir, "orders").select("o_orderkey", F.try_parse_json(F.to_json(F.struct(
        "o_custkey", "o_orderstatus", "o_orderpriority"))).alias("v"))
    kv = rs.explode_object(docs, "v", keep=["o_orderkey"]).select("o_orderkey", "key", F.col("value").cast("string").alias("value"))
    kv.repartitionByRange(3, "key").write.parquet(f"{root}/landing")
    src = spark.readStream.schema(kv.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/landing")
    orders = table(spark, sf_dir, "orders")
    src = src.repartition(tasks_for(orders), "o_orderkey")
    wide = rs.pivot_values(src, ["o_orderkey"], "key", "value", ORDER_KEYS)
    target = Scd1Target(spark, f"{root}/target", ["o_orderkey"], ["batch"], columns=["o_orderkey", *ORDER_KEYS, "batch"],
                        n_buckets=max(8, tasks_for(orders, ROWS_PER_BUCKET)))

    def upsert(batch, batch_id):
        target.apply_batch(batch.withColumns({"batch": F.lit(batch_id).cast("long"), "_change_type": F.lit("update_postimage")}), batch_id)

    q = (wide.writeStream.outputMode("update").foreachBatch(upsert)
         .option("checkpointLocation", f"{root}/_checkpoints/pivot").trigger(availableNow=True).start())
    q.awaitTermination()
    return target.current().select("o_orderkey", *ORDER_KEYS)


def index_changes(spark, sf_dir):
    """A change feed of allowed-amount index rows (stand-in input), by order number: all are inserted; every third is amended a day
    later; every seventh deleted two days later; for every fifth a change from before the insert arrives last of all."""
    rows = fl.allowed_amount_file_index(fl.flatten_parsed(index_bronze_table(spark, sf_dir).select("index_file_source_id", "doc")))
    rows = rows.withColumn("order_key", F.regexp_extract("file_location", r"/(\d+)\.json$", 1).cast("long"))
    at = lambda day: F.timestamp_seconds(F.lit(1_700_000_000 + 86_400 * day) + F.col("order_key") % 3600)
    kinds = [("insert", 0, "true", "file_description"), ("update_postimage", 1, "order_key % 3 = 0", "'amended'"),
             ("delete", 2, "order_key % 7 = 0", "file_description"), ("update_postimage", -1, "order_key % 5 = 0", "'stale'")]
    # all changes of a row come from one flatten of the documents
    changes = F.array(*[F.when(F.expr(which), F.struct(
        F.expr(text).alias("text"), at(day).alias("_commit_timestamp"), F.lit(kind).alias("_change_type"), F.lit(arrives).alias("arrives")))
        for arrives, (kind, day, which, text) in enumerate(kinds)])
    out = rows.select("*", F.explode(F.filter(changes, lambda c: c.isNotNull())).alias("c")).select(*rows.columns, "c.*")
    return out.drop("file_description").withColumnRenamed("text", "file_description")


INDEX_KEY = ["index_file_source_id", "reporting_entity_name", "reporting_entity_type", "file_type", "file_location", "structure_pos", "entry_pos"]


def q_stream_index_apply(spark, sf_dir):
    """T5, T6, T8 on index rows: changes keyed by the entry's place and ordered by (window of the commit, commit time)."""
    root = scratch_path(spark, "stream_index_apply")
    log = index_changes(spark, sf_dir)
    log.repartitionByRange(8, "arrives", "order_key").write.parquet(f"{root}/changes")
    src = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/changes")
    landed = spark.read.schema(log.schema).parquet(f"{root}/changes")
    src = src.repartition(tasks_for(landed), *INDEX_KEY)
    src = src.withColumn("window_start", F.window("_commit_timestamp", "1 hour")["start"])
    target = Scd1Target(spark, f"{root}/target", INDEX_KEY, ["window_start", "_commit_timestamp"], max_deltas=3,
                        n_buckets=max(8, tasks_for(landed, ROWS_PER_BUCKET)),
                        columns=[*INDEX_KEY, "allowed_amount_file_index_id", "file_description", "window_start", "_commit_timestamp", "_change_type"])
    q = (src.writeStream.foreachBatch(target.foreach_batch())
         .option("checkpointLocation", f"{root}/_checkpoints/apply").trigger(availableNow=True).start())
    q.awaitTermination()
    return target.current().select("allowed_amount_file_index_id", "file_location", "file_description")


#: The log of the files that a stream has read is written anew, as one, every so many micro-batches (10 by default): its
#: bytes grow with the square of the files.
FEW_LOG_COPIES = {"spark.sql.streaming.fileSource.log.compactInterval": "100"}


def q_stream_whole_files(spark, sf_dir):
    """S1-S4 with file semantics: every index document is its own file (written
    with ``maxRecordsPerFile=1``, no driver loop), streamed back whole
    (``wholetext``, up to 5,000 files per micro-batch) and flattened.  Its cost
    is dominated by creating thousands of tiny files; at scale, land JSON Lines
    (``q_stream_flatten``)."""
    root = scratch_path(spark, "stream_whole_files")
    docs = index_bronze_table(spark, sf_dir).select("value")
    with with_settings(spark, NO_OLD_SHUFFLES):
        write_document_files(docs, f"{root}/landing", "value", tasks_for(docs, FILES_PER_TASK), compression="gzip")
    src = stream_whole_files(spark, f"{root}/landing", max_files_per_trigger=5000)
    flat = fl.flatten_index(src.select("index_file_source_id", "value"))
    rows = flat.where(F.col("file_type").startswith("in_network")).select(*FLAT_OUT)
    # a scan makes a task of 32 small files at most, and each task a file: a few tasks for each core write fewer files
    tasks = 4 * spark.sparkContext.defaultParallelism
    # Spark looks up the files of each micro-batch again, by default in a task for each file
    with with_settings(spark, {"spark.sql.sources.parallelPartitionDiscovery.parallelism": str(tasks)} | FEW_LOG_COPIES):
        stream_to_table(rows.coalesce(tasks), f"{root}/in_network", f"{root}/_checkpoints/in_network")
    return spark.read.parquet(f"{root}/in_network")


def land_rate_lines(spark, sf_dir, root: str) -> None:
    """Rate files as JSON Lines, half of them gzipped and half in LZ4, with saved web pages among them.

    By part number, one in twenty each: a further root field, a further field inside an item, a price that is text, and a text cut off."""
    docs = rates_bronze_table(spark, sf_dir).select(F.split("file_path", "/")[1].cast("long").alias("pk"), "value")
    v, kind = F.col("value"), F.col("pk") % 20
    value = (F.when(kind == 1, F.concat(F.lit('{"vendor_note":"x",'), F.expr("substring(value, 2)")))
             .when(kind == 2, F.regexp_replace(v, r'^(.*?"in_network":\[\{)', r'$1"surcharge":{"a":[1]},'))
             .when(kind == 3, F.regexp_replace(v, r'^(.*?"negotiated_rate":)[0-9.E]+', r'$1"n/a"'))
             .when(kind == 4, F.expr("substring(value, 1, length(value) - 2)")).otherwise(v))
    pages = table(spark, sf_dir, "pages").select(F.regexp_replace("html", r"[\r\n]+", " ").alias("value"))
    docs.where("pk % 2 = 0").select(value.alias("value")).unionByName(pages).write.option("compression", "lz4").text(f"{root}/landing/lz4")
    docs.where("pk % 2 = 1").select(value.alias("value")).write.option("compression", "gzip").text(f"{root}/landing/gz")


def _stream_rates(spark, sf_dir, status: str):
    """The landed lines streamed, compared with the declared schema, and each micro-batch split.

    Landed files go once the batch that read them is written: nothing else reads them."""
    root = scratch_path(spark, "stream_rates")
    land_rate_lines(spark, sf_dir, root)
    src = stream_lines(spark, f"{root}/landing/*", max_files_per_trigger=4, clean_source="delete")
    # a compressed file is read by one task: the lines of a micro-batch are parsed by all
    src = src.repartition(2 * spark.sparkContext.defaultParallelism, "value")
    read = rescue.read_with_rescue(src, RATES_SCHEMA, keep=["index_file_source_id"])
    with with_settings(spark, NO_OLD_SHUFFLES):
        q = (read.writeStream.foreachBatch(rescue.split_writer(f"{root}/rates"))
             .option("checkpointLocation", f"{root}/_checkpoints/rates").trigger(availableNow=True).start())
        q.awaitTermination()
    return rescue.split_table(spark, f"{root}/rates", read.schema, status)


def q_stream_rates(spark, sf_dir):
    """The kept documents of the rates stream, flattened to prices."""
    kept = _stream_rates(spark, sf_dir, "kept")
    return rt.rates_fact(kept, keep=["index_file_source_id"]).select(
        "billing_code", "rate_pos", "negotiated_rate", "billing_class", "provider_references", "n_inline_groups")


def q_rates_quarantine(spark, sf_dir):
    """What the rates stream set aside, with the reason and the first rescued field."""
    bad = _stream_rates(spark, sf_dir, "quarantine")
    paths = F.array_sort(F.expr(f"json_object_keys({rescue.RESCUED})"))
    rows = bad.select("reason", rescue.RESCUED, F.try_variant_get(F.try_parse_json("value"), "$.in_network[0].billing_code", "string").alias("billing_code"),
                      F.coalesce(F.size(paths), F.lit(0)).alias("n"), paths[0].alias("rescued_path"))
    return rows.select("billing_code", "reason", F.greatest("n", F.lit(0)).alias("n_rescued"), "rescued_path",
                       F.from_json(rescue.RESCUED, "map<string,string>")[F.col("rescued_path")].alias("rescued_json"))


def q_stream_tumbling(spark, sf_dir):
    """Watermarked daily windows per event type, update mode."""
    root = scratch_path(spark, "stream_tumbling")
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    ev.repartitionByRange(4, "event_id").write.parquet(f"{root}/landing")
    src = spark.readStream.schema(ev.schema).parquet(f"{root}/landing")
    agg = tumbling_counts(src, "ts", "1 day", "1 hour", ["event_type"])
    q = (agg.writeStream.outputMode("update").foreachBatch(updates_to_folder(f"{root}/updates"))
         .option("checkpointLocation", f"{root}/_checkpoints/windows").trigger(availableNow=True).start())
    q.awaitTermination()
    return latest_updates(spark, f"{root}/updates", ["window_start", "window_end", "event_type"])


def _stream_scd1(spark, log):
    root = scratch_path(spark, "stream_scd1")
    log.repartitionByRange(5, "event_id").write.parquet(f"{root}/change_log")
    src = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/change_log")
    target = Scd1Target(spark, f"{root}/target", KEYS, SEQ,
                        columns=["user_id", "value", "event_type", "ts", "event_id", "_change_type"], n_buckets=8)
    q = (src.writeStream.foreachBatch(target.foreach_batch())
         .option("checkpointLocation", f"{root}/_checkpoints/scd1").trigger(availableNow=True).start())
    q.awaitTermination()
    return target.current().select(*KEYS, *VALUES)


def q_stream_scd1(spark, sf_dir):
    """S11, T5-T8 in a stream: the change log, one file per micro-batch, applied
    to a versioned, bucketed SCD1 target through ``foreachBatch``."""
    return _stream_scd1(spark, change_log(spark, sf_dir))


def q_stream_scd1_truncate(spark, sf_dir):
    """T7 in a stream: the truncate of the log's middle comes in one micro-batch, and the
    batches come in the order of file times, so rows below it can also come later."""
    log = with_truncate_at_middle(change_log(spark, sf_dir))
    return _stream_scd1(spark, log)


_ORDERS_POS_SQL = """
WITH o AS (SELECT o_orderkey, o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS structure_pos
           FROM orders),
  f AS (SELECT l_orderkey, CAST(l_linenumber AS VARCHAR) AS file_description,
               'https://h/' || l_partkey || '-' || l_suppkey || '.json.gz' AS file_location FROM lineitem),
  fp AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY file_description, file_location) - 1 AS entry_pos FROM f)
SELECT c_name AS reporting_entity_name, c_mktsegment AS reporting_entity_type, 'in_network_files' AS file_type,
       file_description, file_location, structure_pos, entry_pos
FROM fp JOIN o ON fp.l_orderkey = o.o_orderkey JOIN customer ON c_custkey = o.o_custkey"""

_IN_TIME = f"""
WITH m AS (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 2 HOUR AS mark FROM events WHERE NOT ({SECOND}) AND NOT ({LATE})),
  k AS (SELECT events.* FROM events, m WHERE NOT ({LATE}) OR ts > mark)"""

ORACLE = {
    "stream_flatten": f"SELECT *, true AS source_known, true AS key_holds FROM ({_ORDERS_POS_SQL})",
    "stream_expectations": INDEX_ORACLE["expectation_counts"],
    "stream_closed_windows": _IN_TIME + """
SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS window_start, CAST(date_trunc('day', ts) + INTERVAL 1 DAY AS TIMESTAMP) AS window_end,
       event_type, count(*) AS n_events
FROM k WHERE date_trunc('day', ts) + INTERVAL 1 DAY <= (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 2 HOUR FROM k)
GROUP BY 1, 2, 3""",
    "stream_late_rows": _IN_TIME + """
SELECT (SELECT count(*) FROM events) AS n_read, (SELECT count(*) FROM events) - (SELECT count(*) FROM k) AS n_dropped""",
    "stream_pivot": INDEX_ORACLE["pivot_keys"],
    "stream_index_apply": f"""
WITH r AS ({INDEX_ORACLE['allowed_amount_index']}), k AS (SELECT *, regexp_extract(file_location, '/(\\d+)\\.json$', 1)::BIGINT AS o FROM r)
SELECT allowed_amount_file_index_id, file_location, CASE WHEN o % 3 = 0 THEN 'amended' ELSE file_description END AS file_description
FROM k WHERE o % 7 <> 0""",
    "stream_whole_files": _ORDERS_POS_SQL,
    "stream_tumbling": """
SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS window_start,
       CAST(date_trunc('day', ts) + INTERVAL 1 DAY AS TIMESTAMP) AS window_end, event_type, count(*) AS n_events
FROM events GROUP BY 1, 2, 3""",
    "stream_scd1": CDC_ORACLE["scd1_current"],
    "stream_scd1_truncate": CDC_ORACLE["scd1_truncate"],
}

ORACLE["stream_rates"] = f"""
WITH f AS ({RATES_ORACLE['rates_fact']})
SELECT billing_code, rate_pos, negotiated_rate, billing_class, provider_references, n_inline_groups FROM f
WHERE billing_code::BIGINT % 20 NOT IN (1, 2, 3, 4)"""
ORACLE["rates_quarantine"] = """
WITH d AS (SELECT DISTINCT l_partkey AS pk FROM lineitem)
SELECT CASE WHEN pk % 20 <> 4 THEN pk::VARCHAR END AS billing_code,
       CASE WHEN pk % 20 = 4 THEN 'not valid JSON' ELSE 'fields outside the schema' END AS reason, (pk % 20 <> 4)::INTEGER AS n_rescued,
       CASE pk % 20 WHEN 1 THEN '$.vendor_note' WHEN 2 THEN '$.in_network[0].surcharge'
                    WHEN 3 THEN '$.in_network[0].negotiated_rates[0].negotiated_prices[0].negotiated_rate' END AS rescued_path,
       CASE pk % 20 WHEN 1 THEN '"x"' WHEN 2 THEN '{"a":[1]}' WHEN 3 THEN '"n/a"' END AS rescued_json
FROM d WHERE pk % 20 IN (1, 2, 3, 4)
UNION ALL SELECT NULL, 'not valid JSON', 0, NULL, NULL FROM pages"""

ORACLE["stream_all_strings"] = """
SELECT event_id::VARCHAR AS event_id, CASE WHEN event_type <> 'view' THEN user_id::VARCHAR END AS user_id,
       CASE WHEN event_type = 'click' THEN user_id || ',' || event_id END AS tags, CASE WHEN event_type = 'purchase' THEN 'once' END AS odd_name,
       CASE WHEN event_type = 'error' THEN 'true' END AS user_flag, NULL::VARCHAR AS corrupt FROM events"""
ORACLE["stream_declared_plans"] = """
SELECT c_name AS reporting_entity_name, o_orderkey::VARCHAR AS reporting_plan_id,
       CASE WHEN o_custkey % 3 = 0 THEN 'group' ELSE o_orderstatus END AS reporting_plan_market_type, 0 AS n_downloaded,
       CASE WHEN o_custkey % 11 = 0 AND o_custkey % 5 <> 0 THEN 'x' END AS file_location
FROM orders JOIN customer ON c_custkey = o_custkey WHERE o_custkey % 13 <> 0"""
ORACLE["chained_streams"] = """
WITH n AS (SELECT (SELECT count(DISTINCT o_custkey) FROM orders) AS docs, (SELECT count(*) FROM lineitem) AS files, (SELECT count(*) FROM orders) AS plans,
                  (SELECT count(*) FROM orders WHERE o_orderstatus = 'F') AS amounts)
SELECT 'bronze' AS table_name, docs AS n_rows, 0::BIGINT AS n_read_again FROM n UNION ALL SELECT 'flat', files + plans + amounts, 0 FROM n
UNION ALL SELECT 'in_network', files, 0 FROM n UNION ALL SELECT 'plans', plans, 0 FROM n"""

QUERIES = {
    "stream_all_strings": q_stream_all_strings,
    "stream_declared_plans": q_stream_declared_plans,
    "chained_streams": q_chained_streams,
    "stream_expectations": q_stream_expectations,
    "stream_closed_windows": q_stream_closed_windows,
    "stream_late_rows": q_stream_late_rows,
    "stream_pivot": q_stream_pivot,
    "stream_index_apply": q_stream_index_apply,
    "stream_rates": q_stream_rates,
    "rates_quarantine": q_rates_quarantine,
    "stream_flatten": q_stream_flatten,
    "stream_whole_files": q_stream_whole_files,
    "stream_tumbling": q_stream_tumbling,
    "stream_scd1": q_stream_scd1,
    "stream_scd1_truncate": q_stream_scd1_truncate,
}
