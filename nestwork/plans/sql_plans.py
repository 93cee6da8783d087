"""Spark SQL text as a user writes it: a temp view, a CTE chain, pipe syntax, lateral generators.

``event_props_sql`` profiles the JSON properties of the events: each property value is put
beside the event, and every event type is summed up per property, with the number of values in the
upper half of the scale.
"""

from __future__ import annotations

from ..functions.variant import parse
from ..operators import chunking as ch
from ..sources.rates_docs import INLINE, UNRESOLVED
from ..sources.tables import table
from .chunk_plans import RATE_CHUNK, RATE_PATH, REF_CHUNK, REF_PATH, rate_docs

PROPS_SQL = """
WITH typed AS (SELECT * EXCEPT (ts, props) FROM {view} WHERE bag IS NOT NULL),
     spread AS (SELECT t.user_id, t.event_type, p.key AS prop, CAST(p.value AS BIGINT) AS amount
                FROM typed AS t, LATERAL variant_explode(t.bag) AS p)
FROM spread
|> WHERE amount IS NOT NULL
|> EXTEND amount >= 50 AS upper_half
|> AGGREGATE count(*) AS n_values, count_if(upper_half) AS n_upper, sum(amount) AS total,
             count(DISTINCT user_id) AS n_users GROUP BY event_type, prop
|> SELECT event_type, prop, n_values, n_upper, total, n_users
"""


def q_event_props_sql(spark, sf_dir):
    view = "nestwork_event_props"
    table(spark, sf_dir, "events").withColumn("bag", parse("props")).createOrReplaceTempView(view)
    return spark.sql(PROPS_SQL.format(view=view))


def q_path_counts(spark, sf_dir):
    """A3: objects and chunks per path, over one multi-path split."""
    cfg = [{"path": RATE_PATH, "chunk_size": RATE_CHUNK}, {"path": REF_PATH, "chunk_size": REF_CHUNK}]
    return ch.counts_per(ch.multi_path_chunks(rate_docs(spark, sf_dir), cfg, typed="typed"), ["json_path"])


ORACLE = {
    "event_props_sql": """
WITH p AS (SELECT user_id, event_type, unnest(json_keys(props)) AS prop, props FROM events),
  v AS (SELECT user_id, event_type, prop, CAST(json_extract_string(props, '$.' || prop) AS BIGINT) AS amount FROM p)
SELECT event_type, prop, count(*) AS n_values, count(*) FILTER (WHERE amount >= 50) AS n_upper,
       sum(amount)::BIGINT AS total, count(DISTINCT user_id) AS n_users
FROM v WHERE amount IS NOT NULL GROUP BY 1, 2""",
    "path_counts": f"""
WITH r AS (SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY l_partkey),
  s AS (SELECT l_partkey, count(DISTINCT l_suppkey) AS n FROM lineitem
        WHERE NOT ({INLINE} OR {UNRESOLVED}) GROUP BY l_partkey)
SELECT '{RATE_PATH}' AS json_path, sum(n)::BIGINT AS n_objects, sum(CAST(ceil(n / {RATE_CHUNK}) AS BIGINT))::BIGINT AS n_chunks FROM r
UNION ALL
SELECT '{REF_PATH}', sum(n)::BIGINT, sum(CAST(ceil(n / {REF_CHUNK}) AS BIGINT))::BIGINT FROM s""",
}

QUERIES = {
    "event_props_sql": q_event_props_sql,
    "path_counts": q_path_counts,
}
