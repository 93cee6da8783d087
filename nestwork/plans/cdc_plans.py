"""Change-data queries over ``events``."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import cdc
from ..sources.bronze import change_log_table
from ..sources.change_log import with_truncate_at_middle

KEYS = ["user_id"]
SEQ = ["ts", "event_id"]
VALUES = ["value", "event_type", "ts", "event_id"]


def q_scd1_current(spark, sf_dir):
    return cdc.apply_scd1(change_log_table(spark, sf_dir), KEYS, SEQ).select(*KEYS, *VALUES)


def q_scd1_truncate(spark, sf_dir):
    return cdc.apply_scd1(with_truncate_at_middle(change_log_table(spark, sf_dir)), KEYS, SEQ).select(*KEYS, *VALUES)


def q_changes_since(spark, sf_dir):
    log = change_log_table(spark, sf_dir)
    return cdc.changes_since(log, 1).select("user_id", "event_id", "ts", "value", "_change_type",
                                            "_commit_version", "_commit_timestamp")


def q_change_feed(spark, sf_dir):
    """T4: changes between the state at the middle version and the final state."""
    log = change_log_table(spark, sf_dir)
    middle = log.agg(F.floor(F.max("_commit_version") / 2)).scalar()
    return cdc.changes_between(log, KEYS, SEQ, ["value", "event_id"], middle)


def q_latest_per_key(spark, sf_dir):
    """W1 on its own: the latest event per user, deletes included."""
    log = change_log_table(spark, sf_dir)
    return cdc.latest_per_key(log, KEYS, SEQ, ["event_id", "value", "_change_type"])


_LOG = """
  c AS (SELECT user_id, ts, event_id, value, event_type, event_id // 1000 AS _commit_version,
               CASE event_type WHEN 'error' THEN 'delete' WHEN 'signup' THEN 'insert' ELSE 'update_postimage' END AS ct
        FROM events)"""
_CURRENT = """
  l AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM {src})"""

ORACLE = {
    "scd1_current": f"""
WITH {_LOG}, {_CURRENT.format(src='c')}
SELECT user_id, value, event_type, ts, event_id FROM l WHERE rn = 1 AND ct <> 'delete'""",
    "scd1_truncate": f"""
WITH {_LOG},
  m AS (SELECT max(_commit_version) // 2 AS mv FROM c),
  t AS (SELECT ts AS tts, event_id AS tid FROM c, m WHERE _commit_version = mv ORDER BY ts DESC, event_id DESC LIMIT 1),
  k AS (SELECT c.* FROM c, t WHERE (c.ts, c.event_id) > (t.tts, t.tid)), {_CURRENT.format(src='k')}
SELECT user_id, value, event_type, ts, event_id FROM l WHERE rn = 1 AND ct <> 'delete'""",
    "changes_since": f"""
WITH {_LOG}, v AS (SELECT _commit_version, max(ts) AS _commit_timestamp FROM c GROUP BY 1)
SELECT user_id, event_id, ts, value, ct AS _change_type, c._commit_version, v._commit_timestamp
FROM c JOIN v USING (_commit_version) WHERE c._commit_version >= 1""",
    "change_feed": f"""
WITH {_LOG},
  m AS (SELECT max(_commit_version) // 2 AS mv FROM c),
  b0 AS (SELECT c.* FROM c, m WHERE _commit_version <= mv),
  bl AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM b0),
  al AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM c),
  b AS (SELECT user_id, value, event_id FROM bl WHERE rn = 1 AND ct <> 'delete'),
  a AS (SELECT user_id, value, event_id FROM al WHERE rn = 1 AND ct <> 'delete')
SELECT a.user_id, a.value, a.event_id, 'insert' AS _change_type FROM a ANTI JOIN b USING (user_id)
UNION ALL SELECT b.user_id, b.value, b.event_id, 'delete' FROM b ANTI JOIN a USING (user_id)
UNION ALL SELECT b.user_id, b.value, b.event_id, 'update_preimage' FROM b JOIN a USING (user_id)
  WHERE (a.value, a.event_id) IS DISTINCT FROM (b.value, b.event_id)
UNION ALL SELECT a.user_id, a.value, a.event_id, 'update_postimage' FROM b JOIN a USING (user_id)
  WHERE (a.value, a.event_id) IS DISTINCT FROM (b.value, b.event_id)""",
    "latest_per_key": f"""
WITH {_LOG}, {_CURRENT.format(src='c')}
SELECT user_id, event_id, value, ct AS _change_type FROM l WHERE rn = 1""",
}

QUERIES = {
    "scd1_current": q_scd1_current,
    "scd1_truncate": q_scd1_truncate,
    "changes_since": q_changes_since,
    "change_feed": q_change_feed,
    "latest_per_key": q_latest_per_key,
}
