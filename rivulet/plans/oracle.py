"""DuckDB SQL oracles for the driver queries (same tables, same column names).

Append-mode window results are final only for windows whose end is at or below the
watermark after the last batch: ``max(ts)`` truncated to milliseconds minus the delay.
"""

from __future__ import annotations

DAY_US = 86_400_000_000
HOUR_US = 3_600_000_000


def _wm_us(delay_us: int, table: str = "events") -> str:
    return f"(SELECT (epoch_us(max(ts)) // 1000) * 1000 - {delay_us} FROM {table})"


ORACLE: dict[str, str] = {}

ORACLE["w_tumbling_key"] = f"""
WITH b AS (SELECT epoch_us(ts) // {DAY_US} * 86400 AS ws, event_type, value FROM events)
SELECT ws AS win_start, ws + 86400 AS win_end, event_type, count(*) AS cnt,
       round(sum(value), 6) AS total_value
FROM b GROUP BY ws, event_type
HAVING (ws + 86400) * 1000000 <= {_wm_us(2 * DAY_US)}
"""

ORACLE["w_tumbling"] = f"""
WITH b AS (SELECT epoch_us(ts) // {HOUR_US} * 3600 AS ws FROM events)
SELECT ws AS win_start, ws + 3600 AS win_end, count(*) AS cnt
FROM b GROUP BY ws
HAVING (ws + 3600) * 1000000 <= {_wm_us(DAY_US)}
"""

ORACLE["w_sliding"] = f"""
WITH b AS (SELECT epoch_us(ts) // {4 * HOUR_US} * 14400 - k * 14400 AS ws, value
           FROM events, unnest([0, 1, 2]) AS t(k))
SELECT ws AS win_start, ws + 43200 AS win_end, count(*) AS cnt,
       round(sum(value), 6) AS total_value
FROM b GROUP BY ws
HAVING (ws + 43200) * 1000000 <= {_wm_us(DAY_US)}
"""

ORACLE["w_session"] = f"""
WITH o AS (SELECT user_id, ts, value,
                  lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS prev FROM events),
s AS (SELECT *, sum(CASE WHEN prev IS NULL OR ts >= prev + INTERVAL 6 HOUR THEN 1 ELSE 0 END)
                OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM o),
g AS (SELECT user_id, sid, epoch_us(min(ts)) AS session_start_us,
             epoch_us(max(ts)) + {6 * HOUR_US} AS session_end_us, count(*) AS cnt,
             round(sum(value), 6) AS total_value
      FROM s GROUP BY user_id, sid)
SELECT user_id, session_start_us, session_end_us, cnt, total_value FROM g
WHERE session_end_us <= {_wm_us(DAY_US)}
"""

ORACLE["w_processing_time"] = """
SELECT count(*) AS cnt, CAST(60 AS BIGINT) AS win_seconds FROM events
"""

ORACLE["w_chained"] = f"""
WITH h AS (SELECT epoch_us(ts) // {HOUR_US} AS hr, count(*) AS c FROM events GROUP BY hr
           HAVING (hr + 1) * {HOUR_US} <= {_wm_us(DAY_US)}),
d AS (SELECT hr * 3600 // 86400 * 86400 AS ws, max(c) AS max_inner_cnt, sum(c) AS cnt
      FROM h GROUP BY ws)
SELECT ws AS win_start, ws + 86400 AS win_end, max_inner_cnt, CAST(cnt AS BIGINT) AS cnt FROM d
WHERE (ws + 86400) * 1000000 <= {_wm_us(DAY_US)}
"""

_PROJECTION = """
SELECT event_id, user_id, event_type, value, epoch_us(ts) AS ts_us FROM events
"""
for _k in ("s_parquet_stream", "s_batch_scan", "s_json_stream", "s_envelope", "d_dedup"):
    ORACLE[_k] = _PROJECTION

ORACLE["s_bronze_stream"] = """
SELECT user_id, round(avg(value), 6) AS avg_value,
       count(*) AS cnt
FROM events WHERE event_type = 'purchase' GROUP BY user_id
"""
ORACLE["a_filtered_group"] = ORACLE["s_bronze_stream"]

ORACLE["s_csv_lines"] = f"""
WITH b AS (SELECT epoch_us(ts) // {DAY_US} * 86400 AS ws, event_type FROM events)
SELECT ws AS win_start, ws + 86400 AS win_end, event_type AS key, count(*) AS cnt
FROM b GROUP BY ws, event_type
HAVING (ws + 86400) * 1000000 <= {_wm_us(2 * DAY_US)}
"""

ORACLE["p_stateless"] = """
SELECT event_id, user_id, event_type, CAST(round(value * 100) AS BIGINT) AS amount_cents,
       CAST(json_extract(props, '$.k') AS INTEGER) AS k, epoch_us(ts) AS ts_us
FROM events WHERE event_type <> 'error'
"""

ORACLE["p_flatmap"] = """
WITH w AS (SELECT unnest(regexp_split_to_array(text, '[ \\t\\n\\r\\f]+')) AS word FROM documents)
SELECT word, count(*) AS cnt FROM w WHERE word <> '' GROUP BY word
"""

ORACLE["a_sum_count"] = """
SELECT user_id, round(sum(value), 6) AS total_value, count(*) AS cnt
FROM events GROUP BY user_id
"""

ORACLE["a_group_count"] = """
SELECT event_type, count(*) AS cnt FROM events GROUP BY event_type
"""

ORACLE["a_min_max"] = """
SELECT min(event_id) AS min_event_id, max(event_id) AS max_event_id, count(*) AS cnt FROM events
"""

ORACLE["a_distinct"] = """
SELECT count(DISTINCT user_id) AS n_distinct FROM events
"""

ORACLE["a_latest_per_key"] = """
SELECT user_id, epoch_us(ts) AS ts_us, event_id, event_type, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
"""

ORACLE["d_dedup_wm"] = """
SELECT event_id, user_id, event_type, value FROM events
"""

ORACLE["j_stream_static"] = """
SELECT e.event_id, e.user_id, e.event_type, c.c_name, c.c_nationkey, c.c_mktsegment
FROM events e JOIN customer c ON e.user_id = c.c_custkey
"""

ORACLE["j_stream_stream"] = """
SELECT event_id, user_id, event_type, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events
"""

_VIEWS_PURCHASES = """
v AS (SELECT user_id, event_id AS view_id, ts AS view_ts FROM events WHERE event_type = 'view'),
p AS (SELECT user_id, event_id AS purchase_id, ts AS purchase_ts FROM events WHERE event_type = 'purchase'),
m AS (SELECT v.user_id, view_id, purchase_id, epoch_us(view_ts) AS view_ts_us,
             epoch_us(purchase_ts) AS purchase_ts_us
      FROM v JOIN p ON v.user_id = p.user_id
       AND p.purchase_ts BETWEEN v.view_ts AND v.view_ts + INTERVAL 6 HOUR)
"""

ORACLE["j_interval"] = f"WITH {_VIEWS_PURCHASES} SELECT * FROM m"

ORACLE["j_interval_left"] = f"""
WITH {_VIEWS_PURCHASES},
wm AS (SELECT least((SELECT (epoch_us(max(view_ts)) // 1000) * 1000 FROM v),
                    (SELECT (epoch_us(max(purchase_ts)) // 1000) * 1000 FROM p)) - {DAY_US} AS wm)
SELECT * FROM m
UNION ALL
SELECT v.user_id, v.view_id, CAST(NULL AS BIGINT) AS purchase_id, epoch_us(v.view_ts) AS view_ts_us,
       CAST(NULL AS BIGINT) AS purchase_ts_us
FROM v WHERE v.view_id NOT IN (SELECT view_id FROM m)
  AND epoch_us(v.view_ts) + {6 * HOUR_US} < (SELECT wm FROM wm)
"""

ORACLE["j_backfill"] = """
SELECT e.user_id, count(*) AS cnt, coalesce(n.n_name, 'unknown') AS country
FROM events e LEFT JOIN customer c ON e.user_id = c.c_custkey
LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
GROUP BY e.user_id, coalesce(n.n_name, 'unknown')
"""

ORACLE["u_union"] = f"""
WITH b AS (SELECT epoch_us(ts) // {DAY_US} * 86400 AS ws, event_type FROM events),
wm AS (SELECT least(
  (SELECT (epoch_us(max(ts)) // 1000) * 1000 FROM events WHERE event_type IN ('click', 'view')),
  (SELECT (epoch_us(max(ts)) // 1000) * 1000 FROM events WHERE event_type NOT IN ('click', 'view') OR event_type IS NULL)
  ) - {2 * DAY_US} AS wm)
SELECT ws AS win_start, ws + 86400 AS win_end, event_type, count(*) AS cnt
FROM b GROUP BY ws, event_type
HAVING (ws + 86400) * 1000000 <= (SELECT wm FROM wm)
"""

_CHANGELOG = """
cl AS (SELECT event_id AS seq, user_id AS key,
              CASE WHEN event_type = 'error' THEN 'delete' ELSE 'set' END AS op,
              CAST(round(value * 100) AS BIGINT) AS value FROM events)
"""
_AS_OF_SEQ = "(SELECT max(event_id) FROM events WHERE ts < TIMESTAMP '2024-01-16 00:00:00')"

ORACLE["o_fold_upsert"] = f"""
WITH {_CHANGELOG}
SELECT key, value, seq FROM cl
QUALIFY row_number() OVER (PARTITION BY key ORDER BY seq DESC) = 1 AND op = 'set'
"""

ORACLE["o_fold_asof"] = f"""
WITH {_CHANGELOG}
SELECT key, value, seq FROM cl WHERE seq <= {_AS_OF_SEQ}
QUALIFY row_number() OVER (PARTITION BY key ORDER BY seq DESC) = 1 AND op = 'set'
"""

ORACLE["o_fold_sum"] = f"""
WITH {_CHANGELOG},
d AS (SELECT key, max(seq) AS ds FROM cl WHERE op = 'delete' GROUP BY key)
SELECT cl.key, CAST(sum(cl.value) AS BIGINT) AS total, count(*) AS n_sets
FROM cl LEFT JOIN d ON cl.key = d.key
WHERE cl.op = 'set' AND (d.ds IS NULL OR cl.seq > d.ds)
GROUP BY cl.key
"""

ORACLE["o_scan"] = f"""
WITH {_CHANGELOG},
g AS (SELECT *, sum(CASE WHEN op = 'delete' THEN 1 ELSE 0 END)
                OVER (PARTITION BY key ORDER BY seq ROWS UNBOUNDED PRECEDING) AS grp FROM cl)
SELECT seq, key, op, value,
       CAST(sum(CASE WHEN op = 'set' THEN value ELSE 0 END)
            OVER (PARTITION BY key, grp ORDER BY seq ROWS UNBOUNDED PRECEDING) AS BIGINT) AS running
FROM g
"""

ORACLE["o_snapshot_diff"] = f"""
WITH {_CHANGELOG},
n AS (SELECT key, value FROM cl
      QUALIFY row_number() OVER (PARTITION BY key ORDER BY seq DESC) = 1 AND op = 'set'),
o AS (SELECT key, value FROM cl WHERE seq <= {_AS_OF_SEQ}
      QUALIFY row_number() OVER (PARTITION BY key ORDER BY seq DESC) = 1 AND op = 'set')
SELECT coalesce(o.key, n.key) AS key,
       CASE WHEN o.key IS NULL THEN 'insert' WHEN n.key IS NULL THEN 'delete' ELSE 'update' END AS op,
       o.value AS old_value, n.value AS new_value
FROM o FULL OUTER JOIN n ON o.key = n.key
WHERE o.key IS NULL OR n.key IS NULL OR o.value IS DISTINCT FROM n.value
"""

ORACLE["o_update_replay"] = ORACLE["a_sum_count"]

_SLICE4 = ("CAST(floor((event_id - (SELECT min(event_id) FROM events)) * {n} / "
           "((SELECT max(event_id) - min(event_id) + 1 FROM events))) AS INTEGER)")

for _k in ("k_file_sink", "k_batch_path", "k_batch_marker", "k_dedup_downstream", "k_compact"):
    ORACLE[_k] = _PROJECTION

ORACLE["k_foreach_batch"] = f"""
SELECT {_SLICE4.format(n=4)} AS slice, count(*) AS cnt,
       CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS total_cents
FROM events GROUP BY slice
"""

ORACLE["s_driven_stream"] = f"""
SELECT CAST({_SLICE4.format(n=4)} // 2 AS BIGINT) AS batch_id, {_SLICE4.format(n=4)} AS slice, count(*) AS cnt,
       CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS total_cents
FROM events GROUP BY ALL
"""

ORACLE["k_txn_guard"] = """
SELECT CASE WHEN event_type = 'purchase' THEN 'a' ELSE 'b' END AS app_id, count(*) AS cnt,
       CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS total_cents
FROM events GROUP BY app_id
"""

ORACLE["k_accumulate"] = """
SELECT event_type, count(*) AS cnt, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS total_cents
FROM events GROUP BY event_type
"""

ORACLE["k_upsert"] = """
SELECT user_id, event_id, event_type, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1
"""

ORACLE["k_fanout"] = """
SELECT 'all' AS sink, count(*) AS cnt FROM events
UNION ALL
SELECT 'purchases' AS sink, count(*) AS cnt FROM events WHERE event_type = 'purchase'
"""

ORACLE["k_dead_letter"] = """
SELECT CASE WHEN event_type = 'error' THEN 'dead_letter' ELSE 'main' END AS sink, count(*) AS cnt
FROM events GROUP BY sink
"""

ORACLE["k_topk_all_time"] = """
SELECT user_id, count(*) AS cnt FROM events GROUP BY user_id ORDER BY cnt DESC, user_id LIMIT 10
"""

ORACLE["t_topk_batch"] = f"""
WITH c AS (SELECT {_SLICE4.format(n=2)} AS slice, user_id, count(*) AS cnt FROM events GROUP BY slice, user_id)
SELECT slice, user_id, cnt, CAST(row_number() OVER (PARTITION BY slice ORDER BY cnt DESC, user_id) AS INTEGER) AS rank
FROM c QUALIFY rank <= 3
"""

ORACLE["s_rate_contiguity"] = """
SELECT count(*) AS n_rows, count(DISTINCT event_id) AS n_distinct, min(event_id) AS min_value,
       max(event_id) AS max_value,
       CASE WHEN count(*) = 0 THEN 'EMPTY'
            WHEN count(*) <> count(DISTINCT event_id) THEN 'DUPLICATES'
            WHEN count(DISTINCT event_id) <> max(event_id) - min(event_id) + 1 THEN 'GAPS'
            ELSE 'PASS' END AS verdict
FROM events
"""

ORACLE["s_state_reader"] = ORACLE["a_group_count"]

ORACLE["u_millis"] = """
SELECT event_id, epoch_us(ts) // 1000 AS ms, epoch_us(ts) // 1000 * 1000 AS ts_ms_us FROM events
"""

ORACLE["b_progress"] = f"""
SELECT CAST({_SLICE4.format(n=2)} AS BIGINT) AS arrival, count(*) AS numInputRows,
       CAST(0 AS BIGINT) AS numRowsDroppedByWatermark
FROM events GROUP BY arrival
"""

ORACLE["b_audit"] = f"""
WITH s AS (SELECT DISTINCT CAST({_SLICE4.format(n=2)} AS BIGINT) AS batch_id FROM events)
SELECT 'file_sink' AS query, batch_id, true AS has_offset, true AS has_commit, true AS has_sink,
       true AS aligned FROM s
UNION ALL
SELECT 'foreach_batch' AS query, batch_id, true AS has_offset, true AS has_commit,
       false AS has_sink, true AS aligned FROM s
"""

# Late data with a no-data batch after every arrival: a row of arrival N is dropped when
# its window end is at or below the watermark left by arrivals 0..N-1.
ORACLE["w_late_data"] = f"""
WITH r AS (SELECT *, list_position([0, 2, 1, 3], {_SLICE4.format(n=4)}) - 1 AS arrival,
                  epoch_us(ts) // {DAY_US} * 86400 AS ws FROM events),
a AS (SELECT arrival, (epoch_us(max(ts)) // 1000) * 1000 AS mx FROM r GROUP BY arrival),
wm AS (SELECT arrival, coalesce(max(mx) OVER (ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING
                                             AND 1 PRECEDING) - {2 * DAY_US}, 0) AS wm_before
       FROM a),
kept AS (SELECT r.* FROM r JOIN wm USING (arrival) WHERE (r.ws + 86400) * 1000000 > wm.wm_before)
SELECT ws AS win_start, ws + 86400 AS win_end, event_type, count(*) AS cnt FROM kept
GROUP BY ws, event_type
HAVING (ws + 86400) * 1000000 <= (SELECT max(mx) FROM a) - {2 * DAY_US}
"""

# Hourly counts reach the processor once the watermark passes their hour; a period is idle
# when the next counted event is 6 hours away, or when the watermark is 7 hours past it.
ORACLE["x_idle_users"] = f"""
WITH e AS (SELECT user_id, epoch_us(ts) AS us FROM events
           WHERE (epoch_us(ts) // {HOUR_US} + 1) * {HOUR_US} <= {_wm_us(DAY_US)}),
n AS (SELECT *, lag(us) OVER w AS prev, lead(us) OVER w AS nxt FROM e WINDOW w AS (PARTITION BY user_id ORDER BY us)),
i AS (SELECT *, sum(CASE WHEN us - prev >= {6 * HOUR_US} THEN 1 ELSE 0 END)
                OVER (PARTITION BY user_id ORDER BY us ROWS UNBOUNDED PRECEDING) AS island FROM n),
g AS (SELECT user_id, count(*) AS cnt, max(us) AS last_ts_us, max(island) OVER (PARTITION BY user_id) = island AS final
      FROM i GROUP BY user_id, island)
SELECT user_id, cnt, last_ts_us FROM g
WHERE NOT final OR (last_ts_us // 1000) * 1000 + {7 * HOUR_US} < {_wm_us(DAY_US)}
"""

ORACLE["x_migrate"] = """
SELECT e.user_id, coalesce(n.n_name, 'unknown') AS country, count(*) AS cnt
FROM events e LEFT JOIN customer c ON e.user_id = c.c_custkey
LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
GROUP BY e.user_id, coalesce(n.n_name, 'unknown')
"""

ORACLE["a_avg_partial"] = """
SELECT event_type, round(avg(value), 6) AS avg_value,
       count(*) AS cnt
FROM events GROUP BY event_type
"""

ORACLE["k_partitioned_write"] = f"""
SELECT event_id, user_id, event_type, value, epoch_us(ts) AS ts_us,
       CAST(floor(epoch_us(ts) / {DAY_US}) AS BIGINT) AS event_day
FROM events
"""

ORACLE["s_state_vars"] = f"""
WITH e AS (SELECT user_id, event_type, {_SLICE4.format(n=3)} AS slice FROM events)
SELECT 'total' AS part, user_id, CAST(NULL AS VARCHAR) AS kind, count(*) AS cnt FROM e GROUP BY user_id
UNION ALL SELECT 'kinds', user_id, coalesce(event_type, ''), count(*) FROM e GROUP BY user_id, coalesce(event_type, '')
UNION ALL SELECT 'changed', user_id, NULL, count(*) FROM e GROUP BY user_id HAVING max(slice) = 2
"""

ORACLE["x_initial_state"] = """
SELECT user_id, coalesce(event_type, '') AS event_type, count(*) AS cnt FROM events GROUP BY ALL
"""

ORACLE["o_changes_stream"] = f"""
WITH {_CHANGELOG},
p AS (SELECT *, lag(op) OVER w AS was, lag(value) OVER w AS old FROM cl WINDOW w AS (PARTITION BY key ORDER BY seq))
SELECT key, seq, 'insert' AS kind, value FROM p WHERE op = 'set' AND was IS DISTINCT FROM 'set'
UNION ALL SELECT key, seq, 'update_before', old FROM p WHERE op = 'set' AND was = 'set'
UNION ALL SELECT key, seq, 'update_after', value FROM p WHERE op = 'set' AND was = 'set'
UNION ALL SELECT key, seq, 'delete', old FROM p WHERE op = 'delete' AND was = 'set'
"""

ORACLE["o_fold_stream"] = ORACLE["o_fold_upsert"]
ORACLE["o_changes_replay"] = ORACLE["o_fold_asof"]

ORACLE["x_cutover"] = f"""
WITH b AS (SELECT epoch_us(ts) // {DAY_US} * 86400 AS ws, event_type, coalesce(value >= 50, false) AS big FROM events)
SELECT ws AS win_start, ws + 86400 AS win_end, event_type, big, count(*) AS cnt, 1 AS refused
FROM b GROUP BY ws, event_type, big
HAVING (ws + 86400) * 1000000 <= {_wm_us(2 * DAY_US)}
"""

ORACLE["x_change_verdict"] = f"""
SELECT change, verdict, columns,
       (SELECT count(*) FROM (SELECT DISTINCT epoch_us(ts) // {DAY_US}, event_type FROM events)) AS n_state
FROM (VALUES ('result filter', 'safe', ''), ('key', 'refused', 'user_id'), ('aggregate', 'dangerous', 'sum -> max'),
             ('input filter', 'dangerous', 'event_id')) v(change, verdict, columns)
"""
