"""Driver-facing query registry and its SQL oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rivulet.plans import queries as _q
from rivulet.plans.oracle import ORACLE

QUERY_NAMES = [
    "w_tumbling_key", "w_tumbling", "w_sliding", "w_session", "w_processing_time", "w_chained",
    "s_parquet_stream", "s_batch_scan", "s_json_stream", "s_envelope", "s_bronze_stream",
    "s_csv_lines", "s_driven_stream",
    "p_stateless", "p_flatmap",
    "a_sum_count", "a_filtered_group", "a_group_count", "a_min_max", "a_distinct",
    "a_latest_per_key",
    "d_dedup", "d_dedup_wm",
    "j_stream_static", "j_stream_stream", "j_interval", "j_interval_left", "j_backfill",
    "u_union",
    "o_fold_upsert", "o_fold_asof", "o_fold_sum", "o_scan", "o_snapshot_diff", "o_update_replay",
    "k_file_sink", "k_foreach_batch", "k_batch_path", "k_batch_marker", "k_txn_guard",
    "k_accumulate", "k_upsert", "k_fanout", "k_dead_letter", "k_dedup_downstream",
    "k_topk_all_time", "t_topk_batch",
    "s_rate_contiguity", "s_state_reader", "u_millis", "b_progress", "b_audit", "w_late_data",
    "x_idle_users", "x_migrate", "k_compact", "a_avg_partial", "k_partitioned_write",
    "x_cutover", "x_change_verdict", "s_state_vars", "x_initial_state", "o_changes_stream", "o_fold_stream", "o_changes_replay",
]


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: getattr(_q, name) for name in QUERY_NAMES}


def oracles() -> dict[str, str]:
    return {name: ORACLE[name] for name in QUERY_NAMES if name in ORACLE}
