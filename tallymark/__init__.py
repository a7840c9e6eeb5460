"""Metric update logs on Spark: check, fold, merge, query, snapshot and report them."""

from tallymark.operators.fold import fold_counters, fold_gauges, fold_ids, fold_state, fold_uuids, latest_rows, pack_order
from tallymark.operators.ids import assign_ids
from tallymark.operators.merge import key_violations, merge_add, rename, replace, restore, to_snapshot, upsert
from tallymark.operators.quality import StreamHealth, counted_report, observed, observed_report, quality_report
from tallymark.operators.query import (
    list_counters,
    list_gauges,
    list_state,
    lookup_json,
    lookup_many,
    lookup_point,
    lookup_typed,
    render_list,
    scan,
)
from tallymark.operators.report import (
    interval_fold,
    report_changes,
    report_cumulative,
    report_overcount,
    report_payload,
    report_ticks,
    wire_encode,
    write_payloads,
)
from tallymark.operators.validate import (
    batch_profile,
    batch_verdicts,
    check_snapshot,
    check_text,
    check_typed,
    drop_rejected_batches,
    rejects,
    rejects_by_code,
    valid,
)
from tallymark.session import session
from tallymark.sources.arrays import join_parts, save_array
from tallymark.sources.metric_table import register as register_table
from tallymark.sources.samples import collect_samples, normalize_samples, poll_count, unpivot_samples
from tallymark.sources.snapshots import load_snapshot, save_snapshot
from tallymark.sources.updates import (
    decode_batches,
    decode_lookups,
    decode_updates,
    read_documents,
    updates_from_uris,
)
from tallymark.streaming.jobs import finish, open_store, read_fold, read_running, read_whole_batches, run_fold, run_saves, run_upsert, run_whole_batches
from tallymark.streaming.store import StateStore
