from .tables import (
    append_events,
    compact,
    compact_bucketed,
    compact_events,
    current_target,
    ensure_target,
    fan_out,
    keep_snapshot,
    latest_snapshot,
    merged,
    newest_per_key,
    read_current,
    read_snapshot,
    rebuild_target,
    run_number,
    snapshot_payload,
    upsert,
)
