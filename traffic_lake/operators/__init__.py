from .dashboards import date_histogram, facet_counts, key_presence, reconcile, reconcile_by_digest
from .enrich import (
    flat_to_processed,
    flat_to_raw,
    keep_fields,
    to_processed,
    to_raw,
    with_event_filter,
    with_local_times,
    with_location_filter,
    within_bbox,
)
from .fields import (
    by_category,
    by_frequency,
    classify_fields,
    field_samples,
    field_stats,
    flatten_paths,
    inspect_fields,
    profile_fields,
)
from .incremental import (
    document_count,
    example_fields,
    high_water_mark,
    last_ingested,
    last_ingested_key,
    read_after,
    recent_sample,
)
from .quality import (
    RawPurityError,
    assert_raw_only,
    field_counts,
    observe_cycle,
    processed_field_hits,
    split_rejects,
)
