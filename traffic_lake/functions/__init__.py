from .alerts import (
    PRIORITIES,
    SANTIAGO_BOX,
    SANTIAGO_ZONES,
    Box,
    ZoneRules,
    geo_point,
    in_box,
    priority,
    upper_or_empty,
    zone,
)
from .timeparts import (
    SANTIAGO,
    day_part,
    epoch_ms_to_local,
    epoch_ms_to_utc,
    iso_naive,
    iso_utc,
    iso_with_offset,
    localize_comments,
    to_local,
    utc_now,
    utc_ntz,
    weekday_es,
    with_processed_at,
    with_time_filter,
)
from .variants import field, has_field, kind, number, parse_number
