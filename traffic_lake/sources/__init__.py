from .snapshots import (
    alert_key,
    explode_alerts,
    quarantine_corrupt,
    read_alert_snapshots,
    read_bronze,
)
