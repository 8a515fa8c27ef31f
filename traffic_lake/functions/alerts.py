"""Column functions that classify an alert: priority, zone, point, box."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Priority of each alert type; every other type is BAJA.
PRIORITIES = {
    "ACCIDENT": "ALTA",
    "CONSTRUCTION": "MEDIA",
    "HAZARD": "MEDIA",
    "JAM": "BAJA",
    "POLICE": "MEDIA",
    "ROAD_CLOSED": "ALTA",
    "WEATHERHAZARD": "ALTA",
}
DEFAULT_PRIORITY = "BAJA"


@dataclass(frozen=True)
class Box:
    """A bounding box; the defaults are the fixed values of the watched city."""

    left: float = -70.75
    bottom: float = -33.6
    right: float = -70.55
    top: float = -33.4


@dataclass(frozen=True)
class ZoneRules:
    """Zone thresholds; the defaults are fixed values."""

    cities: tuple[str, ...] = ("SANTIAGO", "CHILE")
    prefix: str = "Santiago"
    north: float = -33.42
    south: float = -33.58
    west: float = -70.68
    east: float = -70.55
    unknown: str = "UNKNOWN"
    nearby: str = "Nearby"


SANTIAGO_BOX = Box()
SANTIAGO_ZONES = ZoneRules()


def upper_or_empty(text: Column) -> Column:
    return F.upper(F.coalesce(text, F.lit("")))


def priority(
    alert_type: Column, mapping: Mapping[str, str] = PRIORITIES, default: str = DEFAULT_PRIORITY
) -> Column:
    """Priority of an upper-case type, ``default`` when the mapping has none."""
    pairs = [F.lit(part) for pair in mapping.items() for part in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), alert_type), F.lit(default))


def in_box(x: Column, y: Column, box: Box = SANTIAGO_BOX) -> Column:
    """True inside the box, edges included."""
    return x.between(box.left, box.right) & y.between(box.bottom, box.top)


def is_core_city(city: Column, rules: ZoneRules = SANTIAGO_ZONES) -> Column:
    return F.upper(city).isin(*rules.cities)


def zone(
    city: Column,
    x: Column,
    y: Column,
    rules: ZoneRules = SANTIAGO_ZONES,
    has_point: Column | None = None,
) -> Column:
    """Zone of an alert; a value exactly on a threshold counts as Centro.

    ``has_point`` says whether both coordinates are given (default: both are
    not NULL). Spark orders NaN above every number, so NaN is first replaced by
    a threshold, which lies in the centre.
    """
    has_point = (x.isNotNull() & y.isNotNull()) if has_point is None else has_point
    name = F.coalesce(city, F.lit(rules.unknown))
    lat, lon = F.nanvl(y, F.lit(rules.north)), F.nanvl(x, F.lit(rules.west))
    latitude = F.when(lat > rules.north, "Norte").when(lat < rules.south, "Sur").otherwise("Centro")
    longitude = F.when(lon < rules.west, "Oeste").when(lon > rules.east, "Este").otherwise("Centro")
    return (
        F.when(~has_point, rules.unknown)
        .when(
            is_core_city(name, rules),
            F.concat(F.lit(f"{rules.prefix}-"), latitude, F.lit("-"), longitude),
        )
        .otherwise(F.concat(name, F.lit(f"-{rules.nearby}")))
    )


def geo_point(x: Column, y: Column, cast: bool = True) -> Column:
    """``struct<lat,lon>`` when both coordinates are there, else NULL.

    With ``cast`` unusable coordinates drop the point; without it the given
    values are only renamed.
    """
    if cast:
        x, y = x.try_cast("double"), y.try_cast("double")
    return F.when(x.isNotNull() & y.isNotNull(), F.struct(y.alias("lat"), x.alias("lon")))
