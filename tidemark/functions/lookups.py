"""Small fixed lookup tables as map columns (M5, M6, W3 rules)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Port event type -> navigation status.
STATUS_OF_EVENT = {
    "ARRIVAL": "Arriving",
    "DEPARTURE": "Departing",
    "BERTHED": "Moored",
    "ANCHORED": "At anchor",
    "UNDERWAY": "Under way using engine",
}
UNKNOWN_STATUS = "Unknown"

# Deadweight multiplier per vessel type (default 1.0).
DEADWEIGHT_MULTIPLIER = {
    "Container Ship": 1.5,
    "Bulk Carrier": 2.0,
    "Tanker": 2.5,
    "Cargo Ship": 1.2,
    "Passenger Ship": 0.5,
    "Fishing Vessel": 0.3,
    "Tug": 0.2,
    "Naval Vessel": 0.8,
    "Yacht": 0.1,
    "Other": 1.0,
}

# Legal next port events; initial state and fallback.
LEGAL_NEXT_EVENT = {
    "UNDERWAY": ["ARRIVAL", "ANCHORED"],
    "ARRIVAL": ["BERTHED"],
    "BERTHED": ["DEPARTURE"],
    "ANCHORED": ["UNDERWAY", "ARRIVAL"],
    "DEPARTURE": ["UNDERWAY"],
}
INITIAL_STATE = "UNDERWAY"
FALLBACK_NEXT = ["ARRIVAL"]


def map_lit(mapping: dict) -> Column:
    items = []
    for k, v in mapping.items():
        items.append(F.lit(k))
        items.append(F.array(*[F.lit(x) for x in v]) if isinstance(v, list) else F.lit(v))
    return F.create_map(*items)


def status_from_event(event_type: Column) -> Column:
    """M5: navigation status of a port event type."""
    return F.coalesce(map_lit(STATUS_OF_EVENT)[event_type], F.lit(UNKNOWN_STATUS))


def gross_tonnage(length: Column, beam: Column) -> Column:
    """M6: floor(0.2 * length * beam * 10)."""
    return F.floor(F.lit(0.2) * length * beam * 10).cast("bigint")


def deadweight(vessel_type: Column, length: Column) -> Column:
    """M6: floor(length * multiplier(type) * 10), multiplier 1.0 if unknown."""
    mult = F.coalesce(map_lit(DEADWEIGHT_MULTIPLIER)[vessel_type], F.lit(1.0))
    return F.floor(length * mult * 10).cast("bigint")


def legal_next(prev_state: Column) -> Column:
    return F.coalesce(map_lit(LEGAL_NEXT_EVENT)[prev_state], F.array(*[F.lit(x) for x in FALLBACK_NEXT]))


__all__ = ["status_from_event", "gross_tonnage", "deadweight", "legal_next", "map_lit"]
