from detour.functions.columns import (
    gridlock_label, iso_utc, json_payload, preview, py_timestamp_str, title_from_id, with_default,
)
from detour.functions.geo import haversine_m

__all__ = [
    "gridlock_label", "iso_utc", "json_payload", "preview", "py_timestamp_str",
    "title_from_id", "with_default", "haversine_m",
]
