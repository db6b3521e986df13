"""These must equal the original system's for equal results.

Kept together and in their natural order; every other module imports them from here.
"""

# Line ids the network is built from, in their original order.
TUBE_LINES = [
    "bakerloo", "central", "circle", "district",
    "hammersmith-city", "jubilee", "metropolitan",
    "northern", "piccadilly", "victoria", "waterloo-city",
]

# Status reduction and the disruption rule.
SEVERITY_THRESHOLD = 10        # disrupted when severity < 10
MISSING_SEVERITY_RANK = 99     # a status without severity sorts as 99 ...
MISSING_SEVERITY_REPORT = 10   # ... and is reported as 10
UNKNOWN_LINE_ID = "unknown"
UNKNOWN_LINE_NAME = "Unknown Line"
UNKNOWN_SEVERITY_DESC = "Unknown"
STATUS_EVENT_TYPE = "tube_line_status"

# Stop-point types.
METRO_STATION_TYPE = "NaptanMetroStation"
BUS_STOP_TYPE = "NaptanPublicBusCoachTram"

# Network search and alert rule.
NEARBY_RADIUS_M = 300
PATH_LIMIT = 100
NEARBY_LIMIT = 20
DISPLAY_ROUTES = 10
MIN_ROUTES = 3
PREVIEW_CHARS = 200
GRIDLOCK_TEXT = "GRIDLOCK ALERT"
ALTERNATIVES_TEXT = "Alternatives available"

# Stream contract.
BROKER_TIME_COLUMN = "event_hub_timestamp"
TRIGGER_INTERVAL = "30 seconds"
BROKER_REQUEST_TIMEOUT_MS = "60000"
BROKER_SESSION_TIMEOUT_MS = "30000"
