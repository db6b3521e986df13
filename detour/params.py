"""Tunable thresholds. Every operator takes them as arguments; these are the defaults."""

from __future__ import annotations

from dataclasses import dataclass

from detour import fixed as X


@dataclass(frozen=True)
class Params:
    # Defaults are the fixed values of detour.fixed.
    severity_threshold: int = X.SEVERITY_THRESHOLD
    missing_severity_rank: int = X.MISSING_SEVERITY_RANK
    missing_severity_report: int = X.MISSING_SEVERITY_REPORT
    radius_m: float = float(X.NEARBY_RADIUS_M)
    path_limit: int | None = X.PATH_LIMIT        # nearest path rows kept per line (None = all)
    nearby_limit: int = X.NEARBY_LIMIT           # nested path rows stored per alert
    display_routes: int = X.DISPLAY_ROUTES       # route names shown per alert
    min_routes: int = X.MIN_ROUTES               # gridlock when distinct routes < min_routes
    preview_chars: int = X.PREVIEW_CHARS         # alert payload preview length
    earth_radius_m: float = 6371008.8            # mean Earth radius (IUGG)


DEFAULT = Params()
