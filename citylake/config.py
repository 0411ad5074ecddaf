"""Business thresholds in one frozen object so every model reads the same values."""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass


@dataclass(frozen=True)
class Rules:
    # Fixed values of the reference's business rules (must stay equal to them).
    max_distance_miles: float = 100.0      # distance anomaly: > 100
    max_fare: float = 500.0                # fare anomaly: > 500
    max_duration_minutes: int = 180        # quality filter: duration <= 180
    default_emission_g_mile: float = 406.0 # vendor without factor
    jfk_rate_code: int = 2
    jfk_flat_fare: float = 70.0
    airport_rate_codes: tuple[int, ...] = (2, 3)
    price_tolerance: float = 0.5           # |variance| > 0.5 is a price anomaly
    short_trip_miles: float = 1.5          # distance < 1.5 is a short-trip risk
    core_borough: str = "Manhattan"
    calendar_start: str = "2023-01-01"
    calendar_days: int = 3650

    # Raw epochs above this magnitude were written in a finer unit and read as seconds:
    # milliseconds up to a thousand times it, microseconds beyond (functions.columns.repair_epoch).
    epoch_micros_threshold: float = 1e11
    # Audit timestamp written into *_updated_at columns (CURRENT_TIMESTAMP by default).
    run_ts: _dt.datetime | None = None
    # When set, float SUMs are rounded to this many decimals and AVGs are taken as
    # rounded sum / count, which makes results independent of addition order.
    sum_scale: int | None = None

    def with_(self, **kw) -> "Rules":
        from dataclasses import replace

        return replace(self, **kw)
