"""Default thresholds shared by the operators."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Defaults:
    # fixed values
    seed: int = 42
    rfm_quantiles: int = 4
    min_support: float = 0.002
    min_confidence: float = 0.15
    min_lift: float = 1.2
    wastage_medium: float = 0.33
    wastage_high: float = 0.66
    z_threshold: float = 3.0
    sales_spike: float = 4.0
    sales_drop: float = 0.15
    rating_high: float = 4.3
    rating_low: float = 2.2
    peak_first_hour: int = 11
    peak_last_hour: int = 21
    weekend_days: tuple[int, ...] = (5, 6)  # Monday is 0


DEFAULTS = Defaults()
