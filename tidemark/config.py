"""Thresholds of the pipeline; every one can be set by an environment variable, and an invalid value leaves the default."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, fields, replace

MINUTE, HOUR, DAY = 60_000, 3_600_000, 86_400_000


@dataclass(frozen=True)
class Config:
    takeover_failures: int = 3
    takeover_most: int = 10
    takeover_ms: int = 10 * MINUTE
    micro_count: int = 5
    micro_amount: float = 10.0
    micro_ms: int = 2 * MINUTE
    velocity_count: int = 3
    velocity_low: float = 100.0
    velocity_high: float = 2000.0
    velocity_ms: int = 2000
    travel_km: float = 150.0
    travel_ms: int = 15 * MINUTE
    block_score: float = 0.85
    alert_score: float = 0.5

    @classmethod
    def from_env(cls, env: Mapping[str, str] | None = None) -> Config:
        """Defaults overridden by TXRISK_<FIELD> where that parses."""
        env, own = os.environ if env is None else env, cls()
        for f in fields(cls):
            try:
                own = replace(own, **{f.name: type(f.default)(env[f"TXRISK_{f.name.upper()}"].strip())})
            except (KeyError, ValueError):
                pass
        return own


#: for sparse event tables, where a user's events are hours apart
SPARSE = Config(takeover_ms=7 * DAY, micro_ms=7 * DAY, velocity_ms=7 * DAY, travel_km=2000.0, travel_ms=DAY)
