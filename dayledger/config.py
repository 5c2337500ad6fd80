"""Every tunable of the library, in one typed object."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta


@dataclass(frozen=True)
class Settings:
    # Event days behind the newest one that an incremental run recomputes.
    lookback_days: int = 7
    # Files that one batch of the stream of arrivals takes at most.
    files_per_batch: int = 1000
    # Daily impressions a creative needs before its CTR is ranked.
    impression_floor: int = 1000
    # Percent rank, inclusive, up to which a creative counts as a top performer.
    top_share: float = 0.1

    # Calendar of the known outage, used by the gap report only.
    first_day: date = date(2026, 1, 1)
    outage_day_index: int = 70

    @property
    def outage_day(self) -> date:
        return self.first_day + timedelta(days=self.outage_day_index)


DEFAULTS = Settings()
