"""Which column plays which part.

All operators take names instead of assuming them, so that the same code serves the
raw flight files and any other table of legs.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class LegRoles:
    year: str = "year"
    month: str = "month"
    delay: str = "departure_delay"
    cancelled: str = "cancelled"
    diverted: str = "diverted"
    categorical: tuple[str, ...] = ("airline", "origin_airport_id", "dest_airport_id")
    numeric: tuple[str, ...] = (
        "year", "month", "day", "dayofweek", "crsdeptime", "distance", "scheduled_elapsed_time",
    )
    day_of_week: str = "dayofweek"
    scheduled_hhmm: str = "crsdeptime"
    carrier: str = "airline"
    origin: str = "origin_airport_id"
    destination: str = "dest_airport_id"
    imputed: tuple[str, ...] = ("taxi_out", "air_time")

    @property
    def features(self) -> tuple[str, ...]:
        return self.numeric + self.categorical

    @property
    def consumed(self) -> tuple[str, ...]:
        return (self.delay, self.cancelled, self.diverted)

    @property
    def required(self) -> tuple[str, ...]:
        return self.features + self.consumed


FLIGHTS = LegRoles()
