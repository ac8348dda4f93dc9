"""Weather ladders: one definition drives both the daily assignment and the band dimension."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

UNKNOWN = "Unknown"


@dataclass(frozen=True)
class Ladder:
    """Ascending half-open steps; ``zero`` names an exact-zero member ahead of the first step."""

    steps: tuple[tuple[float, str], ...]
    top: str
    zero: str | None = None

    @property
    def members(self) -> list[str]:
        first = [self.zero] if self.zero else []
        return [*first, *(name for _, name in self.steps), self.top, UNKNOWN]

    def of(self, value: Column) -> Column:
        rung = F.when(value.isNull(), UNKNOWN)
        if self.zero:
            rung = rung.when(value == 0, self.zero)
        for below, name in self.steps:
            rung = rung.when(value < below, name)
        return rung.otherwise(self.top)


# Thresholds in °F and inches, as reported (rounded) values.
TEMPERATURE = Ladder(((32.0, "Freezing"), (50.0, "Cold"), (70.0, "Mild"), (85.0, "Warm")), "Hot")
PRECIPITATION = Ladder(((0.1, "Light"), (0.5, "Moderate")), "Heavy", zero="None")
SNOW = Ladder(((2.0, "Light"),), "Significant", zero="None")
