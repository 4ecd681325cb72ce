"""What a report is about: period, regions, labels. Plain data, no Spark."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date

YEARLY = 5


@dataclass(frozen=True)
class Report:
    """A quarterly report (``kind`` 1-4) or a yearly one (``kind`` 5)."""

    kind: int

    def __post_init__(self) -> None:
        if self.kind not in (1, 2, 3, 4, YEARLY):
            raise ValueError(f"report kind must be 1-4 (quarter) or 5 (year), got {self.kind!r}")

    @property
    def yearly(self) -> bool:
        return self.kind == YEARLY

    @property
    def first_month(self) -> int:
        return 1 if self.yearly else 3 * self.kind - 2

    @property
    def months(self) -> int:
        return 12 if self.yearly else 3

    def window_end(self, latest: date) -> date:
        """First day after the report period of the year that ``latest`` lies in."""
        month = self.first_month + self.months
        return date(latest.year + 1, 1, 1) if month > 12 else date(latest.year, month, 1)

    def label(self, year: int) -> str:
        return str(year) if self.yearly else f"{year}_Q{self.kind}"

    def comparison_label(self, name: str, report_year: int) -> str:
        """Header of the column that shows the same period a year earlier."""
        year = report_year - 1
        return f"{name} {year}" if self.yearly else f"{name} {year} Q{self.kind}"


@dataclass(frozen=True)
class Labels:
    all_regions: str = "ALL_REGIONS"
    national: str = "NATIONAL"
    total: str = "TOTAL"
    empty: str = "(leeg)"
    other_regions: str = "OTHER_REGIONS"


@dataclass(frozen=True)
class SurveillanceConfig:
    """Everything a full report needs besides its input tables."""

    report: Report
    regions: tuple[str, ...]
    display_name: str = "All regions"
    labels: Labels = field(default_factory=Labels)
