"""What counts cover, learned while they are written.

Windows, axes and checks need to know the months that occur, and whether events
lie outside the listed regions. These come as an observed metric of the write that
stages the counts, so no job looks at the written table again.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from epitally.config import Labels, Report
from epitally.functions import is_in
from epitally.staging import stage_observed

_LISTED, _NONE, _OTHER = "listed", "none", "other"


@dataclass(frozen=True)
class CountFacts:
    """The months that occur, each with the kinds of regions that it has: at most three a month."""

    cells: frozenset[tuple[date, str]]
    regions: tuple[str, ...]

    @property
    def latest(self) -> date | None:
        return max((month for month, _ in self.cells), default=None)

    @property
    def year(self) -> int | None:
        """Year of the latest month; None without any."""
        return self.latest.year if self.cells else None

    @property
    def years(self) -> list[int]:
        return sorted({month.year for month, _ in self.cells})

    def window(self, report: Report) -> CountFacts:
        """The same for the counts inside the report window."""
        if not self.cells:
            return self
        end = report.window_end(self.latest)
        return CountFacts(frozenset(c for c in self.cells if c[0] < end), self.regions)

    def axes(self, labels: Labels) -> tuple[list[str | None], list[date]]:
        """Regions and months of a dense table, see ``operators.counts``."""
        kinds = {kind for _, kind in self.cells}
        axis = [*self.regions, *([None] if _NONE in kinds else []), *([labels.other_regions] if _OTHER in kinds else [])]
        months = [date(year, month, 1) for year in self.years for month in range(1, 13)]
        return axis, [m for m in months if m <= self.latest]

    def coverage(self, report: Report, year: int) -> dict:
        """First and latest year, and whether the report can be made; as ``checks.coverage_flags``."""
        first, latest = (self.years[0], self.years[-1]) if self.cells else (None, None)
        with_quarter = max((m.year for m, _ in self.cells if (m.month + 2) // 3 == report.kind), default=None)
        covered = latest is not None and (report.yearly or with_quarter == latest)
        return {"first_year": first, "latest_year": latest, "period_covered": covered, "starts_in_time": first is not None and first <= year}


class Counted(NamedTuple):
    """Written monthly counts and what they cover."""

    frame: DataFrame
    facts: CountFacts

    def window(self, report: Report) -> Counted:
        """All earlier years, and the latest year up to the end of the report period, as a plain range of months."""
        latest = self.facts.latest
        inside = F.lit(False) if latest is None else F.col("month_start") < report.window_end(latest)
        return Counted(self.frame.filter(inside), self.facts.window(report))


def _cell(regions: Sequence[str]) -> Column:
    region = F.col("region")
    kind = F.when(region.isNull(), _NONE).when(is_in(region, regions), _LISTED).otherwise(_OTHER)
    return F.concat_ws(" ", F.col("month_start").cast("string"), kind)


def write_counts(counts: DataFrame, name: str, regions: Sequence[str] = (), parts: Mapping[str, Column] | None = None) -> dict[str, Counted]:
    """Stages monthly counts; for each of ``parts``, a condition on them, the counts that meet it and what these cover."""
    parts = {name: F.lit(True)} if parts is None else parts
    metrics = {f"m{i}": F.collect_set(F.when(condition, _cell(regions))) for i, condition in enumerate(parts.values())}
    staged, found = stage_observed(counts, name, metrics)
    out = {}
    for i, (part, condition) in enumerate(parts.items()):
        cells = (text.split(" ") for text in found.get(f"m{i}") or ())
        facts = CountFacts(frozenset((date.fromisoformat(month), kind) for month, kind in cells), tuple(regions))
        out[part] = Counted(staged if len(parts) == 1 else staged.filter(condition), facts)
    return out
