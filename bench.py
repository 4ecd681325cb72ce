"""Time the headline queries and print one JSON line.

Every query runs twice over the whole tables, the second run counts: the first
one pays for starting Spark's code generation, which a long-lived cluster
session pays once.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from epitally.session import local_session  # noqa: E402
from workload.queries import REGISTRY  # noqa: E402

HEADLINES = (
    "monthly_counts",
    "classify_rules",
    "parse_dates",
    "report_window",
    "dense_counts",
    "pair_dense_counts",
    "incidence_monthly",
    "topic_incidence_monthly",
    "period_incidence",
    "name_harmonise",
    "population_per_year_boundaries",
    "disease_table_quarter",
    "disease_table_year",
    "scenario_table",
    "setting_table",
    "top5_topics_wide",
    "series_total",
    "series_breakdown",
    "quality_flags",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores, app="bench")
    seconds: dict[str, float] = {}
    for _ in range(2):
        for name in HEADLINES:
            start = time.perf_counter()
            REGISTRY[name](spark, folder).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries, warm",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(folder).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
