"""Counts that are kept by export file."""

import os
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from epitally.config import Report
from epitally.operators.counts import monthly_counts
from epitally.plans.enquiries import clean_enquiries
from epitally.plans.increments import Update, current_counted, current_counts, enquiry_exports, ensure_counts
from epitally.plans.monthly import counted
from epitally.sources import read_events, schemas
from epitally.sources.versions import current_version
from helpers import rows

HEADER = ",".join(f'"{c.header.replace(".", " ")}"' for c in schemas.ENQUIRIES)


def write(path, *events, header=HEADER):
    values = {c.name: "" for c in schemas.ENQUIRIES}
    lines = [",".join(f'"{v}"' for v in (values | {"broad_topic": "Infectieziekten"} | e).values()) for e in events]
    path.write_text("\n".join([header, *lines]) + "\n")


def event(region, day, topic, **more):
    return {"region_name": region, "received_on": "/".join(reversed(day.split("-"))), "topic": topic} | more


def full(spark, folder):
    return monthly_counts(clean_enquiries(read_events(spark, str(folder), schemas.ENQUIRIES)), ["topic"])


@pytest.fixture
def exports(tmp_path):
    folder = tmp_path / "exp orts"
    folder.mkdir()
    write(folder / "a+1.csv", event("Zeeland", "2023-01-05", "Griep"), event("Zeeland", "2023-01-06", "Griep"))
    write(folder / "b.csv", event("Zeeland", "2023-01-09", "Griep"), event("", "2023-02-01", "Tick\nbite"))
    (folder / "empty.csv").write_text("")
    return folder


def test_a_new_export_counts_itself_only(spark, exports, tmp_path):
    output, source = str(tmp_path / "counts"), enquiry_exports(str(exports))
    assert ensure_counts(spark, source, output) == Update(2, 0)
    assert ensure_counts(spark, source, output) == Update(0, 0) and current_version(spark, output).number == 1
    write(exports / "c.csv", event("Zeeland", "2024-04-01", "Griep"), event("Zeeland", "2023-01-30", "Griep"))
    assert ensure_counts(spark, source, output) == Update(1, 0)
    batches = [spark.read.parquet(f"{output}/batches/{b}") for b in current_version(spark, output).facts["batches"]]
    assert [b.select("_source").distinct().count() for b in batches] == [2, 1]
    expected = full(spark, exports)
    assert rows(current_counts(spark, output)) == rows(expected.select("region", "month_start", "topic", "n")) and expected.count() == 3
    events = clean_enquiries(read_events(spark, str(exports), schemas.ENQUIRIES))
    plain, kept = counted(events, ["topic"], Report(1), "plain"), current_counted(spark, output, Report(1), "kept")
    assert rows(kept.frame, *plain.frame.columns) == rows(plain.frame) and kept.facts == plain.facts


def test_written_anew_and_removed_exports(spark, exports, tmp_path):
    output, source = str(tmp_path / "counts"), enquiry_exports(str(exports))
    ensure_counts(spark, source, output)
    write(exports / "b.csv", event("Zeeland", "2023-05-09", "Griep"))
    os.utime(exports / "b.csv", (2_000_000_000, 2_000_000_000))
    (exports / "a+1.csv").write_text(HEADER + "\n")
    assert ensure_counts(spark, source, output) == Update(2, 2)
    assert rows(current_counts(spark, output)) == rows(full(spark, exports).select("region", "month_start", "topic", "n"))
    (exports / "b.csv").unlink()
    assert ensure_counts(spark, source, output) == Update(0, 1)
    assert current_counts(spark, output).isEmpty()


def test_many_updates_are_merged_and_other_rules_count_anew(spark, exports, tmp_path):
    output, source = str(tmp_path / "counts"), enquiry_exports(str(exports))
    for i in range(3):
        write(exports / f"more{i}.csv", event("Zeeland", f"2023-0{i + 3}-05", "Griep"))
        ensure_counts(spark, source, output, most_batches=2)
    assert len(current_version(spark, output).facts["batches"]) == 1
    expected = rows(full(spark, exports).select("region", "month_start", "topic", "n"))
    assert rows(current_counts(spark, output)) == expected
    assert ensure_counts(spark, replace(source, rules="2"), output) == Update(5, 0)
    assert rows(current_counts(spark, output)) == expected


def test_a_failed_update_leaves_the_counts(spark, exports, tmp_path):
    output, source = str(tmp_path / "counts"), enquiry_exports(str(exports))
    ensure_counts(spark, source, output)
    before = rows(current_counts(spark, output))
    write(exports / "c.csv", event("Zeeland", "2023-01-30", "Griep"))
    lost = replace(source, clean=lambda raw, keep: clean_enquiries(raw, keep).withColumn("topic", F.raise_error(F.lit("lost")).cast("string")))
    with pytest.raises(Exception, match="lost"):
        ensure_counts(spark, lost, output)
    assert rows(current_counts(spark, output)) == before
    assert ensure_counts(spark, source, output) == Update(1, 0)


def test_only_empty_files(spark, tmp_path):
    (tmp_path / "exports").mkdir()
    (tmp_path / "exports" / "a.csv").write_text("")
    output, source = str(tmp_path / "counts"), enquiry_exports(str(tmp_path / "exports"))
    with pytest.raises(ValueError, match="no counts"):
        current_counts(spark, output)
    assert ensure_counts(spark, source, output) == Update(0, 0)
    assert current_counts(spark, output).columns == ["region", "month_start", "topic", "n"] and current_counts(spark, output).isEmpty()
