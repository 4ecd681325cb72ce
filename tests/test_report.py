"""Cleaning rules and a whole report, worked out by hand on small inputs."""

import pytest

from epitally import fixed_values as fixed
from epitally.config import Report, SurveillanceConfig
from epitally.operators.checks import CoverageError
from epitally.operators.series import SeriesSpec
from epitally.plans.cases import clean_cases, first_link, harmonise_names
from epitally.plans.catalogue import QUARTERLY, YEARLY
from epitally.plans.enquiries import clean_enquiries
from epitally.plans.inputs import InputPaths, read_inputs, write_report
from epitally.plans.report import ReportInputs, build_report
from epitally.plans.situations import clean_situations
from epitally.sources import read_events, schemas
from helpers import day, rows, table

CASE = {
    "case_identifier": "BZO/1",
    "time_entered": "05-01-2024",
    "disease": "Mazelen",
    "summary_diagnosis": None,
    "abr": None,
    "infection": None,
    "confidence": "Confirmed",
    "date_deleted": None,
    "status": "Definitief",
}


def frame(spark, schema, default, changes):
    names = [c.name for c in schema]
    kinds = ", ".join(f"{c.name} {c.data_type}" for c in schema)
    return spark.createDataFrame([tuple({**default, **change}[n] for n in names) for change in changes], kinds)


def cases(spark, *changes):
    return frame(spark, schemas.CASES, CASE, changes)


CASE_RULES = [
    ({}, "Mazelen"),
    ({"disease": "COVID-19"}, None),
    ({"disease": None}, None),
    ({"disease": None, "summary_diagnosis": "Scabiës"}, "Scabies"),
    ({"disease": None, "summary_diagnosis": "ScabiC+s, unspecified"}, "Scabies"),
    # The cleaned spelling of this subtype is in no rule.
    ({"disease": None, "summary_diagnosis": "Scabiës crustosa"}, None),
    ({"disease": "Invasieve pneumokokkenziekte  (bij kinderen)"}, "Invasieve pneumokokkenziekte"),
    ({"disease": "Nieuwe Influenza A (H1N1)"}, "Humane infectie met dierlijk influenzavirus"),
    ({"disease": "Hepatitis B"}, "Hepatitis B, niet gespecificeerd"),
    ({"disease": "Hepatitis B", "summary_diagnosis": "Acute hepatitis B"}, "Hepatitis B, acuut"),
    ({"disease": "Hepatitis B", "summary_diagnosis": "Chronic hepatitis B (with D)"}, "Hepatitis B, chronisch"),
    ({"disease": "Hepatitis C", "summary_diagnosis": "Hepatitis C, unspecified"}, "Hepatitis C, niet gespecificeerd"),
    ({"abr": "CPE"}, "CPE"),
    ({"abr": "CPE", "summary_diagnosis": "Monkeypox"}, "Monkeypox"),
    ({"infection": "Dengue Fever"}, "Dengue Fever"),
    ({"infection": "Chikungunya", "abr": "MRSA"}, "Chikungunya"),
    # Admission.
    ({"confidence": "Discarded"}, None),
    ({"confidence": None}, None),
    ({"date_deleted": "01-01-2024"}, None),
    ({"status": None}, None),
    ({"status": "Gefiatteerd"}, "Mazelen"),
    ({"disease": "Rabies (Hondsdolheid)", "status": None}, "Rabies (Hondsdolheid)"),
    ({"disease": "Rabies (Hondsdolheid)", "status": "Open"}, "Rabies (Hondsdolheid)"),
    ({"disease": "Rabies (Hondsdolheid)", "status": "Gewist"}, None),
    ({"disease": None, "summary_diagnosis": "Scabies", "status": "Overgedragen"}, None),
]


def test_case_rules(spark):
    """One case per rule, told apart by its region."""
    changes = [{**change, "case_identifier": f"{i}/x"} for i, (change, _) in enumerate(CASE_RULES)]
    found = {int(r.region): r.category for r in clean_cases(cases(spark, *changes)).collect()}
    assert [found.get(i) for i in range(len(CASE_RULES))] == [expected for _, expected in CASE_RULES]


def test_case_region_and_date(spark):
    found = clean_cases(
        cases(
            spark,
            {"case_identifier": "HVB/2/x", "time_entered": "1/2/2024"},
            {"case_identifier": "XYZ/3", "time_entered": "someday"},
            {"case_identifier": None, "time_entered": None},
        )
    )
    assert rows(found, "region", "event_date") == sorted(
        [("HvB", day("2024-02-01")), ("XYZ", None), (None, None)], key=repr
    )


SITUATION = {
    "name": "ZLG/1",
    "date_entered": "05-01-2024",
    "article_26": "Yes",
    "scenario": "Gastroenteritis",
    "setting": "School",
    "agent": "Norovirus",
}


def situations(spark, *changes):
    return frame(spark, schemas.SITUATIONS, SITUATION, changes)


def test_situation_rules(spark):
    found = clean_situations(
        situations(
            spark, {}, {"article_26": "No"}, {"article_26": None}, {"scenario": None, "setting": None, "agent": None}
        )
    )
    date = day("2024-01-05")
    assert rows(found) == sorted(
        [("ZL", date, "Gastroenteritis", "Norovirus", "School"), ("ZL", date, "(leeg)", None, "(leeg)")], key=repr
    )


ENQUIRY = {
    "broad_topic": "Infectieziekten",
    "topic": "Mazelen",
    "received_on": "05/01/2024",
    "region_name": "Zeeland",
}


def enquiries(spark, *changes):
    return frame(spark, schemas.ENQUIRIES, ENQUIRY, changes)


def test_enquiry_rules(spark):
    found = clean_enquiries(
        enquiries(
            spark,
            {"received_on": "05/01/2024 14:00"},
            {"broad_topic": "Vaccinatie"},
            {"received_on": None},
            {"topic": "COVID-19"},
            {"topic": None, "region_name": "Elsewhere"},
            {"received_on": "unknown"},
        )
    )
    date = day("2024-01-05")
    assert rows(found) == sorted(
        [("Zee", date, "Mazelen"), (None, date, None), ("Zee", None, "Mazelen")], key=repr
    )


def test_names_are_translated_once_and_summed(spark):
    link = spark.createDataFrame(
        [("Measles", "Other", 5), ("Measles", "Mazelen", 2), ("Rubeola", "Mazelen", 3), ("Gone", None, 4)],
        "national_name string, local_name string, list_order int",
    ).repartition(3)
    national = spark.createDataFrame(
        [("Measles", 3), ("Rubeola", 4), ("Tetanus", 5), ("Gone", 6)], "national_name string, n long"
    )
    assert rows(harmonise_names(national, first_link(link))) == sorted(
        [("Mazelen", 7), ("Tetanus", 5), (None, 6)], key=repr
    )


def test_catalogue():
    assert len(QUARTERLY) == 19 and len(YEARLY) == 17
    assert len({s.name for s in QUARTERLY}) == 19
    assert {s.name for s in QUARTERLY} - {s.name for s in YEARLY} == {"pertussis", "enquiries_measles"}
    assert next(s for s in YEARLY if s.name == "pertussis_recent").years == (2023,)


# A whole report


@pytest.fixture(scope="module")
def inputs(spark):
    million = 1000000
    people = [
        (region, year - 1, size, year)
        for year in (2023, 2024)
        for region, size in (("BZO", million), ("Zee", million // 2), ("ALL_REGIONS", 2 * million), ("NATIONAL", 10 * million))
    ]
    return ReportInputs(
        cases=cases(
            spark,
            {},
            {"time_entered": "20-03-2024"},
            {"time_entered": "02-04-2024"},
            {"time_entered": "05-02-2023"},
            {"case_identifier": "ZEE/9", "time_entered": "05-02-2024"},
            {"case_identifier": "XYZ/9", "time_entered": "05-02-2024"},
            {"case_identifier": "ZEE/9", "disease": "Tuberculose"},
            {"disease": "Not in the link"},
        ),
        situations=situations(
            spark,
            {},
            {"name": "BZO/1", "agent": "COVID-19"},
            {"name": "BZO/1", "agent": None, "setting": None},
            {"date_entered": "05-01-2023"},
        ),
        enquiries=enquiries(
            spark, {}, {}, {"topic": "Anders"}, {"region_name": "Elsewhere"}, {"region_name": "Brabant-Zuidoost", "topic": "Anders"}
        ),
        national=spark.createDataFrame(
            [("Measles", 30), ("TB", 5), ("Tetanus", 10)], "national_name string, n long"
        ),
        name_link=spark.createDataFrame(
            [("Measles", "Mazelen", 1), ("TB", "Tuberculose", 2), ("Polio", "Polio", 3)],
            "national_name string, local_name string, list_order int",
        ),
        population=spark.createDataFrame(people, "region string, pop_year int, population long, year int"),
    )


SPECS = (
    SeriesSpec("measles", "diseases", include=("Mazelen",)),
    SeriesSpec("situations", "scenarios"),
    SeriesSpec("noro", "scenario_agents", include=("Gastroenteritis",), breakdown=("agent", ("Norovirus",))),
    SeriesSpec("calls", "topics", include=("Mazelen", "Anders")),
)


@pytest.fixture(scope="module")
def report(inputs):
    return build_report(inputs, SurveillanceConfig(Report(1), ("BZO", "Zee"), "South"), SPECS)


def test_report_frame(report):
    assert report.year == 2024
    assert report.comparison_label == "South 2023 Q1"
    assert set(report.tables) == {"diseases", "scenarios", "settings", "top_topics"}


def test_report_disease_table(report):
    found = table(report.tables["diseases"], "category")
    # BZO_n, Zee_n, ALL_n, NATIONAL_n, BZO, Zee, ALL, NATIONAL, previous
    assert {k: list(v.values())[2:] for k, v in found.items()} == {
        # XYZ counts in the supra-region; the case of April is outside the window.
        "Mazelen": [2, 1, 4, 30, 2.0, 2.0, 2.0, 3.0, 1.0],
        "Polio": [None, None, None, None, None, None, None, None, None],
        "Tetanus": [None, None, None, 10, None, None, None, 1.0, None],
        "TOTAL": [2, 1, 4, 40, 2.0, 2.0, 2.0, 4.0, 1.0],
    }


def test_report_situation_tables(report):
    found = table(report.tables["scenarios"], "scenario")
    # BZO_n, Zee_n, ALL_n, BZO, Zee, ALL, previous. Nothing happened in Zee.
    assert list(found["Gastroenteritis"].values())[2:] == [2, None, 3, 2.0, None, 2.0, 1.0]
    assert list(found["TOTAL"].values())[2:] == [2, None, 3, 2.0, None, 2.0, 1.0]
    settings = table(report.tables["settings"], "setting")
    assert settings["(leeg)"]["ALL_REGIONS_incidence_previous"] == 0.0
    assert {k: v["ALL_REGIONS_n"] for k, v in settings.items()} == {"School": 2, "(leeg)": 1, "TOTAL": 3}


def test_report_top_topics(report):
    found = table(report.tables["top_topics"], "rank")
    assert list(found[1].values()) == [1, "Anders", 1, "Mazelen", 2]
    assert list(found[2].values()) == [2, "Mazelen", 0, "Anders", 1]


def test_report_series(report):
    measles = {(r.region, r.month_start): (r.n, r.incidence, r.incidence_all) for r in report.series["measles"].collect()}
    # Three regions, January 2023 to March 2024.
    assert len(measles) == 3 * 15
    assert measles[("BZO", day("2024-01-01"))] == (1, 1.0, 0.5)
    assert measles[("Zee", day("2024-02-01"))] == (1, 2.0, 1.0)
    assert measles[("OTHER_REGIONS", day("2024-02-01"))] == (1, 0.0, 1.0)
    scenarios = {(r.region, r.month_start): r.n for r in report.series["situations"].collect()}
    # Without the coronavirus agent, with the unknown one.
    assert scenarios[("BZO", day("2024-01-01"))] == 1
    noro = {(r.region, r.month_start): r.n for r in report.series["noro"].collect()}
    assert noro[("BZO", day("2024-01-01"))] == 0 and noro[("OTHER_REGIONS", day("2023-01-01"))] == 1
    calls = {r.region: (r.n, r.incidence_all) for r in report.series["calls"].collect()}
    assert calls == {"Zee": (3, 2.5), "BZO": (1, 2.5), None: (1, 2.5)}


def test_report_stops_when_the_period_is_not_covered(inputs):
    with pytest.raises(CoverageError, match="cases: no rows in period 3"):
        build_report(inputs, SurveillanceConfig(Report(3), ("BZO",)), SPECS)
    with pytest.raises(CoverageError, match="situations: no rows in period 2"):
        build_report(inputs, SurveillanceConfig(Report(2), ("BZO",)), SPECS)


def test_report_stops_on_old_denominators(inputs):
    old = ReportInputs(**{**inputs.__dict__, "population": inputs.population.filter("pop_year < 2023")})
    with pytest.raises(CoverageError, match="population"):
        build_report(old, SurveillanceConfig(Report(1), ("BZO",)), SPECS)


def test_report_stops_on_unknown_series_values(inputs):
    specs = (SeriesSpec("nope", "diseases", include=("Nope",)),)
    with pytest.raises(CoverageError, match="Nope"):
        build_report(inputs, SurveillanceConfig(Report(1), ("BZO",)), specs)


def test_yearly_report(inputs):
    found = build_report(inputs, SurveillanceConfig(Report(5), ("BZO", "Zee"), "South"), SPECS)
    diseases = table(found.tables["diseases"], "category")
    assert diseases["Mazelen"]["BZO_n"] == 3
    assert found.comparison_label == "South 2023"


def test_cases_from_an_export(spark, tmp_path):
    path = tmp_path / "cases.csv"
    path.write_text(
        "Case Identifier,Time entered,Meldingsplichtige ziekte,Summary Diagnosis,ABR,Infection,Confidence,"
        "Datum gewist,Status van de melding,Extra\n"
        "NLG/1,31/12/2023,,Scabiës,,,Possible,,,x\n"
        "NLG/1,31/12/2023,,,,,Possible,,Definitief,x\n",
        encoding="utf-8",
    )
    found = clean_cases(read_events(spark, str(path), schemas.CASES))
    assert rows(found) == [("LN", day("2023-12-31"), "Scabies")]


def test_report_from_files_to_files(spark, tmp_path):
    def write(name, text):
        (tmp_path / name).write_text(text, encoding="utf-8")
        return str(tmp_path / name)

    case_header = (
        "Case Identifier;Time entered;Meldingsplichtige ziekte;Summary Diagnosis;ABR;Infection;Confidence;"
        "Datum gewist;Status van de melding\n"
    )
    paths = InputPaths(
        cases=write("cases.csv", case_header + "BZO/1;05-01-2024;Mazelen;;;;Confirmed;;Definitief\n"),
        situations=write(
            "situations.csv",
            "Name,Date entered,Artikel 26,Infectious Agent,Scenario,Principal Contextual Setting,Infectious Agent\n"
            "BZO/1,05-01-2024,Yes,Norovirus,Gastroenteritis,School,Other\n",
        ),
        enquiries=write(
            "enquiries.csv",
            "Broad Topic,Specific Topic,Received on,GGD\nInfectieziekten,Mazelen,05/01/2024 9:00,Zeeland\n",
        ),
        national=write("national.csv", "Ziekte RIVM,Landelijke aantallen in rapportageperiode\nMeasles,20\n"),
        name_link=write("link.csv", "Ziekte RIVM,Meldingsplichtige ziekte HPZone\nMeasles,Mazelen\n"),
        population=write("population.csv", "GGD,2023\nBZO,1000000\nRegio,2000000\nNederland,10000000\n"),
    )
    specs = (
        SeriesSpec("measles", "diseases", include=("Mazelen",)),
        SeriesSpec("noro", "scenario_agents", include=("Gastroenteritis",), breakdown=("agent", ("Norovirus",))),
    )
    built = build_report(read_inputs(spark, paths), SurveillanceConfig(Report(1), ("BZO",)), specs)
    out = write_report(built, str(tmp_path / "out"))
    diseases = table(spark.read.parquet(f"{out}/tables/diseases"), "category")
    assert list(diseases["Mazelen"].values())[2:] == [1, 1, 20, 1.0, 1.0, 2.0, None]
    assert spark.read.parquet(f"{out}/tables/top_topics").columns == ["rank", "BZO_topic", "BZO_n"]
    assert built.modified.keys() == {"cases", "situations", "enquiries"}
    charts = spark.read.parquet(f"{out}/series/scenario_agents")
    noro = charts.filter("chart = 'noro'").collect()
    assert [(r.region, r.n, r.incidence_all) for r in noro] == [("BZO", 1, 0.5)]


def test_fixed_values_are_consistent():
    assert set(fixed.REGION_BY_ENQUIRY_NAME.values()) == set(fixed.REGIONS)
    assert set(fixed.REGION_BY_STATISTICS_NAME.values()) == set(fixed.REGIONS)
    assert set(fixed.REGION_BY_PREFIX.values()) < set(fixed.REGIONS)
