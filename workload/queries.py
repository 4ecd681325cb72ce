"""One entry per operator or report table, over whole tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace
from datetime import date
from functools import reduce
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from epitally.config import Labels, Report
from epitally.functions import (
    classify,
    map_region,
    mask_zero,
    not_in,
    parse_day_month_year,
    parse_leading_date,
    recode,
    round_half_away,
    unify_spelling,
    with_date_parts,
)
from epitally.operators.checks import denominator_flags
from epitally.operators.counts import dense_counts, dense_template, monthly_counts, with_all_regions, zero_filled
from epitally.operators.facts import Counted, CountFacts, write_counts
from epitally.operators.filters import admitted, at_period
from epitally.operators.period_table import (
    DISEASE_STYLE,
    SITUATION_STYLE,
    period_table,
    pivot_regions,
    with_total,
)
from epitally.operators.population import pivot_population, unpivot_years
from epitally.operators.rates import drop_breakdown, to_period
from epitally.operators.series import SeriesSpec, missing_values, rename_all_regions, series
from epitally.operators.topics import pivot_topics, top_topics
from epitally.plans.cases import clean_cases, first_link, harmonise_names, national_incidence
from epitally.plans.catalogue import QUARTERLY, build_charts
from epitally.plans.denominators import population_table
from epitally.plans.enquiries import clean_enquiries
from epitally.plans.increments import case_exports, current_counts, ensure_counts
from epitally.plans.inputs import PopulationSources, ensure_population, read_wide_population, refresh_population
from epitally.plans.monthly import counted, less_detail, monthly_incidence, windowed_counts
from epitally.plans.situations import clean_situations
from epitally.sources import add_labels, normalize_columns, read_events, schemas, source_modified, write_table
from epitally.sources.versions import current_version
from epitally.staging import stage, stage_observed, staging_dir
from workload import projections as p
from workload.projections import REGIONS, Tables

Query = Callable[[SparkSession, str], DataFrame]

QUARTER = Report(2)
LAST_QUARTER = Report(4)
YEAR = Report(5)
LABELS = Labels()
STATISTICS_NAMES = {"EUROPE": "EU", "ASIA": "AS"}
REGISTRY: dict[str, Query] = {}


def query(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    """Register a query under its function's name, without the leading ``q_``."""
    REGISTRY[fn.__name__.removeprefix("q_")] = lambda spark, folder: fn(Tables(spark, folder))
    return fn


def _union(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


# Filters, recodes and parsing


@query
def q_monthly_counts(t: Tables) -> DataFrame:
    counts = with_date_parts(monthly_counts(p.cases(t), ["category"]), "month_start")
    return counts.select("year", "month", "region", "category", "n")


@query
def null_safe_exclusion(t: Tables) -> DataFrame:
    kept = p.cases(t).filter(not_in(F.col("category"), ["1-URGENT", "5-LOW"]))
    return kept.groupBy("region", "category").agg(F.count("*").alias("n"))


@query
def admission_filter(t: Tables) -> DataFrame:
    events = p.all_cases(t).withColumns(
        {
            "status": p.nullif("status", "P"),
            "deleted": F.when(F.col("o_totalprice") < 20000, F.col("event_date")),
        }
    )
    condition = admitted(
        F.col("c_mktsegment"),
        F.col("deleted"),
        F.col("status"),
        F.col("category"),
        confidences=["AUTOMOBILE", "BUILDING", "MACHINERY"],
        statuses=["F"],
        exempt_categories=["1-URGENT"],
        blocked_statuses=["O"],
    )
    return events.filter(condition).groupBy("category", "status").agg(F.count("*").alias("n"))


@query
def classify_rules(t: Tables) -> DataFrame:
    rules = (
        ("c_mktsegment", ("BUILDING", "MACHINERY"), "works"),
        ("status", ("P",), "pending"),
        ("merged", ("1-URGENT", "2-HIGH"), "fast"),
    )
    events = p.all_cases(t).withColumn("merged", recode(F.col("category"), {"5-LOW": "3-MEDIUM"}))
    return (
        events.withColumn("classified", classify(rules, F.col("merged")))
        .groupBy("category", "classified")
        .agg(F.count("*").alias("n"))
    )


@query
def spelling(t: Tables) -> DataFrame:
    name = F.col("p_name")
    parts = t.part.select(
        "p_name",
        unify_spelling(name, "widg.t", "gadget", only_with="widg").alias("unified"),
        unify_spelling(name, "(?i)^[aeiou]?[a-z]", "*").alias("without_head"),
    )
    return parts.groupBy("p_name", "unified", "without_head").agg(F.count("*").alias("n"))


@query
def id_prefix_region(t: Tables) -> DataFrame:
    prefix = F.col("prefix")
    return (
        p.identifiers(t)
        .select(
            "prefix",
            map_region(prefix, {"NATION_3": "N3", "NATION_8": "N8"}).alias("region_kept"),
            map_region(prefix, {"NATION_3": "N3", "NATION_13": "N13"}, default=None).alias("region_known"),
        )
        .groupBy("prefix", "region_kept", "region_known")
        .agg(F.count("*").alias("n"))
    )


@query
def parse_dates(t: Tables) -> DataFrame:
    return (
        p.date_texts(t)
        .select(
            "form",
            parse_day_month_year(F.col("written")).alias("event_date"),
            parse_leading_date(F.col("written")).alias("leading_date"),
        )
        .groupBy("form", "event_date", "leading_date")
        .agg(F.count("*").alias("n"))
    )


@query
def q_report_window(t: Tables) -> DataFrame:
    """The window on monthly counts, as a report has it: the events are read once."""
    windowed = with_date_parts(windowed_counts(p.cases(t), [], QUARTER, "cases"), "month_start")
    return windowed.groupBy("year", "quarter", "region").agg(F.sum("n").alias("n"))


# Dense monthly counts and rates


def _case_counts(t: Tables, report: Report = QUARTER) -> Counted:
    return counted(p.cases(t), ["category"], report, "cases", REGIONS)


def _situation_counts(t: Tables, report: Report = QUARTER, orders: DataFrame | None = None) -> Counted:
    return counted(p.situations(t, orders), ["scenario", "agent", "setting"], report, "situations", REGIONS)


def _enquiry_counts(t: Tables, report: Report = QUARTER, orders: DataFrame | None = None) -> Counted:
    return counted(p.enquiries(t, orders), ["topic"], report, "enquiries", REGIONS)


@query
def dense_calendar(t: Tables) -> DataFrame:
    counts = _case_counts(t)
    return dense_template(counts.frame, ["category"], REGIONS, facts=counts.facts)


@query
def q_dense_counts(t: Tables) -> DataFrame:
    counts = _case_counts(t)
    return dense_counts(counts.frame, ["category"], REGIONS, facts=counts.facts)


@query
def domain_dense_counts(t: Tables) -> DataFrame:
    """Categories from other tables: some that no case has, and only some of those that cases have."""
    segments = t.customer.select(F.col("c_mktsegment").alias("category"))
    priority = F.col("o_orderpriority")
    urgent = t.orders.select(F.when(priority < "3", priority).otherwise(F.concat(F.lit("not "), priority)).alias("category"))
    counts = _case_counts(t)
    return dense_counts(counts.frame, ["category"], REGIONS, segments.unionByName(urgent), facts=counts.facts)


@query
def pair_dense_counts(t: Tables) -> DataFrame:
    pairs = ["scenario", "agent"]
    counts = _situation_counts(t)
    return dense_counts(less_detail(counts.frame, pairs), pairs, REGIONS, facts=counts.facts)


@query
def region_rollup(t: Tables) -> DataFrame:
    counts = _enquiry_counts(t)
    return with_all_regions(zero_filled(counts.frame, ["topic"], REGIONS, facts=counts.facts), ["topic"])


def _case_monthly(t: Tables, report: Report = QUARTER) -> DataFrame:
    counts = _case_counts(t, report)
    return monthly_incidence(counts.frame, ["category"], p.population(t), REGIONS, facts=counts.facts)


def _pair_monthly(t: Tables, report: Report = QUARTER, orders: DataFrame | None = None) -> DataFrame:
    pairs = ["scenario", "agent"]
    counts = _situation_counts(t, report, orders)
    return monthly_incidence(less_detail(counts.frame, pairs), pairs, p.population(t), REGIONS, facts=counts.facts)


def _topic_monthly(t: Tables, report: Report = QUARTER, orders: DataFrame | None = None) -> DataFrame:
    counts = _enquiry_counts(t, report, orders)
    return monthly_incidence(counts.frame, ["topic"], p.population(t), REGIONS, facts=counts.facts)


@query
def incidence_monthly(t: Tables) -> DataFrame:
    return _case_monthly(t)


@query
def topic_incidence_monthly(t: Tables) -> DataFrame:
    return _topic_monthly(t)


@query
def period_incidence(t: Tables) -> DataFrame:
    return to_period(_topic_monthly(t), ["topic"], QUARTER)


@query
def period_incidence_year(t: Tables) -> DataFrame:
    return to_period(_case_monthly(t, YEAR), ["category"], YEAR)


@query
def scenario_monthly(t: Tables) -> DataFrame:
    return drop_breakdown(_pair_monthly(t), ["scenario"], "agent", ["O"])


# Population


@query
def population_wide(t: Tables) -> DataFrame:
    return pivot_population(p.population(t), t.population_years)


@query
def population_long(t: Tables) -> DataFrame:
    return unpivot_years(population_wide(t), [str(y) for y in t.population_years])


@query
def population_per_year_boundaries(t: Tables) -> DataFrame:
    return population_table(p.municipal_observations(t), p.area_map(t), region_names=STATISTICS_NAMES)


@query
def population_fixed_boundaries(t: Tables) -> DataFrame:
    table = population_table(
        p.municipal_observations(t), p.area_map(t), "fixed", boundary_year=2001, region_names=STATISTICS_NAMES
    )
    return pivot_population(table, t.population_years)


@query
def dimension_labels(t: Tables) -> DataFrame:
    nations = t.nation.select(F.concat(F.lit("N"), F.col("n_nationkey")).alias("Key"), F.col("n_name").alias("Title"))
    coded = t.supplier.select(
        F.rpad(F.concat(F.lit("N"), F.col("s_nationkey") + 5), 6, " ").alias("place"), "s_suppkey"
    )
    labelled = add_labels(coded, nations, "place")
    return labelled.groupBy(F.trim("place").alias("place"), "place_label").agg(F.count("*").alias("n"))


@query
def name_harmonise(t: Tables) -> DataFrame:
    national = t.part.groupBy(F.col("p_name").alias("national_name")).agg(F.count("*").alias("n"))
    link = t.part.select(
        F.when(F.col("p_size") <= 5, F.col("p_name")).alias("national_name"),
        F.col("p_type").alias("local_name"),
        F.col("p_partkey").alias("list_order"),
    )
    return harmonise_names(national, first_link(link))


# Period tables


def _disease_table(t: Tables, report: Report) -> DataFrame:
    """Regions and nation from the same staged counts, so from one scan of the orders."""
    events = p.all_cases(t).filter(F.col("category").isNotNull())
    parts = {"world": F.lit(True), "regional": F.col("world_region") == p.SUPRA_REGION}
    written = write_counts(monthly_counts(events, ["world_region", "category"]), "cases", REGIONS, parts)
    counts, window = written["world"].frame, written["regional"].window(report)
    regional, year = less_detail(window.frame, ["category"]), window.facts.year
    population = p.population(t)
    diseases = counts.select("category")
    national = at_period(counts, year, report).groupBy("category").agg(F.sum("n").alias("n"))
    return period_table(
        monthly_incidence(regional, ["category"], population, REGIONS, diseases, facts=window.facts),
        "category",
        report,
        year,
        REGIONS,
        DISEASE_STYLE,
        national=national_incidence(national, population, year),
        exclude=["5-LOW"],
    )


@query
def disease_table_quarter(t: Tables) -> DataFrame:
    return _disease_table(t, QUARTER)


@query
def disease_table_year(t: Tables) -> DataFrame:
    return _disease_table(t, YEAR)


def _orders_and_year(t: Tables, report: Report) -> tuple[DataFrame, int | None]:
    """The regional orders, written, and the report year: the cases, which are orders, set it for the other data sets too."""
    month = F.trunc("order_date", "MM").cast("string")
    orders, found = stage_observed(p.regional_orders(t), "regional-orders", {"months": F.collect_set(month)})
    facts = CountFacts(frozenset((date.fromisoformat(m), "listed") for m in found.get("months") or ()), ())
    return orders.drop("order_date"), facts.window(report).year


@query
def scenario_table(t: Tables) -> DataFrame:
    orders, year = _orders_and_year(t, QUARTER)
    return period_table(_pair_monthly(t, QUARTER, orders), "scenario", QUARTER, year, REGIONS, SITUATION_STYLE)


@query
def setting_table(t: Tables) -> DataFrame:
    orders, year = _orders_and_year(t, QUARTER)
    counts = _situation_counts(t, QUARTER, orders)
    monthly = monthly_incidence(less_detail(counts.frame, ["setting"]), ["setting"], p.population(t), REGIONS, facts=counts.facts)
    return period_table(monthly, "setting", QUARTER, year, REGIONS, SITUATION_STYLE)


@query
def setting_table_year(t: Tables) -> DataFrame:
    orders, year = _orders_and_year(t, YEAR)
    counts = _situation_counts(t, YEAR, orders)
    monthly = monthly_incidence(less_detail(counts.frame, ["setting"]), ["setting"], p.population(t), REGIONS, facts=counts.facts)
    return period_table(monthly, "setting", YEAR, year, REGIONS, SITUATION_STYLE)


def _sparse_cells(t: Tables) -> DataFrame:
    """Counts of all cases; one region's count of one category is not known."""
    counts = monthly_counts(p.cases(t), ["category"]).groupBy("region", "category").agg(F.sum("n").alias("n"))
    unknown = (F.col("region") == REGIONS[1]) & F.col("category").eqNullSafe(F.lit("2-HIGH"))
    cells = counts.select("region", "category", F.when(~unknown, F.col("n")).alias("n"), F.lit(0).cast("long").alias("population"))
    return pivot_regions(cells, ["category"], REGIONS)


def _totals(t: Tables, skip_nulls: bool) -> DataFrame:
    columns = [f"{region}_n" for region in REGIONS]
    return with_total(_sparse_cells(t), "category", columns, skip_nulls).select("category", "is_total", *columns)


@query
def total_row_propagating(t: Tables) -> DataFrame:
    return _totals(t, skip_nulls=False)


@query
def total_row_skipping(t: Tables) -> DataFrame:
    return _totals(t, skip_nulls=True)


@query
def rounding_masking(t: Tables) -> DataFrame:
    tens = F.col("c_acctbal") / 1000
    return t.customer.select(
        "c_custkey",
        round_half_away(tens, 1).alias("one_digit"),
        round_half_away(tens).alias("whole"),
        mask_zero(round_half_away(tens)).alias("masked"),
    )


# Top topics


def _top5(t: Tables) -> DataFrame:
    orders, year = _orders_and_year(t, QUARTER)
    return top_topics(_topic_monthly(t, QUARTER, orders), "topic", QUARTER, year, relabel={"Brand#1": "Brand # 1"})


@query
def top5_topics_long(t: Tables) -> DataFrame:
    return _top5(t)


@query
def top5_topics_wide(t: Tables) -> DataFrame:
    return pivot_topics(_top5(t), "topic", REGIONS)


# Chart series


@query
def series_total(t: Tables) -> DataFrame:
    return series(_case_monthly(t), "category", SeriesSpec("total", "cases"))


@query
def series_excluding(t: Tables) -> DataFrame:
    return series(_case_monthly(t), "category", SeriesSpec("excluding", "cases", exclude=("5-LOW",)))


@query
def series_multi(t: Tables) -> DataFrame:
    spec = SeriesSpec("multi", "topics", include=("Brand#3", "Brand#7"))
    return series(_topic_monthly(t), "topic", spec)


@query
def series_breakdown(t: Tables) -> DataFrame:
    spec = SeriesSpec("breakdown", "pairs", include=("R",), breakdown=("agent", ("O",)))
    return series(_pair_monthly(t), "scenario", spec)


@query
def series_years(t: Tables) -> DataFrame:
    spec = SeriesSpec("years", "cases", include=("1-URGENT",), years=(2000, 2001))
    return series(_case_monthly(t), "category", spec)


@query
def display_names(t: Tables) -> DataFrame:
    totals = to_period(_case_monthly(t), ["category"], QUARTER).groupBy("region").agg(F.sum("n").alias("n"))
    return rename_all_regions(totals, "Europe as a whole")


# Checks


@query
def quality_flags(t: Tables) -> DataFrame:
    """What the guards look at, per data set and report kind, learned while the counts of one pass over each event table are written."""
    parts = {"situations": F.col("situation"), "enquiries": F.lit(True)}
    written = write_counts(monthly_counts(p.cases(t), []), "cases") | write_counts(monthly_counts(p.line_events(t), ["situation"]), "items", parts=parts)
    population = stage(p.population(t), "population")
    needed = [*REGIONS, LABELS.all_regions, LABELS.national]
    flags = []
    for report in (QUARTER, LAST_QUARTER):
        facts = {name: found.facts.window(report) for name, found in written.items()}
        year = facts["cases"].year
        serving = denominator_flags(population, year, needed).first()
        for name, own in facts.items():
            flags.append({"dataset": name, "report": report.kind} | own.coverage(report, year) | {"fresh": serving.fresh, "complete": serving.complete})
    kinds = "first_year int, latest_year int, period_covered boolean, starts_in_time boolean, fresh boolean, complete boolean"
    return t.spark.createDataFrame(flags, f"dataset string, report int, {kinds}")


PRESENCE_SPECS = (
    SeriesSpec("both", "cases", include=("1-URGENT", "9-NONE")),
    SeriesSpec("left_out", "cases", exclude=("5-LOW", "0-NONE")),
    SeriesSpec("too_late", "cases", include=("2-HIGH",), years=(2090,)),
)


@query
def value_presence(t: Tables) -> DataFrame:
    """What the check of the requested chart values misses, over all cases."""
    counts = stage(monthly_counts(p.cases(t), ["category"]), "cases").withColumn("year", F.year("month_start"))
    missing = missing_values(counts, "category", PRESENCE_SPECS)
    asked = [(spec.name, value, value not in missing[spec.name]) for spec in PRESENCE_SPECS for value in (*spec.exclude, *(spec.include or ()))]
    return t.spark.createDataFrame(asked, "series string, value string, occurs boolean")


# Charts of the catalogue, cleaning of raw exports, and files


CATALOGUE_CATEGORIES = {"1-URGENT": "Kinkhoest (Pertussis)", "2-HIGH": "Scabies", "3-MEDIUM": "Legionellose"}
CATALOGUE_TOPICS = {"Brand#1": "Scabies (Schurft)", "Brand#2": "Buiktyfus", "Brand#3": "Anders"}


@query
def series_catalogue(t: Tables) -> DataFrame:
    """The shipped charts of two sources, the charts of a source from one pass."""
    cases = p.cases(t).withColumn("category", recode(F.col("category"), CATALOGUE_CATEGORIES))
    topics = p.enquiries(t).withColumn("topic", recode(F.col("topic"), CATALOGUE_TOPICS))
    population = p.population(t)
    monthly = {
        "diseases": monthly_incidence(windowed_counts(cases, ["category"], QUARTER, "cases"), ["category"], population, REGIONS),
        "topics": monthly_incidence(windowed_counts(topics, ["topic"], QUARTER, "enquiries"), ["topic"], population, REGIONS),
    }
    staged = {name: stage(df, name) for name, df in monthly.items()}
    return _union(build_charts(staged, [spec for spec in QUARTERLY if spec.source in staged]).values())


@query
def cleaned_cases(t: Tables) -> DataFrame:
    raw = normalize_columns(p.raw_cases(t))
    named = raw.select(*(F.col(f"`{c.header}`").alias(c.name) for c in schemas.CASES))
    return monthly_counts(clean_cases(named), ["category"])


@query
def cleaned_situations(t: Tables) -> DataFrame:
    return monthly_counts(clean_situations(p.raw_situations(t)), ["scenario", "agent", "setting"])


@query
def cleaned_enquiries(t: Tables) -> DataFrame:
    return monthly_counts(clean_enquiries(p.raw_enquiries(t)), ["topic"])


def _scratch(t: Tables, name: str) -> str:
    return f"{staging_dir(t.spark)}/epitally/{name}-{uuid4().hex}"


@query
def csv_cases(t: Tables) -> DataFrame:
    """The raw cases as exports: one with other marks and another order of the columns, and an empty one."""
    raw = p.raw_cases(t).withColumn("_half", F.col("Amount").cast("double").cast("long") % 2)
    folder = _scratch(t, "cases-csv")
    quoting = {"header": True, "quote": '"', "escape": '"', "emptyValue": ""}
    written = raw.withColumns({"Whole": F.format_number(F.floor("Amount"), 1), "Amount": F.format_number("Amount", 2)})
    first, second = written.filter("_half = 0").drop("_half"), written.filter("_half <> 0").drop("_half")
    first.write.options(**quoting).csv(f"{folder}/first")
    comma = second.withColumns({c: F.translate(c, ",.", ".,") for c in ("Amount", "Whole")})
    comma.select(*reversed(second.columns)).write.options(sep=";", **quoting).csv(f"{folder}/second")
    t.spark.range(1).select(F.lit("")).write.text(f"{folder}/empty")
    schema = (*schemas.CASES, schemas.InputColumn("Amount", "amount", "double"), schemas.InputColumn("Whole", "whole", "bigint"))
    read = read_events(t.spark, [f"{folder}/first", f"{folder}/second", f"{folder}/empty"], schema, split_beyond=0)
    cents = F.round(F.col("amount") * 100).cast("long")
    sums = F.count("*").alias("n"), F.sum(cents).alias("cents"), F.sum("whole").alias("wholes")
    return read.groupBy("disease", "summary_diagnosis", "confidence", "status").agg(*sums)


@query
def incremental_counts(t: Tables) -> DataFrame:
    """Counts kept by export file: four exports, nothing new, a fifth one, and one written anew."""
    folder = _scratch(t, "increments")
    raw = p.raw_cases(t).withColumn("export", F.pmod(F.crc32("`Case Identifier`"), F.lit(5)).cast("int"))

    def write(export: int) -> None:
        # One file that a task writes as rows arrive; to partition the output by export, it would first sort them all.
        own = raw.filter(F.col("export") == export).drop("export").repartition(1)
        own.write.mode("overwrite").options(header=True, quote='"', escape='"').csv(f"{folder}/exports/export={export}")

    updates = []
    for which in (range(4), (), (4,), (1,)):
        with ThreadPoolExecutor(4) as pool:
            list(pool.map(write, which))
        updates.append(ensure_counts(t.spark, case_exports(f"{folder}/exports"), f"{folder}/counts"))
    counted, dropped = (F.lit(",".join(map(str, n))).alias(name) for name, n in zip(("counted", "dropped"), zip(*updates, strict=True), strict=True))
    return current_counts(t.spark, f"{folder}/counts").select("*", counted, dropped)


@query
def csv_rejects(t: Tables) -> DataFrame:
    """Texts in number columns that give no number, from the table that reading writes."""
    key, balance = F.col("c_custkey"), F.col("c_acctbal").cast("decimal(18,2)")
    written = t.customer.select(
        F.when(key % 7 == 0, "n.v.t.").when(key % 11 == 0, "NA").when(key % 13 != 0, F.format_number(balance, 2)).alias("Balance"),
        F.when(key % 5 == 0, F.format_number(balance, 2)).when(key % 17 == 0, "99999999999999999999").otherwise(key.cast("string")).alias("Key"),
        F.lit("two\nlines").alias("Remark"),
    )
    folder = _scratch(t, "rejects")
    written.write.options(header=True, quote='"', escape='"').csv(f"{folder}/export")
    schema = (schemas.InputColumn("Balance", "balance", "double"), schemas.InputColumn("Key", "key", "bigint"))
    read = read_events(t.spark, f"{folder}/export", schema, rejects=f"{folder}/rejects")
    listed = t.spark.read.parquet(f"{folder}/rejects").groupBy("column", "reason").agg(F.count("*").alias("n"))
    kept = read.agg(F.count("balance").alias("balance"), F.count("key").alias("key"))
    kept = kept.select(F.inline(F.array(*(F.struct(F.lit(c).alias("column"), F.lit("kept").alias("reason"), F.col(c).alias("n")) for c in ("balance", "key")))))
    return listed.unionByName(kept)


@query
def csv_situations(t: Tables) -> DataFrame:
    """The raw situations as exports whose header names the agent twice, of which the first is meant."""
    raw = p.raw_situations(t)
    header = ["Name", "Date entered", "Artikel 26", "Scenario", "Principal Contextual Setting", "Infectious Agent", "Remark", "Infectious Agent"]
    texts = F.struct("name", "date_entered", "article_26", "scenario", "setting", "agent", F.lit("two\nlines").alias("remark"), F.lit("Other").alias("again"))
    lines = raw.select((F.crc32("name") % 4).alias("export"), F.to_csv(texts, {"quote": '"', "escape": '"'}).alias("value"))
    head = F.lit(",".join(header))
    # The rows of each task are an export, so none has to be brought together or sorted; its first row brings the header.
    exports = _union(lines.filter(F.col("export") == i).select("value") for i in range(4))
    first = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1) == 0
    exports = exports.select(F.when(first, F.concat_ws("\n", head, "value")).otherwise(F.col("value")).alias("value"))
    folder = _scratch(t, "situations-csv")
    # One more export holds no situation.
    exports.unionByName(t.spark.range(1).select(head.alias("value"))).write.text(folder)
    read = read_events(t.spark, folder, schemas.SITUATIONS, duplicated=["Infectious.Agent"])
    return monthly_counts(clean_situations(read), ["scenario", "agent", "setting"])


def _population_files(t: Tables, folder: str) -> PopulationSources:
    """Municipal counts, area tables and their dictionaries as files."""
    names = {"EUROPE": "GGD Zeeland", "ASIA": "GGD West-Brabant"}
    observations = p.municipal_observations(t).toDF("RegioS", "Perioden", "BevolkingAanHetBeginVanDePeriode_1")
    write_table(observations, f"{folder}/observations.parquet")
    areas, dictionaries = {}, {}
    for year in p.AREA_YEARS:
        # The columns of the regions move from year to year; the dictionary tells them.
        code, name = f"Code_{year % 10}{year % 2}", f"Naam_{year % 10}{year % 2 + 1}"
        area = p.area_map(t).filter(F.col("boundary_year") == year).select(
            F.rpad("municipality", 10, " ").alias("Code_1"),
            F.upper("municipality").alias("Naam_2"),
            F.lit(f"Municipality\nBegindatum {year}, or before").alias("Omschrijving_3"),
            F.lit("GG").alias(code),
            F.concat(recode(F.col("region_name"), names), F.lit("  ")).alias(name),
        )
        areas[year], dictionaries[year] = f"{folder}/area{year}", f"{folder}/dictionary{year}"
        quoting = {"header": True, "quote": '"', "escape": '"', "ignoreTrailingWhiteSpace": False}
        area.write.options(**quoting).csv(areas[year])
        columns = [
            (21, 5, "TopicGroup", "", "GGD-regio's", None),
            (22, 21, "Topic", code, "Code", 14),
            (23, 21, "Topic", name, "Naam", 15),
        ]
        dictionary = t.spark.createDataFrame(columns, "ID int, ParentID int, Type string, Key string, Title string, Position int")
        dictionary.write.options(**quoting).csv(dictionaries[year])
    return PopulationSources(f"{folder}/observations.parquet", areas, dictionaries)


@query
def population_refresh(t: Tables) -> DataFrame:
    """Regional population by fixed boundaries, made from files, written and read back."""
    folder = _scratch(t, "population")
    files = _population_files(t, folder)
    refresh_population(t.spark, files.observations, files.area_tables, files.dictionaries, f"{folder}/wide.parquet", "fixed")
    return read_wide_population(t.spark, f"{folder}/wide.parquet")


@query
def population_upkeep(t: Tables) -> DataFrame:
    """Regional population by each year's boundaries: absent at first, then a year behind its files, then up to date."""
    folder = _scratch(t, "upkeep")
    files, path = _population_files(t, folder), f"{folder}/wide.parquet"
    made = [ensure_population(t.spark, replace(files, last_year=last), path) for last in (p.AREA_YEARS[-2], None, None)]
    version = current_version(t.spark, path)
    facts = F.lit(",".join(str(len(years)) for years in made)).alias("made"), F.lit(version.number).cast("int").alias("version")
    return read_wide_population(t.spark, path).select("region", "pop_year", "population", *facts)


@query
def export_order(t: Tables) -> DataFrame:
    """When the files of the event inputs were written, as an order, and the column header of the year before."""
    folder = _scratch(t, "exports")
    events = {"enquiries": p.raw_enquiries(t), "cases": p.raw_cases(t), "situations": p.raw_situations(t)}
    for name, raw in events.items():  # one after another
        raw.write.option("header", True).csv(f"{folder}/{name}")
    modified = {name: source_modified(t.spark, f"{folder}/{name}") for name in events}
    year = counted(p.cases(t), [], QUARTER, "case-months").facts.year
    found = [
        (name, sorted(modified.values()).index(time) + 1, report.comparison_label("Region", year))
        for name, time in modified.items()
        for report in (QUARTER, YEAR)
    ]
    return t.spark.createDataFrame(found, "dataset string, place int, comparison string")
