"""Star-schema tables seen as surveillance inputs.

The nations of EUROPE are the regions, EUROPE is the supra-region and all
customers are the nation. Joins leave the largest table for last, so that it is
shuffled once and only against orders that are already limited to EUROPE;
Spark broadcasts a side when its measured size allows and splits skewed
partitions otherwise.

The raw inputs at the end have the headers and values of real exports, so that
they pass through the readers and the cleaning of the library.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from epitally.functions import id_prefix, is_in
from epitally.staging import stage

SUPRA_REGION = "EUROPE"
REGIONS = ("NATION_3", "NATION_8", "NATION_13", "NATION_18", "NATION_23")
UNKNOWN_REGION = "NATION_23"
AREA_YEARS = tuple(range(1996, 2002))

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


class Tables:
    """Lazy scans of one scale-factor folder."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder.rstrip("/")
        # A query looks into each table's footer once.
        self._schemas: dict[str, StructType] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        path = f"{self.folder}/{name}.parquet"
        if name not in self._schemas:
            self._schemas[name] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(self._schemas[name]).parquet(path)

    @cached_property
    def population_years(self) -> list[int]:
        """From the year before the first order, whose count serves it, to the year of the last."""
        year = F.year("o_orderdate")
        span = self.orders.agg(F.min(year).alias("first"), F.max(year).alias("last")).first()
        return list(range(span.first - 1, span.last + 1))


def nullif(col: str, value: str) -> Column:
    return F.nullif(F.col(col), F.lit(value))


def places(t: Tables) -> DataFrame:
    """Nations with their region of the world."""
    return t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))


def customer_regions(t: Tables) -> DataFrame:
    named = places(t).select("n_nationkey", F.col("n_name").alias("region"), F.col("r_name").alias("world_region"))
    return t.customer.join(named, F.col("c_nationkey") == F.col("n_nationkey"))


def supra_region_only(df: DataFrame) -> DataFrame:
    return df.filter(F.col("world_region") == SUPRA_REGION)


def all_cases(t: Tables) -> DataFrame:
    """One event per order, anywhere."""
    orders = t.orders.select(
        "o_orderkey",
        "o_custkey",
        F.col("o_orderdate").cast("date").alias("event_date"),
        nullif("o_orderpriority", "4-NOT SPECIFIED").alias("category"),
        F.col("o_orderstatus").alias("status"),
        "o_totalprice",
    )
    return orders.join(customer_regions(t), F.col("o_custkey") == F.col("c_custkey"))


def cases(t: Tables) -> DataFrame:
    return supra_region_only(all_cases(t)).select("region", "event_date", "category", "status")


def regional_orders(t: Tables) -> DataFrame:
    customers = supra_region_only(customer_regions(t)).select("c_custkey", "region")
    orders = t.orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
    return orders.select("o_orderkey", "region", F.col("o_orderdate").cast("date").alias("order_date"))


def situations(t: Tables, orders: DataFrame | None = None) -> DataFrame:
    """``orders``: the regional ones, if they are written already."""
    items = t.lineitem.filter(F.col("l_discount") > 0.05).select(
        "l_orderkey",
        F.col("l_shipdate").cast("date").alias("event_date"),
        nullif("l_returnflag", "A").alias("scenario"),
        nullif("l_linestatus", "F").alias("agent"),
        F.nullif(F.col("l_linenumber").cast("string"), F.lit("7")).alias("setting"),
    )
    return (
        items.join(orders if orders is not None else regional_orders(t), F.col("l_orderkey") == F.col("o_orderkey"))
        .select("region", "event_date", "scenario", "agent", "setting")
        .fillna("(leeg)", ["scenario", "setting"])
    )


def enquiries(t: Tables, orders: DataFrame | None = None) -> DataFrame:
    items = t.lineitem.select("l_orderkey", "l_partkey", F.col("l_shipdate").cast("date").alias("event_date"))
    parts = t.part.select("p_partkey", F.col("p_brand").alias("topic"))
    return (
        items.join(orders if orders is not None else regional_orders(t), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .select(nullif("region", UNKNOWN_REGION).alias("region"), "event_date", "topic")
    )


def line_events(t: Tables) -> DataFrame:
    """Line items of the supra-region: all of them are enquiries, some are situations."""
    items = t.lineitem.select(
        "l_orderkey", F.col("l_shipdate").cast("date").alias("event_date"), (F.col("l_discount") > 0.05).alias("situation")
    )
    return items.join(regional_orders(t), F.col("l_orderkey") == F.col("o_orderkey")).select("region", "event_date", "situation")


def population(t: Tables) -> DataFrame:
    """Inhabitants per nation of EUROPE, over all of them, and over the world, by year."""
    per_nation = customer_regions(t).groupBy("region", "world_region").agg(F.count("*").alias("customers"))
    rows = F.when(
        F.col("world_region") == SUPRA_REGION,
        F.array(F.col("region"), F.lit("ALL_REGIONS"), F.lit("NATIONAL")),
    ).otherwise(F.array(F.lit("NATIONAL")))
    # A few nations by now, and a written result whose size the optimizer knows.
    by_place = (
        per_nation.select(F.explode(rows).alias("region"), "customers")
        .select("region", "customers", F.explode(F.lit(t.population_years)).alias("pop_year"))
        .groupBy("region", "pop_year")
        .agg(F.sum(F.col("customers") * 10000 + (F.col("pop_year") - 1994) * 1000).alias("population"))
    )
    return stage(by_place, "population").withColumn("year", F.col("pop_year") + 1)


# Municipalities: one per nation and market segment.


def municipality_code(nation: str, segment: str) -> Column:
    code = F.concat(F.lit("GM"), F.lpad(F.col(nation).cast("string"), 2, "0"), F.substring(segment, 1, 2))
    return F.rpad(code, 10, " ")


def municipal_observations(t: Tables) -> DataFrame:
    """Padded code, period code and population; one municipality misses one year."""
    counted = t.customer.groupBy("c_nationkey", "c_mktsegment").agg(F.count("*").alias("customers"))
    periods = F.flatten(
        F.transform(
            F.lit(t.population_years),
            lambda y: F.array(
                F.concat(y.cast("string"), F.lit("MM01")),
                F.concat(y.cast("string"), F.lit("MM07")),
                F.concat(y.cast("string"), F.lit("JJ00")),
            ),
        )
    )
    observed = counted.withColumn("period_code", F.explode(periods)).withColumn(
        "value", F.col("customers") * 100 + (F.substring("period_code", 1, 4).cast("int") - 1994) * 10
    )
    unknown = (F.col("c_nationkey") == 3) & is_in(F.col("c_mktsegment"), ["MACHINERY"]) & (
        F.substring("period_code", 1, 4) == "1997"
    )
    municipal = observed.select(
        municipality_code("c_nationkey", "c_mktsegment").alias("municipality"),
        "period_code",
        F.when(~unknown, F.col("value")).alias("population"),
    )
    nation = observed.groupBy("period_code").agg(F.sum("value").alias("population"))
    return municipal.unionByName(nation.withColumn("municipality", F.rpad(F.lit("NL01"), 10, " ")))


def area_map(t: Tables) -> DataFrame:
    """Boundaries 1996-2001: BUILDING moves in 1999, one municipality ends in 2001."""
    segments = t.customer.select("c_nationkey", "c_mktsegment").distinct()
    yearly = segments.join(places(t), F.col("c_nationkey") == F.col("n_nationkey")).withColumn(
        "boundary_year", F.explode(F.lit(list(AREA_YEARS)))
    )
    ended = (F.col("boundary_year") == 2001) & (F.col("c_nationkey") == 8) & (F.col("c_mktsegment") == "AUTOMOBILE")
    moved = (F.col("boundary_year") >= 1999) & (F.col("c_mktsegment") == "BUILDING")
    return yearly.filter(~ended).select(
        "boundary_year",
        F.trim(municipality_code("c_nationkey", "c_mktsegment")).alias("municipality"),
        F.when(moved, F.lit("MIDDLE EAST")).otherwise(F.col("r_name")).alias("region_name"),
    )


def identifiers(t: Tables) -> DataFrame:
    """Customers with an identifier whose prefix is their nation."""
    numbered = customer_regions(t).withColumn("identifier", F.concat_ws("/", "region", F.col("c_custkey")))
    return numbered.select("identifier", id_prefix(F.col("identifier")).alias("prefix"))


# The months as the Dutch shorten them.
_DUTCH_MONTHS = ["jan", "feb", "mrt", "apr", "mei", "jun", "jul", "aug", "sep", "okt", "nov", "dec"]


def date_texts(t: Tables) -> DataFrame:
    """Ship dates written in fourteen ways; forms 5 and 15 are never dates, form 7 only to one parser."""
    date = F.col("l_shipdate").cast("date")
    form = F.col("l_linenumber") + 10 * (F.col("l_orderkey") % 2).cast("int")
    dutch = F.element_at(F.array(*map(F.lit, _DUTCH_MONTHS)), F.month(date))
    written = {
        1: F.date_format(date, "dd/MM/yyyy"),
        2: F.date_format(date, "d-M-yyyy"),
        3: F.date_format(date, "dd.MM.yyyy"),
        4: F.date_format(date, "dd MM yyyy"),
        5: F.concat(F.lit("31/02/"), F.year(date).cast("string")),
        6: F.date_format(date, "ddMMyyyy"),
        7: F.concat(F.date_format(date, "dd/MM/yyyy"), F.lit(" 13:45")),
        11: F.concat(F.lit("\t"), F.date_format(date, "d-M-yy"), F.lit("\r")),
        12: F.date_format(date, "d , M , yyyy"),
        13: F.concat(F.dayofmonth(date).cast("string"), dutch, F.year(date).cast("string")),
        14: F.date_format(date, "d MMM yy"),
        15: F.concat(F.lit("31/02/"), F.year(date).cast("string")),
        16: F.date_format(date, "ddMMyy"),
        17: F.concat(F.date_format(date, "d - M - yyyy"), F.lit("\t")),
    }
    text = F.coalesce(*(F.when(form == k, v) for k, v in written.items()))
    return t.lineitem.select(form.alias("form"), text.alias("written"))


# Raw exports: real headers and values, one row per order or line item.


def _pick(key: Column, values: list[str | None]) -> Column:
    """One of the values, by the remainder of a number."""
    return F.element_at(F.array(*(F.lit(v).cast("string") for v in values)), (key % len(values) + 1).cast("int"))


PREFIXES = ["BZO", "WBT", "HVB", "ZEE", "NLG", "ZLG", "ABC"]
DIAGNOSES = ["Scabi\u00ebs", "Acute hepatitis B", "Monkeypox", "one\nand \"two\", three", None]
CONFIDENCES = ["Confirmed", "Possible", "Probable", "Unlikely", None]
DISEASES = {
    "1-URGENT": "Hepatitis B",
    "2-HIGH": "Kinkhoest (Pertussis)",
    "3-MEDIUM": None,
    "4-NOT SPECIFIED": "COVID-19",
    "5-LOW": "Legionellose",
}
STATUSES = ["Definitief", "Gefiatteerd", "Gewist", None]
ENQUIRY_REGIONS = ["Brabant-Zuidoost", "Hart voor Brabant", "West-Brabant", "Zeeland", "Noord Limburg", "Zuid Limburg", "Elders"]
TOPICS = ["Scabies (Schurft)", "COVID-19", "Besmettingsaccident/mensenbeet", None, "Anders"]


def raw_cases(t: Tables) -> DataFrame:
    """Every order as a reported case, with an amount that is no column of a case export."""
    key = F.col("o_orderkey")
    disease = F.coalesce(*(F.when(F.col("o_orderpriority") == k, F.lit(v)) for k, v in DISEASES.items()))
    return t.orders.select(
        F.concat_ws("/", _pick(F.col("o_custkey"), PREFIXES), key).alias("Case Identifier"),
        F.date_format("o_orderdate", "dd-MM-yyyy").alias("Time  entered"),
        disease.alias("Meldingsplichtige ziekte"),
        _pick(key, DIAGNOSES).alias("Summary Diagnosis"),
        F.when(key % 11 == 0, "CPE").alias("ABR"),
        F.when(key % 13 == 0, "Dengue Fever").alias("Infection"),
        _pick(F.floor(key / 8), CONFIDENCES).alias("Confidence"),
        F.when(F.col("o_totalprice") < 20000, "01-01-2020").alias("Datum gewist"),
        _pick(F.col("o_custkey") + key, STATUSES).alias("Status van de melding"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("Amount"),
    )


def raw_situations(t: Tables) -> DataFrame:
    return t.lineitem.select(
        F.concat_ws("/", _pick(F.col("l_suppkey"), PREFIXES), "l_orderkey").alias("name"),
        F.date_format("l_shipdate", "d/M/yyyy").alias("date_entered"),
        F.when(F.col("l_discount") > 0.05, "Yes").when(F.col("l_discount") > 0.02, "No").alias("article_26"),
        nullif("l_returnflag", "A").alias("scenario"),
        F.nullif(F.col("l_linenumber").cast("string"), F.lit("7")).alias("setting"),
        nullif("l_linestatus", "F").alias("agent"),
    )


def raw_enquiries(t: Tables) -> DataFrame:
    return t.lineitem.select(
        F.when(F.col("l_returnflag") != "A", "Infectieziekten").alias("broad_topic"),
        _pick(F.col("l_partkey"), TOPICS).alias("topic"),
        F.when(F.col("l_linenumber") < 7, F.date_format("l_shipdate", "dd/MM/yyyy HH:mm")).alias("received_on"),
        _pick(F.col("l_suppkey"), ENQUIRY_REGIONS).alias("region_name"),
    )
