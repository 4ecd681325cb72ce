"""The same results in plain SQL, written independently of the DataFrame code."""

from __future__ import annotations

from epitally.plans.catalogue import QUARTERLY
from workload import projections as p
from workload.projections import REGIONS

_PLACES = """
customer_regions AS (
    SELECT c_custkey, c_nationkey, c_mktsegment, c_acctbal, n_name, r_name
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
)"""

_ALL_CASES = f"""{_PLACES},
all_cases AS (
    SELECT n_name AS region, r_name AS world_region, c_mktsegment,
           CAST(o_orderdate AS DATE) AS event_date,
           nullif(o_orderpriority, '4-NOT SPECIFIED') AS category,
           o_orderstatus AS status, o_totalprice
    FROM orders JOIN customer_regions ON o_custkey = c_custkey
)"""

_CASES = f"""{_ALL_CASES},
events AS (SELECT region, event_date, category, status FROM all_cases WHERE world_region = 'EUROPE')"""

_REGIONAL_ORDERS = f"""{_PLACES},
regional_orders AS (
    SELECT o_orderkey, n_name AS region FROM orders JOIN customer_regions ON o_custkey = c_custkey
    WHERE r_name = 'EUROPE'
)"""

_SITUATIONS = f"""{_REGIONAL_ORDERS},
events AS (
    SELECT region, CAST(l_shipdate AS DATE) AS event_date,
           coalesce(nullif(l_returnflag, 'A'), '(leeg)') AS scenario,
           nullif(l_linestatus, 'F') AS agent,
           coalesce(nullif(CAST(l_linenumber AS VARCHAR), '7'), '(leeg)') AS setting
    FROM lineitem JOIN regional_orders ON l_orderkey = o_orderkey
    WHERE l_discount > 0.05
)"""

_ENQUIRIES = f"""{_REGIONAL_ORDERS},
events AS (
    SELECT nullif(region, 'NATION_23') AS region, CAST(l_shipdate AS DATE) AS event_date, p_brand AS topic
    FROM lineitem JOIN regional_orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
)"""

_YEARS = """
population_years AS (
    SELECT unnest(range((SELECT min(year(o_orderdate)) - 1 FROM orders), (SELECT max(year(o_orderdate)) + 1 FROM orders))) AS pop_year
)"""

_POPULATION = f"""{_YEARS},
per_nation AS (
    SELECT n_name, r_name, y.pop_year, count(*) * 10000 + (y.pop_year - 1994) * 1000 AS inhabitants
    FROM customer_regions CROSS JOIN population_years y
    GROUP BY n_name, r_name, y.pop_year
),
population AS (
    SELECT n_name AS region, CAST(pop_year AS INTEGER) AS pop_year, CAST(inhabitants AS BIGINT) AS population,
           CAST(pop_year + 1 AS INTEGER) AS year
    FROM per_nation WHERE r_name = 'EUROPE'
    UNION ALL
    SELECT 'ALL_REGIONS', CAST(pop_year AS INTEGER), CAST(sum(inhabitants) AS BIGINT), CAST(pop_year + 1 AS INTEGER)
    FROM per_nation WHERE r_name = 'EUROPE' GROUP BY pop_year
    UNION ALL
    SELECT 'NATIONAL', CAST(pop_year AS INTEGER), CAST(sum(inhabitants) AS BIGINT), CAST(pop_year + 1 AS INTEGER)
    FROM per_nation GROUP BY pop_year
)"""

# First day after the report window: Q2 ends in June, a yearly report with its year.
_CUTOFF = {2: "make_date(year(max(event_date)), 7, 1)", 5: "make_date(year(max(event_date)) + 1, 1, 1)"}


def _counts(by: str, report: int = 2) -> str:
    return f"""
windowed AS (SELECT * FROM events WHERE event_date < (SELECT {_CUTOFF[report]} FROM events)),
counts AS (
    SELECT region, CAST(date_trunc('month', event_date) AS DATE) AS month_start, {by}, count(*) AS n
    FROM windowed GROUP BY ALL
)"""


def _template(by: str, domain: str | None = None) -> str:
    domain = domain or f"SELECT DISTINCT {by} FROM windowed"
    return f"""
months AS (
    SELECT make_date(y.y, CAST(m.m AS INTEGER), 1) AS month_start
    FROM (SELECT DISTINCT CAST(year(event_date) AS INTEGER) AS y FROM windowed) y
    CROSS JOIN (SELECT unnest(range(1, 13)) AS m) m
    WHERE make_date(y.y, CAST(m.m AS INTEGER), 1) <= (SELECT max(event_date) FROM windowed)
),
template AS (
    SELECT r.region, months.month_start, d.*
    FROM (SELECT unnest({list(REGIONS)}) AS region UNION SELECT DISTINCT region FROM windowed) r CROSS JOIN months CROSS JOIN ({domain}) d
)"""


def _dense(by: str, domain: str | None = None, report: int = 2) -> str:
    columns = [c.strip() for c in by.split(",")]
    same = " AND ".join(f"c.{c} IS NOT DISTINCT FROM t.{c}" for c in ["region", "month_start", *columns])
    return f"""{_counts(by, report)},{_template(by, domain)},
dense AS (SELECT t.*, coalesce(c.n, 0) AS n FROM template t LEFT JOIN counts c ON {same})"""


def _monthly(by: str, domain: str | None = None, report: int = 2) -> str:
    return f"""{_dense(by, domain, report)},{_POPULATION},
rolled AS (
    SELECT region, month_start, {by}, n FROM dense
    UNION ALL
    SELECT 'ALL_REGIONS', month_start, {by}, CAST(sum(n) AS BIGINT) FROM dense GROUP BY month_start, {by}
),
monthly AS (
    SELECT r.region, CAST(year(r.month_start) AS INTEGER) AS year, r.month_start, {by}, r.n, p.population,
           CAST(r.n AS DOUBLE) / nullif(p.population, 0) * 1000000.0 AS incidence
    FROM rolled r LEFT JOIN population p ON r.region = p.region AND year(r.month_start) = p.year
)"""


_SUMMED = """CAST(sum(n) AS BIGINT) AS n, max(population) AS population,
       coalesce(CAST(sum(n) AS DOUBLE) / nullif(max(population), 0) * 1000000.0, 0) AS incidence"""


def _period(report: int) -> str:
    if report == 5:
        return "CAST(year(month_start) AS VARCHAR)"
    return "year(month_start) || '_Q' || quarter(month_start)"


def _round(x: str, scale: float = 1) -> str:
    return f"(sign({x}) * floor(abs({x}) * {scale} + 0.5) / {scale} + 0.0)"


# Report year 2001: the latest year of the cases at every scale factor.
_REPORT_YEAR = "(SELECT CAST(year(max(CAST(o_orderdate AS DATE))) AS INTEGER) FROM orders JOIN customer_regions ON o_custkey = c_custkey WHERE r_name = 'EUROPE')"


def _period_table(head: str, by: str, report: int, disease: bool) -> str:
    """Conditional sums per category, a total from the same sums, then rates."""
    in_quarter = "" if report == 5 else f" AND quarter(month_start) = {report}"
    now = f"(year = y.y{in_quarter})"
    before = f"(year = y.y - 1{in_quarter})"
    names = [*REGIONS, "ALL_REGIONS"]
    keep = "category <> '5-LOW'" if disease else "TRUE"
    sums = ",\n".join(
        f"sum(n) FILTER ({now} AND region = '{r}') AS {r}_n, max(population) FILTER ({now} AND region = '{r}') AS {r}_p"
        for r in names
    )
    nation_cells = ""
    if disease:
        nation_cells = f"""
nation AS (
    SELECT category, count(*) AS n FROM all_cases, (SELECT {_REPORT_YEAR} AS y) y
    WHERE year(event_date) = y.y{in_quarter.replace("month_start", "event_date")}
      AND category IS NOT NULL AND event_date < (SELECT {_CUTOFF[report]} FROM events)
    GROUP BY category
),"""
    wide = f"""
y AS (SELECT {_REPORT_YEAR} AS y),{nation_cells}
regional AS (
    SELECT {by}, {sums},
           sum(n) FILTER ({before} AND region = 'ALL_REGIONS') AS prev_n,
           max(population) FILTER ({before} AND region = 'ALL_REGIONS') AS prev_p
    FROM monthly, y WHERE {keep} GROUP BY {by}
    HAVING count(*) FILTER ({now}) > 0
),"""
    if disease:
        nation_population = "(SELECT population FROM population, y WHERE region = 'NATIONAL' AND year = y.y)"
        wide += f"""
wide AS (
    SELECT regional.*, nation.n AS NATIONAL_n, {nation_population} AS NATIONAL_p
    FROM regional LEFT JOIN nation ON nation.category = regional.category
),"""
        names = [*names, "NATIONAL"]
    else:
        wide += "\nwide AS (SELECT * FROM regional),"
    columns = [*names, "prev"]
    if disease:
        total = ", ".join(f"coalesce(sum({c}_n), 0) AS {c}_n, max({c}_p) AS {c}_p" for c in columns)
    else:
        total = ", ".join(
            f"CASE WHEN count(*) = count({c}_n) THEN sum({c}_n) END AS {c}_n, max({c}_p) AS {c}_p" for c in columns
        )
    plain = ", ".join(f"{c}_n, {c}_p" for c in columns)
    both = f"""
both_rows AS (
    SELECT {by}, FALSE AS is_total, {plain} FROM wide
    UNION ALL SELECT 'TOTAL', TRUE, {plain} FROM (SELECT {total} FROM wide)
)"""
    masked = {*REGIONS} | ({"ALL_REGIONS", "prev"} if disease else set())

    def mask(expr: str, name: str) -> str:
        return f"nullif({expr}, 0)" if name in masked else expr

    def rate(name: str) -> str:
        value = f"CAST({name}_n AS DOUBLE) / nullif({name}_p, 0) * 1000000.0"
        if name != "NATIONAL":
            value = f"CASE WHEN {name}_n IS NOT NULL THEN coalesce({value}, 0) END"
        alias = "ALL_REGIONS_incidence_previous" if name == "prev" else f"{name}_incidence"
        return f"{mask(_round(f'({value})'), name)} AS {alias}"

    outputs = [f"{mask(f'CAST({c}_n AS BIGINT)', c)} AS {c}_n" for c in names] + [rate(c) for c in columns]
    return f"WITH {head},{wide}{both}\nSELECT {by}, is_total, {', '.join(outputs)} FROM both_rows"


def _series(head: str, where: str) -> str:
    return f"""WITH {head},
points AS (
    SELECT region, month_start, CAST(sum(n) AS BIGINT) AS n,
           coalesce(CAST(sum(n) AS DOUBLE) / nullif(max(population), 0) * 1000000.0, 0) AS incidence
    FROM monthly WHERE {where} GROUP BY region, month_start
)
SELECT p.region, p.month_start, p.n, p.incidence, a.incidence AS incidence_all,
       CASE WHEN month(p.month_start) = 1 THEN strftime(p.month_start, '%b') || chr(10) || strftime(p.month_start, '%Y')
            ELSE strftime(p.month_start, '%b') END AS axis_label
FROM points p LEFT JOIN points a ON a.region = 'ALL_REGIONS' AND a.month_start = p.month_start
WHERE p.region IS DISTINCT FROM 'ALL_REGIONS'"""


_CASE_MONTHLY = f"{_CASES},{_monthly('category')}"
_TOPIC_MONTHLY = f"{_ENQUIRIES},{_monthly('topic')}"
_PAIR_MONTHLY = f"{_SITUATIONS},{_monthly('scenario, agent')}"
_DISEASES = "SELECT DISTINCT category FROM all_cases WHERE category IS NOT NULL"
_DISEASE_CASES = f"""{_ALL_CASES},
events AS (SELECT * FROM all_cases WHERE world_region = 'EUROPE' AND category IS NOT NULL)"""

_TOP5 = f"""{_TOPIC_MONTHLY},
totals AS (
    SELECT region, {_period(2)} AS period,
           CASE WHEN topic = 'Brand#1' THEN 'Brand # 1' ELSE topic END AS topic, CAST(sum(n) AS BIGINT) AS n
    FROM monthly
    WHERE year = {_REPORT_YEAR} AND quarter(month_start) = 2 AND region IS NOT NULL AND region <> 'ALL_REGIONS'
    GROUP BY ALL
),
ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY region, period ORDER BY n DESC, topic) AS INTEGER) AS rank
    FROM totals QUALIFY rank <= 5
)"""

_MUNICIPAL = f"""{_PLACES},{_YEARS},
counted AS (
    SELECT c_nationkey, c_mktsegment, r_name,
           'GM' || lpad(CAST(c_nationkey AS VARCHAR), 2, '0') || substr(c_mktsegment, 1, 2) AS municipality,
           count(*) AS customers
    FROM customer_regions GROUP BY ALL
),
observations AS (
    SELECT municipality, c_nationkey, c_mktsegment, r_name, CAST(y AS INTEGER) AS pop_year,
           customers * 100 + (y - 1994) * 10 AS value,
           CASE WHEN c_nationkey = 3 AND c_mktsegment = 'MACHINERY' AND y = 1997 THEN NULL
                ELSE customers * 100 + (y - 1994) * 10 END AS population
    FROM counted CROSS JOIN (SELECT pop_year AS y FROM population_years)
),
area AS (
    SELECT CAST(b AS INTEGER) AS boundary_year, municipality,
           CASE WHEN b >= 1999 AND c_mktsegment = 'BUILDING' THEN 'MIDDLE EAST' ELSE r_name END AS region_name
    FROM counted CROSS JOIN (SELECT unnest(range(1996, 2002)) AS b)
    WHERE NOT (b = 2001 AND c_nationkey = 8 AND c_mktsegment = 'AUTOMOBILE')
),
wanted AS (
    SELECT boundary_year, municipality, CASE region_name WHEN 'EUROPE' THEN 'EU' ELSE 'AS' END AS region
    FROM area WHERE region_name IN ('EUROPE', 'ASIA')
),
nation_rows AS (SELECT pop_year, CAST(sum(value) AS BIGINT) AS population FROM observations GROUP BY pop_year)"""


def _population_pivot(rows: str) -> str:
    years = ", ".join(f'max(population) FILTER (pop_year = {y}) AS "{y}"' for y in range(1994, 2002))
    return f"SELECT region, {years} FROM {rows} GROUP BY region"


def _flags(dataset: str, events: str, report: int) -> str:
    cutoff = {2: "make_date(max(year(event_date)), 7, 1)", 4: "make_date(max(year(event_date)) + 1, 1, 1)"}[report]
    window = f"(SELECT * FROM {events} WHERE event_date < (SELECT {cutoff} FROM {events}))"
    year = "(SELECT y FROM report_year)"
    return f"""
SELECT '{dataset}' AS dataset, {report} AS report,
       CAST(min(year(event_date)) AS INTEGER) AS first_year, CAST(max(year(event_date)) AS INTEGER) AS latest_year,
       count(*) FILTER (quarter(event_date) = {report} AND year(event_date) = (SELECT max(year(event_date)) FROM {window})) > 0
           AS period_covered,
       min(year(event_date)) <= {year} AS starts_in_time,
       (SELECT max(pop_year) FROM population) >= {year} - 1 AS fresh,
       (SELECT count(DISTINCT region) FROM population WHERE pop_year = {year} - 1 AND population IS NOT NULL) = {len(REGIONS) + 2} AS complete
FROM {window}"""


def _all_flags() -> str:
    head = f"""WITH {_ALL_CASES},
cases AS (SELECT region, event_date FROM all_cases WHERE world_region = 'EUROPE'),
regional_orders AS (
    SELECT o_orderkey, n_name AS region FROM orders JOIN customer_regions ON o_custkey = c_custkey
    WHERE r_name = 'EUROPE'
),
enquiries AS (
    SELECT region, CAST(l_shipdate AS DATE) AS event_date FROM lineitem JOIN regional_orders ON l_orderkey = o_orderkey
),
situations AS (
    SELECT region, CAST(l_shipdate AS DATE) AS event_date FROM lineitem JOIN regional_orders ON l_orderkey = o_orderkey
    WHERE l_discount > 0.05
),
report_year AS (SELECT max(year(event_date)) AS y FROM cases),{_POPULATION}"""
    names = ("cases", "situations", "enquiries")
    return head + " UNION ALL ".join(_flags(name, name, report) for report in (2, 4) for name in names)


# The texts are not parsed here: their dates are known. A time after the date is not one for the first parser.
_DATE_FORMS = """
written AS (
    SELECT CAST(l_linenumber + 10 * (l_orderkey % 2) AS INTEGER) AS form, CAST(l_shipdate AS DATE) AS date FROM lineitem
)"""

_HARMONISE = """
WITH national AS (SELECT p_name AS national_name, count(*) AS n FROM part GROUP BY p_name),
link AS (
    SELECT p_name AS national_name, p_type AS local_name FROM part WHERE p_size <= 5
    QUALIFY row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) = 1
)
SELECT coalesce(link.local_name, national.national_name) AS category, CAST(sum(n) AS BIGINT) AS n
FROM national LEFT JOIN link ON national.national_name = link.national_name GROUP BY 1"""

_NATION_COLUMNS = ", ".join(f"sum(n) FILTER (region = '{r}') AS {r}_n" for r in REGIONS)
_SPARSE = f"""WITH {_CASES},
cells AS (
    SELECT region, category, CASE WHEN NOT (region = '{REGIONS[1]}' AND category IS NOT DISTINCT FROM '2-HIGH') THEN count(*) END AS n
    FROM events GROUP BY region, category
),
wide AS (SELECT category, {_NATION_COLUMNS} FROM cells GROUP BY category)"""


def _sparse_total(total: str) -> str:
    plain = ", ".join(f"CAST({r}_n AS BIGINT) AS {r}_n" for r in REGIONS)
    totals = ", ".join(f"CAST({total.format(c=f'{r}_n')} AS BIGINT)" for r in REGIONS)
    return f"{_SPARSE} SELECT category, FALSE AS is_total, {plain} FROM wide UNION ALL SELECT NULL, TRUE, {totals} FROM wide"


_TENS = "c_acctbal / 1000"

ORACLE: dict[str, str] = {
    "monthly_counts": f"""WITH {_CASES}
SELECT CAST(year(event_date) AS INTEGER) AS year, CAST(month(event_date) AS INTEGER) AS month, region, category,
       count(*) AS n FROM events GROUP BY ALL""",
    "null_safe_exclusion": f"""WITH {_CASES}
SELECT region, category, count(*) AS n FROM events
WHERE category IS NULL OR category NOT IN ('1-URGENT', '5-LOW') GROUP BY ALL""",
    "admission_filter": f"""WITH {_ALL_CASES},
prepared AS (SELECT category, c_mktsegment, nullif(status, 'P') AS status, o_totalprice FROM all_cases)
SELECT category, status, count(*) AS n FROM prepared
WHERE c_mktsegment IN ('AUTOMOBILE', 'BUILDING', 'MACHINERY') AND NOT o_totalprice < 20000
  AND (coalesce(status = 'F', FALSE)
       OR (coalesce(category = '1-URGENT', FALSE) AND NOT coalesce(status = 'O', FALSE)))
GROUP BY ALL""",
    "classify_rules": f"""WITH {_ALL_CASES},
merged AS (SELECT *, CASE category WHEN '5-LOW' THEN '3-MEDIUM' ELSE category END AS merged FROM all_cases)
SELECT category, CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'works' WHEN status = 'P' THEN 'pending'
       WHEN merged IN ('1-URGENT', '2-HIGH') THEN 'fast' ELSE merged END AS classified, count(*) AS n
FROM merged GROUP BY ALL""",
    "spelling": """
SELECT p_name, regexp_replace(p_name, 'widg.t', 'gadget', 'g') AS unified,
       regexp_replace(p_name, '^[aeiouAEIOU]?[a-zA-Z]', '*') AS without_head, count(*) AS n FROM part GROUP BY ALL""",
    "id_prefix_region": f"""WITH {_PLACES},
prefixed AS (SELECT split_part(n_name || '/' || c_custkey, '/', 1) AS prefix FROM customer_regions)
SELECT prefix, CASE prefix WHEN 'NATION_3' THEN 'N3' WHEN 'NATION_8' THEN 'N8' ELSE prefix END AS region_kept,
       CASE prefix WHEN 'NATION_3' THEN 'N3' WHEN 'NATION_13' THEN 'N13' END AS region_known, count(*) AS n
FROM prefixed GROUP BY ALL""",
    "parse_dates": f"""WITH {_DATE_FORMS}
SELECT form, CASE WHEN form NOT IN (5, 7, 15) THEN date END AS event_date,
       CASE WHEN form IN (1, 7) THEN date END AS leading_date, count(*) AS n
FROM written GROUP BY ALL""",
    "report_window": f"""WITH {_CASES}
SELECT CAST(year(event_date) AS INTEGER) AS year, CAST(quarter(event_date) AS INTEGER) AS quarter, region, count(*) AS n
FROM events
WHERE year(event_date) < (SELECT max(year(event_date)) FROM events)
   OR (year(event_date) = (SELECT max(year(event_date)) FROM events) AND month(event_date) < 7)
GROUP BY ALL""",
    "dense_calendar": f"WITH {_CASES},{_counts('category')},{_template('category')} SELECT * FROM template",
    "dense_counts": f"WITH {_CASES},{_dense('category')} SELECT * FROM dense",
    "domain_dense_counts": f"""WITH {_CASES},{_dense('category', '''
    SELECT DISTINCT c_mktsegment AS category FROM customer
    UNION SELECT DISTINCT CASE WHEN o_orderpriority < '3' THEN o_orderpriority ELSE 'not ' || o_orderpriority END FROM orders ''')} SELECT * FROM dense""",
    "pair_dense_counts": f"WITH {_SITUATIONS},{_dense('scenario, agent')} SELECT * FROM dense",
    "region_rollup": f"""WITH {_ENQUIRIES},{_dense('topic')}
SELECT CASE WHEN grouping(region) = 1 THEN 'ALL_REGIONS' ELSE region END AS region, month_start, topic,
       CAST(sum(n) AS BIGINT) AS n
FROM dense GROUP BY GROUPING SETS ((region, month_start, topic), (month_start, topic))""",
    "incidence_monthly": f"WITH {_CASE_MONTHLY} SELECT * FROM monthly",
    "topic_incidence_monthly": f"WITH {_TOPIC_MONTHLY} SELECT * FROM monthly",
    "period_incidence": f"""WITH {_TOPIC_MONTHLY}
SELECT region, year, {_period(2)} AS period, topic, {_SUMMED} FROM monthly GROUP BY region, year, period, topic""",
    "period_incidence_year": f"""WITH {_CASES},{_monthly('category', report=5)}
SELECT region, year, {_period(5)} AS period, category, {_SUMMED} FROM monthly GROUP BY region, year, period, category""",
    "scenario_monthly": f"""WITH {_PAIR_MONTHLY}
SELECT region, year, month_start, scenario, {_SUMMED} FROM monthly
WHERE agent IS NULL OR agent NOT IN ('O') GROUP BY region, year, month_start, scenario""",
    "population_wide": f"WITH {_PLACES},{_POPULATION} {_population_pivot('population')}",
    "population_long": f"""WITH {_PLACES},{_POPULATION},
wide AS ({_population_pivot('population')})
SELECT region, CAST(name AS INTEGER) AS pop_year, population, CAST(name AS INTEGER) + 1 AS year
FROM (UNPIVOT wide ON COLUMNS(* EXCLUDE region) INTO NAME name VALUE population)""",
    "population_per_year_boundaries": f"""WITH {_MUNICIPAL},
cells AS (
    SELECT w.region, o.pop_year, o.population FROM observations o
    JOIN wanted w ON w.municipality = o.municipality AND w.boundary_year = o.pop_year
),
regional AS (
    SELECT region, pop_year, CASE WHEN count(*) = count(population) THEN sum(population) END AS population
    FROM cells GROUP BY region, pop_year
),
stacked AS (
    SELECT * FROM regional
    UNION ALL
    SELECT 'ALL_REGIONS', pop_year, CASE WHEN count(*) = count(population) THEN sum(population) END
    FROM regional GROUP BY pop_year
    UNION ALL
    SELECT 'NATIONAL', pop_year, population FROM nation_rows WHERE pop_year IN (SELECT pop_year FROM regional)
)
SELECT region, pop_year, CAST(population AS BIGINT) AS population, pop_year + 1 AS year FROM stacked""",
    "population_fixed_boundaries": f"""WITH {_MUNICIPAL},
cells AS (
    SELECT w.region, o.pop_year, o.population FROM observations o
    JOIN wanted w ON w.municipality = o.municipality AND w.boundary_year = 2001
),
regional AS (
    SELECT region, pop_year, CAST(coalesce(sum(population), 0) AS BIGINT) AS population FROM cells GROUP BY ALL
),
stacked AS (
    SELECT * FROM regional
    UNION ALL SELECT 'ALL_REGIONS', pop_year, CAST(sum(population) AS BIGINT) FROM regional GROUP BY pop_year
    UNION ALL SELECT 'NATIONAL', pop_year, population FROM nation_rows
)
{_population_pivot('stacked')}""",
    "dimension_labels": """
SELECT 'N' || (s_nationkey + 5) AS place, n_name AS place_label, count(*) AS n
FROM supplier LEFT JOIN nation ON n_nationkey = s_nationkey + 5 GROUP BY ALL""",
    "name_harmonise": _HARMONISE,
    "disease_table_quarter": _period_table(
        f"{_DISEASE_CASES},{_monthly('category', _DISEASES)}", "category", 2, disease=True
    ),
    "disease_table_year": _period_table(
        f"{_DISEASE_CASES},{_monthly('category', _DISEASES, 5)}", "category", 5, disease=True
    ),
    "scenario_table": _period_table(_PAIR_MONTHLY, "scenario", 2, disease=False),
    "setting_table": _period_table(f"{_SITUATIONS},{_monthly('setting')}", "setting", 2, disease=False),
    "setting_table_year": _period_table(
        f"{_SITUATIONS},{_monthly('setting', report=5)}", "setting", 5, disease=False
    ),
    "total_row_propagating": _sparse_total("CASE WHEN count(*) = count({c}) THEN sum({c}) END"),
    "total_row_skipping": _sparse_total("coalesce(sum({c}), 0)"),
    "rounding_masking": f"""
SELECT c_custkey, {_round(_TENS, 10.0)} AS one_digit, {_round(_TENS)} AS whole, nullif({_round(_TENS)}, 0) AS masked
FROM customer""",
    "top5_topics_long": f"WITH {_TOP5} SELECT region, period, topic, n, rank FROM ranked",
    "top5_topics_wide": f"WITH {_TOP5} SELECT rank, "
    + ", ".join(
        f"max(topic) FILTER (region = '{r}') AS {r}_topic, max(n) FILTER (region = '{r}') AS {r}_n" for r in REGIONS
    )
    + " FROM ranked GROUP BY rank",
    "series_total": _series(_CASE_MONTHLY, "TRUE"),
    "series_excluding": _series(_CASE_MONTHLY, "category IS NULL OR category NOT IN ('5-LOW')"),
    "series_multi": _series(_TOPIC_MONTHLY, "topic IN ('Brand#3', 'Brand#7')"),
    "series_breakdown": _series(_PAIR_MONTHLY, "scenario = 'R' AND agent = 'O'"),
    "series_years": _series(_CASE_MONTHLY, "category = '1-URGENT' AND year IN (2000, 2001)"),
    "display_names": f"""WITH {_CASE_MONTHLY}
SELECT CASE WHEN region = 'ALL_REGIONS' THEN 'Europe as a whole' ELSE region END AS region, CAST(sum(n) AS BIGINT) AS n
FROM monthly GROUP BY 1""",
    "quality_flags": _all_flags(),
    "value_presence": f"""WITH {_CASES}
SELECT v.series, v.value,
       EXISTS (SELECT 1 FROM events WHERE category = v.value AND (v.year IS NULL OR year(event_date) = v.year)) AS occurs
FROM (VALUES ('both', '1-URGENT', NULL), ('both', '9-NONE', NULL), ('left_out', '5-LOW', NULL), ('left_out', '0-NONE', NULL),
             ('too_late', '2-HIGH', 2090)) v(series, value, year)""",
}


# The charts of the catalogue, on categories that are given their names.

_CATALOGUE_NAMES = {
    "diseases": ("category", "'1-URGENT' THEN 'Kinkhoest (Pertussis)' WHEN '2-HIGH' THEN 'Scabies' WHEN '3-MEDIUM' THEN 'Legionellose'"),
    "topics": ("topic", "'Brand#1' THEN 'Scabies (Schurft)' WHEN 'Brand#2' THEN 'Buiktyfus' WHEN 'Brand#3' THEN 'Anders'"),
}


def _catalogue() -> str:
    charts = []
    for spec in QUARTERLY:
        if spec.source not in _CATALOGUE_NAMES:
            continue
        by, names = _CATALOGUE_NAMES[spec.source]
        name = f"CASE {by} WHEN {names} ELSE {by} END"
        listed = lambda values: ", ".join(f"'{v}'" for v in values)
        where = "TRUE"
        if spec.include is not None:
            where += f" AND {name} IN ({listed(spec.include)})"
        if spec.exclude:
            where += f" AND coalesce({name} NOT IN ({listed(spec.exclude)}), TRUE)"
        if spec.years is not None:
            where += f" AND year IN ({', '.join(map(str, spec.years))})"
        head = _CASE_MONTHLY if spec.source == "diseases" else _TOPIC_MONTHLY
        charts.append(f"SELECT '{spec.name}' AS chart, c.* FROM ({_series(head, where)}) c")
    return " UNION ALL ".join(charts)


ORACLE["series_catalogue"] = _catalogue()


# Raw exports, cleaned by rules that are written out here.


def _pick(key: str, values: list[str | None]) -> str:
    listed = ", ".join("NULL" if v is None else "'" + v.replace("'", "''").replace("\n", "' || chr(10) || '") + "'" for v in values)
    return f"([{listed}])[CAST(({key}) % {len(values)} AS INTEGER) + 1]"


def _region(prefix: str) -> str:
    return f"CASE {prefix} WHEN 'WBT' THEN 'WB' WHEN 'HVB' THEN 'HvB' WHEN 'ZEE' THEN 'Zee' WHEN 'NLG' THEN 'LN' WHEN 'ZLG' THEN 'ZL' ELSE {prefix} END"


_RAW_CASES = f"""
raw AS (
    SELECT {_pick("o_custkey", p.PREFIXES)} AS prefix, CAST(o_orderdate AS DATE) AS event_date,
           CASE o_orderpriority WHEN '1-URGENT' THEN 'Hepatitis B' WHEN '2-HIGH' THEN 'Kinkhoest (Pertussis)'
                WHEN '4-NOT SPECIFIED' THEN 'COVID-19' WHEN '5-LOW' THEN 'Legionellose' END AS disease,
           {_pick("o_orderkey", p.DIAGNOSES)} AS diagnosis,
           o_orderkey % 11 = 0 AS cpe, o_orderkey % 13 = 0 AS dengue,
           {_pick("o_orderkey // 8", p.CONFIDENCES)} AS confidence, o_totalprice < 20000 AS deleted,
           {_pick("o_custkey + o_orderkey", p.STATUSES)} AS status, CAST(o_totalprice AS DECIMAL(18, 2)) AS amount
    FROM orders
)"""

ORACLE["cleaned_cases"] = f"""WITH {_RAW_CASES},
classified AS (
    SELECT *, CASE WHEN diagnosis = '{p.DIAGNOSES[0]}' THEN 'Scabies' WHEN diagnosis = 'Acute hepatitis B' THEN 'Hepatitis B, acuut'
                   WHEN diagnosis = 'Monkeypox' THEN 'Monkeypox' WHEN cpe THEN 'CPE' WHEN dengue THEN 'Dengue Fever'
                   WHEN disease = 'Hepatitis B' THEN 'Hepatitis B, niet gespecificeerd' ELSE disease END AS category
    FROM raw WHERE disease IS DISTINCT FROM 'COVID-19'
)
SELECT {_region("prefix")} AS region, CAST(date_trunc('month', event_date) AS DATE) AS month_start, category, count(*) AS n
FROM classified
WHERE category IS NOT NULL AND NOT deleted AND confidence IN ('Confirmed', 'Possible', 'Probable')
  AND (coalesce(status IN ('Definitief', 'Gefiatteerd'), FALSE) OR (category = 'Scabies' AND status IS DISTINCT FROM 'Gewist'))
GROUP BY ALL"""

ORACLE["cleaned_situations"] = f"""
SELECT {_region(_pick("l_suppkey", p.PREFIXES))} AS region, CAST(date_trunc('month', l_shipdate) AS DATE) AS month_start,
       CASE l_returnflag WHEN 'A' THEN '(leeg)' ELSE l_returnflag END AS scenario, nullif(l_linestatus, 'F') AS agent,
       CASE l_linenumber WHEN 7 THEN '(leeg)' ELSE CAST(l_linenumber AS VARCHAR) END AS setting, count(*) AS n
FROM lineitem WHERE l_discount > 0.05 GROUP BY ALL"""

ORACLE["cleaned_enquiries"] = f"""
WITH raw AS (
    SELECT {_pick("l_suppkey", ["BZO", "HvB", "WB", "Zee", "LN", "ZL", None])} AS region, {_pick("l_partkey", p.TOPICS)} AS topic, l_shipdate
    FROM lineitem WHERE l_returnflag <> 'A' AND l_linenumber < 7
)
SELECT region, CAST(date_trunc('month', l_shipdate) AS DATE) AS month_start, topic, count(*) AS n
FROM raw WHERE topic IS DISTINCT FROM 'COVID-19' GROUP BY ALL"""

ORACLE["csv_cases"] = f"""WITH {_RAW_CASES}
SELECT disease, diagnosis AS summary_diagnosis, confidence, status, count(*) AS n, CAST(sum(amount * 100) AS BIGINT) AS cents,
       CAST(sum(floor(amount)) AS BIGINT) AS wholes
FROM raw GROUP BY ALL"""

ORACLE["incremental_counts"] = f"SELECT *, '4,0,1,1' AS counted, '0,0,0,1' AS dropped FROM ({ORACLE['cleaned_cases']})"

ORACLE["csv_rejects"] = """
WITH written AS (
    SELECT CASE WHEN c_custkey % 7 = 0 THEN 'not a number' WHEN c_custkey % 11 = 0 OR c_custkey % 13 = 0 THEN 'missing' ELSE 'kept' END AS balance,
           CASE WHEN c_custkey % 5 = 0 THEN CASE WHEN CAST(c_acctbal AS DECIMAL(18, 2)) = floor(CAST(c_acctbal AS DECIMAL(18, 2))) THEN 'kept' ELSE 'not whole' END
                WHEN c_custkey % 17 = 0 THEN 'too large' ELSE 'kept' END AS key
    FROM customer
)
SELECT 'balance' AS "column", balance AS reason, count(*) AS n FROM written WHERE balance <> 'missing' GROUP BY ALL
UNION ALL SELECT 'key', key, count(*) FROM written GROUP BY ALL"""

ORACLE["csv_situations"] = ORACLE["cleaned_situations"]

ORACLE["population_refresh"] = f"""WITH {_MUNICIPAL},
cells AS (
    SELECT CASE w.region WHEN 'EU' THEN 'Zee' ELSE 'WB' END AS region, o.pop_year, o.population FROM observations o
    JOIN wanted w ON w.municipality = o.municipality AND w.boundary_year = {max(p.AREA_YEARS)}
    WHERE o.pop_year BETWEEN {min(p.AREA_YEARS)} AND {max(p.AREA_YEARS)}
),
regional AS (SELECT region, pop_year, coalesce(sum(population), 0) AS population FROM cells GROUP BY ALL),
stacked AS (
    SELECT * FROM regional
    UNION ALL SELECT 'ALL_REGIONS', pop_year, sum(population) FROM regional GROUP BY pop_year
    UNION ALL SELECT 'NATIONAL', pop_year, population FROM nation_rows
    WHERE pop_year BETWEEN {min(p.AREA_YEARS)} AND {max(p.AREA_YEARS)}
)
SELECT region, CAST(pop_year AS INTEGER) AS pop_year, CAST(population AS BIGINT) AS population, CAST(pop_year + 1 AS INTEGER) AS year
FROM stacked"""


ORACLE["population_upkeep"] = f"""WITH {_MUNICIPAL},
cells AS (
    SELECT CASE w.region WHEN 'EU' THEN 'Zee' ELSE 'WB' END AS region, o.pop_year, o.population FROM observations o
    JOIN wanted w ON w.municipality = o.municipality AND w.boundary_year = o.pop_year
),
regional AS (
    SELECT region, pop_year, CASE WHEN count(*) = count(population) THEN sum(population) END AS population FROM cells GROUP BY ALL
),
stacked AS (
    SELECT * FROM regional
    UNION ALL SELECT 'ALL_REGIONS', pop_year, CASE WHEN count(*) = count(population) THEN sum(population) END FROM regional GROUP BY pop_year
    UNION ALL SELECT 'NATIONAL', pop_year, population FROM nation_rows WHERE pop_year IN (SELECT pop_year FROM regional)
)
SELECT region, CAST(pop_year AS INTEGER) AS pop_year, CAST(population AS BIGINT) AS population,
       '{len(p.AREA_YEARS) - 1},1,0' AS made, 2::INTEGER AS version
FROM stacked"""

ORACLE["export_order"] = f"""WITH {_ALL_CASES},
report_year AS (SELECT max(year(event_date)) - 1 AS y FROM all_cases WHERE world_region = 'EUROPE')
SELECT dataset, place::INTEGER AS place, 'Region ' || y || quarter AS comparison
FROM (VALUES ('enquiries', 1), ('cases', 2), ('situations', 3)) d(dataset, place), (VALUES (' Q2'), ('')) q(quarter), report_year"""
