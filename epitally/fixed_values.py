"""Fixed values of the surveillance domain.

The lists below have to be spelled exactly like the values in the input
tables, otherwise the results differ. They are configuration: every operator
takes them as arguments.
"""

from __future__ import annotations

# Regions.
REGIONS = ("BZO", "HvB", "LN", "WB", "Zee", "ZL")

# Identifier prefix -> region. Other prefixes stay as they are.
REGION_BY_PREFIX = {
    "WBT": "WB",
    "HVB": "HvB",
    "ZEE": "Zee",
    "NLG": "LN",
    "ZLG": "ZL",
}

# Region name in enquiries -> region. Other names become NULL.
REGION_BY_ENQUIRY_NAME = {
    "Brabant-Zuidoost": "BZO",
    "Hart voor Brabant": "HvB",
    "West-Brabant": "WB",
    "Zeeland": "Zee",
    "Noord Limburg": "LN",
    "Zuid Limburg": "ZL",
}

# Region name in population statistics -> region.
REGION_BY_STATISTICS_NAME = {
    "GGD Brabant-Zuidoost": "BZO",
    "GGD Hart voor Brabant": "HvB",
    "GGD Limburg-Noord": "LN",
    "GGD West-Brabant": "WB",
    "GGD Zeeland": "Zee",
    "GGD Zuid-Limburg": "ZL",
}

# Row labels of the supra-region and the nation in the wide population input.
POPULATION_ROW_LABELS = {"Regio": "ALL_REGIONS", "Nederland": "NATIONAL"}
NATION_CODE = "NL01"

# Diseases left out when reading cases.
EXCLUDED_DISEASES = ("COVID-19", "Coronavirus", "Wuhan Novel Coronavirus")

# Disease spellings that are merged.
DISEASE_RECODES = {
    "Invasieve pneumokokkenziekte  (bij kinderen)": "Invasieve pneumokokkenziekte",
    "Hepatitis B": "Hepatitis B, niet gespecificeerd",
    "Hepatitis C": "Hepatitis C, niet gespecificeerd",
    "Humane infectie met aviair Influenzavirus B": "Humane infectie met dierlijk influenzavirus",
    "Nieuwe Influenza A (H1N1)": "Humane infectie met dierlijk influenzavirus",
}

# Spelling of a diagnosis with a garbled diacritic.
DIAGNOSIS_PATTERN = "Scabi.s"
DIAGNOSIS_HEAD = "Scabi"
DIAGNOSIS_REPLACEMENT = "Scabies"

# Fixed values: (column, values, disease); the first match decides.
DISEASE_RULES = (
    ("summary_diagnosis", ("Scabies", "ScabiC+s crustosa", "ScabiC+s, unspecified"), "Scabies"),
    ("summary_diagnosis", ("Acute hepatitis B",), "Hepatitis B, acuut"),
    ("summary_diagnosis", ("Chronic hepatitis B",), "Hepatitis B, chronisch"),
    ("summary_diagnosis", ("Chronic hepatitis B (with D)",), "Hepatitis B, chronisch"),
    ("summary_diagnosis", ("Hepatitis B, unspecified",), "Hepatitis B, niet gespecificeerd"),
    ("summary_diagnosis", ("Acute hepatitis C",), "Hepatitis C, acuut"),
    ("summary_diagnosis", ("Chronic hepatitis C",), "Hepatitis C, chronisch"),
    ("summary_diagnosis", ("Hepatitis C, unspecified",), "Hepatitis C, niet gespecificeerd"),
    ("summary_diagnosis", ("Monkeypox",), "Monkeypox"),
    ("abr", ("CPE",), "CPE"),
    ("infection", ("Chikungunya",), "Chikungunya"),
    ("infection", ("Dengue Fever",), "Dengue Fever"),
)

# Admission of cases.
ADMITTED_CONFIDENCE = ("Confirmed", "Possible", "Probable")
ADMITTED_STATUS = ("Definitief", "Gefiatteerd")
BLOCKED_STATUS = ("Gewist", "Overgedragen")
STATUS_EXEMPT_DISEASES = ("Rabies (Hondsdolheid)", "Virale hemorragische koorts", "Scabies")

# Diseases left out of the period table and its total.
DISEASES_OUTSIDE_TABLE = ("Scabies", "Rabies (Hondsdolheid)", "Tuberculose")

# Situations.
ARTICLE_26_VALUE = "Yes"
EMPTY_LABEL = "(leeg)"
AGENTS_OUTSIDE_CHARTS = ("Coronavirus", "COVID-19")

# Enquiries.
ENQUIRY_BROAD_TOPIC = "Infectieziekten"
EXCLUDED_TOPICS = ("COVID-19", "Wuhan Novel Coronavirus")
TOPIC_RELABELS = {"Besmettingsaccident/mensenbeet": "Besmettingsaccident / mensenbeet"}

# How the statistics dictionary names the region columns.
REGION_TOPIC_GROUP = "GGD-regio's"
CODE_TITLE = "Code"
NAME_TITLE = "Naam"
