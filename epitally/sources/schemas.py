"""Columns that the operators use, by input table.

Each entry maps a header (after blanks became dots) to the column name used in
this library and its type. Inputs may have any number of further columns.
"""

from __future__ import annotations

from typing import NamedTuple


class InputColumn(NamedTuple):
    header: str
    name: str
    data_type: str = "string"


# Headers of the input tables.
CASES = (
    InputColumn("Case.Identifier", "case_identifier"),
    InputColumn("Time.entered", "time_entered"),
    InputColumn("Meldingsplichtige.ziekte", "disease"),
    InputColumn("Summary.Diagnosis", "summary_diagnosis"),
    InputColumn("ABR", "abr"),
    InputColumn("Infection", "infection"),
    InputColumn("Confidence", "confidence"),
    InputColumn("Datum.gewist", "date_deleted"),
    InputColumn("Status.van.de.melding", "status"),
)

SITUATIONS = (
    InputColumn("Name", "name"),
    InputColumn("Date.entered", "date_entered"),
    InputColumn("Artikel.26", "article_26"),
    InputColumn("Scenario", "scenario"),
    InputColumn("Principal.Contextual.Setting", "setting"),
    InputColumn("Infectious.Agent", "agent"),
)

ENQUIRIES = (
    InputColumn("Broad.Topic", "broad_topic"),
    InputColumn("Specific.Topic", "topic"),
    InputColumn("Received.on", "received_on"),
    InputColumn("GGD", "region_name"),
)

NATIONAL = (
    InputColumn("Ziekte.RIVM", "national_name"),
    InputColumn("Landelijke.aantallen.in.rapportageperiode", "n", "bigint"),
)

NAME_LINK = (
    InputColumn("Ziekte.RIVM", "national_name"),
    InputColumn("Meldingsplichtige.ziekte.HPZone", "local_name"),
)

MUNICIPAL_POPULATION = (
    InputColumn("RegioS", "municipality"),
    InputColumn("Perioden", "period_code"),
    InputColumn("BevolkingAanHetBeginVanDePeriode_1", "population", "bigint"),
)

# The header of the region column differs between boundary years, see ``resolve_region_columns``.
AREA_CODE_HEADER = "Code_1"
AREA_NAME_HEADER = "Naam_2"
