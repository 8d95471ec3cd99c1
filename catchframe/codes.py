"""Fixed code lists: many raw labels to one short code.

The dictionaries are in the order of the ordered code lists; a raw label that is
not listed has no code (missing).
"""

# Country names of the official landings files.
COUNTRY_NAMES = {
    "Belgium": "BE",
    "Channel Is.- Guernsey": "GG",
    "Channel Is.- Jersey": "JE",
    "Channel Islands (ns)": "CI",
    "Denmark": "DK",
    "France": "FR",
    "Germany": "DE",
    "Germany  Fed. Rep. Of": "DE",
    "Germany, Fed. Rep. of": "DE",
    "Ireland": "IE",
    "Netherlands": "NL",
    "Norway": "NO",
    "Sweden": "SE",
    "UK (England)": "UK",
    "UK(Scotland)": "UK",
    "UK - Scotland": "UK",
    "UKS": "UK",
    "UKE": "UK",
    "UK - Eng+Wales+N.Irl.": "UK",
    "UK - England & Wales": "UK",
    "GB": "UK",
    "UK(Northern Ireland)": "UK",
}

# Country names of the detailed catch tables.
REPORT_COUNTRIES = {
    "Belgium": "BE",
    "Germany": "DE",
    "Denmark": "DK",
    "France": "FR",
    "Ireland": "IE",
    "Netherlands": "NL",
    "Norway": "NO",
    "Sweden": "SE",
    "UK": "UK",
    "Channel Is.- Guernsey": "GG",
    "Channel Is.- Jersey": "JE",
    "Isle of Man": "IM",
    "UK (England)": "UK",
    "UK(Scotland)": "UK",
    "UK(Northern Ireland)": "UK",
}

# Short codes of the official tables, islands counted with the UK.
ISLANDS_TO_UK = {
    "BE": "BE", "DE": "DE", "DK": "DK", "FR": "FR", "IE": "IE", "NL": "NL", "NO": "NO",
    "SE": "SE", "UK": "UK", "CI": "UK", "GG": "UK", "IM": "UK", "JE": "UK",
}

# Gear codes to gear groups.
GEAR_GROUPS = {
    "OTB": "Otter and Seine",
    "SDN": "Otter and Seine",
    "TBB": "Beam",
    "GNS": "Trammel/gillnets",
    "GTR": "Trammel/gillnets",
    "LLS": "Other",
    "MIS": "Other",
    "SSC": "Otter and Seine",
    "FPO": "Other",
    "DRB": "Other",
    "LHP": "Other",
    "OTM": "Other",
}

# Area codes of the data set to the three area groups.
AREA_GROUPS = {
    "27.3.a": "27.3.a", "27.3.a.21": "27.3.a", "27.3.a.20": "27.3.a", "27.3.a_NK": "27.3.a",
    "27.4": "27.4", "27.4.a": "27.4", "27.4.b": "27.4", "27.4.c": "27.4",
    "27.7.d": "27.7.de", "27.7.e": "27.7.de",
}

# The detailed catches know no area of unknown subdivision.
DETAILED_AREAS = {area: group for area, group in AREA_GROUPS.items() if not area.endswith("_NK")}

# Area names of the historical files.
DIVISIONS = {
    "III a": "27.3.a",
    "IV (not specified)": "27.4",
    "IV a": "27.4",
    "IV a+b (not specified)": "27.4",
    "IV b": "27.4",
    "IV c": "27.4",
    "VII d": "27.7.de",
    "VII e": "27.7.de",
    "VII d+e (not specified)": "27.7.de",
}

# Area codes of the preliminary landings files.
PRELIMINARY_AREAS = {
    "27_3_A": "27.3.a", "27_3_A_20": "27.3.a", "27_3_A_21": "27.3.a",
    "27_4_A": "27.4", "27_4_B": "27.4", "27_4_C": "27.4",
    "27_7_D": "27.7.de", "27_7_E": "27.7.de",
}

# Areas of the data set in years 2006-2021, and of the quota tables.
DATASET_AREAS = ("27.3.a", "27.4", "27.7.d", "27.7.e")
QUOTA_DIVISIONS = ("II a (not specified)", "II a2", "IV a", "IV a+b (not specified)", "IV b", "IV c")
QUOTA_DATASET_AREAS = ("27.2.a", "27.4")
QUOTA_PRELIMINARY_AREAS = ("27_2_A_2", "27_4_A", "27_4_B", "27_4_C")
COMBINED_QUOTA_AREAS = (
    "27_2_A_2", "27_4_A", "27_4_B", "27_4_C", "27_3_A_20", "27_3_A_21", "27_3_A", "27_7_E", "27_7_D",
)

# The two quota species under each file's naming.
SPECIES_RAW = {"brill": "Brill", "turbot": "Turbot"}
SPECIES_CODES = {"brill": "BLL", "turbot": "TUR"}
SPECIES_LATIN = {"brill": "Scophthalmus rhombus", "turbot": "Scophthalmus maximus"}

# Category labels, text codes without a weight, and units.
LOGBOOK = "Logbook Registered Discard"
BMS = "BMS landing"
DISCARDS = "Discards"
LANDINGS = "Landings"
IMPORTED = "Imported_Data"
CODE_TOKENS = ("-", ".", "<0.5")
NA_TOKEN = "0 c"
UNITS = "TLW"
