"""Schemas, product presets and the small fixed dimension tables.

The dictionaries below are fixed reference values (administrative codes and
names); they are data, not logic, and each becomes a small DataFrame that is
broadcast (its size is fixed by this file).
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# FIXED VALUES: product preset, display labels, administrative codes & names.
# ---------------------------------------------------------------------------

# Canonical product columns of the wide table (after name normalisation).
PRODUCTS = ("gazole", "sp95", "sp98", "e10", "e85", "gplc")

# Products that get a dedicated competitiveness flag column.
FLAGGED_PRODUCTS = ("gazole", "sp95")

# Display label of each product in long (unpivoted) tables.
PRODUCT_LABELS = {
    "gazole": "Gazole",
    "sp95": "SP95",
    "sp98": "SP98",
    "e10": "E10",
    "e85": "E85",
    "gplc": "GPLc",
}

# Region code -> region name; "99" collects everything unmapped.
REGION_NAMES = {
    "11": "Île-de-France",
    "24": "Centre-Val de Loire",
    "27": "Bourgogne-Franche-Comté",
    "28": "Normandie",
    "32": "Hauts-de-France",
    "44": "Grand Est",
    "52": "Pays de la Loire",
    "53": "Bretagne",
    "75": "Nouvelle-Aquitaine",
    "76": "Occitanie",
    "84": "Auvergne-Rhône-Alpes",
    "93": "Provence-Alpes-Côte d'Azur",
    "94": "Corse",
    "99": "Autres",
}
OTHER_REGION = "99"
UNKNOWN_REGION_NAME = "Inconnu"

# Department code -> department name (the 24 named departments).
DEPARTMENT_NAMES = {
    "75": "Paris", "13": "Bouches-du-Rhône", "69": "Rhône",
    "33": "Gironde", "59": "Nord", "31": "Haute-Garonne",
    "44": "Loire-Atlantique", "67": "Bas-Rhin", "06": "Alpes-Maritimes",
    "34": "Hérault", "83": "Var", "38": "Isère",
    "92": "Hauts-de-Seine", "93": "Seine-Saint-Denis", "94": "Val-de-Marne",
    "78": "Yvelines", "91": "Essonne", "95": "Val-d'Oise",
    "77": "Seine-et-Marne", "29": "Finistère", "35": "Ille-et-Vilaine",
    "56": "Morbihan", "22": "Côtes-d'Armor", "57": "Moselle",
}

# Department code -> region code, all 96 metropolitan departments.
DEPARTMENT_REGION = {
    "01": "84", "02": "32", "03": "84", "04": "93", "05": "93", "06": "93",
    "07": "84", "08": "44", "09": "76", "10": "44", "11": "76", "12": "76",
    "13": "93", "14": "28", "15": "84", "16": "75", "17": "75", "18": "24",
    "19": "75", "21": "27", "22": "53", "23": "75", "24": "75", "25": "27",
    "26": "84", "27": "28", "28": "24", "29": "53", "2A": "94", "2B": "94",
    "30": "76", "31": "76", "32": "76", "33": "75", "34": "76", "35": "53",
    "36": "24", "37": "24", "38": "84", "39": "27", "40": "75", "41": "24",
    "42": "84", "43": "84", "44": "52", "45": "24", "46": "76", "47": "75",
    "48": "76", "49": "52", "50": "28", "51": "44", "52": "44", "53": "52",
    "54": "44", "55": "44", "56": "53", "57": "44", "58": "27", "59": "32",
    "60": "32", "61": "28", "62": "32", "63": "84", "64": "75", "65": "76",
    "66": "76", "67": "44", "68": "44", "69": "84", "70": "27", "71": "27",
    "72": "52", "73": "84", "74": "84", "75": "11", "76": "28", "77": "11",
    "78": "11", "79": "75", "80": "32", "81": "76", "82": "76", "83": "93",
    "84": "93", "85": "52", "86": "75", "87": "75", "88": "44", "89": "27",
    "90": "27", "91": "11", "92": "11", "93": "11", "94": "11", "95": "11",
}

# Corsican postal codes start with "20"; their first three digits give the
# department (public postal geography).
CORSICA_POSTAL_PREFIX = {"200": "2A", "201": "2A", "202": "2B", "206": "2B"}

# Landing-file naming: one snapshot per day (a metadata sidecar beside it does
# not match).
SNAPSHOT_STEM = "*_[0-9][0-9][0-9][0-9]-[0-9][0-9]-[0-9][0-9]"
SNAPSHOT_GLOB = SNAPSHOT_STEM + ".json"

# Pivot: columns that carry the observation itself, never a grouping key.
# (the parsed time, the source file and the corrupt text come with a scan)
CORRUPT = "_corrupt_record"
OBSERVATION_COLUMNS = ("prix_nom", "prix_valeur", "prix_maj", "prix_maj_ts", "prix_id",
                       "ingestion_timestamp", "source_file", CORRUPT)

# ---------------------------------------------------------------------------
# Schemas
# ---------------------------------------------------------------------------

GEOM = T.StructType([
    T.StructField("lat", T.DoubleType()),
    T.StructField("lon", T.DoubleType()),
])

# Raw landed record (one per entity x product x update).  Prices and
# timestamps are read as strings and parsed with try_cast in the clean step,
# so malformed values become NULL instead of failing the job.
RAW_OBSERVATION = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("cp", T.StringType()),
    T.StructField("ville", T.StringType()),
    T.StructField("adresse", T.StringType()),
    T.StructField("geom", GEOM),
    T.StructField("prix_nom", T.StringType()),
    T.StructField("prix_valeur", T.StringType()),
    T.StructField("prix_maj", T.StringType()),
    T.StructField("prix_id", T.StringType()),
    T.StructField("ingestion_timestamp", T.StringType()),
    T.StructField("dep_code", T.StringType()),
    T.StructField("reg_code", T.StringType()),
])

def mean_col(product: str) -> str:
    """Name of a product's mean column in the marts."""
    return f"{product}_moyen"
