"""Explicit table schemas (schema inference is never used).

Fixed values: the column names, their order and their types below must equal
the source system's landing schemas for the JSON readers to bind correctly.
Every column is nullable.
"""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()
L = T.LongType()
D = T.DoubleType()
B = T.BooleanType()
TS = T.TimestampType()
DT = T.DateType()


def struct(fields: list[tuple[str, T.DataType]]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# --- fixed values: historical day envelope (one JSON document per day-file) ---
HIST_RECORD_FIELDS = [
    ("latitude", D),
    ("longitude", D),
    ("code_qualification", L),
    ("libelle_statut", S),
    ("grandeur_hydro_elab", S),
    ("code_site", S),
    ("libelle_qualification", S),
    ("code_statut", L),
    ("libelle_methode", S),
    ("code_station", S),
    ("date_prod", TS),
    ("code_methode", L),
    ("resultat_obs_elab", D),
    ("date_obs_elab", DT),
]
HIST_RECORD = struct(HIST_RECORD_FIELDS)

HIST_RAW = struct([
    ("api_version", S),
    ("next", S),
    ("data", T.ArrayType(HIST_RECORD, True)),
    ("prev", S),
    ("first", S),
    ("count", L),
    ("json_file", S),
])

# Flattened history: the record's fields without date_prod, then prev, json_file.
HIST_FLAT_COLUMNS = [n for n, _ in HIST_RECORD_FIELDS if n != "date_prod"] + ["prev", "json_file"]
HIST_FLAT = struct([(n, t) for n, t in HIST_RECORD_FIELDS if n != "date_prod"]
                   + [("prev", S), ("json_file", S)])

QUANTILE_COLUMNS = ["quantile_999", "quantile_990", "quantile_900",
                    "quantile_100", "quantile_010", "quantile_001"]
# Fractions of the six quantiles, in the order of QUANTILE_COLUMNS (n / 1000).
QUANTILE_FRACTIONS = [0.999, 0.990, 0.900, 0.100, 0.010, 0.001]

HIST_AGG = struct([("code_station", S), ("latitude", D), ("longitude", D),
                   ("grandeur_hydro_elab", S)]
                  + [(q, D) for q in QUANTILE_COLUMNS]
                  + [("minimum_date_window", DT), ("maximum_date_window", DT)])

# --- fixed values: live observation record (NDJSON, one object per line) ---
LIVE_FIELDS = [
    ("code_site", S),
    ("code_station", S),
    ("grandeur_hydro", S),
    ("date_debut_serie", TS),
    ("date_fin_serie", TS),
    ("statut_serie", L),
    ("code_systeme_alti_serie", L),
    ("date_obs", TS),
    ("resultat_obs", D),
    ("code_methode_obs", L),
    ("libelle_methode_obs", S),
    ("code_qualification_obs", L),
    ("libelle_qualification_obs", S),
    ("continuite_obs_hydro", B),
    ("longitude", D),
    ("latitude", D),
]
LIVE_RECORD = struct(LIVE_FIELDS)
LIVE_RAW = struct(LIVE_FIELDS + [("ingestion_timestamp", TS)])
# The de-duplication key: every landed column except the ingestion stamp.
LIVE_DEDUP_COLUMNS = [n for n, _ in LIVE_FIELDS]

# One page of the live API: records under ``data``, link to the next page.
LIVE_PAGE = struct([("count", L), ("next", S), ("data", T.ArrayType(LIVE_RECORD, True))])

INDICATOR_COLUMNS = ["flood_indicateur", "longitude", "latitude", "date_obs", "resultat_obs",
                     "code_station"] + QUANTILE_COLUMNS

# --- fixed values: station dimension ---
GEOMETRY = struct([
    ("type", S),
    ("crs", struct([("type", S), ("properties", struct([("name", S)]))])),
    ("coordinates", T.ArrayType(D, True)),
])

STATION_FIELDS = [
    ("code_site", S),
    ("libelle_site", S),
    ("code_station", S),
    ("libelle_station", S),
    ("type_station", S),
    ("coordonnee_x_station", D),
    ("coordonnee_y_station", D),
    ("code_projection", L),
    ("longitude_station", D),
    ("latitude_station", D),
    ("influence_locale_station", D),
    ("commentaire_station", S),
    ("altitude_ref_alti_station", D),
    ("code_systeme_alti_site", D),
    ("code_commune_station", S),
    ("libelle_commune", S),
    ("code_departement", S),
    ("code_region", S),
    ("libelle_region", S),
    ("code_cours_eau", S),
    ("libelle_cours_eau", S),
    ("uri_cours_eau", S),
    ("descriptif_station", S),
    ("date_maj_station", S),
    ("date_ouverture_station", S),
    ("date_fermeture_station", S),
    ("commentaire_influence_locale_station", S),
    ("code_regime_station", L),
    ("qualification_donnees_station", L),
    ("code_finalite_station", D),
    ("type_contexte_loi_stat_station", D),
    ("type_loi_station", D),
    ("code_sandre_reseau_station", T.ArrayType(S, True)),
    ("date_debut_ref_alti_station", S),
    ("date_activation_ref_alti_station", S),
    ("date_maj_ref_alti_station", S),
    ("libelle_departement", S),
    ("en_service", B),
    ("geometry", GEOMETRY),
]
STATION = struct(STATION_FIELDS)
# The station API answers with the list under ``data``.
STATION_RESPONSE = struct([("count", L), ("data", T.ArrayType(STATION, True))])


def with_ntz(schema: T.StructType) -> T.StructType:
    """Same schema with TIMESTAMP replaced by TIMESTAMP_NTZ (top level only).

    The driver's test tables hold wall-clock ``timestamp_ntz`` values; batch
    queries over them keep that type so they compare with DuckDB TIMESTAMP.
    """
    return T.StructType([
        T.StructField(f.name, T.TimestampNTZType() if isinstance(f.dataType, T.TimestampType)
                      else f.dataType, f.nullable)
        for f in schema.fields
    ])
