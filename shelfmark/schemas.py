"""Fixed table layouts."""

from __future__ import annotations

from pyspark.sql import types as T

LONG, TEXT, TEXTS = T.LongType(), T.StringType(), T.ArrayType(T.StringType())

# Column names and types of the refined table, in table order.
REFINED_SCHEMA = T.StructType([
    T.StructField("id", LONG),
    T.StructField("id_mal", LONG),
    T.StructField("title_romaji", TEXT),
    T.StructField("title_english", TEXT),
    T.StructField("title_native", TEXT),
    T.StructField("format", TEXT),
    T.StructField("status", TEXT),
    T.StructField("episodes", LONG),
    T.StructField("duration", LONG),
    T.StructField("season", TEXT),
    T.StructField("season_year", LONG),
    T.StructField("average_score", LONG),
    T.StructField("popularity", LONG),
    T.StructField("favourites", LONG),
    T.StructField("genres", TEXTS),
    T.StructField("studios", TEXTS),
    T.StructField("start_year", LONG),
    T.StructField("start_month", LONG),
    T.StructField("start_day", LONG),
    T.StructField("end_year", LONG),
    T.StructField("end_month", LONG),
    T.StructField("end_day", LONG),
    T.StructField("description", TEXT),
    T.StructField("ingestion_timestamp", TEXT),
    T.StructField("content_hash", TEXT),
])
REFINED_COLUMNS = REFINED_SCHEMA.fieldNames()

# The hash covers every business column: all but the arrival time and itself.
HASHED_COLUMNS = [c for c in REFINED_COLUMNS if c not in ("ingestion_timestamp", "content_hash")]

# One landed page, or one part of a large page. `records` keeps each record as its own JSON text;
# `first_position` is the place in the page of the first of them (absent: 0).
LANDING_SCHEMA = T.StructType([
    T.StructField("ingestion_timestamp", TEXT),
    T.StructField("source", TEXT),
    T.StructField("source_page", LONG),
    T.StructField("first_position", LONG),
    T.StructField("records", TEXTS),
])

LANDING_TABLE_SCHEMA = T.StructType([*LANDING_SCHEMA.fields, T.StructField("landing_run", TEXT)])

LEDGER_SCHEMA = T.StructType([
    T.StructField("page", LONG),
    T.StructField("reason", TEXT),
    T.StructField("recorded_at", TEXT),
])

QUARANTINE_SCHEMA = T.StructType([
    T.StructField("motivo_rechazo", TEXT),
    T.StructField("payload_original", TEXT),
    T.StructField("quarantined_at", TEXT),
    T.StructField("run_id", TEXT),
])

VECTOR_SCHEMA = T.StructType([
    T.StructField("engine", TEXT),
    T.StructField("batch_seq", LONG),
    T.StructField("id", LONG),
    T.StructField("content_hash", TEXT),
    T.StructField("embedder", TEXT),
    T.StructField("embedding", T.ArrayType(T.FloatType())),
    T.StructField("cell", LONG),
    T.StructField("cells", T.ArrayType(LONG)),
])

# Names and order of the run counters.
RUN_METRICS = [
    "filas_leidas",
    "filas_validas",
    "filas_en_cuarentena",
    "filas_nuevas",
    "filas_actualizadas",
    "filas_totales_silver",
]
