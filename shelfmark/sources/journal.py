"""Append-only journals: rejected entries and failed pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dedupe import keep_last
from ..schemas import LEDGER_SCHEMA, QUARANTINE_SCHEMA
from .paths import read_appended


def quarantine_rows(rejected: DataFrame, as_of: str, run_id: str, payload: str = "payload") -> DataFrame:
    """Journal form of rejected rows: the reason and the payload exactly as it arrived."""
    return rejected.select(
        "motivo_rechazo", F.col(payload).alias("payload_original"),
        F.lit(as_of).alias("quarantined_at"), F.lit(run_id).alias("run_id"))


def write_quarantine(rows: DataFrame, path: str) -> None:
    """Rejects of one run, in a folder of its own: a run done again replaces what it wrote before."""
    (rows.select(*QUARANTINE_SCHEMA.fieldNames()).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("run_id").json(path))


def read_quarantine(spark: SparkSession, path: str) -> DataFrame:
    return read_appended(spark, path, QUARANTINE_SCHEMA)


def current_quarantine(rows: DataFrame) -> DataFrame:
    """One row per payload, from its latest run; the journal itself grows with each run."""
    hashed = rows.withColumn("payload_hash", F.sha2("payload_original", 256))
    return keep_last(hashed, ["payload_hash"], ["quarantined_at", "run_id"])


def append_failures(rows: DataFrame, path: str) -> None:
    rows.select(*LEDGER_SCHEMA.fieldNames()).write.mode("append").json(path)


def read_failures(spark: SparkSession, path: str) -> DataFrame:
    return read_appended(spark, path, LEDGER_SCHEMA)


def open_failures(failures: DataFrame, done_pages: DataFrame) -> DataFrame:
    """Failures of pages that have not been landed since."""
    return failures.join(done_pages, "page", "left_anti")
