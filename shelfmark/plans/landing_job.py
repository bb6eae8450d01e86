"""Land delivered page responses: skip done pages, write good ones, record failed ones."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import JobConfig
from ..operators.responses import fetch_outcomes, landing_summary, pacing_audit, page_results
from ..scratch import drop_scratch, fresh_scratch, write_through
from ..sources.journal import append_failures
from ..sources.landing import land_records, landing_table, write_landing
from ..sources.page_sets import missing_pages, page_bitmaps


def landed_pages(spark: SparkSession, config: JobConfig) -> DataFrame:
    return landing_table(spark, config.landing_dir).select(F.col("source_page").alias("page")).distinct()


def run_landing(spark: SparkSession, config: JobConfig, attempts: DataFrame, as_of: str,
                run_id: str) -> DataFrame:
    """`attempts` is the request log (`page, attempt, status, retry_after, body`); returns the counts.

    Every page of the log is asked for, or, with `paginas`, pages 1 to `paginas`. A page that failed never stops
    the others; pages landed before are not looked at again. Large pages are landed in parts of `per_page` records.
    """
    scratch = fresh_scratch(spark, config.scratch_dir, run_id)
    if config.paginas is None:
        done = landed_pages(spark, config)
        logged = write_through(attempts.select(F.col("page").cast("bigint").alias("page")).distinct(), f"{scratch}/logged")
        pending, asked = logged.join(done, "page", "left_anti"), logged.count()
    else:
        landed_set = page_bitmaps(landing_table(spark, config.landing_dir).withColumnRenamed("source_page", "page"))
        pending, asked = missing_pages(landed_set, config.paginas), config.paginas
    pending = write_through(pending, f"{scratch}/pending")
    wanted = attempts.join(pending, "page", "left_semi")
    # Outcomes are narrow; once they are written out, Spark knows how to join the bodies to them.
    outcomes = write_through(fetch_outcomes(wanted), f"{scratch}/outcomes")
    results = write_through(page_results(wanted, outcomes), f"{scratch}/pages")

    landed = results.filter("landed").select(
        F.lit(as_of).alias("ingestion_timestamp"), F.lit(config.source).alias("source"),
        F.col("page").alias("source_page"), "records")
    write_landing(in_parts(landed, config.per_page), config.landing_dir, run_id)
    failures = results.filter(~F.col("landed")).select("page", "reason", F.lit(as_of).alias("recorded_at"))
    append_failures(failures, config.ledger_dir)
    counts = landing_summary(results, pending, asked).collect()
    summary = spark.createDataFrame(counts, "paginas_solicitadas long, paginas_saltadas_checkpoint long, "
                                            "paginas_escritas long, paginas_fallidas long, paginas_sin_decidir long")
    drop_scratch(spark, scratch)
    return summary


def in_parts(pages: DataFrame, max_records: int) -> DataFrame:
    """Pages with their records cut into parts of at most `max_records`; an empty page is one empty part."""
    last = F.greatest(F.size("records") - 1, F.lit(0))
    first = F.explode(F.sequence(F.lit(0), last, F.lit(max_records)))
    return pages.withColumn("first_position", first).withColumn(
        "records", F.slice("records", F.col("first_position") + 1, max_records)).withColumn(
        "first_position", F.col("first_position").cast("bigint"))


def land(spark: SparkSession, config: JobConfig, records: DataFrame, as_of: str, run_id: str) -> None:
    """Land single records (`source_page, position, payload`) as pages."""
    write_landing(land_records(records, as_of, config.source, config.per_page), config.landing_dir, run_id)


def audit_pacing(config: JobConfig, requests: DataFrame) -> DataFrame:
    """`pacing_audit` with the job's pause and threshold."""
    return pacing_audit(requests, config.pausa_base, config.umbral_remaining)
