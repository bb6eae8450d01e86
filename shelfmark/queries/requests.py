"""Request-log queries: outcomes, routing, landing, ledger, pacing."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.dedupe import keep_last
from ..operators.responses import (fetch_outcomes, landing_summary, number_attempts, pacing_audit, page_results,
                                   route_responses)
from ..scratch import fresh_scratch, staged
from ..sources.journal import open_failures
from ..sources.landing import pending_pages
from ..streaming.outcomes import OUTCOME_SCHEMA, streamed_outcomes
from .tables import AS_OF, REQUEST_LOG_SQL, request_log, table


def routed(spark, sf_dir):
    return route_responses(request_log(spark, sf_dir)).select(
        "event_id", "route", "errors", F.array_join("records", ";").alias("records"))


def _attempts(spark, sf_dir):
    return number_attempts(request_log(spark, sf_dir), ["ts", "event_id"])


def outcomes(spark, sf_dir):
    return fetch_outcomes(_attempts(spark, sf_dir)).select(
        "page", "outcome", F.col("attempts").cast("bigint").alias("attempts"),
        F.col("last_status").cast("bigint").alias("last_status"),
        F.round("wait_seconds", 6).alias("wait_seconds"))


def outcomes_streamed(spark, sf_dir):
    """The whole log as a stream of six spans of time and a last one that only moves the time on; each page as last told."""
    folder = fresh_scratch(spark, name="requests")
    log = request_log(spark, sf_dir).select(
        "page", F.timestamp_micros(_micros(F.col("ts"))).alias("ts"), F.col("event_id").alias("number"), "status", "retry_after", "body")
    at, day = F.unix_micros("ts"), 86_400_000_000
    first, last = log.agg(F.min(at), F.max(at)).first()
    span = F.floor((at - first) * 6 / (last - first + 1))
    beat = spark.range(1).select(*(
        (F.timestamp_micros(F.lit(last + day)) if c == "ts" else F.lit(None).cast(log.schema[c].dataType)).alias(c) for c in log.columns))
    for k in range(6):
        log.filter(span == k).coalesce(1).write.parquet(f"{folder}/arriving/{k}")
    beat.coalesce(1).write.parquet(f"{folder}/arriving/6")
    arriving = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/arriving/*")
    (streamed_outcomes(arriving).writeStream.format("parquet").option("checkpointLocation", f"{folder}/checkpoint")
     .trigger(availableNow=True).start(f"{folder}/told").awaitTermination())
    told = spark.read.schema(OUTCOME_SCHEMA).parquet(f"{folder}/told")
    return keep_last(told, ["page"], ["attempts"]).withColumn("wait_seconds", F.round("wait_seconds", 6))


def _results(spark, sf_dir):
    attempts = _attempts(spark, sf_dir)
    return page_results(attempts, staged(fetch_outcomes(attempts)))


def landed_pages(spark, sf_dir):
    return _results(spark, sf_dir).select(
        "page", "landed", "reason", F.size("records").cast("bigint").alias("n_records"), "is_empty")


def _pending(spark, sf_dir):
    """Pages of the whole log less those landed before, taken to be the labelled ones."""
    last = table(spark, sf_dir, "events").agg(F.max("user_id")).first()[0] + 1
    done = table(spark, sf_dir, "labels").select((F.col("doc_id") + 1).alias("page"))
    return pending_pages(done, last), last


def summary(spark, sf_dir):
    pending, last = _pending(spark, sf_dir)
    wanted = _results(spark, sf_dir).join(pending, "page", "left_semi")
    return landing_summary(wanted, pending, last)


def _ledger(spark, sf_dir):
    failed = _results(spark, sf_dir).filter(~F.col("landed"))
    return failed.select("page", "reason", F.lit(AS_OF).alias("recorded_at"))


def still_open(spark, sf_dir):
    done = table(spark, sf_dir, "labels").select((F.col("doc_id") + 1).alias("page"))
    return open_failures(_ledger(spark, sf_dir), done)


def _micros(column):
    return F.timestamp_diff("MICROSECOND", F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'"), column)


def pacing(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("bigint")
    sent = _micros(F.col("ts"))
    log = events.select(
        "event_id", F.col("event_type").alias("client"), sent.alias("ts_micros"),
        F.floor("value").alias("remaining"), (sent + (k - 30) * 1_000_000).alias("reset_micros"))
    return pacing_audit(log, base_pause=600.0).select(
        "event_id", F.round("gap_seconds", 6).alias("gap_seconds"),
        F.round("owed_pause", 6).alias("owed_pause"), "too_soon",
        F.round("brake_seconds", 6).alias("brake_seconds"))


_PENDING_SQL = """
pending AS (
  SELECT page FROM (SELECT unnest(range(1, (SELECT max(user_id) + 2 FROM events))) AS page)
  WHERE page NOT IN (SELECT doc_id + 1 FROM labels))
"""
_LEDGER_SQL = f"SELECT page, reason, '{AS_OF}' AS recorded_at FROM results WHERE reason IS NOT NULL"

OUTCOMES_SQL = f"""
        WITH {REQUEST_LOG_SQL},
        waits AS (
          SELECT n.page, sum(CASE WHEN n.status = 429 THEN coalesce(retry_after, 1) ELSE 2.0 ** n.attempt END)
                 FILTER (n.retryable AND n.attempt < 4 AND n.attempt < coalesce(d.deciding_attempt, 5)) AS wait
          FROM numbered n JOIN decided d ON n.page = d.page GROUP BY n.page)
        SELECT d.page, d.outcome, d.attempts, d.last_status::BIGINT AS last_status,
               round(coalesce(w.wait, 0), 6) AS wait_seconds
        FROM decided d JOIN waits w ON d.page = w.page"""

QUERIES = {
    "route_responses": (routed, f"""
        WITH {REQUEST_LOG_SQL}
        SELECT event_id, CASE WHEN NOT coalesce(json_valid(body), false) THEN 'unreadable'
                 WHEN json_type(body, '$.errors') = 'ARRAY' THEN 'query_error' ELSE 'page' END AS route,
               CASE WHEN route = 'query_error' THEN json_extract(body, '$.errors')::VARCHAR END AS errors,
               CASE WHEN route = 'page' THEN array_to_string(json_extract(body, '$.data.Page.media[*]'), ';')
               END AS records
        FROM log"""),
    "fetch_outcomes": (outcomes, OUTCOMES_SQL),
    "streamed_outcomes": (outcomes_streamed, OUTCOMES_SQL),
    "landing_results": (landed_pages, f"""
        WITH {REQUEST_LOG_SQL}
        SELECT page, landed, reason,
               CASE WHEN landed THEN n_records::BIGINT END AS n_records,
               CASE WHEN landed THEN n_records = 0 END AS is_empty FROM results"""),
    "landing_summary": (summary, f"""
        WITH {REQUEST_LOG_SQL}, {_PENDING_SQL}
        SELECT (SELECT max(user_id) + 1 FROM events) AS paginas_solicitadas,
               (SELECT max(user_id) + 1 FROM events) - (SELECT count(*) FROM pending) AS paginas_saltadas_checkpoint,
               count(*) FILTER (reason IS NULL) AS paginas_escritas,
               count(*) FILTER (reason IS NOT NULL) AS paginas_fallidas,
               (SELECT count(*) FROM pending) - count(*) AS paginas_sin_decidir
        FROM results WHERE page IN (SELECT page FROM pending)"""),
    "failed_ledger": (_ledger, f"WITH {REQUEST_LOG_SQL} {_LEDGER_SQL}"),
    "open_failures": (still_open, f"""
        WITH {REQUEST_LOG_SQL} {_LEDGER_SQL} AND page NOT IN (SELECT doc_id + 1 FROM labels)"""),
    "pacing_audit": (pacing, """
        WITH timed AS (
          SELECT event_id, value, (epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY event_type ORDER BY ts)) / 1e6 AS gap,
                 ((props->>'$.k')::BIGINT - 30)::DOUBLE AS until_reset
          FROM events)
        SELECT event_id, round(gap, 6) AS gap_seconds, round(greatest(coalesce(600 - gap, 0), 0), 6) AS owed_pause,
               coalesce(gap < 600, false) AS too_soon,
               CASE WHEN floor(value) < 10 THEN greatest(until_reset, 0) ELSE 0 END AS brake_seconds
        FROM timed"""),
}
