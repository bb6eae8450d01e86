"""What a log of page requests amounts to: outcome per page, routed bodies, pacing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..scratch import staged
from .contract import EMPTY_JSON

PAGE, QUERY_ERROR, UNREADABLE = "page", "query_error", "unreadable"
OK, OTHER_STATUS, EXHAUSTED, UNDECIDED = "ok", "other_status", "exhausted", "undecided"


def number_attempts(log: DataFrame, order: Sequence[str], max_attempts: int = 4) -> DataFrame:
    """Add `attempt`, 1 for a page's first request, and keep those the retry policy would make.

    Later requests of a page cannot matter; dropping them beside the window keeps a page that
    holds most of the log down to `max_attempts` rows per map task.
    """
    in_order = Window.partitionBy("page").orderBy(*order)
    numbered = log.withColumn("attempt", F.row_number().over(in_order))
    return numbered.filter(F.col("attempt") <= max_attempts)


def is_retryable(status: Column, body: Column) -> Column:
    """No response at all, 429, any 5xx, or a 403 that says the service is temporarily disabled."""
    disabled = (status == 403) & F.lower(F.coalesce(body, F.lit(""))).contains("temporarily disabled")
    return status.isNull() | (status == 429) | status.between(500, 599) | disabled


def fetch_outcomes(attempts: DataFrame, max_attempts: int = 4) -> DataFrame:
    """One row per page: `outcome, attempts, deciding_attempt, last_status, wait_seconds`.

    `attempts` holds `page, attempt, status, retry_after, body` and optionally `jitter` (0..1).
    The first response that must not be retried decides. Between attempts a 429 prescribes its
    Retry-After (default 1), anything else 2^attempt plus jitter; nothing follows the last one.
    """
    status, attempt = F.col("status"), F.col("attempt")
    jitter = F.col("jitter") if "jitter" in attempts.columns else F.lit(0.0)
    backoff = F.pow(F.lit(2.0), attempt) + jitter
    narrow = attempts.filter(attempt <= max_attempts).select(
        "page", "attempt", "status", is_retryable(status, F.col("body")).alias("retryable"),
        F.when(status == 429, F.coalesce(F.col("retry_after").cast("double"), F.lit(1.0)))
        .otherwise(backoff).alias("wait"))
    decided = narrow.groupBy("page").agg(
        F.min(F.when(~F.col("retryable"), attempt)).alias("deciding_attempt"),
        F.min_by("status", F.when(~F.col("retryable"), attempt)).alias("deciding_status"),
        F.max_by("status", attempt).alias("final_status"),
        F.max(attempt).alias("made"),
        *[F.max(F.when(F.col("retryable") & (attempt == i), F.col("wait"))).alias(f"wait_{i}")
          for i in range(1, max_attempts)])
    used = F.coalesce("deciding_attempt", "made")
    waits = [F.when(F.coalesce(F.col("deciding_attempt") > i, F.lit(True)), F.col(f"wait_{i}"))
             for i in range(1, max_attempts)]
    wait_seconds = F.lit(0.0)
    for wait in waits:
        wait_seconds = wait_seconds + F.coalesce(wait, F.lit(0.0))
    outcome = (F.when(F.col("deciding_status") == 200, F.lit(OK))
               .when(F.col("deciding_attempt").isNotNull(), F.lit(OTHER_STATUS))
               .when(F.col("made") >= max_attempts, F.lit(EXHAUSTED))
               .otherwise(F.lit(UNDECIDED)))
    return decided.select(
        "page", outcome.alias("outcome"), used.alias("attempts"), "deciding_attempt",
        F.when(F.col("deciding_attempt").isNotNull(), F.col("deciding_status"))
        .otherwise(F.col("final_status")).alias("last_status"),
        wait_seconds.alias("wait_seconds"))


def exhausted_reason(last_status: Column) -> Column:
    # Fixed text: how a page that ran out of attempts is recorded.
    detail = F.when(last_status.isNotNull(), F.format_string("status=%d", last_status)).otherwise(
        F.lit("no response"))
    return F.concat(F.lit("RetriesExhausted: Reintentos agotados: "), detail)


def route_responses(bodies: DataFrame, body: str = "body") -> DataFrame:
    """Add `route`, `errors` (JSON text) and `records` (one JSON text per entry).

    Non-empty `errors` wins over any `data`; a body that is neither is unreadable.
    """
    parsed = bodies.withColumn("__document", F.try_parse_json(body))
    errors = F.to_json(F.try_variant_get("__document", "$.errors", "variant"))
    media = F.try_variant_get("__document", "$.data.Page.media", "array<variant>")
    records = F.from_json(body, "data STRUCT<Page: STRUCT<media: ARRAY<STRING>>>")["data"]["Page"]["media"]
    has_errors = errors.isNotNull() & ~errors.isin(EMPTY_JSON)
    route = (F.when(has_errors, F.lit(QUERY_ERROR))
             .when(media.isNotNull(), F.lit(PAGE))
             .otherwise(F.lit(UNREADABLE)))
    return (parsed.withColumn("route", route)
            .withColumn("errors", F.when(F.col("route") == QUERY_ERROR, errors))
            .withColumn("records", F.when(F.col("route") == PAGE, records))
            .drop("__document"))


def page_results(attempts: DataFrame, outcomes: DataFrame) -> DataFrame:
    """One row per decided page: `page, landed, reason, records, is_empty`.

    Bodies are fetched only for the deciding attempts, after the outcomes are known.
    """
    bodies = attempts.select("page", F.col("attempt").alias("deciding_attempt"), "body")
    decided = outcomes.filter(F.col("outcome") != UNDECIDED).join(
        bodies, ["page", "deciding_attempt"], "left")
    spent = F.col("outcome") == EXHAUSTED
    reason = (F.when(spent, exhausted_reason(F.col("last_status")))
              .when(F.col("route") == QUERY_ERROR, F.concat(F.lit("QueryError: "), F.col("errors")))
              .when(F.col("route") == UNREADABLE,
                    F.format_string("UnreadableBody: status=%d", "last_status")))
    return route_responses(decided).select(
        "page", (~spent & (F.col("route") == PAGE)).alias("landed"), reason.alias("reason"), "records",
        (F.size("records") == 0).alias("is_empty"))


def landing_summary(results: DataFrame, pending: DataFrame, total_pages: int) -> DataFrame:
    """The counts of a landing run; `pending` are the pages it had to look at.

    Pages asked for are skipped, written, failed, or not decided by the log: the last four add up to the first.
    """
    open_pages = pending.agg(F.count(F.lit(1))).scalar()
    counted = results.agg(
        F.count_if(F.col("landed")).alias("paginas_escritas"),
        F.count_if(~F.col("landed")).alias("paginas_fallidas"))
    return counted.select(
        F.lit(total_pages).cast("bigint").alias("paginas_solicitadas"),
        (F.lit(total_pages) - open_pages).cast("bigint").alias("paginas_saltadas_checkpoint"),
        "paginas_escritas", "paginas_fallidas",
        (open_pages - F.col("paginas_escritas") - F.col("paginas_fallidas")).alias("paginas_sin_decidir"))


def previous_time(df: DataFrame, key: str, time: str, slice_width: int, slice_rows: int = 100_000) -> DataFrame:
    """Add `previous`: the time of the same key's preceding row (null for its first).

    `lag` over a whole key would put a busy client in one task. The window runs within time
    slices, and the first row of a slice takes the latest time of the key's slice before,
    found on one row per key and slice. A slice counted to hold more than `slice_rows` rows is cut into as many equal
    parts as that asks for.
    """
    sliced = df.withColumn("__slice", F.floor(F.col(time) / slice_width))
    # One row per crowded slice; written out, so that Spark knows how few they are.
    crowded = staged(sliced.groupBy(key, "__slice").agg(F.count(F.lit(1)).alias("__rows"))
                     .filter(F.col("__rows") > slice_rows)
                     .select(key, "__slice", F.ceil(F.col("__rows") / slice_rows).alias("__parts")))
    into = F.col(time) - F.col("__slice") * slice_width
    part = F.floor(into * F.coalesce("__parts", F.lit(1)) / slice_width)
    sliced = sliced.join(crowded, [key, "__slice"], "left").withColumn("__part", part).drop("__parts")
    place = [key, "__slice", "__part"]
    within = Window.partitionBy(*place).orderBy(time)
    ends = sliced.groupBy(*place).agg(F.max(time).alias("__end"))
    across = Window.partitionBy(key).orderBy("__slice", "__part")
    carried = ends.select(*place, F.lag("__end").over(across).alias("__carried"))
    return (sliced.withColumn("__lag", F.lag(time).over(within))
            .join(carried, place, "left")
            .withColumn("previous", F.coalesce("__lag", "__carried"))
            .drop("__slice", "__part", "__lag", "__carried"))


def pacing_audit(log: DataFrame, base_pause: float = 1.0, threshold: int = 10,
                 slice_seconds: int = 3600) -> DataFrame:
    """Per request: gap to the one before, the pause still owed, and the brake it calls for.

    `log` holds `client, ts_micros, remaining, reset_micros`. The brake holds until the reset
    time once `remaining` falls below `threshold`; without both headers there is none.
    """
    timed = previous_time(log, "client", "ts_micros", slice_seconds * 1_000_000)
    gap = (F.col("ts_micros") - F.col("previous")) / 1e6
    until_reset = (F.col("reset_micros") - F.col("ts_micros")) / 1e6
    braked = F.coalesce(F.col("remaining") < threshold, F.lit(False)) & F.col("reset_micros").isNotNull()
    return (timed.withColumn("gap_seconds", gap)
            .withColumn("owed_pause", F.greatest(F.coalesce(F.lit(base_pause) - gap, F.lit(0.0)), F.lit(0.0)))
            .withColumn("too_soon", F.coalesce(gap < base_pause, F.lit(False)))
            .withColumn("brake_seconds",
                        F.when(braked, F.greatest(until_reset, F.lit(0.0))).otherwise(F.lit(0.0)))
            .drop("previous"))
