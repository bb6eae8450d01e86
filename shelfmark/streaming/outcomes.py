"""Outcomes of page requests while they arrive: state holds a page's first requests, timers tell when its outcome stands.

A page is decided once the watermark has passed its deciding request, so that no earlier one can still come: the first
response that must not be retried, or the last attempt the policy allows. A page whose wait has passed without a further
request is told as undecided; a request that comes after all makes it told anew.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.responses import EXHAUSTED, OK, OTHER_STATUS, UNDECIDED, is_retryable

OUTCOME_SCHEMA = "page long, outcome string, attempts long, last_status long, wait_seconds double"
STATE_SCHEMA = "requests string, told long"


def outcome_of(requests: list[list], max_attempts: int) -> tuple[str, int, int | None, float]:
    """(outcome, attempts, last status, seconds waited) of requests in order: (micros, number, status, retryable, retry after)."""
    waited = 0.0
    for attempt, (_, _, status, retryable, after) in enumerate(requests, 1):
        if not retryable:
            return OK if status == 200 else OTHER_STATUS, attempt, status, waited
        if attempt < max_attempts:
            waited += (1.0 if after is None else after) if status == 429 else 2.0 ** attempt
    made = len(requests)
    return EXHAUSTED if made >= max_attempts else UNDECIDED, made, requests[-1][2], waited


def streamed_outcomes(log: DataFrame, delay: str = "10 minutes", max_attempts: int = 4) -> DataFrame:
    """Rows of OUTCOME_SCHEMA for a streamed log `page, ts, number, status, retry_after, body`.

    Requests of a page count in the order of `ts`, then `number`; those that come more than `delay` after later ones are
    dropped. Rows without a page only move the time on. A page is told once, or again if it was undecided. State is at most
    `max_attempts` requests a page.
    """
    timed = log.withWatermark("ts", delay).select(  # a filter on the page would move below the watermark
        "page", "ts", F.unix_micros("ts").alias("at"), F.col("number").cast("long").alias("number"),
        F.col("status").cast("long").alias("status"), is_retryable(F.col("status"), F.col("body")).alias("retryable"),
        F.col("retry_after").cast("double").alias("retry_after"))

    def follow(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if pd.isna(key[0]):
            for _ in parts:
                pass
            return
        requests, told = (json.loads(state.get[0]), state.get[1]) if state.exists else ([], 0)
        if not state.hasTimedOut:
            for part in parts:
                found = part[["at", "number", "status", "retryable", "retry_after"]].itertuples(index=False, name=None)
                requests += [[int(a), int(n), None if pd.isna(s) else int(s), bool(r), None if pd.isna(w) else float(w)]
                             for a, n, s, r, w in found]
                requests = sorted(requests, key=lambda r: r[:2])[:max_attempts]
        outcome, attempts, status, waited = outcome_of(requests, max_attempts)
        due = requests[attempts - 1][0] // 1000 + 1
        if outcome == UNDECIDED:
            due += int(1000 * (waited - outcome_of(requests[:-1], max_attempts)[3] if len(requests) > 1 else waited))
        passed = state.getCurrentWatermarkMs() >= due
        if passed and told != attempts and told >= 0:
            told = attempts if outcome == UNDECIDED else -1  # -1: decided for good
            yield pd.DataFrame({"page": [key[0]], "outcome": [outcome], "attempts": [attempts],
                                "last_status": pd.array([status], "Int64"), "wait_seconds": [waited]})
        state.update((json.dumps(requests), told))
        if not passed:
            state.setTimeoutTimestamp(due)

    return timed.groupBy("page").applyInPandasWithState(
        follow, OUTCOME_SCHEMA, STATE_SCHEMA, "append", GroupStateTimeout.EventTimeTimeout)
