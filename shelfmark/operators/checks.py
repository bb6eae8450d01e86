"""Quality checks as one-row tables: each condition and the verdict `passed`."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _verdict(*conditions: str) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c) for c in conditions])


def check_silver_idempotent(metrics: DataFrame, first: str, second: str) -> DataFrame:
    """A second run over the same pages inserts and updates nothing and leaves the total alone."""
    def of(run, metric):
        return F.max(F.when(F.col("run") == run, F.col(metric)))

    total = "filas_totales_silver"
    return metrics.agg(
        (of(second, "filas_nuevas") == 0).alias("no_new_rows"),
        (of(second, "filas_actualizadas") == 0).alias("no_updates"),
        (of(first, total) == of(second, total)).alias("same_total"),
    ).withColumn("passed", _verdict("no_new_rows", "no_updates", "same_total"))


def check_gold_no_growth(run_metrics: DataFrame) -> DataFrame:
    return run_metrics.select(
        "engine", (F.col("embeddings_nuevos") == 0).alias("nothing_embedded"),
        (F.col("vector_count_antes") == F.col("vector_count_despues")).alias("same_size"),
    ).withColumn("passed", _verdict("nothing_embedded", "same_size"))


def check_results(results: DataFrame, refined: DataFrame, k: int, min_top1: float) -> DataFrame:
    """Per query: exactly k rows, known ids, scores never rising, best score high enough."""
    by_rank = Window.partitionBy("query_id").orderBy("rank")
    known = refined.select("id", F.lit(True).alias("known")).join(
        results.select("id").distinct(), "id", "inner")
    seen = (results.join(known, "id", "left")
            .withColumn("above", F.lag("score").over(by_rank)))
    return seen.groupBy("query_id").agg(
        (F.count(F.lit(1)) == k).alias("exactly_k"),
        (F.count_if(F.col("known").isNull()) == 0).alias("known_ids"),
        (F.count_if(F.col("score") > F.col("above")) == 0).alias("descending"),
        (F.max("score") >= min_top1).alias("top1_reached"),
    ).withColumn("passed", _verdict("exactly_k", "known_ids", "descending", "top1_reached"))


def check_engine_report(reports: DataFrame) -> DataFrame:
    """At least two engines, the five metrics of each present, recall within [0, 1]."""
    metrics = ["build_time_ms", "latency_p50_ms", "latency_p95_ms", "recall_at_k", "disk_footprint_bytes"]
    missing = reduce(lambda a, b: a | b, [F.col(m).isNull() for m in metrics])
    return reports.agg(
        (F.count(F.lit(1)) >= 2).alias("enough_engines"),
        (F.count_if(missing) == 0).alias("complete"),
        (F.count_if(~F.col("recall_at_k").between(0, 1)) == 0).alias("recall_in_range"),
    ).withColumn("passed", _verdict("enough_engines", "complete", "recall_in_range"))
