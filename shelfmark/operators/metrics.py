"""Run counters as tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import RUN_METRICS
from .merge import count_changes


def route_counters() -> list[Column]:
    """Of checked rows, for an aggregation or an observation."""
    valid = F.col("motivo_rechazo").isNull()
    return [F.count(F.lit(1)).alias("filas_leidas"), F.count_if(valid).alias("filas_validas"),
            F.count_if(~valid).alias("filas_en_cuarentena")]


def route_counts(checked: DataFrame) -> DataFrame:
    """`filas_leidas, filas_validas, filas_en_cuarentena`, before any de-duplication."""
    return checked.agg(*route_counters())


def metrics_pivot(metrics: DataFrame, runs: Sequence[str]) -> DataFrame:
    """One row per counter in fixed order, one column per run."""
    long = metrics.unpivot("run", RUN_METRICS, "metric", "value")
    ordinal = F.array_position(F.array(*[F.lit(m) for m in RUN_METRICS]), F.col("metric"))
    return (long.groupBy("metric").pivot("run", list(runs)).agg(F.max("value"))
            .withColumn("ordinal", ordinal).orderBy("ordinal"))


def run_metrics(run: str, checked: DataFrame, changes: DataFrame, merged: DataFrame) -> DataFrame:
    """One run's six counters from its checked rows, its changes and the merged table."""
    total = merged.agg(F.count(F.lit(1))).scalar()
    changed = count_changes(changes).select(F.struct("filas_nuevas", "filas_actualizadas")).scalar()
    return route_counts(checked).select(
        F.lit(run).alias("run"), "filas_leidas", "filas_validas", "filas_en_cuarentena",
        changed["filas_nuevas"].alias("filas_nuevas"),
        changed["filas_actualizadas"].alias("filas_actualizadas"),
        total.alias("filas_totales_silver"))


def gold_run_metrics(engine: str, delta: DataFrame, stored: DataFrame) -> DataFrame:
    """`engine, embeddings_nuevos, vector_count_antes, vector_count_despues`."""
    new, before = F.col("embeddings_nuevos"), F.col("vector_count_antes")
    held = stored.agg(F.count(F.lit(1))).scalar()
    return delta.agg(F.count(F.lit(1)).alias("embeddings_nuevos")).select(
        F.lit(engine).alias("engine"), "embeddings_nuevos", held.alias("vector_count_antes")
    ).withColumn("vector_count_despues", before + new)
