"""Measuring search methods: query sample, recall, percentiles, choice of engine."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def sample_queries(vectors: DataFrame, n: int = 50, seed: int = 42) -> DataFrame:
    """`min(n, rows)` vectors without replacement, the same ones on every run."""
    draw = F.md5(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")))
    return (vectors.orderBy(draw, "id").limit(n)
            .select(F.col("id").alias("query_id"), "embedding"))


def recall_at_k(results: DataFrame, truth: DataFrame) -> DataFrame:
    """`engine, hits, truths, recall_at_k`; 0 when there is no truth.

    `results` holds `engine, query_id, id` and `truth` `query_id, id`, both k rows per query.
    """
    marked = results.join(truth.select("query_id", "id", F.lit(1).alias("hit")),
                          ["query_id", "id"], "left")
    truths = truth.agg(F.count(F.lit(1))).scalar()
    counted = (marked.groupBy("engine").agg(F.coalesce(F.sum("hit"), F.lit(0)).alias("hits"))
               .withColumn("truths", truths))
    recall = F.when(F.col("truths") > 0, F.col("hits") / F.col("truths")).otherwise(F.lit(0.0))
    return counted.withColumn("recall_at_k", recall)


SALTS = 32


def exact_percentiles(df: DataFrame, group: str, value: str, probabilities: Sequence[float],
                      accuracy: int = 100_000) -> DataFrame:
    """`group, p, percentile` with linear interpolation between neighbours.

    `percentile()` holds every distinct value of a group in one task. Here a sketch first
    brackets each wanted rank (small groups keep their whole range). Values below the bracket
    are only counted, map-side, and values above it dropped: what reaches the ordered step is
    about 6/`accuracy` of a group, and the result is still exact. Values meet the brackets dealt by group and value,
    so a group with most rows does not fill one task.
    """
    slack = 3.0 / accuracy
    edges = [e for p in probabilities for e in (max(0.0, p - slack), min(1.0, p + slack))]
    sketch = df.filter(F.col(value).isNotNull()).groupBy(group).agg(
        F.count(F.lit(1)).alias("n"), F.min(value).alias("least"), F.max(value).alias("most"),
        F.percentile_approx(value, edges, accuracy).alias("edges"))
    small = F.col("n") <= accuracy
    wanted = F.explode(F.array(*[
        F.struct(
            F.lit(float(p)).alias("p"),
            F.when(small, F.col("least")).otherwise(F.col("edges")[2 * i]).alias("low"),
            F.when(small, F.col("most")).otherwise(F.col("edges")[2 * i + 1]).alias("high"))
        for i, p in enumerate(probabilities)]))
    brackets = sketch.select(group, "n", wanted.alias("w")).select(group, "n", "w.*")
    salt = F.pmod(F.xxhash64(value), F.lit(SALTS)).cast("int").alias("__salt")
    salted = brackets.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    inside = df.select(group, value, salt).join(salted, [group, "__salt"]).filter(F.col(value) <= F.col("high"))
    counts = (inside.withColumn("v", F.when(F.col(value) >= F.col("low"), F.col(value)))
              .groupBy(group, "p", "n", "v").agg(F.count(F.lit(1)).alias("rows")))
    upward = (Window.partitionBy(group, "p").orderBy(F.col("v").asc_nulls_first())
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    position = F.col("p") * (F.col("n") - 1)
    ranked = counts.withColumn("reached", F.sum("rows").over(upward)).withColumn("position", position)
    ends = ranked.groupBy(group, "p", "position").agg(
        F.min(F.when(F.col("reached") > F.floor("position"), F.col("v"))).alias("below"),
        F.min(F.when(F.col("reached") > F.ceil("position"), F.col("v"))).alias("above"))
    between = F.col("below") + (F.col("above") - F.col("below")) * (
        F.col("position") - F.floor("position"))
    return ends.select(group, "p", between.alias("percentile"))


def latency_percentiles(latencies: DataFrame, group: str = "engine", value: str = "latency_ms") -> DataFrame:
    """`engine, latency_p50_ms, latency_p95_ms`."""
    rows = exact_percentiles(latencies, group, value, [0.5, 0.95])
    return rows.groupBy(group).agg(
        F.max(F.when(F.col("p") == 0.5, F.col("percentile"))).alias("latency_p50_ms"),
        F.max(F.when(F.col("p") == 0.95, F.col("percentile"))).alias("latency_p95_ms"))


def choose_engine(reports: DataFrame) -> DataFrame:
    """One row, `engine, justification`: best recall; on a tie the smaller footprint; then list order.

    `reports` holds one row per engine: `engine, engine_order, recall_at_k, disk_footprint_bytes`.
    """
    best = reports.agg(F.max("recall_at_k")).scalar()
    place = F.struct("disk_footprint_bytes", "engine_order")
    listed = F.array_sort(F.collect_list(F.struct("engine_order", "engine")))
    tied = reports.filter(F.col("recall_at_k") == best).agg(
        F.count(F.lit(1)).alias("n"), F.max("recall_at_k").alias("recall"),
        F.min_by("engine", place).alias("engine"),
        F.min_by("disk_footprint_bytes", place).alias("bytes"),
        F.array_join(F.transform(listed, lambda x: x["engine"]), ", ").alias("names"))
    # Fixed texts: the two forms of the justification.
    alone = F.format_string("%s tiene el mayor recall@k medido (%.3f).", "engine", "recall")
    shared = F.format_string(
        "Empate en recall@k (%.3f) entre %s; gana %s por menor huella en disco (%d bytes).",
        "recall", "names", "engine", "bytes")
    return tied.filter(F.col("n") > 0).select(
        "engine", F.when(F.col("n") == 1, alone).otherwise(shared).alias("justification"))


def engine_report_table(reports: DataFrame, chosen: DataFrame) -> DataFrame:
    """Rounded report rows with a mark on the chosen engine."""
    winner = chosen.select("engine", F.lit("✓").alias("mark"))
    return reports.join(winner, "engine", "left").select(
        "engine_order", F.col("engine").alias("motor"),
        F.round("build_time_ms", 3).alias("tiempo_construccion_ms"),
        F.round("latency_p50_ms", 4).alias("latencia_p50_ms"),
        F.round("latency_p95_ms", 4).alias("latencia_p95_ms"),
        F.round("recall_at_k", 4).alias("recall_at_k"),
        F.col("disk_footprint_bytes").alias("huella_disco_bytes"),
        F.coalesce("mark", F.lit("")).alias("elegido"))
