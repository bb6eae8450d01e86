"""One key holding a third of all rows: results stay whole, and the plans thin it out before the shuffle."""

import numpy as np
from pyspark.sql import functions as F

from shelfmark.operators.dedupe import keep_last
from shelfmark.operators.responses import number_attempts, previous_time
from shelfmark.operators.topk import HyperplaneCells, topk
from test_gold import as_ranks, vector_table

ROWS = 6000


def skewed(spark):
    """Key 0 holds every third row."""
    n = F.col("id")
    return spark.range(ROWS, numPartitions=6).select(
        F.when(n % 3 == 0, F.lit(0)).otherwise(n % 500 + 1).alias("key"), n.alias("place"))


def plan_of(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")


def test_keep_last_thins_out_before_the_shuffle(spark):
    df = skewed(spark)
    last = {r["key"]: r["place"] for r in keep_last(df, ["key"], ["place"]).collect()}
    wanted = {}
    for row in df.collect():
        wanted[row["key"]] = max(wanted.get(row["key"], -1), row["place"])
    assert last == wanted
    plan = plan_of(keep_last(df, ["key"], ["place"]))
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_attempts_thin_out_before_the_shuffle(spark):
    log = skewed(spark).select(F.col("key").alias("page"), "place")
    numbered = number_attempts(log, ["place"])
    counts = {r["page"]: r["n"] for r in numbered.groupBy("page").agg(F.count("*").alias("n")).collect()}
    assert set(counts.values()) == {4} and len(counts) == log.select("page").distinct().count()
    plan = plan_of(numbered)
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_previous_time_slices_a_busy_key(spark):
    df = skewed(spark)
    found = {r["place"]: r["previous"] for r in previous_time(df, "key", "place", 250).collect()}
    seen, wanted = {}, {}
    for row in sorted(df.collect(), key=lambda r: r["place"]):
        wanted[row["place"]] = seen.get(row["key"])
        seen[row["key"]] = row["place"]
    assert found == wanted
    assert "hashpartitioning(key#" in plan_of(previous_time(df, "key", "place", 250))


def test_a_crowded_cell_is_cut_into_blocks(spark):
    rng = np.random.default_rng(11)
    matrix = rng.normal(size=(400, 8)).astype(np.float32)
    matrix[:200] = np.abs(matrix[:200]) + 1  # half the rows share one direction, hence one cell
    matrix /= np.linalg.norm(matrix, axis=1, keepdims=True)
    strategy = HyperplaneCells(8, tables=2, bits=3)
    queries, vectors = vector_table(spark, matrix[:60], "query_id"), vector_table(spark, matrix)
    whole = as_ranks(topk(queries, vectors, 7, strategy))
    assert as_ranks(topk(queries, vectors, 7, strategy, broadcast_queries=0, block_rows=13)) == whole
