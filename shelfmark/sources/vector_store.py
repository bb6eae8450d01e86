"""Vectors as a Parquet table; the id travels with its vector, so no position mapping can be lost."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import VECTOR_SCHEMA
from ..scratch import file_system, write_through
from .paths import path_exists, stored_bytes


def read_vectors(spark: SparkSession, path: str, engine: str | None = None) -> DataFrame:
    """All stored vectors, or one engine's (a partition filter)."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], VECTOR_SCHEMA)
    rows = spark.read.schema(VECTOR_SCHEMA).parquet(path)
    return rows if engine is None else rows.filter(F.col("engine") == engine)


def append_vectors(rows: DataFrame, path: str) -> None:
    """Add a batch; earlier batches are not rewritten. Files hold ranges of cells in order, so a probe skips the rest."""
    _in_order(rows).write.mode("append").partitionBy("engine", "batch_seq").parquet(path)


def _in_order(rows: DataFrame) -> DataFrame:
    return (rows.withColumn("cell", F.col("cells")[0]).select(*VECTOR_SCHEMA.fieldNames())
            .repartitionByRange("cell", "id").sortWithinPartitions("cell", "id"))


def replace_vectors(rows: DataFrame, path: str, engine: str, scratch: str) -> None:
    """Put `rows` (batch 0) in place of all the engine holds. One writer; readers wait for the end."""
    spark = rows.sparkSession
    kept = write_through(rows, scratch)
    system, place = file_system(spark, f"{path}/engine={engine}")
    system.delete(place, True)
    append_vectors(kept, path)


def superseded(rows: DataFrame) -> DataFrame:
    """`engine, id, newest` of ids stored in more than one batch; reads no vectors."""
    batches = rows.groupBy("engine", "id").agg(F.min("batch_seq").alias("oldest"), F.max("batch_seq").alias("newest"))
    return batches.filter(F.col("oldest") < F.col("newest")).select("engine", "id", "newest")


def current_vectors(rows: DataFrame, replaced: DataFrame | None = None) -> DataFrame:
    """Newest vector of each id and engine, for stores that re-embed changed texts.

    `replaced` may be `superseded(rows)` already written out: it is normally tiny, and the vectors then meet it where
    they lie instead of being shuffled by id.
    """
    replaced = superseded(rows) if replaced is None else replaced
    kept = rows.join(replaced, ["engine", "id"], "left")
    return kept.filter(F.col("newest").isNull() | (F.col("batch_seq") == F.col("newest"))).select(*rows.columns)


def next_batch(rows: DataFrame) -> int:
    return rows.agg(F.coalesce(F.max("batch_seq") + 1, F.lit(0))).first()[0]


def vector_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("engine").agg(F.count(F.lit(1)).alias("vectors"))


def store_bytes(spark: SparkSession, path: str, engine: str) -> int:
    location = f"{path}/engine={engine}"
    return stored_bytes(spark, location) if path_exists(spark, location) else 0
