"""Where a job may cut its lineage."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def scratch_root(spark: SparkSession, fallback: str | None = None) -> str:
    """The shared folder named in `spark.checkpoint.dir`; where that is unset `fallback`, else a folder of the warehouse.

    The warehouse is shared too, wherever the session runs.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or fallback
    return root.rstrip("/") if root else f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/scratch"


def fresh_scratch(spark: SparkSession, fallback: str | None = None, name: str = "plan") -> str:
    """A folder no other run uses. What lies there is never read after the run that wrote it."""
    return f"{scratch_root(spark, fallback)}/shelfmark-{name}-{uuid.uuid4().hex}"


def write_through(df: DataFrame, path: str, partition_by: Sequence[str] = (), **options: str) -> DataFrame:
    """Write `df` as a table and read it back, so a lost executor never re-runs what led to it. `options` are the writer's."""
    df.write.mode("overwrite").options(**options).partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def staged(df: DataFrame, fallback: str | None = None) -> DataFrame:
    """`write_through` to a fresh folder, for plans that use `df` several times."""
    return write_through(df, fresh_scratch(df.sparkSession, fallback))


def file_system(spark: SparkSession, path: str):
    """Hadoop's file system and path object for `path`: whatever Spark can read and write."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Remove a folder of `fresh_scratch`, for jobs whose results do not read it any more."""
    if "/shelfmark-" not in path:
        raise ValueError(f"not a scratch folder: {path}")
    system, place = file_system(spark, path)
    system.delete(place, True)
