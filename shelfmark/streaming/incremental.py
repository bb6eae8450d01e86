"""Refine page files as they arrive, each once, resumable from its checkpoint."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..config import JobConfig
from ..plans.silver_job import REPLAY_ORDER, refine
from ..schemas import LONG, REFINED_SCHEMA, TEXT, T
from ..sources.buckets import BucketTable
from ..sources.landing import BATCH_GLOB, explode_page_files

# Incremental runs see only new files, so the table remembers where each row came from: a page
# file that arrives late must not undo a later one.
ORDERED_SCHEMA = T.StructType([
    *REFINED_SCHEMA.fields,
    T.StructField("source_page", LONG), T.StructField("file_name", TEXT), T.StructField("position", LONG)])


def incremental_table(spark: SparkSession, config: JobConfig) -> BucketTable:
    return BucketTable(spark, f"{config.table_dir}_incremental", ORDERED_SCHEMA, buckets=config.table_buckets)


def start_incremental(spark: SparkSession, config: JobConfig, as_of: str, checkpoint: str | None = None,
                      max_files: int = 10_000) -> StreamingQuery:
    """Process every page file not seen before, then stop.

    The checkpoint belongs to the table and lies beside it. A batch replayed after a failure meets rows of equal hash,
    changes nothing and replaces its own rejects. The file source does not see a path rewritten in place; use the
    batch job where pages are replaced.
    """
    checkpoint = checkpoint or f"{config.silver_dir}/incremental_checkpoint"
    checkpoint_id = hashlib.md5(checkpoint.encode()).hexdigest()[:8]
    files = (spark.readStream.format("text").option("wholetext", True)
             .option("pathGlobFilter", BATCH_GLOB).option("recursiveFileLookup", True).option("maxFilesPerTrigger", max_files)
             .load(config.bronze_dir)
             .select(F.col("_metadata.file_name").alias("file_name"), F.col("value").alias("text")))

    def merge(batch: DataFrame, batch_id: int) -> None:
        # Batch numbers begin anew with a new checkpoint; the query's id is the checkpoint's own.
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or checkpoint_id
        records = explode_page_files(batch).withColumn("position", F.col("position").cast("bigint"))
        refine(batch.sparkSession, config, records, as_of, f"batch_{query}_{batch_id}",
               incremental_table(batch.sparkSession, config), order=REPLAY_ORDER)

    return (files.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
