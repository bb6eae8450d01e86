"""Landed records to the refined table: check, route, hash, de-duplicate, merge, count."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import JobConfig
from ..functions.hashing import content_hash
from ..operators.contract import check_contract
from ..operators.dedupe import keep_last
from ..operators.merge import INSERT, UPDATE, change_counters, merge_changes
from ..operators.metrics import route_counters
from ..schemas import HASHED_COLUMNS, LONG, REFINED_COLUMNS, REFINED_SCHEMA, RUN_METRICS
from ..scratch import drop_scratch, fresh_scratch, staged, write_through
from ..sources.buckets import COMPRESSION, BucketTable
from ..sources.feed import ChangeFeed
from ..sources.journal import quarantine_rows, write_quarantine
from ..sources.landing import landing_table, read_landing, read_page_files, relanded_pages

METRICS_SCHEMA = T.StructType([T.StructField("run", T.StringType())]
                              + [T.StructField(m, LONG) for m in RUN_METRICS])

# Where a row was landed; the later place wins.
REPLAY_ORDER = ["source_page", "file_name", "position"]


def refined_rows(valid: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Valid rows in table layout, the last landed of each id, with their content hash.

    The hash comes after the de-duplication, so it is not computed for rows that fall away.
    """
    newest = keep_last(valid, ["id"], REPLAY_ORDER)
    return newest.withColumn("content_hash", content_hash(HASHED_COLUMNS)).select(
        *REFINED_COLUMNS, *keep)


def landed_records(spark: SparkSession, config: JobConfig, layout: str) -> DataFrame:
    if layout == "files":
        return read_page_files(spark, config.bronze_dir)
    if layout == "table":
        landing = landing_table(spark, config.landing_dir)
        return read_landing(landing, staged(relanded_pages(landing), config.scratch_dir))
    raise ValueError(f"unknown landing layout: {layout}")


def refine(spark: SparkSession, config: JobConfig, records: DataFrame, as_of: str, run_id: str,
           table: BucketTable, order: Sequence[str] = ()) -> DataFrame:
    """Merge `records` into `table`; returns the run's counters as one row.

    The checked rows are written once, split by verdict, and every later step reads that copy:
    the costly parse runs a single time and a lost executor cannot change the counts. Only rejects keep their
    payload there. Only buckets of the table that change are written. The counters are observed on the rows as they are
    written, and the table keeps its number of rows: none is counted in a pass of its own. What changed is added to the
    table's feed.
    """
    scratch = fresh_scratch(spark, config.scratch_dir, run_id)
    checked = check_contract(records, config.min_desc_len)
    checked = checked.withColumn("is_valid", F.col("motivo_rechazo").isNull()).withColumn(
        "payload", F.when(F.col("motivo_rechazo").isNotNull(), F.col("payload")))
    routed, changed = Observation("routed"), Observation("changed")
    checked = write_through(checked.observe(routed, *route_counters()), f"{scratch}/checked", ["is_valid"],
                            compression=COMPRESSION)
    valid_count, rejected_count = (routed.get[c] for c in ("filas_validas", "filas_en_cuarentena"))
    if rejected_count:
        rejected = checked.filter(~F.col("is_valid"))
        write_quarantine(quarantine_rows(rejected, as_of, run_id), config.quarantine_dir)

    inserted, updated = 0, 0
    if valid_count:
        source = refined_rows(checked.filter("is_valid"), keep=order)
        changes = merge_changes(table.read(), source, order=order).observe(changed, *change_counters())
        changes = write_through(changes, f"{scratch}/changes", compression=COMPRESSION)
        inserted, updated = (changed.get[c] for c in ("filas_nuevas", "filas_actualizadas"))
        if table.apply(changes, scratch) and inserted + updated:
            table_feed(table).append(changes.filter(F.col("op").isin(INSERT, UPDATE)))
    counters = (valid_count + rejected_count, valid_count, rejected_count, inserted, updated, table.total_rows())
    drop_scratch(spark, scratch)
    return spark.createDataFrame([(run_id, *counters)], METRICS_SCHEMA)


def refined_table(spark: SparkSession, config: JobConfig) -> BucketTable:
    return BucketTable(spark, config.table_dir, REFINED_SCHEMA, buckets=config.table_buckets)


def table_feed(table: BucketTable) -> ChangeFeed:
    return ChangeFeed(table.spark, f"{table.path}_feed")


def run_silver(spark: SparkSession, config: JobConfig, as_of: str, run_id: str,
               layout: str = "files") -> DataFrame:
    """Re-read everything landed and merge it; repeating a run changes nothing."""
    records = landed_records(spark, config, layout)
    return refine(spark, config, records, as_of, run_id, refined_table(spark, config))
