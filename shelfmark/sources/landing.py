"""Landed pages: JSON page files as delivered, or the columnar landing table we write."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import LANDING_SCHEMA, LANDING_TABLE_SCHEMA
from .paths import path_exists

# Fixed value: name format of a landed page file. The later parts of a large page add their first position.
BATCH_NAME = "anime_catalog_batch_%04d.json"
PART_NAME = "anime_catalog_batch_%04d_from_%09d.json"
BATCH_GLOB = "anime_catalog_batch_*.json"
BATCH_PATTERN = r"^anime_catalog_batch_(\d{4,})(?:_from_\d{9,})?\.json$"


def batch_filename(page: Column, first_position: Column | None = None) -> Column:
    whole = F.format_string(BATCH_NAME, page)
    if first_position is None:
        return whole
    later = F.coalesce(first_position, F.lit(0)) > 0
    return F.when(later, F.format_string(PART_NAME, page, first_position)).otherwise(whole)


def page_of(file_name: Column) -> Column:
    """Page number in a file name; null when the name is not a complete page file's."""
    return F.regexp_extract(file_name, BATCH_PATTERN, 1).try_cast("bigint")


def envelope_text(timestamp: Column, source: Column, page: Column, records: Column,
                  first_position: Column | None = None) -> Column:
    """The page envelope as JSON text; `records` are JSON texts and go in as they are.

    Only a later part of a large page says at which position it begins.
    """
    def quoted(column):
        return F.to_json(column.cast("string").cast("variant"))

    begins = F.lit("")
    if first_position is not None:
        said = F.concat(F.lit(',"first_position":'), first_position.cast("string"))
        begins = F.when(F.coalesce(first_position, F.lit(0)) > 0, said).otherwise(F.lit(""))
    return F.concat(
        F.lit('{"ingestion_timestamp":'), quoted(timestamp), F.lit(',"source":'), quoted(source),
        F.lit(',"source_page":'), page.cast("string"), begins,
        F.lit(',"records":['), F.array_join(records, ","), F.lit("]}"))


def land_records(records: DataFrame, timestamp: str, source: str, max_records: int = 50) -> DataFrame:
    """Pages from single records (`source_page, position, payload`), in landing layout.

    A page of more than `max_records` records is landed in parts, so no group grows with the
    data; `first_position` is 0 for the first part and tells where each later one begins.
    """
    part = F.floor(F.col("position") / max_records)
    grouped = records.groupBy("source_page", part.alias("part")).agg(
        F.array_sort(F.collect_list(F.struct("position", "payload"))).alias("rows"))
    return grouped.select(
        F.lit(timestamp).alias("ingestion_timestamp"), F.lit(source).alias("source"), "source_page",
        F.col("rows")[0]["position"].cast("bigint").alias("first_position"),
        F.transform("rows", lambda r: r["payload"]).alias("records"))


def page_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per page file: `file_name` and whole `text`. Folders beside the files are no partitions of them."""
    return (spark.read.text(path, wholetext=True, pathGlobFilter=BATCH_GLOB, recursiveFileLookup=True)
            .select(F.col("_metadata.file_name").alias("file_name"), F.col("value").alias("text")))


def valid_pages(files: DataFrame) -> DataFrame:
    """Pages that are done: complete file name, JSON object, `records` and `source_page` present, in every part."""
    keys = F.json_object_keys("text")
    whole = F.coalesce(F.array_contains(keys, "records") & F.array_contains(keys, "source_page"), F.lit(False))
    return (files.select(page_of(F.col("file_name")).alias("page"), whole.alias("whole"))
            .filter(F.col("page").isNotNull()).groupBy("page").agg(F.every("whole").alias("whole"))
            .filter("whole").select("page"))


def pending_pages(done: DataFrame, total_pages: int) -> DataFrame:
    """Pages 1..`total_pages` not yet done, ascending."""
    wanted = done.sparkSession.range(1, total_pages + 1).withColumnRenamed("id", "page")
    return wanted.join(done, "page", "left_anti").orderBy("page")


def explode_page_files(files: DataFrame) -> DataFrame:
    """Records of page files: `source_page, file_name, position, ingestion_timestamp, payload`.

    `source_page` comes from the name and gives the replay order. A file without a readable
    record list yields one row holding its whole text, which the contract then rejects.
    """
    envelope = F.from_json("text", LANDING_SCHEMA).alias("e")
    opened = files.select("file_name", "text", envelope)
    readable = F.coalesce(F.col("e.records"), F.array("text"))
    return _placed(opened.select(
        page_of(F.col("file_name")).alias("source_page"), "file_name",
        F.col("e.ingestion_timestamp").alias("ingestion_timestamp"),
        F.col("e.first_position").alias("first_position"), readable.alias("records")))


def _placed(pages: DataFrame) -> DataFrame:
    """One row per record, with its absolute position in the page."""
    opened = pages.select("source_page", "file_name", "ingestion_timestamp", "first_position",
                          F.posexplode("records").alias("__at", "payload"))
    position = F.coalesce("first_position", F.lit(0).cast("bigint")) + F.col("__at")
    return opened.select("source_page", "file_name", "ingestion_timestamp", position.alias("position"), "payload")


def read_page_files(spark: SparkSession, path: str) -> DataFrame:
    return explode_page_files(page_files(spark, path))


def write_landing(envelopes: DataFrame, path: str, run_id: str) -> None:
    """Append pages to the landing table; Spark's commit keeps half-written pages out of sight."""
    if "first_position" not in envelopes.columns:
        envelopes = envelopes.withColumn("first_position", F.lit(0).cast("bigint"))
    rows = envelopes.select(*LANDING_SCHEMA.fieldNames(), F.lit(run_id).alias("landing_run"))
    rows.write.mode("append").partitionBy("landing_run").parquet(path)


def landing_table(spark: SparkSession, path: str) -> DataFrame:
    if not path_exists(spark, path):
        return spark.createDataFrame([], LANDING_TABLE_SCHEMA)
    return spark.read.schema(LANDING_TABLE_SCHEMA).parquet(path)


def relanded_pages(landing: DataFrame) -> DataFrame:
    """Pages landed more than once, with the stamp of their newest copy; reads narrow columns only."""
    stamp = F.struct("ingestion_timestamp", "landing_run")
    copies = landing.groupBy("source_page").agg(F.min(stamp).alias("oldest"), F.max(stamp).alias("newest"))
    return copies.filter(F.col("oldest") != F.col("newest")).select("source_page", "newest")


def read_landing(landing: DataFrame, relanded: DataFrame | None = None) -> DataFrame:
    """Records of the landing table; a page landed again replaces its earlier copy.

    `relanded` may be `relanded_pages(landing)` already written out. It is normally tiny, and
    once Spark knows its size the join broadcasts it and the records are not shuffled.
    """
    relanded = relanded_pages(landing) if relanded is None else relanded
    stamp = F.struct("ingestion_timestamp", "landing_run")
    kept = landing.join(relanded, "source_page", "left").filter(
        F.col("newest").isNull() | (stamp == F.col("newest")))
    return _placed(kept.select(
        "source_page", batch_filename(F.col("source_page"), F.col("first_position")).alias("file_name"),
        "ingestion_timestamp", "first_position", "records"))
