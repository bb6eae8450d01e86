"""Path checks through Spark's own readers, so any file system it knows will do."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scratch import file_system


def path_exists(spark: SparkSession, path: str) -> bool:
    """One request to the file system; nothing is listed."""
    system, place = file_system(spark, path)
    return system.exists(place)


def write_text(spark: SparkSession, text: str, path: str) -> None:
    """One small file: written beside its place, then put there in one step. A reader finds the old text or the new one."""
    system, draft = file_system(spark, f"{path}.tmp")
    stream = system.create(draft, True)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    hadoop = spark._jvm.org.apache.hadoop.fs
    rename = getattr(hadoop, "Options$Rename")
    replace = spark._sc._gateway.new_array(rename, 1)
    replace[0] = rename.OVERWRITE
    files = hadoop.FileContext.getFileContext(system.getUri(), spark._jsc.hadoopConfiguration())
    files.rename(system.makeQualified(draft), system.makeQualified(hadoop.Path(path)), replace)


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Size on disk of the data files under `path`; reads no content."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Deal the rows of a scan out evenly, or by `keys`, before heavy per-row work, whatever files they came in."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def read_appended(spark: SparkSession, path: str, schema) -> DataFrame:
    """JSON rows appended under `path`; none when it does not exist yet."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(path)
