"""A table in hash buckets of its key: a change rewrites the buckets it touches and no others."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.hashing import row_digest
from ..operators.merge import apply_changes
from ..scratch import write_through
from .paths import path_exists, write_text

BUCKET = "bucket"
COMPRESSION = "zstd"  # of the rows, which are mostly text and written several times in a run
STATS = T.StructType([T.StructField("rows", T.LongType()), T.StructField("digest", T.DecimalType(38, 0)),
                      T.StructField(BUCKET, T.IntegerType())])


class BucketTable:
    """Parquet partitioned by `bucket`; one writer at a time, any number of readers.

    Spark's dynamic partition overwrite replaces the touched buckets. A writer that dies half way leaves some buckets
    changed and some not; the same changes applied again complete the work, as they meet rows of equal hash.
    The number of buckets is chosen once, for the size the table will have, and kept beside the data. So are each bucket's
    number of rows and the sum of its rows' digests, which does not depend on their order or on the files.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, key: str = "id", buckets: int = 64):
        self.spark, self.path, self.schema, self.key, self.wanted = spark, path, schema, key, buckets
        self.stored = T.StructType([*schema.fields, T.StructField(BUCKET, T.IntegerType())])

    def buckets(self) -> int:
        noted = f"{self.path}/bucket_count"
        if not path_exists(self.spark, noted):
            return self.wanted
        return int(self.spark.read.text(noted).first()[0])

    def exists(self) -> bool:
        return path_exists(self.spark, f"{self.path}/bucket_count")

    def _bucket(self, n: int) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(n)).cast("int")

    def _rows(self) -> DataFrame:
        if not self.exists():
            return self.spark.createDataFrame([], self.stored)
        return self.spark.read.schema(self.stored).parquet(f"{self.path}/rows")

    def read(self) -> DataFrame:
        return self._rows().select(*self.schema.fieldNames())

    def stats(self) -> DataFrame:
        """`bucket, rows, digest` as kept: a row for each bucket written so far."""
        if not self.exists():
            return self.spark.createDataFrame([], STATS)
        return self.spark.read.schema(STATS).parquet(f"{self.path}_stats")

    def total_rows(self) -> int:
        """From what is kept; no row is read."""
        return self.stats().agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]

    def _counted(self, rows: DataFrame, n: int) -> DataFrame:
        covered = [c for c in self.schema.fieldNames() if c != "ingestion_timestamp"]
        digests = rows.select(self._bucket(n).alias(BUCKET), row_digest(covered).alias("digest"))
        return digests.groupBy(BUCKET).agg(F.count(F.lit(1)).alias("rows"), F.sum("digest").cast("decimal(38,0)").alias("digest"))

    def altered(self) -> DataFrame:
        """`bucket, rows, digest, rows_found, digest_found` of buckets whose content is not what was written; reads the whole table."""
        found = self._counted(self.read(), self.buckets()).toDF(BUCKET, "rows_found", "digest_found")
        both = self.stats().join(found, BUCKET, "full_outer")
        same = F.col("rows").eqNullSafe(F.col("rows_found")) & F.col("digest").eqNullSafe(F.col("digest_found"))
        emptied = (F.col("rows") == 0) & F.col("rows_found").isNull()
        return both.filter(~same & ~F.coalesce(emptied, F.lit(False)))

    def recount(self) -> None:
        """Keep the numbers of what the table holds now: after a writer died between the rows and their numbers."""
        self._keep(self._counted(self.read(), self.buckets()))

    def _keep(self, stats: DataFrame) -> None:
        (stats.select("rows", "digest", BUCKET).coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(BUCKET).parquet(f"{self.path}_stats"))

    def apply(self, changes: DataFrame, scratch: str) -> int:
        """Merge changed rows (with `op`, as `merge_changes` gives them); returns how many buckets were written."""
        n = self.buckets()
        if not self.exists():
            self.spark.createDataFrame([], self.stored).write.mode("ignore").parquet(f"{self.path}/rows")
            self.spark.createDataFrame([], STATS).write.mode("ignore").parquet(f"{self.path}_stats")
            write_text(self.spark, str(n), f"{self.path}/bucket_count")
        touched = [r[0] for r in changes.select(self._bucket(n).alias(BUCKET)).distinct().collect()]  # n at most
        if not touched:
            return 0
        before = self._rows().filter(F.col(BUCKET).isin(touched)).select(*self.schema.fieldNames())
        after = write_through(apply_changes(before, changes, self.key), f"{scratch}/touched", compression=COMPRESSION)
        self._write(after, n)
        self._keep(self._counted(after, n))
        return len(touched)

    def _write(self, rows: DataFrame, n: int) -> None:
        # A file per bucket, unless Spark's own splitting of large partitions makes more.
        (rows.withColumn(BUCKET, self._bucket(n)).hint("rebalance", F.col(BUCKET)).write.mode("overwrite")
         .options(partitionOverwriteMode="dynamic", compression=COMPRESSION).partitionBy(BUCKET).parquet(f"{self.path}/rows"))
