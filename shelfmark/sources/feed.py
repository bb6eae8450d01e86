"""What each run changed in a table, for consumers that follow it.

A run's changes are a partition of their own, numbered in order of arrival. A consumer keeps the number of the last it has
handled and reads only what came later; nothing new means no file is opened.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..scratch import file_system
from .paths import path_exists, write_text

FEED_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("content_hash", T.StringType()), T.StructField("op", T.StringType()),
    T.StructField("seq", T.LongType())])


class ChangeFeed:
    """One writer, any number of consumers, each with a name of its own."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _numbers(self) -> list[int]:
        """Runs kept, in order: a listing of folder names."""
        if not path_exists(self.spark, f"{self.path}/runs"):
            return []
        system, place = file_system(self.spark, f"{self.path}/runs")
        names = [s.getPath().getName() for s in system.listStatus(place)]
        return sorted(int(n.split("=")[1]) for n in names if n.startswith("seq="))

    def append(self, changes: DataFrame) -> int:
        """Keep a run's changes (`id, content_hash, op`); returns their number."""
        seq = max(self._numbers(), default=-1) + 1
        changes.select("id", "content_hash", "op").write.mode("overwrite").parquet(f"{self.path}/runs/seq={seq}")
        return seq

    def seen(self, consumer: str) -> int:
        """Number of the last run the consumer has handled, -1 before the first."""
        noted = f"{self.path}/consumers/{consumer}"
        return int(self.spark.read.text(noted).first()[0]) if path_exists(self.spark, noted) else -1

    def last(self) -> int:
        return max(self._numbers(), default=-1)

    def unseen(self, consumer: str) -> DataFrame | None:
        """The newest change of each id in runs the consumer has not handled; None if there are no such runs."""
        after = self.seen(consumer)
        numbers = [n for n in self._numbers() if n > after]
        if not numbers:
            return None
        rows = (self.spark.read.schema(FEED_SCHEMA).option("basePath", f"{self.path}/runs")
                .parquet(*(f"{self.path}/runs/seq={n}" for n in numbers)))
        newest = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("seq")))
        return rows.withColumn("place", newest).filter(F.col("place") == 1).drop("place")

    def handled(self, consumer: str, seq: int) -> None:
        """Note that the consumer is done with all runs up to `seq`."""
        write_text(self.spark, str(seq), f"{self.path}/consumers/{consumer}")

    def forget(self, consumers: list[str]) -> int:
        """Remove runs that all named consumers have handled, but for the last, which keeps the numbering; returns how many."""
        done = min(self.seen(c) for c in consumers)
        old = [n for n in self._numbers() if n <= done][:-1]
        for n in old:
            system, place = file_system(self.spark, f"{self.path}/runs/seq={n}")
            system.delete(place, True)
        return len(old)
