"""Sets of pages as bitmaps: one row of 4 KB for each 32,768 pages, whatever number of pages it holds.

The pages of a landing run are a few rows that can be kept and merged with those of other runs; what is still to be
fetched is read off the merged bits, so no page number is ever joined or shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PAGES = 32_768  # in a bitmap: Spark's size, page 1 first


def page_bitmaps(pages: DataFrame, *by: str) -> DataFrame:
    """`bucket, bitmap` (after `by`, if given) of a table's `page` column; nulls, repeats and numbers below 1 add nothing."""
    known = pages.filter(F.col("page") >= 1)
    return known.groupBy(*by, F.bitmap_bucket_number("page").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("page")).alias("bitmap"))


def merged_bitmaps(bitmaps: DataFrame) -> DataFrame:
    """The union of several sets: one row a bucket."""
    return bitmaps.groupBy("bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def page_count(merged: DataFrame) -> DataFrame:
    """`pages`: how many the set holds."""
    return merged.agg(F.coalesce(F.sum(F.bitmap_count("bitmap")), F.lit(0)).alias("pages"))


def missing_pages(merged: DataFrame, total_pages: int) -> DataFrame:
    """Pages 1..`total_pages` that are not in the set, ascending. Only buckets are joined, one row for 32,768 pages."""
    buckets = -(-total_pages // PAGES)
    wanted = merged.sparkSession.range(1, buckets + 1).withColumnRenamed("id", "bucket")
    both = wanted.join(merged, "bucket", "left")
    byte = F.conv(F.hex(F.substring("bitmap", F.floor(F.col("bit") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    bit_set = F.coalesce(F.getbit(byte, F.pmod("bit", F.lit(8))) == 1, F.lit(False))
    bits = both.select("bucket", "bitmap", F.explode(F.sequence(F.lit(0), F.lit(PAGES - 1))).alias("bit"))
    page = ((F.col("bucket") - 1) * PAGES + F.col("bit") + 1).alias("page")
    return bits.filter(~bit_set).select(page).filter(F.col("page") <= total_pages).orderBy("page")
