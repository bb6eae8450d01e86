"""Hash-gated upsert by key, without a table format that knows MERGE."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

INSERT, UPDATE, UNCHANGED, KEPT = "insert", "update", "unchanged", "kept"
ADVANCE = "advance"  # same content seen at a later place: only the place is brought up to date


def merge_upsert(target: DataFrame, source: DataFrame, key: str = "id",
                 hash_column: str = "content_hash") -> DataFrame:
    """Every row of the merged table with what happened to it in `op`.

    Both sides hold one row per key. A matched row is replaced only when the hashes differ (a
    null hash never differs); equal rows keep the target's values; nothing is deleted.
    """
    columns = target.columns
    t = target.select(F.col(key).alias("__key"), F.struct(*columns).alias("t"))
    s = source.select(F.col(key).alias("__key"), F.struct(*columns).alias("s"))
    differs = F.coalesce(F.col(f"t.{hash_column}") != F.col(f"s.{hash_column}"), F.lit(False))
    op = (F.when(F.col("t").isNull(), F.lit(INSERT))
          .when(F.col("s").isNull(), F.lit(KEPT))
          .when(differs, F.lit(UPDATE))
          .otherwise(F.lit(UNCHANGED)))
    joined = t.join(s, "__key", "full_outer").withColumn("op", op)
    winner = F.when(F.col("op").isin(INSERT, UPDATE), F.col("s")).otherwise(F.col("t"))
    return joined.select(winner.alias("row"), "op").select("row.*", "op")


def merge_changes(target: DataFrame, source: DataFrame, key: str = "id",
                  hash_column: str = "content_hash", order: Sequence[str] = (),
                  arrival: str = "ingestion_timestamp") -> DataFrame:
    """Only the source rows that change the table, with `op`.

    Reads a few narrow columns of the target, not the table. `order` names columns, stored in
    the table too, that tell which of two rows is newer: an older source row is left out, so a
    late file cannot undo a later one, and equal content at a newer place moves the stored
    place along while keeping its `arrival` time.
    """
    known = target.select(
        F.col(key), F.col(hash_column).alias("__hash"), F.struct(F.lit(0), *order).alias("__order"),
        F.col(arrival).alias("__arrival"), F.lit(True).alias("__known"))
    # Inner first: the small side of it can be broadcast, which an outer join would forbid.
    matched = known.join(source.select(key), key, "inner")
    compared = source.join(matched, key, "left")
    place = F.struct(F.lit(0), *order)
    differs = F.col("__hash") != F.col(hash_column)
    op = (F.when(F.col("__known").isNull(), F.lit(INSERT))
          .when(differs & (place >= F.col("__order")), F.lit(UPDATE))
          .when(~differs & (place > F.col("__order")), F.lit(ADVANCE)))
    kept = F.when(F.col("op") == ADVANCE, F.col("__arrival")).otherwise(F.col(arrival))
    return (compared.withColumn("op", op).filter(F.col("op").isNotNull())
            .withColumn(arrival, kept).drop("__hash", "__order", "__arrival", "__known"))


def apply_changes(target: DataFrame, changes: DataFrame, key: str = "id") -> DataFrame:
    """The merged table: target rows no change replaces, then the changed rows."""
    replaced = changes.filter(F.col("op") != INSERT).select(key)
    return target.join(replaced, key, "left_anti").unionByName(changes.select(*target.columns))


def change_counters() -> list[Column]:
    """Of changed rows, for an aggregation or an observation."""
    return [F.count_if(F.col("op") == INSERT).alias("filas_nuevas"),
            F.count_if(F.col("op") == UPDATE).alias("filas_actualizadas")]


def count_changes(changes: DataFrame) -> DataFrame:
    return changes.agg(*change_counters())


def merge_into_table(spark, table: str, source: DataFrame, key: str = "id",
                     hash_column: str = "content_hash") -> None:
    """The same upsert as one native MERGE, for catalogue tables whose format supports it."""
    (source.alias("source")
     .mergeInto(table, F.expr(f"{table}.{key} = source.{key}"))
     .whenMatched(F.expr(f"{table}.{hash_column} != source.{hash_column}")).updateAll()
     .whenNotMatched().insertAll()
     .merge())
