"""The newest row of each key of a stream, by state that holds nothing but the place of that row.

Rows that repeat or come late, within a batch or batches later, fall away before anything is merged. The state grows by a few
numbers a key, not by its row; Spark keeps it by batch in the checkpoint, so a restart goes on where the last batch ended.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.merge import UPDATE
from ..scratch import drop_scratch, fresh_scratch, write_through
from ..sources.buckets import BucketTable


def _place(values) -> tuple:
    """Comparable, nulls first."""
    return tuple((0, 0) if pd.isna(v) else (1, v) for v in values)


def newest_rows(rows: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Rows of a stream that are newer than every row of their key before them, at most one for each key and batch.

    `order` names whole-number or text columns, the later place the larger; of equal places the first seen counts. Rows
    without a key are left out. A key's rows of a batch pass through one task in pieces; only the newest so far is held.
    """
    fields, order = rows.schema, list(order)
    if any(not isinstance(fields[c].dataType, (T.LongType, T.IntegerType, T.StringType)) for c in order):
        raise ValueError("order columns must be whole numbers or texts")
    names = fields.fieldNames()
    whole = [c for c in order if not isinstance(fields[c].dataType, T.StringType)]

    def keep(_, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        newest = _place(state.get) if state.exists else None
        found = None
        for part in parts:
            part = part.astype({c: "Int64" for c in whole})
            places = [_place(p) for p in part[order].itertuples(index=False, name=None)]
            best = max(range(len(places)), key=lambda k: (places[k], -k))
            if newest is None or places[best] > newest:
                newest, found = places[best], part.iloc[[best]]
        if found is not None:
            state.update(tuple(v if seen else None for seen, v in newest))
            yield found[names]

    # Whole numbers travel as they are: pandas would make those beside a null floating.
    state = T.StructType([T.StructField(c, T.LongType() if c in whole else T.StringType()) for c in order])
    return rows.filter(F.col(key).isNotNull()).groupBy(key).applyInPandasWithState(
        keep, fields, state, "append", GroupStateTimeout.NoTimeout)


def keep_newest(rows: DataFrame, key: str, order: Sequence[str], table: BucketTable, checkpoint: str,
                scratch_dir: str | None = None) -> StreamingQuery:
    """Bring `table` up to the newest row of each key of the stream, then stop; a later call goes on after it.

    A batch done again after a failure starts from the state before it and writes the same rows.
    """
    spark = rows.sparkSession

    def merge(batch: DataFrame, batch_id: int) -> None:
        scratch = fresh_scratch(spark, scratch_dir, f"newest_{batch_id}")
        changes = batch.select(*table.schema.fieldNames()).withColumn("op", F.lit(UPDATE))
        table.apply(write_through(changes, f"{scratch}/changes"), scratch)
        drop_scratch(spark, scratch)

    return (newest_rows(rows, key, order).writeStream.outputMode("append").foreachBatch(merge)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
