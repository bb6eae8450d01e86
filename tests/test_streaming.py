from datetime import datetime, timedelta

import pandas as pd
import pytest

from entries import entry, write_page
from shelfmark.config import JobConfig
from shelfmark.sources.buckets import BucketTable
from shelfmark.sources.journal import read_quarantine
from shelfmark.streaming.incremental import incremental_table, start_incremental
from shelfmark.streaming.outcomes import OUTCOME_SCHEMA, streamed_outcomes
from shelfmark.streaming.newest import keep_newest, newest_rows


def process(spark, config):
    query = start_incremental(spark, config, "2024-05-02")
    query.awaitTermination()
    return [p for p in query.recentProgress if p["numInputRows"]]


def rows(spark, config):
    return {r["id"]: (r["episodes"], r["ingestion_timestamp"], r["source_page"])
            for r in incremental_table(spark, config).read().collect()}


def test_each_file_once_and_late_files_do_not_undo_later_ones(spark, tmp_path):
    config = JobConfig(bronze_dir=str(tmp_path / "bronze"), silver_dir=str(tmp_path / "silver"),
                       scratch_dir=str(tmp_path / "scratch"))
    write_page(config.bronze_dir, 1, [entry(1, episodes=1), entry(2, episodes=1), entry(9, description="")], "t1")
    assert len(process(spark, config)) == 1
    assert rows(spark, config) == {1: (1, "t1", 1), 2: (1, "t1", 1)}
    assert process(spark, config) == []
    assert read_quarantine(spark, config.quarantine_dir).count() == 1

    # Page 5 changes entry 1 and confirms entry 2 as it is.
    write_page(config.bronze_dir, 5, [entry(1, episodes=5), entry(2, episodes=1)], "t5")
    process(spark, config)
    assert rows(spark, config) == {1: (5, "t5", 5), 2: (1, "t1", 5)}

    # Page 3 arrives late: older than what page 5 said, news only about entry 3.
    write_page(config.bronze_dir, 3, [entry(1, episodes=3), entry(2, episodes=3), entry(3, episodes=3)], "t3")
    process(spark, config)
    assert rows(spark, config) == {1: (5, "t5", 5), 2: (1, "t1", 5), 3: (3, "t3", 3)}


def test_rejects_of_another_checkpoint_are_kept(spark, tmp_path):
    config = JobConfig(bronze_dir=str(tmp_path / "bronze"), silver_dir=str(tmp_path / "silver"), scratch_dir=str(tmp_path / "scratch"))
    write_page(config.bronze_dir, 1, [entry(1), entry(9, description="")], "t1")
    for name in ("lost", "new"):
        start_incremental(spark, config, "2024-05-02", str(tmp_path / name)).awaitTermination()
    assert read_quarantine(spark, config.quarantine_dir).select("run_id").distinct().count() == 2


ARRIVING = "id long, page long, name string, word string"


def test_state_keeps_the_newest_over_batches_and_restarts(spark, tmp_path):
    def arrive(name, rows):
        spark.createDataFrame(rows, ARRIVING).coalesce(1).write.parquet(str(tmp_path / "in" / name))

    def process():
        rows = spark.readStream.schema(ARRIVING).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in" / "*"))
        query = keep_newest(rows, "id", ["page", "name"], table, str(tmp_path / "checkpoint"), str(tmp_path / "scratch"))
        query.awaitTermination()
        return {r["id"]: r["word"] for r in table.read().collect()}

    table = BucketTable(spark, str(tmp_path / "table"), spark.createDataFrame([], ARRIVING).schema, buckets=2)
    arrive("a", [(1, 5, "x", "old"), (1, 5, "y", "newest of its batch"), (2, None, None, "no place"), (None, 1, "a", "no key"),
                 (3, 1, "a", "first"), (3, 1, "a", "repeated")] + [(9, k, "hot", f"row {k}") for k in range(3_000)])
    assert process() == {1: "newest of its batch", 2: "no place", 3: "first", 9: "row 2999"}
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "table").rglob("part-*")}
    arrive("b", [(1, 5, "x", "late"), (1, 4, "z", "late"), (2, None, None, "again"), (9, 17, "hot", "late")])
    assert process() == {1: "newest of its batch", 2: "no place", 3: "first", 9: "row 2999"}
    assert before == {p: p.stat().st_mtime_ns for p in (tmp_path / "table").rglob("part-*")}  # nothing was merged
    arrive("c", [(1, 6, "a", "newer"), (2, 0, None, "placed"), (2 ** 60 + 1, 2 ** 60 + 1, "a", "large"), (2 ** 60 + 1, 2 ** 60, "a", "less")])
    assert process() == {1: "newer", 2: "placed", 3: "first", 9: "row 2999", 2 ** 60 + 1: "large"}
    assert process() == {1: "newer", 2: "placed", 3: "first", 9: "row 2999", 2 ** 60 + 1: "large"}


def test_order_columns_must_compare(spark):
    with pytest.raises(ValueError):
        newest_rows(spark.createDataFrame(pd.DataFrame({"id": [1], "at": [0.5]})), "id", ["at"])


REQUESTS = "page long, ts timestamp, number long, status int, retry_after double, body string"


def test_pages_are_decided_by_requests_and_timers(spark, tmp_path):
    def arrive(name, rows):
        rows = [(page, datetime(2024, 5, 1) + timedelta(seconds=at), n, status, after, None)
                for n, (page, at, status, after) in enumerate(rows)]
        spark.createDataFrame(rows, REQUESTS).coalesce(1).write.parquet(str(tmp_path / "in" / name))

    def told():
        rows = spark.readStream.schema(REQUESTS).parquet(str(tmp_path / "in" / "*"))
        (streamed_outcomes(rows, "10 seconds").writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "checkpoint"))
         .trigger(availableNow=True).start(str(tmp_path / "told")).awaitTermination())
        return sorted(tuple(r) for r in spark.read.schema(OUTCOME_SCHEMA).parquet(str(tmp_path / "told")).collect())

    ok, failed, left = (1, "ok", 2, 200, 2.0), (2, "exhausted", 4, 503, 14.0), (3, "undecided", 1, 429, 60.0)
    arrive("a", [(1, 3, 200, None), (1, 1, 503, None), *((2, k, 503, None) for k in range(5)), (3, 5, 429, 60.0), (4, 6, 404, None),
                 (None, 30, None, None)])
    assert told() == [ok, failed, (4, "other_status", 1, 404, 0.0)]  # the wait of page 3 is not over
    arrive("b", [(1, 40, 200, None), (5, 100, None, None), (None, 101, None, None)])
    assert told() == [ok, failed, left, (4, "other_status", 1, 404, 0.0)]
    arrive("c", [(3, 110, 200, None), (5, 102, 200, None), (None, 300, None, None)])
    assert told() == [ok, failed, (3, "ok", 2, 200, 60.0), left, (4, "other_status", 1, 404, 0.0), (5, "ok", 2, 200, 2.0)]
    assert len(told()) == 6
