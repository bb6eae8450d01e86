from pathlib import Path

import pytest
from pyspark.errors import PySparkException

from entries import entry, write_page
from shelfmark.config import JobConfig
from shelfmark.operators.checks import check_silver_idempotent
from shelfmark.operators.merge import apply_changes, merge_changes, merge_into_table, merge_upsert
from shelfmark.plans.silver_job import refined_table, run_silver
from shelfmark.schemas import RUN_METRICS
from shelfmark.sources.journal import read_quarantine


@pytest.fixture
def config(tmp_path):
    return JobConfig(bronze_dir=str(tmp_path / "bronze"), silver_dir=str(tmp_path / "silver"),
                     scratch_dir=str(tmp_path / "scratch"))


def run(spark, config, run_id):
    return run_silver(spark, config, "2024-05-02", run_id)


def counters(metrics):
    row = metrics.first()
    return tuple(row[m] for m in RUN_METRICS)


def test_second_run_changes_nothing(spark, config):
    write_page(config.bronze_dir, 1, [entry(100 + i) for i in range(5)])
    first, second = run(spark, config, "a"), run(spark, config, "b")
    assert counters(first) == (5, 5, 0, 5, 0, 5)
    assert counters(second) == (5, 5, 0, 0, 0, 5)
    assert check_silver_idempotent(first.unionByName(second), "a", "b").first()["passed"]


def files_of(config):
    return {str(p): p.stat().st_mtime_ns for p in Path(config.table_dir).rglob("part-*.parquet")}


def test_a_change_leaves_files_of_other_buckets_alone(spark, config):
    write_page(config.bronze_dir, 1, [entry(100 + i) for i in range(40)])
    run(spark, config, "a")
    before = files_of(config)
    assert len({Path(p).parent for p in before if "bucket=" in p}) > 10
    assert counters(run(spark, config, "b"))[3:] == (0, 0, 40) and files_of(config) == before
    write_page(config.bronze_dir, 1, [entry(100 + i, episodes=99 if i == 7 else 12) for i in range(40)])
    assert counters(run(spark, config, "c"))[3:] == (0, 1, 40)
    after = files_of(config)
    gone = set(before) - set(after)
    assert len({Path(p).parent for p in gone}) == 1
    assert all(after[p] == before[p] for p in before if p not in gone)
    assert {r["episodes"] for r in refined_table(spark, config).read().filter("id = 107").collect()} == {99}
    assert refined_table(spark, config).read().count() == 40


def test_a_run_done_again_replaces_its_rejects(spark, config):
    write_page(config.bronze_dir, 1, [entry(1), entry(2, description="short")])
    for _ in range(2):
        run(spark, config, "same")
    assert read_quarantine(spark, config.quarantine_dir).count() == 1
    run(spark, config, "other")
    assert read_quarantine(spark, config.quarantine_dir).count() == 2


def test_hash_is_stable_and_ignores_arrival(spark, config):
    write_page(config.bronze_dir, 1, [entry(i) for i in range(3)])
    run(spark, config, "a")
    before = sorted(refined_table(spark, config).read().collect())
    write_page(config.bronze_dir, 1, [entry(i) for i in range(3)], stamp="2030-01-01T00:00:00+00:00")
    assert counters(run(spark, config, "b"))[3:] == (0, 0, 3)
    assert sorted(refined_table(spark, config).read().collect()) == before


def test_business_change_updates(spark, config):
    write_page(config.bronze_dir, 1, [entry(100 + i) for i in range(2)])
    run(spark, config, "a")
    write_page(config.bronze_dir, 1, [entry(100 + i, averageScore=99) for i in range(2)])
    assert counters(run(spark, config, "b"))[3:] == (0, 2, 2)
    assert {r["average_score"] for r in refined_table(spark, config).read().collect()} == {99}


def test_last_landed_occurrence_wins_and_rows_are_counted_before_dedupe(spark, config):
    write_page(config.bronze_dir, 2, [entry(1, episodes=2), entry(1, episodes=3)])
    write_page(config.bronze_dir, 1, [entry(1, episodes=1), entry(2), entry(3, description="short")])
    assert counters(run(spark, config, "a")) == (5, 4, 1, 2, 0, 2)
    rows = {r["id"]: r["episodes"] for r in refined_table(spark, config).read().collect()}
    assert rows == {1: 3, 2: 12}


def test_nothing_valid_still_leaves_an_empty_table(spark, config):
    write_page(config.bronze_dir, 1, [entry(1, description="")])
    assert counters(run(spark, config, "a")) == (1, 0, 1, 0, 0, 0)
    assert refined_table(spark, config).read().count() == 0


def test_unreadable_page_file_is_quarantined_whole(spark, config):
    write_page(config.bronze_dir, 1, [entry(1)])
    broken = write_page(config.bronze_dir, 2, [entry(2)])
    text = broken.read_text()[:300]
    broken.write_text(text)
    assert counters(run(spark, config, "a")) == (2, 1, 1, 1, 0, 1)
    (row,) = read_quarantine(spark, config.quarantine_dir).collect()
    assert row["payload_original"] == text and row["motivo_rechazo"].startswith("Malformed record")


ROWS = "id long, v string, ingestion_timestamp string, content_hash string"


def test_merge_forms_agree(spark):
    target = spark.createDataFrame(
        [(1, "a", "t", "h1"), (2, "b", "t", "h2"), (3, "c", "t", "h3"), (4, "d", "t", None)], ROWS)
    source = spark.createDataFrame(
        [(1, "A", "s", "h1"), (2, "B", "s", "x2"), (4, "D", "s", "h4"), (5, "E", "s", "h5")], ROWS)
    whole = merge_upsert(target, source)
    assert {(r["id"], r["v"], r["op"]) for r in whole.collect()} == {
        (1, "a", "unchanged"), (2, "B", "update"), (3, "c", "kept"), (4, "d", "unchanged"), (5, "E", "insert")}
    changes = merge_changes(target, source)
    assert {(r["id"], r["op"]) for r in changes.collect()} == {(2, "update"), (5, "insert")}
    assert sorted(apply_changes(target, changes).collect(), key=lambda r: r["id"]) == sorted(
        whole.drop("op").collect(), key=lambda r: r["id"])


def test_native_merge_needs_a_table_format(spark):
    spark.createDataFrame([(1, "a", "t", "h")], ROWS).createOrReplaceTempView("plain_rows")
    with pytest.raises(PySparkException, match="MERGE|table|plain_rows"):
        merge_into_table(spark, "plain_rows", spark.table("plain_rows"))
