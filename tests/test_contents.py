"""What a table keeps about its contents, and the feed of its changes."""

import pytest
from pyspark.sql import functions as F

from entries import entry, write_page
from shelfmark.config import JobConfig
from shelfmark.plans import gold_job
from shelfmark.plans.gold_job import run_gold, run_search
from shelfmark.plans.silver_job import refined_table, run_silver, table_feed
from shelfmark.queries.tables import catalogue
from shelfmark.schemas import RUN_METRICS
from shelfmark.sources.buckets import BucketTable


@pytest.fixture
def config(tmp_path):
    return JobConfig(bronze_dir=str(tmp_path / "bronze"), silver_dir=str(tmp_path / "silver"), gold_dir=str(tmp_path / "gold"),
                     scratch_dir=str(tmp_path / "scratch"), table_buckets=8)


def _land(config, page, ids, **changes):
    write_page(config.bronze_dir, page, [entry(i, description=f"story {i} of the valley " * 5, **changes) for i in ids])


def _run(spark, config, run_id):
    row = run_silver(spark, config, "2024-05-02", run_id).first()
    return tuple(row[m] for m in RUN_METRICS)


def _kept(spark, config):
    return sorted(tuple(r) for r in refined_table(spark, config).stats().select("bucket", "rows", "digest").collect())


def test_a_second_run_leaves_the_contents_as_they_are(spark, config):
    _land(config, 1, range(30))
    assert _run(spark, config, "a") == (30, 30, 0, 30, 0, 30)
    before = _kept(spark, config)
    assert sum(r[1] for r in before) == 30 and len(before) > 4
    assert _run(spark, config, "b") == (30, 30, 0, 0, 0, 30) and _kept(spark, config) == before
    _land(config, 1, range(30), episodes=77)
    assert _run(spark, config, "c") == (30, 30, 0, 0, 30, 30)
    assert all(a[1] == b[1] and a[2] != b[2] for a, b in zip(before, _kept(spark, config)))
    assert refined_table(spark, config).altered().count() == 0


def test_one_changed_cell_is_found(spark, config):
    _land(config, 1, range(30))
    _run(spark, config, "a")
    table = refined_table(spark, config)
    rows = spark.createDataFrame(table.read().collect(), table.schema)
    table._write(rows.withColumn("status", F.when(F.col("id") == 12, F.lit("other")).otherwise(F.col("status"))), table.buckets())
    found = table.altered().collect()
    assert len(found) == 1 and found[0]["rows"] == found[0]["rows_found"] and found[0]["digest"] != found[0]["digest_found"]
    table._write(rows.filter("id <> 12"), table.buckets())
    assert [r["rows"] - (r["rows_found"] or 0) for r in table.altered().collect()] in ([1], [])
    table._write(rows, table.buckets())
    table.recount()
    assert table.altered().count() == 0


def test_a_run_without_valid_rows_is_counted(spark, config):
    write_page(config.bronze_dir, 1, [entry(1, description="short"), "[]", 5])
    assert _run(spark, config, "a") == (3, 0, 3, 0, 0, 0)
    assert table_feed(refined_table(spark, config)).last() == -1


def test_the_index_follows_the_feed(spark, config, monkeypatch):
    _land(config, 1, range(10))
    _run(spark, config, "a")
    feed = table_feed(refined_table(spark, config))
    assert run_gold(spark, config, "g1", delta_on="feed").first()[1:] == (10, 0, 10)
    _run(spark, config, "b")
    assert feed.last() == 0 and feed.unseen("exact") is None
    with monkeypatch.context() as nothing_read:
        nothing_read.setattr(gold_job, "read_vectors", None)
        assert run_gold(spark, config, "g2", delta_on="feed").first()[1:] == (0, 10, 10)
    _land(config, 1, range(3), episodes=50)
    _land(config, 2, range(20, 22))
    _run(spark, config, "c")
    _land(config, 1, range(2), episodes=51)
    _run(spark, config, "d")
    assert sorted((r["id"], r["op"], r["seq"]) for r in feed.unseen("exact").collect()) == [
        (0, "update", 2), (1, "update", 2), (2, "update", 1), (20, "insert", 1), (21, "insert", 1)]
    assert run_gold(spark, config, "g3", delta_on="feed").first()[1:] == (5, 10, 15)
    queries = spark.createDataFrame([(1, "story 21 of the valley")], "query_id long, text string")
    assert run_search(spark, config, queries, k=20).select("id").distinct().count() == 12
    assert feed.forget(["exact"]) == 2 and feed.last() == 2


def test_the_catalogue_moves_each_text_once_however_many_labels(spark, tmp_path):
    texts = [(i, f"word{i} and more", "en", "src1", 20) for i in [*range(20), 3]] + [(None, "no id", "en", "src1", 5)]
    spark.createDataFrame(texts, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in [*range(5), 4, None]], "doc_id long, quality int, toxic int").write.parquet(
        f"{tmp_path}/labels.parquet")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = catalogue(spark, str(tmp_path))
        plan = rows._sc._jvm.PythonSQLUtils.explainString(rows._jdf.queryExecution(), "simple")
        got = sorted((str(r["doc_id"]), '"idMal":1' in r["payload"]) for r in rows.where("payload is not null").collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange") == 2 and "Sort" not in plan  # the texts, and the labels
    assert got == sorted((str(i), i < 5) for i in [*range(20), 3, 4])


def test_a_large_bucket_is_written_by_several_tasks(spark, tmp_path):
    rows = spark.range(20_000).select("id", F.sha2(F.col("id").cast("string"), 512).alias("text"))
    table = BucketTable(spark, f"{tmp_path}/table", rows.schema, buckets=1)
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    try:
        table._write(rows.repartition(8), 1)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    written = spark.read.parquet(f"{tmp_path}/table/rows")
    assert written.count() == 20_000 and len(written.inputFiles()) > 2
