import json

import pytest
from pyspark.sql import functions as F

from entries import LOG_SCHEMA, entry, page_body, page_name, write_page
from shelfmark.config import JobConfig, from_args
from shelfmark.operators.responses import fetch_outcomes, pacing_audit, previous_time, route_responses
from shelfmark.plans.landing_job import audit_pacing, land, landed_pages, run_landing
from shelfmark.plans.silver_job import refined_table, run_silver
from shelfmark.sources.journal import open_failures, read_failures
from shelfmark.sources.landing import (batch_filename, envelope_text, land_records, landing_table, page_files,
                                       pending_pages, read_landing, read_page_files, valid_pages)


def config_in(tmp_path, **changes):
    return JobConfig(bronze_dir=str(tmp_path / "bronze"), silver_dir=str(tmp_path / "silver"),
                     scratch_dir=str(tmp_path / "scratch"), **changes)


def log(spark, rows):
    return spark.createDataFrame(rows, LOG_SCHEMA)


def test_pages_left_after_an_interrupted_run(spark, tmp_path):
    for page in range(1, 6):
        write_page(tmp_path, page, [entry(page)])
    (tmp_path / page_name(6)).write_text('{"records": [')
    (tmp_path / page_name(7)).write_text("[1]")
    (tmp_path / page_name(8)).write_text('{"source_page": 8}')
    (tmp_path / (page_name(9) + ".tmp")).write_text((tmp_path / page_name(1)).read_text())
    (tmp_path / "anime_catalog_batch_10.json").write_text((tmp_path / page_name(1)).read_text())
    (tmp_path / page_name(11)).write_text('{"source_page": 11, "records": null}')
    done = valid_pages(page_files(spark, str(tmp_path)))
    assert sorted(r["page"] for r in done.collect()) == [1, 2, 3, 4, 5, 11]
    left = [r["page"] for r in pending_pages(done, 20).collect()]
    assert left == [p for p in range(6, 21) if p != 11]


def test_records_come_in_page_order_with_their_text(spark, tmp_path):
    big = {"id": 1, "z": 1, "a": 12345678901234567890123, "t": "é　"}
    write_page(tmp_path, 2, [big, entry(2)])
    write_page(tmp_path, 1, [])
    rows = read_page_files(spark, str(tmp_path)).orderBy("source_page", "position").collect()
    assert [(r["source_page"], r["position"]) for r in rows] == [(2, 0), (2, 1)]
    assert list(json.loads(rows[0]["payload"]).items()) == list(big.items())


def test_envelopes_are_whole_and_large_pages_come_in_parts(spark):
    records = spark.createDataFrame(
        [(1, i, json.dumps({"id": i})) for i in range(5)] + [(2, 0, "{}")],
        "source_page long, position long, payload string")
    landed = land_records(records, "now", "src", max_records=2)
    rows = {(r["source_page"], r["first_position"]): r["records"] for r in landed.collect()}
    assert rows == {(1, 0): ['{"id": 0}', '{"id": 1}'], (1, 2): ['{"id": 2}', '{"id": 3}'],
                    (1, 4): ['{"id": 4}'], (2, 0): ["{}"]}
    text = landed.filter("source_page = 2").select(envelope_text(
        F.col("ingestion_timestamp"), F.col("source"), F.col("source_page"), F.col("records"))).first()[0]
    assert json.loads(text) == {"ingestion_timestamp": "now", "source": "src", "source_page": 2, "records": [{}]}


def test_a_page_in_parts_keeps_its_order(spark, tmp_path):
    """Id 7 stands at positions 30 and 55 of 60: the later one wins, from the table and from files."""
    ids = [7 if i in (30, 55) else 100 + i for i in range(60)]
    records = spark.createDataFrame([(1, i, json.dumps(entry(n, episodes=i))) for i, n in enumerate(ids)],
                                    "source_page long, position long, payload string")
    config = config_in(tmp_path)
    land(spark, config, records, "t1", "a")
    assert landing_table(spark, config.landing_dir).count() == 2
    placed = read_landing(landing_table(spark, config.landing_dir))
    assert sorted(r["position"] for r in placed.collect()) == list(range(60))
    assert placed.select("file_name").distinct().count() == 2
    run_silver(spark, config, "t2", "b", layout="table")
    assert refined_table(spark, config).read().filter("id = 7").first()["episodes"] == 55

    files = land_records(records, "t1", "src").select(
        batch_filename(F.col("source_page"), F.col("first_position")).alias("name"),
        envelope_text(F.col("ingestion_timestamp"), F.col("source"), F.col("source_page"), F.col("records"),
                      F.col("first_position")).alias("text")).collect()
    folder = tmp_path / "files"
    folder.mkdir()
    for row in files:
        (folder / row["name"]).write_text(row["text"])
    assert sorted(r["name"] for r in files) == [page_name(1), "anime_catalog_batch_0001_from_000000050.json"]
    again = read_page_files(spark, str(folder))
    assert sorted((r["position"], json.loads(r["payload"])["id"]) for r in again.collect()) == list(enumerate(ids))
    assert [r["page"] for r in valid_pages(page_files(spark, str(folder))).collect()] == [1]
    (folder / files[1]["name"]).write_text('{"records": [')
    assert valid_pages(page_files(spark, str(folder))).count() == 0


def test_every_page_of_the_log_is_landed_and_counted(spark, tmp_path):
    config = config_in(tmp_path)
    bodies = [(p, 1, 200, None, page_body(p, 60 if p == 3 else 1)) for p in range(1, 31)]
    undecided = [(40, 1, 503, None, None), (41, 1, None, None, None)]
    failed = [(50, i, 500, None, None) for i in range(1, 5)]
    run_landing(spark, config, log(spark, bodies[:4]), "t1", "a")
    counts = run_landing(spark, config, log(spark, bodies + undecided + failed), "t2", "b").first().asDict()
    assert counts == {"paginas_solicitadas": 33, "paginas_saltadas_checkpoint": 4, "paginas_escritas": 26,
                      "paginas_fallidas": 1, "paginas_sin_decidir": 2}
    assert landed_pages(spark, config).count() == 30
    placed = read_landing(landing_table(spark, config.landing_dir)).filter("source_page = 3")
    assert sorted(r["position"] for r in placed.collect()) == list(range(60))


def test_landing_skips_done_pages(spark, tmp_path):
    config = config_in(tmp_path, paginas=20)
    bodies = [(p, 1, 200, None, page_body(p, 1)) for p in range(1, 21)]
    run_landing(spark, config, log(spark, bodies[:5]), "t1", "a")
    assert landed_pages(spark, config).count() == 5
    counts = run_landing(spark, config, log(spark, bodies), "t2", "b").first().asDict()
    assert counts == {"paginas_solicitadas": 20, "paginas_saltadas_checkpoint": 5,
                      "paginas_escritas": 15, "paginas_fallidas": 0, "paginas_sin_decidir": 0}
    assert landed_pages(spark, config).count() == 20
    metrics = run_silver(spark, config, "t3", "c", layout="table").first()
    assert (metrics["filas_leidas"], metrics["filas_nuevas"]) == (20, 20)


def test_a_failed_page_does_not_stop_the_run(spark, tmp_path):
    config = config_in(tmp_path, paginas=3)
    attempts = log(spark, [(1, 1, 200, None, page_body(1, 1))] + [(2, i, 503, None, None) for i in range(1, 5)]
                   + [(3, 1, 200, None, page_body(3, 1))])
    counts = run_landing(spark, config, attempts, "t1", "a").first()
    assert (counts["paginas_escritas"], counts["paginas_fallidas"]) == (2, 1)
    (failure,) = read_failures(spark, config.ledger_dir).collect()
    assert failure["page"] == 2
    assert failure["reason"] == "RetriesExhausted: Reintentos agotados: status=503"
    again = log(spark, [(2, 1, 200, None, page_body(2, 1))])
    run_landing(spark, config, again, "t2", "b")
    assert open_failures(read_failures(spark, config.ledger_dir), landed_pages(spark, config)).count() == 0


POLICY = [
    ([(429, 7.0, None), (200, None, "{}")], "ok", 2, 7.0),
    ([(429, None, None), (200, None, "{}")], "ok", 2, 1.0),
    ([(503, None, None), (500, None, None), (200, None, "{}")], "ok", 3, 2.0 + 4.0),
    ([(None, None, None), (200, None, "{}")], "ok", 2, 2.0),
    ([(403, None, "Temporarily DISABLED today"), (200, None, "{}")], "ok", 2, 2.0),
    ([(403, None, "no"), (200, None, "{}")], "other_status", 1, 0.0),
    ([(404, None, None)], "other_status", 1, 0.0),
    ([(503, None, None)] * 4, "exhausted", 4, 2.0 + 4.0 + 8.0),
    ([(503, None, None)] * 4 + [(200, None, "{}")], "exhausted", 4, 14.0),
    ([(503, None, None)], "undecided", 1, 2.0),
]


def test_retry_policy(spark):
    steps = [(page, i + 1, *step) for page, case in enumerate(POLICY) for i, step in enumerate(case[0])]
    rows = fetch_outcomes(log(spark, steps)).orderBy("page").collect()
    assert [(r["outcome"], r["attempts"], r["wait_seconds"]) for r in rows] == [case[1:] for case in POLICY]


def test_errors_are_looked_at_before_data(spark):
    bodies = spark.createDataFrame([
        (1, '{"errors":[{"message":"m"}],"data":{"Page":{"media":[{"id":1}]}}}'),
        (2, '{"errors":[],"data":{"Page":{"media":[{"id":1},{"id":2}]}}}'),
        (3, '{"data":{"Page":{"media":[]}}}'), (4, "<html>"), (5, None), (6, '{"data":null}')], "n long, body string")
    rows = {r["n"]: (r["route"], r["errors"], r["records"]) for r in route_responses(bodies).collect()}
    assert rows[1] == ("query_error", '[{"message":"m"}]', None)
    assert rows[2] == ("page", None, ['{"id":1}', '{"id":2}'])
    assert rows[3] == ("page", None, [])
    assert {rows[n][0] for n in (4, 5, 6)} == {"unreadable"}


def test_pacing(spark):
    second = 1_000_000
    rows = [("c", 1_000_000 * second, 3, 1_000_030 * second), ("c", 1_000_000 * second + 400_000, 50, 1_000_100 * second),
            ("c", 1_000_010 * second, None, 1_000_100 * second), ("d", 1_000_010 * second, 3, None)]
    audit = pacing_audit(spark.createDataFrame(
        rows, "client string, ts_micros long, remaining long, reset_micros long")).orderBy("client", "ts_micros").collect()
    assert [r["brake_seconds"] for r in audit] == [30.0, 0.0, 0.0, 0.0]
    assert [r["too_soon"] for r in audit] == [False, True, False, False]
    assert [r["owed_pause"] for r in audit] == [0.0, 0.6, 0.0, 0.0]
    assert [r["gap_seconds"] for r in audit] == [None, 0.4, 9.6, None]


def test_previous_time_across_slices(spark):
    times = [0, 5, 9, 10, 11, 35, 36, 100]
    df = spark.createDataFrame([("k", t) for t in times] + [(None, 3)], "key string, t long")
    rows = [(r["t"], r["previous"]) for r in previous_time(df, "key", "t", 10).filter("key = 'k'")
            .orderBy("t").collect()]
    assert rows == list(zip(times, [None, *times[:-1]]))
    assert previous_time(df, "key", "t", 10).count() == len(times) + 1
    burst = [*range(200, 260), 260, 260, 900, 901]
    crowded = spark.createDataFrame([("k", t) for t in times + burst], "key string, t long")
    rows = [(r["t"], r["previous"]) for r in previous_time(crowded, "key", "t", 100, slice_rows=7).orderBy("t", "previous").collect()]
    assert rows == list(zip(times + burst, [None, *times, *burst][:-1]))


def test_config_prefers_arguments_then_environment(monkeypatch):
    monkeypatch.setenv("PAGINAS", "7")
    monkeypatch.setenv("SEARCH_K", "3")
    config = from_args(["--min-desc-len", "10"])
    assert (config.paginas, config.k, config.min_desc_len, config.per_page) == (7, 3, 10, 50)
    assert from_args(["--k", "9"]).k == 9
    monkeypatch.delenv("PAGINAS")
    assert from_args([]).paginas is None


def test_settings_of_the_pacing_act(spark):
    rows = [("c", 0, 3, 9_000_000), ("c", 1_500_000, 7, 9_000_000)]
    requests = spark.createDataFrame(rows, "client string, ts_micros long, remaining long, reset_micros long")
    audit = audit_pacing(JobConfig(pausa_base=2.0, umbral_remaining=5), requests).orderBy("ts_micros").collect()
    assert [r["owed_pause"] for r in audit] == [0.0, 0.5]
    assert [r["brake_seconds"] for r in audit] == [9.0, 0.0]


def test_settings_are_checked():
    with pytest.raises(ValueError):
        JobConfig(k=0)
