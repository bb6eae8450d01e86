import json

import pytest

from entries import LOG_SCHEMA, entry, page_body, write_page
from shelfmark.__main__ import main


def test_jobs_from_the_command_line(spark, tmp_path):
    places = [f"--{kind}-dir={tmp_path / kind}" for kind in ("bronze", "silver", "gold", "reports", "scratch")]
    write_page(tmp_path / "bronze", 1, [entry(k, description=f"words of entry number {k} " * 4) for k in range(6)])
    stamp = ["--as-of", "2024-05-02"]
    assert main(["silver", *stamp, *places]) == 0
    assert main(["gold", *stamp, *places]) == 0
    (tmp_path / "queries.json").write_text(json.dumps({"query_id": 1, "text": "entry number 3"}))
    found = str(tmp_path / "found")
    assert main(["search", *stamp, *places, "--k=2", f"--queries={tmp_path / 'queries.json'}", f"--out={found}"]) == 0
    assert [r["id"] for r in spark.read.parquet(found).orderBy("rank").collect()][0] == 3
    assert main(["index", *stamp, *places, "--index=codes"]) == 0
    assert main(["search", *stamp, *places, "--k=2", "--index=codes", f"--queries={tmp_path / 'queries.json'}", f"--out={found}2"]) == 0
    assert spark.read.parquet(f"{found}2").exceptAll(spark.read.parquet(found)).count() == 0
    assert main(["rebuild", *stamp, *places]) == 0
    assert main(["stream", *stamp, *places]) == 0
    log = spark.createDataFrame([(7, 1, 200, None, page_body(7, 3))], LOG_SCHEMA)
    log.write.parquet(str(tmp_path / "log"))
    assert main(["land", *stamp, *places, f"--attempts={tmp_path / 'log'}"]) == 0
    assert main(["silver", *stamp, *places, "--layout=table"]) == 0
    assert main(["gold", *stamp, *places, "--delta-on=feed"]) == 0
    assert main(["all", *stamp, *places]) == 0
    assert (tmp_path / "reports" / "execution_report.md").read_text(encoding="utf-8").startswith("# ")


@pytest.mark.parametrize("command", ["search", "land", "index", "pacing"])
def test_commands_need_their_files(command):
    with pytest.raises(SystemExit):
        main([command, "--as-of", "x"])
