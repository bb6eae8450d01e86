import sys
from pathlib import Path

import pytest
from cases import SMALL

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import __spark_entry__ as driver  # noqa: E402
from compare import connect, difference  # noqa: E402
from shelfmark.llm.queries import QUERIES  # noqa: E402

ROWS = {"op1": "conversations", "op10": "pages"}


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


def test_all_are_registered():
    names = [n for n in driver.queries() if n.startswith("op") and n[2].isdigit() or n == "pipeline"]
    assert [n.split("_")[0] for n in names] == [*(f"op{k}" for k in range(1, 14)), "pipeline"]


@pytest.mark.parametrize("name", QUERIES)
def test_whole_tables(spark, duck, name):
    query, sql = QUERIES[name]
    got = query(spark, SMALL)
    if sql is not None:
        assert difference(got, sql, duck) is None
    elif name.startswith("op2_"):
        assert got.select("doc_id").distinct().count() == spark.read.parquet(f"{SMALL}/documents.parquet").count()
    else:
        table = ROWS.get(name.split("_")[0], "documents")
        assert got.count() == spark.read.parquet(f"{SMALL}/{table}.parquet").count()
