"""Raw entries and landed page files for the tests."""

from __future__ import annotations

import json
from pathlib import Path

from shelfmark.operators.contract import FIELDS

STAMP = "2024-05-01T10:00:00+00:00"


SAMPLES = {"integer": 12, "text": "sample", "texts": ["one", "two"], "names": [{"name": "maker"}]}


def entry(id, description="x" * 80, **changes):
    """A valid raw entry, built from the contract: a sample of its kind at the place of each field."""
    raw = {"id": id}
    for field in FIELDS[1:]:
        *parents, name = field.path.removeprefix("$.").split(".")
        place = raw
        for parent in parents:
            place = place.setdefault(parent, {})
        place[name] = SAMPLES[field.kind]
    raw["title"]["romaji"] = f"Entry {id}"
    raw["description"] = description
    return raw | changes


def page_name(page: int) -> str:
    return f"anime_catalog_batch_{page:04d}.json"


def write_page(folder, page: int, records, stamp: str = STAMP) -> Path:
    folder = Path(folder)
    folder.mkdir(parents=True, exist_ok=True)
    path = folder / page_name(page)
    envelope = {"ingestion_timestamp": stamp, "source": "test", "source_page": page, "records": records}
    path.write_text(json.dumps(envelope, ensure_ascii=False, indent=2), encoding="utf-8")
    return path


def payloads(spark, records, stamp: str | None = STAMP):
    rows = [(i, r if isinstance(r, str) else json.dumps(r), stamp) for i, r in enumerate(records)]
    return spark.createDataFrame(rows, "n long, payload string, ingestion_timestamp string")


def page_body(page: int, n: int) -> str:
    return json.dumps({"data": {"Page": {"pageInfo": {"currentPage": page}, "media": [
        entry(page * 1000 + i) for i in range(n)]}}})


LOG_SCHEMA = "page long, attempt int, status int, retry_after double, body string"
