import json

from entries import entry, payloads
from shelfmark.operators.contract import check_contract, rejected_rows, valid_rows
from shelfmark.sources.journal import write_quarantine, current_quarantine, quarantine_rows, read_quarantine


def check_one(spark, record, stamp="2024-05-01T10:00:00+00:00"):
    return check_contract(payloads(spark, [record], stamp)).first()


def test_valid_entry_passes_with_all_columns(spark):
    row = check_one(spark, entry(7, description="<i>Some</i> words &amp; more" + " text" * 20))
    assert row["motivo_rechazo"] is None
    assert (row["id"], row["title_romaji"], row["episodes"], row["season_year"]) == (7, "Entry 7", 12, 12)
    assert (row["genres"], row["studios"]) == (["one", "two"], ["maker"])
    assert (row["start_month"], row["end_day"]) == (12, 12)
    assert row["description"].startswith("Some words & more text")


def test_missing_id_is_quarantined_with_its_payload(spark, tmp_path):
    record = entry(1)
    del record["id"]
    checked = check_contract(payloads(spark, [record]))
    write_quarantine(quarantine_rows(rejected_rows(checked), "now", "run"), str(tmp_path / "q"))
    (row,) = read_quarantine(spark, str(tmp_path / "q")).collect()
    assert "id" in row["motivo_rechazo"] and row["motivo_rechazo"].startswith("Pydantic ValidationError: ")
    assert json.loads(row["payload_original"]) == record
    assert valid_rows(checked).count() == 0


def test_empty_description_is_rejected_by_length(spark):
    row = check_one(spark, entry(1, description=""))
    assert row["motivo_rechazo"] == "description tiene 0 caracteres tras limpieza HTML, mínimo requerido 50"


def test_length_is_judged_first_and_counts_code_points(spark):
    row = check_one(spark, entry("x", description="😀" * 49))
    assert row["motivo_rechazo"] == "description tiene 49 caracteres tras limpieza HTML, mínimo requerido 50"
    assert check_one(spark, entry(1, description="😀" * 50))["motivo_rechazo"] is None


def test_null_secondary_id_is_fine(spark):
    row = check_one(spark, entry(1, idMal=None))
    assert row["motivo_rechazo"] is None and row["id_mal"] is None


INTEGERS = [
    (5, 5), ("5", 5), (5.0, 5), (True, 1), (" 12 ", 12), ("1_000", 1000), ("4.0", 4), ("-3", -3), (1e3, 1000),
    (2.5, None), ("2.5", None), ("many", None), ("true", None), ([1], None), ({"a": 1}, None), ("", None),
    (123456789012345678901234567890, None), (2**63 - 1, 2**63 - 1), (2**63, None), (2.00000000000001, None),
]
WRONG_TYPES = [
    ({"format": 5}, "format"), ({"title": {"romaji": ""}}, "title_romaji"), ({"title": {}}, "title_romaji"),
    ({"title": None}, "title_romaji"), ({"genres": ["a", None]}, "genres"), ({"genres": "a"}, "genres"),
    ({"genres": {"a": 1}}, "genres"), ({"studios": {"nodes": [{"name": 5}]}}, "studios"),
    ({"studios": {"nodes": ["x"]}}, "studios"), ({"startDate": {"year": "soon"}}, "start_year"),
]
ABSENT_PARTS = [
    ({"genres": None, "studios": None}, [], []),
    ({"genres": [], "studios": {"nodes": None}}, [], []),
    ({"genres": "", "studios": {}}, [], []),
    ({"studios": {"nodes": [None, {}, {"name": None}, {"name": ""}, {"name": "A"}]}}, ["one", "two"], ["A"]),
    ({"startDate": None, "endDate": None}, ["one", "two"], ["maker"]),
]
MALFORMED = [
    "[1, 2]", '"text"', "5", "not json", entry(1, description=5), entry(1, description=["x"]),
    entry(1, title="name"), entry(1, studios=[1]), entry(1, startDate="2020"),
]


def check_all(spark, records):
    return check_contract(payloads(spark, records)).orderBy("n").collect()


def test_integers_are_read_leniently(spark):
    for (given, value), row in zip(INTEGERS, check_all(spark, [entry(1, episodes=g) for g, _ in INTEGERS])):
        assert row["episodes"] == value, given
        reason = None if value is not None else "Pydantic ValidationError: episodes: integer expected"
        assert row["motivo_rechazo"] == reason, given


def test_wrong_types_name_the_field(spark):
    for (changes, named), row in zip(WRONG_TYPES, check_all(spark, [entry(1, **c) for c, _ in WRONG_TYPES])):
        assert row["motivo_rechazo"].startswith("Pydantic ValidationError: "), changes
        assert f"{named}: " in row["motivo_rechazo"], changes


def test_absent_parts_are_tolerated(spark):
    rows = check_all(spark, [entry(1, **changes) for changes, _, _ in ABSENT_PARTS])
    for (changes, genres, studios), row in zip(ABSENT_PARTS, rows):
        assert row["motivo_rechazo"] is None, changes
        assert (row["genres"], row["studios"]) == (genres, studios), changes


def test_malformed_shapes_are_quarantined(spark):
    for record, row in zip(MALFORMED, check_all(spark, MALFORMED)):
        assert row["motivo_rechazo"].startswith("Malformed record: "), record


def test_all_broken_fields_are_listed(spark):
    reason = check_one(spark, entry(None, episodes="x", format=1), stamp=None)["motivo_rechazo"]
    for field in ("id", "episodes", "format", "ingestion_timestamp"):
        assert f"{field}: " in reason


def test_current_quarantine_has_one_row_per_payload(spark, tmp_path):
    rejected = rejected_rows(check_contract(payloads(spark, [entry(1, description=""), entry(2, description="")])))
    for run in ("run_1", "run_2"):
        write_quarantine(quarantine_rows(rejected, f"at {run}", run), str(tmp_path / "q"))
    journal = read_quarantine(spark, str(tmp_path / "q"))
    assert journal.count() == 4
    current = current_quarantine(journal).collect()
    assert len(current) == 2 and {r["run_id"] for r in current} == {"run_2"}
