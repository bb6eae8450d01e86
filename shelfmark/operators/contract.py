"""Data contract for raw catalogue entries: flatten, check, route."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import clean_description
from ..schemas import REFINED_COLUMNS


@dataclass(frozen=True)
class Field:
    name: str
    path: str
    kind: str
    required: bool = False


# Where each column lies in a raw entry, and its type, in table order.
FIELDS = [
    Field("id", "$.id", "integer", required=True),
    Field("id_mal", "$.idMal", "integer"),
    Field("title_romaji", "$.title.romaji", "text", required=True),
    Field("title_english", "$.title.english", "text"),
    Field("title_native", "$.title.native", "text"),
    Field("format", "$.format", "text"),
    Field("status", "$.status", "text"),
    Field("episodes", "$.episodes", "integer"),
    Field("duration", "$.duration", "integer"),
    Field("season", "$.season", "text"),
    Field("season_year", "$.seasonYear", "integer"),
    Field("average_score", "$.averageScore", "integer"),
    Field("popularity", "$.popularity", "integer"),
    Field("favourites", "$.favourites", "integer"),
    Field("genres", "$.genres", "texts"),
    Field("studios", "$.studios.nodes", "names"),
    Field("start_year", "$.startDate.year", "integer"),
    Field("start_month", "$.startDate.month", "integer"),
    Field("start_day", "$.startDate.day", "integer"),
    Field("end_year", "$.endDate.year", "integer"),
    Field("end_month", "$.endDate.month", "integer"),
    Field("end_day", "$.endDate.day", "integer"),
]
PARENTS = {"title": "$.title", "studios": "$.studios", "startDate": "$.startDate", "endDate": "$.endDate"}

# JSON texts that count as "nothing there" where a nested value is expected.
EMPTY_JSON = ["null", "false", "0", "0.0", '""', "[]", "{}"]
_EMPTY_SQL = ", ".join(f"'{text}'" for text in EMPTY_JSON)

INTEGERS = [f for f in FIELDS if f.kind == "integer"]
TEXTS = [f for f in FIELDS if f.kind == "text"]

# Fields of one kind are handled as one array with a lambda over it. Written out field by field,
# the same rules generate methods too large for the JVM to compile.


def _node(path: str) -> str:
    return f"try_variant_get(__document, '{path}', 'variant')"


def _nodes(paths) -> str:
    return f"array({', '.join(_node(path) for path in paths)})"


def _kind(node: str) -> str:
    """Variant type name; missing and JSON null are both 'VOID'."""
    return f"coalesce(schema_of_variant({node}), 'VOID')"


def _is_empty(node: str, kind: str) -> str:
    return f"({kind} = 'VOID' OR to_json({node}) IN ({_EMPTY_SQL}))"


def lenient_integer(node: str, kind: str) -> str:
    """Whole number from an integer, a boolean, a fraction-free number or a numeric text; else null."""
    text = f"trim(try_variant_get({node}, '$', 'string'))"
    number = f"try_variant_get({node}, '$', 'double')"
    exact = f"try_variant_get({node}, '$', 'decimal(38,10)')"
    return rf"""CASE
        WHEN {kind} IN ('BIGINT', 'BOOLEAN') THEN try_variant_get({node}, '$', 'bigint')
        WHEN {kind} = 'STRING' THEN
          CASE WHEN {text} RLIKE r'^[+-]?[0-9]+(_[0-9]+)*(\.0*)?$'
               THEN try_cast(regexp_replace({text}, r'\.0*$|_', '') AS BIGINT) END
        WHEN startswith({kind}, 'DECIMAL') THEN
          CASE WHEN {number} = floor({number}) AND {exact} = floor({exact}) THEN try_cast({exact} AS BIGINT) END
        WHEN {kind} IN ('DOUBLE', 'FLOAT') THEN
          CASE WHEN {number} = floor({number}) AND abs({number}) < 9.2e18 THEN try_cast({number} AS BIGINT) END
        END"""


def _strict_text(node: str, kind: str) -> str:
    return f"CASE WHEN {kind} = 'STRING' THEN try_variant_get({node}, '$', 'string') END"


def _list_of_texts(node: str) -> str:
    """List of texts; an empty or missing value is the empty list, any other shape null."""
    elements, kind = f"try_variant_get({node}, '$', 'array<variant>')", _kind(node)
    return f"""CASE
        WHEN startswith({kind}, 'ARRAY') THEN
          CASE WHEN forall({elements}, x -> {_kind("x")} = 'STRING')
               THEN try_variant_get({node}, '$', 'array<string>') END
        WHEN {_is_empty(node, kind)} THEN CAST(array() AS ARRAY<STRING>)
        END"""


def _list_of_names(node: str) -> str:
    """The non-empty `name` of each non-empty node; null when a node or a name has the wrong type."""
    elements, kind = f"try_variant_get({node}, '$', 'array<variant>')", _kind(node)
    filled = f"filter({elements}, x -> NOT {_is_empty('x', _kind('x'))})"
    name = "try_variant_get(x, '$.name', 'variant')"
    sound = (f"forall({filled}, x -> startswith({_kind('x')}, 'OBJECT') "
             f"AND ({_kind(name)} = 'STRING' OR {_is_empty(name, _kind(name))}))")
    named = f"filter({filled}, x -> NOT {_is_empty(name, _kind(name))})"
    return f"""CASE
        WHEN startswith({kind}, 'ARRAY') THEN
          CASE WHEN {sound} THEN transform({named}, x -> try_variant_get(x, '$.name', 'string')) END
        WHEN {_is_empty(node, kind)} THEN CAST(array() AS ARRAY<STRING>)
        END"""


def _with(df: DataFrame, expressions: dict[str, str]) -> DataFrame:
    return df.withColumns({name: F.expr(text) for name, text in expressions.items()})


def flatten_entry(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Add one typed column per contract field, parsed from the JSON text in `payload`.

    A value of the wrong type becomes null here; `check_contract` names the field. Helper
    columns (all starting with `__`) stay for it.
    """
    parsed = df.withColumn("__document", F.try_parse_json(payload))
    lists = {f.name: f for f in FIELDS if f.kind in ("texts", "names")}
    parsed = _with(parsed, {
        "__integer_nodes": _nodes(f.path for f in INTEGERS),
        "__text_nodes": _nodes(f.path for f in TEXTS),
        **{f"__{name}": _node(f.path) for name, f in lists.items()}})
    parsed = _with(parsed, {
        "__integer_kinds": f"transform(__integer_nodes, n -> {_kind('n')})",
        "__text_kinds": f"transform(__text_nodes, n -> {_kind('n')})"})
    parsed = _with(parsed, {
        "__integers": f"zip_with(__integer_nodes, __integer_kinds, (n, k) -> {lenient_integer('n', 'k')})",
        "__texts": f"zip_with(__text_nodes, __text_kinds, (n, k) -> {_strict_text('n', 'k')})",
        **{name: (_list_of_texts if f.kind == "texts" else _list_of_names)(f"__{name}")
           for name, f in lists.items()}})
    return _with(parsed, {
        **{f.name: f"__integers[{i}]" for i, f in enumerate(INTEGERS)},
        **{f.name: f"__texts[{i}]" for i, f in enumerate(TEXTS)}})


def _errors(fields: list[Field], kinds: str, values: str, message: str) -> str:
    """Messages for the fields whose value is null though present, or null though required."""
    names = ", ".join(f"'{f.name}'" for f in fields)
    required = ", ".join(str(f.required).lower() for f in fields)
    wrong = f"{values}[i] IS NULL AND ({kinds}[i] <> 'VOID' OR array({required})[i])"
    return (f"transform(filter(sequence(0, {len(fields) - 1}), i -> {wrong}), "
            f"i -> concat(array({names})[i], ': {message}'))")


def check_contract(df: DataFrame, min_desc_len: int = 50, payload: str = "payload") -> DataFrame:
    """Clean, flatten and check raw entries; `motivo_rechazo` is null for a valid row.

    `df` holds `payload` (JSON text) and `ingestion_timestamp`; its other columns pass through.
    One reason per row: unreadable shape, then length after cleaning, then misplaced nesting,
    then the list of fields that break their type.
    """
    flat = flatten_entry(df, payload)
    flat = _with(flat, {"__raw": _node("$.description"), "__parents": _nodes(PARENTS.values())})
    flat = _with(flat, {"__raw_kind": _kind("__raw")})
    flat = _with(flat, {"__raw_text": _strict_text("__raw", "__raw_kind")})
    flat = clean_description(flat, "__raw_text", "description")
    parent_names = ", ".join(f"'{name}'" for name in PARENTS)
    misplaced = (f"NOT startswith({_kind('__parents[i]')}, 'OBJECT') "
                 f"AND NOT {_is_empty('__parents[i]', _kind('__parents[i]'))}")
    flat = _with(flat, {
        "__misplaced": f"""array_join(transform(filter(sequence(0, {len(PARENTS) - 1}), i -> {misplaced}),
            i -> concat(array({parent_names})[i], ': object expected')), '; ')""",
        "__broken": f"""concat_ws('; ',
            {_errors(INTEGERS, '__integer_kinds', '__integers', 'integer expected')},
            {_errors(TEXTS, '__text_kinds', '__texts', 'text expected')},
            CASE WHEN title_romaji = '' THEN 'title_romaji: non-empty text expected' END,
            CASE WHEN genres IS NULL THEN 'genres: list of texts expected' END,
            CASE WHEN studios IS NULL THEN 'studios: list of named objects expected' END,
            CASE WHEN ingestion_timestamp IS NULL THEN 'ingestion_timestamp: text expected' END)""",
    })
    # Fixed texts: the length reason and how the list of type errors begins, word for word.
    reason = f"""CASE
        WHEN NOT startswith({_kind("__document")}, 'OBJECT') THEN 'Malformed record: JSON object expected'
        WHEN __raw_kind <> 'STRING' AND NOT {_is_empty("__raw", "__raw_kind")}
          THEN 'Malformed record: description: text expected'
        WHEN length(description) < {int(min_desc_len)} THEN concat('description tiene ', length(description),
          ' caracteres tras limpieza HTML, mínimo requerido {int(min_desc_len)}')
        WHEN __misplaced <> '' THEN concat('Malformed record: ', __misplaced)
        WHEN __broken <> '' THEN concat('Pydantic ValidationError: ', __broken)
        END"""
    passed_on = [F.col(c) for c in df.columns if c not in REFINED_COLUMNS]
    typed = [F.col(c) for c in REFINED_COLUMNS if c != "content_hash"]
    # The one-element explode stops a later filter on the verdict from being pushed below all
    # of the above, which would repeat the whole check inside the filter.
    return flat.select(*typed, *passed_on, F.expr(f"explode(array({reason}))").alias("motivo_rechazo"))


def valid_rows(checked: DataFrame) -> DataFrame:
    return checked.filter(F.col("motivo_rechazo").isNull())


def rejected_rows(checked: DataFrame) -> DataFrame:
    return checked.filter(F.col("motivo_rechazo").isNotNull())
