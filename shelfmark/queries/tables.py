"""The given tables, and the catalogue-shaped views the registered queries run on.

Each view is derived from whole tables. `CATALOGUE_SQL` and the like are their SQL twins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.paths import spread

AS_OF, LATER = "2024-01-01T00:00:00+00:00", "2024-02-01T00:00:00+00:00"
PAGE_SIZE = 50


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quoted(text: Column) -> Column:
    """JSON text of a string."""
    return F.to_json(text.cast("variant"))


def _case(column: str, cases: dict[str, Column], otherwise: Column) -> Column:
    picked = F.when(F.lit(False), otherwise)
    for value, result in cases.items():
        picked = picked.when(F.col(column) == value, result)
    return picked.otherwise(otherwise)


def catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as raw catalogue entries; some sources deliver them with a defect.

    Columns `doc_id, source_page, file_name, position, ingestion_timestamp, payload`.
    """
    # Dealt out by the key of the join, which then moves no text a second time once the labels are too large to broadcast; nor
    # does it sort any.
    documents = spread(table(spark, sf_dir, "documents"), "doc_id")
    labels = table(spark, sf_dir, "labels").hint("shuffle_hash")
    rows = documents.join(labels, "doc_id", "left")
    number = F.col("doc_id").cast("string")
    id_pair = _case("source", {
        "src3": F.lit(""),
        "src5": F.concat(F.lit('"id":"'), number, F.lit('",')),
        "src7": F.concat(F.lit('"id":'), number, F.lit(".0,")),
        "src9": F.concat(F.lit('"id":'), number, F.lit(".5,")),
    }, F.concat(F.lit('"id":'), number, F.lit(",")))
    word = F.regexp_extract("text", r"^[^ \n]*", 0)
    title = _case("source", {
        "src11": F.lit('{"romaji":""}'),
        "src15": quoted(word),
    }, F.concat(F.lit('{"romaji":'), quoted(word), F.lit(',"english":null,"native":'),
                quoted(F.col("source")), F.lit("}")))
    episodes = _case("source", {"src13": F.lit('"many"')}, F.col("n_chars").cast("string"))
    genres = F.concat(F.lit("["), quoted(F.col("lang")),
                      _case("source", {"src17": F.lit(",null")}, F.lit("")), F.lit("]"))
    description = _case("source", {"src19": F.lit("null")},
                        quoted(F.regexp_replace("text", "\n", "<br>")))
    entry = F.concat(
        F.lit("{"), id_pair,
        F.lit('"idMal":'), F.coalesce(F.col("quality").cast("string"), F.lit("null")),
        F.lit(',"title":'), title,
        F.lit(',"format":'), quoted(F.col("lang")),
        F.lit(',"episodes":'), episodes,
        F.lit(',"popularity":'), F.coalesce(F.col("toxic").cast("string"), F.lit("null")),
        F.lit(',"genres":'), genres,
        F.lit(',"studios":{"nodes":[{"name":'), quoted(F.col("source")), F.lit('},null,{"name":""}]}'),
        F.lit(',"startDate":{"year":'), F.col("n_chars").cast("string"), F.lit(',"month":true},"endDate":null'),
        F.lit(',"description":'), description, F.lit("}"))
    payload = _case("source", {"src2": F.concat(F.lit("["), entry, F.lit("]"))}, entry)
    page = (F.floor(F.col("doc_id") / PAGE_SIZE) + 1).cast("bigint")
    return rows.select(
        "doc_id", page.alias("source_page"),
        F.format_string("anime_catalog_batch_%04d.json", page).alias("file_name"),
        (F.col("doc_id") - (page - 1) * PAGE_SIZE).cast("bigint").alias("position"),
        F.lit(AS_OF).alias("ingestion_timestamp"), payload.alias("payload"))


_ENTRY_SQL = """
'{' || CASE source WHEN 'src3' THEN '' WHEN 'src5' THEN '"id":"' || doc_id || '",'
            WHEN 'src7' THEN '"id":' || doc_id || '.0,' WHEN 'src9' THEN '"id":' || doc_id || '.5,'
            ELSE '"id":' || doc_id || ',' END
|| '"idMal":' || coalesce(quality::VARCHAR, 'null')
|| ',"title":' || CASE source WHEN 'src11' THEN '{"romaji":""}' WHEN 'src15' THEN to_json(word)::VARCHAR
     ELSE '{"romaji":' || to_json(word)::VARCHAR || ',"english":null,"native":"' || source || '"}' END
|| ',"format":"' || lang || '","episodes":' || CASE source WHEN 'src13' THEN '"many"' ELSE n_chars::VARCHAR END
|| ',"popularity":' || coalesce(toxic::VARCHAR, 'null')
|| ',"genres":["' || lang || '"' || CASE source WHEN 'src17' THEN ',null' ELSE '' END
|| '],"studios":{"nodes":[{"name":"' || source || '"},null,{"name":""}]}'
|| ',"startDate":{"year":' || n_chars || ',"month":true},"endDate":null,"description":'
|| CASE source WHEN 'src19' THEN 'null' ELSE to_json(replace(text, chr(10), '<br>'))::VARCHAR END || '}'
"""

# Entities that occur in the given tables; `&amp` last, so nothing is decoded twice.
_SPACE_SQL = (r"[\s\x{0B}\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}"
              r"\x{205F}\x{3000}]")


def clean_sql(text: str) -> str:
    bare = (f"regexp_replace(regexp_replace(coalesce({text}, ''), '<br{_SPACE_SQL}*/?>', ' ', 'gi'),"
            " '<[^>]+>', '', 'g')")
    decoded = (f"regexp_replace(replace(replace(replace({bare}, '&copy;', '©'), '&middot;', '·'),"
               " '&quot;', '\"'), '&amp;?', '&', 'g')")
    return f"trim(regexp_replace({decoded}, '{_SPACE_SQL}+', ' ', 'g'))"


# The catalogue as text, then read back with JSON functions and judged field by field.
CATALOGUE_SQL = f"""
labelled AS (
  SELECT d.*, l.quality, l.toxic, regexp_extract(d.text, '^[^ \\n]*') AS word
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
entries AS (
  SELECT doc_id, source, doc_id // {PAGE_SIZE} + 1 AS source_page, doc_id % {PAGE_SIZE} AS position,
         CASE source WHEN 'src2' THEN '[' || entry || ']' ELSE entry END AS payload
  FROM (SELECT *, {_ENTRY_SQL} AS entry FROM labelled)),
opened AS (
  SELECT *, json_type(payload) AS root, json_type(payload, '$.id') AS id_type,
         json_extract_string(payload, '$.id') AS id_text, json_type(payload, '$.title') AS title_type,
         json_extract_string(payload, '$.title.romaji') AS title_romaji,
         json_type(payload, '$.episodes') AS episodes_type,
         list_contains(json_type(payload, '$.genres[*]'), 'NULL') AS null_genre,
         {clean_sql("json_extract_string(payload, '$.description')")} AS description
  FROM entries),
typed AS (
  SELECT *, CASE WHEN id_type IN ('UBIGINT', 'BIGINT') THEN id_text::BIGINT
                 WHEN id_type = 'VARCHAR' THEN TRY_CAST(id_text AS BIGINT)
                 WHEN id_type = 'DOUBLE' AND id_text::DOUBLE = floor(id_text::DOUBLE)
                   THEN id_text::DOUBLE::BIGINT END AS id
  FROM opened),
judged AS (
  SELECT *, CASE
    WHEN root <> 'OBJECT' THEN 'Malformed record: JSON object expected'
    WHEN length(description) < 50 THEN 'description tiene ' || length(description)
         || ' caracteres tras limpieza HTML, mínimo requerido 50'
    WHEN title_type = 'VARCHAR' AND json_extract_string(payload, '$.title') <> ''
         THEN 'Malformed record: title: object expected'
    WHEN id IS NULL OR coalesce(title_romaji, '') = '' OR episodes_type = 'VARCHAR' OR null_genre
         THEN 'Pydantic ValidationError: ' || concat_ws('; ',
              CASE WHEN id IS NULL THEN 'id: integer expected' END,
              CASE WHEN coalesce(title_romaji, '') = '' THEN 'title_romaji: non-empty text expected' END,
              CASE WHEN episodes_type = 'VARCHAR' THEN 'episodes: integer expected' END,
              CASE WHEN null_genre THEN 'genres: list of texts expected' END)
    END AS motivo_rechazo
  FROM typed)
"""


def request_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events read as page requests: user = page, time = order, type and value = response."""
    kind, value = F.col("event_type"), F.col("value")
    status = (F.when(kind == "error", F.lit(503)).when(kind == "signup", F.lit(429))
              .when(kind == "view", F.lit(403)).otherwise(F.lit(200)))
    page_body = F.concat(
        F.lit('{"data":{"Page":{"media":[{"id":'), F.col("event_id").cast("string"),
        F.lit(',"kind":"'), kind, F.lit('"},{"id":'), F.col("user_id").cast("string"), F.lit("}]}}}"))
    body = (F.when(kind == "view", F.when(value < 50, F.lit("API Temporarily Disabled")).otherwise(F.lit("no")))
            .when((kind == "purchase") & (value < 20), F.lit('{"errors":[{"message":"bad query"}],"data":null}'))
            .when(kind.isin("purchase", "click"), page_body))
    return table(spark, sf_dir, "events").select(
        (F.col("user_id") + 1).alias("page"), "ts", "event_id", status.alias("status"),
        F.when(kind == "signup", value).alias("retry_after"), body.alias("body"))


REQUEST_LOG_SQL = """
log AS (
  SELECT user_id + 1 AS page, ts, event_id,
         CASE event_type WHEN 'error' THEN 503 WHEN 'signup' THEN 429 WHEN 'view' THEN 403 ELSE 200 END AS status,
         CASE WHEN event_type = 'signup' THEN value END AS retry_after,
         CASE WHEN event_type = 'view' AND value < 50 THEN 'API Temporarily Disabled'
              WHEN event_type = 'view' THEN 'no'
              WHEN event_type = 'purchase' AND value < 20 THEN '{"errors":[{"message":"bad query"}],"data":null}'
              WHEN event_type IN ('purchase', 'click') THEN
                '{"data":{"Page":{"media":[{"id":' || event_id || ',"kind":"' || event_type || '"},{"id":'
                || user_id || '}]}}}' END AS body, CASE WHEN json_valid(body) THEN body END AS json
  FROM events),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY page ORDER BY ts, event_id) AS attempt,
         status = 429 OR status BETWEEN 500 AND 599
         OR (status = 403 AND contains(lower(coalesce(body, '')), 'temporarily disabled')) AS retryable
  FROM log QUALIFY attempt <= 4),
outcomes AS (
  SELECT page, min(attempt) FILTER (NOT retryable) AS deciding_attempt,
         arg_min(status, attempt) FILTER (NOT retryable) AS deciding_status,
         arg_max(status, attempt) AS final_status, max(attempt) AS made
  FROM numbered GROUP BY page),
decided AS (
  SELECT o.page, CASE WHEN deciding_status = 200 THEN 'ok' WHEN deciding_attempt IS NOT NULL THEN 'other_status'
                      WHEN made >= 4 THEN 'exhausted' ELSE 'undecided' END AS outcome,
         coalesce(deciding_attempt, made) AS attempts, deciding_attempt,
         coalesce(deciding_status, final_status) AS last_status
  FROM outcomes o),
results AS (
  SELECT d.page, coalesce(json_extract(n.json, '$.data.Page.media') IS NOT NULL, false) AS landed,
         CASE WHEN d.deciding_attempt IS NULL THEN 'RetriesExhausted: Reintentos agotados: status=' || d.last_status
              WHEN n.json IS NULL THEN 'UnreadableBody: status=' || d.last_status
              WHEN json_type(n.json, '$.errors') = 'ARRAY'
                THEN 'QueryError: ' || json_extract(n.json, '$.errors')::VARCHAR END AS reason,
         json_array_length(n.json, '$.data.Page.media') AS n_records
  FROM decided d LEFT JOIN numbered n ON n.page = d.page AND n.attempt = d.deciding_attempt
  WHERE d.outcome <> 'undecided')
"""


def merge_sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Target: labelled documents and all pages as stored earlier. Source: all documents, delivered now."""
    from ..functions.hashing import content_hash

    documents = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")
    labels = table(spark, sf_dir, "labels").withColumnRenamed("doc_id", "id")
    pages = table(spark, sf_dir, "pages")

    def row(status, arrived):
        return ["id", status.alias("status"), F.col("text").alias("description"),
                F.lit(arrived).alias("ingestion_timestamp")]

    stored = documents.join(labels, "id").select(
        *row(F.concat(F.lit("q"), F.col("quality").cast("string")), AS_OF))
    old = pages.select((-F.col("page_id") - 1).alias("id"), F.col("url").alias("text")).select(
        *row(F.lit("page"), AS_OF))
    fresh = documents.join(labels, "id", "left").select(
        *row(F.coalesce(F.concat(F.lit("q"), F.col("toxic").cast("string")), F.lit("none")), LATER))
    hashed = content_hash(["id", "status", "description"])
    return (stored.unionByName(old).withColumn("content_hash", hashed),
            fresh.withColumn("content_hash", hashed))


MERGE_SQL = f"""
target AS (
  SELECT *, sha256(to_json({{'description': description, 'id': id, 'status': status}})::VARCHAR) AS content_hash
  FROM (SELECT d.doc_id AS id, 'q' || quality AS status, text AS description, '{AS_OF}' AS ingestion_timestamp
        FROM documents d JOIN labels l ON d.doc_id = l.doc_id
        UNION ALL SELECT -page_id - 1, 'page', url, '{AS_OF}' FROM pages)),
source AS (
  SELECT *, sha256(to_json({{'description': description, 'id': id, 'status': status}})::VARCHAR) AS content_hash
  FROM (SELECT d.doc_id AS id, coalesce('q' || toxic, 'none') AS status, text AS description,
               '{LATER}' AS ingestion_timestamp
        FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)),
merged AS (
  SELECT CASE WHEN t.id IS NULL THEN 'insert' WHEN s.id IS NULL THEN 'kept'
              WHEN t.content_hash <> s.content_hash THEN 'update' ELSE 'unchanged' END AS op,
         coalesce(t.id, s.id) AS id,
         CASE WHEN op IN ('insert', 'update') THEN s.status ELSE t.status END AS status,
         CASE WHEN op IN ('insert', 'update') THEN s.ingestion_timestamp ELSE t.ingestion_timestamp END
           AS ingestion_timestamp,
         CASE WHEN op IN ('insert', 'update') THEN s.content_hash ELSE t.content_hash END AS content_hash
  FROM target t FULL JOIN source s ON t.id = s.id)
"""
