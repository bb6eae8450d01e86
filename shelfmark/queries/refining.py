"""Landing, cleaning, contract, hashing, de-duplication and merge."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.hashing import content_hash
from ..functions.text import clean_description, synopsis_preview
from ..operators.checks import check_silver_idempotent
from ..operators.contract import check_contract, flatten_entry, rejected_rows, valid_rows
from ..operators.dedupe import keep_last
from ..operators.merge import INSERT, apply_changes, merge_changes, merge_upsert
from ..operators.metrics import metrics_pivot, route_counts, run_metrics
from ..config import JobConfig
from ..plans.silver_job import refine, refined_rows, table_feed
from ..schemas import REFINED_COLUMNS, REFINED_SCHEMA
from ..scratch import fresh_scratch, staged, write_through
from ..sources.buckets import COMPRESSION, BucketTable
from ..sources.journal import current_quarantine, quarantine_rows
from ..sources.landing import (batch_filename, envelope_text, explode_page_files, land_records,
                               pending_pages, read_landing, valid_pages)
from ..sources.page_sets import merged_bitmaps, missing_pages, page_bitmaps
from ..sources.paths import spread
from ..streaming.newest import keep_newest
from .tables import (AS_OF, CATALOGUE_SQL, LATER, MERGE_SQL, PAGE_SIZE, catalogue, clean_sql, merge_sides,
                     quoted, table)


def clean_html(spark, sf_dir):
    pages = spread(table(spark, sf_dir, "pages").select("page_id", "html"))
    return clean_description(pages, "html", "description").select("page_id", "description")


def min_length_filter(spark, sf_dir):
    documents = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    cleaned = clean_description(documents, "text", "description")
    return cleaned.withColumn("length", F.length("description").cast("bigint")) \
        .filter(F.col("length") >= 50).select("doc_id", "length")


def flatten_nested(spark, sf_dir):
    flat = flatten_entry(catalogue(spark, sf_dir))
    return flat.select(
        "doc_id", "id", "id_mal", "title_romaji", "title_english", "title_native", "format", "status",
        "episodes", "popularity", F.array_join("genres", ",").alias("genres"),
        F.array_join("studios", ",").alias("studios"), "start_year", "start_month", "end_year")


FLATTEN_SQL = f"""
WITH {CATALOGUE_SQL}
SELECT t.doc_id, t.id, CASE WHEN root = 'OBJECT' THEN quality::BIGINT END AS id_mal,
       CASE WHEN title_type = 'OBJECT' THEN title_romaji END AS title_romaji, NULL::VARCHAR AS title_english,
       CASE WHEN title_type = 'OBJECT' THEN json_extract_string(payload, '$.title.native') END AS title_native,
       json_extract_string(payload, '$.format') AS format, NULL::VARCHAR AS status,
       CASE WHEN episodes_type <> 'VARCHAR' THEN n_chars END AS episodes,
       CASE WHEN root = 'OBJECT' THEN toxic::BIGINT END AS popularity,
       CASE WHEN root <> 'OBJECT' THEN '' WHEN NOT null_genre THEN lang END AS genres,
       CASE WHEN root = 'OBJECT' THEN t.source ELSE '' END AS studios,
       CASE WHEN root = 'OBJECT' THEN n_chars END AS start_year,
       CASE WHEN root = 'OBJECT' THEN 1::BIGINT END AS start_month, NULL::BIGINT AS end_year
FROM typed t JOIN labelled l ON t.doc_id = l.doc_id
"""


def _checked(spark, sf_dir):
    return check_contract(catalogue(spark, sf_dir))


def contract_valid(spark, sf_dir):
    return valid_rows(_checked(spark, sf_dir)).select(
        "doc_id", "id", "title_romaji", F.md5("description").alias("description_md5"), "ingestion_timestamp")


def contract_rejects(spark, sf_dir):
    return rejected_rows(_checked(spark, sf_dir)).select("doc_id", "motivo_rechazo")


def quarantined(spark, sf_dir):
    return quarantine_rows(rejected_rows(_checked(spark, sf_dir)), AS_OF, "run_1")


def quarantine_current(spark, sf_dir):
    """The journal after two runs over the same pages, seen as one row per payload."""
    rejected = rejected_rows(_checked(spark, sf_dir))
    journal = quarantine_rows(rejected, AS_OF, "run_1").unionByName(quarantine_rows(rejected, LATER, "run_2"))
    return current_quarantine(journal).select("payload_hash", "run_id", "quarantined_at")


def hashed(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    return documents.select(
        "doc_id", content_hash(["doc_id", "lang", "n_chars", "source", "text"]).alias("content_hash"))


def dedupe_last(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    return keep_last(events, ["user_id"], ["ts", "event_id"]).drop("ts")


def stream_newest(spark, sf_dir):
    """All events as a stream of six batches, the newest of each user kept by state and merged into a table."""
    folder = fresh_scratch(spark, name="stream")
    events = table(spark, sf_dir, "events").select(
        "event_id", F.unix_micros(F.to_utc_timestamp("ts", "UTC")).alias("at"), "user_id", "event_type", "value")
    events.repartition(6, "event_id").write.parquet(f"{folder}/arriving")
    arriving = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/arriving")
    stored = BucketTable(spark, f"{folder}/table", events.schema, key="user_id", buckets=8)
    keep_newest(arriving, "user_id", ["at", "event_id"], stored, f"{folder}/checkpoint").awaitTermination()
    return stored.read().drop("at")


def refined(spark, sf_dir):
    """Checked, de-duplicated and hashed entries: what a run merges into the table."""
    rows = refined_rows(valid_rows(_checked(spark, sf_dir)))
    return rows.select("id", "id_mal", "title_romaji", "episodes", "description", "ingestion_timestamp",
                       F.length("content_hash").cast("bigint").alias("hash_length"))


def merged(spark, sf_dir):
    return merge_upsert(*merge_sides(spark, sf_dir)).select(
        "id", "status", "ingestion_timestamp", "content_hash", "op")


def changes_only(spark, sf_dir):
    return merge_changes(*merge_sides(spark, sf_dir)).select("id", "status", "content_hash", "op")


def merged_table(spark, sf_dir):
    target, source = merge_sides(spark, sf_dir)
    return apply_changes(target, staged(merge_changes(target, source))).select(
        "id", "status", "ingestion_timestamp", "content_hash")


def bucket_table(spark, sf_dir):
    """The same merge through the stored table: filled, then changed bucket by bucket, then read back."""
    target, source = merge_sides(spark, sf_dir)
    folder = fresh_scratch(spark, name="buckets")
    stored = BucketTable(spark, f"{folder}/table", target.schema, buckets=16)
    stored.apply(target.withColumn("op", F.lit(INSERT)), f"{folder}/filled")
    stored.apply(staged(merge_changes(stored.read(), source)), f"{folder}/changed")
    return stored.read().select("id", "status", "ingestion_timestamp", "content_hash")


def silver_metrics(spark, sf_dir):
    """Two runs over the same landed pages, into an empty table and into the result of the first."""
    checked = staged(_checked(spark, sf_dir))
    source = staged(
        refined_rows(valid_rows(checked)).select("id", "content_hash", "ingestion_timestamp"))
    columns = [REFINED_SCHEMA[c] for c in source.columns]
    stored = spark.createDataFrame([], schema=type(REFINED_SCHEMA)(columns))
    runs = []
    for run in ("run_1", "run_2"):
        changes = merge_changes(stored, source)
        stored = apply_changes(stored, changes)
        runs.append(run_metrics(run, checked, changes, stored))
    return runs[0].unionByName(runs[1])


def _stored_table(spark, sf_dir):
    """An empty table, its job's settings, and all catalogue records."""
    folder = fresh_scratch(spark, name="refined")
    config = JobConfig(silver_dir=folder, scratch_dir=folder)
    return BucketTable(spark, f"{folder}/table", REFINED_SCHEMA, buckets=16), config, catalogue(spark, sf_dir).drop("doc_id")


def observed_counters(spark, sf_dir):
    """Two runs of the job over the same records, their counters observed while it wrote."""
    stored, config, records = _stored_table(spark, sf_dir)
    first = refine(spark, config, records, AS_OF, "run_1", stored)
    return first.unionByName(refine(spark, config, records, AS_OF, "run_2", stored))


def content_digests(spark, sf_dir):
    """Rows and digest the table keeps after each of two runs, and after one cell was changed behind its back."""
    stored, config, records = _stored_table(spark, sf_dir)

    def kept(step):
        sums = staged(stored.stats().agg(F.sum("rows").alias("rows"), F.sum("digest").cast("string").alias("digest")))
        return sums.withColumn("altered_buckets", F.lit(stored.altered().count())).withColumn("step", F.lit(step))

    refine(spark, config, records, AS_OF, "run_1", stored)
    first = kept("first")
    refine(spark, config, records, AS_OF, "run_2", stored)
    second = kept("second")
    least = stored.read().agg(F.min("id")).first()[0]
    changed = F.when(F.col("id") == least, F.coalesce("episodes", F.lit(0)) + 1).otherwise(F.col("episodes"))
    altered = write_through(stored.read().withColumn("episodes", changed), fresh_scratch(spark), compression=COMPRESSION)
    stored._write(altered, stored.buckets())
    return first.unionByName(second).unionByName(kept("changed"))


def feed_changes(spark, sf_dir):
    """What a consumer that has seen the first of two runs finds in the table's feed."""
    target, source = merge_sides(spark, sf_dir)
    folder = fresh_scratch(spark, name="feed")
    stored = BucketTable(spark, f"{folder}/table", target.schema, buckets=16)
    feed = table_feed(stored)
    for number, rows in enumerate((target, source)):
        changes = staged(merge_changes(stored.read(), rows))
        stored.apply(changes, f"{folder}/{number}")
        seq = feed.append(changes)
        if number == 0:
            feed.handled("index", seq)
    return feed.unseen("index").select("id", "content_hash", "op")


def refined_hashes(spark, sf_dir):
    rows = refined_rows(valid_rows(_checked(spark, sf_dir)))
    return rows.select("id", "content_hash")


def entry_json_sql(stored: str = "") -> str:
    """All hashed columns of a valid entry, keys in order; `stored` may add the one that follows the first."""
    return f"""to_json({{
  'average_score': NULL::BIGINT, {stored}'description': j.description, 'duration': NULL::BIGINT, 'end_day': NULL::BIGINT,
  'end_month': NULL::BIGINT, 'end_year': NULL::BIGINT, 'episodes': n_chars, 'favourites': NULL::BIGINT, 'format': lang,
  'genres': [lang], 'id': j.id, 'id_mal': quality::BIGINT, 'popularity': toxic::BIGINT, 'season': NULL::VARCHAR,
  'season_year': NULL::BIGINT, 'start_day': NULL::BIGINT, 'start_month': 1::BIGINT, 'start_year': n_chars,
  'status': NULL::VARCHAR, 'studios': [l.source], 'title_english': NULL::VARCHAR,
  'title_native': CASE WHEN l.source NOT IN ('src11', 'src15') THEN l.source END, 'title_romaji': title_romaji}})"""

HASHES_SQL = f"""
hashes AS (
  SELECT j.id, j.doc_id, sha256({entry_json_sql()}::VARCHAR) AS content_hash
  FROM judged j JOIN labelled l ON j.doc_id = l.doc_id
  WHERE motivo_rechazo IS NULL
  QUALIFY row_number() OVER (PARTITION BY j.id ORDER BY source_page DESC, position DESC) = 1)
"""


METRICS_SQL = f"""
WITH {CATALOGUE_SQL},
counts AS (
  SELECT count(*) AS read, count(*) FILTER (motivo_rechazo IS NULL) AS valid,
         count(*) FILTER (motivo_rechazo IS NOT NULL) AS rejected,
         count(DISTINCT CASE WHEN motivo_rechazo IS NULL THEN id END) AS total FROM judged),
runs AS (
  SELECT 'run_1' AS run, read AS filas_leidas, valid AS filas_validas, rejected AS filas_en_cuarentena,
         total AS filas_nuevas, 0::BIGINT AS filas_actualizadas, total AS filas_totales_silver FROM counts
  UNION ALL SELECT 'run_2', read, valid, rejected, 0, 0, total FROM counts)
"""


def silver_idempotent(spark, sf_dir):
    """The second run against the first, which passes, and the first against the second, which inserts rows."""
    metrics = staged(silver_metrics(spark, sf_dir))
    return check_silver_idempotent(metrics, "run_1", "run_2").withColumn("judged", F.lit("run_2")).unionByName(
        check_silver_idempotent(metrics, "run_2", "run_1").withColumn("judged", F.lit("run_1")))


def counts_table(spark, sf_dir):
    pivot = metrics_pivot(silver_metrics(spark, sf_dir), ["run_1", "run_2"])
    return pivot.withColumn("ordinal", F.col("ordinal").cast("bigint"))


def _landed(spark, sf_dir):
    records = catalogue(spark, sf_dir).select("source_page", "position", "payload")
    return land_records(records, AS_OF, "catalog_api", PAGE_SIZE)


def land_envelope(spark, sf_dir):
    pages = _landed(spark, sf_dir)
    text = envelope_text(F.col("ingestion_timestamp"), F.col("source"), F.col("source_page"), F.col("records"),
                         F.col("first_position"))
    return pages.select(batch_filename(F.col("source_page"), F.col("first_position")).alias("file_name"), "source_page",
                        text.alias("envelope"))


ENVELOPE_SQL = f"""
SELECT format('anime_catalog_batch_{{:04d}}.json', source_page) AS file_name, source_page,
       '{{"ingestion_timestamp":"{AS_OF}","source":"catalog_api","source_page":' || source_page
       || ',"records":[' || string_agg(payload, ',' ORDER BY position) || ']}}' AS envelope
FROM entries GROUP BY source_page
"""


def read_landed_files(spark, sf_dir):
    files = land_envelope(spark, sf_dir).withColumnRenamed("envelope", "text")
    return explode_page_files(files).select(
        "source_page", F.col("position").cast("bigint").alias("position"), "ingestion_timestamp", "payload")


def read_landed_table(spark, sf_dir):
    """All catalogue pages, some of which are landed again later from the `pages` table."""
    first = _landed(spark, sf_dir).withColumn("landing_run", F.lit("run_1"))
    page_id, page = F.col("page_id"), (F.floor(F.col("page_id") / PAGE_SIZE) + 1).cast("bigint")
    later = table(spark, sf_dir, "pages").select(
        page.alias("source_page"), (page_id - (page - 1) * PAGE_SIZE).cast("bigint").alias("position"),
        F.concat(F.lit('{"id":'), page_id.cast("string"), F.lit(',"url":'), quoted(F.col("url")),
                 F.lit("}")).alias("payload"))
    second = land_records(later, LATER, "catalog_api", PAGE_SIZE).withColumn("landing_run", F.lit("run_2"))
    return read_landing(first.unionByName(second)).select(
        "source_page", "file_name", F.col("position").cast("bigint").alias("position"),
        "ingestion_timestamp", "payload")


READ_TABLE_SQL = f"""
WITH {CATALOGUE_SQL},
again AS (
  SELECT page_id // {PAGE_SIZE} + 1 AS source_page, page_id % {PAGE_SIZE} AS position,
         '{LATER}' AS ingestion_timestamp,
         '{{"id":' || page_id || ',"url":' || to_json(url)::VARCHAR || '}}' AS payload FROM pages),
kept AS (
  SELECT source_page, position, '{AS_OF}' AS ingestion_timestamp, payload FROM entries
  WHERE source_page NOT IN (SELECT source_page FROM again)
  UNION ALL SELECT * FROM again)
SELECT source_page, format('anime_catalog_batch_{{:04d}}.json', source_page) AS file_name, position,
       ingestion_timestamp, payload FROM kept
"""


def _files(spark, sf_dir):
    """One page file per document; languages differ in whether the file is whole."""
    documents = table(spark, sf_dir, "documents")
    page, lang = F.col("doc_id") + 1, F.col("lang")
    record = F.concat(F.lit('{"text":'), quoted(F.col("text")), F.lit("}"))
    head = F.concat(F.lit('{"source_page":'), page.cast("string"))
    whole = F.concat(head, F.lit(',"records":['), record, F.lit("]}"))
    text = (F.when(lang == "de", F.concat(head, F.lit(',"records":['), record))
            .when(lang == "fr", F.concat(F.lit("["), whole, F.lit("]")))
            .when(lang == "es", F.concat(F.lit('{"records":['), record, F.lit("]}")))
            .otherwise(whole))
    name = F.format_string("anime_catalog_batch_%04d.json", page)
    tmp = F.col("source") == "src0"
    return documents.select(F.when(tmp, F.concat(name, F.lit(".tmp"))).otherwise(name).alias("file_name"),
                            text.alias("text"))


def whole_pages(spark, sf_dir):
    return valid_pages(_files(spark, sf_dir))


def pages_left(spark, sf_dir):
    last = table(spark, sf_dir, "documents").agg(F.max("doc_id")).first()[0] + 1
    return pending_pages(whole_pages(spark, sf_dir), last)


def pages_missing(spark, sf_dir):
    """The pages left by the merged bitmaps of three landing runs, each with its share of the pages."""
    last = table(spark, sf_dir, "documents").agg(F.max("doc_id")).first()[0] + 1
    runs = page_bitmaps(whole_pages(spark, sf_dir).withColumn("landing_run", F.col("page") % 3), "landing_run")
    return missing_pages(merged_bitmaps(staged(runs)), last)


DONE_SQL = "lang NOT IN ('de', 'fr', 'es') AND source <> 'src0'"


def previews(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", synopsis_preview(F.col("text")).alias("synopsis"),
        synopsis_preview(F.col("text"), table_safe=False).alias("listing"))


_WS = r"[\s\x{0B}\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"


def preview_sql(text: str) -> str:
    flat = f"regexp_replace(translate({text}, '|' || chr(10), '/ '), '^{_WS}|{_WS}$', '', 'g')"
    return (f"CASE WHEN length({flat}) > 160 THEN regexp_replace({flat}[1:160], '{_WS}$', '') || '…' "
            f"ELSE {flat} END")


QUERIES = {
    "clean_html": (clean_html, f"SELECT page_id, {clean_sql('html')} AS description FROM pages"),
    "min_length_filter": (min_length_filter, f"""
        SELECT doc_id, length FROM (SELECT doc_id, length({clean_sql('text')}) AS length FROM documents)
        WHERE length >= 50"""),
    "flatten_nested": (flatten_nested, FLATTEN_SQL),
    "contract_valid": (contract_valid, f"""
        WITH {CATALOGUE_SQL}
        SELECT doc_id, id, title_romaji, md5(description) AS description_md5, '{AS_OF}' AS ingestion_timestamp
        FROM judged WHERE motivo_rechazo IS NULL"""),
    "contract_rejects": (contract_rejects, f"""
        WITH {CATALOGUE_SQL} SELECT doc_id, motivo_rechazo FROM judged WHERE motivo_rechazo IS NOT NULL"""),
    "route_counts": (lambda spark, sf_dir: route_counts(_checked(spark, sf_dir)), f"""
        WITH {CATALOGUE_SQL}
        SELECT count(*) AS filas_leidas, count(*) FILTER (motivo_rechazo IS NULL) AS filas_validas,
               count(*) FILTER (motivo_rechazo IS NOT NULL) AS filas_en_cuarentena FROM judged"""),
    "quarantine_rows": (quarantined, f"""
        WITH {CATALOGUE_SQL}
        SELECT motivo_rechazo, payload AS payload_original, '{AS_OF}' AS quarantined_at, 'run_1' AS run_id
        FROM judged WHERE motivo_rechazo IS NOT NULL"""),
    "current_quarantine": (quarantine_current, f"""
        WITH {CATALOGUE_SQL}
        SELECT DISTINCT sha256(payload) AS payload_hash, 'run_2' AS run_id, '{LATER}' AS quarantined_at
        FROM judged WHERE motivo_rechazo IS NOT NULL"""),
    "content_hash": (hashed, """
        SELECT doc_id, sha256(to_json({'doc_id': doc_id, 'lang': lang, 'n_chars': n_chars,
                                       'source': source, 'text': text})::VARCHAR) AS content_hash
        FROM documents"""),
    "dedupe_last": (dedupe_last, """
        SELECT event_id, user_id, event_type, value FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"""),
    "stream_newest": (stream_newest, """
        SELECT event_id, user_id, event_type, value FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"""),
    "refined_rows": (refined, f"""
        WITH {CATALOGUE_SQL}
        SELECT j.id, quality::BIGINT AS id_mal, title_romaji, n_chars AS episodes, description,
               '{AS_OF}' AS ingestion_timestamp, 64::BIGINT AS hash_length
        FROM judged j JOIN labelled l ON j.doc_id = l.doc_id WHERE motivo_rechazo IS NULL
        QUALIFY row_number() OVER (PARTITION BY j.id ORDER BY source_page DESC, position DESC) = 1"""),
    "merge_upsert": (merged, f"""
        WITH {MERGE_SQL} SELECT id, status, ingestion_timestamp, content_hash, op FROM merged"""),
    "merge_changes": (changes_only, f"""
        WITH {MERGE_SQL} SELECT id, status, content_hash, op FROM merged WHERE op IN ('insert', 'update')"""),
    "merged_table": (merged_table, f"""
        WITH {MERGE_SQL} SELECT id, status, ingestion_timestamp, content_hash FROM merged"""),
    "bucket_table": (bucket_table, f"""
        WITH {MERGE_SQL} SELECT id, status, ingestion_timestamp, content_hash FROM merged"""),
    "silver_metrics": (silver_metrics, f"{METRICS_SQL} SELECT * FROM runs"),
    "observed_counters": (observed_counters, f"{METRICS_SQL} SELECT * FROM runs"),
    "refined_hashes": (refined_hashes, f"WITH {CATALOGUE_SQL}, {HASHES_SQL} SELECT id, content_hash FROM hashes"),
    "content_digests": (content_digests, f"""
        WITH {CATALOGUE_SQL}, {HASHES_SQL},
        digests AS (
          SELECT ('0x' || sha256({entry_json_sql("'content_hash': h.content_hash, ")}::VARCHAR)[1:15])::BIGINT AS digest
          FROM hashes h JOIN judged j ON j.doc_id = h.doc_id JOIN labelled l ON l.doc_id = h.doc_id)
        SELECT step, altered_buckets, count(*) AS rows, sum(digest)::VARCHAR AS digest
        FROM digests, (VALUES ('first', 0::BIGINT), ('second', 0), ('changed', 1)) steps(step, altered_buckets) GROUP BY ALL"""),
    "feed_changes": (feed_changes, f"""
        WITH {MERGE_SQL} SELECT id, content_hash, op FROM merged WHERE op IN ('insert', 'update')"""),
    "check_silver_idempotent": (silver_idempotent, f"""
        {METRICS_SQL}
        SELECT b.filas_nuevas = 0 AS no_new_rows, b.filas_actualizadas = 0 AS no_updates,
               a.filas_totales_silver = b.filas_totales_silver AS same_total,
               no_new_rows AND no_updates AND same_total AS passed, b.run AS judged
        FROM runs a, runs b WHERE a.run <> b.run"""),
    "metrics_pivot": (counts_table, f"""
        {METRICS_SQL},
        long AS (UNPIVOT runs ON COLUMNS(* EXCLUDE run) INTO NAME metric VALUE v)
        SELECT metric, max(v) FILTER (run = 'run_1') AS run_1, max(v) FILTER (run = 'run_2') AS run_2,
               list_position(['filas_leidas', 'filas_validas', 'filas_en_cuarentena', 'filas_nuevas',
                              'filas_actualizadas', 'filas_totales_silver'], metric)::BIGINT AS ordinal
        FROM long GROUP BY metric"""),
    "land_envelope": (land_envelope, f"WITH {CATALOGUE_SQL} {ENVELOPE_SQL}"),
    "read_landing": (read_landed_files, f"""
        WITH {CATALOGUE_SQL}
        SELECT source_page, position, '{AS_OF}' AS ingestion_timestamp, payload FROM entries"""),
    "read_landing_table": (read_landed_table, READ_TABLE_SQL),
    "valid_pages": (whole_pages, f"SELECT doc_id + 1 AS page FROM documents WHERE {DONE_SQL}"),
    "pending_pages": (pages_left, f"""
        SELECT page FROM (SELECT unnest(range(1, (SELECT max(doc_id) + 2 FROM documents))) AS page)
        WHERE page NOT IN (SELECT doc_id + 1 FROM documents WHERE {DONE_SQL})"""),
    "missing_pages": (pages_missing, f"""
        SELECT page FROM (SELECT unnest(range(1, (SELECT max(doc_id) + 2 FROM documents))) AS page)
        WHERE page NOT IN (SELECT doc_id + 1 FROM documents WHERE {DONE_SQL})"""),
    "synopsis_preview": (previews, f"""
        SELECT doc_id, {preview_sql('text')} AS synopsis,
               CASE WHEN length(text) > 160
                    THEN regexp_replace(replace(text, chr(10), ' ')[1:160], '{_WS}$', '') || '…'
                    ELSE replace(text, chr(10), ' ') END AS listing
        FROM documents"""),
}
