"""SQL statements that say, independently, what each catalog query returns."""

from __future__ import annotations

# Building blocks -----------------------------------------------------------

REVIEWS = """
reviews AS (
  SELECT CAST(d.doc_id AS VARCHAR) AS id, d.source AS author_name,
         split_part(d.text, '.', 1) AS title, d.text AS content,
         CAST(l.quality AS VARCHAR) AS im_rating, CAST(d.n_chars AS VARCHAR) AS im_version,
         d.lang AS segmento, 'documents' AS app, sha256(d.text) AS text_key
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
)"""

# The columns of REVIEWS as the lens gives them.
RAW = """
id, author_name, title, content, im_version, CAST(NULL AS VARCHAR) AS updated,
CAST(NULL AS VARCHAR) AS author_uri, CAST(NULL AS INTEGER) AS im_votecount,
CAST(NULL AS INTEGER) AS im_votesum, app, CAST(NULL AS VARCHAR) AS content_attributes_label,
CAST(NULL AS VARCHAR) AS content_attributes_term, segmento,
CAST(im_rating AS INTEGER) AS im_rating"""
CHECKED = "id, author_name AS name_client, app, im_version, im_rating, title, content, segmento, text_key"

# Rows of REVIEWS with what is wrong with each.
JUDGED = (
    REVIEWS
    + """,
judged AS (
  SELECT *, count(*) OVER (PARTITION BY text_key) > 1 AS repeated,
         im_rating IS NULL AS incomplete
  FROM reviews
)"""
)

SNAPSHOTS = """
snapshots AS (
  SELECT CAST(user_id AS VARCHAR) AS id, CAST(ts AS DATE) AS odate,
         max_by(event_type, event_id) AS title, max_by(props, event_id) AS content,
         CAST(CAST(floor(max_by(value, event_id)) AS BIGINT) AS VARCHAR) AS im_rating
  FROM events GROUP BY 1, 2
),
new AS (SELECT * FROM snapshots WHERE odate = (SELECT max(CAST(ts AS DATE)) FROM events)),
old AS (SELECT * FROM snapshots WHERE odate < (SELECT max(CAST(ts AS DATE)) FROM events)),
pairs AS (
  SELECT n.id, o.odate, o.title, o.content, o.im_rating,
         n.title <> o.title AS title_differs, n.content <> o.content AS content_differs,
         n.im_rating <> o.im_rating AS rating_differs
  FROM new n JOIN old o ON n.id = o.id
),
replaced AS (
  SELECT id, title, content, im_rating, min(odate) AS first_seen
  FROM pairs WHERE title_differs OR content_differs OR rating_differs
  GROUP BY ALL
)"""

ENTRY = "concat(title, '|', content, '|events|pf||', im_rating)"

HISTORIES = (
    SNAPSHOTS
    + f""",
histories AS (
  SELECT id, string_agg({ENTRY}, ';' ORDER BY first_seen, title, content, im_rating) AS history,
         count(*) AS versions
  FROM replaced GROUP BY id
)"""
)

LATEST = (
    HISTORIES
    + """,
latest AS (
  SELECT id, max_by(title, odate) AS title, max_by(content, odate) AS content,
         max_by(im_rating, odate) AS im_rating, CAST(max(odate) AS VARCHAR) AS updated
  FROM old GROUP BY id
)"""
)

OUTER = (
    "WITH "
    + SNAPSHOTS
    + """
SELECT id, CAST(o.odate AS VARCHAR) AS old_odate, """
    + ", ".join(
        f"""{row}.title AS {side}_title, {row}.content AS {side}_content,
       {row}.im_rating AS {side}_im_rating, CAST({row}.odate AS VARCHAR) AS {side}_updated,
       CAST(NULL AS VARCHAR) AS {side}_im_version,
       CASE WHEN {row}.odate IS NOT NULL THEN 'USER ' || id END AS {side}_name_client,
       CASE WHEN {row}.odate IS NOT NULL THEN 'events' END AS {side}_app,
       CASE WHEN {row}.odate IS NOT NULL THEN 'pf' END AS {side}_segmento"""
        for side, row in (("new", "n"), ("old", "o"))
    )
    + " FROM new n FULL JOIN old o USING (id)"
)

REPORT = (
    JUDGED
    + """,
counts AS (
  SELECT count(*) AS total_records,
         (SELECT count(*) FROM (SELECT text_key FROM reviews GROUP BY 1 HAVING count(*) > 1))
           AS duplicate_keys,
         count(*) FILTER (im_rating IS NULL) AS null_rating,
         count(*) FILTER (NOT repeated AND NOT incomplete) AS valid,
         count(*) FILTER (repeated OR incomplete) AS invalid
  FROM judged
),
report AS (
  SELECT 'duplicate_check' AS "check", duplicate_keys = 0 AS status,
         CASE WHEN duplicate_keys = 0 THEN 200 ELSE 409 END AS code,
         CASE WHEN duplicate_keys = 0 THEN 'Nenhum registro duplicado encontrado.'
              ELSE 'Registros duplicados encontrados: ' || duplicate_keys
                   || ' registros com base no ''id''.' END AS message, total_records
  FROM counts
  UNION ALL
  SELECT 'null_check', null_rating = 0, CASE WHEN null_rating = 0 THEN 200 ELSE 400 END,
         CASE WHEN null_rating = 0 THEN 'Nenhum valor nulo encontrado nas colunas criticas.'
              ELSE 'Valores nulos encontrados nas colunas: {''im_rating'': '
                   || null_rating || '}.' END, total_records
  FROM counts
  UNION ALL
  SELECT 'type_consistency_check', null_rating = 0,
         CASE WHEN null_rating = 0 THEN 200 ELSE 400 END,
         CASE WHEN null_rating = 0
              THEN 'Consistencia dos tipos de dados verificada com sucesso.'
              ELSE 'Valores não numericos encontrados na coluna ''im_rating''.' END,
         total_records
  FROM counts
)"""
)

CHECK_COLUMNS = ", ".join(
    f"""(SELECT {part} FROM report WHERE "check" = '{name}') AS {name}_{part}"""
    for name in ("duplicate_check", "null_check", "type_consistency_check")
    for part in ("message", "status", "code")
)

NUMBER = "'^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)$'"


def _folded(column: str) -> str:
    return f"upper(strip_accents(replace({column}, 'ß', 'ss')))"


def _whole(column: str) -> str:
    whole = f"regexp_extract(trim({column}), '^([+-]?[0-9]*)', 1)"
    return (
        f"CASE WHEN regexp_matches(trim({column}), {NUMBER}) THEN TRY_CAST("
        f"CASE WHEN {whole} IN ('', '+', '-') THEN '0' ELSE {whole} END AS INTEGER) END"
    )


# Statements ----------------------------------------------------------------

SQL = {
    "union_segments": f"WITH {REVIEWS} SELECT {RAW} FROM reviews",
    "empty_source": f"WITH {REVIEWS} SELECT {RAW} FROM reviews",
    "path_attributes": """
WITH paths AS (
  SELECT page_id, '/lake/bronze/appleStore/' || regexp_extract(url, '^https?://([^/?#]+)', 1)
         || CASE page_id % 4 WHEN 0 THEN '_pf' WHEN 1 THEN '_my_pj' WHEN 2 THEN '_fp' ELSE '' END
         || '/odate=20240130/part-0.parquet' AS path
  FROM pages
)
SELECT page_id, regexp_extract(path, '/appleStore/(.*?)/odate=', 1) AS app,
       regexp_extract(path, '/([^/]+)_(pf|pj)/odate=', 2) AS segmento
FROM paths""",
    "file_lineage": "SELECT o_orderkey, 'orders' AS source_table FROM orders",
    "standardize_text": f"""
SELECT doc_id, {_folded('text')} AS content, {_folded('source')} AS name_client
FROM documents""",
    "standardize_reviews": f"""
WITH {REVIEWS}
SELECT id, {_folded('author_name')} AS name_client, {_folded('title')} AS title, im_version,
       im_rating, 'documents' AS app, segmento, {_folded('content')} AS content
FROM reviews""",
    "conform_schema": f"""
WITH {REVIEWS}
SELECT CAST(id AS VARCHAR) AS id, CAST(im_rating AS INTEGER) AS im_rating,
       CAST(im_version AS INTEGER) AS im_version, {_whole('title')} AS title,
       segmento, content, '20240130' AS odate
FROM reviews""",
    "history_partitions": f"""
WITH {SNAPSHOTS}
SELECT id, title, content, im_rating, 'pf' AS segmento, CAST(odate AS VARCHAR) AS odate
FROM old""",
    "history_default": f"""
WITH {SNAPSHOTS}
SELECT id, title, 'NA' AS segmento FROM old""",
    "outer_merge": OUTER,
    "merge_decomposed": OUTER,
    "merge_broadcast": OUTER,
    "salted_outer": OUTER,
    "salted_join": f"""
WITH {SNAPSHOTS}
SELECT CAST(e.event_id AS BIGINT) AS event_id, n.id, n.title
FROM events e JOIN new n ON CAST(e.user_id AS VARCHAR) = n.id""",
    "change_flags": f"""
WITH {SNAPSHOTS}
SELECT id, CAST(odate AS VARCHAR) AS odate,
       CASE WHEN title_differs THEN 'title' WHEN content_differs THEN 'content'
            WHEN rating_differs THEN 'im_rating' END AS changed,
       title_differs OR content_differs OR rating_differs AS is_change
FROM pairs""",
    "change_rows": f"""
WITH {SNAPSHOTS}
SELECT id, CAST(first_seen AS VARCHAR) AS first_seen, title, content, im_rating
FROM replaced""",
    "change_rows_broadcast": f"""
WITH {SNAPSHOTS}
SELECT id, CAST(first_seen AS VARCHAR) AS first_seen, title, content, im_rating
FROM replaced""",
    "change_rows_reduced": f"""
WITH {SNAPSHOTS}
SELECT id, CAST(first_seen AS VARCHAR) AS first_seen, title, content, im_rating
FROM replaced""",
    "ledger_versions": f"""
WITH {SNAPSHOTS}
SELECT id, title, content, im_rating, CAST(min(odate) AS VARCHAR) AS first_seen
FROM old GROUP BY ALL""",
    "change_history": f"WITH {HISTORIES} SELECT id, history, versions FROM histories",
    "latest_snapshot": f"WITH {LATEST} SELECT id, title, content, im_rating, updated FROM latest",
    "current_snapshot": f"""
WITH {LATEST}
SELECT id, 'USER ' || id AS name_client, coalesce(n.title, l.title) AS title,
       coalesce(n.content, l.content) AS content, coalesce(n.im_rating, l.im_rating) AS im_rating,
       coalesce(CAST(n.odate AS VARCHAR), l.updated) AS updated
FROM new n FULL JOIN latest l USING (id)""",
    "snapshot_merge": f"""
WITH {LATEST}
SELECT id, 'USER ' || id AS name_client, coalesce(n.title, l.title) AS title,
       coalesce(n.content, l.content) AS content, coalesce(n.im_rating, l.im_rating) AS im_rating,
       coalesce(CAST(n.odate AS VARCHAR), l.updated) AS updated,
       coalesce(h.history, '') AS history
FROM new n FULL JOIN latest l USING (id) LEFT JOIN histories h USING (id)""",
    "duplicate_keys": """
SELECT sha256(text) AS text_key, count(*) AS n FROM documents GROUP BY 1 HAVING count(*) > 1""",
    "duplicate_records": """
SELECT doc_id, text, source, lang, n_chars, sha256(text) AS text_key FROM documents
WHERE text IN (SELECT text FROM documents GROUP BY text HAVING count(*) > 1)""",
    "null_counts": f"""
WITH {REVIEWS}
SELECT 'id' AS column_name, count(*) FILTER (id IS NULL) AS nulls FROM reviews
UNION ALL SELECT 'content', count(*) FILTER (content IS NULL) FROM reviews
UNION ALL SELECT 'im_rating', count(*) FILTER (im_rating IS NULL) FROM reviews
UNION ALL SELECT 'im_version', count(*) FILTER (im_version IS NULL) FROM reviews""",
    "rating_type_check": f"""
WITH texts AS (
  SELECT p_partkey, 'name' AS field, p_name AS im_rating FROM part
  UNION ALL SELECT p_partkey, 'size', ' ' || CAST(p_size AS VARCHAR) FROM part
  UNION ALL SELECT p_partkey, 'price', CAST(p_retailprice AS VARCHAR) FROM part
  UNION ALL SELECT p_partkey, 'key', CAST(p_partkey AS VARCHAR) || '0000000000' FROM part
)
SELECT p_partkey, field, {_whole('im_rating')} AS number, ({_whole('im_rating')}) IS NULL AS bad
FROM texts""",
    "validation_report": f"WITH {REPORT} SELECT * FROM report",
    "check_rollup": f"""
WITH {REPORT}
SELECT count(*) FILTER (status) AS success_count, count(*) FILTER (NOT status) AS error_count
FROM report""",
    "quarantine": f"""
WITH {JUDGED}
SELECT * FROM (
  SELECT {CHECKED}, concat_ws(',', CASE WHEN incomplete THEN 'null im_rating' END,
                                   CASE WHEN repeated THEN 'duplicate key' END) AS reasons
  FROM judged WHERE incomplete OR repeated)""",
    "valid_reviews": f"""
WITH {JUDGED}
SELECT {CHECKED} FROM judged EXCEPT SELECT {CHECKED} FROM judged WHERE repeated OR incomplete""",
    "except_rows": """
SELECT text, lang, source, n_chars, replace(text, chr(10), '|') AS lines FROM documents
EXCEPT
SELECT text, lang, source, n_chars, replace(text, chr(10), '|') FROM documents
JOIN labels USING (doc_id)""",
    "quality_metrics": f"""
WITH {REPORT}
SELECT valid, round(valid / total_records * 100, 6) AS valid_percentage, invalid,
       round(invalid / total_records * 100, 6) AS invalid_percentage, total_records
FROM counts""",
    "segment_label": """
SELECT upper(string_agg(name, ',' ORDER BY name)) AS type_client
FROM (SELECT DISTINCT lang AS name FROM documents)""",
    "metrics_document": f"""
WITH {REPORT}
SELECT 'run-1' AS application_id, 'NA' AS sigla, 'reviews' AS projeto, 'silver' AS layer_lake,
       CAST(valid AS BIGINT) AS valid_count, invalid AS invalid_count,
       round(valid / total_records * 100, 6) AS valid_percentage,
       round(invalid / total_records * 100, 6) AS invalid_percentage, total_records,
       '1.50 min' AS total_processing_time, 'numStages=3,numTasks=12' AS stages, {CHECK_COLUMNS},
       (SELECT count(*) FILTER (status) FROM report) AS success_count,
       (SELECT count(*) FILTER (NOT status) FROM report) AS error_count,
       (SELECT upper(string_agg(name, ',' ORDER BY name))
        FROM (SELECT DISTINCT lang AS name FROM documents)) AS type_client,
       'silver_app_store' AS source_app, 'app_store' AS source_search,
       '2024-01-30 10:00:00' AS start_ts, '2024-01-30 10:01:30' AS end_ts,
       '2024-01-30T10:01:31.250Z' AS "timestamp"
FROM counts""",
    "metrics_roundtrip": """
SELECT 'datametrics' AS "index", lang AS client, count(*) AS total
FROM documents GROUP BY lang""",
    "failure_document": """
SELECT 'silver' AS layer, 'app_store_reviews' AS job, '0' AS priority,
       string_agg(name, ',' ORDER BY name) AS clients, 'no space left' AS error,
       '2024-01-30T10:01:31.250Z' AS "timestamp"
FROM (SELECT DISTINCT lang AS name FROM documents)""",
    "stage_report_kv": """
WITH lines AS (
  SELECT event_id, CASE event_type WHEN 'error' THEN 'Scheduling mode = ' || props
                   WHEN 'view' THEN '   ' WHEN 'click' THEN event_type || ' => ' || props
                   ELSE '  ' || event_type || ' = ' || props END AS line
  FROM events
),
split AS (
  SELECT event_id, line, string_split_regex(trim(line), ' => | = ') AS parts FROM lines
)
SELECT event_id, trim(parts[1]) AS key, trim(parts[2]) AS value FROM split
WHERE len(parts) = 2 AND NOT starts_with(line, 'Scheduling mode')""",
    "frame_bytes": """
SELECT CAST(sum(strlen(CAST(doc_id AS VARCHAR)) + strlen(text) + strlen(lang) + strlen(source)
       + strlen(CAST(n_chars AS VARCHAR))) AS BIGINT) AS bytes FROM documents""",
    "daily_run": """
WITH docs AS (
  SELECT CAST(doc_id AS VARCHAR) AS id, n_chars % 7 = 0 AS anonymous,
         CASE lang WHEN 'en' THEN 'pf' ELSE 'pj' END AS segmento,
         CAST(n_chars % 5 + 1 AS VARCHAR) AS rating, doc_id
  FROM documents
),
labelled AS (
  SELECT d.id, d.anonymous, d.segmento, l.toxic, CAST(l.quality + 1 AS VARCHAR) AS rating
  FROM docs d JOIN labels l ON d.doc_id = l.doc_id
),
first_day AS (SELECT id, segmento, rating FROM docs WHERE NOT anonymous),
second_day AS (SELECT * FROM labelled WHERE toxic = 0),
merged AS (
  SELECT id, coalesce(n.segmento, o.segmento) AS segmento, coalesce(n.rating, o.rating) AS rating,
         CASE WHEN n.rating <> o.rating THEN o.rating ELSE '' END AS history,
         o.id IS NULL AND n.anonymous AS incomplete
  FROM second_day n FULL JOIN first_day o USING (id)
)
SELECT id, 'docs_' || segmento AS app, segmento, rating AS im_rating, history,
       CASE WHEN incomplete THEN 'null name_client' ELSE 'valid' END AS reasons
FROM merged
UNION ALL
SELECT id, 'docs_' || segmento, segmento, rating, '',
       CASE WHEN anonymous THEN 'null name_client,duplicate key' ELSE 'duplicate key' END
FROM labelled, range(2) WHERE toxic = 1""",
    "partition_roundtrip": """
SELECT event_id, user_id, event_type,
       CASE WHEN CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events)
            THEN 'corrected' ELSE 'first' END AS load,
       strftime(ts, '%Y%m%d') AS odate
FROM events""",
    "sample": f"WITH {REVIEWS} SELECT {RAW} FROM reviews ORDER BY id LIMIT 10",
}

# Other ways to the same rows.
SQL["ledger_merge"] = SQL["snapshot_merge"]
SQL["bucketed_snapshot"] = SQL["current_snapshot"]
SQL["late_day"] = SQL["daily_run"]
SQL["failed_run"] = """
SELECT 'datametrics_fail' AS "index", 'silver' AS layer, 'reviews' AS project,
       'app_store_reviews' AS job, '0' AS priority,
       string_agg(DISTINCT CASE lang WHEN 'en' THEN 'pf' ELSE 'pj' END, ','
                  ORDER BY CASE lang WHEN 'en' THEN 'pf' ELSE 'pj' END) AS clients,
       true AS says_why, true AS raised
FROM documents"""
