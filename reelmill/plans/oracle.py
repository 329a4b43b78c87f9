"""The model tables as plain SQL over the given tables, for the side-by-side check.

Integer division is ``//`` here; times have no zone. Each constant is a named
subquery; :func:`with_tables` puts the needed ones in front of a query.
"""

_PUB = "(TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST((doc_id * 7) % 30 AS INTEGER)))"
_VID = "('v' || lpad(CAST(doc_id AS VARCHAR), 10, '0'))"
_LEN = "CAST(n_chars // 15 AS INTEGER)"
_HAS = "(doc_id % 10) IN (2, 4, 5, 7, 8, 9)"

TABLES = {
    "ep": f"""
        SELECT doc_id + 1 AS id, {_VID} AS video_id, source AS channel_slug,
               'Episode ' || doc_id AS title,
               CASE WHEN doc_id % 17 <> 0 THEN {_PUB} END AS published_at,
               'https://example.test/watch?v=' || {_VID} AS source_url,
               CASE WHEN doc_id % 3 = 0 THEN 'https://example.test/t/' || doc_id END
                 AS thumbnail_url,
               CASE WHEN (doc_id % 10) NOT IN (0, 1, 6) THEN {_LEN} END AS duration_seconds,
               CASE WHEN {_HAS} THEN lang END AS transcript_language,
               CASE WHEN {_HAS} THEN 'transcriptapi' END AS transcript_source,
               CASE WHEN {_HAS} THEN text END AS raw_text,
               CASE WHEN {_HAS} THEN length(text) END AS raw_char_count,
               CASE WHEN doc_id % 10 = 0 THEN 'discovered'
                    WHEN doc_id % 10 IN (1, 2, 6) THEN 'failed'
                    WHEN doc_id % 10 = 3 THEN 'skipped'
                    WHEN doc_id % 10 IN (4, 5) THEN 'fetched' ELSE 'done' END AS status,
               CAST(doc_id % 7 AS INTEGER) AS attempts,
               CAST(doc_id % 12 AS INTEGER) AS distill_attempts,
               CASE WHEN doc_id % 10 = 5 THEN 'j' || doc_id END AS distill_job_id,
               CASE WHEN doc_id % 10 = 1
                      THEN 'transcript unavailable for ' || {_VID} || ' (en,asr)'
                    WHEN doc_id % 10 = 2 THEN 'distill job j' || doc_id || ' failed'
                    WHEN doc_id % 10 = 3 THEN 'below 600s minimum (' || (n_chars // 15) || 's)'
               END AS last_error,
               CASE WHEN {_HAS} THEN {_PUB} END AS fetched_at,
               CASE WHEN doc_id % 10 >= 7 THEN {_PUB} END AS distilled_at
          FROM documents""",
    "di": f"""
        SELECT doc_id * 2 + k AS id, doc_id + 1 AS episode_id, 'm' || (doc_id % 2) AS model,
               'v' || k AS prompt_version, coalesce(text, '') AS summary,
               CAST(doc_id % 4 AS INTEGER) AS key_topic_count,
               CAST(doc_id % 5 AS INTEGER) AS segment_count,
               CASE WHEN doc_id % 20 = 9 THEN k = 1 ELSE k = 2 END AS is_current,
               {_PUB} AS created_at
          FROM documents, (SELECT 1 AS k UNION ALL SELECT 2) ks""",
    "rn": """
        SELECT run_date, CASE failures % 3 WHEN 0 THEN 'success' WHEN 1 THEN 'partial'
                         ELSE 'failed' END AS status,
               episodes_discovered, transcripts_fetched, distilled, reprocessed, failures,
               last_heartbeat
          FROM (SELECT CAST(ts AS DATE) AS run_date,
                       count(*) FILTER (WHERE event_type = 'signup') AS episodes_discovered,
                       count(*) FILTER (WHERE event_type = 'view') AS transcripts_fetched,
                       count(*) FILTER (WHERE event_type = 'purchase') AS distilled,
                       count(*) FILTER (WHERE event_type = 'click') AS reprocessed,
                       count(*) FILTER (WHERE event_type = 'error') AS failures,
                       max(ts) AS last_heartbeat
                  FROM events GROUP BY 1)""",
    "feed": """
        SELECT 'u' || user_id AS video_id, event_type AS channel_slug, event_id AS feed_pos,
               'Event ' || event_id AS title, props AS description,
               'https://www.youtube.com/watch?v=u' || user_id AS source_url,
               't' || event_id AS thumbnail_url,
               CASE WHEN event_id % 101 <> 0 THEN ts END AS published_at
          FROM events""",
    "recent": """
        SELECT * FROM feed WHERE published_at IS NULL
            OR published_at >= TIMESTAMP '2024-01-16 23:57:12'""",
    "firsts": """
        SELECT * EXCLUDE (rn) FROM (
            SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY channel_slug, feed_pos)
                      AS rn FROM recent) WHERE rn = 1""",
    "items": """
        SELECT *, row_number() OVER (
            ORDER BY published_at DESC NULLS LAST, channel_slug, feed_pos) AS pos FROM firsts""",
    "resp": f"""
        SELECT doc_id, doc_id + 1 AS id, {_VID} AS video_id, CAST(doc_id % 7 AS INTEGER) AS attempts,
               CASE doc_id % 12 WHEN 0 THEN 404 WHEN 1 THEN 402 WHEN 2 THEN 429 WHEN 3 THEN 500
                    WHEN 4 THEN 403 ELSE 200 END AS http_status,
               CASE doc_id % 12 WHEN 0 THEN 'captions are off' WHEN 1 THEN 'monthly quota is used up'
                    ELSE '' END AS detail,
               CASE WHEN doc_id % 12 > 5 THEN text ELSE '' END AS text, lang,
               CASE WHEN doc_id % 13 <> 0 THEN {_LEN} END AS length_seconds
          FROM documents""",
    "answers": """
        SELECT *, CASE WHEN http_status = 200 AND text <> '' THEN 'ok'
                       WHEN http_status IN (200, 404) THEN 'unavailable'
                       WHEN http_status IN (402, 408, 429, 500, 502, 503, 504) THEN 'transient'
                       ELSE 'error' END AS kind,
               CASE WHEN http_status = 200 AND text <> '' THEN NULL
                    WHEN http_status = 200
                      THEN 'transcript unavailable for ' || video_id || ' (en,asr)'
                    WHEN http_status = 404
                      THEN 'transcript unavailable for ' || video_id || ' (en,asr): ' || detail
                    ELSE 'transcriptapi ' || http_status || ' for ' || video_id || ': ' || detail
               END AS error
          FROM resp""",
    "moves": """
        SELECT *, CASE WHEN kind = 'ok' AND reason IS NULL THEN 'fetched'
                       WHEN kind = 'ok' THEN 'skipped'
                       WHEN kind = 'unavailable' AND attempts + 1 >= 5 THEN 'skipped'
                       WHEN kind = 'unavailable' THEN 'unavailable' ELSE 'failed' END AS outcome,
               CASE WHEN kind = 'ok' AND reason IS NULL THEN 'fetched'
                    WHEN kind = 'ok' THEN 'skipped'
                    WHEN kind = 'unavailable' AND attempts + 1 >= 5 THEN 'skipped'
                    WHEN kind = 'transient' THEN 'discovered' ELSE 'failed' END AS new_status
          FROM (SELECT *, CASE WHEN kind = 'ok' AND length_seconds < 30
                                 THEN 'below 30s minimum (' || length_seconds || 's)'
                               WHEN kind = 'ok' AND length_seconds > 600
                                 THEN 'above 600s maximum (' || length_seconds || 's)'
                          END AS reason FROM answers)""",
    "jobs": """
        SELECT doc_id + 1 AS id, 'j' || doc_id AS job_id, doc_id AS d,
               CASE WHEN doc_id % 8 IN (0, 2, 5, 6) THEN 'ok' WHEN doc_id % 8 IN (1, 4) THEN 'failed'
                    WHEN doc_id % 8 = 3 THEN 'pending' ELSE 'invalid' END AS kind,
               CASE WHEN doc_id % 8 IN (1, 4) AND doc_id % 16 < 8 THEN 'model error ' || doc_id
                    WHEN doc_id % 8 IN (1, 4) THEN 'distill job j' || doc_id || ' failed'
                    WHEN doc_id % 8 = 7 THEN
                      'the summarisation service returned an invalid process response'
               END AS error,
               CASE WHEN doc_id % 8 IN (0, 2, 5, 6) THEN coalesce(text, '') END AS summary
          FROM documents""",
    "segs": """
        SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line,
               generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos FROM documents""",
    "lines": """
        SELECT doc_id, pos, trim(regexp_replace(line, '\\s+', ' ', 'g')) AS line FROM segs""",
    "kept": """
        SELECT doc_id, pos, line FROM (
            SELECT *, lag(line) OVER (PARTITION BY doc_id ORDER BY pos) AS before
              FROM lines WHERE line <> '')
         WHERE before IS NULL OR before <> line""",
    "flat": """
        SELECT doc_id, string_agg(line, chr(10) ORDER BY pos) AS raw_text FROM kept GROUP BY doc_id
    """,
}

_ORDER = list(TABLES)
_USES = {
    "recent": ["feed"],
    "firsts": ["recent"],
    "items": ["firsts"],
    "answers": ["resp"],
    "moves": ["answers"],
    "lines": ["segs"],
    "kept": ["lines"],
    "flat": ["kept"],
}


def with_tables(names: str, query: str) -> str:
    """``query`` behind the named subqueries and those they build on."""
    needed: set[str] = set()
    todo = names.split()
    while todo:
        name = todo.pop()
        needed.add(name)
        todo += _USES.get(name, [])
    subqueries = [f"{n} AS ({TABLES[n].strip()})" for n in _ORDER if n in needed]
    return f"WITH {', '.join(subqueries)} {query.strip()}" if subqueries else query.strip()


def hashed(text: str) -> str:
    """T5 in SQL."""
    return f"sha256(lower(trim(regexp_replace({text}, '\\s+', ' ', 'g'))))"
