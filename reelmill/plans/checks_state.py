"""Queries that change state in batches: updates, passes, results, run rows."""

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelmill.functions.text import content_hash
from reelmill.operators import changes as ch
from reelmill.operators import discovery, distill, queues, runs, transcripts
from reelmill.plans import fixtures as fx
from reelmill.plans.checks_inputs import _recent, naive
from reelmill.plans.flagship import summary_after_pass
from reelmill.plans.checks_reads import _COMPLETED, _RUN, labelled_ids
from reelmill.plans.oracle import hashed, with_tables
from reelmill.sources.store import work_dir

QUERIES: dict = {}
NOW = fx.NOW
_NOW = "TIMESTAMP '2024-02-01 12:30:00'"
RUN_DATE = date(2024, 1, 30)


def query(name: str, tables: str = "", sql: str | None = None):
    def register(fn):
        QUERIES[name] = (fn, with_tables(tables, sql) if sql else None)
        return fn

    return register


_L = "(SELECT doc_id + 1 AS id, quality, toxic FROM labels)"


def _changes(spark, sf, *columns) -> DataFrame:
    """A change set over the labelled documents."""
    docs = fx.table(spark, sf, "documents").select("doc_id", "text", "lang", "n_chars")
    labels = fx.table(spark, sf, "labels")
    return docs.join(labels, "doc_id").select((F.col("doc_id") + 1).alias("id"), *columns)


# -- keyed updates ------------------------------------------------------------------


@query(
    "u1_mark_fetched",
    "ep",
    f"""SELECT ep.id, CASE WHEN l.id IS NULL THEN ep.status ELSE 'fetched' END AS status,
              CASE WHEN l.id IS NULL THEN ep.raw_text ELSE d.text END AS raw_text,
              CASE WHEN l.id IS NULL THEN NULL ELSE {hashed('d.text')} END AS content_hash,
              CASE WHEN l.id IS NULL THEN ep.transcript_language ELSE d.lang END AS language,
              CASE WHEN l.id IS NULL OR l.quality = 0 THEN ep.duration_seconds
                   ELSE CAST(d.n_chars AS INTEGER) END AS duration_seconds,
              CASE WHEN l.id IS NULL THEN ep.fetched_at ELSE {_NOW} END AS fetched_at,
              CASE WHEN l.id IS NULL THEN ep.last_error END AS last_error, ep.attempts
         FROM ep JOIN documents d ON d.doc_id + 1 = ep.id LEFT JOIN {_L} l ON l.id = ep.id""",
)
def mark_fetched(spark, sf):
    changes = _changes(
        spark,
        sf,
        F.col("text").alias("raw_text"),
        content_hash(F.col("text")).alias("content_hash"),
        F.col("lang").alias("transcript_language"),
        F.lit("transcriptapi").alias("transcript_source"),
        F.when(F.col("quality") == 1, F.col("n_chars").cast("int")).alias("duration_seconds"),
    )
    state = ch.mark_fetched(fx.episodes(spark, sf, text=True), changes, NOW)
    return state.select(
        "id", "status", "raw_text", "content_hash",
        F.col("transcript_language").alias("language"), "duration_seconds", "fetched_at",
        "last_error", "attempts",
    )


@query(
    "u2_mark_skipped",
    "ep",
    f"""SELECT ep.id, CASE WHEN l.id IS NULL THEN status ELSE 'skipped' END AS status,
              CASE WHEN l.quality = 1 THEN 7 ELSE duration_seconds END AS duration_seconds,
              CASE WHEN l.id IS NULL THEN last_error ELSE 'reason ' || l.toxic END AS last_error
         FROM ep LEFT JOIN {_L} l ON l.id = ep.id""",
)
def mark_skipped(spark, sf):
    changes = _changes(
        spark,
        sf,
        F.when(F.col("quality") == 1, F.lit(7)).alias("duration_seconds"),
        F.format_string("reason %s", "toxic").alias("reason"),
    )
    state = ch.mark_skipped(fx.episodes(spark, sf), changes)
    return state.select("id", "status", "duration_seconds", "last_error")


@query(
    "u3_set_status",
    "ep",
    f"""SELECT ep.id, CASE WHEN l.id IS NULL THEN status WHEN l.toxic = 1 THEN 'failed'
                          ELSE 'done' END AS status,
              CASE WHEN l.id IS NULL THEN last_error WHEN l.toxic = 1 THEN 'toxic' END AS last_error,
              attempts + coalesce(l.quality, 0) AS attempts
         FROM ep LEFT JOIN {_L} l ON l.id = ep.id""",
)
def set_status(spark, sf):
    toxic = F.col("toxic") == 1
    changes = _changes(
        spark,
        sf,
        F.when(toxic, "failed").otherwise("done").alias("status"),
        F.when(toxic, "toxic").alias("last_error"),
        F.col("quality").alias("bump"),
    )
    return ch.set_status(fx.episodes(spark, sf), changes).select(
        "id", "status", "last_error", "attempts"
    )


@query(
    "u4_set_distill_job",
    "ep",
    f"""SELECT ep.id, CASE WHEN l.id IS NULL THEN distill_job_id
                          WHEN l.quality = 1 THEN 'job-' || ep.id END AS distill_job_id
         FROM ep LEFT JOIN {_L} l ON l.id = ep.id""",
)
def set_distill_job(spark, sf):
    job = F.when(F.col("quality") == 1, F.format_string("job-%s", F.col("doc_id") + 1))
    changes = _changes(spark, sf, job.alias("distill_job_id"))
    return ch.set_distill_job(fx.episodes(spark, sf), changes).select("id", "distill_job_id")


@query(
    "u5_bump_and_touch",
    "ep",
    f"""SELECT ep.id, distill_attempts + CASE WHEN l.id IS NULL THEN 0 ELSE 1 END
                AS distill_attempts,
              CASE WHEN l.id IS NULL THEN distilled_at ELSE {_NOW} END AS distilled_at
         FROM ep LEFT JOIN {_L} l ON l.id = ep.id""",
)
def bump_and_touch(spark, sf):
    ids = labelled_ids(spark, sf)
    bumped = ch.bump_distill_attempts(fx.episodes(spark, sf), ids)
    return ch.touch_distilled(bumped, ids, NOW).select("id", "distill_attempts", "distilled_at")


@query(
    "u6_reset_for_reprocess",
    "ep",
    f"""SELECT ep.id, CASE WHEN hit THEN 'fetched' ELSE status END AS status,
              CASE WHEN hit THEN NULL ELSE last_error END AS last_error,
              CASE WHEN hit THEN NULL ELSE distill_job_id END AS distill_job_id,
              CASE WHEN hit THEN 0 ELSE distill_attempts END AS distill_attempts, distilled_at,
              (SELECT count(*) FROM ep JOIN {_L} l USING (id) WHERE raw_text IS NOT NULL) AS matched
         FROM (SELECT ep.*, l.id IS NOT NULL AND raw_text IS NOT NULL AS hit
                 FROM ep LEFT JOIN {_L} l ON l.id = ep.id) ep""",
)
def reset_for_reprocess(spark, sf):
    episodes, ids = fx.episodes(spark, sf), labelled_ids(spark, sf)
    matched = ch.matched(episodes, ids, ch.has_text(episodes))
    return ch.reset_for_reprocess(episodes, ids).select(
        "id", "status", "last_error", "distill_job_id", "distill_attempts", "distilled_at",
        matched.scalar().alias("matched"),
    )


@query(
    "u7_reset_full",
    "ep",
    f"""SELECT ep.id, CASE WHEN l.id IS NULL THEN status ELSE 'discovered' END AS status,
              CASE WHEN l.id IS NULL THEN length(raw_text) END AS chars,
              CASE WHEN l.id IS NULL THEN transcript_source END AS transcript_source,
              CASE WHEN l.id IS NULL THEN last_error END AS last_error,
              CASE WHEN l.id IS NULL THEN distill_job_id END AS distill_job_id,
              CASE WHEN l.id IS NULL THEN distill_attempts ELSE 0 END AS distill_attempts,
              CASE WHEN l.id IS NULL THEN fetched_at END AS fetched_at,
              CASE WHEN l.id IS NULL THEN distilled_at END AS distilled_at,
              attempts, duration_seconds FROM ep LEFT JOIN {_L} l ON l.id = ep.id""",
)
def reset_full(spark, sf):
    state = ch.reset_full(fx.episodes(spark, sf, text=True), labelled_ids(spark, sf))
    return state.select(
        "id", "status", F.length("raw_text").cast("bigint").alias("chars"), "transcript_source",
        "last_error", "distill_job_id", "distill_attempts", "fetched_at", "distilled_at",
        "attempts", "duration_seconds",
    )


@query(
    "u8_delete_episodes",
    "ep",
    f"SELECT id, video_id, status FROM ep WHERE id NOT IN (SELECT id FROM {_L})",
)
def delete_episodes(spark, sf):
    kept = ch.delete_episodes(fx.episodes(spark, sf), labelled_ids(spark, sf))
    return kept.select("id", "video_id", "status")


@query(
    "u8_delete_cascade",
    "di",
    f"SELECT id, episode_id, model FROM di WHERE episode_id NOT IN (SELECT id FROM {_L})",
)
def delete_cascade(spark, sf):
    kept = ch.delete_results(fx.distillations(spark, sf), labelled_ids(spark, sf))
    return kept.select("id", "episode_id", "model")


# -- discovery ------------------------------------------------------------------------


def _known(spark, sf) -> DataFrame:
    """Stored episodes for the feed: the customers, as far as users have their keys."""
    return fx.table(spark, sf, "supplier").select(
        (F.col("s_suppkey") + 1000).alias("id"),
        F.concat(F.lit("u"), F.col("s_suppkey") * 3).alias("video_id"),
    )


_KNOWN = "(SELECT s_suppkey + 1000 AS id, 'u' || (s_suppkey * 3) AS video_id FROM supplier)"
_FRESH = f"""fresh AS (SELECT *, row_number() OVER (
        ORDER BY published_at DESC NULLS LAST, channel_slug, feed_pos) AS place FROM items
        WHERE video_id NOT IN (SELECT video_id FROM {_KNOWN}))"""


@query(
    "d10_insert_new",
    "items",
    f"""SELECT place + (SELECT max(id) FROM {_KNOWN}) AS id, video_id, channel_slug, title,
              published_at, status, attempts FROM (SELECT *, 'discovered' AS status, 0 AS attempts,
              row_number() OVER (ORDER BY published_at DESC NULLS LAST, channel_slug, feed_pos)
                AS place FROM items WHERE video_id NOT IN (SELECT video_id FROM {_KNOWN}))""",
)
def insert_new(spark, sf):
    items = discovery.newest(discovery.first_wins(_recent(spark, sf)))
    fresh = discovery.new_episodes(items, _known(spark, sf), NOW, work_dir(spark))
    return fresh.select(
        "id", "video_id", "channel_slug", "title", naive("published_at"), "status", "attempts"
    )


@query(
    "d11_discovery_run",
    "items rn",
    f"""SELECT run_date, CASE WHEN hit THEN 'success' ELSE status END AS status,
              episodes_discovered + CASE WHEN hit THEN new ELSE 0 END AS episodes_discovered,
              failures, CASE WHEN hit THEN '{{"crawled":' || crawled || ',"new":' || new || '}}'
                             ELSE '{{}}' END AS notes,
              CASE WHEN hit THEN {_NOW} ELSE last_heartbeat END AS last_heartbeat
         FROM (SELECT rn.*, run_date = DATE '2024-01-30' AS hit,
                      (SELECT count(*) FROM items) AS crawled,
                      (SELECT count(*) FROM items WHERE video_id NOT IN (
                          SELECT video_id FROM {_KNOWN})) AS new FROM rn)""",
)
def discovery_run(spark, sf):
    items = discovery.newest(discovery.first_wins(_recent(spark, sf)))
    counts = discovery.discovery_counts(items, discovery.unseen(items, _known(spark, sf)))
    updated = runs.discovery_run(fx.ingest_runs(spark, sf), counts, RUN_DATE, NOW)
    return updated.select(
        "run_date", "status", "episodes_discovered", "failures", "notes", "last_heartbeat"
    )


# -- transcripts ------------------------------------------------------------------------


def _moves(spark, sf) -> DataFrame:
    queue = fx.response_queue(spark, sf)
    return transcripts.transitions(queue, fx.responses(spark, sf), 5, 30, 600)


@query(
    "t10_transitions",
    "moves flat",
    f"""SELECT m.id, m.outcome, m.new_status AS status,
              CASE WHEN m.new_status = 'failed' THEN 1 ELSE 0 END AS bump,
              coalesce(m.reason, m.error) AS last_error,
              CASE WHEN m.kind = 'ok' THEN m.length_seconds END AS duration_seconds,
              CASE WHEN m.new_status = 'fetched' THEN {hashed('f.raw_text')} END AS content_hash,
              CASE WHEN m.new_status = 'fetched' THEN length(f.raw_text) END AS chars
         FROM moves m LEFT JOIN flat f ON f.doc_id = m.doc_id""",
)
def transitions(spark, sf):
    return _moves(spark, sf).select(
        "id", "outcome", "status", "bump", "last_error", "duration_seconds", "content_hash",
        F.col("raw_char_count").cast("bigint").alias("chars"),
    )


@query(
    "t10_apply_transitions",
    "ep moves",
    f"""SELECT ep.id, m.new_status AS status,
              ep.attempts + CASE WHEN m.new_status = 'failed' THEN 1 ELSE 0 END AS attempts,
              coalesce(m.reason, m.error) AS last_error,
              coalesce(CASE WHEN m.kind = 'ok' THEN m.length_seconds END, ep.duration_seconds)
                AS duration_seconds,
              CASE WHEN m.new_status = 'fetched' THEN {_NOW} ELSE ep.fetched_at END AS fetched_at
         FROM ep JOIN moves m ON m.id = ep.id""",
)
def apply_transitions(spark, sf):
    state = transcripts.apply_transitions(fx.episodes(spark, sf), _moves(spark, sf), NOW)
    return state.select(
        "id", "status", "attempts", "last_error", "duration_seconds", "fetched_at"
    )


@query(
    "t11_pass_counts",
    "moves",
    """SELECT count(*) FILTER (WHERE outcome = 'fetched') AS transcripts_fetched,
              count(*) FILTER (WHERE outcome = 'skipped') AS skipped,
              count(*) FILTER (WHERE outcome = 'unavailable') AS unavailable,
              count(*) FILTER (WHERE outcome = 'failed') AS failures FROM moves""",
)
def pass_counts(spark, sf):
    return transcripts.pass_counts(_moves(spark, sf))


# -- requests and results -----------------------------------------------------------------

_REQUEST = """to_json({source: 'youtube', source_type: 'youtube', source_item_id: video_id,
    title: title, text: coalesce(raw_text, ''),
    metadata: {url: source_url, channel: channel_slug, thumbnail_url: thumbnail_url,
               description: CAST(NULL AS VARCHAR), transcript_language: transcript_language,
               transcript_source: transcript_source},
    options: {include_sentiment: true, include_entities: true, include_watchlist: true,
              watchlist_required: false, max_chunk_chars: 12000}"""


@query(
    "f1_build_request",
    "ep",
    f"""SELECT id, sha256(CAST(CASE WHEN published_at IS NULL THEN {_REQUEST}}})
              ELSE {_REQUEST}, observed_at: strftime(published_at, '%Y-%m-%dT%H:%M:%S+00:00')}})
              END AS VARCHAR)) AS digest FROM ep""",
)
def build_request(spark, sf):
    request = distill.request_json()
    return fx.episodes(spark, sf, text=True).select("id", F.sha2(request, 256).alias("digest"))


@query("f2_classify_jobs", "jobs", "SELECT job_id, kind, error FROM jobs")
def classify_jobs(spark, sf):
    return distill.classify_jobs(fx.jobs(spark, sf)).select("job_id", "kind", "error")


@query(
    "f3_extract_results",
    "jobs",
    """SELECT job_id, 'm1' AS model, 'unknown' AS prompt_version, summary,
              'a,b' AS key_topics, '{"n":' || d || '}' AS segments,
              '{"total_tokens":' || d || '}' AS token_usage, 'r' || d AS request_id
         FROM jobs WHERE kind = 'ok'""",
)
def extract_results(spark, sf):
    return distill.classify_jobs(fx.jobs(spark, sf)).filter("kind = 'ok'").select(
        "job_id", "model", "prompt_version", "summary",
        F.array_join("key_topics", ",").alias("key_topics"),
        F.array_join("segments", ",").alias("segments"), "token_usage", "request_id",
    )


_PENDING = """pending AS (SELECT id FROM ep WHERE status = 'fetched' AND distill_job_id IS NOT NULL)"""


def _collected(spark, sf) -> DataFrame:
    return distill.collected(
        queues.pending_distill(fx.episodes(spark, sf)), fx.jobs(spark, sf)
    )



def _after(tables: str, subqueries: str, sql: str) -> str:
    """A query with one more named subquery behind the shared ones."""
    front = with_tables(tables, "")
    return f"{front.rstrip()}, {subqueries} {sql.strip()}"


def query_with(name: str, tables: str, subqueries: str, sql: str):
    def register(fn):
        QUERIES[name] = (fn, _after(tables, subqueries, sql))
        return fn

    return register


@query_with(
    "f4_collect_counts",
    "ep jobs",
    _PENDING,
    """SELECT count(*) FILTER (WHERE kind = 'ok') AS distilled,
              count(*) FILTER (WHERE kind IN ('failed', 'invalid')) AS failures,
              count(*) FILTER (WHERE kind = 'pending') AS pending FROM pending JOIN jobs USING (id)""",
)
def collect_counts(spark, sf):
    return distill.collect_counts(_collected(spark, sf))


@query_with(
    "f4_collect_state",
    "ep jobs",
    _PENDING,
    f"""SELECT ep.id, CASE WHEN j.kind IS NULL OR j.kind = 'pending' THEN ep.status
                          WHEN j.kind = 'ok' THEN 'done' ELSE 'failed' END AS status,
              CASE WHEN j.kind IS NULL OR j.kind = 'pending' THEN ep.distill_job_id END
                AS distill_job_id,
              ep.distill_attempts + CASE WHEN j.kind IN ('failed', 'invalid') THEN 1 ELSE 0 END
                AS distill_attempts,
              CASE WHEN j.kind IS NULL OR j.kind = 'pending' THEN ep.last_error ELSE j.error END
                AS last_error,
              CASE WHEN j.kind = 'ok' THEN {_NOW} ELSE ep.distilled_at END AS distilled_at
         FROM ep LEFT JOIN (SELECT jobs.* FROM jobs JOIN pending USING (id)) j ON j.id = ep.id""",
)
def collect_state(spark, sf):
    state = distill.apply_collected(fx.episodes(spark, sf), _collected(spark, sf), NOW)
    return state.select(
        "id", "status", "distill_job_id", "distill_attempts", "last_error", "distilled_at"
    )


_SUBMIT = """queue AS (SELECT * FROM ep
        WHERE (status = 'fetched' AND distill_job_id IS NULL) OR (status = 'failed'
          AND raw_text IS NOT NULL AND distill_job_id IS NULL AND distill_attempts < 10))"""
_JOB = "sha256(video_id || '|' || distill_attempts || '|b1')"


@query_with(
    "f5_submit_state",
    "ep",
    _SUBMIT,
    f"""SELECT ep.id, CASE WHEN q.id IS NULL THEN ep.status ELSE 'fetched' END AS status,
              CASE WHEN q.id IS NULL THEN ep.last_error END AS last_error,
              CASE WHEN q.id IS NULL THEN ep.distill_job_id
                   ELSE {_JOB.replace('video_id', 'q.video_id').replace('distill_att', 'q.distill_att')}
              END AS distill_job_id, ep.distill_attempts
         FROM ep LEFT JOIN queue q ON q.id = ep.id""",
)
def submit_state(spark, sf):
    episodes = fx.episodes(spark, sf)
    state = distill.apply_submissions(episodes, distill.submissions(episodes, "b1"))
    return state.select("id", "status", "last_error", "distill_job_id", "distill_attempts")


@query_with(
    "f5_submit_counts",
    "ep",
    _SUBMIT,
    "SELECT count(*) AS submitted, CAST(0 AS BIGINT) AS failures FROM queue",
)
def submit_counts(spark, sf):
    return distill.submit_counts(distill.submissions(fx.episodes(spark, sf), "b1"))


@query(
    "f6_mark_failed",
    "ep",
    f"""SELECT ep.id, CASE WHEN d.doc_id IS NULL THEN status ELSE 'failed' END AS status,
              CASE WHEN d.doc_id IS NULL THEN distill_job_id END AS distill_job_id,
              distill_attempts + CASE WHEN d.doc_id IS NULL THEN 0 ELSE 1 END AS distill_attempts,
              CASE WHEN d.doc_id IS NULL THEN last_error ELSE substr(d.text, 1, 500) END
                AS last_error
         FROM ep LEFT JOIN (SELECT documents.* FROM documents JOIN labels USING (doc_id)) d
           ON d.doc_id + 1 = ep.id""",
)
def mark_failed(spark, sf):
    failures = _changes(spark, sf, F.col("text").alias("error"))
    state = distill.mark_distill_failed(fx.episodes(spark, sf), failures)
    return state.select("id", "status", "distill_job_id", "distill_attempts", "last_error")


# A batch of results: one version for every labelled document, one more for the
# good ones, then the first version again for the toxic ones.
_BATCH = """batch AS (
    SELECT doc_id + 1 AS episode_id, 'm' || quality AS model, 'v2' AS prompt_version,
           'first ' || doc_id AS summary, doc_id * 3 AS seq FROM labels
    UNION ALL SELECT doc_id + 1, 'm1', 'v3', 'second ' || doc_id, doc_id * 3 + 1 FROM labels
     WHERE quality = 1
    UNION ALL SELECT doc_id + 1, 'm' || quality, 'v2', 'third ' || doc_id, doc_id * 3 + 2
      FROM labels WHERE toxic = 1)"""


def _result_batch(spark, sf) -> DataFrame:
    labels = fx.table(spark, sf, "labels")
    sql = f"WITH {_BATCH.replace('FROM labels', 'FROM {labels}')} SELECT * FROM batch"
    rows = spark.sql(sql, labels=labels)
    empty = F.array().cast("array<string>")
    nothing = F.lit(None).cast("string")
    return rows.select(
        "*", empty.alias("key_topics"), empty.alias("segments"), nothing.alias("token_usage"),
        F.lit("{}").alias("request_payload"), F.lit("{}").alias("response_payload"),
        nothing.alias("request_id"),
    )


@query_with(
    "f7_versioned_upsert",
    "di",
    _BATCH,
    f"""SELECT o.id, o.episode_id, o.model, o.prompt_version, o.summary,
              o.is_current AND o.episode_id NOT IN (SELECT episode_id FROM batch) AS is_current,
              o.created_at
         FROM di o WHERE (o.episode_id, o.model, o.prompt_version) NOT IN (
              SELECT (episode_id, model, prompt_version) FROM batch)
        UNION ALL
       SELECT o.id, b.episode_id, b.model, b.prompt_version, b.summary,
              b.seq = b.top AS is_current, {_NOW} AS created_at
         FROM (SELECT *, max(seq) OVER (PARTITION BY episode_id) AS top,
                      row_number() OVER (PARTITION BY episode_id, model, prompt_version
                                         ORDER BY seq DESC) AS rn FROM batch) b
         LEFT JOIN di o USING (episode_id, model, prompt_version) WHERE b.rn = 1""",
)
def versioned_upsert(spark, sf):
    """New ids only have to be above the old ones, so they are shown as null."""
    old = fx.distillations(spark, sf)
    merged = distill.upsert_results(old, _result_batch(spark, sf), NOW)
    kept_id = F.when(F.col("id") <= old.agg(F.max("id")).scalar(), F.col("id"))
    return merged.select(
        kept_id.alias("id"), "episode_id", "model", "prompt_version", "summary", "is_current",
        "created_at",
    )


_STALE = """stale AS (SELECT * FROM ep WHERE raw_text IS NOT NULL AND NOT EXISTS (
    SELECT 1 FROM di WHERE di.episode_id = ep.id AND di.is_current
       AND di.model = 'm1' AND di.prompt_version = 'v2'))"""


def _reprocessed(spark, sf):
    episodes = fx.episodes(spark, sf)
    stale = queues.reprocess_candidates(
        episodes, fx.distillations(spark, sf), None, None, True, "m1", "v2"
    )
    return distill.reprocess(episodes, stale, "b1")


@query_with(
    "f8_bulk_reprocess",
    "ep di",
    _STALE,
    """SELECT ep.id, CASE WHEN s.id IS NULL THEN ep.status ELSE 'fetched' END AS status,
              CASE WHEN s.id IS NULL THEN ep.last_error END AS last_error,
              CASE WHEN s.id IS NULL THEN ep.distill_job_id
                   ELSE sha256(ep.video_id || '|0|b1') END AS distill_job_id,
              CASE WHEN s.id IS NULL THEN ep.distill_attempts ELSE 0 END AS distill_attempts
         FROM ep LEFT JOIN stale s ON s.id = ep.id""",
)
def bulk_reprocess(spark, sf):
    state, _, _ = _reprocessed(spark, sf)
    return state.select("id", "status", "last_error", "distill_job_id", "distill_attempts")


@query_with(
    "f8_reprocess_counts",
    "ep di",
    _STALE,
    "SELECT count(*) AS reprocessed, count(*) AS submitted FROM stale",
)
def reprocess_counts(spark, sf):
    return _reprocessed(spark, sf)[2]


# -- run rows -------------------------------------------------------------------------------

_RUN_ROW = ["run_date", "status", *_RUN.split(", "), "last_heartbeat"]
# Dates to start: those of the toxic documents' publication days and two new ones.
_DATES = """dates AS (SELECT DISTINCT DATE '2024-01-16' + CAST(turn AS INTEGER) * 5 AS run_date
    FROM conversations)"""


def _dates(spark, sf) -> DataFrame:
    day = F.date_add(F.lit(date(2024, 1, 16)), F.col("turn").cast("int") * 5)
    return fx.table(spark, sf, "conversations").select(day.alias("run_date")).distinct()


@query_with(
    "r1_start_runs",
    "rn",
    _DATES,
    f"""SELECT coalesce(rn.run_date, d.run_date) AS run_date,
              CASE WHEN d.run_date IS NULL THEN rn.status ELSE 'running' END AS status,
              {', '.join(f'coalesce({c}, 0) AS {c}' for c in _RUN.split(', '))},
              CASE WHEN d.run_date IS NULL THEN rn.last_heartbeat ELSE {_NOW} END AS last_heartbeat
         FROM rn FULL OUTER JOIN dates d ON d.run_date = rn.run_date""",
)
def start_runs(spark, sf):
    return runs.start_runs(fx.ingest_runs(spark, sf), _dates(spark, sf), NOW).select(*_RUN_ROW)


# Deltas: two rows per date, one of them for dates that have no run.
_DELTAS = """deltas AS (SELECT DATE '2024-01-16' + CAST(turn AS INTEGER) * 5 AS run_date,
    1 AS transcripts_fetched, turn AS failures FROM conversations)"""


@query_with(
    "r2_add_counters",
    "rn",
    _DELTAS,
    f"""SELECT rn.run_date, status, episodes_discovered,
              CAST(rn.transcripts_fetched + coalesce(d.fetched, 0) AS BIGINT)
                AS transcripts_fetched, distilled, reprocessed,
              CAST(rn.failures + coalesce(d.failed, 0) AS BIGINT) AS failures,
              CASE WHEN d.run_date IS NULL THEN last_heartbeat ELSE {_NOW} END AS last_heartbeat
         FROM rn LEFT JOIN (SELECT run_date, sum(transcripts_fetched) AS fetched,
                                   sum(failures) AS failed FROM deltas GROUP BY 1) d
           ON d.run_date = rn.run_date""",
)
def add_counters(spark, sf):
    turns = fx.table(spark, sf, "conversations")
    deltas = turns.select(
        F.date_add(F.lit(date(2024, 1, 16)), F.col("turn").cast("int") * 5).alias("run_date"),
        F.lit(1).alias("transcripts_fetched"),
        F.col("turn").alias("failures"),
    )
    return runs.add_counters(fx.ingest_runs(spark, sf), deltas, NOW).select(*_RUN_ROW)


@query_with(
    "r3_finish_runs",
    "rn",
    _DATES,
    f"""SELECT rn.run_date, CASE WHEN d.run_date IS NULL THEN status ELSE 'success' END AS status,
              CASE WHEN d.run_date >= DATE '2024-01-20' THEN '{{"n":1}}' ELSE '{{}}' END AS notes,
              CASE WHEN d.run_date IS NULL THEN last_heartbeat ELSE {_NOW} END AS last_heartbeat
         FROM rn LEFT JOIN dates d ON d.run_date = rn.run_date""",
)
def finish_runs(spark, sf):
    late = F.col("run_date") >= F.lit(date(2024, 1, 20))
    finishes = _dates(spark, sf).select(
        "run_date", F.lit("success").alias("status"), F.when(late, '{"n":1}').alias("notes")
    )
    return runs.finish_runs(fx.ingest_runs(spark, sf), finishes, NOW).select(
        "run_date", "status", "notes", "last_heartbeat"
    )


def _chain(spark, sf) -> DataFrame:
    items = discovery.newest(discovery.first_wins(_recent(spark, sf)))
    found = discovery.discovery_counts(items, discovery.unseen(items, _known(spark, sf)))
    submitted = distill.submit_counts(distill.submissions(fx.episodes(spark, sf), "b1"))
    return runs.chain_result(found, transcripts.pass_counts(_moves(spark, sf)), submitted)


@query_with(
    "r4_full_chain",
    "ep items moves",
    f"{_SUBMIT}, {_FRESH}",
    """SELECT (SELECT count(*) FROM fresh) AS episodes_discovered,
              count(*) FILTER (WHERE outcome = 'fetched') AS transcripts_fetched,
              count(*) FILTER (WHERE outcome = 'skipped') AS skipped,
              count(*) FILTER (WHERE outcome = 'unavailable') AS unavailable,
              (SELECT count(*) FROM queue) AS submitted,
              count(*) FILTER (WHERE outcome = 'failed') AS failures,
              CASE WHEN count(*) FILTER (WHERE outcome = 'failed') > 0 THEN 'partial'
                   ELSE 'success' END AS status FROM moves""",
)
def full_chain(spark, sf):
    return _chain(spark, sf)


@query(
    "r5_stage_accounting",
    "moves rn",
    f"""SELECT run_date, status, episodes_discovered, distilled, reprocessed,
              transcripts_fetched + CASE WHEN hit THEN (SELECT count(*) FROM moves
                WHERE outcome = 'fetched') ELSE 0 END AS transcripts_fetched,
              failures + CASE WHEN hit THEN (SELECT count(*) FROM moves
                WHERE outcome = 'failed') ELSE 0 END AS failures,
              CASE WHEN hit THEN {_NOW} ELSE last_heartbeat END AS last_heartbeat
         FROM (SELECT *, run_date = DATE '2024-01-30' AS hit FROM rn)""",
)
def stage_accounting(spark, sf):
    counts = transcripts.pass_counts(_moves(spark, sf))
    updated = runs.record_stage(
        fx.ingest_runs(spark, sf), counts, RUN_DATE, NOW, "transcripts_fetched"
    )
    return updated.select(*_RUN_ROW)


@query_with(
    "r13_summary_after_pass",
    "ep rn items moves",
    """state AS (
        SELECT id, video_id, published_at, status, attempts, last_error, fetched_at, distilled_at,
               raw_text IS NOT NULL AS has_text FROM ep
        UNION ALL SELECT pos + (SELECT max(id) FROM ep), video_id, published_at, 'discovered', 0,
               NULL, NULL, NULL, false FROM items),
       queue AS (SELECT * FROM state WHERE status = 'discovered'
                  OR (status = 'failed' AND NOT has_text AND attempts < 5)),
       after AS (SELECT coalesce(m.new_status, s.status) AS status,
               CASE WHEN m.id IS NULL THEN s.last_error ELSE coalesce(m.reason, m.error) END
                 AS last_error,
               CASE WHEN m.new_status = 'fetched' THEN TIMESTAMP '2024-02-01 12:30:00'
                    ELSE s.fetched_at END AS fetched_at, s.distilled_at
          FROM state s LEFT JOIN (SELECT moves.* FROM moves JOIN queue USING (video_id)) m
            ON m.video_id = s.video_id)""",
    f"""SELECT {_COMPLETED}, (SELECT count(*) FROM rn) AS runs_total,
               (SELECT CAST(sum(episodes_discovered) AS BIGINT) FROM rn)
                 + (SELECT count(*) FROM items) AS episodes_discovered,
               (SELECT CAST(sum(reprocessed) AS BIGINT) FROM rn) AS reprocessed FROM after""",
)
def flagship(spark, sf):
    return summary_after_pass(spark, sf)
