"""Queries over stored state: lists, lookups, counts and work queues."""

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelmill.operators import queues, reports
from reelmill.plans import fixtures as fx
from reelmill.plans.oracle import with_tables
from reelmill.sources.store import work_dir

QUERIES: dict = {}


def query(name: str, tables: str = "", sql: str | None = None):
    def register(fn):
        QUERIES[name] = (fn, with_tables(tables, sql) if sql else None)
        return fn

    return register


def labelled_ids(spark, sf) -> DataFrame:
    """The key set used by lookups and updates: the labelled documents."""
    return fx.table(spark, sf, "labels").select((F.col("doc_id") + 1).alias("id"))


def _ranked(rows: DataFrame) -> DataFrame:
    """Number the rows of one (already cut) page in its order."""
    place = Window.orderBy(*queues.newest_first())
    return rows.withColumn("pos", F.row_number().over(place).cast("bigint"))


# -- runs ---------------------------------------------------------------------

_RUN = "episodes_discovered, transcripts_fetched, distilled, reprocessed, failures"
_RUN_COLS = ["run_date", "status", *_RUN.split(", ")]


@query("r7_last_run", "rn", f"SELECT run_date, status, {_RUN} FROM rn ORDER BY run_date DESC LIMIT 1")
def last_run(spark, sf):
    return reports.last_run(fx.ingest_runs(spark, sf)).select(*_RUN_COLS)


@query(
    "r8_runs_by_date",
    "rn",
    f"""SELECT run_date, status, {_RUN} FROM rn WHERE run_date IN (
        SELECT CAST(ts AS DATE) FROM events WHERE event_type = 'purchase' AND value >= 60)""",
)
def runs_by_date(spark, sf):
    bought = fx.table(spark, sf, "events").filter("event_type = 'purchase' AND value >= 60")
    dates = bought.select(F.to_date("ts").alias("run_date")).distinct()
    return reports.runs_by_date(fx.ingest_runs(spark, sf), dates).select(*_RUN_COLS)


@query(
    "r9_list_runs",
    "rn",
    f"""SELECT run_date, status, {_RUN}, (SELECT count(*) FROM rn WHERE status = 'partial'
              AND run_date >= DATE '2024-01-02') AS total
          FROM rn WHERE status = 'partial' AND run_date >= DATE '2024-01-02'
         ORDER BY run_date DESC LIMIT 5 OFFSET 5""",
)
def list_runs(spark, sf):
    page = reports.list_runs(
        fx.ingest_runs(spark, sf), "partial", date(2024, 1, 2), page=2, page_size=5
    )
    return page.rows.select(*_RUN_COLS, page.total.scalar().alias("total"))


@query(
    "r9_list_runs_all",
    "rn",
    f"SELECT run_date, status, {_RUN}, (SELECT count(*) FROM rn) AS total FROM rn",
)
def list_all_runs(spark, sf):
    page = reports.list_runs(fx.ingest_runs(spark, sf))
    return page.rows.select(*_RUN_COLS, page.total.scalar().alias("total"))


@query(
    "r10_stats",
    "rn ep",
    f"""SELECT {_RUN}, (SELECT count(*) FROM ep) AS episodes_total,
               strftime(run_date, '%Y-%m-%d') AS last_run_date, status AS last_run_status,
               last_heartbeat FROM rn ORDER BY run_date DESC LIMIT 1""",
)
def stats(spark, sf):
    return reports.stats(fx.ingest_runs(spark, sf), fx.episodes(spark, sf))


@query(
    "r11_totals",
    "rn",
    """SELECT count(*) AS runs_total, CAST(sum(episodes_discovered) AS BIGINT)
              AS episodes_discovered, CAST(sum(reprocessed) AS BIGINT) AS reprocessed,
              CAST(sum(failures) AS BIGINT) AS failures FROM rn""",
)
def totals(spark, sf):
    return reports.totals(fx.ingest_runs(spark, sf))


# -- counts -------------------------------------------------------------------

# The error bucket of an episode; a row without an error has none.
_BUCKET = """CASE
    WHEN starts_with(lower(last_error), 'transcript unavailable for')
      OR starts_with(lower(last_error), 'no transcript available for') THEN 'none'
    WHEN regexp_matches(lower(last_error), '^below .* minimum') THEN 'short'
    WHEN regexp_matches(lower(last_error), '^above .* maximum') THEN 'long'
    WHEN last_error IS NOT NULL THEN 'other' END"""
_COMPLETED = f"""
    count(*) AS episodes_total, count(fetched_at) AS transcripts_fetched,
    count(distilled_at) AS distilled,
    count(CASE WHEN status = 'failed' AND {_BUCKET} = 'other' THEN 1 END) AS failures,
    count(CASE WHEN status = 'skipped' AND {_BUCKET} = 'short' THEN 1 END) AS duration_too_short,
    count(CASE WHEN {_BUCKET} = 'none' THEN 1 END) AS transcript_unavailable"""


@query("r12_completed_counts", "ep", f"SELECT {_COMPLETED} FROM ep")
def completed_counts(spark, sf):
    return reports.completed_counts(fx.episodes(spark, sf))


@query(
    "r13_summary",
    "ep rn",
    f"""SELECT {_COMPLETED}, (SELECT count(*) FROM rn) AS runs_total,
               (SELECT CAST(sum(episodes_discovered) AS BIGINT) FROM rn) AS episodes_discovered,
               (SELECT CAST(sum(reprocessed) AS BIGINT) FROM rn) AS reprocessed FROM ep""",
)
def summary(spark, sf):
    return reports.summary(fx.ingest_runs(spark, sf), fx.episodes(spark, sf))


@query("r14_count_total", "ep", "SELECT count(*) AS episodes_total FROM ep")
def count_total(spark, sf):
    return reports.count_total(fx.episodes(spark, sf))


# -- episode lists ------------------------------------------------------------

_LISTED = """
    SELECT ep.id, ep.video_id, ep.status, ep.attempts, ep.published_at, ep.raw_char_count,
           length(d.summary) AS summary_char_count, d.key_topic_count, d.segment_count
      FROM ep LEFT JOIN (SELECT * FROM di WHERE is_current) d ON d.episode_id = ep.id"""


def _listed(rows: DataFrame, *more) -> DataFrame:
    return rows.select(
        "id", "video_id", "status", "attempts", "published_at",
        F.col("raw_char_count").cast("bigint").alias("raw_char_count"),
        F.col("summary_char_count").cast("bigint").alias("summary_char_count"),
        "key_topic_count", "segment_count", *more,
    )


@query(
    "r15_list_episodes",
    "ep di",
    f"""SELECT * , row_number() OVER (ORDER BY published_at DESC NULLS LAST, id DESC) AS pos,
               (SELECT count(*) FROM ep WHERE published_at >= TIMESTAMP '2024-01-10') AS total
          FROM (SELECT * FROM ({_LISTED}) WHERE published_at >= TIMESTAMP '2024-01-10'
                 ORDER BY published_at DESC NULLS LAST, id DESC LIMIT 25 OFFSET 50)""",
)
def list_episodes(spark, sf):
    page = reports.list_episodes(
        fx.episodes(spark, sf),
        fx.distillations(spark, sf),
        from_date=date(2024, 1, 10),
        page=3,
    )
    return _listed(_ranked(page.rows), "pos", page.total.scalar().alias("total"))


@query(
    "r15_list_episodes_all",
    "ep di",
    f"""{_LISTED} WHERE ep.status = 'done'
          AND CAST(published_at AS DATE) BETWEEN DATE '2024-01-03' AND DATE '2024-01-20'""",
)
def list_all_episodes(spark, sf):
    page = reports.list_episodes(
        fx.episodes(spark, sf),
        fx.distillations(spark, sf),
        status="done",
        from_date=date(2024, 1, 3),
        to_date=date(2024, 1, 20),
    )
    return _listed(page.rows)


@query(
    "r15_list_keyset",
    "ep di",
    f"""SELECT * FROM (SELECT *, row_number() OVER (ORDER BY published_at DESC NULLS LAST, id DESC) AS pos
          FROM ({_LISTED})) WHERE pos BETWEEN 26 AND 65""",
)
def list_keyset(spark, sf):
    """The forty rows after the last one of the first page."""
    episodes, results = fx.episodes(spark, sf), fx.distillations(spark, sf)
    first = episodes.orderBy(*queues.newest_first()).limit(25).select("published_at", "id").collect()
    rows = reports.list_after(episodes, results, reports.Cursor(*first[-1]), 40)
    place = Window.orderBy(*queues.newest_first())
    return _listed(rows, (F.row_number().over(place) + 25).cast("bigint").alias("pos"))


@query(
    "r15_list_deep_page",
    "ep di",
    f"""SELECT * FROM (SELECT *, row_number() OVER (ORDER BY published_at DESC NULLS LAST, id DESC) AS pos
          FROM ({_LISTED}) WHERE published_at >= TIMESTAMP '2024-01-03') WHERE pos BETWEEN 101 AND 150""",
)
def list_deep_page(spark, sf):
    rows = reports.list_page(
        fx.episodes(spark, sf), fx.distillations(spark, sf), 3, work_dir(spark), 50, from_date=date(2024, 1, 3)
    )
    return _listed(rows, "pos")


@query(
    "r16_list_with_summaries",
    "ep di",
    """SELECT p.id, p.status, d.summary, p.pos FROM (
           SELECT id, status, row_number() OVER (ORDER BY published_at DESC NULLS LAST, id DESC)
                  AS pos FROM ep) p
         LEFT JOIN di d ON d.episode_id = p.id AND d.is_current
        WHERE p.pos <= 40""",
)
def list_with_summaries(spark, sf):
    results = fx.distillations(spark, sf)
    page = reports.list_episodes(fx.episodes(spark, sf), results, page=1, page_size=40)
    full = reports.with_summaries(page.rows, results)
    return _ranked(full).select("id", "status", "summary", "pos")


@query(
    "r17_episodes_by_id",
    "ep",
    """SELECT id, video_id, status, length(raw_text) AS chars FROM ep
        WHERE id IN (SELECT doc_id + 1 FROM labels)""",
)
def episodes_by_id(spark, sf):
    found = reports.episodes_by_id(fx.episodes(spark, sf, text=True), labelled_ids(spark, sf))
    return found.select("id", "video_id", "status", F.length("raw_text").cast("bigint").alias("chars"))


@query(
    "r17_episodes_by_video_id",
    "ep",
    """SELECT id, video_id, status, raw_text FROM ep WHERE video_id IN (
           SELECT 'v' || lpad(CAST(vec_id AS VARCHAR), 10, '0') FROM embeddings)""",
)
def episodes_by_video_id(spark, sf):
    wanted = fx.table(spark, sf, "embeddings").select(
        F.concat(F.lit("v"), F.lpad(F.col("vec_id").cast("string"), 10, "0")).alias("video_id")
    )
    found = reports.episodes_by_id(fx.episodes(spark, sf, text=True), wanted, "video_id")
    return found.select("id", "video_id", "status", "raw_text")


_RESULT = "id, episode_id, model, prompt_version, summary, is_current"


@query("r18_current_result", "di", f"SELECT {_RESULT} FROM di WHERE is_current AND episode_id = 10")
def current_result(spark, sf):
    return reports.current_result(fx.distillations(spark, sf), 10).select(*_RESULT.split(", "))


@query(
    "r19_current_results",
    "di",
    f"""SELECT {_RESULT} FROM di
         WHERE is_current AND episode_id IN (SELECT doc_id + 1 FROM labels)""",
)
def current_results(spark, sf):
    found = reports.current_results(fx.distillations(spark, sf), labelled_ids(spark, sf))
    return found.select(*_RESULT.split(", "))


@query(
    "r20_episode_detail",
    "ep di",
    """SELECT ep.id, ep.status, length(ep.raw_text) AS chars, d.summary, d.model,
              d.prompt_version, d.id AS result_id
         FROM ep LEFT JOIN di d ON d.episode_id = ep.id AND d.is_current
        WHERE ep.id IN (SELECT doc_id + 1 FROM labels)""",
)
def episode_detail(spark, sf):
    detail = reports.episode_detail(
        fx.episodes(spark, sf, text=True), fx.distillations(spark, sf), labelled_ids(spark, sf)
    )
    return detail.select(
        "id",
        "status",
        F.length("raw_text").cast("bigint").alias("chars"),
        "summary",
        F.col("distillation.model").alias("model"),
        F.col("distillation.prompt_version").alias("prompt_version"),
        F.col("distillation.id").alias("result_id"),
    )


# -- queues -------------------------------------------------------------------

_QUEUE = "id, video_id, status, attempts, distill_attempts, distill_job_id"
_QUEUE_COLS = _QUEUE.split(", ")
_QUEUES = {
    "q1_needing_transcript": (
        queues.needing_transcript,
        "status = 'discovered' OR (status = 'failed' AND raw_text IS NULL AND attempts < 5)",
    ),
    "q2_needing_distill": (
        queues.needing_distill,
        """(status = 'fetched' AND distill_job_id IS NULL) OR (status = 'failed'
           AND raw_text IS NOT NULL AND distill_job_id IS NULL AND distill_attempts < 10)""",
    ),
    "q3_pending_distill": (
        queues.pending_distill,
        "status = 'fetched' AND distill_job_id IS NOT NULL",
    ),
}


def _queue(name: str, select, condition: str) -> None:
    """A queue over the whole table, and the newest 200 of it in their order."""

    @query(name, "ep", f"SELECT {_QUEUE} FROM ep WHERE {condition}")
    def whole(spark, sf):
        return select(fx.episodes(spark, sf)).select(*_QUEUE_COLS)

    @query(
        f"{name}_200",
        "ep",
        f"""SELECT {_QUEUE}, pos FROM (
            SELECT *, row_number() OVER (ORDER BY published_at DESC NULLS LAST, id DESC) AS pos
              FROM ep WHERE {condition}) WHERE pos <= 200""",
    )
    def newest(spark, sf):
        return _ranked(select(fx.episodes(spark, sf), 200)).select(*_QUEUE_COLS, "pos")


for _name, (_select, _condition) in _QUEUES.items():
    _queue(_name, _select, _condition)


_FOUND = ["id", "video_id", "status", "attempts", "last_error"]


@query(
    "q4_failed_candidates",
    "ep",
    f"""SELECT {', '.join(_FOUND)} FROM ep WHERE status = 'failed' AND attempts < 4
          AND CAST(published_at AS DATE) >= DATE '2024-01-05'
          AND CAST(published_at AS DATE) <= DATE '2024-01-25'""",
)
def failed_candidates(spark, sf):
    found = queues.failed_candidates(
        fx.episodes(spark, sf), date(2024, 1, 5), date(2024, 1, 25), 4
    )
    return found.select(*_FOUND)


@query(
    "q5_reprocess_candidates",
    "ep di",
    f"""SELECT {', '.join(_FOUND)} FROM ep WHERE raw_text IS NOT NULL AND NOT EXISTS (
           SELECT 1 FROM di WHERE di.episode_id = ep.id AND di.is_current
              AND di.model = 'm1' AND di.prompt_version = 'v2')""",
)
def stale_candidates(spark, sf):
    found = queues.reprocess_candidates(
        fx.episodes(spark, sf),
        fx.distillations(spark, sf),
        only_stale=True,
        model="m1",
        prompt_version="v2",
    )
    return found.select(*_FOUND)


@query(
    "q5_reprocess_candidates_all",
    "ep",
    f"""SELECT {', '.join(_FOUND)} FROM ep WHERE raw_text IS NOT NULL
          AND CAST(published_at AS DATE) >= DATE '2024-01-12'""",
)
def all_candidates(spark, sf):
    found = queues.reprocess_candidates(
        fx.episodes(spark, sf),
        fx.distillations(spark, sf),
        from_date=date(2024, 1, 12),
        only_stale=True,
        model="m1",
    )
    return found.select(*_FOUND)


@query(
    "q7_date_range",
    "",
    """SELECT event_id, user_id FROM events
        WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-07' AND DATE '2024-01-21'""",
)
def date_range(spark, sf):
    from reelmill.functions.times import in_date_range

    events = fx.table(spark, sf, "events")
    inside = in_date_range(events, "ts", date(2024, 1, 7), date(2024, 1, 21))
    return events.filter(inside).select("event_id", "user_id")
