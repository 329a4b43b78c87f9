"""Queries that go through landed files, the state store and the streams.

Landed documents and stored state are derived from the given tables and written
to the shared folder; each run uses a new directory of its own.
"""

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelmill import schemas
from reelmill.operators import changes as ch
from reelmill.operators import discovery, distill, reports, transcripts
from reelmill.plans import fixtures as fx
from reelmill.plans import passes
from reelmill.plans.checks_inputs import naive
from reelmill.plans.checks_reads import _RUN
from reelmill.plans.checks_state import _KNOWN, _REQUEST, RUN_DATE, _after
from reelmill.plans.oracle import hashed, with_tables
from reelmill.sources import landed, outbox
from reelmill.sources.store import StateStore, Write, work_dir
from reelmill.streaming import jobs as streams

QUERIES: dict = {}
NOW = fx.NOW
_NOW = "TIMESTAMP '2024-02-01 12:30:00'"
SETTINGS = passes.Settings(min_seconds=30, max_seconds=600)


def query(name: str, tables: str = "", sql: str | None = None, more: str = ""):
    def register(fn):
        checked = None
        if sql:
            checked = _after(tables, more, sql) if more else with_tables(tables, sql)
        QUERIES[name] = (fn, checked)
        return fn

    return register


# -- landing ------------------------------------------------------------------------

#: Entries per landed feed document: no document grows with its channel.
PER_DOC = 200


def land_feeds(spark, sf, path: str) -> None:
    """Feed documents of up to PER_DOC entries, received in event order."""
    rows = fx.feed(spark, sf)
    entry = F.struct("feed_pos", *[f.name for f in schemas.FEED_ROW.fields])
    docs = rows.groupBy("channel", F.expr(f"feed_pos div {PER_DOC}").alias("part")).agg(
        F.array_sort(F.collect_list(entry)).alias("entries")
    )
    received = F.timestamp_seconds(F.col("part")).alias("received_at")
    results = F.transform("entries", lambda e: e.dropFields("feed_pos")).alias("results")
    docs.select("channel", received, results).write.mode("overwrite").json(path)


def land_responses(spark, sf, path: str) -> None:
    fx.responses(spark, sf).drop("doc_id").repartition(4).write.mode("overwrite").json(path)


def land_jobs(spark, sf, path: str) -> None:
    """Job documents with their result as a nested object, as the service sends them."""
    job = F.struct("job_id", "status", "error", "received_at")
    head = F.regexp_replace(F.to_json(job), r"\}\z", "")
    tail = F.coalesce(F.concat(F.lit(',"result":'), "result"), F.lit(""))
    line = F.concat(head, tail, F.lit("}")).alias("value")
    fx.jobs(spark, sf).select(line).repartition(4).write.mode("overwrite").text(path)


# -- sources --------------------------------------------------------------------------


def _stored(rows: DataFrame, name: str) -> list:
    """Fixture columns in the stored types (instants instead of zone-free times)."""
    return [
        (F.col(f.name) if f.name in rows.columns else F.lit(None))
        .cast(f.dataType.simpleString())
        .alias(f.name)
        for f in schemas.TABLES[name].fields
    ]


def seeded(spark, sf, episodes: DataFrame | None = None, buckets: int = 8) -> StateStore:
    """A store holding the fixture state."""
    store = StateStore(spark, f"{work_dir(spark)}/state", buckets)
    full = fx.episodes(spark, sf, text=True) if episodes is None else episodes
    if episodes is None:  # the texts below are the first commit
        full = full.withColumn("text_version", F.when(F.col("raw_text").isNotNull(), F.lit(1)))
    in_bucket = full.withColumn("bucket", store.bucket_of(F.col("video_id")))
    writes = {"episodes": Write(in_bucket.select(*_stored(full, "episodes"), "bucket"))}
    if episodes is None:
        texts = in_bucket.filter(F.col("raw_text").isNotNull())
        writes["texts"] = Write(texts.select(*_stored(full, "texts"), "bucket"))
        results = fx.distillations(spark, sf)
        home = in_bucket.select(F.col("id").alias("episode_id"), "bucket")
        typed = results.select(*_stored(results, "distillations"))
        writes["distillations"] = Write(typed.join(home, "episode_id"))
    runs = fx.ingest_runs(spark, sf)
    writes["ingest_runs"] = Write(runs.select(*_stored(runs, "ingest_runs"), F.lit(0).alias("bucket")))
    store.commit(writes)
    return store


def unanswered(spark, sf) -> DataFrame:
    """Every document as a discovered episode without text."""
    queue = fx.response_queue(spark, sf)
    return queue.select(
        "*", F.lit("c").alias("channel_slug"), F.lit("u").alias("source_url"),
        F.lit("discovered").alias("status"), F.lit(0).alias("distill_attempts"),
    )


_ITEM = "video_id, channel_slug, title, source_url, thumbnail_url, description, published_at"


@query("s1_feed_source", "items", f"SELECT {_ITEM} FROM items")
def feed_source(spark, sf):
    path = f"{work_dir(spark)}/feeds"
    land_feeds(spark, sf, path)
    targets = discovery.with_channel_ref(discovery.channel_targets(spark, fx.CHANNELS))
    rows = landed.feed_rows(landed.read_feeds(spark, path))
    found = discovery.normalise_feed(discovery.join_feeds(targets, rows))
    items = discovery.newest(
        discovery.first_wins(discovery.within_lookback(found, fx.AS_OF))
    )
    return items.select(*_ITEM.split(", ")[:-1], naive("published_at"))


@query(
    "s2_response_source",
    "answers flat",
    """SELECT a.video_id, a.http_status, a.kind, a.error,
              CASE WHEN a.kind = 'ok' THEN sha256(f.raw_text) END AS digest
         FROM answers a LEFT JOIN flat f ON f.doc_id = a.doc_id""",
)
def response_source(spark, sf):
    path = f"{work_dir(spark)}/responses"
    land_responses(spark, sf, path)
    answers = transcripts.classify(landed.read_responses(spark, path), with_text=True)
    digest = F.sha2("text", 256).alias("digest")
    return answers.select("video_id", "http_status", "kind", "error", digest)


@query(
    "s3_job_source",
    "jobs",
    "SELECT job_id, kind, error, summary FROM jobs",
)
def job_source(spark, sf):
    path = f"{work_dir(spark)}/jobs"
    land_jobs(spark, sf, path)
    classified = distill.classify_jobs(landed.read_jobs(spark, path))
    return classified.select("job_id", "kind", "error", "summary")


@query(
    "s5_request_outbox",
    "ep",
    f"""SELECT 'b1' AS batch, sha256(video_id || '|' || distill_attempts || '|b1') AS job_id,
              sha256(CAST(CASE WHEN published_at IS NULL THEN {_REQUEST}}})
              ELSE {_REQUEST}, observed_at: strftime(published_at, '%Y-%m-%dT%H:%M:%S+00:00')}})
              END AS VARCHAR)) AS digest FROM ep WHERE raw_text IS NOT NULL""",
)
def request_outbox(spark, sf):
    """Every text written as a request document and read back."""
    path = f"{work_dir(spark)}/outbox"
    full = fx.episodes(spark, sf, text=True).filter(F.col("raw_text").isNotNull())
    rows = full.select(distill.job_id_for("b1").alias("job_id"), distill.request_json().alias("request"))
    outbox.write_requests(rows, f"{path}/batch=b1/commit=1")
    digest = F.sha2("request", 256).alias("digest")
    return outbox.read_requests(spark, f"{path}/batch=b1/commit=1").select("batch", "job_id", digest)


@query(
    "s6_table_snapshot",
    "ep",
    """SELECT ep.id, CASE WHEN l.id IS NULL THEN ep.status ELSE 'discovered' END AS status,
              CASE WHEN l.id IS NULL THEN ep.last_error END AS last_error,
              CASE WHEN l.id IS NULL THEN length(ep.raw_text) END AS chars, ep.published_at
         FROM ep LEFT JOIN (SELECT doc_id + 1 AS id FROM labels WHERE toxic = 1) l ON l.id = ep.id""",
)
def table_snapshot(spark, sf):
    """State written, some buckets replaced by a second commit, then read with texts."""
    store = seeded(spark, sf)
    toxic = fx.table(spark, sf, "labels").filter("toxic = 1")
    ids = toxic.select((F.col("doc_id") + 1).alias("id"))
    changes = store.stage(
        reports.episodes_by_id(store.read("episodes"), ids).select("id", "bucket"), "changes"
    )
    touched = store.touched(changes)
    state = ch.reset_full(store.read("episodes", touched), changes.select("id"))
    store.commit({"episodes": Write(state, touched)})
    full = reports.with_text(store.read("episodes"), store.read("texts"))
    return full.select(
        "id", "status", "last_error", F.length("raw_text").cast("bigint").alias("chars"),
        naive("published_at"),
    )


# -- retry and requeue --------------------------------------------------------------------

# Every failed episode is reset and meets its newest response; delete limit 4.
_RETRY = """
    cand AS (SELECT * FROM ep WHERE status = 'failed'),
    tried AS (SELECT m.* FROM moves m JOIN cand USING (id) WHERE cand.attempts < 4),
    after AS (SELECT *, attempts + CASE WHEN new_status = 'failed' THEN 1 ELSE 0 END AS total
                FROM tried)"""


def _retried(spark, sf) -> tuple[StateStore, DataFrame]:
    store = seeded(spark, sf)
    counts = passes.retry_failed(
        store, fx.responses(spark, sf), NOW, SETTINGS, delete_after=4
    )
    return store, counts


@query(
    "q6_retry_state",
    "ep moves",
    """SELECT ep.id, coalesce(a.new_status, ep.status) AS status,
              CASE WHEN a.id IS NULL THEN ep.attempts ELSE a.total END AS attempts,
              CASE WHEN a.id IS NULL THEN ep.last_error ELSE coalesce(a.reason, a.error) END
                AS last_error
         FROM ep LEFT JOIN after a ON a.id = ep.id
        WHERE NOT (ep.status = 'failed' AND ep.attempts >= 4)
          AND NOT coalesce(a.new_status = 'failed' AND a.total >= 4, false)""",
    _RETRY,
)
def retry_state(spark, sf):
    store, _ = _retried(spark, sf)
    return store.read("episodes").select("id", "status", "attempts", "last_error")


@query(
    "q6_retry_counts",
    "ep moves",
    """SELECT count(*) FILTER (WHERE outcome = 'fetched') AS transcripts_fetched,
              count(*) FILTER (WHERE outcome = 'skipped') AS skipped,
              count(*) FILTER (WHERE outcome = 'unavailable') AS unavailable,
              count(*) FILTER (WHERE outcome = 'failed') AS failures,
              count(*) FILTER (WHERE new_status = 'failed' AND total >= 4)
                + (SELECT count(*) FROM cand WHERE attempts >= 4) AS deleted,
              count(*) AS retried, count(*) AS reprocessed FROM after""",
    _RETRY,
)
def retry_counts(spark, sf):
    return _retried(spark, sf)[1]


# Ids to requeue: one per conversation turn text owner, some of them unknown.
_ASKED = """asked AS (SELECT DISTINCT 'v' || lpad(CAST(conv_id * 9 AS VARCHAR), 10, '0')
    AS video_id FROM conversations)"""


def _asked(spark, sf) -> DataFrame:
    number = F.lpad((F.col("conv_id") * 9).cast("string"), 10, "0")
    return fx.table(spark, sf, "conversations").select(
        F.concat(F.lit("v"), number).alias("video_id")
    )


@query(
    "f9_requeue",
    "ep moves",
    f"""SELECT a.video_id, coalesce(m.outcome, 'not_found') AS outcome,
              CASE WHEN m.id IS NOT NULL THEN m.new_status END AS status,
              CASE WHEN m.new_status = 'fetched' THEN sha256(a.video_id || '|0|r1|2') END
                AS distill_job_id
         FROM asked a LEFT JOIN (SELECT m.* FROM moves m) m ON m.video_id = a.video_id""",
    _ASKED,
)
def requeue(spark, sf):
    store, (outcomes, _) = _requeued(spark, sf)
    state = store.read("episodes").select("video_id", "status", "distill_job_id")
    return outcomes.join(state, "video_id", "left").select(
        "video_id", "outcome", "status", "distill_job_id"
    )


def _requeued(spark, sf) -> tuple[StateStore, passes.Requeued]:
    store = seeded(spark, sf)
    return store, passes.requeue(
        store, _asked(spark, sf), fx.responses(spark, sf), f"{store.root}/outbox", "r1", NOW, SETTINGS
    )


_COUNTED = """count(*) FILTER (WHERE m.outcome = 'fetched') AS transcripts_fetched,
              count(*) FILTER (WHERE m.outcome = 'skipped') AS skipped,
              count(*) FILTER (WHERE m.outcome = 'unavailable') AS unavailable,
              count(*) FILTER (WHERE m.outcome = 'failed') AS failures,
              count(m.id) AS reprocessed"""


@query(
    "f9_requeue_counts",
    "moves",
    f"""SELECT {_COUNTED}, count(*) FILTER (WHERE m.outcome = 'fetched') AS submitted
          FROM asked a LEFT JOIN moves m ON m.video_id = a.video_id""",
    _ASKED,
)
def requeue_counts(spark, sf):
    return _requeued(spark, sf)[1].counts


@query(
    "f9_requeue_requests",
    "ep moves flat",
    """SELECT sha256(a.video_id || '|0|r1|2') AS job_id, f.raw_text AS text
         FROM asked a JOIN moves m ON m.video_id = a.video_id AND m.outcome = 'fetched'
         JOIN flat f ON f.doc_id = m.doc_id""",
    _ASKED,
)
def requeue_requests(spark, sf):
    """The requests that the requeue's commit has sent, with the new texts."""
    store, _ = _requeued(spark, sf)
    sent = outbox.sent_requests(store)
    return sent.select("job_id", F.get_json_object("request", "$.text").alias("text"))


@query(
    "f9_restart",
    "moves",
    f"SELECT {_COUNTED} FROM asked a LEFT JOIN moves m ON m.video_id = a.video_id",
    _ASKED,
)
def restart(spark, sf):
    store = seeded(spark, sf)
    return passes.restart(store, _asked(spark, sf), fx.responses(spark, sf), NOW, SETTINGS).counts


# -- submission, chain, deletion ------------------------------------------------------------

_QUEUED = """queue AS (SELECT * FROM ep WHERE (status = 'fetched' AND distill_job_id IS NULL)
    OR (status = 'failed' AND raw_text IS NOT NULL AND distill_job_id IS NULL
        AND distill_attempts < 10))"""


def land_receipts(spark, sf, path: str) -> None:
    fx.receipts(spark, sf).repartition(4).write.mode("overwrite").json(path)


def _acknowledged(spark, sf) -> StateStore:
    """Receipts in several micro-batches, then all of them again."""
    store = seeded(spark, sf)
    path = f"{store.root}/receipts"
    land_receipts(spark, sf, path)
    for name in ("receipts", "again"):
        streams.receipts(
            store, path, f"{store.root}/outbox", NOW, RUN_DATE, SETTINGS, 2, name
        ).awaitTermination()
    return store


@query(
    "f5_submit_receipts",
    "ep",
    """SELECT ep.id, CASE WHEN q.id IS NULL THEN ep.status WHEN k < 2 THEN 'failed' ELSE 'fetched' END
                AS status,
              CASE WHEN q.id IS NULL THEN ep.distill_job_id
                   WHEN k > 1 THEN 'k' || (ep.id - 1) END AS distill_job_id,
              CASE WHEN q.id IS NULL THEN ep.last_error WHEN k = 1 THEN 'queue full for ' || (ep.id - 1)
                   WHEN k = 0 THEN
                     'the summarisation service did not return a job_id for the process request'
              END AS last_error,
              ep.distill_attempts + CASE WHEN q.id IS NULL OR k > 1 THEN 0 ELSE 1 END
                AS distill_attempts
         FROM (SELECT *, (id - 1) % 11 AS k FROM ep) ep LEFT JOIN queue q ON q.id = ep.id""",
    _QUEUED,
)
def submit_receipts(spark, sf):
    """A receipt counts once, however often it lands."""
    return _acknowledged(spark, sf).read("episodes").select(
        "id", "status", "distill_job_id", "last_error", "distill_attempts"
    )


@query(
    "f5_submit_receipt_requests",
    "ep",
    """SELECT 'k' || (id - 1) AS job_id, raw_text AS text FROM queue WHERE (id - 1) % 11 > 1""",
    _QUEUED,
)
def submit_receipt_requests(spark, sf):
    """Each accepted request is in the outbox once."""
    sent = outbox.sent_requests(_acknowledged(spark, sf))
    return sent.select("job_id", F.get_json_object("request", "$.text").alias("text"))


@query(
    "f5_submit_requests",
    "ep",
    """SELECT sha256(video_id || '|' || distill_attempts || '|b1|2') AS job_id, raw_text AS text
         FROM queue""",
    _QUEUED,
)
def submit_requests(spark, sf):
    store = seeded(spark, sf)
    passes.submit(store, f"{store.root}/outbox", "b1", NOW, RUN_DATE, SETTINGS)
    sent = outbox.sent_requests(store)
    return sent.select("job_id", F.get_json_object("request", "$.text").alias("text"))


def _chained(spark, sf, times: int) -> StateStore:
    store = seeded(spark, sf, unanswered(spark, sf))
    feeds, answers = f"{store.root}/feeds", f"{store.root}/responses"
    land_feeds(spark, sf, feeds)
    land_responses(spark, sf, answers)
    targets = discovery.channel_targets(spark, fx.CHANNELS)
    for _ in range(times):
        passes.run_chain(
            store, landed.read_feeds(spark, feeds), targets, landed.read_responses(spark, answers),
            f"{store.root}/outbox", "c1", fx.AS_OF, RUN_DATE, SETTINGS,
        )
    return store


@query(
    "r4_chain_twice",
    "moves firsts rn",
    """SELECT video_id, new_status AS status,
              attempts + CASE WHEN new_status = 'failed' THEN 1 ELSE 0 END AS attempts,
              CASE WHEN new_status = 'fetched' THEN sha256(video_id || '|0|c1|2') END
                AS distill_job_id FROM moves
        UNION ALL SELECT video_id, 'discovered', 0, NULL FROM firsts""",
)
def chain_twice(spark, sf):
    """A second chain over the same landed files changes no episode."""
    return _chained(spark, sf, 2).read("episodes").select(
        "video_id", "status", "attempts", "distill_job_id"
    )


@query(
    "r4_chain_twice_run",
    "moves firsts rn",
    """SELECT run_date, status, reprocessed, distilled,
              episodes_discovered + CASE WHEN hit THEN (SELECT count(*) FROM firsts) ELSE 0 END
                AS episodes_discovered,
              transcripts_fetched + CASE WHEN hit THEN (SELECT count(*) FROM moves
                WHERE outcome = 'fetched') ELSE 0 END AS transcripts_fetched,
              failures + CASE WHEN hit THEN (SELECT count(*) FROM moves
                WHERE outcome = 'failed') ELSE 0 END AS failures
         FROM (SELECT * REPLACE (CASE WHEN run_date = DATE '2024-01-30' THEN 'success' ELSE status END
                 AS status), run_date = DATE '2024-01-30' AS hit FROM rn)""",
)
def chain_twice_run(spark, sf):
    """Counters of both chains: the second has nothing to count and succeeds."""
    runs = _chained(spark, sf, 2).read("ingest_runs")
    return runs.select("run_date", "status", *_RUN.split(", "))


_GONE = "gone AS (SELECT doc_id + 1 AS id FROM labels WHERE toxic = 1)"


def _deleted(spark, sf, fold: bool) -> StateStore:
    store = seeded(spark, sf)
    toxic = fx.table(spark, sf, "labels").filter("toxic = 1")
    passes.delete(store, toxic.select((F.col("doc_id") + 1).alias("id")))
    if fold:
        passes.fold_deleted(store)
    return store


def _deletion_query(name: str, fold: bool) -> None:
    @query(
        f"u8_delete_texts{name}",
        "ep",
        """SELECT ep.id, ep.raw_text FROM ep WHERE raw_text IS NOT NULL
              AND id NOT IN (SELECT id FROM gone)""",
        _GONE,
    )
    def texts(spark, sf):
        return _deleted(spark, sf, fold).read("texts").select("id", "raw_text")

    @query(
        f"u8_delete_results{name}",
        "di",
        "SELECT id, episode_id, summary FROM di WHERE episode_id NOT IN (SELECT id FROM gone)",
        _GONE,
    )
    def results(spark, sf):
        return _deleted(spark, sf, fold).read("distillations").select("id", "episode_id", "summary")


_deletion_query("", False)
_deletion_query("_folded", True)


# Every event is a change of the episode of its user, in the order of the events.
_CHANGED = f"""
    change AS (SELECT user_id + 1 AS id, event_id AS seq,
        CASE WHEN event_id % 13 = 0 THEN 'again' ELSE event_type END AS op FROM events),
    turn AS (SELECT c.*, bool_or(op = 'signup') OVER (PARTITION BY c.id ORDER BY seq
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS lost, ep.raw_text
          FROM change c JOIN ep ON ep.id = c.id),
    counted AS (SELECT *, max(CASE WHEN op IN ('signup', 'again') THEN seq END)
               OVER (PARTITION BY id) AS since FROM turn
         WHERE op <> 'again' OR (raw_text IS NOT NULL AND NOT coalesce(lost, false))),
    merged AS (SELECT id,
        arg_max(CASE op WHEN 'signup' THEN 'discovered' WHEN 'click' THEN 'failed'
                WHEN 'error' THEN 'failed' WHEN 'again' THEN 'fetched' END, seq)
          FILTER (WHERE op IN ('signup', 'click', 'error', 'again')) AS status,
        arg_max(CASE WHEN op IN ('click', 'error') THEN op || ' ' || seq ELSE '' END, seq)
          FILTER (WHERE op IN ('signup', 'click', 'error', 'again')) AS error,
        arg_max(CASE WHEN op = 'purchase' THEN 'p' || seq ELSE '' END, seq)
          FILTER (WHERE op IN ('signup', 'purchase', 'error', 'again')) AS job,
        count(*) FILTER (WHERE op = 'click') AS tries, any_value(since) AS since,
        count(*) FILTER (WHERE op = 'error' AND (since IS NULL OR seq > since)) AS failures,
        arg_max(op = 'view', seq) FILTER (WHERE op IN ('signup', 'view')) AS touched,
        bool_or(op = 'signup') AS lost
          FROM counted GROUP BY id)"""


def event_patches(spark, sf) -> DataFrame:
    """The events as patches: a reset, a touch, a new status, a job, a failure, a reprocess."""
    seq = F.col("event_id")
    rows = fx.table(spark, sf, "events").select(
        (F.col("user_id") + 1).alias("id"),
        seq.alias("seq"),
        F.when(seq % 13 == 0, "again").otherwise(F.col("event_type")).alias("op"),
    )

    def of(op: str, **columns) -> DataFrame:
        return rows.filter(F.col("op") == op).withColumns(columns)

    error = F.concat_ws(" ", "op", F.col("seq"))
    clicks = of("click", status=F.lit("failed"), last_error=error, bump=F.lit(1))
    every = [
        ch.reset_patches(of("signup")),
        ch.touch_patches(of("view"), NOW),
        ch.status_patches(clicks),
        ch.job_patches(of("purchase", distill_job_id=F.concat(F.lit("p"), F.col("seq")))),
        ch.failed_patches(of("error", error=error), 500),
        ch.reprocess_patches(of("again")),
    ]
    whole = every[0]
    for part in every[1:]:
        whole = whole.unionByName(part)
    return whole


_PATCHED = f"""SELECT ep.id, coalesce(m.status, ep.status) AS status,
          CASE WHEN m.error IS NULL THEN ep.last_error WHEN m.error <> '' THEN m.error END AS last_error,
          CASE WHEN m.job IS NULL THEN ep.distill_job_id WHEN m.job <> '' THEN m.job END
            AS distill_job_id,
          CAST(ep.attempts + coalesce(m.tries, 0) AS INTEGER) AS attempts,
          CAST(CASE WHEN m.since IS NULL THEN ep.distill_attempts ELSE 0 END
            + coalesce(m.failures, 0) AS INTEGER) AS distill_attempts,
          CASE WHEN m.touched THEN {_NOW} WHEN m.touched IS NULL THEN ep.distilled_at END
            AS distilled_at,
          CASE WHEN m.lost THEN NULL ELSE ep.raw_char_count END AS raw_char_count
     FROM ep LEFT JOIN merged m ON m.id = ep.id"""
_PATCH_COLS = ["id", "status", "last_error", "distill_job_id", "attempts", "distill_attempts"]


@query("u7_composed_changes", "ep", _PATCHED, _CHANGED)
def composed_changes(spark, sf):
    """Many changes of one episode as one."""
    episodes = fx.episodes(spark, sf)
    one = ch.compose(event_patches(spark, sf), episodes)
    rest = [naive("distilled_at"), F.col("raw_char_count").cast("bigint").alias("raw_char_count")]
    return ch.apply_patches(episodes, one).select(*_PATCH_COLS, *rest)


@query("u7_amended_store", "ep", _PATCHED, _CHANGED)
def amended_store(spark, sf):
    """The same through the store, in one commit."""
    store = seeded(spark, sf)
    passes.amend(store, event_patches(spark, sf))
    rest = [naive("distilled_at"), F.col("raw_char_count").cast("bigint").alias("raw_char_count")]
    return store.read("episodes").select(*_PATCH_COLS, *rest)


# -- streams ----------------------------------------------------------------------------------


@query(
    "x1_incremental_discovery",
    "recent",
    f"""SELECT video_id, status, attempts, (SELECT count(DISTINCT video_id) FROM recent
              WHERE video_id NOT IN (SELECT video_id FROM {_KNOWN})) AS discovered FROM (
        SELECT DISTINCT video_id, 'discovered' AS status, 0 AS attempts FROM recent
         WHERE video_id NOT IN (SELECT video_id FROM {_KNOWN})
        UNION ALL SELECT video_id, 'done', 2 FROM {_KNOWN})""",
)
def incremental_discovery(spark, sf):
    """Feeds in several micro-batches over known episodes, then all of them again."""
    known = fx.table(spark, sf, "supplier").select(
        (F.col("s_suppkey") + 1000).alias("id"),
        F.concat(F.lit("u"), F.col("s_suppkey") * 3).alias("video_id"),
        F.lit("c").alias("channel_slug"), F.lit("u").alias("source_url"),
        F.lit("done").alias("status"), F.lit(2).alias("attempts"),
        F.lit(0).alias("distill_attempts"),
    )
    store = seeded(spark, sf, known)
    path = f"{store.root}/feeds"
    land_feeds(spark, sf, path)
    everything = passes.Settings(max_items=None)
    run_date = datetime(2024, 3, 1).date()
    for name in ("discover", "again"):
        streams.discover(
            store, path, fx.CHANNELS, fx.AS_OF, run_date, everything, 3, name
        ).awaitTermination()
    run = store.read("ingest_runs").filter(F.col("run_date") == F.lit(run_date))
    discovered = run.select("episodes_discovered").scalar().alias("discovered")
    return store.read("episodes").select("video_id", "status", "attempts", discovered)


_MOVED = f"""SELECT m.id, m.new_status AS status,
              m.attempts + CASE WHEN m.new_status = 'failed' THEN 1 ELSE 0 END AS attempts,
              coalesce(m.reason, m.error) AS last_error,
              CASE WHEN m.new_status = 'fetched' THEN {hashed('f.raw_text')} END AS content_hash,
              CASE WHEN m.new_status = 'fetched' THEN sha256(f.raw_text) END AS text_digest
         FROM moves m LEFT JOIN flat f ON f.doc_id = m.doc_id"""


def _fetched(spark, sf) -> StateStore:
    store = seeded(spark, sf, unanswered(spark, sf))
    path = f"{store.root}/responses"
    land_responses(spark, sf, path)
    for _ in range(2):  # the second run finds nothing new
        streams.fetch(store, path, NOW, RUN_DATE, SETTINGS, 2).awaitTermination()
    return store


@query("x2_incremental_fetch", "moves flat", _MOVED)
def incremental_fetch(spark, sf):
    store = _fetched(spark, sf)
    full = reports.with_text(store.read("episodes"), store.read("texts"))
    digest = F.sha2("raw_text", 256).alias("text_digest")
    return full.select("id", "status", "attempts", "last_error", "content_hash", digest)


@query(
    "x4_batch_run_counters",
    "moves rn",
    f"""SELECT run_date, {_RUN.replace('transcripts_fetched', '''transcripts_fetched + CASE WHEN hit
                THEN (SELECT count(*) FROM moves WHERE outcome = 'fetched') ELSE 0 END
                AS transcripts_fetched''').replace('failures', '''failures + CASE WHEN hit THEN
                (SELECT count(*) FROM moves WHERE outcome = 'failed') ELSE 0 END AS failures''')}
         FROM (SELECT *, run_date = DATE '2024-01-30' AS hit FROM rn)""",
)
def batch_run_counters(spark, sf):
    return _fetched(spark, sf).read("ingest_runs").select("run_date", *_RUN.split(", "))


@query(
    "x3_incremental_collect",
    "ep di jobs",
    f"""SELECT ep.id, CASE WHEN j.kind IS NULL OR j.kind = 'pending' THEN ep.status
                          WHEN j.kind = 'ok' THEN 'done' ELSE 'failed' END AS status,
              CASE WHEN j.kind IS NULL OR j.kind = 'pending' THEN ep.distill_job_id END
                AS distill_job_id,
              CASE WHEN j.kind IS NULL OR j.kind = 'pending' THEN ep.last_error ELSE j.error END
                AS last_error,
              CASE WHEN j.kind = 'ok' THEN {_NOW} ELSE ep.distilled_at END AS distilled_at,
              CASE WHEN j.kind = 'ok' THEN j.summary ELSE d.summary END AS summary,
              CASE WHEN j.kind = 'ok' THEN 'm1' ELSE d.model END AS model
         FROM ep LEFT JOIN jobs j ON j.id = ep.id AND ep.status = 'fetched'
                AND ep.distill_job_id = j.job_id
              LEFT JOIN di d ON d.episode_id = ep.id AND d.is_current""",
)
def incremental_collect(spark, sf):
    store = seeded(spark, sf)
    path = f"{store.root}/jobs"
    land_jobs(spark, sf, path)
    streams.collect(store, path, NOW, RUN_DATE, SETTINGS, 2).awaitTermination()
    current = store.read("distillations").filter("is_current")
    results = current.select(F.col("episode_id").alias("id"), "summary", "model")
    return store.read("episodes").join(results, "id", "left").select(
        "id", "status", "distill_job_id", "last_error", naive("distilled_at"), "summary", "model"
    )
