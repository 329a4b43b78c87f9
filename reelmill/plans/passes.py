"""The passes over stored state: discover, fetch, submit, collect, retry, requeue.

A pass is a unit of the store: it reads one version of the state, works out its change
rows, writes those once (so that counters, state and texts all come from the same rows),
rewrites the buckets the changes fall into and publishes everything as one record. Passes
that consist of passes (a requeue, a chain) read what their parts wrote and publish once;
a pass that dies, or that another writer has overtaken, leaves no trace.
"""

import uuid
from dataclasses import dataclass
from datetime import date, datetime
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelmill import schemas
from reelmill.operators import changes as ch
from reelmill.operators import discovery, distill, queues, reports, runs, transcripts
from reelmill.sources.landed import feed_rows
from reelmill.sources.outbox import write_requests
from reelmill.sources.store import StateStore, Unit, Write


@dataclass(frozen=True)
class Settings:
    """What a deployment configures. The defaults.

    ``limit`` bounds the episodes that one pass takes (None: all that are eligible).
    """

    lookback_days: int = discovery.LOOKBACK_DAYS
    max_items: int | None = None  # a landed feed is read once: what a cap drops is lost
    limit: int | None = None
    max_attempts: int = queues.MAX_ATTEMPTS
    max_distill_attempts: int = queues.MAX_DISTILL_ATTEMPTS
    min_seconds: int = 0
    max_seconds: int = 0
    languages: tuple[str, ...] = ("en", "asr")
    source: str = distill.REQUEST_SOURCE
    max_chunk_chars: int = distill.MAX_CHUNK_CHARS

    def language_codes(self) -> Column:
        return F.array(*[F.lit(code) for code in self.languages])


Applied = dict[str, int] | None


def _run_write(rows: DataFrame) -> Write:
    """The run table is one row per date: a single bucket."""
    return Write(rows.withColumn("bucket", F.lit(0)), [0])


def _with_bucket(rows: DataFrame, episodes: DataFrame) -> DataFrame:
    return rows.join(episodes.select("id", "bucket"), "id")


def discover(
    store: StateStore,
    docs: DataFrame,
    targets: DataFrame,
    now: datetime,
    run_date: date,
    settings: Settings = Settings(),
    applied: Applied = None,
) -> DataFrame:
    """Feed documents -> new episodes and the run row. Returns crawled / new.

    Feeds that can't be read are a failure in the run row, and raised again.
    """
    with store.unit() as work:
        try:
            wanted = discovery.join_feeds(discovery.with_channel_ref(targets), feed_rows(docs))
            recent = discovery.within_lookback(
                discovery.normalise_feed(wanted), now, settings.lookback_days
            )
            items = work.stage(
                discovery.newest(discovery.first_wins(recent), settings.max_items), "items"
            )
        except Exception as error:
            stored = work.read("ingest_runs").drop("bucket")
            failed = runs.failed_discovery_run(stored, run_date, str(error), now)
            work.commit({"ingest_runs": _run_write(failed)})
            work.publish()
            raise
        known = work.read("episodes")
        fresh = discovery.new_episodes(
            items, known, now, work.staging("bulk"), work.last_id("episodes")
        )
        fresh = work.stage(fresh.withColumn("bucket", work.bucket_of(F.col("video_id"))), "fresh")
        counts = work.stage(discovery.discovery_counts(items, fresh), "counts")
        updated = runs.discovery_run(work.read("ingest_runs").drop("bucket"), counts, run_date, now)
        work.commit({"episodes": Write(fresh), "ingest_runs": _run_write(updated)}, applied)
        return counts


def _given_ids(store: StateStore) -> dict[str, int]:
    """The highest ids so far; noted with a deletion, so that none is given twice."""
    tables = ("episodes", "distillations")
    return {t: store.read(t).agg(F.max("id")).first()[0] or 0 for t in tables}


def _episode_write(store: StateStore, changes: DataFrame, apply) -> Write:
    """Rewrite the buckets that ``changes`` (staged, with bucket) fall into."""
    touched = store.touched(changes)
    state = store.read("episodes", touched)
    return Write(apply(state, changes.drop("bucket")), touched)


def _stage_run(
    store: StateStore, counts: DataFrame, run_date: date, now: datetime, *names: str
) -> Write:
    stored = store.read("ingest_runs").drop("bucket")
    return _run_write(runs.record_stage(stored, counts, run_date, now, *names))


def _transitions(
    store: Unit, queue: DataFrame, responses: DataFrame, settings: Settings
) -> DataFrame:
    """Staged change rows with the bucket and the version of their text."""
    changes = transcripts.transitions(
        queue,
        responses,
        settings.max_attempts,
        settings.min_seconds,
        settings.max_seconds,
        settings.language_codes(),
    )
    version = F.when(F.col("raw_text").isNotNull(), F.lit(store.base + 1))
    numbered = changes.withColumn("text_version", version.cast("bigint"))
    return store.stage(_with_bucket(numbered, queue), "transitions")


#: What tells the documents of one key and moment apart.
_DIGEST = {"waiting_answers": ("http_status", "body"), "waiting_jobs": ("status", "error", "result")}


def _typed(rows: DataFrame, table: str) -> DataFrame:
    """Landed rows in the columns of ``table``; a missing time is before all others."""
    fields = [f for f in schemas.TABLES[table].fields if f.name != "digest"]
    typed = rows.select(*[F.col(f.name).cast(f.dataType.simpleString()).alias(f.name) for f in fields])
    timed = typed.withColumn("received_at", F.coalesce("received_at", F.timestamp_seconds(F.lit(0))))
    return timed.withColumn("digest", F.xxhash64(*_DIGEST[table]))


def _with_waiting(
    store: StateStore, table: str, key: str, arrived: DataFrame | None
) -> tuple[list[int], DataFrame, DataFrame]:
    """The buckets of a batch (None: of all that waits), its rows, and those that wait there."""
    if arrived is None:
        buckets = sorted(int(b) for b in store.pointer()["tables"].get(table, {}))
        waiting = store.read(table, buckets)
        return buckets, waiting.limit(0), waiting
    typed = _typed(arrived, table).withColumn("bucket", store.bucket_of(F.col(key)))
    buckets = store.touched(typed)
    return buckets, typed, store.read(table, buckets)


def _now_waiting(
    store: StateStore, table: str, arrived: DataFrame, waiting: DataFrame, later: DataFrame
) -> dict[str, Write]:
    """Arrived rows whose key is in ``later`` (staged) are added to those that wait."""
    if later.isEmpty():
        return {}
    key = later.columns[0]
    own = [key, "received_at", "digest"]
    added = arrived.join(later, key, "left_semi").join(waiting.select(*own), own, "left_anti")
    return {table: Write(added.dropDuplicates(own))}


def fetch(
    store: StateStore,
    responses: DataFrame | None,
    now: datetime,
    run_date: date,
    settings: Settings = Settings(),
    limit: int | None = None,
    applied: Applied = None,
    record: bool = True,
) -> DataFrame:
    """Responses for queued episodes -> transcripts and transitions. Returns T11 counts.

    Takes the eligible episodes that have an unused answer in the batch, the newest
    ``limit`` of them if there is one. An answer whose episode is not known yet, or was
    left to a later pass by the limit, waits in the state; ``responses=None`` is a batch
    of what waits. An answer is used once: a folder may be read again. Only keys meet
    the state; bodies are picked by the (staged) keys to be used.
    """
    with store.unit() as work:
        buckets, arrived, waiting = _with_waiting(work, "waiting_answers", "video_id", responses)
        answers = arrived.unionByName(waiting)
        fresh = (
            answers.select(*transcripts.ANSWER, "bucket")
            .distinct()
            .join(work.read("used_answers", buckets).drop("bucket"), transcripts.ANSWER, "left_anti")
        )
        fresh = work.stage(fresh, "fresh_answers")
        state = work.read("episodes", buckets)
        able = queues.needing_transcript(state, None, settings.max_attempts)
        able = able.join(fresh.select("video_id").distinct(), "video_id", "left_semi")
        queue = queues.head(able, limit).select("id", "video_id", "attempts", "bucket")
        queue = work.stage(queue, "queue")
        keys = work.stage(fresh.join(queue.select("video_id"), "video_id", "left_semi"), "answers")
        mine = answers.drop("bucket").join(keys.drop("bucket"), transcripts.ANSWER, "left_semi")
        changes = _transitions(work, queue, mine.drop("digest"), settings)
        counts = work.stage(transcripts.pass_counts(changes), "counts")
        later = fresh.select("video_id").join(state.select("video_id"), "video_id", "left_anti")
        if limit is not None:
            left = able.select("video_id").join(queue.select("video_id"), "video_id", "left_anti")
            later = later.unionByName(left)
        later = work.stage(later.distinct(), "later")
        # what waited for an episode that isn't to be fetched by now waits no more
        over = (
            waiting.select(*transcripts.ANSWER, "bucket")
            .join(keys.drop("bucket"), transcripts.ANSWER, "left_anti")
            .join(later, "video_id", "left_anti")
        )
        writes = {
            "episodes": _episode_write(
                work, changes, lambda s, c: transcripts.apply_transitions(s, c, now)
            ),
            "texts": Write(_new_texts(changes)),
            "used_answers": Write(keys.unionByName(over)),
            **_now_waiting(work, "waiting_answers", arrived, waiting, later),
        }
        if record:
            writes["ingest_runs"] = _stage_run(work, counts, run_date, now, "transcripts_fetched")
        work.commit(writes, applied)
        return counts


def _new_texts(changes: DataFrame) -> DataFrame:
    fetched = changes.filter(F.col("raw_text").isNotNull())
    return fetched.select("id", "text_version", "raw_text", "bucket")


def _requests(store: Unit, submitted: DataFrame, settings: Settings) -> DataFrame:
    """F1 for the submitted rows (staged id, job_id, bucket).

    Only the folders of the text versions that the rows show are read, and only their
    texts go on: the rows are written first, so up to the planner's broadcast bound no
    text is shuffled; beyond it the wanted texts are, once.
    """
    known = store.read("episodes", store.touched(submitted)).drop("bucket")
    head = store.stage(known.join(submitted.select("id", "job_id", "bucket"), "id"), "request_heads")
    shown = head.filter(F.col("text_version").isNotNull()).select("bucket", "text_version").distinct()
    texts = store.read_versions("texts", {(r.bucket, r.text_version) for r in shown.collect()})
    wanted = store.stage(head.select("id", "text_version"), "wanted_texts")
    texts = texts.join(wanted, ["id", "text_version"], "left_semi")
    request = distill.request_json(settings.source, settings.max_chunk_chars)
    return reports.with_text(head, texts).select("id", "job_id", request.alias("request"))


def submit(
    store: StateStore,
    outbox: str,
    batch: str,
    now: datetime,
    run_date: date,
    settings: Settings = Settings(),
    receipts: DataFrame | None = None,
    record: bool = True,
    applied: Applied = None,
) -> DataFrame:
    """Q2 rows -> request documents and job ids. Returns submitted / failures.

    With ``receipts`` only the rows they answer; a receipt is used once, whether or not
    there is a row for it, so it never comes back with a later submission.
    """
    with store.unit() as work:
        eligible = queues.needing_distill(work.read("episodes"), None, settings.max_distill_attempts)
        writes = {}
        if receipts is not None:
            receipts, writes = _unused_receipts(work, receipts)
            eligible = eligible.join(receipts.select("video_id"), "video_id", "left_semi")
        queue = queues.head(eligible, settings.limit)
        recorded = (run_date, now) if record else None
        return _submit_rows(
            work, queue, outbox, batch, settings, receipts, recorded, writes=writes, applied=applied
        )


def _unused_receipts(store: Unit, receipts: DataFrame) -> tuple[DataFrame, dict[str, Write]]:
    """One receipt per video of those not used before (staged), and their keys to keep."""
    received = F.col("received_at") if "received_at" in receipts.columns else F.lit(None)
    keyed = receipts.select(
        "video_id",
        F.coalesce(received.cast("timestamp"), F.timestamp_seconds(F.lit(0))).alias("received_at"),
        F.xxhash64("job_id", "error").alias("digest"),
        "job_id",
        "error",
        store.bucket_of(F.col("video_id")).alias("bucket"),
    )
    keyed = store.stage(keyed.distinct(), "landed_receipts")
    used = store.read("used_receipts", store.touched(keyed)).drop("bucket")
    keys = store.stage(
        keyed.select(*transcripts.ANSWER, "bucket").join(used, transcripts.ANSWER, "left_anti"),
        "receipt_keys",
    )
    fresh = keyed.join(keys.drop("bucket"), transcripts.ANSWER, "left_semi")
    one = store.stage(distill.one_receipt(fresh), "receipts")
    return one, {"used_receipts": Write(keys)}


def _submit_rows(
    store: Unit,
    queue: DataFrame,
    outbox: str,
    batch: str,
    settings: Settings,
    receipts: DataFrame | None = None,
    recorded: tuple[date, datetime] | None = None,
    reset: bool = False,
    writes: dict[str, Write] | None = None,
    applied: Applied = None,
) -> DataFrame:
    """Submit the rows of ``queue``; with ``reset`` they are first reset as in U6.

    The version is part of the job ids, so a job is never taken for an earlier one of
    its episode and batch. Requests count when the unit is published that names them.
    """
    columns = ["id", "video_id", "distill_job_id", "distill_attempts", "bucket"]
    queue = store.stage(queue.select(*columns), "queue")
    version = store.base + 1
    asked = queue
    if reset:
        asked = queue.withColumn("distill_job_id", F.lit(None).cast("string")).withColumn("distill_attempts", F.lit(0))
    changes = distill.assign_jobs(asked, f"{batch}|{version}", receipts)
    changes = store.stage(_with_bucket(changes, queue), "submissions")
    counts = store.stage(distill.submit_counts(changes), "counts")
    folder = f"{outbox}/batch={batch}/commit={version}-{uuid.uuid4().hex[:8]}"
    write_requests(_requests(store, changes.filter(F.col("job_id").isNotNull()), settings), folder)
    store.send(folder)

    def apply(state: DataFrame, submitted: DataFrame) -> DataFrame:
        if reset:
            state = ch.reset_for_reprocess(state, submitted.select("id"))
        return distill.apply_submissions(state, submitted)

    writes = {**(writes or {}), "episodes": _episode_write(store, changes, apply)}
    if recorded:
        run_date, now = recorded
        writes["ingest_runs"] = _stage_run(store, counts, run_date, now)
    store.commit(writes, applied)
    return counts


def collect(
    store: StateStore,
    jobs: DataFrame | None,
    now: datetime,
    run_date: date,
    settings: Settings = Settings(),
    limit: int | None = None,
    applied: Applied = None,
) -> DataFrame:
    """Job documents of pending episodes -> results and transitions. Returns F4 counts.

    Takes the pending episodes that have a document in the batch, the newest ``limit`` of
    them if there is one. The end of a job that no episode has yet, or that the limit left
    to a later pass, waits in the state (unless it has been collected before);
    ``jobs=None`` is a batch of what waits.
    """
    with store.unit() as work:
        buckets, arrived, waiting = _with_waiting(work, "waiting_jobs", "job_id", jobs)
        jobs = arrived.unionByName(waiting)
        seen = work.stage(jobs.select("job_id").distinct(), "seen")
        asked = seen.select(F.col("job_id").alias("distill_job_id"))
        able = queues.pending_distill(work.read("episodes"), None).join(asked, "distill_job_id", "left_semi")
        columns = ["id", "video_id", "distill_job_id", "published_at", "bucket"]
        able = work.stage(able.select(*columns), "able")
        pending = able if limit is None else work.stage(queues.head(able, limit), "pending")
        results = distill.collected(pending, jobs.drop("bucket"))
        results = work.stage(_with_bucket(results, pending), "collected")
        over = results.filter(F.col("kind") != "pending").select("job_id")
        writes = {"ended_jobs": Write(over.withColumn("bucket", work.bucket_of(F.col("job_id"))))}
        ends = distill.ends(jobs)
        taken = pending.select(F.col("distill_job_id").alias("job_id"))
        early = (
            ends.select("job_id").distinct()
            .join(taken, "job_id", "left_anti")
            .join(work.read("ended_jobs", buckets), "job_id", "left_anti")
        )
        early = work.stage(early, "early")
        writes |= _now_waiting(work, "waiting_jobs", distill.ends(arrived), waiting, early)
        counts = work.stage(distill.collect_counts(results), "counts")
        good = results.filter(F.col("kind") == "ok")
        submitted = work.stage(good.select("id", "job_id", "bucket"), "good")
        batch = distill.result_changes(good.drop("bucket")).join(
            _requests(work, submitted, settings).select(
                F.col("id").alias("episode_id"), F.col("request").alias("request_payload")
            ),
            "episode_id",
        )
        # built once; the keys by themselves, so that no stored document moves to meet them
        batch = work.stage(batch, "results")
        keys = work.stage(batch.select(*distill.RESULT_KEY, "seq"), "result_keys")
        touched = work.touched(submitted)
        stored = work.read("distillations", touched).drop("bucket")
        # ids are unique over the whole table, so the highest one comes from all buckets
        noted = work.spark.range(1).select(F.lit(work.last_id("distillations")).alias("id"))
        highest = work.read("distillations").select("id").unionByName(noted)
        merged = distill.upsert_results(stored, batch, now, highest, keys)
        known = work.read("episodes", touched).select(F.col("id").alias("episode_id"), "bucket")
        work.commit(
            writes
            | {
                "episodes": _episode_write(
                    work, results, lambda s, c: distill.apply_collected(s, c, now)
                ),
                "distillations": Write(merged.join(known, "episode_id"), touched),
                "ingest_runs": _stage_run(work, counts, run_date, now, "distilled"),
            },
            applied,
        )
        return counts


def _deletion(store: Unit, gone: DataFrame) -> dict[str, Write]:
    """What goes with deleted episodes (staged id, video_id, bucket).

    Texts and results are wide: their ids are marked, reads leave them out, and
    :func:`fold_deleted` removes them. Keys of used answers are narrow and go at once,
    after the waiting answers that they hide.
    """
    lost = store.touched(gone)
    used = store.read("used_answers", lost)
    waiting = store.pointer()["tables"].get("waiting_answers", {})
    hidden = [b for b in lost if str(b) in waiting]
    writes = {
        "deleted": Write(gone.select("id", "bucket")),
        "used_answers": Write(used.join(gone.select("video_id"), "video_id", "left_anti"), lost),
    }
    return writes | ({"waiting_answers": Write(store.read("waiting_answers", hidden), hidden)} if hidden else {})


def fold(store: StateStore, most: int = 32) -> dict[str, list[int]]:
    """Rewrite the buckets that lie in more than ``most`` folders, in one commit; what reads
    leave out goes with that. Returns the rewritten buckets by table."""
    with store.unit() as work:
        many = {
            table: sorted(int(b) for b, folders in dirs.items() if len(folders) > most)
            for table, dirs in work.pointer()["tables"].items()
        }
        many = {table: buckets for table, buckets in many.items() if buckets}
        if many:
            work.commit({table: Write(work.read(table, buckets), buckets) for table, buckets in many.items()})
        return many


def fold_deleted(store: StateStore) -> list[int]:
    """Remove what deletions have marked, in one commit. Returns the buckets rewritten."""
    with store.unit() as work:
        marked = sorted(int(b) for b in work.pointer()["tables"].get("deleted", {}))
        if marked:
            work.commit(
                {
                    "texts": Write(work.read("texts", marked), marked),
                    "distillations": Write(work.read("distillations", marked), marked),
                    "deleted": Write(work.read("deleted", marked).limit(0), marked),
                }
            )
        return marked


def reset_and_refetch(
    store: Unit,
    chosen: DataFrame,
    responses: DataFrame,
    now: datetime,
    settings: Settings,
    delete_after: int | None = None,
    used_up: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Reset episodes (U7) and apply the newest response that came since ``now``.

    Rows without such a response stay discovered for a later pass. With
    ``delete_after`` the rows that failed again at or over that number of tries
    are deleted, and so are those of ``used_up``. Returns (change rows, deleted ids).
    """
    chosen = store.stage(chosen, "chosen")
    target = ["id", "video_id", "bucket"]
    drop = chosen.select(*target).limit(0) if used_up is None else used_up.select(*target)
    drop = store.stage(drop, "used_up")
    touched = store.touched(chosen.select("bucket").unionByName(drop.select("bucket")))
    state = ch.reset_full(store.read("episodes", touched), chosen.select("id"))
    typed = _typed(responses, "waiting_answers")
    since = typed.filter(F.col("received_at") >= F.lit(now.isoformat()).cast("timestamp"))
    newest = transcripts.newest_answer(since, chosen)
    keys = newest.select(*transcripts.ANSWER).distinct()
    keys = store.stage(keys.withColumn("bucket", store.bucket_of(F.col("video_id"))), "answers")
    changes = _transitions(store, chosen, newest, settings)
    state = store.stage(
        transcripts.apply_transitions(state, changes.drop("bucket"), now), "refetched"
    )
    failed = queues.still_failed(state, chosen, delete_after).select(*target)
    gone = store.stage(failed.unionByName(drop), "gone")
    if gone.isEmpty():
        writes = {"used_answers": Write(keys)}
    else:
        writes = _deletion(store, gone)
        both = sorted({*writes["used_answers"].buckets, *store.touched(keys)})
        used = store.read("used_answers", both)
        used = used.unionByName(keys.select(*used.columns)).distinct()
        used = used.join(gone, "video_id", "left_anti").select(*used.columns)
        writes["used_answers"] = Write(used, both)
    writes["texts"] = Write(_new_texts(changes).join(gone.select("id"), "id", "left_anti"))
    writes["episodes"] = Write(ch.delete_episodes(state, gone), touched)
    store.commit(writes, ids=_given_ids(store))
    return changes, gone


def retry_failed(
    store: StateStore,
    responses: DataFrame,
    now: datetime,
    settings: Settings = Settings(),
    from_date: date | None = None,
    to_date: date | None = None,
    max_attempts: int | None = None,
    delete_after: int | None = None,
) -> DataFrame:
    """Q6 on the store. Returns deleted / retried / reprocessed and T11 counts."""
    with store.unit() as work:
        candidates = queues.failed_candidates(
            work.read("episodes"), from_date, to_date, max_attempts
        )
        used_up, again = queues.split_retries(candidates, delete_after)
        again = work.stage(again, "again")
        changes, gone = reset_and_refetch(
            work, again, responses, now, settings, delete_after, used_up
        )
        return retry_counts(again, changes, gone)


def retry_counts(again: DataFrame, changes: DataFrame, gone: DataFrame) -> DataFrame:
    def rows(frame: DataFrame) -> Column:
        return frame.agg(F.count("*")).scalar()

    return transcripts.pass_counts(changes).select(
        "*",
        rows(gone).alias("deleted"),
        rows(again).alias("retried"),
        rows(again).alias("reprocessed"),
    )


class Requeued(NamedTuple):
    """Per asked video its ``outcome``, and one row of counters of the whole pass."""

    outcomes: DataFrame
    counts: DataFrame


def restart(
    store: StateStore,
    video_ids: DataFrame,
    responses: DataFrame,
    now: datetime,
    settings: Settings = Settings(),
) -> Requeued:
    """Full reset and new transcript, nothing submitted.

    The outcome of an unknown id is ``not_found``, of a row without a new
    response ``waiting``. Counts are those of T11 and ``reprocessed``.
    """
    with store.unit() as work:
        asked = work.stage(video_ids.select("video_id").distinct(), "asked")
        chosen = reports.episodes_by_id(work.read("episodes"), asked, "video_id")
        known = work.stage(chosen.select("id", "video_id", "bucket"), "known")
        changes, _ = reset_and_refetch(work, chosen, responses, now, settings)
        outcomes = requeue_outcomes(asked, known, changes.select("video_id", "outcome"))
        outcomes = work.stage(outcomes, "outcomes")
        return Requeued(outcomes, restart_counts(outcomes))


def requeue(
    store: StateStore,
    video_ids: DataFrame,
    responses: DataFrame,
    outbox: str,
    batch: str,
    now: datetime,
    settings: Settings = Settings(),
) -> Requeued:
    """:func:`restart`, then a new submission, published together.

    Counts are those of the restart with ``submitted``; failures of both add up.
    """
    with store.unit() as work:
        outcomes, counts = restart(work, video_ids, responses, now, settings)
        again = outcomes.filter(F.col("outcome") == "fetched")
        refetched = reports.episodes_by_id(work.read("episodes"), again, "video_id")
        sent = _submit_rows(work, refetched, outbox, batch, settings)
        both = F.col("failures") + sent.select("failures").scalar()
        counts = counts.withColumn("failures", both).withColumn("submitted", sent.select("submitted").scalar())
        return Requeued(outcomes, counts)


def restart_counts(outcomes: DataFrame) -> DataFrame:
    """T11 counts and ``reprocessed`` of the outcomes of a restart or requeue."""
    reset = F.count_if(F.col("outcome") != "not_found").alias("reprocessed")
    return transcripts.pass_counts(outcomes).select("*", outcomes.agg(reset).scalar().alias("reprocessed"))


def requeue_outcomes(asked: DataFrame, known: DataFrame, outcomes: DataFrame) -> DataFrame:
    """One row per asked id: what its requeue came to."""
    found = known.select("video_id", F.lit("waiting").alias("found"))
    joined = asked.join(found, "video_id", "left").join(outcomes, "video_id", "left")
    return joined.select(
        "video_id", F.coalesce("outcome", "found", F.lit("not_found")).alias("outcome")
    )


def reprocess(
    store: StateStore,
    candidates: DataFrame,
    outbox: str,
    batch: str,
    settings: Settings = Settings(),
) -> DataFrame:
    """F8 on the store: reset (U6) and submit candidates that have text, in one commit."""
    with store.unit() as work:
        asked = work.stage(candidates.select("id").distinct(), "asked")
        episodes = reports.episodes_by_id(work.read("episodes"), asked)
        chosen = episodes.filter(ch.has_text(episodes))
        counts = _submit_rows(work, chosen, outbox, batch, settings, reset=True)
        return counts.withColumn("reprocessed", F.col("submitted") + F.col("failures"))


def amend(store: StateStore, patches: DataFrame) -> int:
    """Any number of ordered changes an episode (see :func:`changes.compose`), in one commit."""
    with store.unit() as work:
        episodes = work.read("episodes")
        one = ch.compose(work.stage(patches, "patches"), episodes)
        changes = work.stage(one.join(episodes.select("id", "bucket"), "id"), "amended")
        return work.commit({"episodes": _episode_write(work, changes, ch.apply_patches)})


def delete(store: StateStore, ids: DataFrame) -> int:
    """U8 on the store; returns the number of deleted episodes."""
    with store.unit() as work:
        found = reports.episodes_by_id(work.read("episodes"), ids)
        gone = work.stage(found.select("id", "video_id", "bucket"), "gone")
        touched = work.touched(gone)
        state = Write(ch.delete_episodes(work.read("episodes", touched), gone), touched)
        work.commit(_deletion(work, gone) | {"episodes": state}, ids=_given_ids(work))
        return gone.count()


def run_chain(
    store: StateStore,
    docs: DataFrame,
    targets: DataFrame,
    responses: DataFrame,
    outbox: str,
    batch: str,
    now: datetime,
    run_date: date,
    settings: Settings = Settings(),
) -> DataFrame:
    """Discover, fetch and submit once, published together with one account."""
    with store.unit() as work:
        found = discover(work, docs, targets, now, run_date, settings)
        fetched = fetch(work, responses, now, run_date, settings, settings.limit, record=False)
        submitted = submit(work, outbox, batch, now, run_date, settings, record=False)
        result = work.stage(runs.chain_result(found, fetched, submitted), "chain")
        updated = runs.chain_run(work.read("ingest_runs").drop("bucket"), result, run_date, now)
        work.commit({"ingest_runs": _run_write(updated)})
        return result
