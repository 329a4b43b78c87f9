"""The passes as incremental jobs over landing directories.

Each job reads what has landed since its last run, in bounded micro-batches, and
stops. A batch's state, run counters and batch id are published by one commit,
so a batch that is replayed after a crash adds nothing (X4).
"""

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from reelmill.operators.discovery import channel_targets
from reelmill.plans import passes
from reelmill.plans.passes import Settings
from reelmill.sources import landed
from reelmill.sources.store import StateStore


def _drain(
    docs: DataFrame,
    store: StateStore,
    name: str,
    apply: Callable[[StateStore, DataFrame, dict[str, int]], object],
) -> StreamingQuery:
    def batch(rows: DataFrame, batch_id: int) -> None:
        local = StateStore(rows.sparkSession, store.root, store.buckets)
        if batch_id > local.applied(name):
            apply(local, rows, {name: batch_id})

    return (
        docs.writeStream.queryName(name)
        .foreachBatch(batch)
        .option("checkpointLocation", f"{store.root}/_streams/{name}")
        .trigger(availableNow=True)
        .start()
    )


def _matched(store: StateStore, table: str, key: str, column: str) -> bool:
    """Whether something that waits has its episode by now."""
    if not store.pointer()["tables"].get(table):
        return False
    known = store.read("episodes").select(F.col(column).alias(key))
    return not store.read(table).select(key).join(known, key, "left_semi").isEmpty()


def discover(
    store: StateStore,
    landing: str,
    specs: str,
    now: datetime,
    run_date: date,
    settings: Settings = Settings(),
    files_per_batch: int | None = None,
    name: str = "discover",
) -> StreamingQuery:
    """Landed feed documents -> new episodes; known videos are ignored."""
    docs = landed.read_feeds(store.spark, landing, stream=True, files_per_batch=files_per_batch)

    def apply(local: StateStore, rows: DataFrame, applied: dict[str, int]) -> None:
        targets = channel_targets(local.spark, specs)
        passes.discover(local, rows, targets, now, run_date, settings, applied)

    return _drain(docs, store, name, apply)


def fetch(
    store: StateStore,
    landing: str,
    now: datetime,
    run_date: date,
    settings: Settings = Settings(),
    files_per_batch: int | None = None,
    name: str = "fetch",
) -> StreamingQuery:
    """Landed responses -> transcripts and transitions of eligible episodes.

    The batch is bounded by files, not by a row limit: an answer that has been
    fetched and paid for is never dropped. One that comes before its episode waits
    in the state; what waits for episodes known by now is taken first.
    """
    if _matched(store, "waiting_answers", "video_id", "video_id"):
        passes.fetch(store, None, now, run_date, settings, None)
    docs = landed.read_responses(
        store.spark, landing, stream=True, files_per_batch=files_per_batch
    )

    def apply(local: StateStore, rows: DataFrame, applied: dict[str, int]) -> None:
        passes.fetch(local, rows, now, run_date, settings, None, applied)

    return _drain(docs, store, name, apply)


def receipts(
    store: StateStore,
    landing: str,
    outbox: str,
    now: datetime,
    run_date: date,
    settings: Settings = Settings(),
    files_per_batch: int | None = None,
    name: str = "receipts",
) -> StreamingQuery:
    """Landed receipts -> job ids of submitted episodes, or failed attempts.

    The request documents of a batch are published by the commit that holds its batch
    id, so a batch that is replayed sends nothing again. A receipt for an episode that
    isn't to be submitted (any more) changes nothing.
    """
    docs = landed.read_receipts(store.spark, landing, stream=True, files_per_batch=files_per_batch)

    def apply(local: StateStore, rows: DataFrame, applied: dict[str, int]) -> None:
        batch = f"{name}-{applied[name]}"
        passes.submit(local, outbox, batch, now, run_date, settings, rows, applied=applied)

    return _drain(docs, store, name, apply)


def collect(
    store: StateStore,
    landing: str,
    now: datetime,
    run_date: date,
    settings: Settings = Settings(),
    files_per_batch: int | None = None,
    name: str = "collect",
) -> StreamingQuery:
    """Landed job documents -> results and transitions of pending episodes.

    The end of a job that no episode has yet waits in the state, as answers do in X2.
    """
    if _matched(store, "waiting_jobs", "job_id", "distill_job_id"):
        passes.collect(store, None, now, run_date, settings, None)
    docs = landed.read_jobs(store.spark, landing, stream=True, files_per_batch=files_per_batch)

    def apply(local: StateStore, rows: DataFrame, applied: dict[str, int]) -> None:
        passes.collect(local, rows, now, run_date, settings, None, applied)

    return _drain(docs, store, name, apply)
