"""One lineage from feeds and responses to the lifetime summary."""

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelmill.operators import discovery, queues, reports, runs, transcripts
from reelmill.plans import fixtures as fx
from reelmill.sources.store import StateStore, work_dir


def summary_after_pass(spark: SparkSession, sf_dir: str, now: datetime = fx.NOW) -> DataFrame:
    """Discover, fetch and account for one pass, then the summary report.

    The short intermediate lists (the pass's items, new rows and queue) are
    written once and read back; the state itself stays a plan, so the counts
    read only the columns they need and never move a text.
    """
    work = StateStore(spark, work_dir(spark))
    episodes = fx.episodes(spark, sf_dir)
    targets = discovery.with_channel_ref(discovery.channel_targets(spark, fx.CHANNELS))
    found = discovery.normalise_feed(discovery.join_feeds(targets, fx.feed(spark, sf_dir)))
    recent = discovery.within_lookback(found, fx.AS_OF)
    items = work.stage(discovery.newest(discovery.first_wins(recent)), "items")
    fresh = work.stage(discovery.new_episodes(items, episodes, now, work.staging("bulk")), "fresh")
    counts = discovery.discovery_counts(items, fresh)
    account = runs.discovery_run(fx.ingest_runs(spark, sf_dir), counts, date(2024, 1, 30), now)

    stored = fresh.select(
        *[
            F.col(f.name).cast(f.dataType.simpleString()).alias(f.name)
            for f in episodes.schema.fields
        ]
    )
    state = episodes.unionByName(stored)
    queue = queues.needing_transcript(state).select("id", "video_id", "attempts")
    queue = work.stage(queue, "queue")
    moves = transcripts.transitions(queue, fx.responses(spark, sf_dir), 5, 30, 600)
    return reports.summary(account, transcripts.apply_transitions(state, moves, now))
