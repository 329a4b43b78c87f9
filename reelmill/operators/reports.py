"""Lists, lookups and lifetime counts."""

from datetime import date, datetime
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelmill.functions.times import in_date_range, moment
from reelmill.operators.discovery import number_bulk
from reelmill.operators.queues import newest_first
from reelmill.schemas import RUN_COUNTERS

# Page size when only a page is asked for.
DEFAULT_PAGE_SIZE = 25


class Page(NamedTuple):
    """The rows of a page and, as a one-row frame, the total that ignores paging."""

    rows: DataFrame
    total: DataFrame


def _paged(rows: DataFrame, order: list[Column], page: int | None, page_size: int | None):
    """The rows of a page; all rows, in no order, when no page is asked for."""
    if page is None and page_size is None:
        return rows
    size = max(page_size or DEFAULT_PAGE_SIZE, 1)
    skip = (max(page or 1, 1) - 1) * size
    top = rows.orderBy(*order).limit(skip + size)
    if not skip:
        return top
    # Not OFFSET: adaptive execution loses a sort that follows offset and a join
    # whose other side turns out empty. The rows up to the page are in one task
    # either way.
    place = F.row_number().over(Window.orderBy(*order))
    return top.withColumn("place", place).filter(F.col("place") > skip).drop("place")


# -- runs -------------------------------------------------------------------


def last_run(runs: DataFrame) -> DataFrame:
    """The newest run, as one row or none."""
    newest = F.max_by(F.struct(*runs.columns), "run_date").alias("run")
    return runs.agg(newest).filter(F.col("run").isNotNull()).select("run.*")


def runs_by_date(runs: DataFrame, dates: DataFrame) -> DataFrame:
    """The runs of a set of dates."""
    return runs.join(dates.select("run_date"), "run_date", "left_semi")


def list_runs(
    runs: DataFrame,
    status: str | None = None,
    from_date: date | None = None,
    to_date: date | None = None,
    page: int | None = None,
    page_size: int | None = None,
) -> Page:
    """Newest date first."""
    wanted = runs
    if status:
        wanted = wanted.filter(F.col("status") == status)
    if from_date:
        wanted = wanted.filter(F.col("run_date") >= F.lit(from_date))
    if to_date:
        wanted = wanted.filter(F.col("run_date") <= F.lit(to_date))
    total = wanted.agg(F.count("*").alias("total"))
    order = [F.col("run_date").desc()]
    return Page(_paged(wanted, order, page, page_size).orderBy(*order), total)


def stats(runs: DataFrame, episodes: DataFrame) -> DataFrame:
    """The last run's counters and the episode count; zeros without runs."""
    newest = runs.agg(
        F.max_by(
            F.struct("run_date", "status", "last_heartbeat", *RUN_COUNTERS), "run_date"
        ).alias("run")
    )
    return newest.select(
        *[F.coalesce(F.col(f"run.{c}"), F.lit(0)).alias(c) for c in RUN_COUNTERS],
        count_total(episodes).scalar().alias("episodes_total"),
        F.date_format("run.run_date", "yyyy-MM-dd").alias("last_run_date"),
        F.col("run.status").alias("last_run_status"),
        F.col("run.last_heartbeat").alias("last_heartbeat"),
    )


def totals(runs: DataFrame) -> DataFrame:
    """Lifetime sums over runs."""
    return runs.agg(
        F.count("*").alias("runs_total"),
        *[
            F.coalesce(F.sum(c), F.lit(0)).alias(c)
            for c in ("episodes_discovered", "reprocessed", "failures")
        ],
    )


# -- episode counts -----------------------------------------------------------


def completed_counts(episodes: DataFrame) -> DataFrame:
    """Six lifetime counts in one scan of five narrow columns.

    A failed row without an error text is in no error bucket: LIKE over null is
    neither true nor false, and it is left that way.
    """
    error = F.lower("last_error")
    failed, skipped = F.col("status") == "failed", F.col("status") == "skipped"
    # The beginnings that sort errors into buckets.
    no_transcript = error.like("transcript unavailable for%") | error.like(
        "no transcript available for%"
    )
    too_short, too_long = error.like("below % minimum%"), error.like("above % maximum%")
    return episodes.agg(
        F.count("*").alias("episodes_total"),
        F.count("fetched_at").alias("transcripts_fetched"),
        F.count("distilled_at").alias("distilled"),
        F.count_if(failed & ~no_transcript & ~too_short & ~too_long).alias("failures"),
        F.count_if(skipped & too_short).alias("duration_too_short"),
        F.count_if(no_transcript).alias("transcript_unavailable"),
    )


def summary(runs: DataFrame, episodes: DataFrame) -> DataFrame:
    """Run sums, with the episode counts winning where both have a name."""
    run_sums = totals(runs)
    return completed_counts(episodes).select(
        *[
            run_sums.select(c).scalar().alias(c)
            for c in ("runs_total", "episodes_discovered", "reprocessed")
        ],
        "*",
    )


def count_total(episodes: DataFrame) -> DataFrame:
    """R14."""
    return episodes.agg(F.count("*").alias("episodes_total"))


# -- episode lists and lookups ------------------------------------------------


def _result_sizes(distillations: DataFrame) -> DataFrame:
    """Sizes of the current results, measured below any join."""
    columns = distillations.columns
    topics = F.coalesce(F.size("key_topics"), F.lit(0)) if "key_topics" in columns else None
    parts = F.coalesce(F.size("segments"), F.lit(0)) if "segments" in columns else None
    return distillations.filter("is_current").select(
        F.col("episode_id").alias("id"),
        F.length("summary").alias("summary_char_count"),
        (topics if topics is not None else F.col("key_topic_count")).alias("key_topic_count"),
        (parts if parts is not None else F.col("segment_count")).alias("segment_count"),
    )


def _wanted(
    episodes: DataFrame, status: str | None, from_date: date | None, to_date: date | None
) -> DataFrame:
    wanted = episodes.filter(in_date_range(episodes, "published_at", from_date, to_date))
    if status:
        wanted = wanted.filter(F.col("status") == status)
    if "raw_char_count" not in wanted.columns:
        wanted = wanted.withColumn("raw_char_count", F.length("raw_text"))
    return wanted.drop("raw_text")


def list_episodes(
    episodes: DataFrame,
    distillations: DataFrame,
    status: str | None = None,
    from_date: date | None = None,
    to_date: date | None = None,
    page: int | None = None,
    page_size: int | None = None,
) -> Page:
    """Newest first, with text and result sizes.

    The page is cut first and then enriched: the left join on the current
    result adds at most one row per episode, so it cannot change the page.
    """
    wanted = _wanted(episodes, status, from_date, to_date)
    total = wanted.agg(F.count("*").alias("total"))
    page_rows = _paged(wanted, newest_first(), page, page_size)
    if page is not None or page_size is not None:
        distillations = _of_page(distillations, page_rows)
    enriched = page_rows.join(_result_sizes(distillations), "id", "left")
    return Page(enriched.orderBy(*newest_first()), total)


class Cursor(NamedTuple):
    """The last row that a page showed."""

    published_at: datetime | None
    id: int


def list_after(
    episodes: DataFrame,
    distillations: DataFrame,
    after: Cursor | None = None,
    page_size: int = DEFAULT_PAGE_SIZE,
    status: str | None = None,
    from_date: date | None = None,
    to_date: date | None = None,
) -> DataFrame:
    """R15 by cursor: the rows that follow ``after``, newest first.

    The cursor is a filter, so a page costs a top-k of its own size however deep it
    lies; rows that come or go on earlier pages don't move it.
    """
    wanted = _wanted(episodes, status, from_date, to_date)
    if after is not None:
        when, lower = F.col("published_at"), F.col("id") < after.id
        if after.published_at is None:
            wanted = wanted.filter(when.isNull() & lower)
        else:
            at = moment(episodes, "published_at", after.published_at)
            wanted = wanted.filter((when < at) | ((when == at) & lower) | when.isNull())
    rows = wanted.orderBy(*newest_first()).limit(page_size)
    return rows.join(_result_sizes(_of_page(distillations, rows)), "id", "left").orderBy(*newest_first())


def list_page(
    episodes: DataFrame,
    distillations: DataFrame,
    page: int,
    workdir: str,
    page_size: int = DEFAULT_PAGE_SIZE,
    status: str | None = None,
    from_date: date | None = None,
    to_date: date | None = None,
) -> DataFrame:
    """R15 for a jump to any page, newest first, with ``pos`` from 1.

    Only the order (time and id) is sorted, by ranges; the counts of the ranges say which
    of them hold the page, so no task sees the rows before it.
    """
    wanted = _wanted(episodes, status, from_date, to_date)
    keys = wanted.select("published_at", F.col("id").alias("key"))
    order = [F.col("published_at").desc_nulls_last(), F.col("key").desc()]
    placed = number_bulk(keys, order, F.lit(1), workdir)  # its id is the place
    last = max(page, 1) * page_size
    inside = placed.filter(F.col("id").between(last - page_size + 1, last))
    rows = wanted.join(inside.select(F.col("key").alias("id"), F.col("id").alias("pos")), "id")
    return rows.join(_result_sizes(_of_page(distillations, rows)), "id", "left").orderBy("pos")


def _of_page(distillations: DataFrame, page_rows: DataFrame) -> DataFrame:
    """The results of a page's episodes.

    The side that a left join keeps cannot be broadcast, so the page is used to
    filter the results first: a semi join that leaves the result table in place.
    """
    ids = page_rows.select(F.col("id").alias("episode_id"))
    return distillations.join(ids, "episode_id", "left_semi")


def with_summaries(page_rows: DataFrame, distillations: DataFrame) -> DataFrame:
    """The current summary of each row of a page."""
    current = _of_page(distillations, page_rows).filter("is_current").select(
        F.col("episode_id").alias("id"), "summary"
    )
    return page_rows.join(current, "id", "left").orderBy(*newest_first())


def episodes_by_id(episodes: DataFrame, ids: DataFrame, key: str = "id") -> DataFrame:
    """The episodes of a set of ids or video ids."""
    return episodes.join(ids.select(key), key, "left_semi")


def current_result(distillations: DataFrame, episode_id: int) -> DataFrame:
    """R18."""
    return distillations.filter(F.col("is_current") & (F.col("episode_id") == episode_id))


def current_results(distillations: DataFrame, ids: DataFrame) -> DataFrame:
    """The current results of a set of episodes."""
    keys = ids.select(F.col("id").alias("episode_id"))
    return distillations.filter("is_current").join(keys, "episode_id", "left_semi")


def episode_detail(episodes: DataFrame, distillations: DataFrame, ids: DataFrame) -> DataFrame:
    """Episodes with their current result as one nested column, or null."""
    current = current_results(distillations, ids)
    nested = current.select(
        F.col("episode_id").alias("id"), F.struct(*current.columns).alias("distillation")
    )
    found = episodes_by_id(episodes, ids)
    return found.join(nested, "id", "left").withColumn(
        "summary", F.col("distillation.summary")
    )


def with_text(episodes: DataFrame, texts: DataFrame) -> DataFrame:
    """Add ``raw_text`` to stored episode rows (the version the row shows)."""
    stored = texts.select("id", "text_version", "raw_text")
    return episodes.join(stored, ["id", "text_version"], "left").select(
        *episodes.columns, "raw_text"
    )
