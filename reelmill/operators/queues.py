"""Work-queue selection and candidate filters (Q1-Q6)."""

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelmill.functions.times import in_date_range
from reelmill.operators.changes import has_text

# Attempt ceilings.
MAX_ATTEMPTS = 5
MAX_DISTILL_ATTEMPTS = 10


def newest_first() -> list[Column]:
    return [F.col("published_at").desc_nulls_last(), F.col("id").desc()]


def head(rows: DataFrame, limit: int | None) -> DataFrame:
    """The newest ``limit`` rows; all of them, in no order, without a limit.

    Sort and limit are one step: every task keeps its best rows."""
    return rows if limit is None else rows.orderBy(*newest_first()).limit(limit)


def needing_transcript(
    episodes: DataFrame, limit: int | None = None, max_attempts: int = MAX_ATTEMPTS
) -> DataFrame:
    """Q1: new episodes, or failures without text that have tries left."""
    retry = (F.col("status") == "failed") & ~has_text(episodes)
    wanted = (F.col("status") == "discovered") | (retry & (F.col("attempts") < max_attempts))
    return head(episodes.filter(wanted), limit)


def needing_distill(
    episodes: DataFrame, limit: int | None = None, max_attempts: int = MAX_DISTILL_ATTEMPTS
) -> DataFrame:
    """Q2: texts that are not submitted, or failed submissions with tries left."""
    retry = (
        (F.col("status") == "failed")
        & has_text(episodes)
        & (F.col("distill_attempts") < max_attempts)
    )
    wanted = F.col("distill_job_id").isNull() & ((F.col("status") == "fetched") | retry)
    return head(episodes.filter(wanted), limit)


def pending_distill(episodes: DataFrame, limit: int | None = None) -> DataFrame:
    """Q3: submitted jobs whose result is not in yet."""
    wanted = (F.col("status") == "fetched") & F.col("distill_job_id").isNotNull()
    return head(episodes.filter(wanted), limit)


def failed_candidates(
    episodes: DataFrame,
    from_date: date | None = None,
    to_date: date | None = None,
    max_attempts: int | None = None,
) -> DataFrame:
    """Q4: failures of a date range, by id."""
    wanted = (F.col("status") == "failed") & in_date_range(
        episodes, "published_at", from_date, to_date
    )
    if max_attempts is not None:
        wanted = wanted & (F.col("attempts") < max_attempts)
    return episodes.filter(wanted).orderBy("id")


def reprocess_candidates(
    episodes: DataFrame,
    distillations: DataFrame,
    from_date: date | None = None,
    to_date: date | None = None,
    only_stale: bool = False,
    model: str | None = None,
    prompt_version: str | None = None,
) -> DataFrame:
    """Q5: texts of a date range, optionally only those whose current result is
    not of the given model and prompt version, by id."""
    wanted = episodes.filter(
        has_text(episodes) & in_date_range(episodes, "published_at", from_date, to_date)
    )
    if only_stale and model and prompt_version:
        up_to_date = distillations.filter(
            F.col("is_current")
            & (F.col("model") == model)
            & (F.col("prompt_version") == prompt_version)
        ).select(F.col("episode_id").alias("id"))
        wanted = wanted.join(up_to_date, "id", "left_anti")
    return wanted.orderBy("id")


def split_retries(
    candidates: DataFrame, delete_after: int | None
) -> tuple[DataFrame, DataFrame]:
    """Q6, first half: (to delete, to reset and fetch again)."""
    if delete_after is None:
        return candidates.filter(F.lit(False)), candidates
    used_up = F.col("attempts") >= delete_after
    return candidates.filter(used_up), candidates.filter(~used_up)


def still_failed(episodes: DataFrame, retried: DataFrame, delete_after: int | None) -> DataFrame:
    """Q6, second half: retried rows that failed again at or over the limit."""
    if delete_after is None:
        return episodes.filter(F.lit(False))
    again = (F.col("status") == "failed") & (F.col("attempts") >= delete_after)
    return episodes.filter(again).join(retried.select("id"), "id", "left_semi")
