"""Summarisation requests, job results and versioned result rows."""

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from reelmill import schemas
from reelmill.functions.payload import json_kind
from reelmill.functions.text import first_truthy
from reelmill.functions.times import iso_utc, moment
from reelmill.operators.changes import has_text, new, reset_for_reprocess, update_rows
from reelmill.operators.discovery import next_id
from reelmill.operators.queues import MAX_DISTILL_ATTEMPTS, needing_distill
from reelmill.operators.transcripts import ERROR_CHARS

# The request's source marks and options.
REQUEST_SOURCE = "youtube"
REQUEST_SOURCE_TYPE = "youtube"
MAX_CHUNK_CHARS = 12000
INVALID_RESULT = "the summarisation service returned an invalid process response"
NO_JOB_ID = "the summarisation service did not return a job_id for the process request"

RESULT_KEY = ["episode_id", "model", "prompt_version"]


def request_json(source: str = REQUEST_SOURCE, max_chunk_chars: int = MAX_CHUNK_CHARS) -> Column:
    """the request document of an episode row with ``raw_text``.

    Unknown attributes are sent as null; only ``observed_at`` is left out when
    the publication time is unknown.
    """
    fields = [
        F.lit(source).alias("source"),
        F.lit(REQUEST_SOURCE_TYPE).alias("source_type"),
        F.col("video_id").alias("source_item_id"),
        F.col("title"),
        F.coalesce("raw_text", F.lit("")).alias("text"),
        F.struct(
            F.col("source_url").alias("url"),
            F.col("channel_slug").alias("channel"),
            F.col("thumbnail_url"),
            F.col("description"),
            F.col("transcript_language"),
            F.col("transcript_source"),
        ).alias("metadata"),
        F.struct(
            F.lit(True).alias("include_sentiment"),
            F.lit(True).alias("include_entities"),
            F.lit(True).alias("include_watchlist"),
            F.lit(False).alias("watchlist_required"),
            F.lit(max_chunk_chars).alias("max_chunk_chars"),
        ).alias("options"),
    ]
    keep_nulls = {"ignoreNullFields": "false"}
    observed = iso_utc(F.col("published_at")).alias("observed_at")
    return F.when(
        F.col("published_at").isNull(), F.to_json(F.struct(*fields), keep_nulls)
    ).otherwise(F.to_json(F.struct(*fields, observed), keep_nulls))


def job_id_for(batch: str) -> Column:
    """the same row in the same batch always gets the same job id."""
    return F.sha2(
        F.concat_ws("|", "video_id", F.col("distill_attempts").cast("string"), F.lit(batch)), 256
    )


def submissions(
    episodes: DataFrame,
    batch: str,
    limit: int | None = None,
    max_attempts: int = MAX_DISTILL_ATTEMPTS,
    receipts: DataFrame | None = None,
) -> DataFrame:
    """Q2 rows with the job id they get, or the error of a refused request.

    ``receipts`` (video_id, job_id, error) is what the delivering process got
    back; without it the job id is derived from the row.
    """
    return assign_jobs(needing_distill(episodes, limit, max_attempts), batch, receipts)


def assign_jobs(
    queue: DataFrame, batch: str, receipts: DataFrame | None = None, error_chars: int = ERROR_CHARS
) -> DataFrame:
    """Rows to submit -> (id, video_id, job_id, error); a row with a job keeps it."""
    if receipts is None:
        job = first_truthy(F.col("distill_job_id"), job_id_for(batch))
        return queue.select("id", "video_id", job.alias("job_id"), F.lit(None).cast("string").alias("error"))
    each = receipts if "given" in receipts.columns else one_receipt(receipts)
    answered = queue.join(each, "video_id")
    job = F.nullif(first_truthy(F.col("distill_job_id"), F.col("given")), F.lit(""))
    error = F.when(job.isNull(), F.substring(first_truthy(F.col("refusal"), NO_JOB_ID), 1, error_chars))
    return answered.select("id", "video_id", job.alias("job_id"), error.alias("error"))


def one_receipt(receipts: DataFrame) -> DataFrame:
    """video_id, given, refusal: one row per video, however often its receipt came; a job
    id counts before a refusal."""
    return receipts.groupBy("video_id").agg(
        F.min(F.when(F.col("job_id") != "", F.col("job_id"))).alias("given"),
        F.min(F.when(F.col("error") != "", F.col("error"))).alias("refusal"),
    )


def apply_submissions(episodes: DataFrame, submitted: DataFrame) -> DataFrame:
    """F5, F6 on the state: job id and cleared error, or a failed attempt."""
    refused = new("job_id").isNull()
    return update_rows(
        episodes,
        submitted.drop("video_id"),
        {
            "distill_job_id": new("job_id"),
            "status": F.when(refused, "failed").otherwise("fetched"),
            "last_error": new("error"),
            "distill_attempts": F.col("distill_attempts") + refused.cast("int"),
        },
    )


def submit_counts(submitted: DataFrame) -> DataFrame:
    return submitted.agg(
        F.count("job_id").alias("submitted"),
        F.count_if(F.col("job_id").isNull()).alias("failures"),
    )


def mark_distill_failed(
    episodes: DataFrame, failures: DataFrame, error_chars: int = ERROR_CHARS
) -> DataFrame:
    """F6. ``failures``: id, error. The job is dropped and the attempt counted."""
    return update_rows(
        episodes,
        failures.select("id", "error"),
        {
            "distill_job_id": F.lit(None),
            "distill_attempts": F.col("distill_attempts") + 1,
            "status": F.lit("failed"),
            "last_error": F.substring(new("error"), 1, error_chars),
        },
    )


def _is(value: Column, *kinds: str) -> Column:
    """The value is absent, null or of one of the JSON kinds."""
    return F.coalesce(json_kind(value).isin("VOID", *kinds), F.lit(True))


def classify_jobs(jobs: DataFrame) -> DataFrame:
    """job documents -> class and, for good ones, the result columns.

    ``kind`` is ok, invalid, failed or pending. A result whose parts have types
    that the result table cannot take is invalid.
    """

    def part(path: str) -> Column:
        return F.variant_get("doc", path, "variant")

    def text(path: str) -> Column:
        return F.try_variant_get("doc", path, "string")

    topics, segments = part("$.distillation.key_topics"), part("$.distillation.segments")
    topic_list = F.try_variant_get("doc", "$.distillation.key_topics", "array<string>")
    segment_list = F.try_variant_get("doc", "$.distillation.segments", "array<variant>")
    fits = (
        _is(part("$.processing"), "OBJECT")
        & _is(part("$.processing.model"), "STRING")
        & _is(part("$.processing.distill_prompt_version"), "STRING")
        & _is(part("$.processing.token_usage"), "OBJECT")
        & _is(part("$.request_id"), "STRING")
        & _is(part("$.distillation.summary"), "STRING")
        & (_is(topics) | F.schema_of_variant(topics).isin("ARRAY<STRING>", "ARRAY<VOID>"))
        & ~F.coalesce(F.exists(topic_list, lambda t: t.isNull()), F.lit(False))
        & _is(segments, "ARRAY")
        & F.coalesce(
            F.forall(segment_list, lambda s: json_kind(s) == "OBJECT"), F.lit(True)
        )
    )
    read = jobs.withColumn("doc", F.try_parse_json("result"))
    complete = F.coalesce(json_kind(part("$.distillation")) == "OBJECT", F.lit(False))
    kind = (
        F.when((F.col("status") == "succeeded") & complete & fits, "ok")
        .when(F.col("status") == "succeeded", "invalid")
        .when(F.col("status") == "failed", "failed")
        .otherwise("pending")
    )
    default_error = F.format_string("distill job %s failed", "job_id")
    error = F.when(F.col("kind") == "invalid", F.lit(INVALID_RESULT)).when(
        F.col("kind") == "failed", first_truthy(F.col("error"), default_error)
    )
    ok = F.col("kind") == "ok"

    def when_ok(value: Column, name: str) -> Column:
        return F.when(ok, value).alias(name)

    return read.withColumn("kind", kind).select(
        "job_id",
        "kind",
        error.alias("error"),
        when_ok(first_truthy(text("$.processing.model"), "unknown"), "model"),
        when_ok(
            first_truthy(text("$.processing.distill_prompt_version"), "unknown"), "prompt_version"
        ),
        when_ok(F.coalesce(text("$.distillation.summary"), F.lit("")), "summary"),
        when_ok(F.coalesce(topic_list, F.array().cast("array<string>")), "key_topics"),
        when_ok(
            F.coalesce(
                F.transform(segment_list, lambda s: F.to_json(s)), F.array().cast("array<string>")
            ),
            "segments",
        ),
        when_ok(text("$.processing.token_usage"), "token_usage"),
        when_ok(text("$.request_id"), "request_id"),
        when_ok(F.col("result"), "response_payload"),
    )


def ends(jobs: DataFrame) -> DataFrame:
    """The documents that say how a job ended."""
    return jobs.filter(F.col("status").isin("succeeded", "failed"))


def collected(pending: DataFrame, jobs: DataFrame) -> DataFrame:
    """Q3 rows with the class and result of their job.

    The first document that says how a job ended counts; a job without one is
    still pending. Documents of other jobs are dropped before anything else.
    """
    queue = pending.select("id", "video_id", F.col("distill_job_id").alias("job_id"))
    mine = ends(jobs).join(queue.select("job_id"), "job_id", "left_semi")
    mine = mine.drop(schemas.CORRUPT).withColumn("digest", F.xxhash64("status", "error", "result"))
    # keys are compared; the documents they choose are moved once
    first = F.min(F.struct("received_at", "digest")).alias("first")
    keys = mine.groupBy("job_id").agg(first).select(
        F.col("job_id").alias("of"), F.col("first.received_at").alias("at"), F.col("first.digest").alias("which")
    )
    same = (F.col("job_id") == F.col("of")) & F.col("received_at").eqNullSafe(F.col("at"))
    chosen = mine.join(keys, same & (F.col("digest") == F.col("which")), "left_semi").drop("digest")
    final = chosen.dropDuplicates(["job_id"])
    joined = queue.join(classify_jobs(final), "job_id", "left")
    return joined.withColumn("kind", F.coalesce("kind", F.lit("pending")))


def apply_collected(
    episodes: DataFrame, results: DataFrame, now: datetime, error_chars: int = ERROR_CHARS
) -> DataFrame:
    """F4 on the state: done, or a failed attempt; pending rows stay."""
    done = new("kind") == "ok"
    changes = results.filter(F.col("kind") != "pending").select("id", "kind", "error")
    return update_rows(
        episodes,
        changes,
        {
            "status": F.when(done, "done").otherwise("failed"),
            "distill_job_id": F.lit(None),
            "distill_attempts": F.col("distill_attempts") + (~done).cast("int"),
            "last_error": F.substring(new("error"), 1, error_chars),
            "distilled_at": F.when(done, moment(episodes, "distilled_at", now)).otherwise(
                F.col("distilled_at")
            ),
        },
    )


def collect_counts(results: DataFrame) -> DataFrame:
    return results.agg(
        F.count_if(F.col("kind") == "ok").alias("distilled"),
        F.count_if(F.col("kind").isin("invalid", "failed")).alias("failures"),
        F.count_if(F.col("kind") == "pending").alias("pending"),
    )


def result_changes(results: DataFrame) -> DataFrame:
    """The rows of a collect pass that go into the result table."""
    skip = ("kind", "error", "video_id", "job_id", "id")
    return results.filter(F.col("kind") == "ok").select(
        F.col("id").alias("episode_id"),
        *[c for c in results.columns if c not in skip],
        F.col("id").alias("seq"),
    )


def upsert_results(
    distillations: DataFrame,
    batch: DataFrame,
    now: datetime,
    all_ids: DataFrame | None = None,
    keys: DataFrame | None = None,
) -> DataFrame:
    """insert or overwrite on (episode, model, prompt); the newest is current.

    ``batch`` carries ``seq``, its order. The batch is reduced before any join
    (a keyed maximum with partial aggregation), and the stored table is only
    looked up by key, so it moves only when the batch is large. ``all_ids`` is
    where new ids are counted from if ``distillations`` is a part of the table. ``keys`` are
    key and ``seq`` of the batch, written by themselves: the planner knows how small they are
    and leaves the stored documents where they lie, however wide the batch is.
    """
    rest = [c for c in batch.columns if c not in RESULT_KEY]
    last = F.max_by(F.struct(*rest), "seq").alias("last")
    latest = batch.groupBy(*RESULT_KEY).agg(last).select(*RESULT_KEY, "last.*")
    newest = (batch if keys is None else keys).groupBy("episode_id").agg(F.max("seq").alias("newest_seq"))
    coming = latest.select(*RESULT_KEY) if keys is None else keys.select(*RESULT_KEY).distinct()

    # stored rows whose key comes again are replaced but keep their id
    replaced = distillations.select("id", *RESULT_KEY).join(
        coming, RESULT_KEY, "left_semi"
    )
    kept = (
        distillations.join(coming, RESULT_KEY, "left_anti")
        .join(newest.withColumn("touched", F.lit(True)), "episode_id", "left")
        .withColumn("is_current", F.col("is_current") & F.col("touched").isNull())
        .select(*distillations.columns)
    )
    placed = latest.join(newest, "episode_id").join(replaced, RESULT_KEY, "left")
    stored = dict(zip(distillations.columns, distillations.schema.fields))
    values = {
        "is_current": F.col("seq") == F.col("newest_seq"),
        "created_at": F.lit(now.isoformat()).cast(TimestampType()),
    }
    written = placed.select(
        *[
            values.get(c, F.col(c) if c in placed.columns else F.lit(None))
            .cast(f.dataType.simpleString())
            .alias(c)
            for c, f in stored.items()
        ]
    )
    return kept.unionByName(number_new(written, distillations if all_ids is None else all_ids))


def number_new(rows: DataFrame, table: DataFrame) -> DataFrame:
    """Ids for the rows that have none, above the highest one there is.

    Keys are spread over parts by hash and each part counts its own rows; the
    parts get disjoint id ranges from their sizes, so no task holds the batch.
    """
    part = F.pmod(F.xxhash64(*RESULT_KEY), F.lit(1024))
    missing = rows.filter(F.col("id").isNull()).withColumn("part", part)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        missing.groupBy("part")
        .agg(F.count("*").alias("rows"))
        .select("part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"))
    )
    within = F.row_number().over(Window.partitionBy("part").orderBy(*RESULT_KEY))
    numbered = missing.withColumn("place", within).join(offsets, "part")
    ids = F.col("offset") + F.col("place") - 1 + next_id(table)
    fresh = numbered.withColumn("id", ids).select(*rows.columns)
    return rows.filter(F.col("id").isNotNull()).unionByName(fresh)


def reprocess(
    episodes: DataFrame, candidates: DataFrame, batch: str
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """F8: reset the candidates that have text and submit them again.

    Returns the state after the reset and submission, the submissions and one
    counter row.
    """
    chosen = candidates.filter(has_text(candidates)).select("id")
    reset = reset_for_reprocess(episodes, chosen)
    submitted = assign_jobs(reset.join(chosen, "id", "left_semi"), batch)
    counts = submitted.agg(
        F.count("*").alias("reprocessed"), F.count("job_id").alias("submitted")
    )
    return apply_submissions(reset, submitted), submitted, counts
