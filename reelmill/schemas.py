"""Table and landed-file schemas (explicit, never inferred)."""

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DateType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# The episode statuses.
STATUSES = ("discovered", "fetched", "distilled", "done", "failed", "skipped")

# The five counters of a run row.
RUN_COUNTERS = (
    "episodes_discovered",
    "transcripts_fetched",
    "distilled",
    "reprocessed",
    "failures",
)


def _fields(*specs):
    return StructType([StructField(name, dtype, nullable) for name, dtype, nullable in specs])


_L, _I, _S, _T, _B = LongType(), IntegerType(), StringType(), TimestampType(), BooleanType()

#: Episode head rows. The transcript text lives in TEXTS, so a status change
#: never rewrites or shuffles it; ``raw_char_count`` is stored when the text is
#: and is null exactly when there is no text. ``text_version`` names the TEXTS
#: row that the episode shows.
EPISODES = _fields(
    ("id", _L, False),
    ("video_id", _S, False),
    ("channel_slug", _S, False),
    ("title", _S, True),
    ("published_at", _T, True),
    ("source_url", _S, False),
    ("thumbnail_url", _S, True),
    ("description", _S, True),
    ("duration_seconds", _I, True),
    ("transcript_language", _S, True),
    ("transcript_source", _S, True),
    ("content_hash", _S, True),
    ("raw_char_count", _I, True),
    ("text_version", _L, True),
    ("status", _S, False),
    ("attempts", _I, False),
    ("distill_attempts", _I, False),
    ("distill_job_id", _S, True),
    ("last_error", _S, True),
    ("discovered_at", _T, True),
    ("fetched_at", _T, True),
    ("distilled_at", _T, True),
)

#: One row per stored transcript. Rows are only added, until their episode is
#: deleted; a version is the number of the commit that stored it.
TEXTS = _fields(("id", _L, False), ("text_version", _L, False), ("raw_text", _S, False))

DISTILLATIONS = _fields(
    ("id", _L, False),
    ("episode_id", _L, False),
    ("model", _S, False),
    ("prompt_version", _S, False),
    ("summary", _S, False),
    ("key_topics", ArrayType(_S), False),
    ("segments", ArrayType(_S), False),
    ("token_usage", _S, True),
    ("request_payload", _S, True),
    ("response_payload", _S, True),
    ("request_id", _S, True),
    ("is_current", _B, False),
    ("created_at", _T, True),
)

INGEST_RUNS = _fields(
    ("run_date", DateType(), False),
    ("status", _S, False),
    *((name, _L, False) for name in RUN_COUNTERS),
    ("last_heartbeat", _T, True),
    ("notes", _S, True),
    ("created_at", _T, True),
    ("updated_at", _T, True),
)

#: Landed input that came before its episode or submission; it waits for them. The digest
#: tells documents of one key and time apart, so that keys are compared without bodies.
WAITING_ANSWERS = _fields(
    ("video_id", _S, False), ("http_status", _I, True), ("received_at", _T, True), ("body", _S, True),
    ("digest", _L, True),
)
WAITING_JOBS = _fields(
    ("job_id", _S, False),
    ("status", _S, True),
    ("error", _S, True),
    ("result", _S, True),
    ("received_at", _T, True),
    ("digest", _L, True),
)

#: Keys of the input that passes have used: it counts once, however often it is read.
USED_ANSWERS = _fields(("video_id", _S, False), ("received_at", _T, False), ("digest", _L, False))
USED_RECEIPTS = USED_ANSWERS
ENDED_JOBS = _fields(("job_id", _S, False))

#: Episodes whose texts and results are deleted but still in the files.
DELETED = _fields(("id", _L, False))

#: Rows of a table that reads leave out: those whose columns are in another table. So what
#: is deleted or done with costs its key; the rows go when their buckets are folded.
HIDDEN_BY = {
    "texts": ("deleted", {"id": "id"}),
    "distillations": ("deleted", {"episode_id": "id"}),
    "waiting_answers": ("used_answers", {c: c for c in ("video_id", "received_at", "digest")}),
    "waiting_jobs": ("ended_jobs", {"job_id": "job_id"}),
}

TABLES = {
    "episodes": EPISODES,
    "texts": TEXTS,
    "distillations": DISTILLATIONS,
    "ingest_runs": INGEST_RUNS,
    "waiting_answers": WAITING_ANSWERS,
    "waiting_jobs": WAITING_JOBS,
    "used_answers": USED_ANSWERS,
    "used_receipts": USED_RECEIPTS,
    "ended_jobs": ENDED_JOBS,
    "deleted": DELETED,
}

# Landed files, one JSON document per line. Each schema carries the corrupt
# record column so that an unreadable line is kept and can be counted.
CORRUPT = "_corrupt_record"

FEED_ROW = _fields(
    ("videoId", _S, True),
    ("title", _S, True),
    ("published", _S, True),
    ("link", _S, True),
    ("description", _S, True),
    ("thumbnail", _fields(("url", _S, True)), True),
)
FEED_DOC = _fields(
    ("channel", _S, True),
    ("received_at", _T, True),
    ("results", ArrayType(FEED_ROW), True),
    (CORRUPT, _S, True),
)
RESPONSE_DOC = _fields(
    ("video_id", _S, True),
    ("http_status", _I, True),
    ("received_at", _T, True),
    ("body", _S, True),
    (CORRUPT, _S, True),
)
JOB_DOC = _fields(
    ("job_id", _S, True),
    ("status", _S, True),
    ("error", _S, True),
    ("result", _S, True),
    ("received_at", _T, True),
    (CORRUPT, _S, True),
)
RECEIPT_DOC = _fields(
    ("video_id", _S, True),
    ("job_id", _S, True),
    ("error", _S, True),
    ("received_at", _T, True),
    (CORRUPT, _S, True),
)
