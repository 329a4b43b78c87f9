"""Caption responses to transcripts, outcomes and episode transitions."""

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelmill.functions.languages import normalise_languages
from reelmill.functions.payload import detail_message, parse_body, whole_seconds
from reelmill.functions.text import content_hash, flatten_segments, has_content, squeeze
from reelmill.functions.times import moment
from reelmill.operators.changes import new, update_rows
from reelmill.operators.queues import MAX_ATTEMPTS

# Statuses that mean "try again later", the source mark of a
# stored transcript and the length that errors are cut to.
TRANSIENT = (402, 408, 429, 500, 502, 503, 504)
SOURCE = "transcriptapi"
ERROR_CHARS = 500

#: Rows of one video that are looked at together when captions come as rows.
CHUNK = 4096


def flatten_rows(segments: DataFrame) -> DataFrame:
    """T4: ``(video_id, pos, text)`` rows -> ``(video_id, raw_text)``.

    A line is compared with the line kept before it. Positions are cut into
    chunks, so the window never sees more than CHUNK rows of one video however
    long it is; only a chunk's last line crosses to the next chunk.
    """
    lines = segments.filter(has_content(F.col("text"))).select(
        "video_id",
        F.expr(f"pos div {CHUNK}").alias("chunk"),
        "pos",
        squeeze(F.col("text")).alias("text"),
    )
    order = Window.partitionBy("video_id", "chunk").orderBy("pos")
    inside = lines.withColumn("before", F.lag("text").over(order))
    # all lines are in order here, so the last line of a chunk is the one kept
    kept = inside.filter(F.col("before").isNull() | (F.col("text") != F.col("before")))
    joined = kept.groupBy("video_id", "chunk").agg(
        F.array_sort(F.collect_list(F.struct("pos", "text"))).alias("rows")
    )
    part = joined.select(
        "video_id",
        "chunk",
        F.get("rows.text", F.lit(0)).alias("first"),
        F.element_at("rows.text", -1).alias("last"),
        F.array_join("rows.text", "\n").alias("body"),
    )
    across = Window.partitionBy("video_id").orderBy("chunk")
    repeated = F.lag("last").over(across) == F.col("first")
    rest = F.substring(F.col("body"), F.length("first") + 2, F.length("body"))
    trimmed = part.withColumn(
        "body", F.when(F.coalesce(repeated, F.lit(False)), rest).otherwise(F.col("body"))
    )
    # the answer is one string per video; its pieces are whole chunks
    pieces = F.array_sort(F.collect_list(F.struct("chunk", "body")))
    return trimmed.filter(F.col("body") != "").groupBy("video_id").agg(
        F.array_join(pieces["body"], "\n").alias("raw_text")
    )


def with_digest(responses: DataFrame) -> DataFrame:
    """Add the number that tells the bodies of one video and moment apart."""
    return responses.withColumn("digest", F.xxhash64("http_status", "body"))


ANSWER = ["video_id", "received_at", "digest"]


def newest_answer(responses: DataFrame, queue: DataFrame) -> DataFrame:
    """The latest response of each queued video (others are dropped first).

    Only keys are compared and shuffled; the bodies are picked by a semi join.
    """
    mine = with_digest(responses.join(queue.select("video_id"), "video_id", "left_semi"))
    last = F.max(F.struct("received_at", "digest")).alias("last")
    keys = mine.groupBy("video_id").agg(last).select("video_id", "last.*")
    return mine.join(keys, ANSWER, "left_semi")


def classify(
    responses: DataFrame, languages: Column | None = None, with_text: bool = False
) -> DataFrame:
    """``(video_id, received_at, http_status, body)`` -> kind and error message.

    ``kind`` is ok, unavailable, transient or error. The answer rows are narrow;
    the transcript itself is only built when it is asked for.
    """
    asked = languages if languages is not None else F.array()
    codes = F.array_join(normalise_languages(asked), ",")
    answered = F.col("http_status") == 200
    captions = F.col("payload.transcript.text")
    read = with_digest(responses).select(
        *ANSWER,
        "http_status",
        "body",
        parse_body(F.col("body")).alias("payload"),
    )
    read = read.select(
        *ANSWER,
        "http_status",
        (answered & F.coalesce(F.exists(captions, has_content), F.lit(False))).alias("ok"),
        F.col("payload.language").alias("language"),
        whole_seconds(F.col("payload.length_seconds")).alias("length_seconds"),
        F.when(~answered, detail_message(F.col("body"), F.col("payload"))).alias("detail"),
        *([captions.alias("captions")] if with_text else []),
    )
    ok = F.col("ok")
    kind = (
        F.when(ok, "ok")
        .when(F.col("http_status").isin(200, 404), "unavailable")
        .when(F.col("http_status").isin(*TRANSIENT), "transient")
        .otherwise("error")
    )
    # The error texts; reports recognise them by their beginning.
    missing = F.format_string("transcript unavailable for %s (%s)", "video_id", codes)
    provider = F.format_string(
        "transcriptapi %s for %s: %s", F.col("http_status").cast("string"), "video_id", "detail"
    )
    error = (
        F.when(ok, F.lit(None))
        .when(answered, missing)
        .when(F.col("http_status") == 404, F.concat(missing, F.lit(": "), "detail"))
        .otherwise(provider)
    )
    text = F.when(ok, flatten_segments(F.col("captions"))).alias("text") if with_text else None
    return read.select(
        *ANSWER,
        "http_status",
        kind.alias("kind"),
        F.when(ok, F.col("language")).alias("language"),
        F.when(ok, F.col("length_seconds")).alias("length_seconds"),
        error.alias("error"),
        *([text] if with_text else []),
    )


def skip_reason(length: Column, min_seconds: int = 0, max_seconds: int = 0) -> Column:
    """Why a transcript of this length is not wanted; null when it is (0 = no gate)."""
    reason = F.lit(None).cast("string")
    if max_seconds:
        reason = F.when(
            length > max_seconds, F.format_string(f"above {max_seconds}s maximum (%ss)", length)
        ).otherwise(reason)
    if min_seconds:
        reason = F.when(
            length < min_seconds, F.format_string(f"below {min_seconds}s minimum (%ss)", length)
        ).otherwise(reason)
    return reason


def decisive_answers(
    queue: DataFrame, answers: DataFrame, max_attempts: int = MAX_ATTEMPTS
) -> DataFrame:
    """The answer that decides about each queued episode, and the tries before it.

    Several answers for one video count as passes in the order received: the
    first transcript decides, or the answer that uses up the tries, or else the
    last one. The same answer landed twice counts once.

    At most ``max_attempts`` failures, one transcript and one "try later" per
    video can matter; all others are dropped before the shuffle (a rank
    filter), so a video with very many answers is no heavy group.
    """
    wait = F.col("kind") == "transient"
    group = F.when(wait, "wait").when(F.col("kind") == "ok", "text").otherwise("try")
    received = F.unix_micros("received_at")
    place = Window.partitionBy("video_id", "group").orderBy(
        F.when(wait, -received).otherwise(received), "digest"
    )
    few = (
        answers.distinct()
        .withColumn("group", group)
        .withColumn("place", F.row_number().over(place))
        .filter(F.col("place") <= max(max_attempts, 1))
        .filter((F.col("group") == "try") | (F.col("place") == 1))
    )
    joined = queue.select("id", "video_id", "attempts").join(few, "video_id")
    order = Window.partitionBy("video_id").orderBy("received_at", "digest")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    is_try = F.col("group") == "try"
    counted = joined.withColumn(
        "tries", F.coalesce(F.count_if(is_try).over(before), F.lit(0))
    ).withColumn("turn", F.row_number().over(order))
    ends = (F.col("group") == "text") | (
        is_try & (F.col("attempts") + F.col("tries") + 1 >= max_attempts)
    )
    # the earliest answer that ends it, else the latest of all
    rank = F.struct(~ends, F.when(ends, F.col("turn")).otherwise(-F.col("turn")))
    rest = [c for c in counted.columns if c not in ("video_id", "group", "place", "turn")]
    return (
        counted.groupBy("video_id")
        .agg(F.min_by(F.struct(*rest), rank).alias("answer"))
        .select("video_id", "answer.*")
    )


def transitions(
    queue: DataFrame,
    responses: DataFrame,
    max_attempts: int = MAX_ATTEMPTS,
    min_seconds: int = 0,
    max_seconds: int = 0,
    languages: Column | None = None,
    error_chars: int = ERROR_CHARS,
) -> DataFrame:
    """What happens to each queued episode that has responses.

    One change row per episode: outcome, new status, attempts to add, error,
    duration and, when fetched, the transcript with its hash. Decisions are made
    on narrow rows; only the chosen transcripts are built and joined to them,
    and not even those where just the counts or statuses are used.
    """
    mine = responses.join(queue.select("video_id"), "video_id", "left_semi")
    answer = decisive_answers(queue, classify(mine, languages), max_attempts)
    ok = F.col("kind") == "ok"
    reason = F.when(ok, skip_reason(F.col("length_seconds"), min_seconds, max_seconds))
    tries_over = F.col("attempts") + F.col("tries") + 1 >= max_attempts
    outcome = (
        F.when(ok & F.col("reason").isNull(), "fetched")
        .when(ok, "skipped")
        .when((F.col("kind") == "unavailable") & tries_over, "skipped")
        .when(F.col("kind") == "unavailable", "unavailable")
        .otherwise("failed")
    )
    status = (
        F.when(F.col("outcome").isin("fetched", "skipped"), F.col("outcome"))
        .when(F.col("kind") == "transient", "discovered")
        .otherwise("failed")
    )
    fetched = F.col("outcome") == "fetched"
    decided = answer.withColumn("reason", reason).withColumn("outcome", outcome)
    texts = chosen_texts(mine, decided.filter(fetched).select(*ANSWER))
    return decided.withColumn("status", status).join(texts, "video_id", "left").select(
        "id",
        "video_id",
        "outcome",
        "status",
        (F.col("tries") + (F.col("status") == "failed").cast("int")).cast("int").alias("bump"),
        F.coalesce("reason", F.substring("error", 1, error_chars)).alias("last_error"),
        F.col("length_seconds").alias("duration_seconds"),
        "raw_text",
        F.length("raw_text").alias("raw_char_count"),
        F.when(fetched, content_hash(F.col("raw_text"))).alias("content_hash"),
        F.when(fetched, F.col("language")).alias("transcript_language"),
        F.when(fetched, F.lit(SOURCE)).alias("transcript_source"),
    )


def chosen_texts(responses: DataFrame, chosen: DataFrame) -> DataFrame:
    """``(video_id, raw_text)`` of the answers in ``chosen``, one row per video."""
    picked = with_digest(responses).join(chosen, ANSWER, "left_semi")
    captions = parse_body(F.col("body"))["transcript"]["text"]
    texts = picked.select("video_id", flatten_segments(captions).alias("raw_text"))
    return texts.dropDuplicates(["video_id"])


def apply_transitions(episodes: DataFrame, changes: DataFrame, now: datetime) -> DataFrame:
    """T10 on the state: the effects of U1, U2 and U3 in a single join."""
    fetched = new("status") == "fetched"

    def when_fetched(column: str) -> Column:
        return F.when(fetched, new(column)).otherwise(F.col(column))

    assign = {
        "status": new("status"),
        "attempts": F.col("attempts") + new("bump"),
        "last_error": new("last_error"),
        "duration_seconds": F.coalesce(new("duration_seconds"), F.col("duration_seconds")),
        "fetched_at": F.when(fetched, moment(episodes, "fetched_at", now)).otherwise(
            F.col("fetched_at")
        ),
        **{
            c: when_fetched(c)
            for c in (
                "raw_text",
                "raw_char_count",
                "content_hash",
                "transcript_language",
                "transcript_source",
                "text_version",
            )
            if c in episodes.columns and c in changes.columns
        },
    }
    if "raw_text" not in episodes.columns:
        changes = changes.drop("raw_text")
    return update_rows(episodes, changes.drop("video_id", "outcome"), assign)


def pass_counts(changes: DataFrame) -> DataFrame:
    """One row of counters; rate limits count as failures."""

    def tally(outcome: str, name: str) -> Column:
        return F.count_if(F.col("outcome") == outcome).alias(name)

    return changes.agg(
        tally("fetched", "transcripts_fetched"),
        tally("skipped", "skipped"),
        tally("unavailable", "unavailable"),
        tally("failed", "failures"),
    )
