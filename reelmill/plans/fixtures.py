"""The given test tables as model tables and landed documents.

Formulas only, one row out per row in (see FIXTURES.md part B).
"""

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = datetime(2024, 1, 30, 23, 57, 12)
NOW = datetime(2024, 2, 1, 12, 30, 0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _video_id() -> Column:
    return F.concat(F.lit("v"), F.lpad(F.col("doc_id").cast("string"), 10, "0"))


def _published() -> Column:
    day = F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(cast((doc_id * 7) % 30 as int))")
    return day


def _seconds() -> Column:
    return F.expr("cast(n_chars div 15 as int)")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").withColumn("m", F.col("doc_id") % 10)


def episodes(spark: SparkSession, sf_dir: str, text: bool = False) -> DataFrame:
    """B1, with ``raw_text`` only on demand."""
    d, m = F.col("doc_id"), F.col("m")
    has_text = m.isin(2, 4, 5, 7, 8, 9)
    vid = _video_id()
    status = (
        F.when(m == 0, "discovered")
        .when(m.isin(1, 2, 6), "failed")
        .when(m == 3, "skipped")
        .when(m.isin(4, 5), "fetched")
        .otherwise("done")
    )
    error = (
        F.when(m == 1, F.format_string("transcript unavailable for %s (en,asr)", vid))
        .when(m == 2, F.format_string("distill job j%s failed", d))
        .when(m == 3, F.format_string("below 600s minimum (%ss)", _seconds()))
    )
    rows = documents(spark, sf_dir).select(
        (d + 1).alias("id"),
        vid.alias("video_id"),
        F.col("source").alias("channel_slug"),
        F.concat(F.lit("Episode "), d).alias("title"),
        F.when(d % 17 != 0, _published()).alias("published_at"),
        F.concat(F.lit("https://example.test/watch?v="), vid).alias("source_url"),
        F.when(d % 3 == 0, F.concat(F.lit("https://example.test/t/"), d)).alias("thumbnail_url"),
        F.lit(None).cast("string").alias("description"),
        F.when(~m.isin(0, 1, 6), _seconds()).alias("duration_seconds"),
        F.when(has_text, F.col("lang")).alias("transcript_language"),
        F.when(has_text, "transcriptapi").alias("transcript_source"),
        F.lit(None).cast("string").alias("content_hash"),
        F.when(has_text, F.col("text")).alias("raw_text"),
        F.when(has_text, F.col("n_chars").cast("int")).alias("raw_char_count"),
        status.alias("status"),
        (d % 7).cast("int").alias("attempts"),
        (d % 12).cast("int").alias("distill_attempts"),
        F.when(m == 5, F.concat(F.lit("j"), d)).alias("distill_job_id"),
        error.alias("last_error"),
        _published().alias("discovered_at"),
        F.when(has_text, _published()).alias("fetched_at"),
        F.when(m >= 7, _published()).alias("distilled_at"),
    )
    return rows if text else rows.drop("raw_text")


def distillations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B2, two results of every document, with lists of the counted sizes."""
    d, k = F.col("doc_id"), F.col("k")
    return documents(spark, sf_dir).withColumn("k", F.explode(F.array(F.lit(1), F.lit(2)))).select(
        (d * 2 + k).alias("id"),
        (d + 1).alias("episode_id"),
        F.concat(F.lit("m"), d % 2).alias("model"),
        F.concat(F.lit("v"), k).alias("prompt_version"),
        F.coalesce("text", F.lit("")).alias("summary"),
        F.array_repeat(F.lit("topic"), (d % 4).cast("int")).alias("key_topics"),
        F.array_repeat(F.lit("{}"), (d % 5).cast("int")).alias("segments"),
        F.lit(None).cast("string").alias("token_usage"),
        F.lit("{}").alias("request_payload"),
        F.lit("{}").alias("response_payload"),
        F.lit(None).cast("string").alias("request_id"),
        F.when(d % 20 == 9, k == 1).otherwise(k == 2).alias("is_current"),
        _published().alias("created_at"),
    )


def ingest_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B3."""
    kind = F.col("event_type")
    counted = table(spark, sf_dir, "events").groupBy(F.to_date("ts").alias("run_date")).agg(
        F.count_if(kind == "signup").alias("episodes_discovered"),
        F.count_if(kind == "view").alias("transcripts_fetched"),
        F.count_if(kind == "purchase").alias("distilled"),
        F.count_if(kind == "click").alias("reprocessed"),
        F.count_if(kind == "error").alias("failures"),
        F.max("ts").alias("last_heartbeat"),
    )
    third = F.col("failures") % 3
    status = F.when(third == 0, "success").when(third == 1, "partial").otherwise("failed")
    counters = counted.columns[1:6]
    return counted.select(
        "run_date",
        status.alias("status"),
        *counters,
        "last_heartbeat",
        F.lit("{}").alias("notes"),
        F.col("last_heartbeat").alias("created_at"),
        F.col("last_heartbeat").alias("updated_at"),
    )


CHANNELS = "click, error, purchase, signup, view"


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B4 in the shape of feed entries: one entry per event."""
    e = F.col("event_id")
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("@"), "event_type").alias("channel"),
        e.alias("feed_pos"),
        F.concat(F.lit("u"), "user_id").alias("videoId"),
        F.concat(F.lit("Event "), e).alias("title"),
        F.when(e % 101 != 0, stamp).alias("published"),
        F.lit(None).cast("string").alias("link"),
        F.col("props").alias("description"),
        F.struct(F.concat(F.lit("t"), e).alias("url")).alias("thumbnail"),
    )


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B5 as provider responses; the caption list is the document's lines."""
    d = F.col("doc_id")
    k = d % 12
    status = (
        F.when(k == 0, 404).when(k == 1, 402).when(k == 2, 429).when(k == 3, 500).when(k == 4, 403)
    )
    captions = F.transform(F.split("text", "\n"), lambda t: F.struct(t.alias("text")))
    none = F.array().cast("array<struct<text string>>")
    full = F.to_json(
        F.struct(
            F.when(k > 5, captions).otherwise(none).alias("transcript"),
            F.col("lang").alias("language"),
            F.when(d % 13 != 0, _seconds()).alias("length_seconds"),
        )
    )
    body = (
        F.when(k == 1, F.lit('{"detail":{"message":"monthly quota is used up","reason":"quota"}}'))
        .when(k == 0, F.lit('{"detail":"captions are off"}'))
        .when(k < 5, F.lit("{}"))
        .otherwise(full)
    )
    return documents(spark, sf_dir).select(
        "doc_id",
        _video_id().alias("video_id"),
        F.coalesce(status, F.lit(200)).alias("http_status"),
        F.lit(NOW.isoformat()).cast("timestamp").alias("received_at"),
        body.alias("body"),
    )


def response_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a queued episode without text."""
    d = F.col("doc_id")
    return documents(spark, sf_dir).select(
        (d + 1).alias("id"), _video_id().alias("video_id"), (d % 7).cast("int").alias("attempts")
    )


def jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One job document per document, its whole text as the summary of a good one."""
    d = F.col("doc_id")
    k = d % 8
    result = F.struct(
        F.format_string("r%s", d).alias("request_id"),
        F.struct(
            F.lit("m1").alias("model"), F.struct(d.alias("total_tokens")).alias("token_usage")
        ).alias("processing"),
        F.struct(
            F.coalesce("text", F.lit("")).alias("summary"),
            F.array(F.lit("a"), F.lit("b")).alias("key_topics"),
            F.array(F.struct(d.alias("n"))).alias("segments"),
        ).alias("distillation"),
    )
    good = k.isin(0, 2, 5, 6)
    body = F.when(good, F.to_json(result)).when(k == 7, F.format_string('{"request_id":"r%s"}', d))
    status = F.when(k.isin(1, 4), "failed").when(k == 3, "running").otherwise("succeeded")
    return documents(spark, sf_dir).select(
        F.concat(F.lit("j"), d).alias("job_id"),
        status.alias("status"),
        F.when(k.isin(1, 4) & (d % 16 < 8), F.format_string("model error %s", d)).alias("error"),
        body.alias("result"),
        F.lit(NOW.isoformat()).cast("timestamp").alias("received_at"),
    )


def receipts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the service answers to a request for each document; some answers come twice."""
    d = F.col("doc_id")
    k = d % 11
    times = F.when(d % 3 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return documents(spark, sf_dir).select(
        _video_id().alias("video_id"),
        F.when(k > 1, F.concat(F.lit("k"), d)).alias("job_id"),
        F.when(k == 1, F.format_string("queue full for %s", d)).alias("error"),
        F.lit(NOW.isoformat()).cast("timestamp").alias("received_at"),
        F.explode(times).alias("copy"),
    ).drop("copy")


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B7, row form of the document lines."""
    return documents(spark, sf_dir).select(
        F.col("doc_id").cast("string").alias("video_id"),
        F.posexplode(F.split("text", "\n")).alias("pos", "text"),
    )
