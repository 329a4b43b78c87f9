"""Landed JSON files as batch or streaming frames (S1-S3, receipts of S5).

A line that is no JSON keeps its text in the corrupt-record column; the row
views below drop it and :func:`unreadable` counts it.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelmill import schemas


def _read(spark: SparkSession, path: str, schema, stream: bool, files_per_batch: int | None):
    reader = spark.readStream if stream else spark.read
    if stream and files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.schema(schema).option("mode", "PERMISSIVE").json(path)


def read_feeds(
    spark: SparkSession, path: str, *, stream: bool = False, files_per_batch: int | None = None
) -> DataFrame:
    """Feed documents; ``received_at``, then the file, orders a channel's landings."""
    docs = _read(spark, path, schemas.FEED_DOC, stream, files_per_batch)
    return docs.withColumn("doc", F.col("_metadata.file_path"))


def feed_rows(docs: DataFrame) -> DataFrame:
    """One row per feed entry in feed order; missing ``results`` is an empty feed."""
    entries = docs.filter(F.col("channel").isNotNull()).select(
        "channel", "received_at", "doc", F.posexplode("results").alias("feed_pos", "entry")
    )
    return entries.select(*entries.columns[:-1], "entry.*")


def read_responses(
    spark: SparkSession, path: str, *, stream: bool = False, files_per_batch: int | None = None
) -> DataFrame:
    """Caption responses; an object body arrives as its JSON text."""
    docs = _read(spark, path, schemas.RESPONSE_DOC, stream, files_per_batch)
    return docs.filter(F.col("video_id").isNotNull())


def read_jobs(
    spark: SparkSession, path: str, *, stream: bool = False, files_per_batch: int | None = None
) -> DataFrame:
    """S3: polled job documents; ``result`` keeps its JSON text."""
    docs = _read(spark, path, schemas.JOB_DOC, stream, files_per_batch)
    return docs.filter(F.col("job_id").isNotNull())


def read_receipts(
    spark: SparkSession, path: str, *, stream: bool = False, files_per_batch: int | None = None
) -> DataFrame:
    """What the service answered to a request: a job id or an error."""
    docs = _read(spark, path, schemas.RECEIPT_DOC, stream, files_per_batch)
    return docs.filter(F.col("video_id").isNotNull())


def unreadable(spark: SparkSession, path: str) -> DataFrame:
    """Lines of a landing directory that are not JSON documents."""
    return spark.read.text(path).filter(F.try_parse_json("value").isNull())
