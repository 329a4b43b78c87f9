"""Request documents for the outside summarisation service.

A pass writes its requests to a folder of its own and names it in the record of its
commit. Readers follow the records: requests of a pass that died before its commit, or
that was refused, are in no record and are never sent; no other pass writes over them.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelmill.sources.store import StateStore


def write_requests(requests: DataFrame, folder: str) -> None:
    """Write ``(job_id, request)`` rows, one JSON document per line, to a new folder."""
    opened = F.regexp_replace(F.to_json(F.struct("job_id")), r"\}\z", "")
    line = F.concat(opened, F.lit(',"request":'), F.col("request"), F.lit("}"))
    requests.select(line.alias("value")).write.text(folder)


def read_requests(spark: SparkSession, *folders: str) -> DataFrame:
    """Folders of requests as ``(batch, job_id, request)``; ``request`` is JSON text."""
    schema = "job_id string, request string"
    if not folders:
        return spark.createDataFrame([], f"batch string, {schema}")
    found = spark.read.schema(schema).json(list(folders))
    batch = F.regexp_extract(F.col("_metadata.file_path"), "/batch=([^/]*)/", 1)
    return found.select(batch.alias("batch"), "job_id", "request")


def sent_requests(store: StateStore, after: int = 0) -> DataFrame:
    """Everything that the commits above version ``after`` have sent."""
    return read_requests(store.spark, *store.requests(after))
