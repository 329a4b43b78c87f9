"""From raw documents to packed training sequences, each stage written and read again.

Stages take the documents that their predecessor kept, whatever further columns the table
has. Rows are judged each by itself: a stage that drops copies numbers the rows first, so
rows that share an id, repeat one another or have no id are told apart. Of rows with equal
texts exactly one stays (of the largest id, if there is one), and of near copies one. A null
text is empty: never toxic, without secrets, a copy of other empty texts, packed as the end
token alone. Texts of any length are taken in whole; an empty table gives no rows.
"""

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelmill.llm import exact_dedup, minhash, packing, secrets, toxicity
from reelmill.llm.common import documents, free_name, staged


def _numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a number of its own for each row, written: it reads alike each time."""
    row = free_name(docs, "row")
    return staged(docs.withColumn(row, F.monotonically_increasing_id()), "numbered"), row


def _without(docs: DataFrame, row: str, dropped: DataFrame) -> DataFrame:
    """``docs`` without the rows whose numbers are dropped; only those are joined."""
    gone = free_name(docs, "dropped")
    numbers = staged(dropped.toDF(gone), "dropped")
    return docs.join(numbers, F.col(row) == F.col(gone), "left_anti").drop(row)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    model = toxicity.fit_model(docs, labels.filter(toxicity.learn_row("doc_id", 5, 0)))
    return toxicity.without_toxic(docs, model)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs, row = _numbered(docs)
    return _without(docs, row, exact_dedup.exact_dedup(docs, row=row).filter("NOT kept").select("row"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs, row = _numbered(docs)
    judged = minhash.near_duplicates(docs.select(F.col(row).alias("doc_id"), "text"))
    return _without(docs, row, judged.filter("NOT kept").select("doc_id"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs, secrets.scan(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    groups = max(1, math.ceil(docs.count() / packing.GROUP_DOCS))
    return packing.pack(packing.pieces(docs), groups)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("minhash_near_dedup", drop_near_copies),
    ("secret_scans", redact_secrets),
    ("packing", pack_sequences),
]

#: The toxicity model can't be stated in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
