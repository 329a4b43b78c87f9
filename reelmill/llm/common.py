"""What several of the corpus operators share: normal form, words, staging."""

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelmill.sources.store import work_dir

#: Bytes of text that a Python worker handles at once.
BATCH_BYTES = 4 << 20


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def staged(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` written to the shared folder and read back: later steps, also after
    a lost executor, start from the files."""
    spark = rows.sparkSession
    path = f"{work_dir(spark)}/{name}"
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def free_name(rows: DataFrame, name: str) -> str:
    """``name``, with lines added until no column of ``rows`` has it (in any case)."""
    taken = {column.lower() for column in rows.columns}
    while name.lower() in taken:
        name += "_"
    return name


def with_fields(rows: DataFrame, **kinds: str) -> T.StructType:
    """The schema of ``rows`` with further fields of the simple types given."""
    return T.StructType([*rows.schema.fields, *T.StructType.fromDDL(", ".join(map(" ".join, kinds.items())))])


def fold(data: bytes) -> bytes:
    """UTF-8 text with A-Z (and no other letter) in lower case."""
    return data.lower()


def words_of(data: bytes) -> list[bytes]:
    """Words of folded text: stretches without the bytes 09-0D and 20."""
    return data.lower().split()


def texts(
    batches: Iterator[pa.RecordBatch], at_once: int = BATCH_BYTES, column: str = "text"
) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of the batches with the (UTF-8) bytes of their column ``column`` (null: empty).

    A slice holds about ``at_once`` bytes of text, or one row that is longer.
    """
    for batch in batches:
        values = batch.column(batch.schema.get_field_index(column))
        sizes = [n or 0 for n in pa.compute.binary_length(values).to_pylist()]
        start = size = 0
        for i, n in enumerate(sizes):
            if i > start and size + n > at_once:
                yield _slice(batch, values, start, i)
                start, size = i, 0
            size += n
        if start < len(sizes):
            yield _slice(batch, values, start, len(sizes))


def _slice(batch, column, start, end):
    part = column.slice(start, end - start)
    kind = pa.large_binary() if pa.types.is_large_string(part.type) else pa.binary()
    return batch.slice(start, end - start), [t or b"" for t in part.cast(kind).to_pylist()]


class WordHashes(dict):
    """64-bit hashes of words, kept for the words met last."""

    KEPT = 400_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.KEPT:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def learn_row(doc_id: str, folds: int, out: int):
    """Condition: the row's id doesn't fall into the fold that is held out (null ids learn)."""
    return ~held_out(doc_id, folds, out)


def held_out(doc_id: str, folds: int, out: int):
    """Condition: crc32 of the id as text, modulo ``folds``, is ``out`` (null id: false)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds == out, F.lit(False))
