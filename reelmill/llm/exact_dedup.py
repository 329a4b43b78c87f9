"""Exact deduplication over content-defined chunk recipes.

Every text is cut where a rolling hash over its last 16 bytes says so; a chunk is
named by its digest. One job groups the chunks by digest and compares their bytes,
so that a digest names one chunk only (a digest that would name two is extended by
the bytes themselves). From there on a text is its recipe, the ordered list of
chunk names, and only recipes are grouped and joined: a long document is never
moved as a whole, and a chunk that many documents share is moved once per task.

Defined cases: a null text is empty; empty texts have the empty recipe and are
equal; rows with a null id count in their group but never name it while another id
is there; of equal rows that repeat the largest id (or have no id at all) exactly one
stays; rows that repeat an id with another text are judged by that text; an empty table
gives no rows. Texts of any length are chunked whole. Only the id and text columns are
read (and a given row key), so other columns may have any name.
"""

import hashlib
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelmill.llm.common import documents, fold, staged, texts

WINDOW = 16
_MIX = np.frombuffer(
    b"".join(hashlib.sha256(bytes([i])).digest()[:4] for i in range(256)), dtype="<u4"
)


@dataclass(frozen=True)
class Chunking:
    """Bytes of a chunk: never under ``least`` (but the last), about ``least + 2**bits``,
    never over ``most``. ``digest_bytes`` of SHA-256 name a chunk."""

    bits: int = 10
    least: int = 256
    most: int = 8192
    digest_bytes: int = 32


def marks(data: np.ndarray, bits: int, at_once: int = 1 << 20) -> list[int]:
    """Ends of the windows whose rolling hash begins with ``bits`` zeros."""
    found = []
    for low in range(0, len(data), at_once):
        first = max(0, low - WINDOW + 1)
        rolled = _MIX[data[first : low + at_once]]
        for shift in (1, 2, 4, 8):
            rolled[shift:] += rolled[:-shift] << np.uint32(shift)
        ends = np.flatnonzero(rolled >> np.uint32(32 - bits) == 0) + first + 1
        found.extend(ends[ends > low].tolist())
    return found


def cut(start: int, end: int, ends: list[int], how: Chunking) -> list[int]:
    """Ends of the chunks of the text that lies at ``start`` to ``end``.

    No chunk is shorter than the window, so no hash that counts reaches back over
    ``start`` and equal texts are cut alike wherever they lie.
    """
    cuts = []
    while end - start > how.least:
        i = bisect_left(ends, start + how.least)
        start = min(ends[i] if i < len(ends) else end, start + how.most, end)
        cuts.append(start)
    if start < end:
        cuts.append(end)
    return cuts


def _chunked(data: list[bytes], how: Chunking) -> Iterator[tuple[bytes, list[bytes]]]:
    """Each folded text and its chunks."""
    joined = fold(b"".join(data))
    ends = marks(np.frombuffer(joined, dtype=np.uint8), how.bits)
    start = 0
    for text in data:
        end = start + len(text)
        edges = [start, *cut(start, end, ends, how)]
        yield joined[start:end], [joined[a:b] for a, b in zip(edges, edges[1:], strict=False)]
        start = end


def chunks(docs: DataFrame, how: Chunking = Chunking()) -> DataFrame:
    """digest, chunk: every chunk of the texts, at least once per batch."""

    def run(batches):
        for _, data in texts(batches):
            found = {}
            for _, parts in _chunked(data, how):
                for part in parts:
                    found[part] = hashlib.sha256(part).digest()[: how.digest_bytes]
            yield pa.RecordBatch.from_pydict(
                {"digest": pa.array(found.values(), pa.binary()), "chunk": pa.array(found, pa.binary())}
            )

    return docs.select("text").mapInArrow(run, "digest binary, chunk binary")


def ambiguous(found: DataFrame) -> DataFrame:
    """Digests that stand for more than one chunk; none in practice."""
    different = found.groupBy("digest", "chunk").agg(F.lit(1).alias("one"))
    return different.groupBy("digest").agg(F.count("*").alias("n")).filter("n > 1").select("digest")


def recipes(
    docs: DataFrame, how: Chunking = Chunking(), unclear: frozenset = frozenset(), row: str | None = None
) -> DataFrame:
    """doc_id, row, text_sha256, recipe: chunk names in order. A name in ``unclear`` is
    followed by the chunk's length and bytes. ``row`` is the column of that name, a long,
    or null."""

    def run(batches):
        for batch, data in texts(batches):
            names, whole = [], []
            for text, parts in _chunked(data, how):
                whole.append(hashlib.sha256(text).hexdigest())
                name = []
                for part in parts:
                    digest = hashlib.sha256(part).digest()[: how.digest_bytes]
                    name.append(digest)
                    if digest in unclear:
                        name += [len(part).to_bytes(8, "little"), part]
                names.append(b"".join(name))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(whole), pa.array(names, pa.binary())],
                ["doc_id", "row", "text_sha256", "recipe"],
            )

    number = F.col(row) if row else F.lit(None).cast("long")
    return docs.select(F.col("doc_id").cast("long"), "text", number.alias("row")).mapInArrow(
        run, "doc_id long, row long, text_sha256 string, recipe binary"
    )


def exact_dedup(docs: DataFrame, how: Chunking = Chunking(), row: str | None = None) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256, n_chunks, row: one row per document.

    ``row`` names a column of ``docs`` that tells its rows apart, if there is one; it comes
    back as ``row``, else numbers given here do.

    The only thing that comes to the driver is the list of ambiguous digests, which
    is empty unless SHA-256 (cut to ``digest_bytes``) collides.
    """
    unclear = frozenset(bytes(r.digest) for r in ambiguous(chunks(docs, how)).toLocalIterator())
    named = recipes(docs, how, unclear, row)
    if row is None:  # numbers are given once, with the staged rows
        named = named.withColumn("row", F.monotonically_increasing_id())
    named = staged(named, "recipes")
    groups = named.groupBy("recipe").agg(
        F.max(F.struct("doc_id", "row")).alias("keep"), F.count("*").alias("group_size")
    )
    return named.join(groups, "recipe").select(
        "doc_id",
        F.col("keep.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("keep.row")).alias("kept"),
        "text_sha256",
        F.floor(F.length("recipe") / how.digest_bytes).alias("n_chunks") if not unclear else F.lit(None).cast("long").alias("n_chunks"),
        "row",
    )


def op1_chunk_recipes(spark, sf_dir: str) -> DataFrame:
    return exact_dedup(documents(spark, sf_dir)).drop("n_chunks", "row")


SQL = """
WITH norm AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                  'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents
)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, text_sha256
FROM norm WINDOW g AS (PARTITION BY text_sha256)
"""

QUERIES = {"op1_chunk_recipes": (op1_chunk_recipes, SQL)}
