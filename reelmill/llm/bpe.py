"""Byte-level BPE by a global shuffle of distinct words, and decoding by table.

A *word* is a stretch of text with at most one leading blank, or white space: no
pre-token crosses its edges, so the pre-tokens of a word are those that it has in
its text. Two passes over the texts see them in the same blocks (runs of rows of
one task):

* the first deals the distinct words of a block, with their numbers there, to the
  shares that own them, one packed row per block and share; the task of a share
  encodes each distinct word once and sends the ids back, packed alike;
* the second sends the positions, as numbers of words, and both meet by block,
  where the ids are put together by position.

A frequent word so travels once per block, not once per occurrence, and takes no more
room than any other, so no key is hot. Where a block is put together its words are
places in one array of ids, not objects, so a task holds little more than its output.
``docs`` must be a relation that reads the same rows in the same tasks again: a table
or a staged result.

Defined cases: a null text is empty and has no ids; a repeated row is encoded each
time; control words of other vocabularies are ordinary text; an empty table gives
no rows. Only the id and the text are read.
"""

import base64
import re
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelmill.llm.common import documents, texts, with_fields

#: Bytes of text in a block, if no single text is longer.
BLOCK_BYTES = 16 << 20
#: Words of a text whose ids are gathered at once.
GATHERED = 1 << 18
#: Shares of the words per shuffle partition, and words that a task keeps encoded.
SHARES, KEPT = 4, 1_000_000

#: The letters that are white space to the pattern.
_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
WORD = re.compile(f" ?[^{_SPACE}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")


def ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ids of a vocabulary file, a bounded table."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Numbers(dict):
    """Numbers of words in the order in which they come."""

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        return number


def _blocks(batches, block_bytes: int) -> Iterator[tuple[int, list, list, np.ndarray, Numbers]]:
    """block, ids of its rows, words in each, word numbers one after another, the words."""
    first = TaskContext.get().partitionId() << 32
    for i, (batch, data) in enumerate(texts(batches, block_bytes)):
        numbers, counts, codes = Numbers(), [], []
        for text in data:
            found = WORD.findall(text.decode("utf-8", "replace"))
            counts.append(len(found))
            codes.append(np.fromiter(map(numbers.__getitem__, found), np.uint32, len(found)))
        del data
        yield first + i, batch.column(0), counts, np.concatenate(codes), numbers
        del numbers, codes  # not held while the next block is read


def _pack(numbers: np.ndarray) -> bytes:
    """Small numbers in two bytes, the others in four more."""
    big = numbers >= 65535
    low = np.where(big, 65535, numbers).astype("<u2")
    return zlib.compress(low.tobytes() + numbers[big].astype("<u4").tobytes(), 1)


def _unpack(packed: bytes, n: int) -> np.ndarray:
    data = zlib.decompress(packed)
    numbers = np.frombuffer(data, "<u2", n).astype(np.uint32)
    numbers[numbers == 65535] = np.frombuffer(data, "<u4", offset=2 * n)
    return numbers


def _bytes_of(numbers: np.ndarray) -> bytes:
    """Numbers with a length in front, compressed."""
    return zlib.compress(np.append(len(numbers), numbers).astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def _numbers_of(packed: bytes) -> np.ndarray:
    data = np.frombuffer(zlib.decompress(packed), np.uint8)
    return np.ascontiguousarray(data.reshape(4, -1).T).view("<u4").ravel()[1:]


def block_words(docs: DataFrame, block_bytes: int, shares: int) -> DataFrame:
    """block, share, numbers, words: the distinct words of each block by their owner,
    numbers as steps from one to the next."""

    def run(batches):
        for block, _, _, _, numbers in _blocks(batches, block_bytes):
            words = [word.encode() for word in numbers]
            del numbers
            owner = np.fromiter((zlib.crc32(word) % shares for word in words), np.int32, len(words))
            order = np.argsort(owner, kind="stable")
            edges = np.searchsorted(owner[order], np.arange(shares + 1))
            rows = {"share": [], "numbers": [], "words": []}
            for share in np.flatnonzero(np.diff(edges)).tolist():
                mine = order[edges[share] : edges[share + 1]]
                sizes = np.fromiter((len(words[i]) for i in mine), np.uint32, len(mine))
                rows["share"].append(share)
                rows["numbers"].append(_bytes_of(np.diff(mine, prepend=0)))
                rows["words"].append(_joined(sizes, b"".join([words[i] for i in mine])))
            yield pa.RecordBatch.from_pydict(
                {
                    "block": pa.array(np.full(len(rows["share"]), block)),
                    "share": pa.array(rows["share"], pa.int32()),
                    "numbers": pa.array(rows["numbers"], pa.binary()),
                    "words": pa.array(rows["words"], pa.binary()),
                }
            )

    return docs.mapInArrow(run, "block long, share int, numbers binary, words binary")


def _joined(sizes: np.ndarray, data: bytes) -> bytes:
    """Pieces one after another behind their sizes, compressed."""
    head = _bytes_of(sizes)
    return len(head).to_bytes(4, "little") + head + zlib.compress(data, 1)


def _unjoined(packed: bytes) -> tuple[np.ndarray, bytes]:
    """Sizes of the pieces and the pieces one after another."""
    end = 4 + int.from_bytes(packed[:4], "little")
    return _numbers_of(packed[4:end]), zlib.decompress(packed[end:])


def _pieces(packed: bytes) -> list[bytes]:
    sizes, data = _unjoined(packed)
    edges = np.cumsum(sizes, dtype=np.int64).tolist()
    return [data[a:b] for a, b in zip([0, *edges], edges, strict=False)]


class _Coded:
    """Ids of the words of a block: their places in one array, by the words' numbers."""

    def __init__(self, numbers: list[bytes], packed: list[bytes], width: str):
        parts = [_unjoined(one) for one in packed]
        none = np.zeros(0, np.int64)
        at = np.concatenate([none, *(np.cumsum(_numbers_of(one), dtype=np.int64) for one in numbers)])
        sizes = np.concatenate([none, *(part for part, _ in parts)]) // np.dtype(width).itemsize
        self.ids = np.frombuffer(b"".join([data for _, data in parts]), width)
        self.starts, self.sizes = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        self.starts[at], self.sizes[at] = np.cumsum(sizes) - sizes, sizes

    def text(self, codes: np.ndarray) -> bytes:
        """Ids of the words with these numbers, one after another."""
        found = []
        for k in range(0, len(codes), GATHERED):
            some = codes[k : k + GATHERED]
            sizes = self.sizes[some]
            ends = np.cumsum(sizes)
            places = np.repeat(self.starts[some] - ends + sizes, sizes) + np.arange(ends[-1])
            found.append(self.ids[places].astype("<u4").tobytes())
        return b"".join(found)


def block_positions(docs: DataFrame, block_bytes: int) -> DataFrame:
    """block, doc_ids, counts, codes: which words stand where in each block."""

    def run(batches):
        for block, doc_ids, counts, codes, _ in _blocks(batches, block_bytes):
            yield pa.RecordBatch.from_pydict(
                {
                    "block": pa.array([block]),
                    "doc_ids": pa.array([doc_ids.to_pylist()], pa.list_(pa.int64())),
                    "counts": pa.array([counts], pa.list_(pa.int32())),
                    "codes": pa.array([_pack(codes)], pa.binary()),
                }
            )

    return docs.mapInArrow(run, "block long, doc_ids array<long>, counts array<int>, codes binary")


def encoded_words(words: DataFrame, vocab: str, pattern: str, width: str) -> DataFrame:
    """block, numbers, ids: the words of a block and share encoded, each word once in all
    (again only when a task has met ``KEPT`` others)."""

    def run(batches):
        encoder = tiktoken.Encoding("words", pat_str=pattern, mergeable_ranks=ranks(vocab), special_tokens={})
        known: dict[bytes, bytes] = {}
        for batch in batches:
            packed = []
            for row in batch.column(2).to_pylist():
                coded = []
                for word in _pieces(row):
                    ids = known.get(word)
                    if ids is None:
                        if len(known) >= KEPT:
                            known.clear()
                        ids = np.array(encoder.encode_ordinary(word.decode()), width).tobytes()
                        known[word] = ids
                    coded.append(ids)
                sizes = np.fromiter(map(len, coded), np.uint32, len(coded))
                packed.append(_joined(sizes, b"".join(coded)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(packed, pa.binary())], ["block", "numbers", "ids"]
            )

    sent = words.repartition("share").select("block", "numbers", "words")
    return sent.mapInArrow(run, "block long, numbers binary, ids binary")


def encode(
    docs: DataFrame,
    vocab: str | None = None,
    pattern: str = public_tokenizers.PATTERN,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian unsigned 32-bit numbers)."""
    vocab = vocab or public_tokenizers.path("byte_bpe_50k.tiktoken")
    width = "<u2" if max(ranks(vocab).values()) < 65536 else "<u4"
    shares = SHARES * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    parts = encoded_words(block_words(docs, block_bytes, shares), vocab, pattern, width)
    places = block_positions(docs, block_bytes)

    def join(found: pa.Table, where: pa.Table) -> pa.Table:
        coded = _Coded(found.column("numbers").to_pylist(), found.column("ids").to_pylist(), width)
        out_ids, out_docs = [], []
        for row in where.to_pylist():
            codes = _unpack(row["codes"], sum(row["counts"]))
            start = 0
            for doc_id, n in zip(row["doc_ids"], row["counts"], strict=True):
                out_docs.append(doc_id)
                out_ids.append(coded.text(codes[start : start + n]))
                start += n
        return pa.table(
            {
                "doc_id": pa.array(out_docs, pa.int64()),
                "n_tokens": pa.array([len(i) // 4 for i in out_ids], pa.int64()),
                "ids": pa.array(out_ids, pa.binary()),
            }
        )

    return (
        parts.groupBy("block")
        .cogroup(places.groupBy("block"))
        .applyInArrow(join, "doc_id long, n_tokens long, ids binary")
    )


def decode(coded: DataFrame, vocab: str | None = None) -> DataFrame:
    """``coded`` with a column ``decoded``, the bytes of its ``ids``. The token table
    (one row per vocabulary entry, so of bounded size) is joined inside the tasks."""
    vocab = vocab or public_tokenizers.path("byte_bpe_50k.tiktoken")
    schema = with_fields(coded, decoded="binary")

    def run(batches):
        table = {rank: token for token, rank in ranks(vocab).items()}
        for batch, data in texts(batches, column="ids"):
            read = [b"".join(map(table.__getitem__, np.frombuffer(ids, "<u4").tolist())) for ids in data]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(read, pa.binary())], [*batch.schema.names, "decoded"]
            )

    return coded.mapInArrow(run, schema)


def op6_word_shuffle_bpe(spark, sf_dir: str) -> DataFrame:
    return decode(encode(documents(spark, sf_dir))).select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


QUERIES = {"op6_word_shuffle_bpe": (op6_word_shuffle_bpe, None)}
