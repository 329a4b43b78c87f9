"""Packing documents into sequences: first-fit decreasing in random groups.

Texts are tokenised and cut into pieces of at most ``limit`` tokens in one pass;
only the pieces' narrow rows are dealt to random groups of bounded size, where a
tournament tree over the free room of the bins finds the first bin with room in
logarithmic time. Groups are independent, so a lost task repeats its own groups
only and gives the same sequences again.

A word (text between ASCII white space, which no token crosses) is encoded once and
kept while the worker's bounded table has room. Plain Latin words are merged by
``tiktoken`` from the same vocabulary file, several times as fast; all others by
``tokenizers``. ``tests/llm`` compares both on whole texts.

Defined cases: a null or empty text is the end token alone; a repeated row is packed
each time; rows without an id are packed like others; an empty table gives no rows.
"""

import json
import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from reelmill.llm.common import documents, free_name, texts, with_fields

LIMIT = 2048
END_ID = 1
#: Documents in a random group, on average.
GROUP_DOCS = 4096

#: Ends a pre-token; two letters that no plain word has.
_MARK = "\uf8ff"
_PLAIN = re.compile("[!-~\u00c0-\u012f\u0131-\u024f]+")
#: The vocabulary's own pre-tokens of lower-case text (a fixed value).
_PRETOKEN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")


def _bytes_of_letters() -> dict[str, int]:
    """The printable letters that byte-level vocabularies write for the bytes."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class WordIds(dict):
    """Ids of words as little-endian unsigned 32-bit numbers, by vocabulary file.

    Holds ``kept`` words at most before it starts anew, which changes nothing but time.
    """

    def __init__(self, path: str, kept: int = 500_000):
        super().__init__()
        self.kept = kept
        self.slow = Tokenizer.from_file(path)
        self.slow.encode_special_tokens = True
        with open(path, encoding="utf-8") as file:
            vocab = json.load(file)["model"]["vocab"]
        letters, mark = _bytes_of_letters(), _MARK.encode()
        table = {mark[:2]: 0, mark: 1}  # the mark is put together before anything else
        self.ends = np.zeros(len(vocab) + 2, bool)
        for token, i in vocab.items():
            if token.startswith("<|"):
                continue
            last = token.endswith("</w>")
            table[bytes(letters[c] for c in token.removesuffix("</w>")) + (mark if last else b"")] = i + 2
            self.ends[i + 2] = last
        self.fast = tiktoken.Encoding(
            "words", pat_str=f"[^{_MARK}]*{_MARK}", mergeable_ranks=table, special_tokens={}
        )

    def learn(self, words: set[bytes]) -> None:
        if len(self) + len(words) > self.kept:
            self.clear()
        plain, counts, pieces = [], [], []
        others = []
        for word in words:
            if word in self:
                continue
            text = word.decode("utf-8", "replace")
            if _PLAIN.fullmatch(text):
                found = _PRETOKEN.findall(text.lower())
                plain.append(word), counts.append(len(found)), pieces.extend(found)
            else:
                others.append((word, text))
        if plain:
            ids = np.array(self.fast.encode_ordinary(_MARK.join(pieces) + _MARK))
            last = np.flatnonzero(self.ends[ids])[np.cumsum(counts) - 1] + 1
            packed, start = (ids - 2).astype("<u4").tobytes(), 0
            for word, end in zip(plain, (4 * last).tolist(), strict=True):
                self[word] = packed[start:end]
                start = end
        coded = self.slow.encode_batch_fast([t for _, t in others], add_special_tokens=False)
        for (word, _), one in zip(others, coded, strict=True):
            self[word] = np.array(one.ids, "<u4").tobytes()


def pieces(docs: DataFrame, vocab: str | None = None, limit: int = LIMIT) -> DataFrame:
    """doc_id, start, length, doc_tokens, ids: every text, its end token added, cut."""
    vocab = vocab or public_tokenizers.path("word_bpe_49k.json")
    end = np.array([END_ID], "<u4").tobytes()

    def run(batches) -> Iterator[pa.RecordBatch]:
        table = WordIds(vocab)
        for batch, data in texts(batches, 1 << 20):
            words = [text.split() for text in data]
            table.learn(set().union(*words))
            rows = [[], [], [], [], []]
            for doc_id, found in zip(batch.column(0).to_pylist(), words, strict=True):
                ids = b"".join(map(table.__getitem__, found)) + end
                for at in range(0, len(ids), 4 * limit):
                    piece = ids[at : at + 4 * limit]
                    values = (doc_id, at // 4, len(piece) // 4, len(ids) // 4, piece)
                    for column, value in zip(rows, values, strict=True):
                        column.append(value)
            kinds = [pa.int64()] * 4 + [pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(r, k) for r, k in zip(rows, kinds, strict=True)],
                ["doc_id", "start", "length", "doc_tokens", "ids"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, start long, length long, doc_tokens long, ids binary"
    )


def first_fit(lengths: list[int], limit: int) -> tuple[list[int], list[int]]:
    """Bin and offset of each piece, pieces taken in the order given.

    The tree's leaves are the bins' free room, every other node holds the larger of
    its two; the walk from the root goes left wherever there is room.
    """
    leaves = 1 << max(0, (len(lengths) - 1).bit_length())
    room = [limit] * (2 * leaves)
    bins, offsets = [], []
    for length in lengths:
        node = 1
        while node < leaves:
            node *= 2
            if room[node] < length:
                node += 1
        bins.append(node - leaves)
        offsets.append(limit - room[node])
        room[node] -= length
        while node > 1:
            node //= 2
            most = max(room[2 * node], room[2 * node + 1])
            if room[node] == most:
                break
            room[node] = most
    return bins, offsets


def pack(cut: DataFrame, groups: int, limit: int = LIMIT) -> DataFrame:
    """``cut`` with sequence_id and offset; its other columns go along unchanged."""
    schema = with_fields(cut, sequence_id="long", offset="long")
    names = schema.names

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "doc_id", "start"], ascending=[False, True, True], kind="stable")
        bins, offsets = first_fit(rows["length"].tolist(), limit)
        return rows.assign(
            sequence_id=(int(key[0]) << 32) + np.array(bins, np.int64), offset=np.array(offsets, np.int64)
        )[names]

    # by a number of the row, so that equal rows and rows without an id are spread too
    name = free_name(cut, "packing_group")
    group = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups))
    return cut.withColumn(name, group).groupBy(name).applyInPandas(run, schema)


def op7_first_fit_packing(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    groups = max(1, math.ceil(docs.count() / GROUP_DOCS))
    cut = pieces(docs).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return pack(cut, groups)


QUERIES = {"op7_first_fit_packing": (op7_first_fit_packing, None)}
