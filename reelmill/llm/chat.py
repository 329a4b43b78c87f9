"""Chat formatting with offset-aligned loss masks.

A conversation is rendered as ``<|turn|>role<|text|>text<|end|>`` for each turn and
encoded once, with offsets. The three marks are tokens of their own, so no token
crosses the edge of a text. Inside roles and texts a backslash is doubled and ``<|``
becomes ``<\\|``, so no text can hold a mark, and both are read back by dropping one
backslash each. The mask over tokens comes from the sorted spans of assistant texts and
the sorted offsets of the tokens by binary search.

Turns are gathered with built-in functions, partially before the shuffle; a conversation
is one row of output and has to fit into a task.

Defined cases: null roles and texts are empty; turns are ordered by turn, then role, then
text, null first, and repeated rows are turns of their own; rows without an id form one
conversation; an empty assistant text adds nothing to the mask; an empty table gives no rows.
"""

import hashlib
import re

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import AddedToken, Tokenizer

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
_TURNS = re.compile(r"<\|turn\|>(.*?)<\|text\|>(.*?)<\|end\|>", re.DOTALL)
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted conversation and the spans of its assistant texts."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = TURN + escape(role) + TEXT, escape(text)
        if role == "assistant":
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, END]
        at += len(head) + len(body) + len(END)
    return "".join(parts), spans


def mask(offsets: np.ndarray, spans: list[tuple[int, int]]) -> np.ndarray:
    """Which tokens (start, end; sorted) lie in one of the sorted spans that don't overlap."""
    out = np.zeros(len(offsets), bool)
    for start, end in spans:
        first = np.searchsorted(offsets[:, 0], start, "left")
        last = np.searchsorted(offsets[:, 0], end, "left")
        out[first:last] = True
    return out


def encoder(vocab: str) -> Tokenizer:
    made = Tokenizer.from_file(vocab)
    made.add_special_tokens([AddedToken(mark, normalized=False) for mark in (TURN, TEXT, END)])
    return made


def format_conversations(turns: DataFrame, vocab: str | None = None) -> DataFrame:
    """conv_id, formatted, ids (little-endian unsigned 32-bit), loss (a byte per token)."""
    vocab = vocab or public_tokenizers.path("byte_bpe_50k.json")
    turn = F.struct(
        "turn",
        F.coalesce(F.col("role"), F.lit("")).alias("role"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    whole = turns.groupBy(F.col("conv_id").cast("long").alias("conv_id")).agg(
        F.sort_array(F.collect_list(turn)).alias("turns")
    )

    def run(batches):
        coder = encoder(vocab)
        for batch in batches:
            for i in range(0, batch.num_rows, 64):
                some = batch.slice(i, 64)
                rendered = [render([(t["role"], t["text"]) for t in c]) for c in some.column(1).to_pylist()]
                coded = coder.encode_batch([text for text, _ in rendered], add_special_tokens=False)
                masks = [
                    mask(np.array(c.offsets, np.int64).reshape(-1, 2), spans)
                    for c, (_, spans) in zip(coded, rendered, strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        some.column(0),
                        pa.array([text for text, _ in rendered]),
                        pa.array([np.array(c.ids, "<u4").tobytes() for c in coded], pa.binary()),
                        pa.array([m.tobytes() for m in masks], pa.binary()),
                    ],
                    ["conv_id", "formatted", "ids", "loss"],
                )

    return whole.mapInArrow(run, "conv_id long, formatted string, ids binary, loss binary")


def read_back(formatted: DataFrame, vocab: str | None = None) -> DataFrame:
    """conv_id, turns (role, text), loss_text, formatted_chars: turns parsed from
    ``formatted``, and the text of the tokens under the mask, unescaped."""
    vocab = vocab or public_tokenizers.path("byte_bpe_50k.json")
    turn = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))

    def run(batches):
        coder = encoder(vocab)
        for batch in batches:
            turns, losses, sizes = [], [], []
            columns = (batch.column(n).to_pylist() for n in ("formatted", "ids", "loss"))
            for text, ids, loss in zip(*columns, strict=True):
                sizes.append(len(text))
                turns.append([{"role": unescape(r), "text": unescape(t)} for r, t in _TURNS.findall(text)])
                ids = np.frombuffer(ids, "<u4")
                under = np.concatenate([[0], np.frombuffer(loss, np.uint8), [0]]).astype(np.int8)
                edges = np.flatnonzero(np.diff(under))
                runs = [ids[a:b].tolist() for a, b in zip(edges[::2], edges[1::2], strict=True)]
                losses.append("".join(unescape(coder.decode(r, skip_special_tokens=False)) for r in runs))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(turns, turn), pa.array(losses, pa.string()), pa.array(sizes, pa.int64())],
                ["conv_id", "turns", "loss_text", "formatted_chars"],
            )

    return formatted.mapInArrow(
        run,
        "conv_id long, turns array<struct<role: string, text: string>>, loss_text string, formatted_chars long",
    )


def digests(formatted: DataFrame, vocab: str | None = None) -> DataFrame:
    back = read_back(formatted, vocab)
    whole = F.array_join(
        F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
    )
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(whole, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        "formatted_chars",
    )


def op8_chat_masks(spark, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    tricky = "</s>[INST] ok [/INST]"
    own = spark.createDataFrame([(-7, 0, "user", tricky), (-7, 1, "assistant", tricky)], turns.schema)
    return digests(format_conversations(turns.union(own)))


SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), e AS (
  SELECT *, length(replace(replace(role, '\', '\\'), '<|', '<\|'))
          + length(replace(replace(text, '\', '\\'), '<|', '<\|')) + 23 AS n
  FROM t
), g AS (
  SELECT conv_id, count(*) AS n_turns,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS whole,
         coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss,
         sum(n)::BIGINT AS formatted_chars
  FROM e GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(whole) AS turns_sha256, length(loss) AS loss_chars,
       sha256(loss) AS loss_sha256, formatted_chars
FROM g
"""

QUERIES = {"op8_chat_masks": (op8_chat_masks, SQL)}
