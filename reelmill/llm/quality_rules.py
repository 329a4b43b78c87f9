"""Quality rules as a short-circuit cascade.

A rule reads measures of a text and rejects it or lets it pass. Measures are worked out
when first asked for, so a rule that never runs costs nothing. On a bounded sample every
rule is timed on texts that hold no measure yet, and the sample's texts are counted by
the set of rules that reject them. The cascade then takes, again and again, the rule with
the most rejections per second among the texts that the rules before it let pass, and a
text runs through the rules in this order until one rejects it.

Which rules reject a text doesn't depend on the order, so ``kept`` is the same for every
plan; only ``rejected_by`` names the first rule of the plan in use.

Defined cases: a null text is empty, an empty text has no words and is rejected for that;
rows that repeat an id are judged each by its text; a null id stays null; an empty table
gives no rows, and its sample leaves the rules in the order given. Only the id and text
columns are read, so other columns may have any name. A text is measured whole, in memory
proportional to its words.
"""

import re
import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelmill.llm.common import documents, texts

SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\x0b\x0c\r"

_SPACE, _SYMBOL, _REST = 1, 2, 3  # classes of bytes; 3: a later byte of a code point
_CLASS = np.zeros(256, np.uint8)
_CLASS[0x80:0xC0] = _REST
_CLASS[list(SPACES)] = _SPACE
_CLASS[list(SYMBOLS)] = _SYMBOL

_UPPER = re.compile(rb"[A-Z]")
_LOWER = re.compile(rb"[a-z]")
_WORDLIKE = re.compile(rb"[A-Za-z\x80-\xff]")


class Text:
    """Measures of one text (UTF-8), each worked out once, when asked for."""

    def __init__(self, data: bytes):
        self.data = data

    @cached_property
    def words(self) -> list[bytes]:
        return self.data.split()

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def _classes(self) -> np.ndarray:
        return np.bincount(_CLASS[np.frombuffer(self.data, np.uint8)], minlength=4)

    @cached_property
    def word_chars(self) -> int:
        """Code points in words."""
        return len(self.data) - int(self._classes[_SPACE]) - int(self._classes[_REST])

    @cached_property
    def n_symbols(self) -> int:
        return int(self._classes[_SYMBOL])

    @cached_property
    def lines(self) -> list[bytes]:
        """Lines with a word."""
        return [line for line in self.data.split(b"\n") if line.strip()]

    @cached_property
    def n_dup_lines(self) -> int:
        """Lines with a word that equal an earlier line."""
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_repeat_words(self) -> int:
        """Words in windows of three words that the text holds twice or more."""
        if self.n_words < 4:
            return 0
        numbers: dict[bytes, int] = {}
        ids = np.array([numbers.setdefault(word, len(numbers)) for word in self.words])
        _, pairs = np.unique(ids[:-1] * len(numbers) + ids[1:], return_inverse=True)
        _, window, count = np.unique(pairs[:-1] * len(numbers) + ids[2:], return_inverse=True, return_counts=True)
        again = count[window] > 1
        inside = np.zeros(self.n_words, bool)
        for shift in range(3):
            inside[shift : shift + len(again)] |= again
        return int(inside.sum())

    @cached_property
    def n_lettered(self) -> int:
        """Words with a letter (any code point above 7F counts as one)."""
        return sum(1 for word in self.words if _WORDLIKE.search(word))

    @cached_property
    def n_upper(self) -> int:
        return len(_UPPER.findall(self.data))

    @cached_property
    def n_lower(self) -> int:
        return len(_LOWER.findall(self.data))


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Text], bool]


#: Few words and heavy repetition, as in the contract.
BASE = (
    Rule("few_words", lambda t: t.n_words < 50),
    Rule("repeated_words", lambda t: 100 * t.n_repeat_words > 50 * t.n_words),
)
#: Shares in whole numbers, so that they are exact.
FURTHER = (
    Rule("short_words", lambda t: t.word_chars < 2 * t.n_words),
    Rule("long_words", lambda t: t.word_chars > 12 * t.n_words),
    Rule("symbols", lambda t: 10 * t.n_symbols > t.n_words),
    Rule("repeated_lines", lambda t: 10 * t.n_dup_lines > 3 * len(t.lines)),
    Rule("few_letters", lambda t: 10 * t.n_lettered < 7 * t.n_words),
    Rule("capitals", lambda t: 10 * t.n_upper > 3 * (t.n_upper + t.n_lower)),
)
RULES = BASE + FURTHER

#: At most this many rows, of at most this many bytes of text each, are in the sample.
SAMPLE_ROWS = 2_000
SAMPLE_BYTES = 1 << 20


@dataclass(frozen=True)
class Trial:
    """What the sample says: seconds of each rule, and texts by the rules that reject them
    (a set of bits in the order of the rules)."""

    seconds: tuple[float, ...]
    rejected: dict[int, int]

    def order(self) -> list[int]:
        """Rules by rejections per second among the texts that are left."""
        left, rest, found = dict(self.rejected), list(range(len(self.seconds))), []
        while rest:

            def worth(i):
                hits = sum(n for bits, n in left.items() if bits >> i & 1)
                return hits / max(self.seconds[i], 1e-9), -self.seconds[i]

            best = max(rest, key=worth)
            found.append(best)
            rest.remove(best)
            left = {bits: n for bits, n in left.items() if not bits >> best & 1}
        return found


def sample(docs: DataFrame, rows: int = SAMPLE_ROWS, size: int = SAMPLE_BYTES, seed: int = 11) -> DataFrame:
    """About ``rows`` rows (never over twice as many) from all over the table; texts
    longer than ``size`` bytes are left out of the sample only."""
    many = docs.count()
    short = docs.select("text").filter(F.coalesce(F.octet_length("text"), F.lit(0)) <= size)
    return short.sample(min(1.0, rows / max(many, 1)), seed).limit(2 * rows)


def try_rules(some: DataFrame, rules: Sequence[Rule] = RULES) -> Trial:
    """Time every rule on every text of ``some`` and note which reject it.

    One row per task, set of rules and rule comes back, summed by Spark: at most
    ``len(rules)`` sums of seconds, and no more sets than sampled texts.
    """

    def run(batches):
        for batch in batches:
            seconds, counts = [0.0] * len(rules), {}
            for _, data in texts([batch]):
                for text in data:
                    bits = 0
                    for i, rule in enumerate(rules):
                        started = time.perf_counter()
                        bits |= bool(rule.rejects(Text(text))) << i
                        seconds[i] += time.perf_counter() - started
                    counts[bits] = counts.get(bits, 0) + 1
            keys = [*(-1 - i for i in range(len(rules))), *counts]
            yield pa.RecordBatch.from_pydict(
                {"key": pa.array(keys, pa.int64()), "value": pa.array([*seconds, *counts.values()], pa.float64())}
            )

    sums = some.select("text").mapInArrow(run, "key long, value double").groupBy("key").agg(F.sum("value").alias("value"))
    found = {r.key: r.value for r in sums.collect()}
    return Trial(
        tuple(found.get(-1 - i, 0.0) for i in range(len(rules))),
        {bits: int(n) for bits, n in found.items() if bits >= 0},
    )


def plan(docs: DataFrame, rules: Sequence[Rule] = RULES, rows: int = SAMPLE_ROWS) -> list[Rule]:
    """``rules`` in the order of the cascade; they come as they are if there is no text."""
    trial = try_rules(sample(docs, rows), rules)
    return [rules[i] for i in trial.order()] if trial.rejected else list(rules)


def cascade(docs: DataFrame, rules: Sequence[Rule], measures: Sequence[str] = ()) -> DataFrame:
    """doc_id, kept, rejected_by, n_tried, then ``measures``: one row per row of ``docs``.

    ``rejected_by`` is the first of ``rules`` that rejects the text (null: kept) and
    ``n_tried`` how many ran. Measures asked for are worked out for every text and cost
    the rules that use them nothing further.
    """

    def run(batches):
        for batch, data in texts(batches):
            rejected, tried, measured = [], [], [[] for _ in measures]
            for one in data:
                text = Text(one)
                for column, name in zip(measured, measures, strict=True):
                    column.append(getattr(text, name))
                n, name = 0, None
                for rule in rules:
                    n += 1
                    if rule.rejects(text):
                        name = rule.name
                        break
                rejected.append(name)
                tried.append(n)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([name is None for name in rejected], pa.bool_()),
                    pa.array(rejected, pa.string()),
                    pa.array(tried, pa.int64()),
                    *[pa.array(column, pa.int64()) for column in measured],
                ],
                ["doc_id", "kept", "rejected_by", "n_tried", *measures],
            )

    extra = "".join(f", {name} long" for name in measures)
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, f"doc_id long, kept boolean, rejected_by string, n_tried long{extra}"
    )


def op13_quality_cascade(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    judged = cascade(docs, plan(docs), MEASURES)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return judged.select("doc_id", *MEASURES, failed.alias("base_failed"), "kept")


SQL = r"""
WITH rows AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents),
words AS (
  SELECT row, list_filter(string_split_regex(text, '[ \t\n\x0b\f\r]+'), lambda w: w <> '') AS words FROM rows
),
tokens AS (SELECT row, unnest(words) AS word, unnest(range(len(words))) AS i FROM words),
windows AS (
  SELECT row, i, concat_ws(' ', word, lead(word) OVER o, lead(word, 2) OVER o) AS w, lead(i, 2) OVER o AS last
  FROM tokens WINDOW o AS (PARTITION BY row ORDER BY i)
),
again AS (
  SELECT row, i FROM (SELECT row, i, count(*) OVER (PARTITION BY row, w) AS n FROM windows WHERE last IS NOT NULL)
  WHERE n > 1
),
inside AS (SELECT row, count(DISTINCT i + shift) AS n FROM again, (SELECT unnest([0, 1, 2]) AS shift) GROUP BY row),
lines AS (
  SELECT row, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT row, unnest(string_split(text, chr(10))) AS line FROM rows)
  WHERE regexp_matches(line, '[^ \t\n\x0b\f\r]') GROUP BY row
),
per AS (
  SELECT r.doc_id, len(words) AS n_words,
         coalesce(list_sum(list_transform(words, lambda w: length(w))), 0) AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         coalesce(n_lines, 0) AS n_lines, coalesce(n_dup_lines, 0) AS n_dup_lines,
         coalesce(n, 0) AS n_repeat_words,
         len(list_filter(words, lambda w: regexp_matches(w, '[A-Za-z]|[^\x00-\x7f]'))) AS n_lettered,
         length(regexp_replace(text, '[^A-Z]', '', 'g')) AS n_upper,
         length(regexp_replace(text, '[^a-z]', '', 'g')) AS n_lower
  FROM rows r JOIN words USING (row) LEFT JOIN inside USING (row) LEFT JOIN lines USING (row)
),
judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM per)
SELECT doc_id, n_words, CAST(word_chars AS BIGINT) AS word_chars, n_symbols, n_dup_lines, n_repeat_words,
       base_failed,
       NOT (base_failed OR word_chars < 2 * n_words OR word_chars > 12 * n_words OR 10 * n_symbols > n_words
            OR 10 * n_dup_lines > 3 * n_lines OR 10 * n_lettered < 7 * n_words
            OR 10 * n_upper > 3 * (n_upper + n_lower)) AS kept
FROM judged
"""

QUERIES = {"op13_quality_cascade": (op13_quality_cascade, SQL)}
