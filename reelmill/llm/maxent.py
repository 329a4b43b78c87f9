"""Language-model scoring: a hashed maximum-entropy model with class-factored softmax.

``P(word | history) = P(class | history) * P(word | class)``. Words belong to 31
classes by a hash of their endings, the end of a text is a class of its own. The class
follows a maximum-entropy model over hashed features of the history: the previous
word (n-gram), it together with the class before it (n-gram of two), and that class
alone, skipping the previous word (skip feature). Within a class, words have their
add-one share, with one place for unknown words, so the probabilities of all words
and one unknown per class add up to one.

1. One pass counts, per task and then by shuffle, all training words and all
   (history, class) pairs. Histories are hashed to at most 67,617, so their table is
   bounded whatever the corpus; word counts grow with it.
2. The weights are trained by distributed gradients: every step, at most ``tasks`` tasks
   compute the gradient of their histories, each of bounded size, and as many add them up
   slice by slice, so the driver gets one gradient a step.
3. Scoring is table look-ups in numpy. The counts of up to ``head`` of the most frequent
   words (a bounded table) go to every task; all other words are joined to the whole count
   table, without a hot key, as hardly a word beyond the head has more than 1/``head`` of
   all occurrences. The driver finds the head's least count in a table of rounded counts,
   so it gets no words but those of the head, however many tasks there are.

Row numbers tie both scoring passes together: ``docs`` must read the same rows in the
same order again (a table or a staged result).

Defined cases: a null or empty text is its end alone; without training rows all counts
are 0 and scores are those of the uniform model; rows without an id learn; repeated rows
count and are scored each; an empty table gives no rows.
"""

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelmill.llm.common import documents, held_out, staged, texts, words_of

BUCKETS = 2048
CLASSES = 32  # the last one is the end's
PAIRS = 16384
START_BUCKET, START_CLASS = BUCKETS, CLASSES
HISTORIES = (BUCKETS + 1) * (CLASSES + 1)
FEATURES = (BUCKETS + 1) + PAIRS + (CLASSES + 1)
SLICES = 64  # of a gradient, when those of all tasks are added up
WORD, HISTORY = 0, 1


@dataclass(frozen=True)
class Training:
    steps: int = 20
    rate: float = 0.5
    prior: float = 2.0  # of the weights: a quadratic penalty, in occurrences
    tasks: int = 8
    head: int = 65_536


class WordCodes(dict):
    """bucket | class << 11 of words, kept for the words met last."""

    KEPT = 400_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.KEPT:
            self.clear()
        value = self[word] = code(word)
        return value


class HeadCodes(dict):
    """Places of the head's words; of other words, kept for those met last, ``size`` + code."""

    def __init__(self, size: int, head: dict[bytes, int]):
        super().__init__(head)
        self.size, self.head = size, head

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.size + WordCodes.KEPT:
            self.clear()
            self.update(self.head)
        value = self[word] = self.size + code(word)
        return value


def code(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word) % BUCKETS | (xxhash.xxh3_64_intdigest(word[-2:]) % (CLASSES - 1)) << 11


def histories(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """History and class of every token of a text, its end included."""
    n = len(codes)
    classes = np.append(codes >> 11, CLASSES - 1)
    before = np.full(n + 1, START_BUCKET)
    before[1:] = codes & (BUCKETS - 1)
    skipped = np.full(n + 1, START_CLASS)
    skipped[2:] = classes[: n - 1] if n > 1 else []
    return before * (CLASSES + 1) + skipped, classes


def features(history: np.ndarray) -> np.ndarray:
    """The three features of each history, as rows of the weight table."""
    before, skipped = np.divmod(history, CLASSES + 1)
    pair = (history.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(50)).astype(np.int64)
    return np.stack([before, BUCKETS + 1 + pair % PAIRS, BUCKETS + 1 + PAIRS + skipped])


def log_softmax(logits: np.ndarray) -> np.ndarray:
    logits = logits - logits.max(axis=1, keepdims=True)
    return logits - np.log(np.exp(logits).sum(axis=1, keepdims=True))


def corpus_counts(docs: DataFrame) -> DataFrame:
    """kind, key, n: how often each word (the end: empty key) and each pair of
    history and class stands in the texts."""

    def run(batches):
        table = WordCodes()
        for _, data in texts(batches):
            words, seen = Counter(), []
            for text in data:
                found = words_of(text)
                words.update(found)
                history, classes = histories(np.fromiter(map(table.__getitem__, found), np.int64, len(found)))
                seen.append(history * CLASSES + classes)
            words[b""] = len(data)
            cells, times = np.unique(np.concatenate(seen), return_counts=True)
            keys = [*words, *(int(c).to_bytes(4, "big") for c in cells)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([WORD] * len(words) + [HISTORY] * len(cells), pa.int8()),
                    pa.array(keys, pa.binary()),
                    pa.array([*words.values(), *times.tolist()], pa.int64()),
                ],
                ["kind", "key", "n"],
            )

    found = docs.select("text").mapInArrow(run, "kind byte, key binary, n long")
    return found.groupBy("kind", "key").agg(F.sum("n").alias("n"))


def class_sizes(words: DataFrame) -> tuple[np.ndarray, int, int, int]:
    """Occurrences plus distinct words plus one of each class; all occurrences, distinct
    words and ends. One row per class comes to the driver."""

    def run(batches):
        total = np.zeros((CLASSES, 2), np.int64)
        for batch in batches:
            keys = batch.column(0).to_pylist()
            codes = np.array([code(k) >> 11 if k else CLASSES - 1 for k in keys], int)
            n = np.array(batch.column(1).to_pylist(), np.int64)
            np.add.at(total, codes, np.stack([n, np.ones_like(n)], axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(CLASSES)), pa.array(total[:, 0]), pa.array(total[:, 1])], ["class", "n", "v"]
        )

    rows = words.select("key", "n").mapInArrow(run, "class long, n long, v long").groupBy("class")
    found = {r["class"]: r for r in rows.agg(F.sum("n").alias("n"), F.sum("v").alias("v")).collect()}
    sizes = np.array([(found[c].n + found[c].v + 1) if c in found else 1 for c in range(CLASSES)], float)
    sizes[-1] = 1.0  # the end is alone in its class
    n, v = sum(r.n for r in found.values()), sum(r.v for r in found.values())
    return sizes, n, v, found[CLASSES - 1].n if found else 0


def gradient(cells: DataFrame, weights: Broadcast, tasks: int) -> DataFrame:
    """slice, grad: the slope of the log-likelihood of ``cells`` (key, n) in every weight, one
    row for each slice of the weight table, as float64 bytes; no rows without cells.

    Every task makes one gradient of its cells, then at most ``tasks`` tasks add up the slices.
    """

    def slope(batches):
        keys, times = [], []
        for batch in batches:
            key = batch.column(0).cast(pa.binary(4))
            keys.append(np.frombuffer(key.buffers()[1], ">u4", len(key), key.offset * 4).astype(np.int64))
            times.append(batch.column(1).to_numpy().astype(float))
        if not keys:
            return
        history, classes = np.divmod(np.concatenate(keys), CLASSES)
        times = np.concatenate(times)
        own, at = np.unique(history, return_inverse=True)
        seen = np.zeros((len(own), CLASSES))
        np.add.at(seen, (at, classes), times)
        rows = features(own)
        expected = np.exp(log_softmax(weights.value[rows].sum(axis=0).astype(float)))
        miss = seen - seen.sum(axis=1, keepdims=True) * expected
        grad = np.zeros(weights.value.shape)
        for row in rows:
            np.add.at(grad, row, miss)
        yield sliced(enumerate(np.array_split(grad.astype("<f4"), SLICES)))

    def add(batches):
        total = {}
        for batch in batches:
            for at, part in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                total[at] = total.get(at, 0.0) + np.frombuffer(part.as_buffer(), "<f4").astype("<f8")
        yield sliced(total.items())

    def sliced(parts):
        at, parts = zip(*parts, strict=True) if parts else ((), ())
        return pa.RecordBatch.from_arrays(
            [pa.array(at, pa.int32()), pa.array([p.tobytes() for p in parts], pa.binary())], ["slice", "grad"]
        )

    kinds = "slice int, grad binary"
    parts = cells.select("key", "n").mapInArrow(slope, kinds).repartition(tasks, "slice")
    return parts.coalesce(tasks).mapInArrow(add, kinds)


def train(cells: DataFrame, how: Training) -> np.ndarray:
    """Log-probability of each class after each history (natural logarithm)."""
    # gradients of cells add up, so cells may lie anywhere; never more than ``tasks`` parts
    spread = staged(cells.repartition(how.tasks), "histories").coalesce(how.tasks)
    weights = np.zeros((FEATURES, CLASSES), np.float32)
    power = np.full_like(weights, 1e-6)
    for _ in range(how.steps):
        sent = cells.sparkSession.sparkContext.broadcast(weights)
        found = gradient(spread, sent, how.tasks).toArrow().sort_by("slice")["grad"]
        sent.destroy()  # else those of all steps stay until the driver collects its garbage
        if not len(found):
            break
        grad = np.concatenate([np.frombuffer(part.as_buffer(), "<f8") for part in found])
        grad = grad.reshape(weights.shape) - how.prior * weights
        grad /= max(1.0, np.abs(grad).max())
        power += grad**2
        weights = (weights + how.rate * grad / np.sqrt(power)).astype(np.float32)
    every = features(np.arange(HISTORIES))
    return log_softmax(weights[every].sum(axis=0)).astype(np.float32)


def head_words(words: DataFrame, most: int) -> DataFrame:
    """The most frequent of ``words`` (key, n), at most ``most``: all from some count up.

    Counts are compared by their first 11 binary digits, so that there are some thousand
    different ones at most; words of equal ones are all in or all out.
    """
    rounded = F.expr("n - n % shiftleft(1L, greatest(length(bin(n)) - 11, 0))")
    sizes = words.groupBy(rounded.alias("least")).agg(F.count("*").alias("words")).collect()
    least, held = None, 0
    for row in sorted(sizes, key=lambda r: -r.least):
        held += row.words
        if held > most:
            break
        least = row.least
    return words.filter(F.lit(False) if least is None else F.col("n") >= least)


def lm_scores(docs: DataFrame, learn: DataFrame, how: Training = Training()) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score of each row of ``docs``,
    by counts and weights from the rows of ``learn``."""
    spark = docs.sparkSession
    counts = staged(corpus_counts(learn), "counts")
    words = counts.filter(F.col("kind") == WORD).select("key", "n")
    sizes, n_all, n_words, n_ends = class_sizes(words)
    table = spark.sparkContext.broadcast(train(counts.filter(F.col("kind") == HISTORY), how))
    # the head is bounded in rows and in bytes of a row
    short = words.filter(F.length("key").between(1, 64))
    frequent = head_words(short, how.head).toArrow()
    head = spark.sparkContext.broadcast(
        dict(zip(frequent["key"].to_pylist(), frequent["n"].to_pylist(), strict=True))
    )
    within = -np.log(sizes)
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"), "text")

    def tail(batches):
        frequent = head.value
        for batch, data in texts(batches):
            out = ([], [], [])
            for row, text in zip(batch.column(0).to_pylist(), data, strict=True):
                rare = Counter([w for w in words_of(text) if w not in frequent])
                out[0].extend([row] * len(rare)), out[1].extend(rare), out[2].extend(rare.values())
            kinds = (pa.int64(), pa.binary(), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(o, k) for o, k in zip(out, kinds, strict=True)], ["row", "key", "times"]
            )

    def whole(batches):
        # a head word's place in the head, or its code behind all of these
        frequent, log_class = head.value, table.value
        size = len(frequent)
        places = HeadCodes(size, {w: i for i, w in enumerate(frequent)})
        codes = np.append([code(w) for w in frequent], np.arange(BUCKETS * CLASSES)).astype(np.int64)
        logs = np.append(np.log10(np.array([*frequent.values()], float) + 1), np.zeros(BUCKETS * CLASSES))
        for batch, data in texts(batches):
            out = ([], [], [], [])
            for text in data:
                found = words_of(text)
                at = np.fromiter(map(places.__getitem__, found), np.int64, len(found))
                history, classes = histories(codes[at])
                model = log_class[history, classes].sum(dtype=float) + within[classes].sum()
                out[0].append(len(found) + 1)
                out[1].append(int((at < size).sum()))
                out[2].append(float(logs[at].sum()))
                out[3].append(model / np.log(10))
            kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], *(pa.array(o, k) for o, k in zip(out, kinds, strict=True))],
                ["row", "doc_id", "n_tokens", "head_known", "head_log", "model"],
            )

    rare = (
        rows.select("row", "text")
        .mapInArrow(tail, "row long, key binary, times int")
        .join(words, "key")
        .groupBy("row")
        .agg(F.sum("times").alias("tail_known"), F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("tail_log"))
    )
    scored = rows.mapInArrow(
        whole, "row long, doc_id long, n_tokens long, head_known long, head_log double, model double"
    ).join(rare, "row", "left")
    logs = F.col("head_log") + F.coalesce("tail_log", F.lit(0.0))
    all_log = float(np.log10(n_all + n_words + 1))
    return scored.select(
        "doc_id",
        "n_tokens",
        (F.col("head_known") + F.coalesce("tail_known", F.lit(0)) + F.lit(int(n_ends > 0))).alias("n_known"),
        F.lit(n_all).cast("long").alias("train_tokens"),
        (logs + F.lit(float(np.log10(n_ends + 1))) - F.col("n_tokens") * F.lit(all_log)).alias("base_score"),
        (logs + F.col("model")).alias("score"),
    )


def op10_hashed_maxent(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    out = held_out("doc_id", 7, 2)
    return lm_scores(docs, docs.filter(~out)).withColumn("held_out", out)


QUERIES = {"op10_hashed_maxent": (op10_hashed_maxent, None)}
