"""Toxicity by multiple-instance learning: sentences judged, documents labelled.

A document is toxic if one of its sentences is. A sentence's probability is
logistic in its distinct words and their beginnings; the document's is the noisy-or over its sentences,
``1 - prod(1 - p)``, and only documents carry labels. Labels may be wrong, so a
share ``noise`` of positives is taken to be none. Since the gradient reaches the
sentences, the fitted model also says which of them offend.

The model is fitted on a bounded sample, ``Fit.per_class`` labelled documents of each
class (those whose hashed ids come first), in one task, and weighted back to the
share of each class among all labelled documents. Scoring is one pass over the table
without a shuffle; the model (``max_features`` at most) goes to every task.

Defined cases: a null or empty text has no sentence and score 0; if labels of either
class are missing, every score is 0; null labels and labels of unknown documents
don't count; of several labels of one id the highest counts; rows that repeat an id
are scored each by its own text; an empty table gives no rows. Only id and text are
read, so that labels, language and source can't enter a score.
"""

import json
import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelmill.llm.common import documents, held_out, learn_row, staged, texts

_SENTENCE = re.compile(r"[^.!?\n]+")
_WORD = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class Fit:
    per_class: int = 2000
    max_features: int = 50_000
    least_documents: int = 3
    noise: float = 0.02
    decay: float = 2e-5
    steps: int = 120
    rate: float = 0.15


def _bags(text: str) -> list[tuple[int, int, list[str]]]:
    """start, end and words of each sentence that has any."""
    bags = []
    for m in _SENTENCE.finditer(text):
        if found := _WORD.findall(m[0].lower()):
            bags.append((m.start(), m.end(), found))
    return bags


def _parts(word: str) -> tuple[str, ...]:
    """Features of a word: itself and its beginnings, which inflected forms share."""
    return (word, f"{word[:4]}*", f"{word[:6]}*") if len(word) > 6 else (word, f"{word[:4]}*")


def _train(bags: list[list[set[str]]], toxic: np.ndarray, weight: np.ndarray, fit: Fit) -> dict:
    """Bias and word weights that minimise the weighted noisy-or loss (Adam, full batch)."""
    common = Counter(p for bag in bags for p in {p for w in set().union(*bag) for p in _parts(w)})
    ranked = sorted((w for w, n in common.items() if n >= fit.least_documents), key=lambda w: (-common[w], w))
    number = {w: i for i, w in enumerate(ranked[: fit.max_features])}
    of_word, of_sentence, of_bag = [], [], []
    for d, bag in enumerate(bags):
        for sentence in bag:
            known = sorted(number[p] for w in sentence for p in _parts(w) if p in number)
            of_word.extend(known)
            of_sentence.extend([len(of_bag)] * len(known))
            of_bag.append(d)
    of_word, of_sentence, of_bag = (np.array(x, np.int64) for x in (of_word, of_sentence, of_bag))
    n_words, n_sentences, n_bags = len(number), len(of_bag), len(bags)
    theta = np.zeros(n_words + 1)
    theta[-1] = -5.0
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    weight = weight / weight.sum()
    for step in range(1, fit.steps + 1):
        z = theta[-1] + np.bincount(of_sentence, theta[of_word], n_sentences)
        safe = np.bincount(of_bag, np.logaddexp(0, z), n_bags)  # -log(1 - noisy-or)
        left = np.exp(-safe)
        pull = np.where(toxic == 1, -(1 - fit.noise) * left / (fit.noise + (1 - fit.noise) * (1 - left)), 1.0)
        dz = (weight * pull)[of_bag] / (1 + np.exp(-z))
        grad = np.append(np.bincount(of_word, dz[of_sentence], n_words) + fit.decay * theta[:-1], dz.sum())
        first += 0.1 * (grad - first)
        second += 0.01 * (grad**2 - second)
        theta -= fit.rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return {
        "bias": float(theta[-1]),
        "words": {w: round(float(theta[i]), 5) for w, i in number.items() if abs(theta[i]) > 1e-3},
    }


def fit_model(docs: DataFrame, labels: DataFrame, fit: Fit = Fit()) -> dict | None:
    """Bias and word weights learnt from ``labels`` (doc_id, toxic); None without both classes."""
    each = (
        labels.select(F.col("doc_id").cast("long"), F.col("toxic").cast("int"))
        .filter("toxic IN (0, 1) AND doc_id IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    sizes = {r.toxic: r["count"] for r in each.groupBy("toxic").count().collect()}
    if len(sizes) < 2:
        return None
    parts = [
        each.filter(F.col("toxic") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit.per_class)
        for c in (0, 1)
    ]
    sample = staged(parts[0].union(parts[1]), "sample")
    examples = docs.select(F.col("doc_id").cast("long"), "text").join(sample, "doc_id")
    weights = {c: n / min(n, fit.per_class) for c, n in sizes.items()}

    def train(batches):
        rows = []
        for batch, data in texts(batches):
            ids, marks = (batch.column(n).to_pylist() for n in ("doc_id", "toxic"))
            for doc_id, toxic, text in zip(ids, marks, data, strict=True):
                sets = [set(words) for _, _, words in _bags(text.decode("utf-8", "replace"))]
                if sets:
                    rows.append((doc_id, toxic, sets))
        rows.sort(key=lambda r: (r[0], r[1], len(r[2])))
        toxic = np.array([r[1] for r in rows], int)
        if len(set(toxic.tolist())) == 2:
            model = _train([r[2] for r in rows], toxic, np.array([weights[t] for t in toxic]), fit)
            yield pa.RecordBatch.from_pydict({"model": pa.array([json.dumps(model)])})

    fitted = examples.repartition(1).mapInArrow(train, "model string").collect()
    return json.loads(fitted[0].model) if fitted else None


def _scorer(model: dict | None, at_least: float = 0.5):
    """Function from a text to its score and its offending sentences."""
    bias, weights = (model["bias"], model["words"]) if model else (0.0, {})

    class Pulls(dict):
        """Weights of words, kept for the words met last."""

        def __missing__(self, word: str) -> float:
            if len(self) >= 400_000:
                self.clear()
            value = self[word] = sum(weights.get(p, 0.0) for p in _parts(word))
            return value

    pulls = Pulls()

    def judge_text(text: bytes) -> tuple[float, list[dict]]:
        safe, found = 0.0, []
        for start, end, words in _bags(text.decode("utf-8", "replace")) if model else ():
            z = bias + sum(map(pulls.__getitem__, set(words)))
            if z > -20:
                high = max(z, 0.0) + math.log1p(math.exp(-abs(z)))  # -log(1 - p)
                safe += high
                if (own := -math.expm1(-high)) >= at_least:
                    found.append({"start": start, "end": end, "score": own})
        return min(1.0, max(0.0, -math.expm1(-safe))), found

    return judge_text


def score(docs: DataFrame, model: dict | None, at_least: float = 0.5) -> DataFrame:
    """doc_id, score, predicted, offending (start, end, score of the sentences in code
    points whose own probability is ``at_least`` so high): one row per row of ``docs``."""

    def run(batches):
        judge_text = _scorer(model, at_least)
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
        for batch, data in texts(batches):
            judged = [judge_text(text) for text in data]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([s for s, _ in judged], pa.float64()),
                    pa.array([int(s >= 0.5) for s, _ in judged], pa.int32()),
                    pa.array([spans for _, spans in judged], kind),
                ],
                ["doc_id", "score", "predicted", "offending"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run,
        "doc_id long, score double, predicted int, offending array<struct<start: int, end: int, score: double>>",
    )


def without_toxic(docs: DataFrame, model: dict | None) -> DataFrame:
    """The rows of ``docs``, all columns, whose text is not predicted toxic; no shuffle."""

    def run(batches):
        doc_score = _scorer(model)
        for batch, data in texts(batches):
            clean = [doc_score(text)[0] < 0.5 for text in data]
            yield batch.filter(pa.array(clean, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def judge(docs: DataFrame, labels: DataFrame, fit: Fit = Fit(), folds: int = 5, out: int = 0) -> DataFrame:
    """Scores of all documents by a model that never saw a label of fold ``out``."""
    model = fit_model(docs, labels.filter(learn_row("doc_id", folds, out)), fit)
    return score(docs, model).withColumn("held_out", held_out("doc_id", folds, out))


def op3_noisy_or_toxicity(spark, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    return judge(documents(spark, sf_dir), labels)


QUERIES = {"op3_noisy_or_toxicity": (op3_noisy_or_toxicity, None)}
