"""Collocations against brute force, the bound of the bit table and odd rows."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from reelmill.llm import collocations as c


def brute(rows, how):
    """(lang, phrase) -> (a, l, r, n, score)."""
    found = {}
    per = {}
    for lang, text in rows:
        text = "".join(ch.lower() if "A" <= ch <= "Z" else ch for ch in text or "")
        for piece in re.split(r"[.,;:!?\n-\r]", text):
            per.setdefault(lang or "und" if lang is None else lang, []).append([w for w in re.split(r"[ \t]", piece) if w])
    for lang, pieces in per.items():
        f = Counter(
            tuple(p[i : i + k]) for p in pieces for k in range(1, how.longest + 1) for i in range(len(p) - k + 1)
        )
        n = sum(map(len, pieces))
        often = {g: a for g, a in f.items() if len(g) > 1 and a >= how.least}
        for g, a in often.items():
            if any(
                len(o) > len(g) and 100 * b >= how.inside * a and g in [o[i : i + len(g)] for i in range(len(o))]
                for o, b in often.items()
            ):
                continue
            score, _, left, right = min((1000 * a * n // (f[g[:k]] * f[g[k:]]), k, f[g[:k]], f[g[k:]]) for k in range(1, len(g)))
            found[lang, " ".join(g)] = (a, left, right, n, score)
    return found


def mined(docs, how):
    return {(r.lang, r.phrase): (r.a, r.l, r.r, r.n, r.score) for r in c.collocations(docs, how).collect()}


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(6)
    words = [f"w{i}" for i in range(30)] + ["É", "ÀB", "Ab"]
    made = []
    for i in range(150):
        text = " ".join(rng.choices(words, [40 / (k + 1) for k in range(len(words))], k=rng.randint(0, 60)))
        if i % 3 == 0:
            text += rng.choice([" ", ". ", "\t"]) + "New York\tcity hall now again"
        made.append((rng.choice(["en", "de", None, ""]), text + rng.choice(["", ".", "\r\n x\x0bw1 w2"])))
    return [*made, (None, None), ("en", ""), *[("xx", "one two three. One Two! one\ttwo")] * 3]


@pytest.mark.parametrize(
    "how",
    [
        c.Mining(least=3),
        c.Mining(least=2, longest=3, inside=60),
        c.Mining(least=3, table_bytes=8),  # nearly every hash is in so small a table
        c.Mining(least=1, batch_bytes=1),
        c.Mining(least=4, longest=2),
    ],
    ids=["usual", "inside", "full table", "one text a batch", "pairs"],
)
def test_against_brute_force(spark, rows, how):
    docs = spark.createDataFrame([(None, *r, "a", "b") for r in rows], "doc_id long, lang string, text string, w1 string, n string")
    assert mined(docs, how) == brute(rows, how)


def test_empty_tables(spark, none):
    assert c.collocations(none.withColumn("lang", F.lit("en"))).collect() == []
    assert c.collocations(spark.createDataFrame([("en", None)] * 3, "lang string, text string")).collect() == []


def test_long_texts_and_ties(spark):
    text = " ".join(["a b c d"] * 40_000)
    docs = spark.createDataFrame([("en", text), ("en", "z y. y z. " * 100)], "lang string, text string")
    found = c.best(c.collocations(docs), 3).orderBy("rank").collect()
    assert [r.rank for r in found] == [1, 2, 3] and found[0].score >= found[1].score >= found[2].score
    assert {r.phrase: r.a for r in c.collocations(docs).collect()}["y z"] == 100
    tied = [r.phrase for r in c.best(c.collocations(docs), 9).collect() if r.a == 100]
    assert tied == ["y z", "z y"]


def test_numbers_beyond_64_bits(spark):
    big = 4 * 10**12
    counts = spark.createDataFrame(
        [("en", 0, "", 10 * big), ("en", 1, "a", big), ("en", 1, "b", big), ("en", 2, "a b", big - 1)],
        "lang string, size int, phrase string, f long",
    )
    row = c.scored(counts).first()
    assert row.score == 1000 * (big - 1) * 10 * big // (big * big) == 9999


def test_only_longest_windows_are_shuffled(spark, rows):
    """No n-gram of another order is exploded: the grouping is a rollup over the columns."""
    docs = spark.createDataFrame(rows, "lang string, text string")
    how = c.Mining(least=3)
    made = c.windows(docs, c._bits(c.frequent_hashes(docs, how), how), how)
    assert made.columns == ["lang", "w1", "w2", "w3", "w4", "w5", "n"]
    assert made.agg(F.sum("n")).first()[0] == sum(len(re.findall(r"[^ \t-\r.,;:!?]+", t or "")) for _, t in rows)
    assert "Expand" in c.frequencies(made, how)._jdf.queryExecution().toString()


def test_hashes_are_those_of_frequent_words_pairs_and_triples(spark, rows):
    """Packed, dealt and added up again: as many as there are frequent phrases."""
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    f = Counter()
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\n-\r]", (text or "").lower()):
            words = piece.split()
            f.update((lang is None and "und" or lang, *words[i : i + k]) for k in (1, 2, 3) for i in range(len(words) - k + 1))
    how = c.Mining(least=5)
    pairs = c.frequent_hashes(docs, how)
    often = Counter(len(g) - 1 for g, n in f.items() if n >= 5)
    assert pairs.count() == pairs.distinct().count() == often[1] + often[2]
    assert c.frequent_hashes(docs, how, c._bits(pairs, how)).count() == often[3]


def test_windows_are_added_up_and_cut_before_they_are_rows(spark, rows):
    """No window is a row of every batch, and none goes on beyond its last frequent prefix."""
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    f = Counter()
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\n-\r]", "".join(ch.lower() if "A" <= ch <= "Z" else ch for ch in text or "")):
            words = [w for w in re.split(r"[ \t]", piece) if w]
            f.update(
                ("und" if lang is None else lang, *words[i : i + k]) for k in range(1, 6) for i in range(len(words) - k + 1)
            )
    how = c.Mining(least=3, batch_bytes=1, table_bytes=8)  # one text a batch, nearly every hash is in the table
    made = c.windows(docs, c._bits(c.frequent_hashes(docs, how), how), how).collect()
    many = [tuple(w for w in r[:-1] if w is not None) for r in made]
    long = [w for w in many if len(w) > 2]
    assert len(long) == len(set(long)) and min(f[w] for w in long) >= how.least
    for w in long:
        assert sum(r.n for r, other in zip(made, many, strict=True) if other[: len(w)] == w) == f[w]
