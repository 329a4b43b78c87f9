"""Periodic runs against brute force, random words and odd rows."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from reelmill.llm import periodic_runs as runs

SF = "/root/testdata/sf0.001"


def all_runs(words, least=12):
    """By the definition: stretches of equal words at every distance, smallest period."""
    n, found = len(words), []
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(least, 2 * q):
                stretch = words[i : i + length]
                if not any(stretch[p:] == stretch[:-p] for p in range(1, q)):
                    found.append((i, length, q))
            i = max(j, i + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def test_transform_and_back():
    rows = np.random.default_rng(1).integers(0, runs.PRIME, (3, 64)).astype(np.uint64)
    assert (runs.transform_back(runs.transform(rows)) == rows).all()


def test_occurrences_of_large_codes():
    rng = np.random.default_rng(2)
    windows = rng.integers(0, 3, (5, 40)) * 1_000_003 + 1_900_000_000
    blocks = windows[:, 7:11].copy()
    found = runs.occurrences(blocks, windows)
    for row in range(5):
        assert [d for d in range(37) if (windows[row, d : d + 4] == blocks[row]).all()] == np.flatnonzero(found[row]).tolist()


def test_random_words():
    rng = random.Random(4)
    for _ in range(600):
        letters, n = rng.choice([1, 2, 2, 3, 5, 40]), rng.randint(0, 160)
        x = [rng.randrange(letters) for _ in range(n)]
        for _ in range(rng.randint(0, 3)):
            if n > 4:
                start, period = rng.randrange(n), rng.randint(1, n // 2)
                for i in range(start + period, rng.randint(start, n)):
                    x[i] = x[i - period]
        least = rng.choice([4, 12, 12, 20])
        assert runs.find_runs(np.array(x, np.int64), least=least) == all_runs(x, least)


@pytest.mark.parametrize(
    "x",
    [[7] * 50_000, ([0] * 300 + [1]) * 100, list(range(9000)) * 3, [0] * 4000 + [1] + [0] * 4000],
    ids=["one word", "long period", "thrice", "two stretches"],
)
def test_long_texts(x):
    found = runs.find_runs(np.array(x, np.int64))
    for start, length, q in found:
        assert x[start : start + length - q] == x[start + q : start + length]
        assert start == 0 or x[start - 1] != x[start + q - 1]
        assert start + length == len(x) or x[start + length] != x[start + length - q]
    kinds = {50_000: [(0, 50_000, 1)], 27_000: [(0, 27_000, 9000)], 8001: [(0, 4000, 1), (4001, 4000, 1)]}
    assert found == kinds.get(len(x), found) and (len(x) != 30_100 or (0, 30_100, 301) in found and len(found) == 101)


def test_odd_rows(odd, spark, none):
    rows = runs.periodic_runs(odd).collect()
    assert len(rows) == odd.count()
    wanted = sorted(((r.doc_id, len(re.findall(r"[^ \t-\r]+", r.text or ""))) for r in odd.collect()), key=str)
    assert sorted(((r.doc_id, r.n_words) for r in rows), key=str) == wanted
    assert runs.periodic_runs(none).collect() == [] == runs.with_repeats(none).collect()
    ties = " ".join(["a b"] * 8 + ["x"] + ["c d"] * 8 + ["y"] + ["c d"] * 8)
    made = spark.createDataFrame([(None, ties), (1, ties), (1, ties)], "doc_id long, text string")
    rows = runs.periodic_runs(made).collect()
    assert [r.doc_id for r in rows] == [None, 1, 1]
    assert all([tuple(r) for r in row.runs] == all_runs(ties.split()) for row in rows)
    assert all(row.collapsed.split()[:4] == ["a", "b", "x", "c"] for row in rows)


def test_query_against_brute_force(spark):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = {r.doc_id: r for r in runs.op11_periodic_runs(spark, SF).collect()}
    assert rows.keys() == texts.keys()
    some = 0
    for doc_id, text in texts.items():
        words = re.findall(r"[^ \t-\r]+", text)
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0 and words:
            g, n = h // 10, len(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        if len(words) > 3000:
            continue  # the definition takes too long
        found = all_runs(words)
        row, some = rows[doc_id], some + bool(found)
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in found)
        dropped = {i for s, n, q in found for i in range(s + q, s + n)}
        rest = " ".join(w for i, w in enumerate(words) if i not in dropped)
        best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
        assert row.n_runs == len(found)
        assert (row.start, row.length, row.period) == (best or (None, None, None))
        assert row.exponent_milli == (best and 1000 * best[1] // best[2])
        assert row.runs_sha256 == hashlib.sha256(lines.encode()).hexdigest()
        assert row.collapsed_sha256 == hashlib.sha256(rest.encode()).hexdigest()
    assert some > 10
