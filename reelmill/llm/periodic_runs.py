"""Periodic runs of words, found by block convolution.

At each dyadic scale the words of a batch are cut into blocks. A block meets the window
that follows it: the sum of squared differences at every distance of the scale is a
convolution, computed exactly by a number-theoretic transform, and zero sums are the
block's occurrences. A run whose period lies in the scale repeats at least one whole
block at that distance, so block and distance are seeds of every run; equal distances
of neighbouring blocks form one seed, which is extended word by word to both sides.

A run is a stretch of words with smallest period q (words q apart are identical) and a
length of at least ``max(least, 2 * q)`` that no neighbouring word extends.

Two filters keep the transforms few without losing a seed: a block is left out if one
of its words doesn't come again within the distances of the scale, or if it is no shorter
than the period of a known run that covers the block and its whole window (then it
occurs there at multiples of that period only).

Defined cases: a null or empty text has no words and no runs; rows that repeat an id are
separate texts; a null id stays null; an empty table gives no rows. Only the id and text
columns are read, so other columns may have any name. A text lies in one task, whole, in
memory proportional to its words (about 100 bytes each); texts of up to 2**27 words are
exact (the transform's modulus has roots of order 2**27).
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelmill.llm.common import documents, texts

#: A prime below 2**31; 2**27 divides it less one, and 31 generates its units.
PRIME = 2013265921
GENERATOR = 31
#: Numbers that one transform call holds.
AT_ONCE = 1 << 19
LEAST = 12

RUNS = "array<struct<start:long,length:long,period:long>>"


class _Roots(dict):
    """By (size, whether for the way back): powers of a root of unity of order ``2 * size``."""

    def __missing__(self, key: tuple[int, bool]) -> np.ndarray:
        size, inverse = key
        root = pow(GENERATOR, (PRIME - 1) // (2 * size), PRIME)
        if inverse:
            root = pow(root, PRIME - 2, PRIME)
        powers = np.ones(1, np.uint64)
        while len(powers) < size:  # [1, r, .., r**(m-1)], then the same times r**m
            powers = np.concatenate([powers, _mod(powers * np.uint64(pow(root, len(powers), PRIME)))])
        self[key] = powers
        return powers


_ROOTS = _Roots()


def _mod(values: np.ndarray) -> np.ndarray:
    return values - values // np.uint64(PRIME) * np.uint64(PRIME)


def _wrap(values: np.ndarray) -> np.ndarray:
    """Values under twice the prime brought under it; the subtraction wraps below zero."""
    return np.minimum(values, values - np.uint64(PRIME))


def transform(rows: np.ndarray) -> np.ndarray:
    """Transform of each row, its order bit-reversed."""
    n, size = rows.shape
    half = size // 2
    while half:
        pairs = rows.reshape(n, -1, 2, half)
        low, high = pairs[:, :, 0], pairs[:, :, 1]
        out = np.empty_like(pairs)
        out[:, :, 0] = _wrap(low + high)
        out[:, :, 1] = _mod((low + np.uint64(PRIME) - high) * _ROOTS[half, False])
        rows = out.reshape(n, size)
        half //= 2
    return rows


def transform_back(rows: np.ndarray) -> np.ndarray:
    n, size = rows.shape
    half = 1
    while half < size:
        pairs = rows.reshape(n, -1, 2, half)
        low, high = pairs[:, :, 0], _mod(pairs[:, :, 1] * _ROOTS[half, True])
        out = np.empty_like(pairs)
        out[:, :, 0] = _wrap(low + high)
        out[:, :, 1] = _wrap(low + np.uint64(PRIME) - high)
        rows = out.reshape(n, size)
        half *= 2
    return _mod(rows * np.uint64(pow(size, PRIME - 2, PRIME)))


def occurrences(blocks: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """Boolean matrix: block ``r`` equals the stretch of window ``r`` that starts at ``d``.

    Codes are split into digits so small that a sum of squared differences stays below
    the prime; a sum that is 0 modulo the prime is then 0.
    """
    n, width = blocks.shape
    length = windows.shape[1]
    size = 1 << (length - 1).bit_length()
    bits = 1
    while width * ((1 << (bits + 1)) - 1) ** 2 < PRIME:
        bits += 1
    top = int(max(blocks.max(), windows.max())).bit_length()
    equal = np.ones((n, length - width + 1), bool)
    for shift in range(0, max(top, 1), bits):
        digit = (blocks >> shift) & ((1 << bits) - 1)
        other = (windows >> shift) & ((1 << bits) - 1)
        a, b = np.zeros((n, size), np.uint64), np.zeros((n, size), np.uint64)
        a[:, :width] = digit[:, ::-1]
        b[:, :length] = other
        product = transform_back(_mod(transform(a) * transform(b)))[:, width - 1 : length]
        squares = np.zeros((n, length + 1), np.int64)
        np.cumsum(other * other, axis=1, out=squares[:, 1:])
        sums = (digit * digit).sum(axis=1, keepdims=True) + squares[:, width:] - squares[:, :-width]
        equal &= (sums - 2 * product.astype(np.int64)) % PRIME == 0
    return equal


def scales(longest: int, least: int) -> Iterator[tuple[int, int, int]]:
    """Smallest period, first larger one, and block length of every scale.

    A run repeats ``length - period`` words; a stretch of ``2 * block - 1`` words holds
    a whole block wherever it lies.
    """
    yield 1, 8, max(1, min((max(least - period, period) + 1) // 2 for period in range(1, 8)))
    low = 8
    while 2 * low <= longest:
        yield low, 2 * low, low // 2
        low *= 2


class _Words:
    """The words of a batch as numbers, with the places where each comes again."""

    def __init__(self, x: np.ndarray):
        self.x, n = x, len(x)
        order = np.argsort(x, kind="stable")
        ranks = np.zeros(n, np.int64)
        new = x[order][1:] != x[order][:-1]
        ranks[order[1:]] = np.cumsum(new)
        self.base = ranks * (n + 1)
        self.keys = self.base[order] + order
        self.next = np.full(n, n, np.int64)
        again = ~new
        self.next[order[:-1][again]] = order[1:][again] - order[:-1][again]

    def comes_again(self, at: np.ndarray, low: int, high: int) -> np.ndarray:
        """The word at each place comes again ``low`` to ``high - 1`` words later."""
        first = np.searchsorted(self.keys, self.base[at] + np.minimum(at + low, len(self.x)))
        found = self.keys[np.minimum(first, len(self.keys) - 1)]
        return (found >= self.base[at] + at + low) & (found < self.base[at] + np.minimum(at + high, len(self.x)))

    def blocks(self, low: int, high: int, width: int) -> np.ndarray:
        """Starts of the blocks all of whose words come again in the scale."""
        n = len(self.x)
        many = max(0, (n - low) // width)
        near = self.next[: many * width].reshape(many, width).max(axis=1) < high
        starts = np.flatnonzero(near) * width
        for i in range(width):  # the first words leave few blocks
            if not len(starts):
                break
            starts = starts[self.comes_again(starts + i, low, high)]
        return starts


def _extend(x: np.ndarray, at: np.ndarray, period: np.ndarray, step: int) -> np.ndarray:
    """How many words from ``at`` on, going by ``step``, equal the word a period later."""
    n = len(x)
    done = np.zeros(len(at), np.int64)
    active, width = np.arange(len(at)), 8
    while len(active):
        width = max(1, min(width, AT_ONCE // len(active)))
        here = (at[active] + step * done[active])[:, None] + step * np.arange(width)
        there = here + period[active][:, None]
        inside = (here >= 0) & (there < n)
        same = inside & (x[np.clip(here, 0, n - 1)] == x[np.clip(there, 0, n - 1)])
        stops = ~same
        count = np.where(stops.any(axis=1), stops.argmax(axis=1), width)
        done[active] += count
        active = active[count == width]
        width = min(2 * width, AT_ONCE)
    return done


def _primes(number: int) -> list[int]:
    found, divisor = [], 2
    while divisor * divisor <= number:
        if number % divisor == 0:
            found.append(divisor)
            while number % divisor == 0:
                number //= divisor
        divisor += 1
    return [*found, number] if number > 1 else found


def find_runs(x: np.ndarray, longest: int | None = None, least: int = LEAST) -> list[tuple[int, int, int]]:
    """All runs of ``x`` as (start, length, period), by start, then period.

    ``longest`` is the length of the longest stretch that a run can lie in.
    """
    n, runs = len(x), []
    if n < least:
        return runs
    words = _Words(x)
    covered_to, covered_by = np.zeros(n, np.int64), np.ones(n, np.int64)
    for low, high, width in scales(min(n, longest or n), least):
        starts = words.blocks(low, high, width)
        known = (covered_to[starts] >= starts + high - 1 + width) & (covered_by[starts] <= width)
        starts = starts[~known]
        seeds = [_seeds(x, part, low, high, width) for part in _parts(starts, 4 * (high - low + width))]
        if not seeds:
            continue
        at, period = (np.concatenate(side) for side in zip(*seeds, strict=True))
        old = (covered_to[at] >= at + period + width) & (period % covered_by[at] == 0)
        at, period = at[~old], period[~old]
        for run in sorted(_grown(x, at, period, width, least)):
            start, length, q = run
            if any(np.array_equal(x[start : start + q], x[start + q // f : start + q // f + q]) for f in _primes(q)):
                continue
            runs.append(run)
            part = slice(start, start + length)
            longer = covered_to[part] < start + length
            covered_to[part][longer] = start + length
            covered_by[part][longer] = q
    return sorted(runs, key=lambda r: (r[0], r[2]))


def _parts(starts: np.ndarray, numbers: int) -> Iterator[np.ndarray]:
    rows = max(1, AT_ONCE // numbers)
    for i in range(0, len(starts), rows):
        yield starts[i : i + rows]


def _seeds(x, starts, low, high, width):
    """Blocks and distances of the scale at which the block occurs again."""
    blocks = x[starts[:, None] + np.arange(width)]
    places = starts[:, None] + np.arange(low, high - 1 + width)
    alphabet, codes = np.unique(blocks, return_inverse=True)
    inside = x[np.minimum(places, len(x) - 1)]
    rank = np.minimum(np.searchsorted(alphabet, inside), len(alphabet) - 1)
    # words that are in no block, and places behind the end, get a code of their own
    window = np.where((places < len(x)) & (alphabet[rank] == inside), rank, len(alphabet))
    row, distance = np.nonzero(occurrences(codes.reshape(blocks.shape), window))
    return starts[row], distance + low


def _grown(x, at, period, width, least) -> set[tuple[int, int, int]]:
    """Runs around the seeds; seeds of neighbouring blocks at one distance are one."""
    if not len(at):
        return set()
    order = np.lexsort((at, period))
    at, period = at[order], period[order]
    first = np.ones(len(at), bool)
    first[1:] = (period[1:] != period[:-1]) | (at[1:] != at[:-1] + width)
    last = np.append(first[1:], True)
    start, end, period = at[first], at[last] + width, period[first]
    start = start - _extend(x, start - 1, period, -1)
    end = end + _extend(x, end, period, 1)
    length = end - start + period
    whole = length >= np.maximum(least, 2 * period)
    return set(zip(start[whole].tolist(), length[whole].tolist(), period[whole].tolist(), strict=True))


def _numbered(data: list[bytes]) -> tuple[np.ndarray, list[list[bytes]], np.ndarray]:
    """Words of the texts as numbers in one array, a number of its own between texts."""
    words = [text.split() for text in data]
    numbers: dict[bytes, int] = {}
    flat, starts = [], []
    for i, text in enumerate(words):
        starts.append(len(flat))
        flat.extend([numbers.setdefault(word, len(numbers)) for word in text])
        flat.append(-1 - i)
    return np.array(flat, np.int64), words, np.array(starts, np.int64)


def periodic_runs(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """doc_id, n_words, runs, collapsed: one row per row of ``docs``.

    ``runs`` are (start, length, period) in words, by start, then period. ``collapsed`` is
    the text without the words that a run holds after its first period, joined by spaces.
    """

    def run(batches):
        for batch, data in texts(batches):
            x, words, starts = _numbered(data)
            found = find_runs(x, max(map(len, words), default=0), least)
            row = np.searchsorted(starts, [r[0] for r in found], side="right") - 1
            dropped = np.zeros(len(x), bool)
            for start, length, period in found:
                dropped[start + period : start + length] = True
            collapsed = []
            for text, start in zip(words, starts.tolist(), strict=True):
                keep = ~dropped[start : start + len(text)]
                collapsed.append(b" ".join(text if keep.all() else [w for w, k in zip(text, keep, strict=True) if k]))
            made = np.array(found, np.int64).reshape(-1, 3)
            if len(made):
                made[:, 0] -= starts[row]
            offsets = np.searchsorted(row, np.arange(len(words) + 1))
            fields = [pa.array(made[:, i]) for i in range(3)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(map(len, words), pa.int64()),
                    pa.ListArray.from_arrays(
                        pa.array(offsets, pa.int32()),
                        pa.StructArray.from_arrays(fields, ["start", "length", "period"]),
                    ),
                    pa.array(collapsed, pa.binary()).cast(pa.string()),
                ],
                ["doc_id", "n_words", "runs", "collapsed"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, f"doc_id long, n_words long, runs {RUNS}, collapsed string"
    )


def with_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, text: one text in ten (by crc32 of the id) repeats itself from a place on.

    With g the tenth of the checksum and n words, word ``i >= a`` becomes word
    ``a + (i - a) % p`` for ``a = g % n`` and ``p = 1 + (n - a) // (3 + g % 8)``.
    Texts without an id stay.
    """
    checksum = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    some = docs.select(F.col("doc_id").cast("long"), "text", checksum.alias("checksum"))

    def run(batches):
        for batch, data in texts(batches):
            changed = []
            for text, h in zip(data, batch.column(2).to_pylist(), strict=True):
                words = text.split() if h is not None and h % 10 == 0 else []
                if words:
                    g, n = h // 10, len(words)
                    a = g % n
                    p = 1 + (n - a) // (3 + g % 8)
                    kept = words[: a + p]
                    text = b" ".join(kept + [kept[a + (i - a) % p] for i in range(a + p, n)])
                changed.append(text)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(changed, pa.binary()).cast(pa.string())], ["doc_id", "text"]
            )

    return some.mapInArrow(run, "doc_id long, text string")


def op11_periodic_runs(spark, sf_dir: str) -> DataFrame:
    found = periodic_runs(with_repeats(documents(spark, sf_dir)))
    # the longest run; of equal ones the first, then the one of least period
    best = F.array_max(
        F.transform("runs", lambda r: F.struct(r.length.alias("length"), (-r.start).alias("s"), (-r.period).alias("q")))
    )
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.s")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.q")).alias("period"),
        F.expr("1000 * best.length div -best.q").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


#: Repeats of unknown period within every text have no practical SQL.
QUERIES = {"op11_periodic_runs": (op11_periodic_runs, None)}
