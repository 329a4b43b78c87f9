"""Phrases whose words occur together more often than their parts would.

Only the longest window is counted: at every word the next ``longest`` words of its piece.
The distinct windows of a batch travel sorted and packed, some bytes each, to the share
that owns their first two words. There equal ones are added up, and a window is cut behind
its longest prefix of ``least`` occurrences: all windows with that prefix are in the share,
so nothing that counts is lost. Only then do they become rows, one column a word, padded
with nulls. Spark's ROLLUP over these columns sums every shorter prefix, so the frequencies
of all phrases of one to ``longest`` words, and the number of all words, come from one
grouping and no n-gram of another order is ever made.

Before that a window is cut where no frequent phrase can go on: words, pairs of
neighbouring words and then triples of frequent pairs are counted by hash, and one whose
hash comes less than ``least`` times is in no phrase of ``least`` occurrences. Hashes that
come often enough are kept in a bit table, which lets through more than them, never less,
so all counts from ``least`` up are exact. Hashes travel sorted and packed, about three
bytes each, to the share that owns them. The table is the only thing sent to all tasks:
two bytes a frequent hash, at most ``Mining.table_bytes``; a corpus that needs a larger
one is mined with that size, exactly as well, with more windows to count.

A phrase's score is the least, over its cuts in two parts, of ``floor(1000 * f * n /
(f(left) * f(right)))``, in decimals of 38 digits; ties go to the first cut. A phrase
that one longer candidate contains in at least ``inside`` percent of its occurrences is
dropped. It is enough to look at phrases longer by one word: frequencies don't rise with
length, so the phrase in between has at least as many occurrences and is a candidate too.

Defined cases: a null text is empty; a null language is ``und``; rows that repeat an id
count each; equal scores are ordered by frequency, then by the phrase's bytes; an empty
table gives no rows. Only the language and text columns are read, so other columns may
have any name. Texts of any length are taken in whole; a batch holds one long text at most.
"""

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelmill.llm.common import documents, staged, texts

#: Rows that a task hands over at once; shares of the hashes per shuffle partition.
ROWS, SHARES = 20_000, 4
#: Windows that are packed, or added up, together.
PACKED = 400_000
#: Bits of a hash. Collisions only let more windows through.
HASH_BITS = 40
#: Bytes that end a piece become full stops, a tab becomes a space, A-Z become a-z.
BREAKS = b".,;:!?\n\x0b\x0c\r"
_PIECES = bytes.maketrans(BREAKS + b"\t", b"." * len(BREAKS) + b" ")


@dataclass(frozen=True)
class Mining:
    """Phrases of 2 to ``longest`` words with at least ``least`` occurrences.

    ``inside`` is the percentage that drops a phrase in favour of a longer one.
    ``batch_bytes`` of text are counted together before anything is sent, and the
    bit table has at most ``table_bytes`` bytes.
    """

    longest: int = 5
    least: int = 100
    inside: int = 100
    batch_bytes: int = 4 << 20
    table_bytes: int = 128 << 20


def _named(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")


class _Numbered:
    """Words of some texts as numbers, by language; -1 between pieces."""

    def __init__(self):
        self.numbers: dict[tuple[int, bytes], int] = {}
        self.langs: dict[str, int] = {}
        self.parts: list[np.ndarray] = []
        self.bytes = 0

    def add(self, langs: list[str], data: list[bytes]) -> None:
        for lang, text in zip(langs, data, strict=True):
            of = self.langs.setdefault(lang, len(self.langs))
            numbers = self.numbers
            found = [
                -1 if word == b"." else numbers.setdefault((of, word), len(numbers))
                for word in text.lower().translate(_PIECES).replace(b".", b" . ").split()
            ]
            found.append(-1)
            self.parts.append(np.array(found, np.int64))
            self.bytes += len(text)

    def words(self) -> np.ndarray:
        return np.concatenate([*self.parts, np.full(1, -1)])

    def hashes(self) -> np.ndarray:
        """One for every word, of its language and bytes."""
        seeds = [xxhash.xxh3_64_intdigest(lang.encode()) for lang in self.langs]
        found = (xxhash.xxh3_64_intdigest(word, seeds[of]) for of, word in self.numbers)
        return np.fromiter(found, np.uint64, len(self.numbers))


def _batches(batches, most: int):
    """Numbered texts of about ``most`` bytes, or of one text that is longer."""
    held = _Numbered()
    for batch in batches:
        for part, data in texts([batch]):
            held.add(part.column(0).to_pylist(), data)
            if held.bytes >= most:
                yield held
                held = _Numbered()
    if held.parts:
        yield held


def _with_next(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Hashes of phrases that go on by a word."""
    mixed = (first * np.uint64(0x9E3779B97F4A7C15)) ^ second
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    return mixed ^ (mixed >> np.uint64(32))


def _known(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    place = (hashes >> np.uint64(64 - HASH_BITS)) & np.uint64(64 * len(table) - 1)
    return (table[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) == 1


class _Chained:
    """Where phrases of a batch go on: by ``table``, or everywhere within pieces."""

    def __init__(self, held: _Numbered, table: np.ndarray | None):
        self.x, hashes = held.words(), held.hashes()
        often = np.ones(len(hashes), bool) if table is None else _known(table, hashes)
        self.word_hashes = hashes
        # the last of each is for -1, no word
        self.lead = np.where(np.append(often, False)[self.x], self.x, -1)
        self.pair = np.zeros(len(self.x), bool)
        self.pair[:-1] = (self.lead[:-1] >= 0) & (self.lead[1:] >= 0)
        if table is not None:
            at = np.flatnonzero(self.pair)
            self.pair[at] = _known(table, self.hashes(at, 2))
        self.triple = np.zeros(len(self.x), bool)
        self.triple[:-1] = self.pair[:-1] & self.pair[1:]

    def hashes(self, at: np.ndarray, size: int) -> np.ndarray:
        """Hashes of the phrases of ``size`` words at some places."""
        mixed = self.word_hashes[self.lead[at]]
        for i in range(1, size):
            mixed = _with_next(mixed, self.word_hashes[self.lead[at + i]])
        return mixed

    def keep_triples(self, table: np.ndarray) -> None:
        at = np.flatnonzero(self.triple)
        self.triple[at] = _known(table, self.hashes(at, 3))


def _packed(numbers: np.ndarray) -> bytes:
    """Numbers byte by byte, the high bytes of all first, compressed."""
    return zlib.compress(numbers.astype(">u8").view(np.uint8).reshape(-1, 8).T.tobytes(), 1)


def _unpacked(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(zlib.decompress(data), np.uint8).reshape(8, -1).T).view(">u8").ravel().astype(np.uint64)


def frequent_hashes(docs: DataFrame, how: Mining = Mining(), table: np.ndarray | None = None) -> DataFrame:
    """hash: of the words and pairs of each language with ``least`` occurrences; given the
    table of these, of the triples. A share's hashes are added up in one task."""
    shares = SHARES * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    top = np.uint64(64 - HASH_BITS)
    sent = docs.sparkSession.sparkContext.broadcast(table)

    def run(batches):
        for held in _batches(batches, how.batch_bytes):
            chained = _Chained(held, sent.value)
            if sent.value is None:
                words, pairs = chained.x[chained.x >= 0], np.flatnonzero(chained.pair)
                found = np.concatenate([chained.word_hashes[words], chained.hashes(pairs, 2)])
            else:
                found = chained.hashes(np.flatnonzero(chained.triple), 3)
            found, counts = np.unique(found >> top, return_counts=True)
            share = (found % np.uint64(shares)).astype(np.int64)
            order = np.argsort(share, kind="stable")
            edges = np.searchsorted(share[order], np.arange(shares + 1))
            rows = {"share": np.flatnonzero(np.diff(edges)), "hashes": [], "counts": []}
            for one in rows["share"].tolist():
                mine = order[edges[one] : edges[one + 1]]
                rows["hashes"].append(_packed(np.diff(found[mine], prepend=np.uint64(0))))
                rows["counts"].append(_packed(counts[mine]))
            yield pa.RecordBatch.from_pydict(
                {
                    "share": pa.array(rows["share"], pa.int64()),
                    "hashes": pa.array(rows["hashes"], pa.binary()),
                    "counts": pa.array(rows["counts"], pa.binary()),
                }
            )

    def add(share, parts):
        hashes = counts = np.zeros(0, np.uint64)
        for start in range(0, len(parts), 64):
            some = parts[start : start + 64]
            hashes = np.concatenate([hashes, *(np.cumsum(_unpacked(h)) for h, _ in some)])
            counts = np.concatenate([counts, *(_unpacked(c) for _, c in some)])
            hashes, place = np.unique(hashes, return_inverse=True)
            summed = np.zeros(len(hashes), np.uint64)
            np.add.at(summed, place, counts)
            counts = summed
        often = hashes[counts >= how.least].astype(np.int64)
        for k in range(0, len(often), ROWS):
            yield pa.RecordBatch.from_arrays([pa.array(often[k : k + ROWS])], ["hash"])

    def sums(batches):
        last, parts = None, []
        for batch in batches:
            for share, hashes, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if share != last:
                    yield from add(last, parts)
                    last, parts = share, []
                parts.append((hashes, counts))
        yield from add(last, parts)

    packed = _named(docs).mapInArrow(run, "share long, hashes binary, counts binary")
    return packed.repartition("share").sortWithinPartitions("share").mapInArrow(sums, "hash long")


def _bits(frequent: DataFrame, how: Mining) -> np.ndarray:
    """Bit table of the hashes of ``frequent``: a power of two of bytes, each table word
    put together by Spark, so the driver gets each of at most ``table_bytes`` once."""
    wanted = 2 * max(frequent.count(), 4)
    size = min(1 << (wanted - 1).bit_length(), 1 << (how.table_bytes.bit_length() - 1))
    place = F.col("hash").bitwiseAND(8 * size - 1)
    words = (
        frequent.select(F.shiftright(place, 6).alias("word"), F.expr(f"shiftleft(1L, int((hash & {8 * size - 1}) % 64))").alias("bit"))
        .groupBy("word")
        .agg(F.bit_or("bit").alias("bits"))
        .toArrow()
    )
    table = np.zeros(max(size // 8, 1), np.int64)
    table[words["word"].to_numpy()] = words["bits"].to_numpy()
    return table.view(np.uint64)


def _columns(how: Mining) -> list[str]:
    return [f"w{i}" for i in range(1, how.longest + 1)]


def _owners(langs: np.ndarray, words: np.ndarray, names: list[str], hashes: np.ndarray, shares: int) -> np.ndarray:
    """The share of each window, by its language and first two words (or fewer)."""
    seeds = np.array([xxhash.xxh3_64_intdigest(lang.encode()) for lang in names], np.uint64)
    found = seeds[langs]
    for i, column in enumerate(words[:2]):
        at = np.flatnonzero(column >= 0)
        word = hashes[column[at]]
        found[at] = _with_next(found[at], word) if i else word
    return ((found >> np.uint64(20)) % np.uint64(shares)).astype(np.int64)


def packed_windows(docs: DataFrame, table: np.ndarray, how: Mining = Mining()) -> DataFrame:
    """lang, share, windows, counts: the distinct longest windows of every batch and how
    often they come, by the share that owns them.

    A window ends where its piece does or where ``table`` doesn't know the next pair or
    triple (it has no word, if the table doesn't know the first).
    """
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(table)
    shares = SHARES * int(spark.conf.get("spark.sql.shuffle.partitions"))

    def run(batches):
        known = sent.value
        for held in _batches(batches, how.batch_bytes):
            langs, words, counts, hashes = _counted(held, known, how.longest)
            vocabulary = pa.array([word for _, word in held.numbers], pa.binary()).cast(pa.string())
            of_lang = list(held.langs)
            del held
            for k in range(0, len(counts), PACKED):
                part = slice(k, k + PACKED)
                columns = [vocabulary.take(pa.array(column[part], mask=column[part] < 0)) for column in words]
                owned = langs[part] * shares + _owners(langs[part], words[:, part], of_lang, hashes, shares)
                rows = pa.table({"owned": owned, "window": _joined(columns), "n": counts[part]})
                rows = rows.sort_by([("owned", "ascending"), ("window", "ascending")])
                owned, n = rows["owned"].to_numpy(), rows["n"].to_numpy()
                edges = np.concatenate([[0], np.flatnonzero(np.diff(owned)) + 1, [len(owned)]])
                lists = pa.LargeListArray.from_arrays(edges, rows["window"].combine_chunks())
                lines = pc.binary_join(lists, pa.scalar("\n", lists.type.value_type))
                first = owned[edges[:-1]]
                yield pa.RecordBatch.from_pydict(
                    {
                        "lang": pa.array([of_lang[i] for i in (first // shares).tolist()], pa.string()),
                        "share": pa.array(first % shares),
                        "windows": pa.array([zlib.compress(line.as_buffer(), 1) for line in lines], pa.binary()),
                        "counts": pa.array([_packed(one) for one in np.split(n, edges[1:-1])], pa.binary()),
                    }
                )

    return _named(docs).mapInArrow(run, "lang string, share long, windows binary, counts binary")


def _joined(columns: list[pa.Array]) -> pa.Array:
    """Words joined by spaces; no word, no space."""
    wide = [column.cast(pa.large_string()) for column in columns]
    wide[0] = wide[0].fill_null("")  # Arrow leaves out rows of nulls alone
    return pc.binary_join_element_wise(*wide, pa.scalar(" ", pa.large_string()), null_handling="skip")


def _summed(parts: list[pa.Table]) -> pa.Table:
    rows = pa.concat_tables(parts)
    return rows.group_by("window", use_threads=False).aggregate([("n", "sum")]).rename_columns(["window", "n"])


def _cut(found: pa.Table, how: Mining) -> pa.Table:
    """Windows cut behind their longest prefix of ``least`` occurrences, or the first word.

    ``found`` has all windows of a language that begin with the same two words as any of its.
    """
    spaces = pc.count_substring(found["window"], " ")
    left = {size: found.filter(pc.equal(spaces, size - 1)) for size in range(2, how.longest + 1)}
    kept = [found.filter(pc.equal(spaces, 0))]  # of one word or none
    longer = found.slice(0, 0)  # frequent prefixes by one word longer, and how often they come

    def shorter(rows: pa.Table) -> pa.Table:
        return pa.table({"window": pc.replace_substring_regex(rows["window"], " [^ ]*$", ""), "n": rows["n"]})

    for size in range(how.longest, 1, -1):
        own = left[size]
        prefixes = _summed([own, shorter(longer)])
        longer = prefixes.filter(pc.greater_equal(prefixes["n"], how.least))
        often = pc.is_in(own["window"], value_set=longer["window"].combine_chunks())
        kept.append(own.filter(often))
        rest = shorter(own.filter(pc.invert(often)))
        if size > 2:
            left[size - 1] = _summed([left[size - 1], rest])
        else:
            kept.append(rest)
    return _summed(kept)


def windows(docs: DataFrame, table: np.ndarray, how: Mining = Mining()) -> DataFrame:
    """lang, w1, .., n: the longest windows, added up by share and cut behind the longest
    prefix of ``least`` occurrences (or one word), and how often they come.

    A window has one column a word, null from its end on. A share's windows of a language
    are added up in one task.
    """
    names = _columns(how)
    none = pa.table({"window": pa.array([], pa.large_string()), "n": pa.array([], pa.int64())})

    def add(lang, parts):
        rows, held, new = none, [], 0
        for lines, counts in parts:
            texts = pa.array([zlib.decompress(lines)], pa.large_binary()).cast(pa.large_string())
            found = pc.split_pattern(texts, "\n").values
            held.append(pa.table({"window": found, "n": _unpacked(counts).astype(np.int64)}))
            new += len(found)
            if new >= max(PACKED, len(rows)):
                rows, held, new = _summed([rows, *held]), [], 0
        rows = _cut(_summed([rows, *held]), how)
        for k in range(0, len(rows), ROWS):
            part = rows.slice(k, ROWS)
            words = [window.split(" ") if window else [] for window in part["window"].to_pylist()]
            columns = [pa.array([w[i] if i < len(w) else None for w in words], pa.string()) for i in range(how.longest)]
            n = part["n"].combine_chunks()
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(words), pa.string()), *columns, n], ["lang", *names, "n"])

    def sums(batches):
        last, parts = None, []
        for batch in batches:
            for lang, share, *packed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (share, lang) != last:
                    if parts:
                        yield from add(last[1], parts)
                    last, parts = (share, lang), []
                parts.append(packed)
        if parts:
            yield from add(last[1], parts)

    dealt = packed_windows(docs, table, how).repartition("share").sortWithinPartitions("share", "lang")
    return dealt.mapInArrow(sums, ", ".join(["lang string", *(f"{name} string" for name in names), "n long"]))


def _counted(
    held: _Numbered, known: np.ndarray, longest: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Language, words (one row a column, -1 for none) and count of the distinct windows;
    hashes of the words.

    Windows grow column by column: those that go on are told apart by the window so far
    and the next word, and most stop early.
    """
    chained = _Chained(held, known)
    chained.keep_triples(known)
    x, lead = chained.x, chained.lead
    n_langs, n_words = len(held.langs), len(chained.word_hashes)
    # windows of no word by language, then those of one word
    of_word = np.array([of for of, _ in held.numbers], np.int64)
    langs = np.append(np.arange(n_langs), of_word)
    words = np.full((longest, n_langs + n_words), -1, np.int32)
    words[0, n_langs:] = np.arange(n_words)
    word_at = np.flatnonzero(x >= 0)
    window = np.where(lead[word_at] >= 0, n_langs + lead[word_at], of_word[x[word_at]])
    active = np.flatnonzero(lead[word_at] >= 0)
    for column in range(1, longest):
        ends = word_at[active] + column
        active = active[chained.pair[ends - 1] & (chained.triple[ends - 2] if column > 1 else True)]
        following = lead[word_at[active] + column]
        grown, which = np.unique(window[active] * n_words + following, return_inverse=True)
        shorter = grown // max(n_words, 1)
        added = words[:, shorter]
        added[column] = grown % max(n_words, 1)
        window[active] = words.shape[1] + which
        words, langs = np.concatenate([words, added], axis=1), np.append(langs, langs[shorter])
    counts = np.bincount(window, minlength=words.shape[1])
    there = np.flatnonzero(counts)
    return langs[there], words[:, there], counts[there], chained.word_hashes


def _phrase(words: list[Column]) -> Column:
    return F.concat_ws(" ", *words)  # leaves nulls out


def frequencies(found: DataFrame, how: Mining = Mining()) -> DataFrame:
    """lang, size, phrase, f: every phrase of up to ``longest`` words with ``least``
    occurrences, and one row of size 0 a language with the number of its words."""
    names = _columns(how)
    sums = found.rollup("lang", *names).agg(F.sum("n").alias("f"), F.grouping_id().alias("level"))
    # level: one bit a column, from the last on, that this row sums over
    size = how.longest - F.bit_count("level")
    last = F.coalesce(*[F.when(size == i + 1, F.col(name)) for i, name in enumerate(names)])
    whole = (F.col("size") == 0) | (F.col("last").isNotNull() & (F.col("f") >= how.least))
    return (
        sums.filter(F.bit_count("level") <= how.longest)
        .select("lang", size.alias("size"), last.alias("last"), _phrase([F.col(n) for n in names]).alias("phrase"), "f")
        .filter(whole)
        .select("lang", "size", "phrase", "f")
    )


def scored(counts: DataFrame, how: Mining = Mining()) -> DataFrame:
    """lang, size, phrase, a, l, r, n, score: the cut of least score of every phrase of
    two or more words. ``counts`` is a table that reads alike each time."""
    words = F.split("phrase", " ")
    parts = counts.filter("size >= 2").select(
        "lang", "size", "phrase", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("cut")
    )
    parts = parts.select(
        "*",
        F.array_join(F.slice(words, 1, F.col("cut")), " ").alias("left"),
        F.array_join(F.slice(words, F.col("cut") + 1, F.col("size")), " ").alias("right"),
    )
    known = counts.filter(f"size BETWEEN 1 AND {how.longest - 1}")
    left = known.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l"))
    right = known.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r"))
    total = counts.filter("size = 0").select("lang", F.col("f").alias("n"))
    big = "CAST({} AS DECIMAL(19, 0))".format
    score = F.expr(f"(1000 * {big('a')} * {big('n')}) div ({big('l')} * {big('r')})")
    best = (
        parts.join(left, ["lang", "left"])
        .join(right, ["lang", "right"])
        .join(total, "lang")
        .groupBy("lang", "size", "phrase", "a", "n")
        .agg(F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("best"))
    )
    return best.select("lang", "size", "phrase", "a", "best.l", "best.r", "n", "best.score")


def contained(counts: DataFrame, how: Mining = Mining()) -> DataFrame:
    """lang, phrase, longer_f: phrases within phrases longer by a word."""
    words, size = F.split("phrase", " "), F.col("size")
    shorter = F.array(F.array_join(F.slice(words, 1, size - 1), " "), F.array_join(F.slice(words, 2, size - 1), " "))
    return (
        counts.filter("size >= 3")
        .select("lang", F.explode(shorter).alias("phrase"), "f")
        .groupBy("lang", "phrase")
        .agg(F.max("f").alias("longer_f"))
    )


def collocations(docs: DataFrame, how: Mining = Mining()) -> DataFrame:
    """lang, size, phrase, a, l, r, n, score: phrases of ``least`` occurrences that no longer
    phrase stands for. The windows are counted once and written."""
    pairs = staged(frequent_hashes(docs, how), "frequent_pairs")
    table = _bits(pairs, how)
    if how.longest > 2:
        table = _bits(pairs.union(staged(frequent_hashes(docs, how, table), "frequent_triples")), how)
    counts = staged(frequencies(windows(docs, table, how), how), "frequencies")
    stands_for = scored(counts, how).join(contained(counts, how), ["lang", "phrase"], "left")
    return stands_for.filter(
        F.col("longer_f").isNull() | (100 * F.col("longer_f") < how.inside * F.col("a"))
    ).drop("longer_f")


def best(found: DataFrame, many: int) -> DataFrame:
    """The first ``many`` phrases of each language with their ranks from 1."""
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= many)


def op12_collocations(spark, sf_dir: str) -> DataFrame:
    first = best(collocations(documents(spark, sf_dir)), 2000)
    return first.select("lang", F.col("rank").cast("long"), "phrase", "a", "l", "r", "n", "score")


SQL = r"""
WITH texts AS (
  SELECT coalesce(lang, 'und') AS lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents
),
pieces AS (SELECT lang, unnest(string_split_regex(text, '[.,;:!?\n\x0b\f\r]')) AS piece FROM texts),
words AS (SELECT lang, list_filter(string_split_regex(piece, '[ \t]'), lambda w: w <> '') AS words FROM pieces),
sizes AS (SELECT unnest([1, 2, 3, 4, 5]) AS size),
starts AS (
  SELECT lang, size, words, unnest(range(1, len(words) - size + 2)) AS i
  FROM words, sizes WHERE len(words) >= size
),
grams AS (SELECT lang, size, array_to_string(words[i : i + size - 1], ' ') AS phrase, count(*) AS f FROM starts GROUP BY ALL),
totals AS (SELECT lang, sum(len(words))::BIGINT AS n FROM words GROUP BY lang),
cuts AS (
  SELECT lang, size, phrase, f AS a, unnest(range(1, size)) AS k, string_split(phrase, ' ') AS words
  FROM grams WHERE size >= 2 AND f >= 100
),
scores AS (
  SELECT c.lang, c.size, c.phrase, a, k, l.f AS l, r.f AS r, n,
         (1000 * a::HUGEINT * n::HUGEINT) // (l.f::HUGEINT * r.f::HUGEINT) AS score
  FROM cuts c JOIN totals t ON t.lang = c.lang
  JOIN grams l ON l.lang = c.lang AND l.phrase = array_to_string(words[1 : k], ' ')
  JOIN grams r ON r.lang = c.lang AND r.phrase = array_to_string(words[k + 1 : ], ' ')
),
least AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
kept AS (
  SELECT * FROM least s WHERE NOT EXISTS (
    SELECT 1 FROM least o WHERE o.lang = s.lang AND o.size > s.size AND 100 * o.a >= 100 * s.a
    AND contains(' ' || o.phrase || ' ', ' ' || s.phrase || ' '))
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM ranked WHERE rank <= 2000
"""

QUERIES = {"op12_collocations": (op12_collocations, SQL)}
