"""SimHash fingerprints, and every pair of them within a Hamming radius.

Built-in expressions only. Terms are pairs of neighbouring words (and single words of
more than three letters), each with two 64-bit hashes; the 128 bits of a text are the
signs of the votes of its terms. Votes are counted sixteen bits to a lane, four lanes to
a long, over at most 4,096 terms at a time; so the aggregation is 32 sums in generated
code, partial before the shuffle, and a very long text is split among several rows.

Documents are ordered by descending id through a range shuffle of ids alone; a text
travels once to its own id's task, and the beginning that its neighbour needs once more.

``within_radius`` finds all pairs of equal or near fingerprints: 128 bits are six blocks,
and for each of the 15 pairs of blocks there is a table keyed by these two; fingerprints
that differ in at most four bits agree in two blocks at least, so none is missed. Equal
fingerprints are one entry with a count.

Defined cases: a null text is empty; an empty text has no terms and the fingerprint of
zeros; documents with the same id are ordered by a hash of their text, and each has its
row; rows without an id come last in the order; the only document is its own neighbour;
an empty table gives no rows. Only the id and the text are read.
"""

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelmill.llm.common import documents, staged

LANES = 16  # of each hash: lane k holds bits k, k + 16, k + 32, k + 48
PART = 4096
_LOW = 0x0001000100010001


def terms(text: Column) -> Column:
    """Words and pairs of neighbouring words of a text, in order, repeats included."""
    words = F.filter(F.split(F.lower(text), "[ \\t-\\r]+"), lambda w: w != "")
    pairs = F.zip_with(
        F.slice(words, F.lit(1), F.size(words) - 1),
        F.slice(words, F.lit(2), F.greatest(F.size(words) - 1, F.lit(0))),
        lambda a, b: F.concat_ws(" ", a, b),
    )
    return F.when(F.size(words) < 2, words).otherwise(pairs)


def fingerprints(rows: DataFrame, text: str) -> DataFrame:
    """row, f0, f1: the fingerprint of the column ``text`` of each row that has terms.

    Grouped by home too, where the rows lie already, so that no vote is shuffled.
    """
    each = rows.select("home", "row", F.posexplode(terms(F.col(text))).alias("pos", "term")).select(
        "home",
        "row",
        F.floor(F.col("pos") / PART).alias("part"),
        F.xxhash64("term").alias("h0"),
        F.xxhash64("term", F.lit(1)).alias("h1"),
    )
    votes = [(h, k, f"{h}_{k}") for h in ("h0", "h1") for k in range(LANES)]
    counted = each.groupBy("home", "row", "part").agg(
        F.count("*").alias("n"),
        *[F.sum(F.shiftrightunsigned(h, k).bitwiseAND(F.lit(_LOW))).alias(name) for h, k, name in votes],
    )
    # every lane is a count of at most PART; wide sums over the parts of a text
    lanes = [
        (h, k, lane, F.shiftrightunsigned(name, 16 * lane).bitwiseAND(F.lit(0xFFFF)))
        for h, k, name in votes
        for lane in range(4)
    ]
    packed = [
        F.sum(lanes[i][3] + F.shiftleft(lanes[i + 1][3], 32)).alias(f"v{i}") for i in range(0, len(lanes), 2)
    ]
    summed = counted.groupBy("home", "row").agg(F.sum("n").alias("n"), *packed)
    bits = {"h0": [], "h1": []}
    for i, (h, k, lane, _) in enumerate(lanes):
        pair = F.col(f"v{i - i % 2}")
        votes_for = F.shiftrightunsigned(pair, 32) if i % 2 else pair.bitwiseAND(F.lit(0xFFFFFFFF))
        bit = k + 16 * lane
        one = F.lit(1 << bit if bit < 63 else -(1 << 63)).cast("long")
        bits[h].append(F.when(2 * votes_for > F.col("n"), one).otherwise(F.lit(0).cast("long")))

    def whole(parts: list[Column]) -> Column:
        # balanced, so that the expression stays shallow
        while len(parts) > 1:
            parts = [a.bitwiseOR(b) for a, b in zip(parts[::2], parts[1::2], strict=True)]
        return parts[0]

    return summed.select("row", whole(bits["h0"]).alias("f0"), whole(bits["h1"]).alias("f1"))


def in_order(ids: DataFrame) -> DataFrame:
    """``ids`` (doc_id, mark, n_chars) with the neighbours' keys: next_id, next_mark and
    prior_id, prior_mark, prior_chars, by descending id, around the ends.

    Ranges of ids are ordered by themselves; the first and last row of each range meet
    in a table with one row per range.
    """
    key = F.struct("doc_id", "mark", "rn", "n_chars")
    n_ranges = max(1, int(ids.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    # by the whole order, so that rows without an id and repeated rows are cut up too
    order = [F.desc_nulls_last("doc_id"), F.asc("mark"), F.asc("rn")]
    ranged = staged(
        ids.repartitionByRange(n_ranges, *order).withColumn("range", F.spark_partition_id()), "ranges"
    )
    inside = Window.partitionBy("range").orderBy(*order)
    near = ranged.select(
        "range", key.alias("own"), F.lead(key).over(inside).alias("next"), F.lag(key).over(inside).alias("prior")
    )
    near = staged(near, "inside")
    edges = (
        near.filter("next IS NULL").select("range", F.col("own").alias("tail"))
        .join(near.filter("prior IS NULL").select("range", F.col("own").alias("front")), "range")
    )
    # one row per range: as many as there are shuffle partitions
    over = Window.orderBy("range")
    whole = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    edges = edges.select(
        "range",
        F.coalesce(F.lead("front").over(over), F.first("front").over(whole)).alias("after"),
        F.coalesce(F.lag("tail").over(over), F.last("tail").over(whole)).alias("before"),
    )
    return near.join(edges, "range").select(
        "own.*",
        F.coalesce("next", "after").alias("next"),
        F.coalesce("prior", "before").alias("prior"),
    )


def with_edited(docs: DataFrame) -> DataFrame:
    """home, row, doc_id, text, n_chars, edited, next_row: texts and their edited texts.

    ``home`` stands for an id and its text, ``row`` for one of the rows that share them.
    Texts are shuffled by home once and stay there: rows find theirs by the same key,
    and so do the neighbours' beginnings. Rows of one home follow one another and have one
    text, so a home gets two beginnings at most, its own and the next home's, however many
    rows it has; these are told apart within the join.
    """
    texts_ = docs.select(
        F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    ).withColumn("mark", F.xxhash64("text"))
    same = Window.partitionBy("doc_id", "mark").orderBy("n_chars")
    ids = texts_.select("doc_id", "mark", F.length("text").alias("n_chars")).withColumn(
        "rn", F.row_number().over(same)
    )
    ordered = staged(
        in_order(ids).select(
            F.xxhash64("doc_id", "mark").alias("home"),
            F.xxhash64("doc_id", "mark", "rn").alias("row"),
            "doc_id",
            "n_chars",
            F.xxhash64("next.doc_id", "next.mark", "next.rn").alias("next_row"),
            F.xxhash64("next.doc_id", "next.mark").alias("next_home"),
            F.xxhash64("prior.doc_id", "prior.mark").alias("prior_home"),
            F.col("prior.rn").alias("prior_rn"),
            F.floor(F.col("prior.n_chars") / 3).cast("int").alias("wanted"),
        ),
        "order",
    )
    one = texts_.select(F.xxhash64("doc_id", "mark").alias("home"), "text").withColumn(
        "rn", F.row_number().over(Window.partitionBy("home").orderBy(F.lit(1)))
    )
    # merged at every size, so that the texts stay where their home is
    placed = one.filter("rn = 1").drop("rn").join(ordered.hint("merge"), "home")
    # one row for each home before this one: the first row's, and the one behind the first's
    fronts = placed.filter((F.col("prior_home") != F.col("home")) | (F.col("prior_rn") == 1)).select(
        F.col("prior_home").alias("home"),
        F.col("home").alias("from_home"),
        F.col("text").substr(F.lit(1), F.col("wanted")).alias("front"),
    )
    cut = F.floor(F.col("n_chars") / 3).cast("int")
    return (
        placed.join(fronts.hint("merge"), "home")
        .filter(F.col("next_home").bitwiseXOR(F.col("from_home")) == 0)
        .select(
            "home",
            "row",
            "doc_id",
            "text",
            "n_chars",
            F.concat(F.col("text").substr(F.lit(1), F.col("n_chars") - cut), F.col("front")).alias("edited"),
            "next_row",
        )
    )


def likeness(a: tuple[str, str], b: tuple[str, str]) -> Column:
    """Share of the 128 bits that agree."""
    differ = F.bit_count(F.col(a[0]).bitwiseXOR(F.col(b[0]))) + F.bit_count(F.col(a[1]).bitwiseXOR(F.col(b[1])))
    return 1 - differ / F.lit(128.0)


def as_hex(high: str, low: str) -> Column:
    return F.lower(F.concat(F.lpad(F.hex(high), 16, "0"), F.lpad(F.hex(low), 16, "0")))


def within_radius(queries: DataFrame, index: DataFrame, radius: int = 4) -> DataFrame:
    """f0, f1 (of a query), g0, g1 (of the index), n: distinct pairs at most ``radius``
    bits apart; n counts the rows of the index that have the fingerprint."""
    blocks = radius + 2
    edges = [128 * i // blocks for i in range(blocks + 1)]

    def block(i: int) -> Column:
        first, last = edges[i], edges[i + 1]

        def part(name: str, low: int, high: int) -> Column:
            width = high - low
            mask = (1 << width) - 1 if width < 64 else -1
            return F.shiftrightunsigned(name, low).bitwiseAND(F.lit(mask).cast("long"))

        if last <= 64:
            return part("f0", first, last)
        if first >= 64:
            return part("f1", first - 64, last - 64)
        return part("f0", first, 64).bitwiseXOR(F.shiftleft(part("f1", 0, last - 64), 64 - first))

    tables = [
        F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), block(i).alias("x"), block(j).alias("y"))
        for i, j in combinations(range(blocks), 2)
    ]

    def keyed(rows: DataFrame) -> DataFrame:
        return rows.select("*", F.explode(F.array(*tables)).alias("at"))

    entries = keyed(index.groupBy("f0", "f1").agg(F.count("*").alias("n"))).select(
        "at", F.col("f0").alias("g0"), F.col("f1").alias("g1"), "n"
    )
    asked = keyed(queries.select("f0", "f1").distinct())
    differ = F.bit_count(F.col("f0").bitwiseXOR(F.col("g0"))) + F.bit_count(F.col("f1").bitwiseXOR(F.col("g1")))
    return asked.join(entries, "at").filter(differ <= radius).select("f0", "f1", "g0", "g1", "n").distinct()


def near_counts(prints: DataFrame, every: int = 50, radius: int = 4) -> DataFrame:
    """f0, f1, n_near: for fingerprints of ids divisible by ``every``, how many rows have
    one within the radius, their own included."""
    asked = prints.filter(F.col("doc_id") % every == 0)
    found = within_radius(asked, prints.select("f0", "f1"), radius)
    return found.groupBy("f0", "f1").agg(F.sum("n").alias("n_near"))


def op9_simhash_blocks(spark, sf_dir: str) -> DataFrame:
    edited = with_edited(documents(spark, sf_dir))
    own = fingerprints(edited, "text")
    other = fingerprints(edited, "edited").select("row", F.col("f0").alias("e0"), F.col("f1").alias("e1"))
    zero = F.lit(0).cast("long")
    facts = edited.select("row", "doc_id", "n_chars", "next_row", F.sha2("edited", 256).alias("edited_sha256"))
    prints = staged(
        facts.join(own, "row", "left")
        .join(other, "row", "left")
        .withColumns({c: F.coalesce(c, zero) for c in ("f0", "f1", "e0", "e1")}),
        "fingerprints",
    )
    after = prints.select(F.col("row").alias("next_row"), F.col("f0").alias("n0"), F.col("f1").alias("n1"))
    near = near_counts(prints)
    asked = (F.col("doc_id") % 50 == 0) & F.col("n_near").isNotNull()
    return (
        prints.join(after, "next_row")
        .join(near, ["f0", "f1"], "left")
        .select(
            "doc_id",
            F.col("n_chars").cast("long"),
            "edited_sha256",
            as_hex("f0", "f1").alias("fingerprint"),
            as_hex("e0", "e1").alias("edited_fingerprint"),
            likeness(("f0", "f1"), ("e0", "e1")).alias("near_edited"),
            likeness(("f0", "f1"), ("n0", "n1")).alias("near_next"),
            F.when(asked, F.col("n_near")).alias("n_near"),
        )
    )


QUERIES = {"op9_simhash_blocks": (op9_simhash_blocks, None)}
