"""Near-duplicate groups: one-permutation MinHash, banded buckets, star-shaped edges.

1. One pass hashes the distinct 4-word shingles of a text once each. The high byte
   deals a hash to one of 256 bins, each bin keeps its least hash, and an empty bin
   takes the value of the first filled one on its own random probe sequence
   (optimal densification). 64 bands of 4 bins are the bucket keys; one bit of
   every bin makes a 256-bit sketch.
2. Texts with one shingle set become one node, so copies cost nothing further.
3. Members of a bucket are paired with its three centres first. A pair whose sketches
   are too far apart is left out (long sets only: their sketch is exact enough); every
   other pair is confirmed on the full shingle sets, as strings.
4. Confirmed pairs are joined into components.
5. Buckets whose other members still lie in several components go on, on narrow rows of
   ids and sketches in blocks of bounded size (buckets of one least id are one group). In
   each round a member tries the one of its near members of other components that is near
   to most (the original among its copies). When a round brings few links, the members
   that still have a near one in another component are named, once each, and their texts
   meet in blocks in which all pairs are counted exactly; a block sends only links that
   join two components, so fewer than it has members. No pair of a bucket stays unseen.

Two texts at a similarity of 0.8 meet in about 26 of the 64 bands (in none: 2 of 10**15
pairs). ``tests/llm`` compares with all pairs, for hub groups and chains too.

Defined cases: null or blank text has no shingles and no link; fewer words than
``size`` make one shingle; rows that repeat an id are one document; a row without
an id is linked with nothing and kept; an empty table gives no rows.
"""

from dataclasses import dataclass
from functools import reduce
from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelmill.llm.common import WordHashes, documents, staged, texts, words_of

BINS, ROWS = 256, 4
SKETCH = ["s0", "s1", "s2", "s3"]


@dataclass(frozen=True)
class Near:
    """``size`` words to a shingle, similarity of at least ``percent`` per cent.

    Sets of at least ``sketched`` shingles are compared by sketch first and dropped
    beyond ``most_bits`` differing bits of 256: 64 stands for a similarity of 0.5,
    more than five deviations below 0.8. ``centres`` members of a bucket meet all others
    first. ``block`` members of a bucket are compared at once, and texts of ``held``
    members or ``held_shingles`` shingles.
    """

    size: int = 5
    percent: int = 80
    sketched: int = 128
    most_bits: int = 64
    centres: int = 3
    block: int = 1000
    held: int = 500
    held_shingles: int = 1_000_000


def _spread(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingle_hashes(words: list[bytes], size: int, hashes: WordHashes) -> np.ndarray:
    """Distinct 64-bit hashes of the shingles, ascending."""
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    n = max(1, len(h) - size + 1)
    width = min(size, len(h))
    mixed = np.full(n, width, np.uint64)
    for i in range(width):
        mixed = _spread(mixed * np.uint64(0x9E3779B97F4A7C15) + h[i : i + n])
    return np.unique(mixed)


def shingles(words: list[bytes], size: int) -> set[bytes]:
    """The distinct shingles themselves."""
    if len(words) <= size:
        return {b" ".join(words)} if words else set()
    return {b" ".join(words[i : i + size]) for i in range(len(words) - size + 1)}


def probes(attempts: int) -> np.ndarray:
    """Row a: the bin that each bin tries at attempt a."""
    at = np.arange(attempts * BINS, dtype=np.uint64)
    return (_spread(at + np.uint64(1)) >> np.uint64(56)).astype(np.uint8).reshape(attempts, BINS)


def signature(hashed: np.ndarray, tries: np.ndarray) -> np.ndarray:
    """Least hash of each bin, empty bins densified; ``hashed`` ascends and isn't empty."""
    bins, first = np.unique((hashed >> np.uint64(56)).astype(np.uint8), return_index=True)
    source = np.full(BINS, -1)
    source[bins] = first
    filled = source >= 0
    empty = np.flatnonzero(~filled)
    taken = source.copy()
    step = 64
    for a in range(0, len(tries), step):
        if not len(empty):
            break
        there = tries[a : a + step][:, empty]
        hit = filled[there]
        found = hit.any(axis=0)
        pick = there[hit.argmax(axis=0), np.arange(len(empty))]
        taken[empty[found]] = source[pick[found]]
        empty = empty[~found]
    taken[empty] = first[0]  # after 4096 attempts without a filled bin
    return hashed[taken]


def signatures(docs: DataFrame, how: Near) -> DataFrame:
    """doc_id, n_shingles, set_key, s0..s3 (sketch), bands; keys are null for empty sets."""
    size = how.size

    def run(batches):
        hashes, tries = WordHashes(), probes(4096)
        salt = _spread(np.arange(BINS // ROWS, dtype=np.uint64) + np.uint64(77))
        for batch, data in texts(batches):
            n, keys, bits, bands = [], [], [], []
            for text in data:
                hashed = shingle_hashes(words_of(text), size, hashes)
                n.append(len(hashed))
                if not len(hashed):
                    keys.append(None), bits.append([None] * 4), bands.append(None)
                    continue
                keys.append(xxhash.xxh3_128_digest(hashed.tobytes()))
                lows = signature(hashed, tries)
                one = np.packbits((_spread(lows) & np.uint64(1)).astype(np.uint8))
                bits.append(one.view("<i8").tolist())
                grouped = lows.reshape(-1, ROWS)
                band = salt
                for i in range(ROWS):
                    band = _spread(band + grouped[:, i])
                bands.append(band.view(np.int64))
            columns = [batch.column(0), pa.array(n, pa.int64()), pa.array(keys, pa.binary())]
            columns += [pa.array([b[i] for b in bits], pa.int64()) for i in range(4)]
            columns.append(pa.array(bands, pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays(
                columns, ["doc_id", "n_shingles", "set_key", *SKETCH, "bands"]
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run,
        "doc_id long, n_shingles long, set_key binary, s0 long, s1 long, s2 long, s3 long, bands array<long>",
    )


def _far(how: Near) -> Column:
    bits = reduce(
        lambda x, y: x + y, (F.bit_count(F.col(f"a.{s}").bitwiseXOR(F.col(f"b.{s}"))) for s in SKETCH)
    )
    long = F.least("a.n_shingles", "b.n_shingles") >= how.sketched
    # a set of under 0.8 times the other's size can't reach the similarity
    apart = 100 * F.least("a.n_shingles", "b.n_shingles") < how.percent * F.greatest(
        "a.n_shingles", "b.n_shingles"
    )
    return apart | (long & (bits > how.most_bits))


def confirmed(pairs: DataFrame, docs: DataFrame, how: Near, part: int = 500) -> DataFrame:
    """The pairs (a, b) whose full shingle sets are similar enough.

    The texts of b travel to their a, at most ``part`` of them to one copy of a; a
    task goes through them one by one and holds one set of a at a time.
    """
    size, percent = how.size, how.percent
    sized = pairs.groupBy("a").agg(F.ceil(F.count("*") / part).cast("int").alias("parts"))
    dealt = pairs.join(sized, "a").select(
        "a", "b", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int").alias("part")
    )
    sides = dealt.select("a", "part", "b", F.col("b").alias("doc_id")).unionByName(
        sized.select(
            "a",
            F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
            F.lit(None).cast("long").alias("b"),
            F.col("a").alias("doc_id"),
        )
    )
    # by merge at every size: how many texts take part grows with the corpus
    moved = docs.select(F.col("doc_id").cast("long"), "text").join(sides.hint("merge"), "doc_id").drop("doc_id")
    moved = moved.repartition("a", "part").sortWithinPartitions("a", "part", F.col("b").asc_nulls_first())

    def run(batches):
        key, sets = None, []
        for batch, data in texts(batches):
            found = []
            rows = zip(*(batch.column(n).to_pylist() for n in ("a", "part", "b")), data, strict=True)
            for a, part_, b, text in rows:
                own = shingles(words_of(text), size)
                if (a, part_) != key:
                    key, sets = (a, part_), []
                if b is None:
                    sets.append(own)
                    continue
                for other in sets:
                    both = len(own & other)
                    if 100 * both >= percent * (len(own) + len(other) - both):
                        found.append((a, b))
                        break
            yield pa.RecordBatch.from_arrays(
                [pa.array([f[i] for f in found], pa.int64()) for i in (0, 1)], ["a", "b"]
            )

    return moved.mapInArrow(run, "a long, b long").distinct()


def components(links: DataFrame) -> DataFrame:
    """node, component: the least node that each node of the links reaches.

    A link between different labels gives the lower one to its ends and to the nodes whose
    labels these had, and every node takes the label of its label, so the rounds grow with
    the logarithm of the longest chain. Each is staged; links are kept in one direction,
    and those that only say again that a node's lower neighbours hang together are gone.
    """
    edges = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    edges = staged(edges.filter("a < b").distinct(), "edges")
    # the lower neighbours of a node hang on the least of them: members that share their
    # centres leave one link each, and the links among centres fall together
    least = edges.groupBy("b").agg(F.min("a").alias("low"))
    hung = edges.join(least, "b").select(F.col("low").alias("a"), F.explode(F.array("b", "a")).alias("b"))
    edges = staged(hung.filter("a < b").distinct(), "edges")
    ends = edges.union(edges.select("b", "a")).toDF("node", "other")
    lows = ends.groupBy("node").agg(F.min("other").alias("low"))
    labels = staged(lows.select("node", F.least("node", "low").alias("component")), "labels")
    while True:
        apart = edges.join(labels.toDF("a", "x"), "a").join(labels.toDF("b", "y"), "b").filter("x <> y")
        near = apart.select(F.explode(F.array("a", "b", "x", "y")).alias("node"), F.least("x", "y").alias("low"))
        near = near.groupBy("node").agg(F.min("low").alias("low"))
        sunk = labels.join(near, "node", "left").select(
            "node", F.least("component", "low").alias("component"), F.col("component").alias("was")
        )
        up = labels.toDF("component", "up")
        new = sunk.join(up, "component").select(
            "node", F.least("component", "up").alias("component"), "was"
        )
        new = staged(new, "labels")
        moved = new.filter("component < was").limit(1).count()
        labels = new.drop("was")
        if not moved:
            return labels


def starred(nodes: DataFrame, how: Near) -> DataFrame:
    """id, c0, c1..: the members of buckets with at least two, and their bucket's centres.

    A bucket has ``how.centres`` centres: its least id, and its least ids under as many
    hashes as are left. All buckets order ids alike, so a group that meets in many
    buckets has the same few centres in most of them and its pairs fall together.
    """
    order = [F.col("id"), *(F.xxhash64("id", F.lit(k)) for k in range(1, how.centres))]
    members = nodes.select(F.col("doc_id").alias("id"), F.explode("bands").alias("bucket"))
    centres = members.groupBy("bucket").agg(
        *[F.min(F.struct(key.alias("key"), "id")).alias(f"c{k}") for k, key in enumerate(order)]
    )
    return (
        members.join(centres, "bucket")
        .select("id", *[F.col(f"c{k}.id").alias(f"c{k}") for k in range(how.centres)])
        .filter(reduce(lambda x, y: x | y, (F.col(f"c{k}") != F.col("id") for k in range(how.centres))))
    )


def candidates(stars: DataFrame, nodes: DataFrame, how: Near) -> DataFrame:
    """a, b: pairs of a bucket's centre and another member that pass the sketches."""
    edges = [
        stars.filter(F.col(c) != F.col("id")).select(
            F.least(c, "id").alias("a"), F.greatest(c, "id").alias("b")
        )
        for c in stars.columns[1:]
    ]
    pairs = reduce(DataFrame.union, edges).distinct()
    sketches = nodes.select(F.col("doc_id").alias("node"), "n_shingles", *SKETCH)
    a, b = sketches.alias("a"), sketches.alias("b")
    return (
        pairs.toDF("left", "right")
        .join(a, F.col("a.node") == F.col("left"))
        .join(b, F.col("b.node") == F.col("right"))
        .filter(~_far(how))
        .select(F.col("left").alias("a"), F.col("right").alias("b"))
    )


def _blocks(rows: DataFrame, keys: list[str], at_end):
    """Each run of rows with equal ``keys`` goes to ``at_end`` (the keys, the rows' rest)."""
    names = rows.columns

    def run(batches):
        key, held = None, []
        for batch in batches:
            found = []
            for start in range(0, batch.num_rows, 1024):
                columns = [batch.column(n).slice(start, 1024).to_pylist() for n in names]
                for row in zip(*columns, strict=True):
                    now = row[: len(keys)]
                    if now != key:
                        if held:
                            found += at_end(key, held)
                        key, held = now, []
                    held.append(row[len(keys) :])
            if found:
                yield found
        if held:
            yield at_end(key, held)

    return run


def _members(rest: DataFrame, labels: DataFrame, nodes: DataFrame, how: Near) -> DataFrame:
    """Members of the groups that span several components, in every pair of blocks."""
    label = labels.select(F.col("node").alias("id"), "component")
    spread = rest.join(label, "id", "left").withColumn("component", F.coalesce("component", "id"))
    groups = (
        spread.groupBy("group")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("n"))
        .filter("low < high")
        .select("group", F.ceil(F.col("n") / how.block).cast("int").alias("parts"))
    )
    sketches = nodes.select(F.col("doc_id").alias("id"), "n_shingles", *SKETCH)
    part = F.pmod(F.xxhash64("id", F.lit(7)), F.col("parts")).cast("int")
    dealt = (
        spread.join(groups, "group")
        .select("group", "id", "component", part.alias("part"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
        .join(sketches, "id")
        .select(
            "group", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"),
            "part", "id", "component", "n_shingles", *SKETCH,
        )
    )
    return dealt.repartition("group", "i", "j").sortWithinPartitions("group", "i", "j")


def _near_blocks(members: DataFrame, how: Near, every: bool) -> DataFrame:
    """id, other, weight: of every two blocks, the members with a near one of another
    component. ``other`` is, of these, the one that is near to most; with ``every`` it is
    the group."""

    def pairs(key, held):
        if len({h[2] for h in held}) < 2:
            return []
        data = np.array(held, np.int64)
        one = data[:, 0] == data[0, 0]
        left, right = (data, data) if one.all() else (data[one], data[~one])
        near = np.zeros((len(left), len(right)), bool)
        weight = np.zeros(near.shape, np.uint8)
        for k in range(0, len(left), 256):
            a, b = left[k : k + 256, None, :], right[None, :, :]
            bits = sum(np.bitwise_count((a[..., c] ^ b[..., c]).view(np.uint64)).astype(np.int16) for c in range(4, 8))
            small, large = np.minimum(a[..., 3], b[..., 3]), np.maximum(a[..., 3], b[..., 3])
            apart = (100 * small < how.percent * large) | ((small >= how.sketched) & (bits > how.most_bits))
            near[k : k + 256] = ~apart & (a[..., 2] != b[..., 2])
            weight[k : k + 256] = np.where(near[k : k + 256], np.maximum(1, how.most_bits + 1 - bits), 0)
        if every:
            some = np.unique(np.concatenate([left[near.any(axis=1), 1], right[near.any(axis=0), 1]]))
            group = np.full(len(some), key[0])
            return [pa.RecordBatch.from_arrays([pa.array(some), pa.array(group), pa.array(np.zeros(len(some)))], names)]
        out = []
        ways = [(left, right, near, weight)]
        if not one.all():
            ways.append((right, left, near.T, weight.T))
        for own, others, close, heavy in ways:
            mass = heavy.sum(axis=0, dtype=float) / len(own)
            pick = np.where(close, mass[None, :], -1.0).argmax(axis=1)
            some = close.any(axis=1)
            pick = pick[some]
            out.append(
                pa.RecordBatch.from_arrays(
                    [pa.array(own[some, 1]), pa.array(others[pick, 1]), pa.array(mass[pick])], names
                )
            )
        return out

    names = ["id", "other", "weight"]
    run = _blocks(members, ["group", "i", "j"], pairs)

    def flat(batches):
        for found in run(batches):
            yield from found

    return members.mapInArrow(flat, "id long, other long, weight double")


def confirmed_blocks(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, how: Near) -> DataFrame:
    """a, b: of the pairs that are similar enough, as many as join all that they join.

    Pairs that hang together are dealt to pairs of blocks, and a text travels once to
    each of these that needs it, however many pairs it is in. Sets are compared by the
    hashes of their shingles, and those that are similar as strings again.
    """
    size, percent = how.size, how.percent
    cluster = components(pairs)
    sized = cluster.join(nodes.select(F.col("doc_id").alias("node"), "n_shingles"), "node")
    parts = sized.groupBy("component").agg(
        F.greatest(
            F.ceil(F.count("*") / how.held), F.ceil(F.sum("n_shingles") / how.held_shingles)
        ).cast("int").alias("parts")
    )
    places = staged(
        sized.join(parts, "component").select(
            "node", "component", F.pmod(F.xxhash64("node", F.lit(9)), F.col("parts")).cast("int").alias("part")
        ),
        "places",
    )
    a, b = places.alias("x"), places.alias("y")
    dealt = (
        pairs.join(a, F.col("x.node") == F.col("a"))
        .join(b, F.col("y.node") == F.col("b"))
        .select(
            F.col("x.component").alias("cluster"),
            F.least("x.part", "y.part").alias("i"),
            F.greatest("x.part", "y.part").alias("j"),
            "a",
            "b",
        )
    )
    keys = ["cluster", "i", "j"]
    sides = staged(
        dealt.select(*keys, F.col("b").alias("doc_id"), F.col("a").alias("partner"))
        .unionByName(dealt.select(*keys, F.col("a").alias("doc_id"), F.lit(None).cast("long").alias("partner")))
        .groupBy(*keys, "doc_id")
        .agg(F.collect_list("partner").alias("partners")),
        "sides",
    )
    moved = docs.select(F.col("doc_id").cast("long"), "text").join(sides.hint("merge"), "doc_id")
    moved = moved.select(*keys, "doc_id", "partners", F.col("text").cast("binary")).repartition(*keys).sortWithinPartitions(*keys)

    def links(_, held):
        hashes, sets, wanted, root = WordHashes(), {}, {}, {}
        for doc, partners, text in held:
            data = bytes(text or b"")
            sets.setdefault(doc, []).append((data, shingle_hashes(words_of(data), size, hashes)))
            wanted[doc], root[doc] = partners, doc

        def top(x):
            while root[x] != x:
                root[x] = x = root[root[x]]
            return x

        def enough(both, x, y):
            return 100 * both >= percent * (x + y - both)

        found = []
        for doc, partners in wanted.items():
            for other in partners:
                if top(doc) == top(other):
                    continue
                for (t, x), (u, y) in product(sets[doc], sets[other]):
                    if not enough(min(len(x), len(y)), len(x), len(y)):
                        continue
                    if enough(len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y)):
                        s, v = shingles(words_of(t), size), shingles(words_of(u), size)
                        if enough(len(s & v), len(s), len(v)):
                            root[top(doc)] = top(other)
                            found.append((other, doc))
                            break
        return found

    run = _blocks(moved, keys, links)

    def flat(batches):
        for found in run(batches):
            yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)], ["a", "b"])

    return moved.mapInArrow(flat, "a long, b long")


def overlaps(sets: list[np.ndarray], few: int = 16, columns: int = 8192) -> np.ndarray:
    """How many elements every two sets share.

    An element of at most ``few`` sets adds to its pairs one by one; the others are
    columns of a 0/1 matrix that is multiplied by itself, ``columns`` at a time.
    """
    n = len(sets)
    shared = np.zeros((n, n), np.int64)
    elements = np.concatenate(sets)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    order = np.argsort(elements, kind="stable")
    elements, owner = elements[order], owner[order]
    new = np.ones(len(elements), bool)
    new[1:] = elements[1:] != elements[:-1]
    starts = np.flatnonzero(new)
    held = np.diff(np.append(starts, len(elements)))
    held_by = np.repeat(held, held)
    rare = owner[(held_by > 1) & (held_by <= few)]
    rank = np.repeat(np.arange(len(starts)), held)
    rare_rank = rank[(held_by > 1) & (held_by <= few)]
    for step in range(1, few):
        same = rare_rank[step:] == rare_rank[:-step]
        pairs = rare[:-step][same] * n + rare[step:][same]
        shared += np.bincount(pairs, minlength=n * n).reshape(n, n)
    shared += shared.T.copy()
    often = np.flatnonzero(held > few)
    for k in range(0, len(often), columns):
        chosen = often[k : k + columns]
        matrix = np.zeros((n, len(chosen)), np.float32)
        for column, (start, size) in enumerate(zip(starts[chosen].tolist(), held[chosen].tolist(), strict=True)):
            matrix[owner[start : start + size], column] = 1
        shared += (matrix @ matrix.T).astype(np.int64)
    return shared


def joining_links(flagged: DataFrame, labels: DataFrame, docs: DataFrame, nodes: DataFrame, how: Near) -> DataFrame:
    """a, b: links between members of one group, enough to join all that they join.

    ``flagged`` (id, other): members and their groups, which are ids too. Groups that share
    members are one cluster, so a text travels once to every two blocks of its cluster, not
    to each of its buckets. There all pairs are counted by the hashes of their shingles;
    one that is similar enough and joins two components is compared again as strings.
    """
    size, percent = how.size, how.percent
    # a member hangs on its least group, and groups that share members on one another
    of = flagged.groupBy("id").agg(F.min("other").alias("low"), F.collect_set("other").alias("groups"))
    of = staged(of, "groups")
    between = of.select(F.col("low").alias("a"), F.explode("groups").alias("b")).filter("a <> b").distinct()
    clusters = components(of.select(F.col("low").alias("a"), F.col("id").alias("b")).union(between))
    sized = (
        clusters.toDF("id", "cluster")
        .join(flagged.select("id").distinct(), "id", "left_semi")
        .join(nodes.select(F.col("doc_id").alias("id"), "n_shingles"), "id")
        .join(labels.toDF("id", "component"), "id", "left")
        .withColumn("component", F.coalesce("component", "id"))
    )
    sized = staged(sized, "clusters")
    parts = sized.groupBy("cluster").agg(
        F.greatest(
            F.ceil(F.count("*") / how.held), F.ceil(F.sum("n_shingles") / how.held_shingles)
        ).cast("int").alias("parts")
    )
    part = F.pmod(F.xxhash64("id", F.lit(9)), F.col("parts")).cast("int")
    keys = ["cluster", "i", "j"]
    dealt = sized.join(parts, "cluster").select(
        "cluster", "id", "component", part.alias("part"),
        F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("with"),
    )
    dealt = dealt.select(
        "cluster", F.least("part", "with").alias("i"), F.greatest("part", "with").alias("j"),
        F.col("id").alias("doc_id"), "component", "part",
    )
    moved = docs.select(F.col("doc_id").cast("long"), "text").join(dealt.hint("merge"), "doc_id")
    moved = moved.select(*keys, "doc_id", "component", "part", F.col("text").cast("binary"))
    moved = moved.repartition(*keys).sortWithinPartitions(*keys)

    def links(key, held):
        hashes = WordHashes()
        ids, component, of, data = zip(*held, strict=True)
        words = [words_of(bytes(text or b"")) for text in data]
        sets = [shingle_hashes(w, size, hashes) for w in words]
        both, n = overlaps(sets), np.array([len(s) for s in sets])
        enough = 100 * both >= percent * (n[:, None] + n[None, :] - both)
        label, of = np.array(component), np.array(of)
        wanted = enough & (label[:, None] < label[None, :])
        if key[1] != key[2]:  # pairs within one block are tried where it meets itself
            wanted &= of[:, None] != of[None, :]
        root = dict.fromkeys(component)

        def top(x):
            while root[x] is not None:
                x = root[x]
            return x

        found = []
        for x, y in np.argwhere(wanted).tolist():
            s, t = top(component[x]), top(component[y])
            if s == t:
                continue
            one, other = shingles(words[x], size), shingles(words[y], size)
            shared = len(one & other)
            if 100 * shared >= percent * (len(one) + len(other) - shared):
                root[s] = t
                found.append((ids[x], ids[y]))
        return found

    run = _blocks(moved, keys, links)

    def flat(batches):
        for found in run(batches):
            yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)], ["a", "b"])

    return moved.mapInArrow(flat, "a long, b long")


def link_rest(stars: DataFrame, tried: DataFrame, links: DataFrame, nodes: DataFrame, docs: DataFrame, how: Near) -> DataFrame:
    """node, component after all pairs of a bucket's members were tried or lie in one component."""
    labels = components(links)
    # pairs with a centre are tried; buckets with the same least id are one group
    centres = stars.columns[1:]
    outer = reduce(lambda x, y: x & y, (F.col(c) != F.col("id") for c in centres))
    rest = staged(stars.filter(outer).select(F.col("c0").alias("group"), "id").distinct(), "rest")
    few = None
    while True:
        found = staged(_near_blocks(_members(rest, labels, nodes, how), how, False), "peaks")
        if few is None:
            # who has no near member of another component now never will
            if not found.limit(1).count():
                return labels
            ids = found.select(F.col("id").alias("doc_id")).union(found.select("other")).distinct()
            some = docs.select(F.col("doc_id").cast("long"), "text").join(ids.hint("merge"), "doc_id", "left_semi")
            few = staged(some, "rest_texts")
        # what was tried gives way to the next best, by the votes of all blocks
        low, high = F.least("id", "other"), F.greatest("id", "other")
        votes = found.groupBy("id", "other", low.alias("a"), high.alias("b")).agg(F.sum("weight").alias("weight"))
        votes = votes.join(tried, ["a", "b"], "left_anti")
        picks = votes.groupBy("id").agg(F.max_by("other", F.struct("weight", "other")).alias("other"))
        pairs = picks.select(F.least("id", "other").alias("a"), F.greatest("id", "other").alias("b")).distinct()
        fresh = staged(pairs, "pairs")
        n, n_more = fresh.count(), 0
        if n:
            more = staged(confirmed_blocks(fresh, few, nodes, how), "links")
            n_more = more.count()
        if n_more:
            tried, links = tried.union(fresh), links.union(more)
            labels = components(links)
        if 10 * n_more <= n:
            break
    flagged = staged(_near_blocks(_members(rest, labels, nodes, how), how, True), "flagged")
    last = staged(joining_links(flagged, labels, few, nodes, how), "links")
    return components(links.union(last)) if last.limit(1).count() else labels


def near_duplicates(docs: DataFrame, how: Near = Near()) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row per row of ``docs``."""
    signed = staged(signatures(docs, how), "signatures")
    some = signed.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    # any of several texts under one id may stand for it: ids are what is linked
    leaders = some.groupBy("set_key").agg(
        F.min("doc_id").alias("leader"),
        F.min_by(F.struct("n_shingles", *SKETCH, "bands"), "doc_id").alias("of"),
    )
    leaders = staged(leaders, "leaders")
    nodes = leaders.select(F.col("leader").alias("doc_id"), "of.*")
    stars = staged(starred(nodes, how), "stars")
    tried = staged(candidates(stars, nodes, how), "pairs")
    links = staged(confirmed(tried, docs, how), "links")
    labels = link_rest(stars, tried, links, nodes, docs, how)
    named = leaders.join(labels, leaders.leader == labels.node, "left").select(
        "set_key", F.coalesce("component", "leader").alias("component")
    )
    out = signed.select("doc_id", "n_shingles", "set_key").join(named, "set_key", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return out.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
    )


def op5_minhash_stars(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir), Near(size=4))


SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
           lambda w: w != '') AS w
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 2),
           lambda i: w[i] || ' ' || w[i+1] || ' ' || w[i+2] || ' ' || w[i+3])) END AS s
  FROM words
), one AS (
  SELECT doc_id, len(s) AS n, md5(list_sort(s)::VARCHAR) AS k FROM sets
), leaders AS (
  SELECT k, min(doc_id) AS leader, min(n) AS n FROM one WHERE n > 0 GROUP BY k
), flat AS (
  SELECT leader, n, unnest(s) AS g FROM leaders JOIN sets ON doc_id = leader
), common AS (
  SELECT a.leader AS a, b.leader AS b, a.n AS na, b.n AS nb, count(*) AS shared
  FROM flat a JOIN flat b ON a.g = b.g AND a.leader < b.leader GROUP BY ALL
), links AS (
  SELECT a, b FROM common WHERE 100 * shared >= 80 * (na + nb - shared)
), ends AS (
  SELECT a AS x, b AS y FROM links UNION SELECT b, a FROM links
), reach(x, y) AS (
  SELECT leader, leader FROM leaders
  UNION
  SELECT reach.x, ends.y FROM reach JOIN ends ON reach.y = ends.x
), low AS (
  SELECT x, min(y) AS c FROM reach GROUP BY x
)
SELECT one.doc_id, n_shingles, component_id, one.doc_id = component_id AS kept
FROM (
  SELECT o.doc_id, o.n::BIGINT AS n_shingles, coalesce(low.c, o.doc_id) AS component_id
  FROM one o LEFT JOIN leaders l ON l.k = o.k AND o.n > 0 LEFT JOIN low ON low.x = l.leader
) one
"""

QUERIES = {"op5_minhash_stars": (op5_minhash_stars, SQL)}
