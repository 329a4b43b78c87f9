"""Multipart credential scan: spans by pattern, weak candidates by interval join.

Built-in expressions only. A scan finds the spans of every kind in each text; only
their narrow rows (row number, kind, gap and length) go on, and positions are running
sums of those. Base kinds are reported always. A *weak* candidate, a mixed token that
would be noise by itself, is reported as ``linked`` only where an access identifier and
an endpoint begin within ``reach`` code points of it: the interval join goes by cells of
that width, in which only the first and the last begin of each kind are kept, so a
candidate meets at most three rows per kind however many parts a text holds.

Row numbers stand for rows, so a repeated id does no harm. Defined cases: a null or
empty text has no spans; repeated rows are scanned each; a null id stays null; an empty
table gives no rows. Only the id and the text are read.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelmill.llm.common import documents, free_name, staged

#: The kinds that are always reported, in the order of reports (fixed values).
ASSIGN = (
    r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
#: Parts that count only together.
ENDPOINT = r"""https?://[^\s"'<>]+|(?:[0-9]{1,3}\.){3}[0-9]{1,3}"""
WEAK = r"[A-Za-z0-9+/_-]{20,}={0,2}"
KINDS = ("assign", "access", "hex", "linked", "endpoint")


def _long_enough(kind: str, match: Column) -> Column:
    """Whether a match counts. ``access`` and ``hex`` carry their least length in the
    pattern, which finds the same maximal runs; an assignment that is too short uses
    up its text, so that it has to be found first and dropped then."""
    if kind == "assign":
        return F.length(F.regexp_extract(match, ASSIGN, 1)) >= 12
    if kind == "linked":
        return match.rlike("[0-9]") & match.rlike("[a-z]") & match.rlike("[A-Z]")
    return F.lit(True)


def _found(kind: str, pattern: str, when: Column) -> Column:
    """kind, gap (code points since the last match), length, counts of each match."""
    text = F.col("text")
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(matches))
    rows = F.zip_with(
        matches,
        gaps,
        lambda m, g: F.struct(
            F.lit(KINDS.index(kind)).alias("kind"),
            F.length(g).alias("gap"),
            F.length(m).alias("length"),
            _long_enough(kind, m).alias("counts"),
        ),
    )
    none = F.array().cast("array<struct<kind: int, gap: int, length: int, counts: boolean>>")
    return F.when(when & text.rlike(pattern), rows).otherwise(none)


def all_spans(docs: DataFrame) -> DataFrame:
    """row, doc_id, mark (of the text), kind, start, end of every span; a row without any has nulls there."""
    text = F.col("text")
    parts = text.contains("AKIA") & text.rlike(ACCESS) & text.rlike(ENDPOINT)
    found = [
        _found("assign", ASSIGN, F.lit(True)),
        _found("access", ACCESS, text.contains("AKIA")),
        _found("hex", HEX, F.lit(True)),
        _found("linked", WEAK, parts),
        _found("endpoint", ENDPOINT, parts),
    ]
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id").cast("long"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    mark = F.xxhash64("text").alias("mark")
    each = rows.select("row", "doc_id", mark, F.posexplode_outer(F.concat(*found)).alias("pos", "m"))
    so_far = Window.partitionBy("row", "m.kind").orderBy("pos")
    end = F.sum(F.col("m.gap") + F.col("m.length")).over(so_far)
    return (
        each.withColumn("end", end)
        .filter("m IS NULL OR m.counts")
        .select(
            "row", "doc_id", "mark", F.col("m.kind").alias("kind"), (F.col("end") - F.col("m.length")).alias("start"), "end"
        )
    )


def linked(spans: DataFrame, reach: int) -> DataFrame:
    """The weak candidates with an access identifier and an endpoint in reach."""
    kind = {name: i for i, name in enumerate(KINDS)}
    cell = F.floor(F.col("start") / reach)
    weak = spans.filter(F.col("kind") == kind["linked"])
    for part in ("access", "endpoint"):
        cells = (
            spans.filter(F.col("kind") == kind[part])
            .groupBy("row", cell.alias("cell"))
            .agg(F.min("start").alias("first"), F.max("start").alias("last"))
        )
        near = weak.select("row", "start", "end", F.explode(F.array(cell - 1, cell, cell + 1)).alias("cell"))
        # of a cell to the left its last part is the nearest, to the right its first
        meets = (
            near.join(cells, ["row", "cell"])
            .filter(
                F.least(F.abs(F.col("start") - F.col("first")), F.abs(F.col("start") - F.col("last"))) <= reach
            )
            .select("row", "start", "end")
            .distinct()
        )
        weak = weak.join(meets, ["row", "start", "end"], "left_semi")
    # what a base span holds already is no find of its own
    # spans of one kind don't overlap, so a cell holds no more of them than its length allows
    cells = F.explode(F.sequence(cell, F.floor((F.col("end") - 1) / reach))).alias("cell")
    base = spans.filter(F.col("kind") < kind["linked"]).select(
        "row", cells, F.col("start").alias("base_start"), F.col("end").alias("base_end")
    )
    inside = (F.col("start") < F.col("base_end")) & (F.col("base_start") < F.col("end"))
    covered = (
        base.join(weak.select("row", "start", "end", cells), ["row", "cell"])
        .filter(inside)
        .select("row", "start", "end")
        .distinct()
    )
    return weak.join(covered, ["row", "start", "end"], "left_anti")


def scan(docs: DataFrame, reach: int = 300) -> DataFrame:
    """doc_id, mark (of the text), spans (start, kind, end in order): one per row of ``docs``."""
    spans = staged(all_spans(docs), "spans")
    kept = spans.filter(F.col("kind").isNull() | (F.col("kind") < KINDS.index("linked"))).unionByName(
        linked(spans, reach)
    )
    none = [F.lit(None).cast(t).alias(c) for c, t in (("kind", "int"), ("start", "long"), ("end", "long"))]
    # rows whose spans are all unlinked parts still need their row
    rows = spans.filter("kind >= 3").select("row", "doc_id", "mark", *none).distinct()
    span = F.when(F.col("kind").isNotNull(), F.struct("start", "kind", "end"))
    return (
        kept.unionByName(rows)
        .groupBy("row")
        .agg(
            F.first("doc_id").alias("doc_id"),
            F.first("mark").alias("mark"),
            F.sort_array(F.collect_list(span)).alias("spans"),
        )
        .drop("row")
    )


def digest(spans: Column) -> Column:
    """kind:start:end of the spans, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"], s["end"])), ","
    )


def redact(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``docs`` with the spans that ``found`` (a scan of them) has cut out of their texts,
    each run of overlapping spans replaced by ``[SECRET]``. Other columns stay, whatever
    their names."""
    of_id, of_mark, spans, made = (free_name(docs, n) for n in ("secret_id", "secret_mark", "secret_spans", "cut"))
    text, done = F.col("text"), "struct<at: bigint, out: string>"
    cut = F.aggregate(
        F.col(spans),
        F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out")),
        lambda acc, s: F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(
                (s["start"] >= acc["at"]),
                F.concat(
                    acc["out"],
                    text.substr((acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int")),
                    F.lit("[SECRET]"),
                ),
            )
            .otherwise(acc["out"])
            .alias("out"),
        ).cast(done),
    )
    some = (
        found.filter(F.size("spans") > 0)
        .select(F.col("doc_id").alias(of_id), F.col("mark").alias(of_mark), F.col("spans").alias(spans))
        .dropDuplicates([of_id, of_mark])
    )
    rest = F.concat(F.col(f"{made}.out"), text.substr((F.col(f"{made}.at") + 1).cast("int"), F.length("text")))
    same = F.col("doc_id").eqNullSafe(F.col(of_id)) & (F.xxhash64("text") == F.col(of_mark))
    joined = docs.join(some, same, "left").withColumn(made, F.when(F.col(spans).isNotNull(), cut))
    return joined.select(
        *[F.when(F.col(made).isNull(), text).otherwise(rest).alias(c) if c == "text" else F.col(c) for c in docs.columns]
    )


def op2_multipart_secrets(spark, sf_dir: str) -> DataFrame:
    found = scan(documents(spark, sf_dir))
    kinds = F.transform("spans", lambda s: s["kind"])
    n = {
        kind: (F.size(kinds) - F.size(F.array_remove(kinds, i))).cast("long").alias(f"n_{kind}")
        for i, kind in enumerate(KINDS[:3])
    }
    base = F.filter("spans", lambda s: s["kind"] < 3)
    return found.select(
        "doc_id",
        *n.values(),
        F.sha2(digest(base), 256).alias("base_sha256"),
        digest(F.col("spans")).alias("spans"),
    )


def _sql_kind(i: int, pattern: str, keep: str) -> str:
    quoted = pattern.replace("'", "''")
    return f"""
  SELECT doc_id, {i} AS kind, pos, m, length(g) AS gap, {keep} AS counts FROM (
    SELECT doc_id, unnest(regexp_extract_all(t, '{quoted}')) AS m,
           unnest(string_split_regex(t, '{quoted}')[:len(regexp_extract_all(t, '{quoted}'))]) AS g,
           unnest(range(len(regexp_extract_all(t, '{quoted}')))) AS pos
    FROM texts)"""


_SQL_KINDS = [
    _sql_kind(0, ASSIGN, f"length(regexp_extract(m, '{ASSIGN.replace(chr(39), chr(39) * 2)}', 1)) >= 12"),
    _sql_kind(1, ACCESS, "true"),
    _sql_kind(2, HEX, "true"),
    _sql_kind(3, WEAK, "regexp_matches(m, '[0-9]') AND regexp_matches(m, '[a-z]') AND regexp_matches(m, '[A-Z]')"),
    _sql_kind(4, ENDPOINT, "true"),
]
SQL = rf"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
found AS ({" UNION ALL ".join(_SQL_KINDS)}
), placed AS (
  SELECT doc_id, kind, counts, length(m) AS n,
         sum(gap + length(m)) OVER (PARTITION BY doc_id, kind ORDER BY pos) AS e
  FROM found
), spans AS (
  SELECT doc_id, kind, (e - n)::BIGINT AS s, e::BIGINT AS e FROM placed WHERE counts
), kept AS (
  SELECT * FROM spans WHERE kind < 3
  UNION ALL
  SELECT * FROM spans w WHERE kind = 3
    AND EXISTS (SELECT 1 FROM spans p WHERE p.doc_id = w.doc_id AND p.kind = 1 AND abs(p.s - w.s) <= 300)
    AND EXISTS (SELECT 1 FROM spans p WHERE p.doc_id = w.doc_id AND p.kind = 4 AND abs(p.s - w.s) <= 300)
    AND NOT EXISTS (SELECT 1 FROM spans p WHERE p.doc_id = w.doc_id AND p.kind < 3 AND p.s < w.e AND w.s < p.e)
), named AS (
  SELECT doc_id, kind, s, ['assign', 'access', 'hex', 'linked'][kind + 1] || ':' || s || ':' || e AS one
  FROM kept
)
SELECT t.doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access,
       count(*) FILTER (kind = 2) AS n_hex,
       sha256(coalesce(string_agg(one, ',' ORDER BY s, kind) FILTER (kind < 3), '')) AS base_sha256,
       coalesce(string_agg(one, ',' ORDER BY s, kind), '') AS spans
FROM texts t LEFT JOIN named ON named.doc_id = t.doc_id GROUP BY t.doc_id
"""

QUERIES = {"op2_multipart_secrets": (op2_multipart_secrets, SQL)}
