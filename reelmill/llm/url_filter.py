"""URL filter by path-template trees: wildcards, merged branches, smoothed purity.

Rules decide first: the longest that fits. Pages that rules decide are the labels for
all others. Per host, paths become templates level by level. Below one template prefix the
next segment is variable if it has more distinct values than the square root of the pages
there. A value of a steady segment stays if it has ``least`` pages; one of a variable segment
only if it holds a fair share of the pages, or if its labels differ from its siblings' beyond
chance. Every other becomes ``*``. Then, from the deepest level to the first, branches of one
host that differ in one named segment form a pool, and those whose labels don't differ from
the pool's beyond chance are merged into it (the segment becomes ``+``). A template is
rejected if the share of blocked labels of its branch, smoothed towards its host's and that
towards the corpus', reaches ``reject``. Pages of a host without any label get the corpus'
rate, so one verdict.

Everything is keyed sums with partial aggregation over distinct paths; no step sees a host
as a whole, so one host may hold any share of the pages.

Defined cases: a null url and one without ``://`` have an empty host and path; a page whose
label is missing is judged by its template; repeated rows count and are returned each; rows
without an id keep a null id; segments beyond ``depth`` count as one; an empty table gives
no rows. Only the id and the url are read.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelmill.llm.common import staged

#: verdict, host, path
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)


@dataclass(frozen=True)
class Tree:
    """``least`` pages make a value of a steady segment a branch; ``share`` of the pages, or
    ``apart`` deviations from its siblings over ``told`` labels, one of a variable segment.
    ``z`` deviations part a branch from its pool; ``weight`` labels smooth a purity."""

    share: float = 0.05
    least: int = 3
    told: int = 5
    apart: float = 3.0
    depth: int = 8
    z: float = 1.96
    weight: float = 5.0
    reject: float = 0.5


def parsed(pages: DataFrame) -> DataFrame:
    """page_id, host, path."""
    url = F.coalesce(F.col("url"), F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.translate(
        F.regexp_extract(rest, "^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    )
    return pages.select(
        "page_id", host.alias("host"), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1).alias("path")
    )


def ruled(rows: DataFrame, rules=RULES) -> DataFrame:
    """``rows`` with rule and rule_verdict of the longest rule that fits, else null."""
    best: Column = F.lit(None).cast("struct<rule: string, verdict: string>")
    for verdict, host, path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((F.col("host") == host) | F.col("host").endswith(f".{host}")) & F.col("path").startswith(path)
        found = F.struct(F.lit(host + path).alias("rule"), F.lit(verdict).alias("verdict"))
        best = F.when(fits, found).otherwise(best)
    return rows.withColumn("best", best).select(
        *rows.columns, F.col("best.rule").alias("rule"), F.col("best.verdict").alias("rule_verdict")
    )


def templates(paths: DataFrame, how: Tree) -> DataFrame:
    """``paths`` (host, path, n, labelled, blocked) with the template of each."""
    segments = F.filter(F.split("path", "/"), lambda s: s != "")
    head = F.slice(segments, 1, how.depth - 1)
    tail = F.array_join(F.slice(segments, how.depth, 1_000_000), "/")
    parts = F.when(F.size(segments) < how.depth, segments).otherwise(F.concat(head, F.array(tail)))
    rows = staged(paths.withColumn("parts", parts).withColumn("template", F.lit("")), "paths")
    deepest = rows.agg(F.max(F.size("parts"))).first()[0] or 0
    for level in range(deepest):
        rows = rows.withColumn("part", F.get("parts", F.lit(level)))
        sums = [F.sum(c).alias(c) for c in ("n", "labelled", "blocked")]
        child = rows.filter(F.col("part").isNotNull()).groupBy("host", "template", "part").agg(*sums)
        node = child.groupBy("host", "template").agg(
            F.count("*").alias("values"),
            *[F.sum(c).alias(f"node_{c}") for c in ("n", "labelled", "blocked")],
        )
        named = (
            child.join(node, ["host", "template"])
            .filter(_stays(how))
            .select("host", "template", "part", F.lit(True).alias("named"))
        )
        step = F.when(F.col("part").isNull(), F.col("template")).otherwise(
            F.concat("template", F.lit("/"), F.when(F.col("named"), F.col("part")).otherwise(F.lit("*")))
        )
        rows = staged(
            rows.join(named, ["host", "template", "part"], "left")
            .withColumn("template", step)
            .drop("part", "named"),
            "level",
        )
    return rows.drop("parts")


def _stays(how: Tree) -> Column:
    """Whether a child (n, labelled, blocked) of a node (values, node_*) keeps its name."""
    steady = F.col("values") * F.col("values") <= F.col("node_n")
    others = F.col("node_labelled") - F.col("labelled")
    rate = (F.col("node_blocked") - F.col("blocked") + 0.5) / (others + 1)
    labels = F.greatest(F.col("labelled"), F.lit(1))
    spread = F.sqrt(rate * (1 - rate) * (1 / labels + 1 / (others + 1)))
    differs = F.abs(F.col("blocked") / labels - rate) > how.apart * spread + 0.5 / labels
    known = (F.col("labelled") >= how.told) & (others > 0)
    return (F.col("n") >= how.least) & (
        steady | (F.col("n") >= F.col("node_n") * how.share) | (known & differs)
    )


def _smooth(blocked: Column, labelled: Column, towards: Column, how: Tree) -> Column:
    return (blocked + how.weight * towards) / (labelled + how.weight)


def branches(each: DataFrame, how: Tree) -> DataFrame:
    """``each`` (host, host_rate, template, labelled, blocked) with the branch of each."""
    rows = staged(each.withColumn("branch", F.split("template", "/")), "templates")
    deepest = rows.agg(F.max(F.size("branch"))).first()[0] or 0
    # a template begins with "/", so its first segment is at place 2
    for at in range(deepest, 1, -1):
        own = rows.groupBy("host", "branch").agg(
            F.first("host_rate").alias("host_rate"),
            F.sum("labelled").alias("labelled"),
            F.sum("blocked").alias("blocked"),
        )
        before, behind = F.slice("branch", 1, at - 1), F.slice("branch", at + 1, how.depth + 1)
        pool = F.concat(before, F.array(F.lit("+")), behind)
        own = own.filter(F.get("branch", F.lit(at - 1)) != "*").withColumn("pool", pool)
        pools = own.groupBy("host", "pool").agg(
            F.count("*").alias("members"),
            F.sum("labelled").alias("pool_labelled"),
            F.sum("blocked").alias("pool_blocked"),
        )
        rate = _smooth(F.col("pool_blocked"), F.col("pool_labelled"), F.col("host_rate"), how)
        n = F.greatest(F.col("labelled"), F.lit(1))
        chance = how.z * F.sqrt(rate * (1 - rate) / n) + 0.5 / n
        alike = (F.col("labelled") == 0) | (F.abs(F.col("blocked") / n - rate) <= chance)
        merged = (
            own.join(pools.filter("members > 1"), ["host", "pool"])
            .filter(alike)
            .select("host", "branch", "pool")
        )
        rows = rows.join(merged, ["host", "branch"], "left")
        rows = staged(rows.withColumn("branch", F.coalesce("pool", "branch")).drop("pool"), "branches")
    return rows.withColumn("branch", F.array_join("branch", "/"))


def judged(rows: DataFrame, how: Tree) -> DataFrame:
    """host, template, branch, purity, template_verdict of every template of ``rows``."""
    each = rows.groupBy("host", "template").agg(F.sum("labelled").alias("labelled"), F.sum("blocked").alias("blocked"))
    hosts = each.groupBy("host").agg(F.sum("labelled").alias("host_labelled"), F.sum("blocked").alias("host_blocked"))
    corpus = each.agg(F.sum("labelled").alias("l"), F.sum("blocked").alias("b")).first()
    start = (corpus.b or 0) / corpus.l if corpus.l else 0.0
    host_rate = _smooth(F.col("host_blocked"), F.col("host_labelled"), F.lit(start), how)
    branch = branches(each.join(hosts.select("host", host_rate.alias("host_rate")), "host"), how)
    merged = branch.groupBy("host", "branch").agg(
        F.sum("labelled").alias("all_labelled"), F.sum("blocked").alias("all_blocked")
    )
    purity = _smooth(F.col("all_blocked"), F.col("all_labelled"), F.col("host_rate"), how)
    return (
        branch.join(merged, ["host", "branch"])
        .withColumn("purity", purity)
        .select(
            "host",
            "template",
            "branch",
            "purity",
            F.when(F.col("purity") >= how.reject, "block").otherwise("allow").alias("template_verdict"),
        )
    )


def judge_urls(pages: DataFrame, rules=RULES, how: Tree = Tree()) -> DataFrame:
    """page_id, host, path, rule, verdict, template, purity: one row per row of ``pages``."""
    rows = ruled(parsed(pages), rules)
    paths = rows.groupBy("host", "path").agg(
        F.count("*").alias("n"),
        F.count("rule_verdict").alias("labelled"),
        F.count_if(F.col("rule_verdict") == "block").alias("blocked"),
    )
    placed = templates(paths, how)
    verdicts = placed.select("host", "path", "template").join(judged(placed, how), ["host", "template"])
    return rows.join(verdicts, ["host", "path"]).select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("rule_verdict", "template_verdict").alias("verdict"),
        "template",
        "purity",
    )


def op4_path_templates(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return judge_urls(pages)


QUERIES = {"op4_path_templates": (op4_path_templates, None)}
