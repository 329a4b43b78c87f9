"""Channel targets, feed normalisation and insertion of new episodes."""

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from reelmill import schemas
from reelmill.functions.text import first_truthy, has_content, slugify, strip
from reelmill.functions.times import moment, parse_published

# Lookback of a discovery pass and the address of a bare video id.
LOOKBACK_DAYS = 14
WATCH_URL = "https://www.youtube.com/watch?v="

_TARGET = "struct<channel_id string, channel_handle string, channel_slug string>"


def _target(channel_id: Column, handle: Column, slug: Column) -> Column:
    return F.struct(
        channel_id.alias("channel_id"),
        handle.alias("channel_handle"),
        slug.alias("channel_slug"),
    )


def _parse_token(token: Column) -> Column:
    named = token.contains("=")
    slug = F.when(named, strip(F.substring_index(token, "=", 1)))
    spec = F.when(named, strip(F.regexp_replace(token, r"^[^=]*=", ""))).otherwise(token)
    by_id = F.lower(spec).startswith("id:")
    channel_id = F.when(by_id, strip(F.substring(spec, 4, 2**31 - 1))).otherwise("")
    handle = F.when(by_id, F.lit("")).otherwise(strip(F.regexp_replace(spec, "^@+", "")))
    return _target(channel_id, handle, first_truthy(slug, slugify(F.concat(channel_id, handle))))


def parse_channel_specs(
    specs: DataFrame,
    column: str = "spec",
    channel_id: str = "",
    handle: str = "",
    slug: str = "",
) -> DataFrame:
    """``"slug=id:UC.., @handle"`` -> one row per target, in spec order.

    A spec without any usable target yields the explicit id, else the handle; both are
    the deployment's to give.
    """
    tokens = F.filter(F.transform(F.split(column, ","), strip), lambda t: t != "")
    targets = F.filter(
        F.transform(tokens, _parse_token),
        lambda t: (t["channel_id"] != "") | (t["channel_handle"] != ""),
    )
    fallback = _target(F.lit(channel_id), F.lit("" if channel_id else handle), F.lit(slug))
    others = [c for c in specs.columns if c != column]
    parsed = specs.select(*others, targets.alias("targets"))
    chosen = F.when(F.size("targets") > 0, F.col("targets")).otherwise(F.array(fallback))
    return parsed.select(*others, F.posexplode(chosen).alias("target_pos", "target")).select(
        *others, "target_pos", "target.*"
    )


def channel_targets(spark: SparkSession, spec: str, **defaults) -> DataFrame:
    """D1 for one configured spec string."""
    return parse_channel_specs(spark.range(1).select(F.lit(spec).alias("spec")), **defaults)


def with_channel_ref(targets: DataFrame, default_handle: str = "") -> DataFrame:
    """D3: id, else ``@handle``; targets with neither are dropped."""
    by_id = strip(F.coalesce("channel_id", F.lit("")))
    named = first_truthy(F.col("channel_handle"), default_handle)
    handle = strip(F.regexp_replace(named, "^@+", ""))
    ref = F.when(by_id != "", by_id).when(handle != "", F.concat(F.lit("@"), handle))
    return targets.withColumn("channel_ref", ref).filter(F.col("channel_ref").isNotNull())


def join_feeds(targets: DataFrame, feed: DataFrame, default_slug: str = "") -> DataFrame:
    """The feed rows of every target, with the target's slug.

    The target list comes from configuration, so its side is small and gets
    broadcast by size; a hot channel then needs no shuffle at all.
    """
    slug = strip(first_truthy(F.col("channel_slug"), default_slug))
    wanted = targets.select(
        "target_pos", F.col("channel_ref").alias("channel"), slug.alias("channel_slug")
    )
    return feed.join(wanted, "channel").drop("channel")


def _feed_order(rows: DataFrame) -> list[str]:
    """Targets in configured order, then landings, then the feed's own order."""
    order = ("target_pos", "received_at", "doc", "feed_pos")
    return [c for c in order if c in rows.columns]


def normalise_feed(rows: DataFrame) -> DataFrame:
    """Feed entries to episode attributes; entries without id are dropped."""
    order = _feed_order(rows)
    return rows.filter(has_content(F.col("videoId"))).withColumn(
        "video_id", strip(F.col("videoId"))
    ).select(
        "video_id",
        "channel_slug",
        "title",
        parse_published(F.col("published")).alias("published_at"),
        first_truthy(F.col("link"), F.concat(F.lit(WATCH_URL), "video_id")).alias("source_url"),
        F.col("thumbnail.url").alias("thumbnail_url"),
        "description",
        F.lit(None).cast("int").alias("duration_seconds"),
        *order,
    )


def within_lookback(
    items: DataFrame, as_of: datetime, lookback_days: int = LOOKBACK_DAYS
) -> DataFrame:
    """Published on or after ``as_of - lookback_days``, or at an unknown time."""
    floor = moment(items, "published_at", as_of - timedelta(days=lookback_days))
    # one mention of the column: its parsing would be repeated for every mention
    return items.filter(F.coalesce("published_at", floor) >= floor)


def first_wins(items: DataFrame) -> DataFrame:
    """One row per video, the first in (target, document, feed) order.

    A keyed minimum: every task reduces its own rows first, so a video that
    fills a third of the feed reaches the shuffle as one row per task.
    """
    rest = [c for c in items.columns if c != "video_id"]
    first = F.min_by(F.struct(*rest), F.struct(*_feed_order(items))).alias("first")
    return items.groupBy("video_id").agg(first).select("video_id", "first.*")


def newest_feed_order(items: DataFrame) -> list:
    """Newest first, ties in feed order."""
    return [F.col("published_at").desc_nulls_last(), *_feed_order(items), F.col("video_id")]


def newest(items: DataFrame, max_items: int | None = None) -> DataFrame:
    """The newest ``max_items``, ties in feed order; all of them without a number."""
    if max_items is None:
        return items
    return items.orderBy(*newest_feed_order(items)).limit(max_items)


def unseen(items: DataFrame, episodes: DataFrame) -> DataFrame:
    """D10, the filter: items whose video is not in the state.

    The state is first reduced to the few ids that the items mention (a semi
    join that broadcasts the small side), so it is not shuffled for a small batch.
    """
    ids = items.select("video_id")
    known = episodes.select("video_id").join(ids, "video_id", "left_semi")
    return items.join(known, "video_id", "left_anti")


def next_id(table: DataFrame) -> Column:
    """One past the highest id, as a scalar subquery."""
    return F.coalesce(table.agg(F.max("id")).scalar(), F.lit(0)) + 1


def new_episodes(
    items: DataFrame, episodes: DataFrame, now: datetime, workdir: str, last_id: int = 0
) -> DataFrame:
    """The rows to insert, numbered in newest-first order of the batch, above the
    stored ids and ``last_id``."""
    start = F.greatest(next_id(episodes), F.lit(last_id + 1))
    fresh = unseen(items, episodes)
    return as_discovered(number_bulk(fresh, newest_feed_order(items), start, workdir), now)


def as_discovered(numbered: DataFrame, now: datetime) -> DataFrame:
    """Rows with ``id`` and feed attributes as complete new episode rows."""
    stamp = F.lit(now.isoformat()).cast(TimestampType())
    values = {
        "status": F.lit("discovered"),
        "attempts": F.lit(0),
        "distill_attempts": F.lit(0),
        "discovered_at": stamp,
    }
    return numbered.select(
        *[
            values.get(f.name, F.col(f.name) if f.name in numbered.columns else F.lit(None))
            .cast(f.dataType.simpleString())
            .alias(f.name)
            for f in schemas.EPISODES.fields
        ]
    )


def number_bulk(items: DataFrame, order: list, start, workdir: str) -> DataFrame:
    """Consecutive ids for any number of rows in a global order.

    Rows are range-partitioned by the (unique) order, sorted and written with
    their part number; part sizes give each part its offset. Only the list of
    part sizes meets in one task, and no part depends on how many rows share a
    date or channel.
    """
    spark = items.sparkSession
    parts = items.repartitionByRange(*order).withColumn("part", F.spark_partition_id())
    parts.write.mode("overwrite").parquet(f"{workdir}/parts")
    stored = spark.read.schema(parts.schema).parquet(f"{workdir}/parts")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        stored.groupBy("part")
        .agg(F.count("*").alias("rows"))
        .select("part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"))
    )
    within = F.row_number().over(Window.partitionBy("part").orderBy(*order))
    placed = stored.withColumn("place", within).join(offsets, "part")
    return placed.withColumn("id", F.col("offset") + F.col("place") - 1 + start).drop(
        "part", "place", "offset"
    )


def discovery_counts(items: DataFrame, fresh: DataFrame) -> DataFrame:
    """One row with the kept and the inserted number."""
    return items.agg(F.count("*").alias("crawled")).select(
        "crawled", fresh.agg(F.count("*")).scalar().alias("new")
    )
