"""Batch updates of keyed state.

Each update is one left join of the state with a change set holding at most one
row per key. A change set below the broadcast threshold leaves the state where
it lies; a larger one is joined by shuffle. ``raw_text`` is carried only by
frames that have it (see schemas.EPISODES).

Several changes of one key are patches: rows of one shape, with a place in the key's
order, that :func:`compose` merges column by column into one change per key.
"""

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelmill import schemas
from reelmill.functions.times import moment

_HIT = "__hit"


def new(column: str) -> Column:
    """A column of the change set inside ``assign`` expressions."""
    return F.col(f"__new_{column}")


def update_rows(
    state: DataFrame, changes: DataFrame, assign: dict[str, Column], key: str = "id"
) -> DataFrame:
    """Rows of ``state`` whose key is in ``changes`` take the assigned values."""
    inbound = changes.select(
        key,
        F.lit(True).alias(_HIT),
        *[F.col(c).alias(f"__new_{c}") for c in changes.columns if c != key],
    )
    joined = state.join(inbound, key, "left")
    return joined.select(
        *[
            F.when(F.col(_HIT), assign[c]).otherwise(F.col(c)).cast(f.dataType.simpleString()).alias(c)
            if c in assign
            else F.col(c)
            for c, f in zip(state.columns, state.schema.fields)
        ]
    )


def last_per_key(changes: DataFrame, order: list[str], key: str = "id") -> DataFrame:
    """One change per key: the last in ``order`` (combined before the shuffle)."""
    rest = [c for c in changes.columns if c != key]
    newest = F.max_by(F.struct(*rest), F.struct(*order)).alias("last")
    return changes.groupBy(key).agg(newest).select(key, "last.*")


def _null() -> Column:
    return F.lit(None)


def has_text(episodes: DataFrame) -> Column:
    """Text presence without touching the text column where its length is stored."""
    column = "raw_char_count" if "raw_char_count" in episodes.columns else "raw_text"
    return F.col(column).isNotNull()


def mark_fetched(episodes: DataFrame, changes: DataFrame, now: datetime) -> DataFrame:
    """U1. ``changes``: id, raw_text, content_hash, transcript_language,
    transcript_source, duration_seconds."""
    return update_rows(
        episodes,
        changes,
        {
            "raw_text": new("raw_text"),
            "raw_char_count": F.length(new("raw_text")),
            "content_hash": new("content_hash"),
            "transcript_language": new("transcript_language"),
            "transcript_source": new("transcript_source"),
            "duration_seconds": F.coalesce(new("duration_seconds"), F.col("duration_seconds")),
            "status": F.lit("fetched"),
            "fetched_at": moment(episodes, "fetched_at", now),
            "last_error": _null(),
        },
    )


def mark_skipped(episodes: DataFrame, changes: DataFrame) -> DataFrame:
    """U2. ``changes``: id, duration_seconds, reason."""
    return update_rows(
        episodes,
        changes,
        {
            "status": F.lit("skipped"),
            "duration_seconds": F.coalesce(new("duration_seconds"), F.col("duration_seconds")),
            "last_error": new("reason"),
        },
    )


def set_status(episodes: DataFrame, changes: DataFrame) -> DataFrame:
    """U3. ``changes``: id, status, last_error, bump (number of attempts to add).

    The error is overwritten, also by null."""
    return update_rows(
        episodes,
        changes,
        {
            "status": new("status"),
            "last_error": new("last_error"),
            "attempts": F.col("attempts") + new("bump"),
        },
    )


def set_distill_job(episodes: DataFrame, changes: DataFrame) -> DataFrame:
    """U4. ``changes``: id, distill_job_id (null clears it)."""
    return update_rows(episodes, changes, {"distill_job_id": new("distill_job_id")})


def bump_distill_attempts(episodes: DataFrame, changes: DataFrame) -> DataFrame:
    """U5. ``changes``: id."""
    return update_rows(episodes, changes, {"distill_attempts": F.col("distill_attempts") + 1})


def touch_distilled(episodes: DataFrame, changes: DataFrame, now: datetime) -> DataFrame:
    """U5. ``changes``: id."""
    return update_rows(
        episodes, changes, {"distilled_at": moment(episodes, "distilled_at", now)}
    )


def reset_for_reprocess(episodes: DataFrame, changes: DataFrame) -> DataFrame:
    """U6. ``changes``: id. Rows without text stay as they are."""
    with_text = has_text(episodes)
    assign = {
        "status": F.lit("fetched"),
        "last_error": _null(),
        "distill_job_id": _null(),
        "distill_attempts": F.lit(0),
    }
    guarded = {c: F.when(with_text, v).otherwise(F.col(c)) for c, v in assign.items()}
    return update_rows(episodes, changes, guarded)


def reset_full(episodes: DataFrame, changes: DataFrame) -> DataFrame:
    """U7. ``changes``: id. Attempts and duration are kept."""
    cleared = (
        "raw_text raw_char_count text_version content_hash transcript_language transcript_source "
        "last_error distill_job_id fetched_at distilled_at"
    ).split()
    return update_rows(
        episodes,
        changes,
        {
            **{c: _null() for c in cleared},
            "status": F.lit("discovered"),
            "distill_attempts": F.lit(0),
        },
    )


def matched(episodes: DataFrame, changes: DataFrame, condition: Column | None = None):
    """How many rows an update hits (its returned flag, for a whole batch)."""
    hit = episodes if condition is None else episodes.filter(condition)
    return hit.join(changes.select("id"), "id", "left_semi").agg(F.count("*").alias("matched"))


def delete_episodes(episodes: DataFrame, changes: DataFrame) -> DataFrame:
    """U8. ``changes``: id."""
    return episodes.join(changes.select("id"), "id", "left_anti")


def delete_results(distillations: DataFrame, changes: DataFrame) -> DataFrame:
    """U8, the cascade: results of deleted episodes go with them."""
    gone = changes.select(F.col("id").alias("episode_id"))
    return distillations.join(gone, "episode_id", "left_anti").select(*distillations.columns)


# -- several changes per key ------------------------------------------------------

#: What patches can set, and which of the counters they can add to.
SETTABLE = (
    "status",
    "last_error",
    "distill_job_id",
    "distill_attempts",
    "raw_char_count",
    "text_version",
    "content_hash",
    "transcript_language",
    "transcript_source",
    "duration_seconds",
    "fetched_at",
    "distilled_at",
)
ADDABLE = ("attempts", "distill_attempts")


def patches(
    changes: DataFrame,
    sets: dict[str, Column],
    adds: dict[str, Column] | None = None,
    if_text: bool = False,
    unless_null: tuple[str, ...] = (),
) -> DataFrame:
    """``changes`` (id, seq, ..) in the shape that :func:`compose` takes.

    ``seq`` is the change's place among those of its id, and unique there. A column not
    in ``sets`` is left alone, and so is one of ``unless_null`` whose value is null. With
    ``if_text`` the change counts only where the episode has a text when its turn comes.
    """
    types = {f.name: f.dataType.simpleString() for f in schemas.EPISODES.fields}

    def cell(name: str) -> Column:
        if name not in sets:
            return F.lit(None).cast(f"struct<v:{types[name]}>").alias(name)
        value = sets[name].cast(types[name])
        boxed = F.struct(value.alias("v"))
        return (F.when(value.isNotNull(), boxed) if name in unless_null else boxed).alias(name)

    added = [(adds or {}).get(c, F.lit(0)).cast("int").alias(f"add_{c}") for c in ADDABLE]
    return changes.select("id", "seq", F.lit(if_text).alias("if_text"), *map(cell, SETTABLE), *added)


def fetched_patches(changes: DataFrame, now: datetime) -> DataFrame:
    """U1. ``changes`` also have raw_char_count and text_version (see schemas.TEXTS)."""
    kept = ("raw_char_count", "text_version", "content_hash", "transcript_language", "transcript_source", "duration_seconds")
    stamp = F.lit(now.isoformat()).cast("timestamp")
    sets = {c: F.col(c) for c in kept} | {"status": F.lit("fetched"), "fetched_at": stamp, "last_error": _null()}
    return patches(changes, sets, unless_null=("duration_seconds",))


def skipped_patches(changes: DataFrame) -> DataFrame:
    """U2."""
    sets = {"status": F.lit("skipped"), "duration_seconds": F.col("duration_seconds"), "last_error": F.col("reason")}
    return patches(changes, sets, unless_null=("duration_seconds",))


def status_patches(changes: DataFrame) -> DataFrame:
    """U3."""
    return patches(
        changes, {"status": F.col("status"), "last_error": F.col("last_error")}, {"attempts": F.col("bump")}
    )


def job_patches(changes: DataFrame) -> DataFrame:
    """U4."""
    return patches(changes, {"distill_job_id": F.col("distill_job_id")})


def bump_patches(changes: DataFrame) -> DataFrame:
    """U5, the counter."""
    return patches(changes, {}, {"distill_attempts": F.lit(1)})


def touch_patches(changes: DataFrame, now: datetime) -> DataFrame:
    """U5, the time."""
    return patches(changes, {"distilled_at": F.lit(now.isoformat()).cast("timestamp")})


def reprocess_patches(changes: DataFrame) -> DataFrame:
    """U6."""
    sets = {"status": F.lit("fetched"), "last_error": _null(), "distill_job_id": _null(), "distill_attempts": F.lit(0)}
    return patches(changes, sets, if_text=True)


def reset_patches(changes: DataFrame) -> DataFrame:
    """U7."""
    kept = ("status", "distill_attempts", "duration_seconds")
    sets = {c: _null() for c in SETTABLE if c not in kept}
    return patches(changes, sets | {"status": F.lit("discovered"), "distill_attempts": F.lit(0)})


def failed_patches(changes: DataFrame, error_chars: int) -> DataFrame:
    """F6. ``changes``: id, seq, error."""
    error = F.substring("error", 1, error_chars)
    sets = {"distill_job_id": _null(), "status": F.lit("failed"), "last_error": error}
    return patches(changes, sets, {"distill_attempts": F.lit(1)})


def _counting(rows: DataFrame, episodes: DataFrame) -> DataFrame:
    """Patches without those whose episode has no text when their turn comes.

    Text comes and goes with the patches before, else it is as in the state. Only the
    marks (id, seq, present) of the ids that are asked about are ordered.
    """
    asked = rows.filter("if_text").select("id").distinct()
    marks = rows.filter("if_text OR raw_char_count IS NOT NULL").join(asked, "id", "left_semi")
    present = F.when(F.col("raw_char_count").isNotNull(), F.col("raw_char_count.v").isNotNull())
    before = Window.partitionBy("id").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    turns = marks.select("id", "seq", "if_text", F.last(present, True).over(before).alias("present"))
    state = episodes.join(asked, "id", "left_semi").select("id", has_text(episodes).alias("stored"))
    without = turns.filter("if_text").join(state, "id", "left")
    without = without.filter(~F.coalesce("present", "stored", F.lit(False))).select("id", "seq")
    return rows.join(without, ["id", "seq"], "left_anti")


def compose(rows: DataFrame, episodes: DataFrame) -> DataFrame:
    """Patches -> one per id, equal to all of them in the order of ``seq``.

    Per column the last value set counts, and what was added to a counter since it was
    last set. Both are keyed aggregates that every task begins on its own rows, so an id
    with any number of patches reaches the shuffle as one row per task.
    """
    counting = _counting(rows, episodes)

    def last(name: str) -> Column:
        return F.max(F.when(F.col(name).isNotNull(), F.struct("seq", name))).alias(name)

    merged = counting.groupBy("id").agg(*map(last, SETTABLE))
    restarts = counting.filter("distill_attempts IS NOT NULL").groupBy("id").agg(F.max("seq").alias("since"))
    since = F.col("since").isNull() | (F.col("seq") > F.col("since"))
    added = (
        counting.filter("add_attempts <> 0 OR add_distill_attempts <> 0")
        .select("id", "seq", *[f"add_{c}" for c in ADDABLE])
        .join(restarts, "id", "left")
        .groupBy("id")
        .agg(
            F.sum("add_attempts").alias("add_attempts"),
            F.sum(F.when(since, F.col("add_distill_attempts"))).alias("add_distill_attempts"),
        )
    )
    sums = [F.coalesce(f"add_{c}", F.lit(0)).cast("int").alias(f"add_{c}") for c in ADDABLE]
    return merged.join(added, "id", "left").select("id", *[F.col(c)[c].alias(c) for c in SETTABLE], *sums)


def apply_patches(episodes: DataFrame, composed: DataFrame) -> DataFrame:
    """Composed patches on the state, in a single join; unknown ids are ignored."""

    def value(name: str) -> Column:
        kept = F.when(new(name).isNotNull(), new(name)["v"]).otherwise(F.col(name))
        return kept + new(f"add_{name}") if name in ADDABLE else kept

    names = [c for c in SETTABLE if c in episodes.columns]
    assign = {c: value(c) for c in names} | {"attempts": F.col("attempts") + new("add_attempts")}
    return update_rows(episodes, composed, assign)
