"""Run bookkeeping: one row per date."""

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelmill.functions.times import moment
from reelmill.operators.changes import new, update_rows
from reelmill.schemas import RUN_COUNTERS

NOTE_ERROR_CHARS = 500


def _stamp(runs: DataFrame, now: datetime) -> Column:
    return moment(runs, "last_heartbeat", now)


def start_runs(runs: DataFrame, dates: DataFrame, now: datetime) -> DataFrame:
    """A row for every ``run_date``; existing rows keep counters and notes."""
    started = dates.select("run_date").distinct().withColumn("started", F.lit(True))
    joined = runs.withColumn("stored", F.lit(True)).join(started, "run_date", "full_outer")
    hit, fresh = F.col("started").isNotNull(), F.col("stored").isNull()
    stamp = _stamp(runs, now)
    values = {
        "run_date": F.col("run_date"),
        "status": F.when(hit, "running").otherwise(F.col("status")),
        "last_heartbeat": F.when(hit, stamp).otherwise(F.col("last_heartbeat")),
        "created_at": F.when(fresh, stamp).otherwise(F.col("created_at")),
        "updated_at": F.when(hit, stamp).otherwise(F.col("updated_at")),
        "notes": F.col("notes"),
        **{c: F.coalesce(c, F.lit(0)) for c in RUN_COUNTERS},
    }
    return joined.select(
        *[values[f.name].cast(f.dataType.simpleString()).alias(f.name) for f in runs.schema.fields]
    )


def add_counters(runs: DataFrame, deltas: DataFrame, now: datetime) -> DataFrame:
    """R2: add counter deltas to existing rows; a date without a row is ignored.

    ``deltas``: run_date and any of the five counters; several rows per date add up.
    """
    given = [c for c in RUN_COUNTERS if c in deltas.columns]
    summed = deltas.groupBy("run_date").agg(
        *[F.sum(F.coalesce(c, F.lit(0))).alias(c) for c in given]
    )
    return update_rows(
        runs,
        summed,
        {
            **{c: F.col(c) + new(c) for c in given},
            "updated_at": _stamp(runs, now),
            "last_heartbeat": _stamp(runs, now),
        },
        key="run_date",
    )


def finish_runs(runs: DataFrame, finishes: DataFrame, now: datetime) -> DataFrame:
    """R3. ``finishes``: run_date, status, notes (JSON text; null becomes ``{}``)."""
    return update_rows(
        runs,
        finishes,
        {
            "status": new("status"),
            "notes": F.coalesce(new("notes"), F.lit("{}")),
            "updated_at": _stamp(runs, now),
            "last_heartbeat": _stamp(runs, now),
        },
        key="run_date",
    )


def _one(counts: DataFrame, column: str) -> Column:
    """A number of a one-row counter frame, as a scalar subquery."""
    return counts.select(column).scalar()


def update_run(
    runs: DataFrame, run_date: date, now: datetime, assign: dict[str, Column]
) -> DataFrame:
    """R2, R3 for a single date: a projection, no join."""
    hit = F.col("run_date") == F.lit(run_date)
    stamps = {"updated_at": _stamp(runs, now), "last_heartbeat": _stamp(runs, now)}
    values = {**assign, **stamps}
    return runs.select(
        *[
            F.when(hit, values[f.name]).otherwise(F.col(f.name))
            .cast(f.dataType.simpleString())
            .alias(f.name)
            if f.name in values
            else F.col(f.name)
            for f in runs.schema.fields
        ]
    )


def start_run(runs: DataFrame, run_date: date, now: datetime) -> DataFrame:
    """R1 for a single date."""
    dates = runs.sparkSession.createDataFrame([(run_date,)], "run_date date")
    missing = dates.join(runs.select("run_date"), "run_date", "left_anti")
    stamp = _stamp(runs, now)
    values = {
        "run_date": F.col("run_date"),
        "status": F.lit("running"),
        "created_at": stamp,
        **{c: F.lit(0) for c in RUN_COUNTERS},
    }
    added = missing.select(
        *[
            values.get(f.name, F.lit(None)).cast(f.dataType.simpleString()).alias(f.name)
            for f in runs.schema.fields
        ]
    )
    return update_run(runs.unionByName(added), run_date, now, {"status": F.lit("running")})


def discovery_run(
    runs: DataFrame, counts: DataFrame, run_date: date, now: datetime
) -> DataFrame:
    """A finished discovery pass; ``counts`` has crawled and new."""
    notes = counts.select(F.to_json(F.struct("crawled", "new")).alias("notes"))
    return update_run(
        start_run(runs, run_date, now),
        run_date,
        now,
        {
            "episodes_discovered": F.col("episodes_discovered") + _one(counts, "new"),
            "status": F.lit("success"),
            "notes": _one(notes, "notes"),
        },
    )


def failed_discovery_run(
    runs: DataFrame, run_date: date, error: str, now: datetime, error_chars: int = NOTE_ERROR_CHARS
) -> DataFrame:
    """A discovery pass that could not read its feeds."""
    return update_run(
        start_run(runs, run_date, now),
        run_date,
        now,
        {
            "failures": F.col("failures") + 1,
            "status": F.lit("failed"),
            "notes": F.to_json(F.struct(F.lit(error[:error_chars]).alias("error"))),
        },
    )


def record_stage(
    runs: DataFrame, counts: DataFrame, run_date: date, now: datetime, *names: str
) -> DataFrame:
    """Add the named counters and the failures of one pass to its run.

    A pass that counted nothing writes nothing, not even a heartbeat.
    """
    total = sum((F.col(c) for c in counts.columns), F.lit(0))
    used = [c for c in (*names, "failures") if c in counts.columns]
    counted = _one(counts.select(total.alias("total")), "total") > 0
    added = {c: F.col(c) + _one(counts, c) for c in used}
    stamps = {c: _stamp(runs, now) for c in ("updated_at", "last_heartbeat")}
    values = {
        c: F.when(counted, v).otherwise(F.col(c)) for c, v in {**added, **stamps}.items()
    }
    hit = F.col("run_date") == F.lit(run_date)
    return runs.select(
        *[
            F.when(hit, values[c]).otherwise(F.col(c)).alias(c) if c in values else F.col(c)
            for c in runs.columns
        ]
    )


def chain_result(discovered: DataFrame, fetched: DataFrame, submitted: DataFrame) -> DataFrame:
    """The counters of a full chain. Failures of both stages add up.

    Submitting collects nothing, so the chain has no ``distilled`` of its own.
    """

    return discovered.select(
        F.col("new").alias("episodes_discovered"),
        _one(fetched, "transcripts_fetched").alias("transcripts_fetched"),
        _one(fetched, "skipped").alias("skipped"),
        _one(fetched, "unavailable").alias("unavailable"),
        _one(submitted, "submitted").alias("submitted"),
        (_one(fetched, "failures") + _one(submitted, "failures")).alias("failures"),
    ).withColumn("status", F.when(F.col("failures") > 0, "partial").otherwise("success"))


def chain_run(runs: DataFrame, result: DataFrame, run_date: date, now: datetime) -> DataFrame:
    """Add the chain's counters (discovery has added its own) and finish."""
    fields = [c for c in result.columns if c != "status"]
    notes = result.select(F.to_json(F.struct(*fields)).alias("notes"))
    return update_run(
        runs,
        run_date,
        now,
        {
            **{c: F.col(c) + _one(result, c) for c in ("transcripts_fetched", "failures")},
            "status": _one(result, "status"),
            "notes": _one(notes, "notes"),
        },
    )
