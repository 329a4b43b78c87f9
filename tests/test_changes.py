"""Composed changes against the changes applied one after another."""

import random
from datetime import datetime

from pyspark.sql import functions as F

from reelmill import schemas
from reelmill.operators import changes as ch

NOW = datetime(2024, 5, 1, 10, 0, 0)


def apply(row, op, seq):
    """One change, by the rules of U1-U7 and F6, on a dictionary."""
    if op == "fetched":
        row |= {"status": "fetched", "raw_char_count": seq, "content_hash": f"h{seq}", "last_error": None, "fetched_at": NOW}
        row["duration_seconds"] = seq if seq % 2 else row["duration_seconds"]
    elif op == "skipped":
        row |= {"status": "skipped", "last_error": f"r{seq}"}
        row["duration_seconds"] = seq if seq % 3 else row["duration_seconds"]
    elif op == "status":
        row |= {"status": "failed", "last_error": None if seq % 2 else f"e{seq}", "attempts": row["attempts"] + seq % 3}
    elif op == "job":
        row["distill_job_id"] = f"j{seq}" if seq % 4 else None
    elif op == "bump":
        row["distill_attempts"] += 1
    elif op == "touch":
        row["distilled_at"] = NOW
    elif op == "failed":
        row |= {"status": "failed", "last_error": f"f{seq}", "distill_job_id": None}
        row["distill_attempts"] += 1
    elif op == "reprocess" and row["raw_char_count"] is not None:
        row |= {"status": "fetched", "last_error": None, "distill_job_id": None, "distill_attempts": 0}
    elif op == "reset":
        row |= dict.fromkeys(("raw_char_count", "content_hash", "last_error", "distill_job_id", "fetched_at", "distilled_at"))
        row |= {"status": "discovered", "distill_attempts": 0}


def as_patches(rows):
    seq = F.col("seq")
    of = {
        "fetched": lambda r: ch.fetched_patches(
            r.select(
                "id", "seq", seq.alias("raw_char_count"), F.concat(F.lit("h"), "seq").alias("content_hash"),
                *[F.lit(None).alias(c) for c in ("text_version", "transcript_language", "transcript_source")],
                F.when(seq % 2 == 1, seq).alias("duration_seconds"),
            ), NOW,
        ),
        "skipped": lambda r: ch.skipped_patches(
            r.select("id", "seq", F.when(seq % 3 > 0, seq).alias("duration_seconds"), F.concat(F.lit("r"), "seq").alias("reason"))
        ),
        "status": lambda r: ch.status_patches(
            r.select(
                "id", "seq", F.lit("failed").alias("status"), (seq % 3).alias("bump"),
                F.when(seq % 2 == 0, F.concat(F.lit("e"), "seq")).alias("last_error"),
            )
        ),
        "job": lambda r: ch.job_patches(r.withColumn("distill_job_id", F.when(seq % 4 > 0, F.concat(F.lit("j"), "seq")))),
        "bump": ch.bump_patches,
        "touch": lambda r: ch.touch_patches(r, NOW),
        "failed": lambda r: ch.failed_patches(r.withColumn("error", F.concat(F.lit("f"), "seq")), 500),
        "reprocess": ch.reprocess_patches,
        "reset": ch.reset_patches,
    }
    whole = None
    for op, build in of.items():
        part = build(rows.filter(F.col("op") == op))
        whole = part if whole is None else whole.unionByName(part)
    return whole


COLUMNS = "status last_error distill_job_id distill_attempts attempts raw_char_count content_hash duration_seconds fetched_at distilled_at".split()


def test_composed_changes_equal_their_sequence(spark):
    rng = random.Random(5)
    ops = ["fetched", "skipped", "status", "job", "bump", "touch", "failed", "reprocess", "reset"]
    changes = [(rng.randrange(60), seq, rng.choice(ops)) for seq in range(700)]
    changes += [(7, seq, "bump") for seq in range(1000, 3000)]  # one id has most of the changes
    state = [
        {
            "id": i, "video_id": f"v{i}", "channel_slug": "c", "source_url": "u", "status": "failed", "attempts": i % 4,
            "distill_attempts": i % 5, "distill_job_id": f"old{i}" if i % 2 else None, "last_error": "old",
            "raw_char_count": 9 if i % 3 else None, "duration_seconds": i, "fetched_at": None, "distilled_at": None,
            "content_hash": None,
        }
        for i in range(50)
    ]
    frame = spark.createDataFrame([tuple(r.get(f) for f in schemas.EPISODES.names) for r in state], schemas.EPISODES)
    rng.shuffle(changes)
    made = as_patches(spark.createDataFrame(changes, "id long, seq long, op string").repartition(5))
    one = ch.compose(made, frame)
    assert one.count() == one.select("id").distinct().count() <= 60
    got = {r.id: tuple(r[c] for c in COLUMNS) for r in ch.apply_patches(frame, one).collect()}
    for row in state:
        for _, seq, op in sorted((c for c in changes if c[0] == row["id"]), key=lambda c: c[1]):
            apply(row, op, seq)
        assert got[row["id"]] == tuple(row[c] for c in COLUMNS)


def test_nothing_to_compose(spark):
    frame = spark.createDataFrame([], schemas.EPISODES)
    empty = as_patches(spark.createDataFrame([], "id long, seq long, op string"))
    assert ch.compose(empty, frame).count() == 0
    some = as_patches(spark.createDataFrame([(1, 1, "reset")], "id long, seq long, op string"))
    assert ch.apply_patches(frame, ch.compose(some, frame)).count() == 0
