"""One key with a third of all rows: results equal a plain loop over the rows."""

import json
import random
from datetime import datetime, timedelta

from test_operators import captions, episodes, moves

from reelmill.operators import discovery, transcripts

NOW = datetime(2024, 5, 1, 10, 0, 0)


def test_first_wins_with_a_hot_video(spark):
    rng = random.Random(1)
    rows = [
        ("hot" if i % 3 == 0 else f"v{rng.randrange(4000)}", rng.randrange(4), i)
        for i in range(30_000)
    ]
    best = {}
    for video, target, pos in sorted(rows, key=lambda r: (r[1], r[2])):
        best.setdefault(video, (target, pos))
    frame = spark.createDataFrame(rows, "video_id string, target_pos int, feed_pos int")
    got = discovery.first_wins(frame.repartition(8)).collect()
    assert {r.video_id: (r.target_pos, r.feed_pos) for r in got} == best


def test_flatten_a_hot_video(spark):
    rng = random.Random(2)
    rows, want = [], {}
    for video, size in [("hot", 15_000), *[(f"v{i}", 30) for i in range(1000)]]:
        kept = []
        for pos in range(size):
            text = rng.choice(["a", "a ", " b", "c\nd", "", None])
            rows.append((video, pos, text))
            line = " ".join((text or "").split())
            if line and (not kept or kept[-1] != line):
                kept.append(line)
        want[video] = "\n".join(kept)
    frame = spark.createDataFrame(rows, "video_id string, pos int, text string")
    got = transcripts.flatten_rows(frame.repartition(8)).collect()
    assert {r.video_id: r.raw_text for r in got} == want


def play(attempts, codes, limit=5):
    """Answers one by one, as single passes would take them."""
    status, text = "discovered", None
    for minute, code in enumerate(codes):
        waiting = status == "discovered" or (status == "failed" and attempts < limit)
        if not waiting:
            break
        if code == 200:
            status, text = "fetched", f"t{minute}"
        elif code == 429:
            status = "discovered"
        elif code == 404 and attempts + 1 >= limit:
            status = "skipped"
        else:
            status, attempts = "failed", attempts + 1
    return status, attempts, len(text) if text else None


def test_many_answers_for_one_video(spark):
    rng = random.Random(3)
    histories = {"hot": [429] * 1500 + [404] * 3 + [429] * 1500 + [200]}
    for i in range(150):
        histories[f"v{i}"] = [rng.choice([404, 429, 403, 200]) for _ in range(rng.randrange(1, 12))]
    start = [{"id": i, "video_id": v, "attempts": i % 5} for i, v in enumerate(histories)]
    rows = [
        (v, 0, code, captions(f"t{m}") if code == 200 else "{}", m)
        for v, codes in histories.items()
        for m, code in enumerate(codes)
    ]
    plain = spark.createDataFrame(
        [(v, s, NOW + timedelta(minutes=m), b if isinstance(b, str) else json.dumps(b))
         for v, _, s, b, m in rows],
        "video_id string, http_status int, received_at timestamp, body string",
    )
    _, after = moves(spark, episodes(spark, *start), plain)
    got = {r.video_id: (r.status, r.attempts, r.raw_char_count) for r in after.collect()}
    assert got == {
        v: play(i % 5, codes) for i, (v, codes) in enumerate(histories.items())
    }
