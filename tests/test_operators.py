"""Operators on small hand-made rows with hand-computed results."""

import json
from datetime import date, datetime

from pyspark.sql import functions as F

from reelmill import schemas
from reelmill.operators import changes as ch
from reelmill.operators import discovery, distill, queues, reports, runs, transcripts

NOW = datetime(2024, 5, 1, 10, 0, 0)


def episodes(spark, *rows):
    """Episode rows from dictionaries; everything else at its default."""
    full = [
        {
            "channel_slug": "c",
            "source_url": "u",
            "status": "discovered",
            "attempts": 0,
            "distill_attempts": 0,
            **row,
        }
        for row in rows
    ]
    values = [tuple(r.get(n) for n in schemas.EPISODES.names) for r in full]
    return spark.createDataFrame(values, schemas.EPISODES)


def responses(spark, *rows):
    """(video_id, minute, status, body) -> response documents."""
    values = [
        (v, s, datetime(2024, 5, 1, 0, m), b if isinstance(b, str) else json.dumps(b))
        for v, m, s, b in rows
    ]
    return spark.createDataFrame(
        values, "video_id string, http_status int, received_at timestamp, body string"
    )


def by(rows, key):
    return {r[key]: r for r in rows.collect()}


def captions(*lines, **more):
    return {"transcript": [{"text": t} for t in lines], "language": "en", **more}


# -- discovery ------------------------------------------------------------------


def targets_of(spark, spec, **more):
    return [
        (r.channel_id, r.channel_handle, r.channel_slug)
        for r in sorted(
            discovery.channel_targets(spark, spec, **more).collect(), key=lambda r: r.target_pos
        )
    ]


def test_channel_specs(spark):
    assert targets_of(spark, "cinema, bnn=id:UC1234567890") == [
        ("", "cinema", "cinema"),
        ("UC1234567890", "", "bnn"),
    ]
    assert targets_of(spark, " My Show=@@h=1 , ID: X_y ,, id: , @ ,=id:Q") == [
        ("", "h=1", "My Show"),
        ("X_y", "", "x-y"),
        ("Q", "", "q"),
    ]
    assert targets_of(spark, " , ", handle="h", slug="s") == [("", "h", "s")]
    assert targets_of(spark, "", channel_id="U", slug="s") == [("U", "", "s")]


def feed(spark, *rows):
    schema = (
        "channel string, feed_pos int, videoId string, title string, published string, "
        "link string, description string, thumbnail struct<url string>"
    )
    return spark.createDataFrame(
        [(c, i, v, f"t{i}", p, None, None, None) for i, (c, v, p) in enumerate(rows)], schema
    )


def discovered(spark, rows, spec, as_of, days=14, limit=80):
    targets = discovery.with_channel_ref(discovery.channel_targets(spark, spec))
    items = discovery.normalise_feed(discovery.join_feeds(targets, feed(spark, *rows)))
    recent = discovery.within_lookback(items, as_of, days)
    return discovery.newest(discovery.first_wins(recent), limit)


def test_old_rows_do_not_claim_ids(spark):
    rows = [
        ("@a", "v1", "2000-01-01T00:00:00Z"),
        ("@b", "v1", "2024-04-30T00:00:00Z"),
        ("@b", "v2", None),
        ("@a", " v3 ", "2024-04-29T00:00:00Z"),
        ("@b", "v3", "2024-04-30T12:00:00Z"),
        ("@a", "  ", "2024-04-30T12:00:00Z"),
        ("@other", "v9", "2024-04-30T12:00:00Z"),
    ]
    got = [(r.video_id, r.channel_slug) for r in discovered(spark, rows, "a, b", NOW).collect()]
    assert got == [("v1", "b"), ("v3", "a"), ("v2", "b")]
    first = discovered(spark, rows, "a, b", NOW, limit=1).collect()
    assert [r.video_id for r in first] == ["v1"]


def test_insert_only_new(spark, tmp_path):
    rows = [("@a", "v1", "2024-04-30T00:00:00Z"), ("@a", "v2", "2024-04-30T09:00:00Z"), ("@a", "v3", None)]
    known = episodes(spark, {"id": 41, "video_id": "v2"})
    fresh = discovery.new_episodes(discovered(spark, rows, "a", NOW), known, NOW, str(tmp_path / "a"))
    assert [(r.id, r.video_id, r.status) for r in fresh.orderBy("id").collect()] == [
        (42, "v1", "discovered"),
        (43, "v3", "discovered"),
    ]
    none = discovery.new_episodes(
        discovered(spark, rows, "a", NOW), episodes(spark), NOW, str(tmp_path / "b")
    )
    assert sorted(r.id for r in none.collect()) == [1, 2, 3]
    later = discovery.new_episodes(discovered(spark, rows, "a", NOW), known, NOW, str(tmp_path / "c"), 90)
    assert sorted(r.id for r in later.collect()) == [91, 92]


def test_bulk_numbers_are_dense_and_ordered(spark, tmp_path):
    rows = spark.range(5000).select(
        F.concat(F.lit("v"), "id").alias("video_id"), (F.col("id") * 7919 % 5000).alias("rank")
    )
    got = discovery.number_bulk(rows, ["rank"], F.lit(11), str(tmp_path)).select("id", "rank")
    assert [tuple(r) for r in got.orderBy("rank").collect()] == [(i + 11, i) for i in range(5000)]


# -- transcripts ------------------------------------------------------------------


def moves(spark, state, answers, **more):
    queue = queues.needing_transcript(state, None, more.get("max_attempts", 5))
    changes = transcripts.transitions(queue, answers, **more)
    return changes, transcripts.apply_transitions(state, changes, NOW)


def test_kinds(spark):
    answers = responses(
        spark,
        ("ok", 0, 200, captions("a", "a ", "b", length_seconds=5)),
        ("empty", 0, 200, captions(" ", " ")),
        ("gone", 0, 404, {"detail": "none"}),
        ("busy", 0, 429, "wait a while"),
        ("unpaid", 0, 402, {"detail": {"message": "no credits", "reason": "x"}}),
        ("denied", 0, 403, "{}"),
        ("list", 0, 200, "[1]"),
    )
    got = by(transcripts.classify(answers, F.array(F.lit("de-AT")), with_text=True), "video_id")
    assert {v: r.kind for v, r in got.items()} == {
        "ok": "ok", "empty": "unavailable", "gone": "unavailable", "busy": "transient",
        "unpaid": "transient", "denied": "error", "list": "unavailable",
    }
    assert got["ok"].text == "a\nb" and got["ok"].length_seconds == 5 and got["ok"].error is None
    assert got["empty"].error == "transcript unavailable for empty (de)"
    assert got["gone"].error == "transcript unavailable for gone (de): none"
    assert got["busy"].error == "transcriptapi 429 for busy: wait a while"
    assert got["unpaid"].error == "transcriptapi 402 for unpaid: no credits"
    assert got["denied"].error == "transcriptapi 403 for denied: "


def test_duration_gates(spark):
    state = episodes(spark, *[{"id": i, "video_id": f"v{i}"} for i in range(5)])
    lengths = {0: 601, 1: 120, 2: 300, 3: None, 4: 200}
    answers = responses(
        spark,
        *[(f"v{i}", 0, 200, captions("x", length_seconds=n)) for i, n in lengths.items()],
    )
    changes, after = moves(spark, state, answers, min_seconds=200, max_seconds=600)
    rows = by(after, "id")
    assert [rows[i].status for i in range(5)] == [
        "skipped", "skipped", "fetched", "fetched", "fetched",
    ]
    assert rows[0].last_error == "above 600s maximum (601s)" and rows[0].duration_seconds == 601
    assert rows[1].last_error == "below 200s minimum (120s)"
    assert rows[1].raw_char_count is None and rows[2].raw_char_count == 1
    assert rows[2].fetched_at == NOW and rows[2].transcript_source == "transcriptapi"
    counts = transcripts.pass_counts(changes).first().asDict()
    assert counts == {"transcripts_fetched": 3, "skipped": 2, "unavailable": 0, "failures": 0}
    _, all_kept = moves(spark, state, answers)
    assert {r.status for r in all_kept.collect()} == {"fetched"}


def test_rate_limit_keeps_episode_and_attempts(spark):
    state = episodes(spark, {"id": 1, "video_id": "v"})
    changes, after = moves(spark, state, responses(spark, ("v", 0, 429, "{}")))
    row = after.first()
    assert (row.status, row.attempts) == ("discovered", 0)
    assert transcripts.pass_counts(changes).first().failures == 1


def test_unavailable_is_retried_then_skipped(spark):
    """One answer per pass: attempts 1 to 4, then skipped without another try."""
    state = episodes(spark, {"id": 1, "video_id": "v"})
    seen = []
    for i in range(6):
        changes, after = moves(spark, state, responses(spark, ("v", i, 404, "{}")))
        row = after.first()
        seen.append((row.status, row.attempts))
        state = spark.createDataFrame([tuple(row)], schemas.EPISODES)
    assert seen == [("failed", n) for n in (1, 2, 3, 4)] + [("skipped", 4)] * 2


def test_many_answers_at_once_equal_one_by_one(spark):
    """A batch with several answers per video ends like single passes."""
    histories = {
        "a": [404, 404, 404, 404, 404, 404],
        "b": [429, 404, 200, 404],
        "c": [500, 500],
        "d": [403] * 7,
        "e": [404, 429],
        "f": [403, 429, 404, 403, 200],
        "g": [429, 403, 403, 429, 404, 404, 429, 200],
    }
    start = {v: {"id": i, "video_id": v, "attempts": i % 3} for i, v in enumerate(histories)}
    rows = [
        (v, m, s, captions(f"t{m}") if s == 200 else "{}")
        for v, codes in histories.items()
        for m, s in enumerate(codes)
    ]
    _, at_once = moves(spark, episodes(spark, *start.values()), responses(spark, *rows, *rows))
    state = episodes(spark, *start.values())
    for minute in range(8):
        step = [r for r in rows if r[1] == minute]
        _, state = moves(spark, state, responses(spark, *step))
        state = spark.createDataFrame([tuple(r) for r in state.collect()], schemas.EPISODES)
    picked = ["id", "status", "attempts", "last_error", "raw_char_count", "content_hash"]
    assert sorted(at_once.select(*picked).collect()) == sorted(state.select(*picked).collect())


def test_error_is_cut(spark):
    state = episodes(spark, {"id": 1, "video_id": "v"})
    _, after = moves(spark, state, responses(spark, ("v", 0, 403, {"detail": "x" * 900})))
    assert len(after.first().last_error) == 500


def test_flatten_rows_across_chunks(spark, monkeypatch):
    monkeypatch.setattr(transcripts, "CHUNK", 2)
    cases = {
        "a": ["x", "x", "x", "x", "x"],
        "b": ["x", " ", " ", "", "x", "y", "y", "y", "z"],
        "c": ["a", "b", "b", "a", "a", None, "a", "b"],
        "d": [" "],
    }
    rows = [(v, i, t) for v, lines in cases.items() for i, t in enumerate(lines)]
    got = transcripts.flatten_rows(
        spark.createDataFrame(rows, "video_id string, pos int, text string")
    )
    assert {r.video_id: r.raw_text for r in got.collect()} == {
        "a": "x",
        "b": "x\ny\nz",
        "c": "a\nb\na\nb",
    }


# -- queues and resets ----------------------------------------------------------------


def test_queue_rules(spark):
    state = episodes(
        spark,
        {"id": 1, "video_id": "a"},
        {"id": 2, "video_id": "b", "status": "failed", "attempts": 4},
        {"id": 3, "video_id": "c", "status": "failed", "attempts": 5},
        {"id": 4, "video_id": "d", "status": "failed", "raw_char_count": 3, "distill_attempts": 9},
        {"id": 5, "video_id": "e", "status": "failed", "raw_char_count": 3, "distill_job_id": "j"},
        {"id": 6, "video_id": "f", "status": "fetched", "raw_char_count": 3, "published_at": NOW},
        {"id": 7, "video_id": "g", "status": "fetched", "raw_char_count": 3, "distill_job_id": "j"},
    )
    ids = lambda df: [r.id for r in df.collect()]
    assert sorted(ids(queues.needing_transcript(state))) == [1, 2]
    assert ids(queues.needing_transcript(state, 1)) == [2] and ids(queues.needing_transcript(state, 9)) == [2, 1]
    assert sorted(ids(queues.needing_distill(state))) == [4, 6] and ids(queues.needing_distill(state, 9)) == [6, 4]
    assert ids(queues.needing_distill(state, max_attempts=9)) == [6]
    assert ids(queues.pending_distill(state)) == [7]
    assert ids(queues.failed_candidates(state)) == [2, 3, 4, 5]
    assert ids(queues.failed_candidates(state, from_date=date(2024, 1, 1))) == []


def test_resets(spark):
    state = episodes(
        spark,
        {"id": 1, "video_id": "a", "status": "done", "raw_char_count": 3, "attempts": 2,
         "distill_attempts": 3, "distilled_at": NOW, "duration_seconds": 9},
        {"id": 2, "video_id": "b", "status": "failed", "last_error": "e"},
    )
    ids = state.select("id")
    soft = by(ch.reset_for_reprocess(state, ids), "id")
    assert (soft[1].status, soft[1].distill_attempts, soft[1].distilled_at) == ("fetched", 0, NOW)
    assert (soft[2].status, soft[2].last_error) == ("failed", "e")
    assert ch.matched(state, ids, ch.has_text(state)).first().matched == 1
    full = by(ch.reset_full(state, ids), "id")
    assert (full[1].status, full[1].attempts, full[1].duration_seconds) == ("discovered", 2, 9)
    assert full[1].raw_char_count is None and full[1].distilled_at is None


def test_last_change_per_key_wins(spark):
    rows = spark.createDataFrame(
        [(1, 1, "a"), (1, 3, "c"), (1, 2, "b"), (2, 1, "z")], "id int, n int, v string"
    )
    got = ch.last_per_key(rows, ["n"])
    assert sorted((r.id, r.v) for r in got.collect()) == [(1, "c"), (2, "z")]


# -- results ---------------------------------------------------------------------------


def results(spark, *rows):
    """(id, episode, model, prompt, current)"""
    return spark.createDataFrame(
        [(i, e, m, p, "s", [], [], None, "{}", "{}", None, c, NOW) for i, e, m, p, c in rows],
        schemas.DISTILLATIONS,
    )


def test_versioned_upsert(spark):
    old = results(
        spark, (1, 1, "m1", "v1", False), (2, 1, "m1", "v2", True), (3, 2, "m1", "v1", True)
    )
    batch = results(
        spark, (0, 1, "m1", "v1", True), (0, 1, "m2", "v1", True), (0, 4, "m1", "v1", True),
        (0, 4, "m1", "v1", True),
    ).drop("id", "is_current", "created_at")
    batch = batch.withColumn("seq", F.monotonically_increasing_id())
    merged = distill.upsert_results(old, batch, NOW).collect()
    current = {(r.episode_id, r.model, r.prompt_version) for r in merged if r.is_current}
    assert current == {(1, "m2", "v1"), (2, "m1", "v1"), (4, "m1", "v1")}
    assert len(merged) == 5 and len({r.id for r in merged}) == 5
    kept = {(r.episode_id, r.model, r.prompt_version): r.id for r in merged}
    assert kept[(1, "m1", "v1")] == 1 and kept[(1, "m1", "v2")] == 2
    again = distill.upsert_results(
        spark.createDataFrame(merged, schemas.DISTILLATIONS), batch, NOW
    )
    assert sorted(again.collect()) == sorted(merged)


def job(job_id, status, result=None, error=None):
    text = None if result is None else json.dumps(result)
    return (job_id, status, error, text, NOW)


def jobs(spark, *rows):
    return spark.createDataFrame(
        list(rows),
        "job_id string, status string, error string, result string, received_at timestamp",
    )


GOOD = {
    "request_id": "r1",
    "processing": {"model": "m1", "distill_prompt_version": "v1", "token_usage": {"t": 1}},
    "distillation": {"summary": "s", "key_topics": ["ai"], "segments": [{"a": 1}]},
}


def test_job_kinds(spark):
    def with_part(**part):
        return {**GOOD, "distillation": {**GOOD["distillation"], **part}}

    got = by(
        distill.classify_jobs(
            jobs(
                spark,
                job("ok", "succeeded", GOOD),
                job("bare", "succeeded", {"distillation": {}}),
                job("none", "succeeded", {"request_id": "r"}),
                job("null", "succeeded"),
                job("list", "succeeded", [1]),
                job("failed", "failed"),
                job("told", "failed", error="boom"),
                job("run", "running"),
                job("topics", "succeeded", with_part(key_topics=[1])),
                job("segs", "succeeded", with_part(segments=["x"])),
                job("empty", "succeeded", with_part(segments=[], key_topics=[])),
                job("model", "succeeded", {**GOOD, "processing": {"model": 3}}),
                job("proc", "succeeded", {**GOOD, "processing": None}),
            )
        ),
        "job_id",
    )
    assert {k: r.kind for k, r in got.items()} == {
        "ok": "ok", "bare": "ok", "none": "invalid", "null": "invalid", "list": "invalid",
        "failed": "failed", "told": "failed", "run": "pending", "topics": "invalid",
        "segs": "invalid", "empty": "ok", "model": "invalid", "proc": "ok",
    }
    assert got["failed"].error == "distill job failed failed" and got["told"].error == "boom"
    assert (got["bare"].model, got["bare"].summary, got["bare"].key_topics) == ("unknown", "", [])
    assert got["ok"].segments == ['{"a":1}'] and got["ok"].token_usage == '{"t":1}'


def test_refused_request_is_a_failed_attempt(spark):
    state = episodes(
        spark,
        {"id": 1, "video_id": "a", "status": "fetched", "raw_char_count": 2, "last_error": "old"},
        {"id": 2, "video_id": "b", "status": "fetched", "raw_char_count": 2},
    )
    receipts = spark.createDataFrame(
        [("a", "job-1", None), ("b", None, None)], "video_id string, job_id string, error string"
    )
    submitted = distill.submissions(state, "b", receipts=receipts)
    rows = by(distill.apply_submissions(state, submitted), "id")
    assert (rows[1].status, rows[1].distill_job_id, rows[1].last_error) == ("fetched", "job-1", None)
    assert (rows[2].status, rows[2].distill_attempts) == ("failed", 1)
    assert rows[2].last_error == distill.NO_JOB_ID
    assert distill.submit_counts(submitted).first().asDict() == {"submitted": 1, "failures": 1}


def test_request_document(spark):
    rows = spark.createDataFrame(
        [
            ("v", "T", "line\né \"q\"", "u", "c", None, None, "en", "s", NOW),
            ("w", None, None, "u", "c", None, None, None, None, None),
        ],
        "video_id string, title string, raw_text string, source_url string, channel_slug string, "
        "thumbnail_url string, description string, transcript_language string, "
        "transcript_source string, published_at timestamp",
    )
    first, second = [
        json.loads(r.request) for r in rows.select(distill.request_json().alias("request")).collect()
    ]
    assert first["text"] == "line\né \"q\"" and first["source_item_id"] == "v"
    assert first["observed_at"] == "2024-05-01T10:00:00+00:00"
    assert first["metadata"]["thumbnail_url"] is None and first["metadata"]["channel"] == "c"
    assert first["options"]["max_chunk_chars"] == 12000
    assert second["text"] == "" and second["title"] is None and "observed_at" not in second


# -- runs and reports -----------------------------------------------------------------------


def run_rows(spark, *rows):
    full = [{"status": "success", **dict.fromkeys(schemas.RUN_COUNTERS, 0), **r} for r in rows]
    values = [tuple(r.get(n) for n in schemas.INGEST_RUNS.names) for r in full]
    return spark.createDataFrame(values, schemas.INGEST_RUNS)


DAY = date(2024, 5, 1)


def test_run_row_life(spark):
    dates = spark.createDataFrame([(DAY,)], "run_date date")
    started = runs.start_runs(run_rows(spark), dates, NOW)
    assert started.first().status == "running" and started.first().failures == 0
    counted = runs.add_counters(started, dates.select("run_date", F.lit(3).alias("failures")), NOW)
    restarted = runs.start_runs(counted, dates, NOW)
    assert (restarted.first().failures, restarted.count()) == (3, 1)
    finish = dates.select("run_date", F.lit("partial").alias("status"), F.lit(None).cast("string").alias("notes"))
    done = runs.finish_runs(restarted, finish, NOW).first()
    assert (done.status, done.notes, done.failures) == ("partial", "{}", 3)


def test_counters_of_a_missing_date_vanish(spark):
    deltas = spark.createDataFrame([(DAY, 4)], "run_date date, distilled int")
    assert runs.add_counters(run_rows(spark), deltas, NOW).count() == 0


def test_failed_discovery(spark):
    row = runs.failed_discovery_run(run_rows(spark), DAY, "no route" + "x" * 600, NOW).first()
    assert (row.status, row.failures) == ("failed", 1)
    assert len(json.loads(row.notes)["error"]) == 500


def test_chain_is_partial_when_something_failed(spark):
    def one(**counts):
        return spark.createDataFrame([tuple(counts.values())], ", ".join(f"{c} int" for c in counts))

    fetched = one(transcripts_fetched=2, skipped=0, unavailable=0, failures=1)
    result = runs.chain_result(one(crawled=3, new=2), fetched, one(submitted=1, failures=1))
    row = result.first()
    assert (row.episodes_discovered, row.failures, row.status) == (2, 2, "partial")
    after = runs.chain_run(run_rows(spark, {"run_date": DAY}), result, DAY, NOW).first()
    assert (after.transcripts_fetched, after.failures, after.status) == (2, 2, "partial")
    assert json.loads(after.notes)["submitted"] == 1
    quiet = runs.chain_result(
        one(crawled=0, new=0), one(transcripts_fetched=0, skipped=0, unavailable=0, failures=0),
        one(submitted=0, failures=0),
    )
    assert quiet.first().status == "success"


def test_empty_pass_writes_no_delta(spark):
    before = run_rows(spark, {"run_date": DAY})

    def after(*counts):
        frame = spark.createDataFrame([counts], "distilled long, pending long")
        row = runs.record_stage(before, frame, DAY, NOW, "distilled").first()
        return row.distilled, row.last_heartbeat

    assert after(0, 0) == (0, None)
    assert after(0, 2) == (0, NOW)
    assert after(3, 0) == (3, NOW)


def test_stats_without_runs(spark):
    row = reports.stats(run_rows(spark), episodes(spark, {"id": 1, "video_id": "a"})).first()
    assert (row.failures, row.episodes_total, row.last_run_date) == (0, 1, None)
    assert reports.last_run(run_rows(spark)).count() == 0
    assert reports.totals(run_rows(spark)).first().failures == 0


def test_summary_episode_counts_win(spark):
    state = episodes(
        spark,
        {"id": 1, "video_id": "a", "status": "failed", "last_error": "boom", "fetched_at": NOW},
        {"id": 2, "video_id": "b", "status": "failed"},
        {"id": 3, "video_id": "c", "status": "skipped", "last_error": "Below 600s minimum (3s)"},
        {"id": 4, "video_id": "d", "status": "skipped",
         "last_error": "No transcript available for d"},
        {"id": 5, "video_id": "e", "status": "skipped", "last_error": "above 9s maximum (30s)"},
    )
    row = reports.summary(
        run_rows(spark, {"run_date": DAY, "failures": 50, "episodes_discovered": 7}), state
    ).first()
    assert row.asDict() == {
        "runs_total": 1, "episodes_discovered": 7, "reprocessed": 0, "episodes_total": 5,
        "transcripts_fetched": 1, "distilled": 0, "failures": 1, "duration_too_short": 1,
        "transcript_unavailable": 1,
    }


def test_pages(spark):
    state = episodes(spark, *[{"id": i, "video_id": f"v{i}"} for i in range(1, 61)])
    none = results(spark)

    def ids(**page):
        return [r.id for r in reports.list_episodes(state, none, **page).rows.collect()]

    assert ids() == list(range(60, 0, -1))
    assert ids(page=2) == list(range(35, 10, -1))
    assert ids(page=0, page_size=7) == list(range(60, 53, -1))
    assert len(ids(page_size=10000)) == 60
    page = reports.list_episodes(state, none, status="done", page=1)
    assert page.rows.count() == 0 and page.total.first().total == 0
