"""The state store, the passes over it and the streams."""

import json
import os
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F
from test_operators import GOOD, captions

from reelmill import schemas
from reelmill.operators import changes as ch
from reelmill.operators import discovery, reports
from reelmill.plans import passes
from reelmill.sources import landed, outbox
from reelmill.sources.store import StateStore, Unit, Write
from reelmill.streaming import jobs as streams

NOW = datetime(2024, 5, 1, 10, 0, 0)
DAY = date(2024, 5, 1)
SETTINGS = passes.Settings(max_items=1000)


@pytest.fixture
def store(spark, tmp_path):
    return StateStore(spark, str(tmp_path / "state"), buckets=4)


def land(path, name, *documents):
    path.mkdir(exist_ok=True)
    lines = [d if isinstance(d, str) else json.dumps(d) for d in documents]
    (path / name).write_text("\n".join(lines) + "\n")
    # a stream takes files by age; names here are in landing order
    age = 1_700_000_000 + int(name.split(".")[0])
    os.utime(path / name, (age, age))


def feed_doc(channel, *videos, minute=0, published="2024-04-30T00:00:00Z"):
    return {
        "channel": channel,
        "received_at": f"2024-05-01T09:{minute:02d}:00Z",
        "results": [{"videoId": v, "title": f"T {v}", "published": published} for v in videos],
    }


def answer(video, status, body, minute=0):
    return {
        "video_id": video,
        "http_status": status,
        "received_at": f"2024-05-01T11:{minute:02d}:00Z",
        "body": body,
    }


def rows(frame, *columns):
    return sorted(tuple(r) for r in frame.select(*columns).collect())


def discover(store, path, name="discover", files=None):
    streams.discover(store, str(path), "a, b", NOW, DAY, SETTINGS, files, name).awaitTermination()


def run_row(store):
    return store.read("ingest_runs").first()


def test_empty_store(store):
    assert store.read("episodes").count() == 0
    assert store.pointer()["version"] == 0 and store.applied("x") == -1


def test_unpublished_version_is_not_read(store, spark):
    """A commit that dies before its record leaves the old state."""
    row = spark.range(1).select(
        F.lit(7).alias("id").cast("long"), F.lit(1).cast("long").alias("text_version"),
        F.lit("text").alias("raw_text"), F.lit(0).alias("bucket"),
    )
    store.commit({"texts": Write(row)})
    row.withColumn("raw_text", F.lit("lost")).drop("bucket").write.parquet(
        f"{store.root}/texts/v=00000002/bucket=0"
    )
    assert rows(store.read("texts"), "raw_text") == [("text",)]
    store.commit({"texts": Write(row.withColumn("raw_text", F.lit("next")), [0])})
    assert rows(store.read("texts"), "raw_text") == [("next",)]
    store.commit({"texts": Write(row.limit(0), [0])})
    assert store.read("texts").count() == 0


def test_feed_source_keeps_order_and_bad_lines(spark, tmp_path):
    land(tmp_path / "f", "1.json", feed_doc("@a", "v1", "v2"), "not json", {"channel": "@b"})
    docs = landed.read_feeds(spark, str(tmp_path / "f"))
    got = landed.feed_rows(docs).orderBy("feed_pos").collect()
    assert [(r.feed_pos, r.videoId) for r in got] == [(0, "v1"), (1, "v2")]
    assert [r.value for r in landed.unreadable(spark, str(tmp_path / "f")).collect()] == ["not json"]


def test_discovery_stream_in_batches_and_replayed(store, tmp_path):
    path = tmp_path / "feeds"
    land(path, "1.json", feed_doc("@a", "a", "b"))
    land(path, "2.json", feed_doc("@b", "b", "c", "c", minute=1))
    land(path, "3.json", feed_doc("@a", "a", minute=2), feed_doc("@zzz", "x", minute=3))
    discover(store, path, files=1)
    assert [r[0] for r in rows(store.read("episodes"), "video_id")] == ["a", "b", "c"]
    assert run_row(store).episodes_discovered == 3
    version = store.pointer()["version"]
    discover(store, path)  # nothing new has landed
    assert store.pointer()["version"] == version
    discover(store, path, name="replay")  # all files again under another name
    assert store.read("episodes").count() == 3
    assert run_row(store).episodes_discovered == 3 and run_row(store).status == "success"
    one = StateStore(store.spark, store.root + "-one", 4)
    discover(one, path)
    assert rows(one.read("episodes"), "video_id", "title") == rows(
        store.read("episodes"), "video_id", "title"
    )


def test_failed_discovery_is_recorded(store, spark, tmp_path):
    land(tmp_path / "feeds", "1.json", feed_doc("@a", "v"))
    gone = F.when(F.col("channel").isNotNull(), F.raise_error(F.lit("feed is gone"))).otherwise("")
    docs = landed.read_feeds(spark, str(tmp_path / "feeds")).withColumn("channel", gone)
    with pytest.raises(Exception, match="feed is gone"):
        passes.discover(store, docs, discovery.channel_targets(spark, "a"), NOW, DAY, SETTINGS)
    run = run_row(store)
    assert (run.status, run.failures, run.episodes_discovered) == ("failed", 1, 0)
    assert "feed is gone" in json.loads(run.notes)["error"] and store.read("episodes").count() == 0


def seed(store, tmp_path, *videos):
    land(tmp_path / "feeds", "1.json", feed_doc("@a", *videos))
    discover(store, tmp_path / "feeds")


HISTORY = [
    answer("a", 404, {"detail": "none"}, 1),
    answer("b", 429, "wait a while", 1),
    answer("a", 200, captions("one", "one", "two", length_seconds=50), 2),
    answer("c", 403, {}, 2),
    answer("b", 200, captions("b text"), 3),
    answer("c", 403, {}, 3),
    answer("unknown", 200, captions("x"), 3),
]
SHOWN = ["video_id", "status", "attempts", "last_error", "raw_char_count", "content_hash"]


def test_fetch_stream_is_the_same_in_any_batches(store, tmp_path):
    one = StateStore(store.spark, store.root + "-one", 4)
    for target in (store, one):
        seed(target, tmp_path, "a", "b", "c", "d")
    for i, doc in enumerate(HISTORY):
        land(tmp_path / "answers", f"{i}.json", doc)
    args = (str(tmp_path / "answers"), NOW, DAY, SETTINGS)
    streams.fetch(store, *args, files_per_batch=1).awaitTermination()
    streams.fetch(one, *args).awaitTermination()
    assert rows(store.read("episodes"), *SHOWN) == rows(one.read("episodes"), *SHOWN)
    assert [r[:3] for r in rows(one.read("episodes"), *SHOWN)] == [
        ("a", "fetched", 1), ("b", "fetched", 0), ("c", "failed", 2), ("d", "discovered", 0),
    ]
    full = reports.with_text(one.read("episodes"), one.read("texts"))
    assert rows(full, "video_id", "raw_text")[:2] == [("a", "one\ntwo"), ("b", "b text")]
    assert run_row(one).transcripts_fetched == 2


def test_replayed_batch_adds_nothing(store, tmp_path):
    """The same batch id again is skipped, counters included."""
    seed(store, tmp_path, "a", "b")
    land(tmp_path / "answers", "1.json", answer("a", 200, captions("t")))
    args = (store, str(tmp_path / "answers"), NOW, DAY, SETTINGS)
    streams.fetch(*args).awaitTermination()
    before = run_row(store)
    # a checkpoint lost after the commit replays batch 0
    second = StateStore(store.spark, store.root, 4)
    docs = landed.read_responses(store.spark, str(tmp_path / "answers"), stream=True)
    calls = []

    def apply(local, batch, applied):
        calls.append(applied)

    query = streams._drain(docs, second, "other", apply)
    query.awaitTermination()
    assert calls == [{"other": 0}] and store.applied("fetch") == 0
    passes.fetch(store, landed.read_responses(store.spark, args[1]), NOW, DAY, SETTINGS, None)
    after = run_row(store)
    assert (before.transcripts_fetched, after.transcripts_fetched) == (1, 1)


def fetched(store, tmp_path, *videos):
    seed(store, tmp_path, *videos)
    land(tmp_path / "answers", "1.json", *[answer(v, 200, captions(f"text {v}")) for v in videos])
    docs = landed.read_responses(store.spark, str(tmp_path / "answers"))
    passes.fetch(store, docs, NOW, DAY, SETTINGS)


def job_of(store, video):
    row = store.read("episodes").filter(F.col("video_id") == video).first()
    return row.distill_job_id


def collect(store, tmp_path, name, *documents):
    land(tmp_path / name, "1.json", *documents)
    docs = landed.read_jobs(store.spark, str(tmp_path / name))
    return passes.collect(store, docs, NOW, DAY, SETTINGS).first().asDict()


def test_submit_then_collect(store, tmp_path):
    fetched(store, tmp_path, "a", "b", "c")
    box = str(tmp_path / "outbox")
    counts = passes.submit(store, box, "b1", NOW, DAY, SETTINGS).first().asDict()
    assert counts == {"submitted": 3, "failures": 0}
    assert store.read("distillations").count() == 0
    sent = {json.loads(r.request)["source_item_id"]: r for r in outbox.sent_requests(store).collect()}
    assert json.loads(sent["a"].request)["text"] == "text a" and sent["a"].job_id == job_of(store, "a")
    again = passes.submit(store, box, "b2", NOW, DAY, SETTINGS).first().asDict()
    assert again == {"submitted": 0, "failures": 0}

    jobs = {v: job_of(store, v) for v in "abc"}
    counts = collect(
        store, tmp_path, "jobs",
        {"job_id": jobs["a"], "status": "succeeded", "result": GOOD, "received_at": "2024-05-01T12:00:00Z"},
        {"job_id": jobs["b"], "status": "failed", "error": "boom", "received_at": "2024-05-01T12:00:00Z"},
        {"job_id": jobs["c"], "status": "running", "received_at": "2024-05-01T12:00:00Z"},
    )
    assert counts == {"distilled": 1, "failures": 1, "pending": 1}
    state = {r.video_id: r for r in store.read("episodes").collect()}
    assert (state["a"].status, state["a"].distill_job_id) == ("done", None)
    assert (state["b"].status, state["b"].last_error, state["b"].distill_attempts) == ("failed", "boom", 1)
    assert (state["c"].status, state["c"].distill_job_id) == ("fetched", jobs["c"])
    result = store.read("distillations").first()
    assert json.loads(result.request_payload) == json.loads(sent["a"].request)
    assert json.loads(result.response_payload)["request_id"] == "r1" and result.is_current
    run = run_row(store)
    assert (run.transcripts_fetched, run.distilled, run.failures) == (3, 1, 1)

    done = store.read("episodes").filter("status = 'done'")
    counts = passes.reprocess(store, done, box, "b3", SETTINGS).first().asDict()
    assert counts == {"submitted": 1, "failures": 0, "reprocessed": 1}
    newer = {**GOOD, "processing": {**GOOD["processing"], "distill_prompt_version": "v2"}}
    ended = {"job_id": job_of(store, "a"), "status": "succeeded", "result": newer}
    assert collect(store, tmp_path, "jobs2", {**ended, "received_at": "2024-05-01T13:00:00Z"})["distilled"] == 1
    assert rows(store.read("distillations"), "prompt_version", "is_current") == [("v1", False), ("v2", True)]

    assert passes.delete(store, done.select("id")) == 1
    assert store.read("distillations").count() == 0 and store.read("episodes").count() == 2


def test_failing_jobs_are_submitted_up_to_the_limit(store, tmp_path):
    fetched(store, tmp_path, "a")
    sent = 0
    limited = passes.Settings(max_distill_attempts=2)
    for i in range(3):
        sent += passes.submit(store, str(tmp_path / "box"), f"b{i}", NOW, DAY, limited).first().submitted
        job = job_of(store, "a")
        if job:
            collect(store, tmp_path, f"jobs{i}", {"job_id": job, "status": "failed", "received_at": "2024-05-01T12:00:00Z"})
    row = store.read("episodes").first()
    assert (sent, row.distill_attempts, row.status) == (2, 2, "failed")


def test_requeue_and_retry(store, tmp_path, spark):
    fetched(store, tmp_path, "a", "b")
    land(tmp_path / "new", "1.json", answer("a", 200, captions("newer a"), 30), answer("b", 404, {}, 30))
    docs = landed.read_responses(spark, str(tmp_path / "new"))
    asked = spark.createDataFrame([("a",), ("b",), ("zz",)], "video_id string")
    box = str(tmp_path / "box")
    got, counts = passes.requeue(store, asked, docs, box, "r1", NOW, SETTINGS)
    assert rows(got, "video_id", "outcome") == [("a", "fetched"), ("b", "unavailable"), ("zz", "not_found")]
    counts = counts.first()
    assert counts.submitted == 1
    assert (counts.reprocessed, counts.transcripts_fetched, counts.unavailable, counts.failures) == (2, 1, 1, 0)
    assert job_of(store, "a") and not job_of(store, "b")
    sent = outbox.sent_requests(store).collect()
    assert [json.loads(r.request)["text"] for r in sent] == ["newer a"]
    # b has failed once; a limit of two deletes it when it fails again
    later = NOW + timedelta(hours=1)
    counts = passes.retry_failed(store, docs, later, SETTINGS, delete_after=2).first()
    assert (counts.retried, counts.deleted, counts.unavailable) == (1, 1, 1)
    assert rows(store.read("episodes"), "video_id") == [("a",)]


def test_chain_counts_once(store, tmp_path, spark):
    land(tmp_path / "feeds", "1.json", feed_doc("@a", "a", "b"))
    land(tmp_path / "answers", "1.json", answer("a", 200, captions("t")), answer("b", 403, {}))
    result = passes.run_chain(
        store,
        landed.read_feeds(spark, str(tmp_path / "feeds")),
        discovery.channel_targets(spark, "a"),
        landed.read_responses(spark, str(tmp_path / "answers")),
        str(tmp_path / "box"),
        "b1",
        NOW,
        DAY,
        SETTINGS,
    ).first()
    assert (result.episodes_discovered, result.transcripts_fetched, result.submitted) == (2, 1, 1)
    run = run_row(store)
    assert (run.episodes_discovered, run.transcripts_fetched, run.failures) == (2, 1, 1)
    assert run.status == "partial" and json.loads(run.notes)["failures"] == 1


def test_state_invariants(store, tmp_path):
    fetched(store, tmp_path, "a", "b", "c", "a")
    episodes = store.read("episodes")
    assert episodes.count() == episodes.select("video_id").distinct().count()
    assert episodes.count() == episodes.select("id").distinct().count()
    assert set(episodes.columns) == {*schemas.EPISODES.names, "bucket"}


def test_passes_under_one_batch_name_all_reach_the_outbox(store, tmp_path):
    fetched(store, tmp_path, "a", "b", "c")
    box = str(tmp_path / "outbox")
    one = passes.Settings(limit=1)
    for _ in range(3):
        passes.submit(store, box, "same", NOW, DAY, one)
    sent = [r.job_id for r in outbox.sent_requests(store).collect()]
    assert sorted(sent) == sorted(job_of(store, v) for v in "abc")


def test_receipts_delivered_twice_count_once(store, tmp_path):
    fetched(store, tmp_path, "a", "b")
    rows = [("a", "j1", None), ("a", "j1", None), ("a", None, "late refusal"), ("b", None, "no"), ("b", "", "no")]
    receipts = store.spark.createDataFrame(rows, "video_id string, job_id string, error string")
    counts = passes.submit(store, str(tmp_path / "outbox"), "b1", NOW, DAY, SETTINGS, receipts).first().asDict()
    assert counts == {"submitted": 1, "failures": 1}
    state = {r.video_id: r for r in store.read("episodes").collect()}
    assert len(state) == 2 == store.read("episodes").count()
    assert state["a"].distill_job_id == "j1" and state["b"].last_error == "no"


def test_answers_before_their_episode_wait_for_it(store, tmp_path):
    """The same state whether answers land before or after discovery, in any batches."""
    for i, doc in enumerate(HISTORY):
        land(tmp_path / "answers", f"{i}.json", doc)
    shown = {}
    for name, files, early in (("late", None, 0), ("early", 2, 1), ("mixed", None, 1)):
        one = StateStore(store.spark, f"{store.root}-{name}", 4)
        if not early:
            seed(one, tmp_path, "a", "b", "c")
        args = (one, str(tmp_path / "answers"), NOW, DAY, SETTINGS, files)
        streams.fetch(*args).awaitTermination()
        waiting = one.read("waiting_answers").count()
        assert waiting == (len(HISTORY) if early else 1)
        if early:
            seed(one, tmp_path, "a", "b", "c")
            streams.fetch(*args).awaitTermination()  # no new file lands
        assert rows(one.read("waiting_answers"), "video_id") == [("unknown",)]
        shown[name] = rows(one.read("episodes"), *SHOWN), run_row(one).transcripts_fetched
    assert shown["late"] == shown["early"] == shown["mixed"] and shown["late"][1] == 2


def test_job_results_before_the_submission_wait_for_it(store, tmp_path):
    fetched(store, tmp_path, "a", "b")
    receipts = store.spark.createDataFrame([("a", "j1"), ("b", "j2")], "video_id string, job_id string")
    receipts = receipts.withColumn("error", F.lit(None).cast("string"))
    end = {"job_id": "j1", "status": "succeeded", "result": GOOD, "received_at": "2024-05-01T12:00:00Z"}
    land(tmp_path / "jobs", "1.json", end, {"job_id": "j2", "status": "running"})
    args = (store, str(tmp_path / "jobs"), NOW, DAY, SETTINGS)
    streams.collect(*args).awaitTermination()
    assert rows(store.read("waiting_jobs"), "job_id") == [("j1",)]
    passes.submit(store, str(tmp_path / "box"), "b1", NOW, DAY, SETTINGS, receipts)
    land(tmp_path / "jobs", "2.json", {"job_id": "j2", "status": "failed", "error": "boom"})
    streams.collect(*args).awaitTermination()
    assert rows(store.read("episodes"), "video_id", "status") == [("a", "done"), ("b", "failed")]
    # a document that comes once more is not kept
    land(tmp_path / "jobs", "3.json", end)
    streams.collect(*args).awaitTermination()
    assert store.read("waiting_jobs").count() == 0 and store.read("distillations").count() == 1


def test_batch_fetch_counts_an_answer_once(store, tmp_path):
    seed(store, tmp_path, "a", "b")
    land(tmp_path / "answers", "1.json", answer("a", 404, {}), {"video_id": "b", "http_status": 404})
    docs = landed.read_responses(store.spark, str(tmp_path / "answers"))
    for limit in (200, 200, None):
        passes.fetch(store, docs, NOW, DAY, SETTINGS, limit)
    assert rows(store.read("episodes"), "video_id", "attempts") == [("a", 1), ("b", 1)]
    land(tmp_path / "answers", "2.json", answer("a", 404, {}, 5))
    docs = landed.read_responses(store.spark, str(tmp_path / "answers"))
    passes.fetch(store, docs, NOW, DAY, SETTINGS)
    assert rows(store.read("episodes"), "video_id", "attempts") == [("a", 2), ("b", 1)]


def test_deleted_episodes_leave_no_text(store, tmp_path):
    fetched(store, tmp_path, "a", "b", "c")
    gone = store.read("episodes").filter("video_id = 'b'").select("id")
    assert passes.delete(store, gone) == 1
    kept = reports.with_text(store.read("episodes"), store.read("texts"))
    assert rows(kept, "raw_text") == [("text a",), ("text c",)] and store.read("texts").count() == 2
    assert rows(store.read("used_answers"), "video_id") == [("a",), ("c",)]


def test_deleted_ids_are_not_given_again(store, tmp_path, spark):
    land(tmp_path / "feeds", "1.json", feed_doc("@a", "v1", "v2"))
    discover(store, tmp_path / "feeds")
    newest = store.read("episodes").agg(F.max("id")).first()[0]
    assert passes.delete(store, spark.createDataFrame([(newest,)], "id long")) == 1
    land(tmp_path / "feeds", "2.json", feed_doc("@a", "v3"))
    discover(store, tmp_path / "feeds")
    assert rows(store.read("episodes"), "id") == [(1,), (newest + 1,)]


def test_second_writer_of_a_version_is_refused(store, spark, monkeypatch):
    """Two commits from one version: the later fails and none of its rows is read."""
    def texts(number):
        return Write(
            spark.range(1).select(
                F.lit(number).cast("long").alias("id"), F.lit(1).cast("long").alias("text_version"),
                F.lit("text").alias("raw_text"), F.lit(0).alias("bucket"),
            )
        )

    late = StateStore(spark, store.root, buckets=4)
    before = late.pointer()
    monkeypatch.setattr(late, "pointer", lambda: before)
    store.commit({"texts": texts(1)})
    with pytest.raises(RuntimeError, match="another writer"):
        late.commit({"texts": texts(2)})
    assert rows(store.read("texts"), "id") == [(1,)]
    assert store.commit({"texts": texts(3)}) == 2
    assert rows(store.read("texts"), "id") == [(1,), (3,)]


# -- units: all or nothing, and nothing lost ---------------------------------------


def changed(work, column, value):
    """The whole episode table with one column set."""
    rows = work.read("episodes")
    kind = dict(rows.dtypes)[column]
    return {"episodes": Write(rows.withColumn(column, F.lit(value).cast(kind)), work.touched(rows))}


def test_update_of_an_overtaken_reader_is_refused(store, tmp_path):
    """Read, another's commit, own commit: refused; the other's update stays."""
    seed(store, tmp_path, "a", "b")
    late = StateStore(store.spark, store.root, 4)
    with pytest.raises(RuntimeError, match="another writer"), late.unit() as work:
        titles = changed(work, "title", "late")
        with store.unit() as first:
            first.commit(changed(first, "status", "fetched"))
        work.commit(titles)
    assert {r[0] for r in rows(store.read("episodes"), "status")} == {"fetched"}
    assert {r[0] for r in rows(store.read("episodes"), "title")} == {"T a", "T b"}
    base = store.pointer()["version"]
    with late.unit() as work:
        work.commit(changed(work, "title", "late"))
    with pytest.raises(RuntimeError, match="another writer"):
        store.commit(changed(store, "title", "old"), base=base)
    assert {r[0] for r in rows(store.read("episodes"), "status", "title")} == {"fetched"}
    assert {r[0] for r in rows(store.read("episodes"), "title")} == {"late"}


def test_unit_reads_its_own_writes_and_publishes_once(store, tmp_path):
    seed(store, tmp_path, "a")
    version = store.pointer()["version"]
    with store.unit() as work:
        work.commit(changed(work, "title", "x"))
        assert rows(work.read("episodes"), "title") == [("x",)]
        assert rows(store.read("episodes"), "title") == [("T a",)]
        with work.unit() as inner:
            inner.commit(changed(inner, "last_error", "y"))
        assert store.pointer()["version"] == version
    assert store.pointer()["version"] == version + 1
    assert rows(store.read("episodes"), "title", "last_error") == [("x", "y")]
    with pytest.raises(ValueError, match="half way"), store.unit() as work:
        work.commit(changed(work, "title", "z"))
        raise ValueError("half way")
    assert store.pointer()["version"] == version + 1 and rows(store.read("episodes"), "title") == [("x",)]


def sent_jobs(store):
    return sorted(r.job_id for r in outbox.sent_requests(store).collect())


def test_two_submitters_send_what_the_state_says(store, tmp_path, monkeypatch):
    """Both read one version: the second is refused, and its requests are not sent."""
    fetched(store, tmp_path, "a", "b")
    box = str(tmp_path / "outbox")
    other = StateStore(store.spark, store.root, 4)
    publish = Unit.publish

    def overtaken(unit):
        monkeypatch.setattr(Unit, "publish", publish)
        passes.submit(other, box, "b1", NOW, DAY, passes.Settings(limit=1))
        return publish(unit)

    monkeypatch.setattr(Unit, "publish", overtaken)
    with pytest.raises(RuntimeError, match="another writer"):
        passes.submit(store, box, "b1", NOW, DAY, SETTINGS)
    assert sent_jobs(store) == sorted(j for j in (job_of(store, "a"), job_of(store, "b")) if j)
    assert len(sent_jobs(store)) == 1
    passes.submit(store, box, "b1", NOW, DAY, SETTINGS)
    assert sent_jobs(store) == sorted([job_of(store, "a"), job_of(store, "b")])


def test_submit_that_dies_after_its_requests_is_repeated_once(store, tmp_path, monkeypatch):
    fetched(store, tmp_path, "a", "b")
    box = str(tmp_path / "outbox")

    def dies(unit):
        raise OSError("lost driver")

    with monkeypatch.context() as patched:
        patched.setattr(Unit, "publish", dies)
        with pytest.raises(OSError, match="lost driver"):
            passes.submit(store, box, "b1", NOW, DAY, SETTINGS)
    assert sent_jobs(store) == [] and job_of(store, "a") is None
    land(tmp_path / "feeds", "2.json", feed_doc("@a", "new"))
    discover(store, tmp_path / "feeds")
    passes.submit(store, box, "b1", NOW, DAY, SETTINGS)
    assert sent_jobs(store) == sorted([job_of(store, "a"), job_of(store, "b")])
    texts = sorted(json.loads(r.request)["text"] for r in outbox.sent_requests(store).collect())
    assert texts == ["text a", "text b"]


def test_reprocess_under_the_same_name_has_a_job_of_its_own(store, tmp_path):
    """The old job's document, collected again, ends nothing."""
    fetched(store, tmp_path, "a")
    box = str(tmp_path / "outbox")
    passes.submit(store, box, "same", NOW, DAY, SETTINGS)
    old = job_of(store, "a")
    end = {"job_id": old, "status": "succeeded", "result": GOOD, "received_at": "2024-05-01T12:00:00Z"}
    assert collect(store, tmp_path, "jobs", end)["distilled"] == 1
    before = store.pointer()["version"]
    counts = passes.reprocess(store, store.read("episodes"), box, "same", SETTINGS).first()
    assert (counts.submitted, store.pointer()["version"]) == (1, before + 1)
    new = job_of(store, "a")
    assert new and new != old
    docs = landed.read_jobs(store.spark, str(tmp_path / "jobs"))
    assert passes.collect(store, docs, NOW, DAY, SETTINGS).first().distilled == 0
    assert job_of(store, "a") == new and store.read("waiting_jobs").count() == 0


def chain(store, spark, tmp_path):
    return passes.run_chain(
        store,
        landed.read_feeds(spark, str(tmp_path / "feeds")),
        discovery.channel_targets(spark, "a"),
        landed.read_responses(spark, str(tmp_path / "answers")),
        str(tmp_path / "box"),
        "b1",
        NOW,
        DAY,
        SETTINGS,
    ).first()


def test_chain_that_dies_at_any_step_leaves_nothing(store, tmp_path, spark, monkeypatch):
    land(tmp_path / "feeds", "1.json", feed_doc("@a", "a", "b"))
    land(tmp_path / "answers", "1.json", answer("a", 200, captions("t")), answer("b", 403, {}))
    commit = Unit.commit
    for step in range(4):
        seen = []

        def dies(unit, *args, step=step, seen=seen, **kwargs):
            if len(seen) == step:
                raise OSError("lost driver")
            seen.append(1)
            return commit(unit, *args, **kwargs)

        with monkeypatch.context() as patched:
            patched.setattr(Unit, "commit", dies)
            with pytest.raises(OSError, match="lost driver"):
                chain(store, spark, tmp_path)
        assert store.pointer()["version"] == 0 and store.read("episodes").count() == 0
        assert store.read("ingest_runs").count() == 0 and sent_jobs(store) == []
    result = chain(store, spark, tmp_path)
    assert (result.episodes_discovered, result.transcripts_fetched, result.submitted, result.failures) == (2, 1, 1, 1)
    assert store.pointer()["version"] == 1 and sent_jobs(store) == [job_of(store, "a")]
    state = rows(store.read("episodes"), *SHOWN)
    again = chain(store, spark, tmp_path)
    assert (again.episodes_discovered, again.transcripts_fetched, again.submitted, again.failures) == (0, 0, 0, 0)
    assert rows(store.read("episodes"), *SHOWN) == state and run_row(store).failures == 1


def test_limit_leaves_answers_for_a_later_pass(store, tmp_path):
    """The same end whatever the limit; nothing that has landed is lost."""
    ends = {}
    for limit in (1, 2, None):
        one = StateStore(store.spark, f"{store.root}-{limit}", 4)
        seed(one, tmp_path, "a", "b", "c")
        path = tmp_path / f"answers-{limit}"
        land(path, "1.json", *[answer(v, 200, captions(f"t {v}")) for v in "abc"], answer("zz", 404, {}))
        docs = landed.read_responses(one.spark, str(path))
        counts = passes.fetch(one, docs, NOW, DAY, SETTINGS, limit).first()
        assert counts.transcripts_fetched == (limit or 3)
        assert one.read("waiting_answers").count() == 4 - (limit or 3)
        for _ in range(2):
            passes.fetch(one, None, NOW, DAY, SETTINGS, limit)
        assert rows(one.read("waiting_answers"), "video_id") == [("zz",)]
        ends[limit] = rows(one.read("episodes"), *SHOWN), run_row(one).transcripts_fetched
    assert ends[1] == ends[2] == ends[None] and ends[None][1] == 3


def test_receipt_stream_counts_each_receipt_once(store, tmp_path):
    """In any batches, twice, and after a crash between the requests and the commit."""
    said = [
        {"video_id": "a", "job_id": "j1"}, {"video_id": "b", "error": "full"}, {"video_id": "a", "job_id": "j1"},
        {"video_id": "b", "error": "full"}, {"video_id": "zz", "job_id": "j9"}, {"video_id": "c"},
    ]
    for i, receipt in enumerate(said):
        land(tmp_path / "receipts", f"{i}.json", receipt | {"received_at": "2024-05-01T12:00:00Z"})
    shown = {}
    for files in (None, 1):
        one = StateStore(store.spark, f"{store.root}-{files}", 4)
        fetched(one, tmp_path, "a", "b", "c")
        args = (one, str(tmp_path / "receipts"), str(tmp_path / f"box-{files}"), NOW, DAY, SETTINGS, files)
        streams.receipts(*args).awaitTermination()
        streams.receipts(*args, "again").awaitTermination()
        columns = ["video_id", "status", "distill_job_id", "distill_attempts", "last_error"]
        shown[files] = rows(one.read("episodes").fillna("-"), *columns), run_row(one).failures
        assert sent_jobs(one) == ["j1"]
    assert shown[None] == shown[1]
    state, failures = shown[1]
    assert state[0] == ("a", "fetched", "j1", 0, "-") and state[1] == ("b", "failed", "-", 1, "full")
    assert state[2][1:4] == ("failed", "-", 1) and failures == 2


def test_deletion_writes_no_text_until_it_is_folded_in(store, tmp_path):
    fetched(store, tmp_path, "a", "b", "c")
    before = store.pointer()["tables"]["texts"]
    passes.delete(store, store.read("episodes").filter("video_id = 'b'").select("id"))
    assert store.pointer()["tables"]["texts"] == before and store.read("texts").count() == 2
    buckets = passes.fold_deleted(store)
    assert len(buckets) == 1 and store.read("texts").count() == 2
    assert "deleted" not in store.pointer()["tables"] or not store.pointer()["tables"]["deleted"]
    stored = [f"{store.root}/texts/{v}/bucket={b}" for b, vs in store.pointer()["tables"]["texts"].items() for v in vs]
    assert store.spark.read.parquet(*stored).count() == 2
    assert passes.fold_deleted(store) == []
    passes.submit(store, str(tmp_path / "box"), "b", NOW, DAY, SETTINGS)  # from rewritten folders too
    assert len(sent_jobs(store)) == 2


def test_requests_read_only_the_folders_of_their_versions(store, tmp_path, spark):
    """No text is shuffled, and texts of other versions are not scanned."""
    seed(store, tmp_path, "a", "b", "c", "d")
    for i, video in enumerate("abcd"):
        land(tmp_path / video, "1.json", answer(video, 200, captions(f"text {video}"), i))
        passes.fetch(store, landed.read_responses(spark, str(tmp_path / video)), NOW, DAY, SETTINGS)
    with store.unit() as work:
        chosen = work.read("episodes").filter("video_id IN ('b', 'd')")
        chosen = work.stage(chosen.select("id", "bucket", F.col("video_id").alias("job_id")), "chosen")
        requests = passes._requests(work, chosen, SETTINGS)
        plan = requests._jdf.queryExecution().executedPlan().toString()
        files = [f for f in requests.inputFiles() if "/texts/" in f]
        assert rows(requests.selectExpr("get_json_object(request, '$.text') AS text"), "text") == [("text b",), ("text d",)]
    versions = {f.split("/texts/")[1].split("-")[0] for f in files}
    wanted = {r.text_version for r in store.read("episodes").filter("video_id IN ('b', 'd')").collect()}
    assert versions == {f"v={v:08d}" for v in wanted} and len(files) == 2
    assert "hashpartitioning" not in plan and "BroadcastHashJoin" in plan


def test_amended_store(store, tmp_path, spark):
    """Many ordered changes of one episode, one commit."""
    fetched(store, tmp_path, "a", "b")
    ids = {r.video_id: r.id for r in store.read("episodes").collect()}

    def of(video, seq, **columns):
        return spark.createDataFrame([(ids[video], seq)], "id long, seq long").withColumns(columns)

    version = store.pointer()["version"]
    one = ch.job_patches(of("a", 1, distill_job_id=F.lit("j1")))
    for more in (
        ch.failed_patches(of("a", 2, error=F.lit("boom")), 500),
        ch.bump_patches(of("a", 3)),
        ch.reprocess_patches(of("a", 4)),
        ch.bump_patches(of("a", 5)),
        ch.reset_patches(of("b", 1)),
        ch.reprocess_patches(of("b", 2)),  # b has no text by then
    ):
        one = one.unionByName(more)
    passes.amend(store, one)
    assert store.pointer()["version"] == version + 1
    state = {r.video_id: r for r in store.read("episodes").collect()}
    assert (state["a"].status, state["a"].distill_attempts, state["a"].distill_job_id) == ("fetched", 1, None)
    assert (state["b"].status, state["b"].raw_char_count, state["b"].text_version) == ("discovered", None, None)


def test_used_keys_are_only_added(store, tmp_path, spark):
    """What a batch writes beside the state is its own keys, whatever came before."""
    videos = [f"v{i}" for i in range(12)]
    seed(store, tmp_path, *videos)
    for i, video in enumerate(videos[:6]):
        land(tmp_path / f"b{i}", "1.json", answer(video, 404, {}, i), answer(f"early{i}", 404, {}, i))
        passes.fetch(store, landed.read_responses(spark, str(tmp_path / f"b{i}")), NOW, DAY, SETTINGS)
        version = store.pointer()["version"]
        for table, wanted in (("used_answers", [video]), ("waiting_answers", [f"early{i}"])):
            dirs = store.pointer()["tables"][table]
            new = [(b, f) for b, folders in dirs.items() for f in folders if f.startswith(f"v={version:08d}")]
            assert [r.video_id for r in store._folders(table, new).collect()] == wanted
    assert store.read("used_answers").count() == 6 == store.read("waiting_answers").count()
    before = rows(store.read("used_answers"), "video_id"), rows(store.read("waiting_answers"), "video_id")
    folded = passes.fold(store, 1)
    assert "used_answers" in folded and all(
        len(store.pointer()["tables"][t][str(b)]) == 1 for t, buckets in folded.items() for b in buckets
    )
    assert (rows(store.read("used_answers"), "video_id"), rows(store.read("waiting_answers"), "video_id")) == before
    assert passes.fold(store, 1) == {}


def test_answer_of_an_episode_that_needs_none_waits_no_more(store, tmp_path, spark):
    land(tmp_path / "early", "1.json", answer("a", 200, captions("one")), answer("a", 200, captions("two"), 1))
    passes.fetch(store, landed.read_responses(spark, str(tmp_path / "early")), NOW, DAY, SETTINGS)
    seed(store, tmp_path, "a")
    skipped = store.read("episodes").withColumn("status", F.lit("skipped"))
    store.commit({"episodes": Write(skipped, store.touched(skipped))})
    assert store.read("waiting_answers").count() == 2
    passes.fetch(store, None, NOW, DAY, SETTINGS)
    assert store.read("waiting_answers").count() == 0 and run_row(store).transcripts_fetched == 0
