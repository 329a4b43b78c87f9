"""Plans have the shape that holds at scale."""

import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from reelmill.operators import changes, discovery, distill, queues, reports, transcripts
from reelmill.plans import catalog
from reelmill.plans import fixtures as fx

SF = "/root/testdata/sf0.001"


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def stored(spark, tmp_path):
    """Episodes, results and a change set as written tables."""
    fx.episodes(spark, SF, text=True).write.parquet(str(tmp_path / "ep"))
    fx.distillations(spark, SF).write.parquet(str(tmp_path / "di"))
    spark.range(5).write.parquet(str(tmp_path / "ch"))
    return [spark.read.parquet(str(tmp_path / n)) for n in ("ep", "di", "ch")]


def read_columns(plan):
    return [set(re.findall(r"(\w+):", s)) for s in re.findall(r"ReadSchema: struct<(.*)>", plan)]


def test_counts_read_narrow_columns(stored):
    plan = plan_of(reports.completed_counts(stored[0]))
    assert read_columns(plan) == [{"status", "last_error", "fetched_at", "distilled_at"}]


def test_queue_is_a_top_k_with_pushed_filter(stored):
    plan = plan_of(queues.pending_distill(stored[0], 200).select("id"))
    assert "TakeOrderedAndProject" in plan and "Exchange" not in plan
    assert "EqualTo(status,fetched), IsNotNull(distill_job_id)]" in plan


def test_date_range_reaches_the_scan(stored):
    plan = plan_of(queues.failed_candidates(stored[0], date(2024, 1, 3), date(2024, 1, 9)))
    assert "GreaterThanOrEqual(published_at,2024-01-03T00:00" in plan
    assert "LessThan(published_at,2024-01-10T00:00" in plan


@pytest.mark.parametrize("name", ["reset_full", "reset_for_reprocess", "delete_episodes"])
def test_small_change_set_leaves_state_in_place(stored, name):
    """No shuffle of the state: the checked-small side is broadcast."""
    plan = plan_of(getattr(changes, name)(stored[0], stored[2]))
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_large_change_set_is_not_broadcast(spark, stored):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(changes.reset_full(stored[0], stored[2]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_list_page_moves_no_text(stored):
    page = reports.list_episodes(stored[0], stored[1], page=3)
    assert "raw_text" not in plan_of(page.rows)


def test_stale_check_is_an_anti_join(stored):
    found = queues.reprocess_candidates(
        stored[0], stored[1], only_stale=True, model="m1", prompt_version="v1"
    )
    assert "LeftAnti" in plan_of(found)


def test_outcomes_need_no_texts(spark):
    """Counting or updating statuses builds and joins no transcript."""
    moves = transcripts.transitions(fx.response_queue(spark, SF), fx.responses(spark, SF))
    narrow = plan_of(transcripts.pass_counts(moves))
    assert "LeftOuter" not in narrow and "WindowGroupLimit" in narrow
    assert "LeftOuter" in plan_of(moves)


def test_first_wins_reduces_before_the_shuffle(spark):
    targets = discovery.with_channel_ref(discovery.channel_targets(spark, fx.CHANNELS))
    items = discovery.normalise_feed(discovery.join_feeds(targets, fx.feed(spark, SF)))
    plan = plan_of(discovery.first_wins(items))
    assert "partial_min_by" in plan and plan.count("Exchange hashpartitioning") == 1
    assert "BroadcastHashJoin" in plan


def test_upsert_leaves_stored_results_in_place(stored):
    batch = stored[1].limit(3).drop("id", "is_current", "created_at").withColumn("seq", F.lit(1))
    plan = plan_of(distill.upsert_results(stored[1], batch, fx.NOW))
    scans = [line for line in plan.splitlines() if "FileScan" in line and "key_topics" in line]
    assert scans and "SortMergeJoin" not in plan


def test_no_python_workers_and_no_cross_joins(spark):
    for name, run in catalog.queries().items():
        if name[0] in "sx" or name.startswith(("q6", "f9", "r13_summary_after")):
            continue  # these write while they are built
        plan = plan_of(run(spark, SF))
        for word in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert word not in plan, (name, word)


def test_pages_by_cursor_and_by_number(spark, stored, tmp_path):
    """Following cursors shows every row once, in order; a jump shows the same rows; a page
    by cursor is a top-k, one by number has no window over all rows."""
    episodes, results, _ = stored
    whole = [r.id for r in episodes.orderBy(*queues.newest_first()).select("id").collect()]
    shown, cursor = [], None
    while True:
        page = reports.list_after(episodes, results, cursor, 23)
        found = page.collect()
        if not found:
            break
        assert [r.id for r in found] == whole[len(shown) : len(shown) + 23]
        jumped = reports.list_page(episodes, results, len(shown) // 23 + 1, str(tmp_path / f"p{len(shown)}"), 23)
        assert [(r.id, r.pos) for r in jumped.collect()] == [(r.id, len(shown) + i + 1) for i, r in enumerate(found)]
        shown += [r.id for r in found]
        cursor = reports.Cursor(found[-1].published_at, found[-1].id)
    assert shown == whole
    assert "TakeOrderedAndProject" in plan_of(reports.list_after(episodes, results, reports.Cursor(None, 50), 5))


def test_wide_batch_leaves_stored_results_in_place(spark, stored, tmp_path):
    """a batch beyond the broadcast bound, but not its keys, moves no stored document."""
    rows = stored[1].drop("id", "is_current", "created_at").withColumn("seq", F.col("episode_id"))
    rows.write.parquet(f"{tmp_path}/batch")
    batch = spark.read.parquet(f"{tmp_path}/batch")
    batch.select(*distill.RESULT_KEY, "seq").write.parquet(f"{tmp_path}/keys")
    keys = spark.read.parquet(f"{tmp_path}/keys")
    bound = keys._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    usual = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(bound))
    try:
        plans = [plan_of(distill.upsert_results(stored[1], batch, fx.NOW, None, k)) for k in (None, keys)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", usual)
    moved = [[line for line in p.splitlines() if "SortMergeJoin" in line and "LeftAnti" in line] for p in plans]
    assert moved[0] and not moved[1]
