"""The quality cascade: SQL (in test_corpus), order of the rules, odd rows."""

import re
from collections import Counter

import pytest

from reelmill.llm import quality_rules as q

SF = "/root/testdata/sf0.01"


def test_measures():
    text = "a b c a b c\n\n x \nsame line\nsame line\n \t \nüñ #1 <b> 7|8 100%\x0b$"
    words = re.findall(r"[^ \t-\r]+", text)
    t = q.Text(text.encode())
    assert (t.n_words, t.word_chars) == (len(words), sum(map(len, words)))
    assert t.n_symbols == sum(ch in "#*$%&|<>" for ch in text)
    assert (len(t.lines), t.n_dup_lines) == (5, 1)
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    again = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    assert t.n_repeat_words == len(again)
    assert q.Text(b"x x x x").n_repeat_words == 4 and q.Text(b"x x x").n_repeat_words == 0
    assert q.Text(b"").n_words == q.Text(b"\n \n").n_dup_lines == 0


def test_order_is_rejections_per_second_of_what_is_left():
    # rule 0 rejects much but slowly; rule 2 rejects what rule 1 does, and a little more
    trial = q.Trial((8.0, 1.0, 1.5, 1.0), {0b0011: 50, 0b0110: 40, 0b0100: 5, 0b0001: 30, 0: 100})
    # per second: 10, 90, 30, 0; then of 30 + 5 texts: 30 / 8, -, 5 / 1.5, 0
    assert trial.order() == [1, 0, 2, 3]
    assert q.Trial((1.0, 1.0), {}).order() == [0, 1]


@pytest.mark.parametrize("order", [q.RULES, q.RULES[::-1]])
def test_verdict_does_not_depend_on_the_order(spark, order):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = q.cascade(docs, order).collect()
    texts = {r.doc_id: q.Text((r.text or "").encode()) for r in docs.collect()}
    assert len(rows) == len(texts)
    for r in rows:
        failed = [rule.name for rule in order if rule.rejects(texts[r.doc_id])]
        assert r.kept == (not failed) and r.rejected_by == (failed[0] if failed else None)
        assert r.n_tried == ([rule.name for rule in order].index(failed[0]) + 1 if failed else len(order))


def test_junk_goes_and_prose_stays(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = [r for r in q.cascade(docs, q.plan(docs), ["n_words"]).collect() if r.doc_id in labels and r.n_words >= 50]
    good = [r.kept for r in rows if labels[r.doc_id] == 1]
    bad = [r.kept for r in rows if labels[r.doc_id] == 0]
    assert sum(good) > 0.97 * len(good) and sum(bad) < 0.1 * len(bad)


def test_sample_is_bounded(spark):
    docs = spark.range(30_000).selectExpr("id AS doc_id", "repeat('word ', 60) AS text")
    assert 400 < q.sample(docs, 500).count() <= 1000
    assert q.sample(docs.selectExpr("repeat(text, 10) AS text"), 500, 2000).count() == 0


def test_odd_rows(odd, none):
    rows = q.cascade(odd, q.plan(odd), q.MEASURES).collect()
    assert len(rows) == odd.count() and sum(r.doc_id is None for r in rows) == 1
    by_id = {r.doc_id: r for r in rows}
    assert (by_id[3].n_words, by_id[3].kept) == (by_id[4].n_words, by_id[4].kept) == (0, False)
    assert by_id[0].kept and by_id[8].n_words == 30_000 and not by_id[8].kept  # few letters in number words
    assert not by_id[11].kept and by_id[11].word_chars == 20_000
    assert q.plan(none) == list(q.RULES)
    assert q.cascade(none, q.RULES, q.MEASURES).collect() == []
