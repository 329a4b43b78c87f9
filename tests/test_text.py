"""Text, language, time and payload functions against Python's own rules."""

import hashlib
import itertools
import re
from datetime import datetime, timezone

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from reelmill.functions import languages, payload, text, times


def column_of(spark, values, dtype, make):
    rows = spark.createDataFrame(
        [(i, v) for i, v in enumerate(values)], f"i int, v {dtype}"
    ).select("i", make(F.col("v")).alias("out"))
    return [r["out"] for r in sorted(rows.collect(), key=lambda r: r["i"])]


EDGES = [
    "", None, " a\tb\n\nc ", "a b", "a\x0bb", "a\x1cb", "a\x1fb", "a\x85b", "a b",
    "　a　", "a​b", "a﻿b", "a᠎b", "ΟΔΟΣ", "İ",
    "ẞ", "ǅ", "a   b", " x ", "\x1d\x1e", "A  B",
]


#: What the edges come to, worked out by hand.
NORMAL = [
    "", "", "a b c", "a b", "a b", "a b", "a b", "a b", "a b",
    "a", "a\u200bb", "a\ufeffb", "a\u180eb", "\u03bf\u03b4\u03bf\u03c2", "i\u0307",
    "\xdf", "\u01c6", "a b", "x", "", "a b",
]


def distinct_lines(lines):
    """Lines of single-spaced words, without blank ones and runs of one line."""
    spaced = (" ".join((line or "").split()) for line in lines)
    return "\n".join(line for line, _ in itertools.groupby(filter(None, spaced)))


def test_hash_edges(spark):
    assert column_of(spark, EDGES, "string", text.content_hash) == [
        hashlib.sha256(v.encode()).hexdigest() for v in NORMAL
    ]


def test_every_space_character(spark):
    """All of the basic plane: the class is exactly what Python calls space."""
    marks = [chr(i) for i in range(0x10000) if not 0xD800 <= i < 0xE000]
    got = column_of(spark, [f"a{m}{m}b" for m in marks], "string", text.squeeze)
    assert got == [re.sub(r"\s+", " ", f"a{m}{m}b") for m in marks]


def test_strip(spark):
    assert column_of(spark, EDGES, "string", text.strip) == [
        None if v is None else v.strip() for v in EDGES
    ]


FLATTENS = [
    ["a", "a", " ", "a", "b "], [None, "x", "x"], [], ["a", "b", "a"], [" ", "q\nq", "q q"],
    ["hello", "hello", "world"], None,
]


def test_flatten_edges(spark):
    got = column_of(spark, FLATTENS, "array<string>", text.flatten_segments)
    assert got == ["a\nb", "x", "", "a\nb\na", "q q", "hello\nworld", ""]


@settings(max_examples=5, deadline=None)
@given(
    st.lists(
        st.lists(st.one_of(st.none(), st.text(alphabet="ab \n  ", max_size=4)), max_size=8),
        min_size=1,
        max_size=40,
    )
)
def test_flatten_random(spark, cases):
    got = column_of(spark, cases, "array<string>", text.flatten_segments)
    assert got == [distinct_lines(v) for v in cases]


def test_slugify(spark):
    names = ["All In", "@@x--y", "___", "", "UC_1234", "Café 9", "-a-"]
    want = ["all-in", "x-y", "channel", "channel", "uc-1234", "caf-9", "a"]
    assert column_of(spark, names, "string", text.slugify) == want


def test_languages(spark):
    assert column_of(spark, ["en, en-US ,"], "string", languages.split_preference) == [
        ["en", "en-US"]
    ]
    cases = [
        ["en-orig", "en", "en-US", "asr"], ["", "EN", "asr-en", "-x"], [], None, [None, " "],
        [f"l{i}" for i in range(12)],
    ]
    assert column_of(spark, cases, "array<string>", languages.normalise_languages) == [
        ["en", "asr"], ["en", "asr-en"], ["en", "asr"], ["en", "asr"], ["en", "asr"],
        [f"l{i}" for i in range(10)],
    ]


PUBLISHED = {
    "2024-01-02T03:04:05Z": (3, 4, 5, 0),
    "2024-01-02T03:04:05.123456Z": (3, 4, 5, 123456),
    "2024-01-02T03:04:05,5Z": (3, 4, 5, 500000),
    "2024-01-02T03:04:05+02:00": (1, 4, 5, 0),
    "2024-01-02T03:04:05-0130": (4, 34, 5, 0),
    "2024-01-02T03:04:05": (3, 4, 5, 0),
    "2024-01-02 03:04:05.25": (3, 4, 5, 250000),
    "2024-01-02T03:04": (3, 4, 0, 0),
    "2024-01-02T03:04Z": (3, 4, 0, 0),
    "2024-01-02T03:04+01:00": (2, 4, 0, 0),
    "2024-01-02": (0, 0, 0, 0),
    "20240102T030405": (3, 4, 5, 0),
    "20240102T030405Z": (3, 4, 5, 0),
    "20240102T030405-0100": (4, 4, 5, 0),
}
NOT_PUBLISHED = ["2024", "2024-01", "2024-1-2T3:4:5Z", "", " ", "bad", "2024-13-40", None,
                 "2024-01-02T25:00:00Z", "2024-01-02T03:04:05Zz"]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_published(spark, zone):
    """No zone means UTC, whatever zone the session shows times in."""
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        values = [*PUBLISHED, *NOT_PUBLISHED]
        got = column_of(
            spark, values, "string", lambda c: F.unix_micros(times.parse_published(c))
        )
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    want = [
        int(datetime(2024, 1, 2, h, m, s, tzinfo=timezone.utc).timestamp()) * 1_000_000 + us
        for h, m, s, us in PUBLISHED.values()
    ]
    assert got == want + [None] * len(NOT_PUBLISHED)


BODIES = [
    ('{"detail":{"message":"pay","reason":"r"}}', "pay"),
    ('{"detail":{"reason":"r"}}', '{"reason":"r"}'),
    ('{"detail":"gone"}', "gone"),
    ('{"detail":7}', "7"),
    ('{"detail":null}', ""),
    ("{}", ""),
    ("[1,2]", ""),
    ('"text"', ""),
    ("  bad gateway ", "bad gateway"),
    ("{broken", "{broken"),
    ("", ""),
    (None, ""),
]


def test_detail_message(spark):
    bodies, want = zip(*BODIES)
    got = column_of(
        spark, bodies, "string", lambda c: payload.detail_message(c, payload.parse_body(c))
    )
    assert got == list(want)


def test_wrapped_payload(spark):
    bodies = ['{"a": 1}', "[1]", "5", " no json ", '"s"']
    got = column_of(spark, bodies, "string", payload.wrapped_payload)
    assert got == [
        '{"a":1}', '{"data":[1]}', '{"data":5}', '{"detail":"no json"}', '{"data":"s"}',
    ]


def test_whole_seconds(spark):
    values = ["12", "12.0", "1.5", "true", '"12"', "null", "-3"]
    bodies = [f'{{"length_seconds":{v}}}' for v in values] + ["{}"]
    got = column_of(
        spark,
        bodies,
        "string",
        lambda c: payload.whole_seconds(payload.parse_body(c)["length_seconds"]),
    )
    assert got == [12, None, None, None, None, None, -3, None]
