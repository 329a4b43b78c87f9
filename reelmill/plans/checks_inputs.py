"""Queries over incoming data: channel specs, feeds, captions, response bodies."""

from pyspark.sql import functions as F

from reelmill.functions import languages, payload, text, times
from reelmill.operators import discovery, transcripts
from reelmill.plans import fixtures as fx
from reelmill.plans.oracle import hashed, with_tables

QUERIES: dict = {}


def query(name: str, tables: str = "", sql: str | None = None):
    def register(fn):
        QUERIES[name] = (fn, with_tables(tables, sql) if sql else None)
        return fn

    return register


# -- channel specs --------------------------------------------------------------

# One spec string per customer: named and bare, ids and handles, empty parts.
_SPECS = """
    SELECT c_custkey, CASE c_custkey % 5
             WHEN 0 THEN ' Slug' || c_custkey || ' = id:UC' || c_custkey || ' '
             WHEN 1 THEN '@Handle ' || c_custkey || '!'
             WHEN 2 THEN ' ,, '
             WHEN 3 THEN '=ID:Uc-' || c_custkey
             ELSE 'My Show = @@h' || c_custkey || '=x' END
           || ',' ||
           CASE c_custkey % 3 WHEN 0 THEN 'id: ' WHEN 1 THEN '@'
             ELSE 'b=ID: x' || c_custkey END AS spec
      FROM customer"""


def _specs(spark, sf):
    customer = fx.table(spark, sf, "customer")
    return spark.sql(_SPECS.replace("FROM customer", "FROM {customer}"), customer=customer)


_SLUG_SQL = """coalesce(nullif(regexp_replace(regexp_replace(lower({0}), '[^a-z0-9]+', '-', 'g'),
    '^-|-$', '', 'g'), ''), 'channel')"""

_TARGETS = f"""
    specs AS ({_SPECS}),
    tokens AS (SELECT c_custkey, trim(t) AS token, pos FROM (
        SELECT c_custkey, unnest(string_split(spec, ',')) AS t,
               generate_subscripts(string_split(spec, ','), 1) AS pos FROM specs)
        WHERE trim(t) <> ''),
    named AS (SELECT *,
        CASE WHEN contains(token, '=') THEN trim(split_part(token, '=', 1)) ELSE '' END AS slug,
        CASE WHEN contains(token, '=')
             THEN trim(substr(token, instr(token, '=') + 1)) ELSE token END AS spec FROM tokens),
    kinds AS (SELECT *,
        CASE WHEN lower(spec) LIKE 'id:%' THEN trim(substr(spec, 4)) ELSE '' END AS channel_id,
        CASE WHEN lower(spec) LIKE 'id:%' THEN '' ELSE trim(ltrim(spec, '@')) END
          AS channel_handle FROM named),
    good AS (SELECT c_custkey, channel_id, channel_handle,
        coalesce(nullif(slug, ''), {_SLUG_SQL.format("channel_id || channel_handle")})
          AS channel_slug,
        row_number() OVER (PARTITION BY c_custkey ORDER BY pos) - 1 AS target_pos
        FROM kinds WHERE channel_id <> '' OR channel_handle <> ''),
    targets AS (SELECT * FROM good UNION ALL
        SELECT c_custkey, '', 'main', 'main', 0 FROM specs
         WHERE c_custkey NOT IN (SELECT c_custkey FROM good))"""


def _targets(spark, sf):
    return discovery.parse_channel_specs(_specs(spark, sf), handle="main", slug="main")


@query(
    "d1_channel_specs",
    "",
    f"""WITH {_TARGETS} SELECT c_custkey, CAST(target_pos AS INTEGER) AS target_pos, channel_id,
              channel_handle, channel_slug FROM targets""",
)
def channel_specs(spark, sf):
    return _targets(spark, sf)


@query(
    "d2_slugify",
    "",
    f"SELECT item_id, {_SLUG_SQL.format('text')} AS slug FROM benchmark UNION ALL "
    f"SELECT doc_id, {_SLUG_SQL.format('text')} FROM documents",
)
def slugify(spark, sf):
    items = fx.table(spark, sf, "benchmark").select("item_id", text.slugify(F.col("text")).alias("slug"))
    docs = fx.table(spark, sf, "documents").select("doc_id", text.slugify(F.col("text")).alias("slug"))
    return items.union(docs)


@query(
    "d3_channel_ref",
    "",
    f"""WITH {_TARGETS} SELECT c_custkey, CAST(target_pos AS INTEGER) AS target_pos,
              CASE WHEN channel_id <> '' THEN channel_id ELSE '@' || channel_handle END
                AS channel_ref FROM targets""",
)
def channel_ref(spark, sf):
    refs = discovery.with_channel_ref(_targets(spark, sf))
    return refs.select("c_custkey", "target_pos", "channel_ref")


# -- feeds ----------------------------------------------------------------------


def _joined(spark, sf):
    targets = discovery.with_channel_ref(discovery.channel_targets(spark, fx.CHANNELS))
    return discovery.join_feeds(targets, fx.feed(spark, sf))


def _items(spark, sf):
    return discovery.normalise_feed(_joined(spark, sf))


def _recent(spark, sf):
    return discovery.within_lookback(_items(spark, sf), fx.AS_OF)


def naive(column: str):
    """An instant as the zone-free time that the check compares."""
    return F.col(column).cast("timestamp_ntz").alias(column)


@query(
    "d4_target_feed_join",
    "",
    """SELECT event_id AS feed_pos, event_type AS channel_slug, 'u' || user_id AS video
         FROM events""",
)
def target_feed_join(spark, sf):
    return _joined(spark, sf).select("feed_pos", "channel_slug", F.col("videoId").alias("video"))


_ITEM = "video_id, channel_slug, title, source_url, thumbnail_url, description, published_at"


def _shown(items):
    return items.select(*_ITEM.split(", ")[:-1], naive("published_at"), "feed_pos")


@query("d5_normalise_feed", "feed", f"SELECT {_ITEM}, feed_pos FROM feed")
def normalise_feed(spark, sf):
    return _shown(_items(spark, sf))


@query(
    "d5_normalise_links",
    "",
    """SELECT 'p' || page_id AS video_id, CASE WHEN page_id % 7 = 0
              THEN 'https://www.youtube.com/watch?v=p' || page_id ELSE url END AS source_url
         FROM pages WHERE url NOT LIKE '%ref=%'""",
)
def normalise_links(spark, sf):
    """Blank ids are dropped, ids trimmed, missing links built."""
    k = F.col("page_id")
    rows = fx.table(spark, sf, "pages").select(
        F.when(F.col("url").like("%ref=%"), F.lit(" \t")).otherwise(F.format_string(" p%s\n", k)).alias("videoId"),
        F.when(k % 7 == 0, F.when(k % 2 == 0, "")).otherwise(F.col("url")).alias("link"),
        F.lit("c").alias("channel_slug"),
        F.lit(None).cast("string").alias("published"),
        F.lit("t").alias("title"),
        F.lit("d").alias("description"),
        F.lit(None).cast("struct<url string>").alias("thumbnail"),
    )
    return discovery.normalise_feed(rows).select("video_id", "source_url")


@query(
    "d6_parse_published",
    "",
    """SELECT event_id, CASE event_id % 8
             WHEN 0 THEN date_trunc('second', ts) WHEN 1 THEN ts
             WHEN 2 THEN ts - INTERVAL 2 HOUR
             WHEN 3 THEN CAST(CAST(ts AS DATE) AS TIMESTAMP)
             WHEN 4 THEN date_trunc('second', ts) + INTERVAL 330 MINUTE
             WHEN 5 THEN date_trunc('second', ts) END AS published_at FROM events""",
)
def parse_published(spark, sf):
    k = F.col("event_id") % 8

    def shown(pattern: str):
        return F.date_format("ts", pattern)

    value = (
        F.when(k == 0, shown("yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(k == 1, shown("yyyy-MM-dd HH:mm:ss.SSSSSS"))
        .when(k == 2, shown("yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+02:00'"))
        .when(k == 3, shown("yyyy-MM-dd"))
        .when(k == 4, shown("yyyy-MM-dd'T'HH:mm:ss'-0530'"))
        .when(k == 5, shown("yyyyMMdd'T'HHmmss"))
        .when(k == 6, shown("yyyy"))
        .otherwise(shown("yyyy-M-d'T'H:m:s'Z x'"))
    )
    parsed = times.parse_published(value).alias("published_at")
    return fx.table(spark, sf, "events").select("event_id", parsed).select(
        "event_id", naive("published_at")
    )


@query("d7_lookback", "recent", f"SELECT {_ITEM}, feed_pos FROM recent")
def lookback(spark, sf):
    return _shown(_recent(spark, sf))


@query("d8_first_wins", "firsts", f"SELECT {_ITEM}, feed_pos FROM firsts")
def first_wins(spark, sf):
    return _shown(discovery.first_wins(_recent(spark, sf)))


@query("d9_newest", "items", f"SELECT {_ITEM}, feed_pos FROM items")
def newest(spark, sf):
    return _shown(discovery.newest(discovery.first_wins(_recent(spark, sf))))


@query("d9_newest_80", "items", f"SELECT {_ITEM}, feed_pos FROM items WHERE pos <= 80")
def newest_80(spark, sf):
    return _shown(discovery.newest(discovery.first_wins(_recent(spark, sf)), 80))


# -- languages --------------------------------------------------------------------

_PREF = "lang || '-' || upper(source) || ' , ASR,' || source || ', asr-' || lang || ',, ' || lang"
_PARTS = f"""
    parts AS (SELECT doc_id, trim(p) AS part, pos FROM (
        SELECT doc_id, unnest(string_split({_PREF}, ',')) AS p,
               generate_subscripts(string_split({_PREF}, ','), 1) AS pos FROM documents)
        WHERE trim(p) <> '')"""


def _preference(spark, sf):
    return fx.table(spark, sf, "documents").select(
        "doc_id", languages.split_preference(F.expr(_PREF)).alias("codes")
    )


@query(
    "t1_language_preference",
    "",
    f"""WITH {_PARTS} SELECT doc_id, string_agg(part, '|' ORDER BY pos) AS codes
          FROM parts GROUP BY doc_id""",
)
def language_preference(spark, sf):
    return _preference(spark, sf).select("doc_id", F.array_join("codes", "|").alias("codes"))


@query(
    "t2_normalise_languages",
    "",
    f"""WITH {_PARTS}, codes AS (SELECT doc_id, pos, CASE
              WHEN lower(part) = 'asr' OR lower(part) LIKE 'asr-%' THEN lower(part)
              ELSE split_part(lower(part), '-', 1) END AS code FROM parts),
          firsts AS (SELECT doc_id, code, min(pos) AS pos FROM codes WHERE code <> '' GROUP BY 1, 2)
        SELECT doc_id, string_agg(code, ',' ORDER BY pos) AS codes FROM firsts GROUP BY doc_id""",
)
def normalise_languages(spark, sf):
    codes = languages.normalise_languages(F.col("codes"))
    return _preference(spark, sf).select("doc_id", F.array_join(codes, ",").alias("codes"))


# -- captions -----------------------------------------------------------------------

_FLAT = "length(raw_text) AS chars, sha256(raw_text) AS digest"


@query("t3_flatten_segments", "flat", f"SELECT doc_id, {_FLAT} FROM flat")
def flatten_segments(spark, sf):
    flat = text.flatten_segments(F.split("text", "\n")).alias("raw_text")
    return fx.table(spark, sf, "documents").select("doc_id", flat).select(
        "doc_id",
        F.length("raw_text").cast("bigint").alias("chars"),
        F.sha2("raw_text", 256).alias("digest"),
    )


@query("t4_flatten_rows", "flat", f"SELECT CAST(doc_id AS VARCHAR) AS video_id, {_FLAT} FROM flat")
def flatten_rows(spark, sf):
    return transcripts.flatten_rows(fx.segments(spark, sf)).select(
        "video_id",
        F.length("raw_text").cast("bigint").alias("chars"),
        F.sha2("raw_text", 256).alias("digest"),
    )


@query(
    "t4_flatten_turns",
    "",
    """WITH lines AS (SELECT conv_id, turn, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS line
                        FROM conversations),
            kept AS (SELECT conv_id, turn, line FROM (SELECT *, lag(line) OVER (
                       PARTITION BY conv_id ORDER BY turn) AS before FROM lines WHERE line <> '')
                      WHERE before IS NULL OR before <> line)
       SELECT CAST(conv_id AS VARCHAR) AS video_id,
              string_agg(line, chr(10) ORDER BY turn) AS raw_text FROM kept GROUP BY conv_id""",
)
def flatten_turns(spark, sf):
    turns = fx.table(spark, sf, "conversations").select(
        F.col("conv_id").cast("string").alias("video_id"), F.col("turn").alias("pos"), "text"
    )
    return transcripts.flatten_rows(turns)


@query("t5_content_hash", "", f"SELECT doc_id, {hashed('text')} AS content_hash FROM documents")
def content_hash(spark, sf):
    return fx.table(spark, sf, "documents").select(
        "doc_id", text.content_hash(F.col("text")).alias("content_hash")
    )


# -- response bodies ------------------------------------------------------------------

# One body per document: message objects, other details, plain text, non-objects.
_BODY = """
    CASE doc_id % 8
      WHEN 0 THEN '{"detail": {"message": "m' || doc_id || '", "reason": "quota"}}'
      WHEN 1 THEN '{"detail":{"message":"","reason":"r' || doc_id || '"}}'
      WHEN 2 THEN '{"detail": "plain ' || doc_id || '", "length_seconds": 12.5}'
      WHEN 3 THEN '{"detail": ' || doc_id || ', "length_seconds": ' || doc_id || '}'
      WHEN 4 THEN '{"length_seconds": "' || doc_id || '"}'
      WHEN 5 THEN '  upstream error ' || doc_id || ' '
      WHEN 6 THEN '[' || doc_id || ']'
      ELSE '{"detail": null, "length_seconds": true}' END"""


def _bodies(spark, sf):
    docs = fx.table(spark, sf, "documents").select("doc_id", F.expr(_BODY).alias("body"))
    return docs.withColumn("payload", payload.parse_body(F.col("body")))


_PARSED = f"""
    bodies AS (SELECT doc_id, body, CASE WHEN json_valid(body) THEN CAST(body AS JSON) END AS doc
                 FROM (SELECT doc_id, {_BODY} AS body FROM documents))"""


@query(
    "s4_tolerant_payload",
    "",
    f"""WITH {_PARSED} SELECT doc_id, CASE
             WHEN doc IS NULL THEN CAST(json_object('detail', trim(body)) AS VARCHAR)
             WHEN json_type(doc) = 'OBJECT' THEN CAST(json(doc) AS VARCHAR)
             ELSE '{{"data":' || CAST(json(doc) AS VARCHAR) || '}}' END AS payload FROM bodies""",
)
def tolerant_payload(spark, sf):
    return _bodies(spark, sf).select(
        "doc_id", payload.wrapped_payload(F.col("body")).alias("payload")
    )


@query(
    "t7_detail_message",
    "",
    f"""WITH {_PARSED} SELECT doc_id, CASE
             WHEN doc IS NULL THEN trim(body)
             WHEN json_type(doc, '$.detail') = 'OBJECT'
               THEN coalesce(nullif(json_extract_string(doc, '$.detail.message'), ''),
                             CAST(json_extract(doc, '$.detail') AS VARCHAR))
             ELSE coalesce(json_extract_string(doc, '$.detail'), '') END AS message FROM bodies""",
)
def detail_message(spark, sf):
    return _bodies(spark, sf).select(
        "doc_id",
        payload.detail_message(F.col("body"), F.col("payload")).alias("message"),
    )


@query(
    "t8_whole_seconds",
    "",
    f"""WITH {_PARSED} SELECT doc_id, CASE
             WHEN json_type(doc, '$.length_seconds') IN ('UBIGINT', 'BIGINT')
             THEN CAST(json_extract(doc, '$.length_seconds') AS INTEGER) END AS length_seconds
          FROM bodies""",
)
def whole_seconds(spark, sf):
    length = payload.whole_seconds(F.col("payload.length_seconds"))
    return _bodies(spark, sf).select("doc_id", length.alias("length_seconds"))


@query(
    "t6_classify_responses",
    "answers flat",
    """SELECT a.video_id, a.http_status, a.kind, a.error,
              CASE WHEN a.kind = 'ok' THEN sha256(f.raw_text) END AS digest,
              CASE WHEN a.kind = 'ok' THEN a.lang END AS language,
              CASE WHEN a.kind = 'ok' THEN a.length_seconds END AS length_seconds
         FROM answers a LEFT JOIN flat f ON f.doc_id = a.doc_id""",
)
def classify_responses(spark, sf):
    return transcripts.classify(fx.responses(spark, sf), with_text=True).select(
        "video_id",
        "http_status",
        "kind",
        "error",
        F.sha2("text", 256).alias("digest"),
        "language",
        "length_seconds",
    )


@query(
    "t9_duration_gates",
    "",
    """SELECT doc_id, CASE WHEN len < 30 THEN 'below 30s minimum (' || len || 's)'
                           WHEN len > 600 THEN 'above 600s maximum (' || len || 's)' END AS reason
         FROM (SELECT doc_id, CASE WHEN doc_id % 13 <> 0 THEN n_chars // 15 END AS len
                 FROM documents)""",
)
def duration_gates(spark, sf):
    length = F.when(F.col("doc_id") % 13 != 0, F.expr("cast(n_chars div 15 as int)"))
    return fx.table(spark, sf, "documents").select(
        "doc_id", transcripts.skip_reason(length, 30, 600).alias("reason")
    )
