"""Test relations derived from the provided ``events`` table (see FIXTURES.md).

Post text, authors, edits, duplicates and malformed messages are all computed from whole
``events`` rows with built-in expressions; the ``event_id`` arithmetic decides *which* rows are
edited, duplicated or malformed, it never shrinks the input. ``oracle_cte`` holds the same
definitions in DuckDB SQL for the oracle queries. Stream and batch posts overlap and together
hold every event.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postflow import schemas

# Keyword rules of the tests (rule_id, tag, any_of, exclude_retweets, lang); the last matches nothing.
TEST_RULES = [
    (1, "buy", ["#purchase", "#signup"], True, "en"),
    (2, "err", ["#ERROR"], True, "en"),
    (3, "view", ["#view"], False, None),
    (4, "none", ["covid19", "covid-19", "coronavirus"], True, "en"),
]


# Keyword rules over the document texts.
DOCUMENT_RULES = [
    (1, "licence", ["license", "licence"], False, None),
    (2, "english", ["The ", "tion"], False, "en"),
    (3, "mail", ["@"], True, None),
    (4, "all", [""], False, "de"),
]


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` as posts: ``id, author_id`` (the source), ``created_at`` (none), ``text, lang``."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    return docs.select(F.col("doc_id").cast("string").alias("id"), F.col("source").alias("author_id"),
                       F.lit(None).cast("string").alias("created_at"), "text", "lang")


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/conversations.parquet")


def iso_millis(ts: Column) -> Column:
    """``yyyy-MM-ddTHH:mm:ss.SSSZ`` of a wall-clock timestamp (``TIMESTAMP_NTZ``).

    Built from the timestamp's fields, which carry no zone: unlike ``date_format``, which goes
    through the session time zone, it gives the same text in every session. Padded strings cost a small
    part of what ``format_string`` costs per row; it stays for null and for years of other than four digits.
    """
    millis = (F.floor(F.date_part(F.lit("SECOND"), ts) * 1000) % 1000).cast("int")
    fields = [F.year(ts), F.month(ts), F.dayofmonth(ts), F.hour(ts), F.minute(ts), F.second(ts), millis]
    padded = [F.lpad(f.cast("string"), n, "0") for f, n in zip(fields, (4, 2, 2, 2, 2, 2, 3), strict=True)]
    marks = [F.lit(m) for m in "--T::.Z"]
    return F.when(F.year(ts).between(0, 9999), F.concat(*[c for pair in zip(padded, marks, strict=True) for c in pair])) \
        .otherwise(F.format_string("%04d-%02d-%02dT%02d:%02d:%02d.%03dZ", *fields))


def _s(col: Column | str) -> Column:
    return (F.col(col) if isinstance(col, str) else col).cast("string")


def base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``p``: one synthetic post per event, with ``lang``, ``event_id`` and ``user_id`` kept."""
    e = events(spark, sf_dir)
    eid, uid, etype = F.col("event_id"), F.col("user_id"), F.col("event_type")
    text = F.concat(
        F.when(eid % 11 == 0, F.lit("RT @x: ")).otherwise(F.lit("")),
        F.lit("@user"), _s(uid), F.lit(" saw #"), etype, F.lit("! "), F.col("props"), F.lit("\n"),
        F.lit("#K"), _s(uid % 7), F.lit("; (#hidden) #"), F.upper(etype), F.lit(": ok #"), etype,
        F.lit("."),
    )
    return e.select(
        _s(eid).alias("id"),
        F.when(eid % 97 == 0, F.lit(None).cast("string")).otherwise(_s(uid)).alias("author_id"),
        iso_millis(F.col("ts")).alias("created_at"),
        text.alias("text"),
        F.when(eid % 4 == 0, F.lit("fr")).otherwise(F.lit("en")).alias("lang"),
        eid.alias("event_id"),
        uid.alias("user_id"),
    )


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return base(spark, sf_dir).select(*schemas.STREAM_POST_COLUMNS)


def stream_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = base(spark, sf_dir)
    return p.where(F.col("event_id") % 3 != 0).select(*schemas.STREAM_POST_COLUMNS)


def batch_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Other column order; every tenth post is an edited version of its stream twin."""
    p = base(spark, sf_dir)
    text = (F.when(F.col("event_id") % 10 == 0, F.concat("text", F.lit(" (edited)")))
             .otherwise(F.col("text")))
    return (p.where((F.col("event_id") % 2 == 0) | (F.col("event_id") % 3 == 0))
             .select("id", "author_id", text.alias("text"), "created_at"))


def ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Id list to hydrate: every post once, some twice, ids that do not resolve, and one hot id
    (the first post, listed again for every third event: about a quarter of the list)."""
    p = base(spark, sf_dir)
    uid = _s("user_id").alias("user_id")
    return (p.select(F.col("id").alias("tweet_id"), uid)
            .unionByName(p.where(F.col("event_id") % 7 == 0)
                         .select(F.col("id").alias("tweet_id"), uid))
            .unionByName(p.where(F.col("event_id") % 13 == 0)
                         .select(F.concat(F.lit("missing-"), "id").alias("tweet_id"), uid))
            .unionByName(p.where(F.col("event_id") % 3 == 0)
                         .select(F.lit("0").alias("tweet_id"), uid)))


def _post_struct() -> Column:
    return F.struct(*[F.col(c) for c in schemas.STREAM_POST_COLUMNS])


def object_messages(spark: SparkSession, sf_dir: str, keep_event_id: bool = False) -> DataFrame:
    """Kafka-shaped ``key, value`` messages in object form; ``event_id % 50`` in 1..3 are malformed."""
    p = base(spark, sf_dir)
    kind = F.col("event_id") % 50
    rule = F.struct(F.lit("1").alias("id"), F.lit("t").alias("tag"))
    good = F.to_json(F.struct(_post_struct().alias("data"), F.array(rule).alias("matching_rules")))
    value = (F.when(kind == 1, F.lit("plain text"))
              .when(kind == 2, F.lit('{"errors":[]}'))
              .when(kind == 3, F.lit(""))
              .otherwise(good))
    cols = [F.col("id").cast("binary").alias("key"), value.cast("binary").alias("value")]
    if keep_event_id:
        cols.append(F.col("event_id"))
    return p.select(*cols)


def list_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lookup-shaped messages in list form; ``% 50 == 4`` carries a second element with id -1."""
    p = base(spark, sf_dir)
    kind = F.col("event_id") % 50
    other = F.struct(F.lit("-1").alias("id"), F.col("author_id"), F.col("created_at"),
                     F.lit("other").alias("text"))
    one = F.to_json(F.struct(F.array(_post_struct()).alias("data")))
    two = F.to_json(F.struct(F.array(_post_struct(), other).alias("data")))
    value = (F.when(kind == 1, F.lit("plain text"))
              .when(kind == 2, F.lit('{"errors":[]}'))
              .when(kind == 3, F.lit('{"data":[]}'))
              .when(kind == 4, two)
              .otherwise(one))
    return p.select(F.col("id").cast("binary").alias("key"), value.cast("binary").alias("value"))


def moved_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every seventh post again, edited; every second of these by another author."""
    p = base(spark, sf_dir).where(F.col("event_id") % 7 == 0)
    author = F.when(F.col("event_id") % 2 == 0, F.lit("moved")).otherwise(F.col("author_id"))
    return p.select("id", author.alias("author_id"), "created_at", F.concat("text", F.lit(" (moved)")).alias("text"))


def list_messages_again(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``list_messages`` with offsets; every fifth post comes again at a later offset, with a text that
    sorts before the first one, and every third of these again as it was first."""
    offset = F.col("key").cast("string").cast("long")
    first = list_messages(spark, sf_dir).withColumn("offset", offset)
    again = first.where(offset % 5 == 0)
    edited = F.regexp_replace(F.col("value").cast("string"), '"text":"', '"text":"! ').cast("binary")
    return first.unionByName(again.withColumn("value", edited).withColumn("offset", F.col("offset") + (1 << 40))) \
        .unionByName(again.where(offset % 3 == 0).withColumn("offset", F.col("offset") + (1 << 41)))


def roundtrip_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encoded posts plus one empty keep-alive message for every ``event_id % 50 == 3``."""
    from postflow.functions.messages import encode_messages

    p = base(spark, sf_dir)
    encoded = encode_messages(p, key="id", cols=schemas.STREAM_POST_COLUMNS)
    empty = (p.where(F.col("event_id") % 50 == 3)
              .select(F.lit(None).cast("binary").alias("key"), F.lit(b"").cast("binary").alias("value")))
    return encoded.unionByName(empty)


def rules(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(TEST_RULES, schemas.RULES)


def many_rules(spark: SparkSession) -> DataFrame:
    """400 rules over 40 keywords: rule ``i`` lists keyword ``i % 40`` in one of two spellings and,
    every fifth, an unlikely one too; every third ignores retweets, every fourth asks for a language."""
    i = F.col("id")
    word = F.concat(F.lit("k"), (i % 40).cast("string"))
    one = F.when(i % 40 < 7, F.concat(F.lit("#"), F.when(i % 2 == 0, F.upper(word)).otherwise(word))) \
        .when(i % 40 < 20, F.concat(F.lit("user"), (i % 40).cast("string"))) \
        .otherwise(F.concat((i % 40).cast("string"), F.lit("; (#Hidden)")))
    return spark.range(400).select(
        i.cast("int").alias("rule_id"), F.concat(F.lit("t"), i.cast("string")).alias("tag"),
        F.when(i % 5 == 0, F.array(one, F.lit("no such word"))).otherwise(F.array(one)).alias("any_of"),
        (i % 3 == 0).alias("exclude_retweets"), F.when(i % 4 == 0, F.lit("fr")).alias("lang"))


def keyword_rules(spark: SparkSession) -> DataFrame:
    """5,000 rules of two keywords each; about 250 of the 10,000 keywords are in some post."""
    i = F.col("id")
    n = i.cast("string")
    return spark.range(5000).select(
        i.cast("int").alias("rule_id"), F.concat(F.lit("t"), n).alias("tag"),
        F.array(F.concat(F.lit("@USER"), n, F.lit(" saw")), F.concat(F.lit('"k": '), n, F.lit("}"))).alias("any_of"),
        (i % 3 == 0).alias("exclude_retweets"), F.when(i % 4 == 0, F.lit("fr")).alias("lang"))


def with_lang(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts with the ``lang`` field that rule matching needs."""
    return base(spark, sf_dir).select(*schemas.STREAM_POST_COLUMNS, "lang")


# The same relations for DuckDB (oracle side). DuckDB's concat skips NULLs where Spark's returns
# NULL; no input column is NULL, so both give the same text.
ORACLE_BASE = """p AS (
  SELECT CAST(event_id AS VARCHAR) AS id,
         CASE WHEN event_id % 97 = 0 THEN NULL ELSE CAST(user_id AS VARCHAR) END AS author_id,
         strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ') AS created_at,
         concat(CASE WHEN event_id % 11 = 0 THEN 'RT @x: ' ELSE '' END,
                '@user', CAST(user_id AS VARCHAR), ' saw #', event_type, '! ', props, chr(10),
                '#K', CAST(user_id % 7 AS VARCHAR), '; (#hidden) #', upper(event_type), ': ok #',
                event_type, '.') AS text,
         CASE WHEN event_id % 4 = 0 THEN 'fr' ELSE 'en' END AS lang,
         event_id, user_id
  FROM events)"""

ORACLE_RELATIONS = {
    "posts": "posts AS (SELECT id, author_id, created_at, text FROM p)",
    "stream_posts": "stream_posts AS (SELECT id, author_id, created_at, text FROM p WHERE event_id % 3 <> 0)",
    "batch_posts": """batch_posts AS (
  SELECT id, author_id,
         CASE WHEN event_id % 10 = 0 THEN concat(text, ' (edited)') ELSE text END AS text,
         created_at
  FROM p WHERE event_id % 2 = 0 OR event_id % 3 = 0)""",
    "ids": """ids AS (
  SELECT id AS tweet_id, CAST(user_id AS VARCHAR) AS user_id FROM p
  UNION ALL
  SELECT id, CAST(user_id AS VARCHAR) FROM p WHERE event_id % 7 = 0
  UNION ALL
  SELECT concat('missing-', id), CAST(user_id AS VARCHAR) FROM p WHERE event_id % 13 = 0
  UNION ALL
  SELECT '0', CAST(user_id AS VARCHAR) FROM p WHERE event_id % 3 = 0)""",
    "rules": """rules AS (
  SELECT * FROM (VALUES
    (1, 'buy', ['#purchase', '#signup'], true, 'en'),
    (2, 'err', ['#ERROR'], true, 'en'),
    (3, 'view', ['#view'], false, NULL),
    (4, 'none', ['covid19', 'covid-19', 'coronavirus'], true, 'en'))
  AS r(rule_id, tag, any_of, exclude_retweets, lang))""",
}


ORACLE_RELATIONS["many_rules"] = """many_rules AS (
  SELECT CAST(i AS INT) AS rule_id, concat('t', i) AS tag,
         CASE WHEN i % 5 = 0 THEN [kw, 'no such word'] ELSE [kw] END AS any_of,
         i % 3 = 0 AS exclude_retweets, CASE WHEN i % 4 = 0 THEN 'fr' END AS lang
  FROM (SELECT i, CASE WHEN i % 40 < 7 THEN concat('#', CASE WHEN i % 2 = 0 THEN 'K' ELSE 'k' END, i % 40)
                       WHEN i % 40 < 20 THEN concat('user', i % 40)
                       ELSE concat(i % 40, '; (#Hidden)') END AS kw
        FROM range(400) r(i)))"""


ORACLE_RELATIONS["keyword_rules"] = """keyword_rules AS (
  SELECT CAST(i AS INT) AS rule_id, concat('t', i) AS tag,
         [concat('@USER', i, ' saw'), concat('"k": ', i, '}')] AS any_of,
         i % 3 = 0 AS exclude_retweets, CASE WHEN i % 4 = 0 THEN 'fr' END AS lang
  FROM range(5000) r(i))"""


def oracle_with(*names: str) -> str:
    """``WITH p AS (...), <names> AS (...)`` for an oracle query."""
    parts = [ORACLE_BASE] + [ORACLE_RELATIONS[n] for n in names]
    return "WITH " + ",\n".join(parts) + "\n"
