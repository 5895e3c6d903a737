"""DuckDB SQL giving the expected result of each registered query (same column names).

Each statement rebuilds the test relations from the ``events`` view (``fixtures.oracle_with``)
and computes the result by plain SQL, independently of the Spark code.
"""

from __future__ import annotations

from postflow.plans.fixtures import oracle_with

# DuckDB (RE2) form of the token separator class; \s is [\t\n\f\r ] there (no vertical tab,
# which the fixtures never contain).
_SPLIT = r"""regexp_split_to_array(text, '[,.\[\]\{\}?!\s;"'']')"""
_WELL_FORMED = "event_id % 50 NOT IN (1, 2, 3)"


def _tokens(source: str) -> str:
    return f"""SELECT id, hashtag FROM (SELECT id, unnest({_SPLIT}) AS hashtag FROM {source})
WHERE hashtag LIKE '#%'"""


def _counts(source: str) -> str:
    return f"""SELECT hashtag, count(*) AS count FROM ({_tokens(source)}) t GROUP BY hashtag"""


_DISTINCT = """SELECT * FROM stream_posts UNION BY NAME SELECT * FROM batch_posts"""
_AUTHORS = f"""SELECT author_id, count(*) AS count FROM ({_DISTINCT}) d GROUP BY author_id"""

_HYDRATE = """SELECT i.tweet_id, p.author_id, p.created_at, p.text
FROM ids i JOIN posts p ON i.tweet_id = p.id"""

_WELL_FORMED_POSTS = f"""SELECT id, author_id, created_at, text FROM p WHERE {_WELL_FORMED}"""


def _decoded(columns: tuple[str, ...]) -> str:
    cols = ", ".join(f"CASE WHEN {_WELL_FORMED} THEN {c} END AS {c}" for c in columns)
    return f"SELECT {cols} FROM p"


def _rules(posts: str, rules: str) -> str:
    return f"""SELECT p.id, r.rule_id, r.tag
FROM {posts} p, {rules} r
WHERE EXISTS (SELECT 1 FROM unnest(r.any_of) AS k(kw) WHERE contains(lower(p.text), lower(k.kw)))
  AND (NOT r.exclude_retweets OR NOT (p.text LIKE 'RT @%'))
  AND (r.lang IS NULL OR p.lang = r.lang)"""


_VERSIONS = """
SELECT id, author_id, text, created_at FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY seq DESC) AS rn FROM v) WHERE rn = 1"""
_LINES = """SELECT line, count(*) AS count FROM (
  SELECT unnest(regexp_split_to_array(text, '\r\n|\r|\n')) AS line FROM {0} WHERE text IS NOT NULL)
GROUP BY line"""
_DOCS = "(SELECT CAST(doc_id AS VARCHAR) AS id, text, lang FROM documents)"

ORACLE_SQL: dict[str, str] = {
    "hashtag_tokens": oracle_with("posts") + _tokens("posts"),
    "hashtag_counts": oracle_with("posts") + _counts("posts"),
    "top_hashtags": oracle_with("posts") + _counts("posts")
    + "\nORDER BY count DESC, hashtag LIMIT 10",
    "decode_object": oracle_with() + _decoded(("id", "author_id", "created_at", "text")),
    "decode_list": oracle_with() + _decoded(("id", "author_id", "text", "created_at")),
    "message_roundtrip": oracle_with() + "SELECT id, author_id, created_at, text FROM p",
    "text_lines": oracle_with()
    + "SELECT unnest(string_split(text, chr(10))) AS line FROM p WHERE text IS NOT NULL",
    "union_posts": oracle_with("stream_posts", "batch_posts")
    + "SELECT * FROM stream_posts UNION ALL BY NAME SELECT * FROM batch_posts",
    "distinct_posts": oracle_with("stream_posts", "batch_posts") + _DISTINCT,
    "author_counts": oracle_with("stream_posts", "batch_posts") + _AUTHORS,
    "top_authors": oracle_with("stream_posts", "batch_posts") + _AUTHORS
    + "\nORDER BY count DESC, author_id ASC NULLS FIRST LIMIT 10",
    "keyed_upsert": oracle_with("stream_posts", "batch_posts") + """,
v AS (SELECT id, author_id, created_at, text, 0 AS batch_id FROM stream_posts
      UNION ALL
      SELECT id, author_id, created_at, text, 1 AS batch_id FROM batch_posts),
r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY batch_id DESC,
          created_at DESC NULLS LAST, text DESC NULLS LAST, author_id DESC NULLS LAST) AS rn
      FROM v WHERE id IS NOT NULL)
SELECT id, author_id, created_at, text FROM r WHERE rn = 1""",
    "keyed_two_writers": oracle_with("stream_posts", "batch_posts") + """,
v AS (SELECT id, author_id, text, created_at, 0 AS seq FROM stream_posts
      UNION ALL SELECT id, author_id, text, created_at, 1 FROM batch_posts
      UNION ALL SELECT id, author_id, concat(text, ' (again)'), created_at, 2 FROM p
                WHERE event_id % 10 = 5)""" + _VERSIONS,
    "top_authors_replaced": oracle_with("stream_posts", "batch_posts") + f"""
SELECT author_id, count FROM (
  SELECT * FROM ({_AUTHORS}) a ORDER BY count DESC, author_id ASC NULLS FIRST LIMIT 10) t
WHERE author_id IS NOT NULL""",
    "document_hashtags": _counts(_DOCS),
    "document_lines": _LINES.format("documents"),
    "conversation_lines": _LINES.format("conversations"),
    "document_rules": "WITH rules AS (SELECT * FROM (VALUES (1, 'licence', ['license', 'licence'], false, NULL), "
                      "(2, 'english', ['The ', 'tion'], false, 'en'), (3, 'mail', ['@'], true, NULL), "
                      "(4, 'all', [''], false, 'de')) AS r(rule_id, tag, any_of, exclude_retweets, lang))\n"
                      + _rules(_DOCS, "rules"),
    "hydrate_keyed": oracle_with("stream_posts", "batch_posts", "ids") + """,
v AS (SELECT id, author_id, text, created_at, 0 AS seq FROM stream_posts
      UNION ALL SELECT id, author_id, text, created_at, 1 FROM batch_posts),
posts AS (""" + _VERSIONS + """)
""" + _HYDRATE,
    "rule_matches_many": oracle_with("many_rules") + _rules("p", "many_rules"),
    "rule_matches_keywords": oracle_with("keyword_rules") + _rules("p", "keyword_rules"),
    "rule_tagged_posts": oracle_with("rules") + f"""
SELECT id, '[' || string_agg('{{"id":' || rule_id || ',"tag":"' || tag || '"}}', ',' ORDER BY rule_id)
       || ']' AS matching_rules
FROM ({_rules("p", "rules")}) m GROUP BY id""",
    "hydrate_ids": oracle_with("posts", "ids") + _HYDRATE,
    "rule_matches": oracle_with("rules") + _rules("p", "rules"),
    "id_stream": oracle_with("ids") + "SELECT tweet_id FROM ids",
    "stream_posts_append": oracle_with() + _WELL_FORMED_POSTS,
    "stream_hashtags_complete": oracle_with() + _counts(f"({_WELL_FORMED_POSTS}) wf"),
    "stream_hashtags_update": oracle_with() + _counts(f"({_WELL_FORMED_POSTS}) wf"),
    "stream_line_feed": oracle_with("posts") + _counts("posts"),
    "stream_hydrate": oracle_with("posts", "ids") + _HYDRATE,
    "stream_restart": oracle_with() + _counts(f"({_WELL_FORMED_POSTS}) wf"),
    "hydrate_pruned": oracle_with("stream_posts", "batch_posts", "ids") + """,
v AS (SELECT id, author_id, text, created_at, 0 AS seq FROM stream_posts
      UNION ALL SELECT id, author_id, text, created_at, 1 FROM batch_posts),
posts AS (""" + _VERSIONS + """)
""" + _HYDRATE,
    "author_counts_bucketed": oracle_with("stream_posts", "batch_posts") + _AUTHORS,
    "authors_incremental": oracle_with("stream_posts", "batch_posts") + f""",
moved AS (
  SELECT id, CASE WHEN event_id % 2 = 0 THEN 'moved' ELSE author_id END AS author_id, created_at,
         concat(text, ' (moved)') AS text FROM p WHERE event_id % 7 = 0),
now AS (SELECT * FROM stream_posts WHERE id NOT IN (SELECT id FROM moved) UNION ALL SELECT * FROM moved)
SELECT author_id, count(*) AS count FROM (SELECT * FROM now UNION BY NAME SELECT * FROM batch_posts) d
WHERE author_id IS NOT NULL GROUP BY author_id""",
    "ingest_offsets": oracle_with() + """
SELECT id, author_id, CASE WHEN event_id % 5 = 0 AND event_id % 3 <> 0 THEN concat('! ', text) ELSE text END AS text,
       created_at, CAST(1 AS BIGINT) AS versions
FROM p WHERE event_id % 50 NOT IN (1, 2, 3)""",
    "stream_posts_latest": oracle_with()
    + f"SELECT *, CAST(1 AS BIGINT) AS versions FROM ({_WELL_FORMED_POSTS}) wf",
    "rejected_messages": oracle_with() + """
SELECT CASE event_id % 50 WHEN 1 THEN 'plain text' WHEN 2 THEN '{"errors":[]}' ELSE '' END AS raw,
       CASE event_id % 50 WHEN 1 THEN 'malformed' WHEN 2 THEN 'no post' ELSE 'empty' END AS reason
FROM p WHERE event_id % 50 IN (1, 2, 3)""",
    "stream_hashtags_buckets": oracle_with() + _counts(f"({_WELL_FORMED_POSTS}) wf"),
    "stream_top_hashtags": oracle_with() + "\nUNION ALL\n".join(
        f"""(SELECT hashtag, count, {part} AS part FROM ({_counts(f"({_WELL_FORMED_POSTS} AND event_id % 3 <= {part}) wf{part}")}) c{part}
ORDER BY count DESC, hashtag LIMIT 5)""" for part in range(3)),
}
