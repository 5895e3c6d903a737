"""Plan checks: no Python in the hot path, the expected shuffles, pruned scans."""

import re

import pytest

import __spark_entry__ as entry

BATCH_KEYS = ["hashtag_tokens", "hashtag_counts", "top_hashtags", "decode_object", "decode_list",
              "message_roundtrip", "text_lines", "union_posts", "distinct_posts",
              "author_counts", "top_authors", "hydrate_ids", "hydrate_keyed", "rule_matches",
              "rule_matches_many", "rule_matches_keywords", "rule_tagged_posts", "document_hashtags", "document_lines",
              "document_rules", "conversation_lines"]

# Shuffles in the initial physical plan (before adaptive re-planning).
EXCHANGES = {
    "hashtag_tokens": 0, "decode_object": 0, "decode_list": 0, "message_roundtrip": 0,
    "text_lines": 0, "union_posts": 0,
    "hashtag_counts": 1,   # partial count -> exchange(hashtag) -> final count
    "distinct_posts": 1,   # partial distinct -> exchange(all columns) -> final
    "author_counts": 2,    # + partial count -> exchange(author_id) -> final
}


def _plan(df, capsys):
    df.explain(mode="formatted")
    return capsys.readouterr().out


@pytest.mark.parametrize("key", BATCH_KEYS)
def test_no_python_in_plans(spark, sf_dir, capsys, key):
    plan = _plan(entry.queries()[key](spark, sf_dir), capsys)
    assert not re.search(r"BatchEvalPython|ArrowEvalPython|PythonUDF|MapInPandas|FlatMapGroups",
                         plan)


@pytest.mark.parametrize("key", sorted(EXCHANGES))
def test_shuffle_count(spark, sf_dir, capsys, key):
    plan = _plan(entry.queries()[key](spark, sf_dir), capsys)
    tree = plan.split("\n\n")[0]
    assert len(re.findall(r"\bExchange\b", tree)) == EXCHANGES[key], tree


def test_aggregates_are_partial_before_the_shuffle(spark, sf_dir, capsys):
    plan = _plan(entry.queries()["author_counts"](spark, sf_dir), capsys)
    assert plan.count("partial_count") == 1
    assert "HashAggregate" in plan


def test_scans_are_pruned(spark, sf_dir, capsys):
    plan = _plan(entry.queries()["hashtag_counts"](spark, sf_dir), capsys)
    schema = re.search(r"ReadSchema: (struct<[^\n]*>)", plan).group(1)
    assert "ts:" not in schema and "value:" not in schema
    plan = _plan(entry.queries()["hydrate_ids"](spark, sf_dir), capsys)
    schemas = re.findall(r"ReadSchema: (struct<[^\n]*>)", plan)
    assert schemas.count("struct<event_id:bigint>") >= 4  # id list: only the id column is read
    plan = _plan(entry.queries()["stream_posts_append"](spark, sf_dir).where("id = '7'"), capsys)
    assert "PushedFilters: [IsNotNull(id), EqualTo(id,7)]" in plan  # keyed read: filter pushed


@pytest.mark.parametrize("key", ["rule_matches", "rule_matches_many", "rule_matches_keywords", "document_rules"])
def test_rules_neither_join_nor_shuffle_the_posts(spark, sf_dir, capsys, key):
    plan = _plan(entry.queries()[key](spark, sf_dir), capsys)
    posts = plan.split("===== Subqueries =====")[0].split("\n\n")[0]
    assert "Join" not in posts and "Exchange" not in posts, posts


def test_hydration_limits_the_archive_below_the_aggregate(spark, sf_dir, capsys):
    entry.queries()["hydrate_keyed"](spark, sf_dir).explain()
    plan = capsys.readouterr().out
    assert "LeftSemi" in plan and plan.index("partial_max") < plan.index("LeftSemi")


def test_keyed_read_combines_map_side(spark, sf_dir, capsys):
    plan = _plan(entry.queries()["keyed_upsert"](spark, sf_dir), capsys)
    assert "partial_max" in plan
    assert "PartitionFilters: [isnotnull(rejected" in plan
