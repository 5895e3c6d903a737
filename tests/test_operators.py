"""Post-table operators and enrichment (SET, AGG-2, SRT, TOP, PRT, JON-1, RUL-1)."""

import pytest
from pyspark.sql import functions as F

from postflow.operators import enrich, posts as ops

S_COLS = "id string, author_id string, created_at string, text string"
B_COLS = "id string, author_id string, text string, created_at string"


def test_union_by_name_and_mismatch_raises(spark):
    s = spark.createDataFrame([("1", "a", "t", "x")], S_COLS)
    b = spark.createDataFrame([("1", "a", "x", "t")], B_COLS)
    assert ops.union_posts(s, b).distinct().count() == 1
    with pytest.raises(Exception, match="NUM_COLUMNS_MISMATCH|Cannot resolve column"):
        ops.union_posts(s, b.drop("text")).collect()


def test_distinct_is_whole_row(spark):
    s = spark.createDataFrame([("1", "a", "t", "x"), ("2", None, "t", "y")], S_COLS)
    b = spark.createDataFrame([("1", "a", "x (edited)", "t"), ("2", None, "y", "t")], B_COLS)
    counts = {r.author_id: r["count"] for r in ops.author_counts(ops.all_posts(s, b)).collect()}
    assert counts == {"a": 2, None: 1}


def test_top_k_ties_and_none(spark):
    df = spark.createDataFrame([("b", 2), ("a", 2), ("c", 5), (None, 2)],
                               "author_id string, count bigint")
    assert [r.author_id for r in ops.top_k(df, 3, "count", "author_id").collect()] == \
        ["c", None, "a"]
    assert ops.top_k(df, None, "count", "author_id").count() == 4


def test_repartition_by_co_locates_keys(spark):
    df = spark.range(1000).select((F.col("id") % 37).cast("string").alias("hashtag"))
    parts = ops.repartition_by(df, 4, ["hashtag"])
    assert parts.rdd.getNumPartitions() == 4
    placed = parts.select("hashtag", F.spark_partition_id().alias("p")).distinct()
    assert placed.groupBy("hashtag").count().where("count > 1").count() == 0
    assert ops.repartition_by(df, None, ["hashtag"]) is df


def test_replicate_is_exact_for_hot_rows(spark):
    df = spark.createDataFrame([("hot", 10), ("warm", 3), ("one", 1)], "k string, n long")
    out = enrich.replicate(df, "n", key=["k"], chunk=3)
    got = {r.k: r["count"] for r in out.groupBy("k").count().collect()}
    assert got == {"hot": 10, "warm": 3, "one": 1}


def test_hydrate_keeps_duplicates_and_drops_unresolved(spark):
    ids = spark.createDataFrame([("1", "u"), ("1", "u"), ("2", "v"), ("nope", "w"), (None, "x")],
                                "tweet_id string, user_id string")
    archive = spark.createDataFrame([("1", "a", "t", "x"), ("2", "b", "t", "y"),
                                     ("3", "c", "t", "z")], S_COLS)
    once = enrich.hydrate(ids, lambda listed: archive.join(listed, "id", "left_semi"), copies=False)
    assert sorted(tuple(r) for r in once.collect()) == [("1", "a", "t", "x"), ("2", "b", "t", "y")]
    got = sorted(tuple(r) for r in enrich.hydrate(ids, archive, chunk=1).collect())
    assert got == [("1", "a", "t", "x"), ("1", "a", "t", "x"), ("2", "b", "t", "y")]


def test_rules(spark):
    posts = spark.createDataFrame(
        [("1", "Talking about COVID-19 today", "en"),
         ("2", "RT @x: coronavirus news", "en"),
         ("3", "covid19 en français", "fr"),
         ("4", None, "en"),
         ("5", "#view and #purchase", None)],
        "id string, text string, lang string")
    rules = [enrich.Rule(1, "kw", ("Covid-19", "CORONAVIRUS", "covid19"), True, "en"),
             enrich.Rule(2, "any", ("#VIEW",), False, None),
             (3, "rt", ["coronavirus"], False, "en")]
    got = sorted(tuple(r) for r in enrich.tag_by_rules(posts, rules).collect())
    assert got == [("1", 1, "kw"), ("2", 3, "rt"), ("5", 2, "any")]
    assert enrich.tag_by_rules(posts, []).count() == 0
    matched = {r.id: [tuple(m) for m in r.matching_rules] for r in enrich.matching_rules(posts, rules).collect()}
    assert matched == {"1": [(1, "kw")], "2": [(3, "rt")], "5": [(2, "any")]}
    # an empty keyword is in every text, NULL keywords and texts match nothing
    odd = [(7, "every", ["", None, ""], False, None), (8, "never", [None], False, None), (9, "none", [], False, None)]
    assert sorted(tuple(r) for r in enrich.tag_by_rules(posts, odd).collect()) == [
        (i, 7, "every") for i in ("1", "2", "3", "5")]
    ref = enrich.REFERENCE_RULES
    assert len(ref) == 4 and {r.tag for r in ref} == {"coronavirus", "COVID-19", "Covid-19",
                                                     "covid19"}
    assert sorted(tuple(r) for r in enrich.tag_by_rules(posts, ref).select("id").distinct()
                  .collect()) == [("1",)]


@pytest.mark.parametrize("n_rules", [1, 60, 300])
def test_many_rules_match_brute_force(spark, sf_dir, n_rules):
    """Generated rules (no cap) against a plain Python check."""
    from postflow.plans import fixtures as fx
    posts = fx.with_lang(spark, sf_dir)
    words = ["#click", "#view", "#error", "#k3", "saw", "ok #sign", "(#hidden)", "rt @x", "#x"]
    rules = [enrich.Rule(i, f"t{i}", (words[i % len(words)], f"#K{i % 7}"), i % 2 == 0,
                         (None, "en", "fr")[i % 3])
             for i in range(n_rules)]
    got = sorted(tuple(r) for r in enrich.tag_by_rules(posts, rules).collect())
    want = []
    for p in posts.collect():
        for r in rules:
            if p.text is None:
                continue
            low = p.text.lower()
            hit = any(k.lower() in low for k in r.any_of)
            if r.exclude_retweets and p.text.startswith("RT @"):
                hit = False
            if r.lang is not None and p.lang != r.lang:
                hit = False
            if hit:
                want.append((p.id, r.rule_id, r.tag))
    assert got == sorted(want) and len(want) > 10 * n_rules


def test_hydrate_spreads_a_hot_id_over_tasks(spark, request):
    """One id listed 20,000 times (a third of the list): exact copies, made by many tasks."""
    hot = spark.range(20_000).select(F.lit("hot").alias("tweet_id"), F.lit("u").alias("user_id"))
    cold = spark.range(40_000).select(F.col("id").cast("string").alias("tweet_id"),
                                      F.lit("u").alias("user_id"))
    archive = spark.range(50_000).select(F.col("id").cast("string").alias("id"),
                                         F.lit("a").alias("author_id"),
                                         F.lit("t").alias("created_at"), F.lit("x").alias("text"))
    archive = archive.unionByName(spark.createDataFrame([("hot", "b", "t", "y")], S_COLS))
    out = enrich.hydrate(hot.unionByName(cold), archive, chunk=1000)
    # Pieces this small would be put together again by size.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    request.addfinalizer(lambda: spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true"))
    counts = out.groupBy((F.col("tweet_id") == "hot").alias("is_hot")).count().collect()
    assert {r.is_hot: r["count"] for r in counts} == {True: 20_000, False: 40_000}
    tasks = (out.where(F.col("tweet_id") == "hot")
                .select(F.spark_partition_id().alias("p")).distinct().count())
    assert tasks >= 4


@pytest.mark.parametrize("direct", [0, 1000])
def test_keyword_index_finds_what_a_search_finds(spark, direct):
    texts = ["", "x", "Grün", "日本語の text", "😀😀 smile 😀", "aaaa", "ab\nab", "İstanbul", "it's \\ back", "ends with qu", None]
    words = ["", "x", "a", "aa", "aaa", "aaaaa", "grün", "RÜN", "本語", "日本語", "😀", "😀 s", "b\na", "\\ b", "'s", "qu", "h qu", None, "zz", "zzzz"]
    rules = [enrich.Rule(i, f"t{i}", (w,), False, None) for i, w in enumerate(words)] + [enrich.Rule(99, "two", ("aa", "x"), False, None)]
    posts = spark.createDataFrame([(str(i), t, "en") for i, t in enumerate(texts)], "id string, text string, lang string")
    lowered = {r.id: r.low for r in posts.selectExpr("id", "lower(text) AS low").collect()}
    low_words = [None if w is None else spark.range(1).selectExpr("1").select(F.lower(F.lit(w))).first()[0] for w in words]
    want = sorted((i, n, f"t{n}") for i, t in lowered.items() if t is not None for n, w in enumerate(low_words) if w is not None and w in t)
    want += [(i, 99, "two") for i, t in lowered.items() if t is not None and ("aa" in t or "x" in t)]
    got = sorted(tuple(r) for r in enrich.tag_by_rules(posts, rules, direct=direct).collect())
    assert got == sorted(want)
