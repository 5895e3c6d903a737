"""Token split, hashtag filter and line feed edge cases (STR-1, GEN-1, FLT-1, AGG-1, PRJ-7)."""

from pyspark.sql import Row

from postflow.functions.text import hashtags, text_lines
from postflow.operators.posts import hashtag_counts


def _tags(spark, text):
    df = spark.createDataFrame([Row(id="1", text=text)], "id string, text string")
    return [r.hashtag for r in hashtags(df).collect()]


def test_every_separator_splits(spark):
    tags = _tags(spark, "#a,#b.#c[#d]{#e}?#f!#g;#h\"#i'#j #k")
    assert tags == ["#a", "#b", "#c", "#d", "#e", "#f", "#g", "#h", "#i", "#j", "#k"]


def test_non_separators_keep_one_token(spark):
    assert _tags(spark, "#m\\#n") == ["#m\\#n"]
    assert _tags(spark, "#q#r") == ["#q#r"]
    assert _tags(spark, "#y:#z") == ["#y:#z"]
    assert _tags(spark, "#p: x") == ["#p:"]
    assert _tags(spark, "x/#s-t") == []


def test_prefix_rules(spark):
    assert _tags(spark, "(#o) a#x") == []
    assert _tags(spark, "# ##s") == ["#", "##s"]


def test_case_is_kept(spark):
    df = spark.createDataFrame([Row(text="#A #a #a")], "text string")
    got = {r.hashtag: r["count"] for r in hashtag_counts(df).collect()}
    assert got == {"#A": 1, "#a": 2}


def test_whitespace_is_ascii_only(spark):
    assert _tags(spark, "#n\u00a0#b") == ["#n\u00a0#b"]
    assert _tags(spark, "#u\u3000#v") == ["#u\u3000#v"]
    assert _tags(spark, "#t\u000b#v") == ["#t", "#v"]
    assert _tags(spark, "#t\t#v\n#w\r#x\f#y") == ["#t", "#v", "#w", "#x", "#y"]


def test_null_and_empty_text_give_no_rows(spark):
    df = spark.createDataFrame([Row(id="1", text=None), Row(id="2", text="")],
                               "id string, text string")
    assert hashtags(df).count() == 0


def test_text_lines(spark):
    df = spark.createDataFrame([Row(text="a\nb"), Row(text=None), Row(text=""),
                                Row(text="c\r\nd\re\n")], "text string")
    assert [r.line for r in text_lines(df).collect()] == ["a", "b", "", "c", "d", "e", ""]
