"""Property test: hashtag tokens against a plain-Python model of the split semantics."""

from hypothesis import given, settings, strategies as st

from postflow.functions.text import hashtags

# The separator set of the token pattern, spelled out: , . [ ] { } ? ! ; " ' and ASCII whitespace
# (space, tab, LF, VT, FF, CR).
SEPARATORS = set(",.[]{}?!;\"'") | set(" \t\n\x0b\x0c\r")
ALPHABET = sorted(SEPARATORS) + list("#abAB:()/-\\") + [" ", "　", "é"]


def model(text):
    tokens, current = [], []
    for ch in text:
        if ch in SEPARATORS:
            tokens.append("".join(current))
            current = []
        else:
            current.append(ch)
    tokens.append("".join(current))
    return [t for t in tokens if t.startswith("#")]


@settings(max_examples=6, deadline=None)
@given(st.lists(st.text(alphabet=ALPHABET, max_size=40), min_size=50, max_size=200))
def test_hashtags_match_the_model(spark, texts):
    rows = [(str(i), t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "id string, text string")
    got = sorted((r.id, r.hashtag) for r in hashtags(df).collect())
    want = sorted((str(i), tag) for i, t in enumerate(texts) for tag in model(t))
    assert got == want
