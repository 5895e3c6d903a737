import re

from llm_cases import ODD, prose
from postflow.llm.decontaminate import drop_leaks, find_leaks

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def grams(w, k):
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)}


def brute(docs, items):
    out = []
    for i, item in items:
        w = words(item)
        if not w:
            continue
        k = min(5, len(w))
        want = grams(w, k)
        for d, text in docs:
            both = len(want & grams(words(text), k))
            if 100 * both >= 80 * len(want):
                out.append((repr(d), repr(i), len(want), both))
    return sorted(out)


def cases():
    items = [(i, prose(n, 100 + i)) for i, n in enumerate((6, 12, 40, 90, 300))]
    items += [(10, "two words"), (11, ""), (12, None), (13, items[2][1]), (13, items[2][1]), (None, "naïve x1 end")]
    long = prose(3000, 7)
    docs = list(enumerate(ODD)) + [(50, long + " " + items[3][1].upper() + " " + long), (51, items[0][1])]
    w = items[4][1].split()
    docs += [(52, " ".join(w[:250])), (53, " ".join(w[:200])), (53, " ".join(w[:250])), (None, items[2][1] + " x")]
    return docs, items


def test_pairs_against_brute_force(spark, documents):
    docs, items = cases()
    table = spark.createDataFrame(items, "item_id long, text string")
    for block in (20_000, 2):
        got = find_leaks(documents(docs), table, block_items=block).collect()
        assert sorted((repr(r.doc_id), repr(r.item_id), r.n_item, r.n_shared) for r in got) == brute(docs, items)


def test_rows_without_leaks_stay_untouched(spark, documents):
    docs, items = cases()
    df = documents(docs)
    got = drop_leaks(df, spark.createDataFrame(items, "item_id long, text string"), block_items=2)
    assert got.schema == df.schema
    bad = {d for d, *_ in brute(docs, items)}
    rows = [(i, t) for i, t in docs if not any(100 * len(grams(words(x), min(5, len(words(x)))) & grams(
        words(t), min(5, len(words(x))))) >= 80 * len(grams(words(x), min(5, len(words(x)))))
        for _, x in items if words(x))]
    assert bad and sorted(map(repr, ((r.doc_id, r.text) for r in got.collect()))) == sorted(map(repr, rows))


def test_empty_tables(spark, documents):
    none = spark.createDataFrame([], "item_id long, text string")
    assert find_leaks(documents([(1, "a b c d e f")]), none).collect() == []
    some = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert find_leaks(documents([(1, "a")]).filter("doc_id = 0"), some).collect() == []
