import numpy as np
import pytest

from llm_cases import ODD, prose
from postflow.llm.quality_model import FEATURES, Gam, features_of, fit, keep_quality, score_quality, train


def test_model_learns_shapes_and_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(4000, 4))
    odds = 2 * (np.abs(x[:, 0]) > 1) - 1 + 3 * np.sign(x[:, 1]) * np.sign(x[:, 2])
    y = (rng.random(4000) < 1 / (1 + np.exp(-odds))).astype(float)
    flat = fit(x[:3000], y[:3000], pairs=0)
    full = fit(x[:3000], y[:3000], pairs=2)
    assert full.pairs[0][:2] == (1, 2)

    def loss(model):
        p = model.probability(x[3000:])
        return -np.mean(np.log(np.where(y[3000:] == 1, p, 1 - p)))

    assert loss(full) < loss(flat) - 0.2


def test_scores_are_table_sums():
    model = Gam(0.5, [np.array([0.0, 1.0]), np.array([5.0])], [np.array([1.0, 2.0, 3.0]), np.array([0.0, 10.0])],
                [(0, 1, np.arange(6.0).reshape(3, 2))])
    x = np.array([[-1.0, 9.0], [0.0, 0.0], [7.0, 5.0]])
    assert model.log_odds(x).tolist() == [0.5 + 1 + 10 + 1, 0.5 + 2 + 0 + 2, 0.5 + 3 + 10 + 5]


@pytest.mark.parametrize("labels", [[], [1, 1], [0]])
def test_without_both_labels_scores_are_the_smoothed_share(labels):
    x = np.zeros((len(labels), len(FEATURES)))
    p = fit(x, np.array(labels, float)).probability(np.zeros((1, len(FEATURES))))
    assert p[0] == pytest.approx((sum(labels) + 1) / (len(labels) + 2))


def test_held_out_accuracy_and_untouched_rows(spark, documents):
    good = [(i, prose(30 + i % 90, i)) for i in range(300)]
    bad = [(1000 + i, " ".join(w + "$$$" for w in prose(30 + i % 90, i).split())) for i in range(300)]
    rows = good + bad + [(5000 + i, t) for i, t in enumerate(ODD)] + [(None, "no key"), (3, "repeated key")]
    df = documents(rows)
    labels = spark.createDataFrame([(i, 1) for i, _ in good] + [(i, 0) for i, _ in bad] + [(None, 1), (9, None)],
                                   "doc_id long, quality int")
    model = train(df, labels)
    scored = score_quality(df, model).collect()
    assert len(scored) == len(rows) and all(0 <= r.score <= 1 for r in scored)
    from postflow.llm.quality_model import held_out
    held = {r.doc_id for r in df.select("doc_id", held_out().alias("h")).filter("h").collect()}
    own = [(r.doc_id, r.score) for r in scored if r.doc_id in held and r.doc_id < 2000]
    assert len(own) > 60 and np.mean([(s >= 0.7) == (i < 1000) for i, s in own]) > 0.97
    kept = keep_quality(df, model)
    assert kept.schema == df.schema
    assert sorted(map(repr, (r.doc_id for r in kept.collect()))) == sorted(
        repr(r.doc_id) for r in scored if r.score >= 0.7)
    few = train(df, labels, train_rows=50)
    assert few.tables and score_quality(df.filter("doc_id = -1"), few).collect() == []


def test_features_do_not_depend_on_neighbours():
    import pyarrow as pa
    whole = features_of(pa.array(ODD, pa.string()))
    single = np.concatenate([features_of(pa.array([t], pa.string())) for t in ODD])
    assert np.allclose(whole, single) and not whole[0].any() and whole.shape[1] == len(FEATURES)
