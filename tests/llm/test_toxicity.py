import numpy as np
import pytest

from wicketflow.llm import queries, toxicity

BASE = "/root/testdata/sf0.1"


def test_held_out_rows(spark):
    docs = spark.read.parquet(f"{BASE}/documents.parquet")
    labels = spark.read.parquet(f"{BASE}/labels.parquet")
    learn = labels.where("pmod(xxhash64(doc_id), 4) > 0")
    rows, toxic = toxicity.labelled_sample(docs, learn, "doc_id", "text", "toxic")
    assert len(rows) == len(toxic) == learn.count()
    model = toxicity.fit(rows, toxicity.severity_grades(rows, toxic))
    scored = toxicity.predict(docs.select("doc_id", "text"), model)
    held = labels.where("pmod(xxhash64(doc_id), 4) = 0").join(scored, "doc_id").collect()
    right = [(r.expected_severity >= 0.5) == bool(r.toxic) for r in held]
    assert len(right) > 60 and np.mean(right) >= 0.95


def test_thresholds_are_ordered_and_the_fit_is_an_optimum():
    rng = np.random.default_rng(5)
    rows = [np.unique(rng.integers(0, 12, 5)).astype(np.int32) for _ in range(400)]
    strength = np.array([np.sum(r < 3) for r in rows])
    grades = np.clip(strength, 0, 2)
    model = toxicity.fit(rows, grades, buckets=12, penalty=1e-2, rounds=3_000, rate=0.02)
    assert (np.diff(model.thresholds) > 0).all()

    def loss(weights, thresholds):
        above = toxicity.OrdinalModel(weights, thresholds).above(
            np.array([weights[r].sum() for r in rows]))
        edges = np.concatenate((np.ones((400, 1)), above, np.zeros((400, 1))), axis=1)
        share = -np.diff(edges, axis=1)[np.arange(400), grades]
        weight = 1 / np.bincount(grades)[grades] / 3
        return -(weight * np.log(share)).sum() + 1e-2 / 2 * (weights ** 2).sum()

    weights = model.weights.astype(np.float64)
    best = loss(weights, model.thresholds)
    for _ in range(50):
        moved = loss(weights + rng.normal(0, 0.05, 12), model.thresholds + rng.normal(0, 0.05, 2))
        assert moved >= best - 1e-6
    severity = model.above(model.score(rows)).sum(axis=1)
    assert np.mean(severity[grades == 2]) > np.mean(severity[grades == 1]) \
        > np.mean(severity[grades == 0])


@pytest.mark.parametrize("labels", [[], [0, 0, 0], [1, 1, 1], [0, 3, 0, 2, 1, 3]])
def test_few_and_other_labels(spark, odd, labels):
    docs = odd.where("doc_id is not null").select("doc_id", "text")
    marks = spark.createDataFrame(list(enumerate(labels)), "doc_id long, toxic int")
    rows, toxic = toxicity.labelled_sample(docs, marks, "doc_id", "text", "toxic")
    assert sorted(toxic) == sorted(v for i, v in enumerate(labels) if i != 5)
    grades = toxicity.severity_grades(rows, toxic)
    assert ((grades > 0) == (toxic > 0)).all()
    got = toxicity.predict(docs, toxicity.fit(rows, grades)).collect()
    assert len(got) == docs.count()
    if not any(labels):
        assert {(r.expected_severity, r.severity) for r in got} == {(0.0, 0)}


def test_many_label_values_are_all_taken(spark):
    docs = spark.createDataFrame([(i, f"word{i}") for i in range(40)], "doc_id long, text string")
    marks = spark.createDataFrame([(i, i) for i in range(40)], "doc_id long, toxic int")
    assert len(toxicity.labelled_sample(docs, marks, "doc_id", "text", "toxic")[1]) == 40


def test_the_fit_is_the_likeliest_by_a_plain_search():
    """Two words, three grades: no point of a grid is better by the likelihood as written."""
    rng = np.random.default_rng(8)
    rows = [np.flatnonzero(rng.random(2) < 0.5).astype(np.int32) for _ in range(200)]
    grades = np.array([min(2, int(0 in r) + int(1 in r and rng.random() < 0.7)) for r in rows])
    model = toxicity.fit(rows, grades, buckets=2, penalty=0.05, rounds=4_000, rate=0.02)

    def loss(a, b, first, second):
        total, sizes = 0.0, np.bincount(grades)
        for r, g in zip(rows, grades):
            score = a * (0 in r) + b * (1 in r)
            up_to = [1 / (1 + np.exp(score - t)) for t in (first, second)] + [1.0]
            p = up_to[g] - (up_to[g - 1] if g else 0.0)
            total -= np.log(p) / sizes[g] / 3
        return total + 0.05 / 2 * (a * a + b * b)

    found = loss(*map(float, model.weights), *map(float, model.thresholds))
    for a in np.arange(-1, 4, 0.5):
        for b in np.arange(-1, 4, 0.5):
            for first in (-0.5, 0.5, 1.0):
                for gap in (0.5, 1.5):
                    assert found <= loss(a, b, first, first + gap) + 1e-6


def test_sample_is_bounded_and_takes_the_larger_label(spark):
    docs = spark.createDataFrame([(i, f"word{i}") for i in range(40)], "doc_id long, text string")
    labels = spark.createDataFrame(
        [(i, i % 2) for i in range(40)] + [(0, 1), (1, None), (None, 1), (99, 1)],
        "doc_id long, toxic int")
    rows, toxic = toxicity.labelled_sample(docs, labels, "doc_id", "text", "toxic")
    assert len(rows) == 40 and toxic.sum() == 21
    rows, toxic = toxicity.labelled_sample(docs, labels, "doc_id", "text", "toxic", bound=5)
    assert (toxic == 0).sum() <= 5 and (toxic == 1).sum() <= 5
    none = toxicity.labelled_sample(docs, labels.where("false"), "doc_id", "text", "toxic")
    assert none[0] == [] and len(none[1]) == 0


def test_odd_rows(odd):
    model = toxicity.OrdinalModel(np.linspace(-1, 1, 64, dtype=np.float32), np.array([0.0, 1.0]))
    got = toxicity.predict(odd, model).collect()
    assert len(got) == odd.count()
    for r in got:
        above = model.above(model.score([toxicity.features(r.text, 64)]))[0]
        assert r.expected_severity == pytest.approx(above.sum())
        assert r.severity == np.argmax(-np.diff([1, *above, 0]))
    assert toxicity.predict(odd.where("false"), model).count() == 0


def test_query_keeps_every_document(spark, documents, small):
    assert queries.op6_toxicity(spark, small).count() == documents.count()
