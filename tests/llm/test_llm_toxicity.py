import numpy as np
import pytest
from llm_cases import documents, prose, rows

from lakeops.llm import toxicity
from lakeops.llm.common import table

SF = "/root/testdata/sf0.01"


def test_gradient_is_the_slope_of_the_loss():
    rng = np.random.default_rng(1)
    n, width, grades = 30, 4, 3
    grade = rng.integers(0, grades + 1, n)
    row, col = np.repeat(np.arange(n), 2), rng.integers(0, width, 2 * n)
    val = rng.random(2 * n)
    params = rng.normal(size=width + grades) * 0.5
    at = lambda p: toxicity.loss(p, grade, row, col, val, width, grades, 0.1)
    _, gradient = at(params)
    for k in range(len(params)):
        step = np.eye(len(params))[k] * 1e-6
        assert gradient[k] == pytest.approx((at(params + step)[0] - at(params - step)[0]) / 2e-6, abs=1e-5)


def test_fit_recovers_ordered_grades():
    rng = np.random.default_rng(2)
    n = 3000
    x = rng.normal(size=n)
    grade = np.searchsorted([0.0, 1.0, 2.0], 2 * x + rng.logistic(size=n))
    w, cuts = toxicity.descend(grade, np.arange(n), np.zeros(n, int), x, 1, 3, 0.0, 800)
    assert w[0] == pytest.approx(2, abs=0.2) and cuts == pytest.approx([0, 1, 2], abs=0.2)


def test_held_out_accuracy(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    model = toxicity.train(docs, labels.where("doc_id % 2 = 0"))
    held = labels.where("doc_id % 2 = 1").join(docs.select("doc_id", "lang"), "doc_id")
    scored = toxicity.severity(docs, model).join(held, "doc_id").collect()
    # few texts of the other languages are toxic here, some of them with words no other text has
    english = [r for r in scored if r.lang == "en"]
    right = sum((r.p_toxic >= 0.5) == (r.toxic == 1) for r in english) / len(english)
    assert right >= 0.96
    assert sum(r.p_toxic >= 0.5 and r.toxic == 0 for r in scored) <= 2
    assert list(model.thresholds) == sorted(model.thresholds)


def test_severity_rises_with_grade(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    sample = toxicity.graded(toxicity.labelled_sample(docs, labels))
    grades = {r.doc_id: r.grade for r in sample.collect()}
    assert set(grades.values()) == {0, 1, 2, 3}
    model = toxicity.fit(sample)
    by_grade: dict = {}
    for r in toxicity.severity(docs, model).collect():
        by_grade.setdefault(grades.get(r.doc_id), []).append(r.severity)
    means = [np.mean(by_grade[g]) for g in range(4)]
    assert means == sorted(means)


def test_score_is_the_formula(spark):
    model = toxicity.OrdinalModel(("bad", "awful"), (2.0, 1.0), (1.0, 3.0))
    got = toxicity.severity(documents(spark, ["Bad, bad awful day", None, "", "fine"]), model)
    x = 2 * np.log(3) + np.log(2)
    p = [1 / (1 + np.exp(1 - x)), 1 / (1 + np.exp(3 - x))]
    base = [1 / (1 + np.exp(1)), 1 / (1 + np.exp(3))]
    by_id = {r.doc_id: r for r in got.collect()}
    assert by_id[0].severity == pytest.approx(sum(p)) and by_id[0].p_toxic == pytest.approx(p[0])
    assert by_id[1].severity == by_id[2].severity == by_id[3].severity == pytest.approx(sum(base))
    assert by_id[1].grade == 0


def test_prefixes_are_shared_by_longer_words(spark):
    assert toxicity.features(["lowe", "loweiwei", "a"]) == ["lowe", "loweiwei", "a", "lowe*"]
    model = toxicity.OrdinalModel(("lowe*", "lowe"), (3.0, 1.0), (1.0,))
    got = toxicity.severity(documents(spark, ["loweä Loweiwei", "lowe", "low"]), model).collect()
    x = {0: 3 * np.log(3), 1: np.log(2), 2: 0.0}
    for r in got:
        assert r.severity == pytest.approx(1 / (1 + np.exp(1 - x[r.doc_id])))


def test_odd_labels_and_empty_tables(spark):
    kind = "doc_id long, quality int, toxic int, text string"
    docs = documents(spark, ["a b", None, prose(1, 9000), "a b", ""], ids=[1, 2, 3, 1, None])
    for labels in ([], [(1, 0, None, "x"), (None, 1, 1, "x")], [(1, 1, 0, "x"), (2, 1, 0, "x")], [(9, 1, 1, "x")], [(1, 1, 1, "x"), (1, 0, 0, "x")]):
        model = toxicity.train(docs, spark.createDataFrame(labels, kind))
        got = rows(toxicity.severity(docs, model), "doc_id", "p_toxic")
        assert [r[0] for r in got] == [1, 1, 2, 3, None]
        if not any(t == 1 and d == 1 for d, _, t, _ in labels):
            assert {r[1] for r in got} == {0.0}
    none = documents(spark, [])
    assert toxicity.severity(none, toxicity.train(none, spark.createDataFrame([(1, 1, 1, "")], kind))).count() == 0


def test_sample_is_bounded(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    assert 20 <= toxicity.labelled_sample(docs, labels, 50).count() <= 50
