"""Class weights (exact) and the weighted logistic regression (rows, ranges)."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_CHECK

from __spark_entry__ import queries
from promoscope.operators import scoring


def test_class_weights_exact(spark):
    train = spark.createDataFrame([(1, 1, 1), (2, 1, 0), (3, 1, 0), (4, 1, 0), (5, 1, None)],
                                  "user_id long, merchant_id long, label int")
    w = {r.user_id: r.classWeights for r in scoring.with_class_weights(train).collect()}
    # 5 rows, 1 positive: ratio = 4/5 for label 1, 1/5 for the rest.
    assert w == {1: pytest.approx(0.8), 2: pytest.approx(0.2), 3: pytest.approx(0.2),
                 4: pytest.approx(0.2), 5: pytest.approx(0.2)}
    b = scoring.class_balance(train).collect()[0]
    assert (b.total, b.ones, b.zeros) == (5, 1, 4)
    assert b.percent_ones == pytest.approx(20.0)
    assert b.balancing_ratio == pytest.approx(0.8)


def test_weights_of_the_fit_leave_incomplete_rows_out(spark):
    names = ", ".join(f"{c} int" for c in scoring.FEATURES)
    rows = [(i, 1, i % 2, *[i] * 10) for i in range(4)] + [(9, 1, 1, None, *[0] * 9)] * 3
    df = spark.createDataFrame(rows, f"user_id int, merchant_id int, label int, {names}")
    weights = scoring.fit_weights(df).collect()
    assert len(weights) == 4 and {r.classWeights for r in weights} == {0.5}


def test_label_is_not_a_function_of_the_features(spark):
    # Shares of ones alike at different scales, pairs without features.
    from promoscope.sources.driver_tables import Tables
    for d in ("/root/testdata/sf0.001", SF_CHECK, "/root/testdata/sf0.1"):
        b = scoring.class_balance(Tables(spark, d).train_pairs()).first()
        assert 20 < b.percent_ones < 60, (d, b)
    table = queries()["train_features"](spark, SF_CHECK)
    missing = table.where("total_logs IS NULL").count()
    assert 0 < missing < table.count()


@pytest.fixture(scope="module")
def scored(spark):
    q = queries()
    return {
        "train": q["train_scores"](spark, SF_CHECK).toPandas(),
        "acc": q["train_accuracy"](spark, SF_CHECK).toPandas(),
        "test": q["test_scores"](spark, SF_CHECK).toPandas(),
        "refit": q["test_scores_refit"](spark, SF_CHECK).toPandas(),
        "test_pairs": q["test_pairs"](spark, SF_CHECK).count(),
        "train_filled": q["train_filled"](spark, SF_CHECK),
    }


def test_every_test_pair_scored(scored):
    assert len(scored["test"]) == scored["test_pairs"]
    assert len(scored["refit"]) == scored["test_pairs"]
    for key in ("test", "refit"):
        p = scored[key]["prob"]
        assert p.notna().all() and (p >= 0).all() and (p <= 1).all()


def test_every_training_row_comes_back(scored):
    filled = scored["train_filled"]
    complete = filled.dropna(subset=list(scoring.FEATURES)).count()
    assert len(scored["train"]) == filled.count() > complete
    assert int(scored["train"]["prob"].notna().sum()) == complete
    assert scoring.skipped_rows(filled).first()["skipped"] == filled.count() - complete
    assert int(scored["acc"]["count"].sum()) == complete
    assert set(scored["acc"]["correct"]) <= {0, 1}


def test_model_is_stable_across_runs(spark, scored):
    again = queries()["test_scores"](spark, SF_CHECK).toPandas()
    a = scored["test"].sort_values(["user_id", "merchant_id"])["prob"].to_numpy()
    b = again.sort_values(["user_id", "merchant_id"])["prob"].to_numpy()
    assert abs(a - b).max() < 1e-5


def test_prob_is_float_column(spark):
    df = queries()["test_scores"](spark, "/root/testdata/sf0.001")
    assert dict(df.dtypes)["prob"] == "float"
    assert df.filter(F.col("prob").isNull()).count() == 0


@pytest.fixture(scope="module")
def optimum(spark):
    """Rows of the fit, and the probabilities of numpy's own Newton steps."""
    import numpy as np

    filled = queries()["train_filled"](spark, SF_CHECK).persist()
    rows = scoring.fit_weights(filled).toPandas()
    x = rows[list(scoring.FEATURES)].to_numpy(float)
    sd = x.std(0, ddof=1)
    z = np.c_[np.ones(len(x)), np.divide(x, sd, out=np.zeros_like(x), where=sd > 0)]
    y, w = rows["label"].to_numpy(float), rows["classWeights"].to_numpy()
    # Least solution with features of weighted deviation 1, as from a start at 0.
    mean = (w[:, None] * z).sum(0) / w.sum()
    unit = np.sqrt((w[:, None] * (z - mean) ** 2).sum(0))
    unit[unit == 0] = 1
    b = np.zeros(z.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-z @ b))
        u = z / unit
        b = b + np.linalg.pinv(u.T @ (u * (w * p * (1 - p))[:, None]), rcond=1e-10) @ (u.T @ (w * (y - p))) / unit

    def loss(b):
        t = z @ b
        return float((w * (np.logaddexp(0, t) - y * t)).sum() / w.sum())

    yield filled, b, loss
    filled.unpersist()


def _coefficients(model):
    import numpy as np
    lr = model.stages[-1]
    return np.r_[lr.intercept, lr.coefficients.toArray()]


def test_converged_coefficients_are_those_of_an_independent_solver(optimum):
    filled, want, loss = optimum
    got = _coefficients(scoring.fit(filled, *scoring.CONVERGED))
    assert abs(got - want).max() < 1e-4
    assert abs(want).max() > 0.05  # not the constant model


def test_ten_iterations_come_near_the_least_loss(optimum):
    filled, want, loss = optimum
    ten = loss(_coefficients(scoring.fit(filled)))
    constant = loss(want * 0)
    assert loss(want) <= ten <= loss(want) + 0.01 * (constant - loss(want))


def test_probability_of_one_is_the_second_as_a_float(spark, optimum):
    import numpy as np
    filled, _, _ = optimum
    scored = scoring.transform(scoring.fit(filled), filled)
    both = scored.select("user_id", "merchant_id", "probability").join(
        scoring.prob_of_one(scored), ["user_id", "merchant_id"]).collect()
    assert both and all((r.probability is None and r.prob is None)
                        or np.float32(r.probability[1]) == np.float32(r.prob) for r in both)
