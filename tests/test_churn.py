from datetime import date, timedelta

import numpy as np
import pytest

from questlog.operators import churn
from questlog.plans.catalog import QUERIES

SCHEMA = (
    "userid long, install_date date, active_days long, sessions long, rounds_played long, "
    "purchases long, revenue_usd double, last_active_day long, churned boolean"
)


def _users(n, seed=1):
    """Users who churn the likelier the fewer days they play, and installed over 30 days."""
    rng = np.random.default_rng(seed)
    days = rng.integers(0, 8, n)
    sessions, rounds, purchases = days + rng.poisson(2, n), rng.poisson(9, n), rng.poisson(0.4, n)
    left = rng.random(n) < 1 / (1 + np.exp(-(1.5 - 0.7 * days - 0.5 * purchases)))
    return [
        (i, date(2024, 1, 1) + timedelta(days=i % 30), int(d), int(s), int(r), int(p), float(p) * 4.99, int(d) - 1 if d else None, bool(c))
        for i, (d, s, r, p, c) in enumerate(zip(days, sessions, rounds, purchases, left))
    ]


def _last_day(spark, day):
    return spark.createDataFrame([(day,)], "day date")


def test_held_out_users_are_ranked(spark):
    features = spark.createDataFrame(_users(4000), SCHEMA)
    scored = churn.churn_scores(features, _last_day(spark, date(2024, 1, 31)))
    rows = scored.collect()
    assert len(rows) == 4000 and all(0 <= r["churn_probability"] <= 1 for r in rows)
    # installed after 18 January: the second week is not over, so nothing is known and nothing learned
    assert {r["userid"] % 30 <= 17 for r in rows if r["labelled"]} == {True}
    assert {r["churned"] for r in rows if not r["labelled"]} == {None}
    assert 0.15 < np.mean([r["held_out"] for r in rows]) < 0.25
    assert churn.held_out_auc(scored) > 0.75


def test_coefficients_equal_a_plain_fit(spark):
    """Newton's method on the same scaled features and penalty."""
    training = churn.prepared(spark.createDataFrame(_users(3000), SCHEMA)).select(*churn.FEATURES, "label")
    model = churn.fit(training, ridge=0.01)
    data = np.array([tuple(r) for r in training.collect()])
    x, y = data[:, :-1], data[:, -1]
    x = np.column_stack([(x - x.mean(axis=0)) / x.std(axis=0, ddof=1), np.ones(len(x))])
    ridge, w = np.diag([0.01] * (x.shape[1] - 1) + [0.0]), np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-x @ w))
        gradient = x.T @ (p - y) / len(y) + ridge @ w
        w -= np.linalg.solve((x.T * (p * (1 - p))) @ x / len(y) + ridge, gradient)
    fitted = model.stages[-1]
    assert np.allclose([*fitted.coefficients, fitted.intercept], w, atol=1e-4)


@pytest.mark.parametrize("churned", [True, False, None])
def test_one_class_or_none_to_learn_from(spark, churned):
    rows = [(*r[:-1], bool(churned)) for r in _users(50)]
    until = None if churned is None else date(2024, 3, 1)
    scored = churn.churn_scores(spark.createDataFrame(rows, SCHEMA), _last_day(spark, until))
    assert {r["churn_probability"] for r in scored.collect()} == {None if churned is None else float(churned)}
    assert churn.churn_scores(spark.createDataFrame([], SCHEMA), _last_day(spark, until)).count() == 0


def test_query_scores_every_user(spark, sf_dir):
    users = QUERIES["churn_features"](spark, sf_dir).select("userid")
    scored = QUERIES["churn_scores"](spark, sf_dir)
    assert scored.columns == ["userid", "labelled", "held_out", "churned", "churn_probability"]
    assert scored.select("userid").exceptAll(users).isEmpty() and scored.count() == users.count() > 0
