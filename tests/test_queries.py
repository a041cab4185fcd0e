import pytest

import __spark_entry__ as contract
from questlog.plans.catalog import QUERIES
from questlog.plans.oracle import ORACLE_SQL
from tests.compare import compare, duck

# A fitted model has no SQL; tests/test_churn.py holds it against a plain fit.
WITHOUT_SQL = {"churn_scores"}
KEYS = sorted(set(QUERIES) - WITHOUT_SQL)


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


def test_every_query_has_sql():
    assert set(ORACLE_SQL) == set(KEYS) and set(QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("key", KEYS)
def test_query_equals_sql(spark, con, sf_dir, key):
    assert compare(spark, con, QUERIES[key], ORACLE_SQL[key], sf_dir) == []


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_invariants(spark, sf_dir):
    """Nothing is lost between the layers."""
    q = QUERIES

    def total(key, column):
        return q[key](spark, sf_dir).agg({column: "sum"}).first()[0]

    users = q["users_dim"](spark, sf_dir).count()
    for key in ("dq_orphan_sessions", "dq_duplicate_assignments"):
        assert q[key](spark, sf_dir).count() > 0
    assert q["sessions"](spark, sf_dir).where("session_start IS NULL").count() > 0
    assert total("sessions", "event_count") == q["events_clean"](spark, sf_dir).count()
    # spend is per user, so an assignment delivered twice counts once there
    once = q["users_dim"](spark, sf_dir).distinct().count()
    assert total("mart_monetization_summary", "users") == once < users
    assert total("mart_engagement_segment_summary", "users") == users
    ltv = q["mart_ltv_curve"](spark, sf_dir).collect()
    for a, b in zip(ltv, ltv[1:]):
        if a["ab_version"] == b["ab_version"]:
            assert a["cumulative_revenue"] <= b["cumulative_revenue"]
