"""Risk score and level: every reachable score, boundaries, NULL inputs."""

import pytest

from ledgerlake.operators.gold import add_risk
from tests.helpers import event, events_df

CASES = [
    # amount, country, status -> score, level
    (100.0, "US", "APPROVED", 0, "LOW"),
    (100.0, "DE", "APPROVED", 20, "LOW"),
    (100.0, "US", "DECLINED", 20, "LOW"),
    (7500.0, "US", "APPROVED", 30, "MEDIUM"),
    (100.0, "DE", "DECLINED", 40, "MEDIUM"),
    (7500.0, "DE", "APPROVED", 50, "MEDIUM"),
    (7500.0, "US", "DECLINED", 50, "MEDIUM"),
    (7500.0, "GB", "DECLINED", 70, "HIGH"),
    (5000.00, "US", "APPROVED", 0, "LOW"),
    (5000.01, "US", "APPROVED", 30, "MEDIUM"),
    (7500.0, None, "DECLINED", 50, "MEDIUM"),
    (7500.0, "CA", None, 50, "MEDIUM"),
    (None, "CA", "DECLINED", 40, "MEDIUM"),
]


@pytest.mark.parametrize("amount,country,status,score,level", CASES)
def test_score_and_level(spark, amount, country, status, score, level):
    r = add_risk(events_df(spark, event(amount=amount, country=country, status=status))).first()
    assert (r.risk_score, r.risk_level) == (score, level)


def test_score_is_int_and_non_null(spark):
    df = add_risk(events_df(spark, event(amount=None, country=None, status=None)))
    assert dict(df.dtypes)["risk_score"] == "int"
    assert df.first().risk_score == 0
