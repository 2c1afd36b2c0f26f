"""Rule library: one case per fault and per edge input, on every profile."""

import math

import pytest

from ledgerlake.operators.gold import add_risk
from ledgerlake.operators.quality import dedup, validate
from tests.helpers import event, events_df

# one fault at a time over a good event: (what changes, the "rules" profile's codes)
FAULTS = [
    ({}, ""),
    ({"amount": -0.01}, "INVALID_AMOUNT"),
    ({"customer_id": None, "amount": 12.5}, "MISSING_CUSTOMER_ID"),
    ({"currency": "CHF"}, "INVALID_CURRENCY"),
    ({"status": "VOID", "currency": "gbp"}, "INVALID_STATUS"),
    ({"transaction_id": None, "amount": None}, "MISSING_TRANSACTION_ID; MISSING_AMOUNT"),
]


@pytest.mark.parametrize("changes,codes", FAULTS)
def test_codes_of_the_rules_profile(spark, changes, codes):
    assert validate(events_df(spark, event(**changes)), "rules").first().error_reason == codes


def test_copies_of_a_transaction_leave_one_row(spark):
    rows = events_df(spark, event(transaction_id="A"), event(transaction_id="A"), event(transaction_id="B"))
    assert sorted(r.transaction_id for r in dedup(rows, ["transaction_id"]).collect()) == ["A", "B"]


@pytest.mark.parametrize("changes,score,level", [
    ({"amount": 5000.0}, 0, "LOW"), ({"amount": 5000.01}, 30, "MEDIUM"),
    ({"amount": 9000.0, "country": "GB", "status": "DECLINED"}, 70, "HIGH")])
def test_risk_of_one_event(spark, changes, score, level):
    r = add_risk(events_df(spark, event(**changes))).first()
    assert (r.risk_score, r.risk_level) == (score, level)


# -- a good event in both profiles -------------------------------------------
@pytest.mark.parametrize("profile,col,ok", [("local", "error_reason", ""),
                                            ("cloud", "validation_error", None)])
def test_valid_event_both_profiles(spark, profile, col, ok):
    r = validate(events_df(spark, event()), profile).first()
    assert r[col] == ok


# -- edge inputs: (overrides, local error_reason, cloud validation_error) ----
EDGES = [
    ({"currency": None}, "", "INVALID_CURRENCY"),
    ({"status": None}, "", "INVALID_STATUS"),
    ({"transaction_id": "   "}, "", "MISSING_TRANSACTION_ID"),
    ({"customer_id": "   "}, "", "MISSING_CUSTOMER_ID"),
    ({"currency": " usd "}, "", "INVALID_CURRENCY"),
    ({"currency": "\tUSD"}, "INVALID_CURRENCY", "INVALID_CURRENCY"),
    ({"status": " approved"}, "", "INVALID_STATUS"),
    ({"event_timestamp": None}, "INVALID_OR_MISSING_TIMESTAMP", "MISSING_EVENT_TIMESTAMP"),
    ({"event_timestamp": "   "}, "INVALID_OR_MISSING_TIMESTAMP", "MISSING_EVENT_TIMESTAMP"),
    ({"event_timestamp": ""}, "INVALID_OR_MISSING_TIMESTAMP", "MISSING_EVENT_TIMESTAMP"),
    ({"event_timestamp": "not-a-date"}, "INVALID_OR_MISSING_TIMESTAMP", None),
    ({"amount": None}, "MISSING_AMOUNT", "MISSING_AMOUNT"),
    ({"amount": 0.0}, "INVALID_AMOUNT", "INVALID_AMOUNT"),
    ({"amount": -5.0}, "INVALID_AMOUNT", "INVALID_AMOUNT"),
    ({"amount": float("nan")}, "", None),
    ({"amount": -1.0, "currency": "ZZZ", "status": "UNKNOWN", "customer_id": None},
     "MISSING_CUSTOMER_ID; INVALID_AMOUNT; INVALID_CURRENCY; INVALID_STATUS",
     "MISSING_CUSTOMER_ID"),
    ({k: None for k in ("transaction_id", "customer_id", "amount", "currency", "status",
                        "event_timestamp")},
     "MISSING_TRANSACTION_ID; MISSING_CUSTOMER_ID; MISSING_AMOUNT; INVALID_OR_MISSING_TIMESTAMP",
     "MISSING_TRANSACTION_ID"),
]


@pytest.mark.parametrize("overrides,local_code,cloud_code", EDGES)
def test_edge_inputs(spark, overrides, local_code, cloud_code):
    df = events_df(spark, event(**overrides))
    assert validate(df, "local").first().error_reason == local_code
    assert validate(df, "cloud").first().validation_error == cloud_code


def test_validation_never_raises_under_ansi(spark):
    assert spark.conf.get("spark.sql.ansi.enabled") in ("true", None, "True")
    rows = [event(event_timestamp=t) for t in ["", "   ", "garbage", "2024-13-45T99:00:00"]]
    out = validate(events_df(spark, *rows), "local").collect()
    assert all(r.error_reason == "INVALID_OR_MISSING_TIMESTAMP" for r in out)


def test_local_standardises_currency_and_status(spark):
    r = validate(events_df(spark, event(currency=" eur ", status="declined ")), "local").first()
    assert (r.currency, r.status, r.error_reason) == ("EUR", "DECLINED", "")
    r = validate(events_df(spark, event(currency=" eur ")), "cloud").first()
    assert r.currency == " eur "


def test_nan_amount_scores_high_amount(spark):
    r = add_risk(events_df(spark, event(amount=float("nan")))).first()
    assert math.isnan(r.amount) and r.risk_score == 30
