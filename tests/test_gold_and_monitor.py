"""Gold metrics, money modes, monitoring record, and the end-to-end invariants."""

import math

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators import gold, monitor
from ledgerlake.operators.quality import quality_layers
from tests.helpers import event, events_df, with_lineage


def test_metric_shapes_per_profile(spark, lake):
    for p, total in (("local", "total_transaction_amount"), ("cloud", "total_transaction_value")):
        risk = lake.risk_rows(p)
        assert gold.gold_metric(risk, "payment", p).columns == [
            "payment_method", "transaction_count", total]
    assert gold.gold_metric(lake.risk_rows("local"), "merchant", "local").columns[:2] == [
        "merchant_id", "merchant_category"]
    assert gold.gold_metric(lake.risk_rows("cloud"), "merchant", "cloud").columns[0] == \
        "merchant_category"
    assert "average_transaction_amount" in gold.gold_metric(lake.risk_rows("local"), "daily",
                                                            "local").columns
    assert gold.gold_metric(lake.risk_rows("cloud"), "daily", "cloud").columns == [
        "transaction_date", "transaction_count", "total_transaction_value"]


def test_local_gold_sort_orders(spark, lake):
    risk = lake.risk_rows("local")
    daily = [r.transaction_date for r in gold.gold_metric(risk, "daily", "local").collect()]
    assert daily == sorted(daily)
    country = [r.total_transaction_amount for r in gold.gold_metric(risk, "country").collect()]
    assert country == sorted(country, reverse=True)
    pay = [r.transaction_count for r in gold.gold_metric(risk, "payment").collect()]
    assert pay == sorted(pay, reverse=True)
    levels = [r.risk_level for r in gold.gold_metric(risk, "risk_summary").collect()]
    assert levels == ["HIGH", "LOW", "MEDIUM"]


@pytest.mark.parametrize("mode", ["decimal", "double"])
def test_money_loses_no_amount(spark, mode):
    def of(*amounts):
        df = events_df(spark, *[event(amount=a) for a in amounts])
        r = gold.metrics(df, ["currency"], "t", "a", mode).first()
        return r.t, r.a, r.transaction_count

    assert of(0.1, 0.2) == (0.3, 0.15, 2)
    assert all(map(math.isnan, of(0.1, 0.2, float("nan"))[:2]))
    assert of(1e17, 10.0) == (1e17 + 10, (1e17 + 10) / 2, 2)
    assert of(1e17, 10.0, float("inf"))[:2] == (math.inf, math.inf)
    assert all(map(math.isnan, of(1e17, 10.0, float("inf"), float("nan"))[:2]))
    assert of(*[0.004] * 1000)[0] == 4.0
    assert of(None, 0.5) == (0.5, 0.5, 2)
    assert of(None) == (None, None, 1)


def test_money_keeps_one_exchange(spark):
    plan = gold.metrics(events_df(spark, event()), ["currency"], "t", "a")._jdf.queryExecution().executedPlan()
    assert plan.toString().count("Exchange") == 1


def test_half_cent_average_rounds_half_up(spark):
    df = events_df(spark, event(amount=0.01), event(amount=0.02))
    assert gold.metrics(df, ["currency"], "t", "a").first().a == 0.02


def test_cloud_daily_keeps_unparsable_dates_as_null_group(spark):
    rows = [(event(event_timestamp="not-a-date"), 0, 1),
            (event(transaction_id="T2", event_timestamp="2024-01-02T23:30:00+00:00"), 0, 2)]
    b = with_lineage(spark, rows, "eventhub")
    silver, _, _ = quality_layers(b, "cloud")
    daily = {r.transaction_date: r.transaction_count
             for r in gold.gold_metric(gold.add_risk(silver), "daily", "cloud").collect()}
    assert daily == {None: 1, __import__("datetime").date(2024, 1, 2): 1}


def test_empty_bronze_metrics_do_not_divide_by_zero(spark):
    b = with_lineage(spark, []).withColumn("ingestion_timestamp", F.current_timestamp())
    silver, quarantine, _ = quality_layers(b, "local")
    m = monitor.monitoring_record(b, silver, quarantine, gold.add_risk(silver)).first()
    assert m.bronze_records == 0 and m.silver_retention_rate_percent is None


# -- FIXTURES.md section 4 at sf0.001 -----------------------------------------
EXPECTED = {
    "local": dict(bronze=1516, valid=1433, silver=1417, quarantine=83,
                  levels={"HIGH": (21, 164710.67), "MEDIUM": (720, 5282813.09),
                          "LOW": (676, 1649427.16)}, total=7096950.92, daily=1054),
    "cloud": dict(bronze=1516, valid=1427, silver=1411, quarantine=89,
                  levels={"HIGH": (21, 164710.67), "MEDIUM": (718, 5268038.07),
                          "LOW": (672, 1645258.58)}, total=7078007.32, daily=1052),
}


@pytest.mark.parametrize("p", ["local", "cloud"])
def test_expected_values_and_invariants(spark, lake, p):
    e = EXPECTED[p]
    m = monitor.monitoring_record(lake.bronze(p), lake.silver(p), lake.quarantine(p),
                                  lake.risk_rows(p)).first()
    assert (m.bronze_records, m.silver_records, m.quarantined_records) == (
        e["bronze"], e["silver"], e["quarantine"])
    # bronze = silver + quarantine + removed duplicates
    d = monitor.duplicates_removed(lake.valid_before_dedup(p), lake.silver(p)).first()
    assert d.valid_before_dedup == e["valid"]
    assert m.records_removed_during_quality_processing == d.duplicates_removed
    # gold rows = silver = sum of levels
    assert m.gold_risk_records == m.silver_records == (
        m.high_risk_transactions + m.medium_risk_transactions + m.low_risk_transactions)
    summary = {r.risk_level: (r.transaction_count, r[2])
               for r in lake.gold("risk_summary", p).collect()}
    assert summary == e["levels"]
    # sum over countries = sum over payment methods = total value
    total = monitor.total_value(lake.silver(p)).first().total_transaction_value
    assert total == e["total"]
    total_col = "total_transaction_amount" if p == "local" else "total_transaction_value"
    for name in ("country", "payment", "merchant"):
        assert round(sum(r[total_col] for r in lake.gold(name, p).collect()), 2) == total
    assert lake.gold("daily", p).count() == e["daily"]
    # write-time observations agree with the read-back layers
    counts = lake.counts[p]
    assert (counts["bronze_records"], counts["silver_records"], counts["quarantined_records"],
            counts["valid_before_dedup"], counts["gold_risk_records"]) == (
        e["bronze"], e["silver"], e["quarantine"], e["valid"], e["silver"])


def test_top_k_preview(spark, lake):
    risk = lake.risk_rows("local")
    got = gold.top(risk, 5, [F.col("amount").desc(), F.col("transaction_id")]).collect()
    want = sorted(risk.select("amount", "transaction_id").collect(),
                  key=lambda r: (-r.amount, r.transaction_id))[:5]
    assert [(r.amount, r.transaction_id) for r in got] == [tuple(r) for r in want]


@pytest.mark.parametrize("p", ["local", "cloud"])
def test_grouping_sets_equal_separate_aggregates(spark, lake, p):
    risk = lake.risk_rows(p)
    combined = gold.all_metrics(risk, p)
    for name in gold.metric_specs(p):
        one = gold.metric_from_all(combined, name, p)
        sep = gold.gold_metric(risk, name, p)
        assert one.columns == sep.columns
        ours, theirs = [tuple(r) for r in one.collect()], [tuple(r) for r in sep.collect()]
        if p == "local":                     # ordered tables: the exact order
            assert ours == theirs
        assert sorted(ours, key=repr) == sorted(theirs, key=repr)


def test_order_of_the_local_tables(spark, lake):
    rows = {name: lake.gold(name, "local").collect() for name in gold.metric_specs("local")}
    assert [r.transaction_date for r in rows["daily"]] == sorted(r.transaction_date for r in rows["daily"])
    for name, keys in (("merchant", ("merchant_id", "merchant_category")), ("country", ("country",))):
        order = [(-r.total_transaction_amount, *(getattr(r, k) or "" for k in keys)) for r in rows[name]]
        assert order == sorted(order) and len(order) > 4
    order = [(-r.transaction_count, r.payment_method) for r in rows["payment"]]
    assert order == sorted(order)
    assert [r.risk_level for r in rows["risk_summary"]] == ["HIGH", "LOW", "MEDIUM"]


@pytest.mark.parametrize("p", ["local", "cloud"])
def test_one_exchange_for_all_metrics(spark, lake, p):
    combined = gold.all_metrics(lake.risk_rows(p), p)
    plan = combined._jdf.queryExecution().executedPlan().toString()
    assert "Expand" in plan and plan.count("Exchange") == 1


def test_double_money_mode_agrees_to_the_cent(spark, lake):
    risk = lake.risk_rows("local")
    keys = ["metric", "transaction_date", "merchant_id", "merchant_category", "country",
            "payment_method", "risk_level"]
    dec = {tuple(r[k] for k in keys): r for r in gold.all_metrics(risk, "local").collect()}
    dbl = {tuple(r[k] for k in keys): r
           for r in gold.all_metrics(risk, "local", "double").collect()}
    assert dec.keys() == dbl.keys() and len(dec) == 1054 + 1417 + 5 + 4 + 3
    for k in dec:
        assert abs(dec[k].total_transaction_amount - dbl[k].total_transaction_amount) < 0.011
        assert abs(dec[k].average_transaction_amount - dbl[k].average_transaction_amount) < 0.011


# FIXTURES.md section 4, sf0.001: error histograms and country metrics
HISTOGRAM = {
    "local": {"": 1433, "MISSING_TRANSACTION_ID": 2, "MISSING_CUSTOMER_ID": 15,
              "MISSING_AMOUNT": 2, "INVALID_AMOUNT": 15, "INVALID_AMOUNT; INVALID_CURRENCY": 2,
              "INVALID_CURRENCY": 15, "INVALID_STATUS": 15, "INVALID_OR_MISSING_TIMESTAMP": 17},
    "cloud": {None: 1427, "MISSING_TRANSACTION_ID": 2, "MISSING_CUSTOMER_ID": 17,
              "MISSING_AMOUNT": 2, "INVALID_AMOUNT": 17, "INVALID_CURRENCY": 19,
              "INVALID_STATUS": 17, "MISSING_EVENT_TIMESTAMP": 15},
}
COUNTRY = {
    "local": {"US": (890, 4395900.67, 4939.21), "CA": (174, 900082.49, 5172.89),
              "GB": (183, 990964.22, 5415.11), "DE": (168, 799763.79, 4760.50),
              None: (2, 10239.75, 5119.88)},
    "cloud": {"US": (886, 4377521.19, 4940.77), "CA": (174, 904776.25, 5199.86),
              "GB": (182, 981719.81, 5394.06), "DE": (167, 803750.32, 4812.88),
              None: (2, 10239.75, 5119.88)},
}


@pytest.mark.parametrize("p", ["local", "cloud"])
def test_fixture_histogram_and_countries(spark, lake, p):
    err = "error_reason" if p == "local" else "validation_error"
    hist = {r[err]: r["count"] for r in lake.validated(p).groupBy(err).count().collect()}
    assert hist == HISTOGRAM[p]
    got = {r.country: (r.transaction_count, r[2], r[3]) for r in lake.gold("country", p).collect()}
    assert got == COUNTRY[p]


def test_gold_tables_lazy_api(spark, lake):
    tables = gold.gold_tables(lake.silver("cloud"), "cloud")
    assert set(tables) == {"risk_rows", "daily", "merchant", "country", "payment", "risk_summary"}
    assert tables["risk_summary"].count() == 3 and tables["merchant"].count() == 8
