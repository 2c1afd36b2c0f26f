"""All metric tables from mergeable parts equal those of grouping sets, without multiplying rows."""

import datetime as dt
import random

import pytest

from ledgerlake.operators import gold

SCHEMA = ("merchant_id string, merchant_category string, country string, payment_method string, "
          "event_timestamp {}, risk_level string, amount double")
AMOUNTS = [0.1, 12.34, -7.25, 1 / 3, 1e12, 99999.995, None]
ODD = [float("nan"), float("inf"), 1e22]


def risk_rows(spark, profile, amounts, n=400):
    r = random.Random(len(amounts))
    time = "timestamp" if profile == "local" else "string"

    def when():
        t = dt.datetime(2024, 1, r.randrange(1, 6), 5)
        return r.choice([t if profile == "local" else t.isoformat(), None])

    rows = [(f"m{r.randrange(9)}", r.choice(["A", "B", None]), r.choice(["US", "CA", None]), r.choice(["CARD", None]),
             when(), r.choice(["HIGH", "LOW"]), r.choice(amounts)) for _ in range(n)]
    return spark.createDataFrame(rows, SCHEMA.format(time))


def rows_of(df, columns):
    return sorted(map(repr, df.select(*columns).collect()))


@pytest.mark.parametrize(("profile", "mode", "amounts"), [
    ("local", "decimal", AMOUNTS), ("local", "decimal", AMOUNTS[:3]), ("local", "decimal", [None]),
    ("local", "exact", AMOUNTS), ("cloud", "decimal", AMOUNTS)], ids=["any", "cents", "null", "exact", "cloud"])
def test_equal_to_grouping_sets(spark, profile, mode, amounts):
    df = risk_rows(spark, profile, amounts)
    sets, rolled = gold.all_metrics(df, profile, mode), gold.rolled_up_metrics(df, profile, mode)
    assert dict(sets.dtypes) == dict(rolled.dtypes)
    assert rows_of(rolled, sets.columns) == rows_of(sets, sets.columns)
    again = gold.rolled_up_metrics(df.repartition(7), profile, mode)
    assert rows_of(again, sets.columns) == rows_of(sets, sets.columns)


def test_amounts_without_digits(spark):
    df = risk_rows(spark, "local", ODD + AMOUNTS[:1])
    sets, rolled = gold.all_metrics(df, "local"), gold.rolled_up_metrics(df, "local")
    assert rows_of(rolled, sets.columns) == rows_of(sets, sets.columns)


def test_no_rows(spark):
    assert gold.rolled_up_metrics(risk_rows(spark, "local", AMOUNTS, 0), "local").count() == 0


def test_rows_are_not_multiplied_and_the_small_grain_is_shuffled_once(spark, lake):
    out = gold.rolled_up_metrics(lake.risk_rows("local"), "local")
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "Expand" not in plan and plan.count("ReusedExchange") == 2
