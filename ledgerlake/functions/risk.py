"""Explainable additive risk score and its level bands (pure expressions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlake.schema import HIGH_AMOUNT, HOME_COUNTRY

# ---------------------------------------------------------------------------
# Weights and bands (must equal the reference's)
# ---------------------------------------------------------------------------
HIGH_AMOUNT_POINTS = 30
FOREIGN_POINTS = 20
DECLINED_POINTS = 20
HIGH_FROM = 60
MEDIUM_FROM = 30
DECLINED = "DECLINED"
# ---------------------------------------------------------------------------


def risk_score(amount: str = "amount", country: str = "country", status: str = "status",
               high_amount: float = HIGH_AMOUNT, home_country: str = HOME_COUNTRY) -> Column:
    """Sum of the fired factors. A NULL input fires nothing (CASE -> ELSE 0)."""
    return (
        F.when(F.col(amount) > high_amount, F.lit(HIGH_AMOUNT_POINTS)).otherwise(F.lit(0))
        + F.when(F.col(country) != home_country, F.lit(FOREIGN_POINTS)).otherwise(F.lit(0))
        + F.when(F.col(status) == DECLINED, F.lit(DECLINED_POINTS)).otherwise(F.lit(0))
    )


def risk_level(score: str = "risk_score") -> Column:
    s = F.col(score)
    return (F.when(s >= HIGH_FROM, F.lit("HIGH"))
            .when(s >= MEDIUM_FROM, F.lit("MEDIUM"))
            .otherwise(F.lit("LOW")))
