"""Declarative data-quality rules and the two validation profiles.

A rule is ``(code, predicate)``; a predicate is a plain Spark ``Column``
that is TRUE when the row fails.  A profile is an ordered rule list plus how
failures are reported:

* ``all``   -- every failing code in rule order, ``"; "``-joined; a valid row
  gets ``""`` (``concat_ws`` skips NULLs, so the column is never NULL).
* ``first`` -- the first failing code in rule order; a valid row gets NULL.

Predicates follow SQL three-valued logic on purpose: in the ``local``
profile ``NOT (currency IN (...))`` is NULL for a NULL currency, so the rule
does not fire and the row passes.  The ``cloud`` profile tests NULL
explicitly.  Do not "fix" one into the other; both are reproduced.

Everything here is a JVM-side expression (CASE / concat_ws / IN), so the
whole validation is one codegen'd projection -- no UDF, no shuffle.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlake.schema import VALID_CURRENCIES, VALID_STATUSES

PARSED_TS = "event_timestamp_parsed"


@dataclass(frozen=True)
class Rule:
    code: str
    predicate: Callable[[], Column]

    def failure(self) -> Column:
        """The rule's code where it fails, else NULL."""
        return F.when(self.predicate(), F.lit(self.code))


def _blank(name: str) -> Column:
    c = F.col(name)
    return c.isNull() | (F.trim(c) == "")


def parse_event_time(c: Column) -> Column:
    """ISO-8601 text -> timestamp; NULL (never an error) when unparsable.

    ``try_to_timestamp`` instead of ``to_timestamp``: with ANSI mode on (the
    Spark 4 default) the latter raises on ``''`` or ``'not-a-date'``, which
    would fail the whole job on a single bad record.
    """
    return F.try_to_timestamp(c)


# ---------------------------------------------------------------------------
# Rule codes (must equal the reference's for identical results)
# ---------------------------------------------------------------------------
MISSING_TRANSACTION_ID = "MISSING_TRANSACTION_ID"
MISSING_CUSTOMER_ID = "MISSING_CUSTOMER_ID"
MISSING_AMOUNT = "MISSING_AMOUNT"
INVALID_AMOUNT = "INVALID_AMOUNT"
INVALID_CURRENCY = "INVALID_CURRENCY"
INVALID_STATUS = "INVALID_STATUS"
INVALID_OR_MISSING_TIMESTAMP = "INVALID_OR_MISSING_TIMESTAMP"
MISSING_EVENT_TIMESTAMP = "MISSING_EVENT_TIMESTAMP"
# ---------------------------------------------------------------------------

LOCAL_RULES = (
    Rule(MISSING_TRANSACTION_ID, lambda: F.col("transaction_id").isNull()),
    Rule(MISSING_CUSTOMER_ID, lambda: F.col("customer_id").isNull()),
    Rule(MISSING_AMOUNT, lambda: F.col("amount").isNull()),
    Rule(INVALID_AMOUNT, lambda: F.col("amount") <= 0),
    Rule(INVALID_CURRENCY, lambda: ~F.col("currency").isin(VALID_CURRENCIES)),
    Rule(INVALID_STATUS, lambda: ~F.col("status").isin(VALID_STATUSES)),
    Rule(INVALID_OR_MISSING_TIMESTAMP, lambda: F.col(PARSED_TS).isNull()),
)

CLOUD_RULES = (
    Rule(MISSING_TRANSACTION_ID, lambda: _blank("transaction_id")),
    Rule(MISSING_CUSTOMER_ID, lambda: _blank("customer_id")),
    Rule(MISSING_AMOUNT, lambda: F.col("amount").isNull()),
    Rule(INVALID_AMOUNT, lambda: F.col("amount") <= 0),
    Rule(INVALID_CURRENCY,
         lambda: F.col("currency").isNull() | ~F.col("currency").isin(VALID_CURRENCIES)),
    Rule(INVALID_STATUS,
         lambda: F.col("status").isNull() | ~F.col("status").isin(VALID_STATUSES)),
    Rule(MISSING_EVENT_TIMESTAMP, lambda: _blank("event_timestamp")),
)

# The rule set the reference's unit tests exercise: the local rules without
# the timestamp rule, with standardisation.
UNIT_RULES = LOCAL_RULES[:6]


@dataclass(frozen=True)
class Profile:
    name: str
    rules: tuple[Rule, ...]
    mode: str                      # "all" | "first"
    error_column: str
    standardise: bool              # upper(trim()) currency and status
    parse_timestamp: bool          # add the parsed event time before the rules
    lineage_prefix: str            # kafka_ / eventhub_ lineage columns
    money_suffix: str              # total_transaction_<suffix>
    merchant_keys: tuple[str, ...]
    daily_average: bool            # daily metrics carry an average
    sorted_gold: bool              # gold tables carry a sort order

    @property
    def total_name(self) -> str:
        return f"total_transaction_{self.money_suffix}"

    @property
    def average_name(self) -> str:
        return f"average_transaction_{self.money_suffix}"


LOCAL = Profile(
    name="local", rules=LOCAL_RULES, mode="all", error_column="error_reason",
    standardise=True, parse_timestamp=True, lineage_prefix="kafka",
    money_suffix="amount", merchant_keys=("merchant_id", "merchant_category"),
    daily_average=True, sorted_gold=True,
)

CLOUD = Profile(
    name="cloud", rules=CLOUD_RULES, mode="first", error_column="validation_error",
    standardise=False, parse_timestamp=False, lineage_prefix="eventhub",
    money_suffix="value", merchant_keys=("merchant_category",),
    daily_average=False, sorted_gold=False,
)

# The rule module the reference unit-tests: local rules without the timestamp
# rule, so it runs on frames that carry no event time.
RULES_ONLY = Profile(
    name="rules", rules=UNIT_RULES, mode="all", error_column="error_reason",
    standardise=True, parse_timestamp=False, lineage_prefix="kafka",
    money_suffix="amount", merchant_keys=("merchant_id", "merchant_category"),
    daily_average=True, sorted_gold=True,
)

PROFILES = {"local": LOCAL, "cloud": CLOUD, "rules": RULES_ONLY}


def get_profile(profile: str | Profile) -> Profile:
    return profile if isinstance(profile, Profile) else PROFILES[profile]


def all_failures(rules: tuple[Rule, ...], sep: str = "; ") -> Column:
    """Every failing code, in rule order; ``""`` when none fails."""
    return F.concat_ws(sep, *[r.failure() for r in rules])


def first_failure(rules: tuple[Rule, ...]) -> Column:
    """The first failing code, in rule order; NULL when none fails."""
    return reduce(lambda acc, r: acc.when(r.predicate(), F.lit(r.code)),
                  rules[1:], rules[0].failure())


def error_expression(profile: Profile) -> Column:
    if profile.mode == "all":
        return all_failures(profile.rules)
    if profile.mode == "first":
        return first_failure(profile.rules)
    raise ValueError(f"unknown rule mode {profile.mode!r}")


def is_valid(profile: Profile) -> Column:
    c = F.col(profile.error_column)
    return (c == "") if profile.mode == "all" else c.isNull()


def is_invalid(profile: Profile) -> Column:
    c = F.col(profile.error_column)
    return (c != "") if profile.mode == "all" else c.isNotNull()
