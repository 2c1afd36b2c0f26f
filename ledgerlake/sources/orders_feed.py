"""Transaction events derived from the ``orders`` table.

The reference feeds its pipeline with random events; for reproducible runs
we derive one event per order (plus a re-sent copy of some orders) with a
fixed set of injected faults.  Every expression is deterministic and exactly
representable, so Spark and an independent SQL engine compute identical rows.
It is a narrow projection + generator over one scan: it scales with
``orders`` and shuffles nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.schema import EVENT_FIELDS

# ---------------------------------------------------------------------------
# Generator vocabularies and fault positions
# ---------------------------------------------------------------------------
MERCHANT_CATEGORIES = ["BAKERY", "BOOKS", "CYCLES", "GARDEN", "MUSIC", "OPTICS", "PETS", "TOOLS"]
TRANSACTION_TYPES = ["SALE", "RETURN", "MOVE", "PAYOUT"]
PAYMENT_METHODS = ["CARD", "CASH", "VOUCHER", "WIRE"]
CURRENCIES = ["USD", "EUR", "GBP", "CAD"]
RESEND_MODULUS, RESEND_REMAINDER = 97, 5
TOPIC = "order-events"
PARTITIONS = 3
SENT_EPOCH = 1_704_067_200      # 2024-01-01 00:00:00 UTC
RESEND_SHIFT = 60               # seconds
# ---------------------------------------------------------------------------


def _pick(values: list[str], idx: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (idx + 1).cast("int"))


def transactions(orders: DataFrame) -> DataFrame:
    """One event per order, plus a second copy of every ``k % 97 = 5`` order.

    Columns: the 14 event fields plus ``partition`` / ``offset`` / ``sent_epoch``
    (where and when the message would sit on a 3-partition topic) and ``resend``.
    The copy differs in ``city``, partition and offset, and is sent a minute
    earlier, a minute later or at the same time, so that each part of the
    survivor's order decides for some orders.
    """
    k, c, p, d = (F.col("o_orderkey"), F.col("o_custkey"),
                  F.col("o_totalprice"), F.col("o_orderdate"))
    k100, k1000 = k % 100, k % 1000
    cents = F.floor(p * 2) / 100
    base = orders.select(
        F.when(k1000 == 173, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("TXN-"), k.cast("string"))).alias("transaction_id"),
        F.when(k100 == 3, F.lit(None).cast("string"))
         .when(k1000 == 127, F.lit("   "))
         .otherwise(F.concat(F.lit("CUST-"), c.cast("string"))).alias("customer_id"),
        F.concat(F.lit("ACC-"), (c + 10000).cast("string")).alias("account_id"),
        F.concat(F.lit("MER-"), (k % 900 + 100).cast("string")).alias("merchant_id"),
        _pick(MERCHANT_CATEGORIES, k % 8).alias("merchant_category"),
        _pick(TRANSACTION_TYPES, c % 4).alias("transaction_type"),
        F.when(k1000 == 151, F.lit(None).cast("double"))
         .when(k1000 == 163, F.lit(0.0))
         .when(k100 == 17, -cents)
         .otherwise(cents).alias("amount"),
        F.when(k100 == 31, F.lit("XYZ"))
         .when(k1000 == 417, F.lit("ZZZ"))
         .when(k1000 == 71, F.lit(" usd "))
         .when(k1000 == 113, F.lit(None).cast("string"))
         .otherwise(_pick(CURRENCIES, k % 4)).alias("currency"),
        _pick(PAYMENT_METHODS, (k + c) % 4).alias("payment_method"),
        F.when(k1000 == 211, F.lit(None).cast("string"))
         .when(c % 8 < 5, F.lit("US"))
         .when(c % 8 == 5, F.lit("CA"))
         .when(c % 8 == 6, F.lit("GB"))
         .otherwise(F.lit("DE")).alias("country"),
        F.lit("WEB").alias("device_type"),
        F.when(k100 == 47, F.lit("UNKNOWN"))
         .when(k1000 == 223, F.lit(None).cast("string"))
         .when((k + 3 * c) % 20 < 17, F.lit("APPROVED"))
         .when((k + 3 * c) % 20 < 19, F.lit("DECLINED"))
         .otherwise(F.lit("PENDING")).alias("status"),
        F.when(k100 == 59, F.lit(None).cast("string"))
         .when(k1000 == 139, F.lit("not-a-date"))
         .otherwise(F.concat(F.to_date(d).cast("string"), F.lit("T00:00:00+00:00")))
         .alias("event_timestamp"),
        # 0 = first send; re-sent orders also get a copy 1 (one scan, no union)
        F.explode(F.when(k % RESEND_MODULUS == RESEND_REMAINDER, F.array(F.lit(0), F.lit(1)))
                   .otherwise(F.array(F.lit(0)))).alias("resend"),
        k.alias("_k"),
    )
    key, again = F.col("_k"), F.col("resend")
    shift = F.when(again == 0, 0).when(key % 3 == 0, -RESEND_SHIFT).when(key % 3 == 1, RESEND_SHIFT).otherwise(0)
    return (base.withColumns({
        "city": F.when(again == 0, F.lit("CITY")).otherwise(F.lit("TOWN")),
        "partition": ((key + again) % PARTITIONS).cast("int"),
        "offset": key * 2 + again,                       # unique for any key
        "sent_epoch": (F.lit(SENT_EPOCH) + shift).cast("long")})
        .select(*EVENT_FIELDS, "partition", "offset", "sent_epoch", "resend"))


def read_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/orders.parquet")


def transactions_from(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transactions(read_orders(spark, sf_dir))
