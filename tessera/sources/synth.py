"""Synthetic customer transactions (S9, G1-G5), derived from ``orders``.

Every order becomes one transaction on the order's day, so the generator is
an ordinary narrow projection: it scales with the table, runs in every task
in parallel and needs no driver-side loop. Draws are hashes of the order key
(customer draws: of the customer key), so each customer keeps one segment and
re-runs reproduce every row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.cleansing import signed_amount
from tessera.functions.draws import (draw_sql, sql_draw, weighted_index_sql,
                                     weighted_pick_sql)
from tessera.functions.timefn import day_name, hour_of_day, is_weekend

# Fixed values of the transaction generator.
# Segments with weight in percent and the uniform amount multiplier range.
SEGMENTS = (("premium", 15), ("regular", 60), ("occasional", 25))
SEGMENT_MULTIPLIER = {"premium": (1.2, 2.5), "regular": (0.8, 1.3),
                      "occasional": (0.5, 1.1)}
# Categories with weight in percent and the uniform base amount range.
CATEGORIES = (("Electronics", 25), ("Clothing", 30), ("Home & Garden", 20),
              ("Books & Media", 15), ("Sports & Outdoors", 10))
CATEGORY_RANGE = {"Electronics": (50, 2000), "Clothing": (15, 300),
                  "Home & Garden": (20, 500), "Books & Media": (5, 100),
                  "Sports & Outdoors": (25, 800)}
PAYMENTS = (("credit_card", 45), ("debit_card", 25), ("paypal", 15),
            ("apple_pay", 8), ("google_pay", 7))
STORES = ("New York, NY", "Los Angeles, CA", "Chicago, IL", "Houston, TX",
          "Phoenix, AZ", "Philadelphia, PA", "San Antonio, TX", "San Diego, CA",
          "Dallas, TX", "San Jose, CA", "Austin, TX", "Jacksonville, FL",
          "San Francisco, CA", "Columbus, OH", "Charlotte, NC", "Online")
DISCOUNTS = (0, 5, 10, 15, 20)
DISCOUNT_PCT = 30
RETURN_PCT = 5
CURRENCY = "USD"
# Hourly weights in hundredths (sum 117; normalised by drawing modulo 117).
HOUR_WEIGHTS = (1, 1, 1, 1, 1, 2, 3, 4, 5, 6, 7, 8, 9, 8, 7, 6, 7, 8, 9, 8, 6, 4, 3, 2)

STEPS = 10000  # resolution of the uniform draws


def synth_transactions(orders: DataFrame) -> DataFrame:
    """One synthetic transaction per order. The row expressions are written
    as Spark SQL text (``selectExpr``): the JVM parses each once, instead of
    Python building the large expression trees one operator call at a time."""
    k, c = "o_orderkey", "o_custkey"
    x = draw_sql(k, "txn2", 3)
    ms = draw_sql(k, "txn", 1)
    hour = weighted_index_sql(draw_sql(k, "txn", 0) + f" % {sum(HOUR_WEIGHTS)}", HOUR_WEIGHTS)
    category = weighted_pick_sql(draw_sql(k, "txn", 2) + " % 100", CATEGORIES)
    payment = weighted_pick_sql(draw_sql(k, "txn2", 1) + " % 100", PAYMENTS)
    segment = weighted_pick_sql(draw_sql(c, "segment", 0) + " % 100", SEGMENTS)
    store = draw_sql(k, "txn2", 2)
    stores = ", ".join("'" + s + "'" for s in STORES)
    discounts = ", ".join(str(d) for d in DISCOUNTS)
    raw = orders.selectExpr(
        f"concat('TXN-', CAST({k} AS STRING)) AS transaction_id",
        f"concat('CUST_', CAST({c} AS STRING)) AS customer_id",
        "make_timestamp_ntz(year(o_orderdate), month(o_orderdate), day(o_orderdate), "
        f"{hour}, CAST({ms} % 60 AS INT), CAST(({ms} div 60) % 60 AS INT)) AS timestamp",
        f"{category} AS category",
        f"{payment} AS payment_method",
        f"element_at(array({stores}), CAST({store} % {len(STORES)} + 1 AS INT)) AS store_location",
        f"{segment} AS customer_segment",
        f"CAST(CASE WHEN {x} % 100 < {DISCOUNT_PCT} THEN element_at(array({discounts}), "
        f"CAST(({x} div 100) % {len(DISCOUNTS)} + 1 AS INT)) ELSE 0 END AS BIGINT) AS discount_applied",
        f"({x} div 1000) % 100 < {RETURN_PCT} AS is_return",
        f"'{CURRENCY}' AS currency",
        f"{draw_sql(k, 'txn', 3)} AS _u_base",
        f"{draw_sql(k, 'txn2', 0)} AS _u_mult",
    )
    # round(uniform(category range) * uniform(segment multiplier), 2) in
    # cents, in integers: base in 1e-4 units times multiplier in 1e-4 units.
    base = "CASE " + " ".join(
        f"WHEN category = '{n}' THEN {lo * STEPS} + {hi - lo} * (_u_base % {STEPS + 1})"
        for n, (lo, hi) in CATEGORY_RANGE.items()) + " END"
    mult = "CASE " + " ".join(
        f"WHEN customer_segment = '{n}' THEN {round(lo * STEPS)} + {round((hi - lo) * 10)} * (_u_mult % 1001)"
        for n, (lo, hi) in SEGMENT_MULTIPLIER.items()) + " END"
    cents = f"CAST(floor((CAST({base} AS BIGINT) * CAST({mult} AS BIGINT) + 500000) / 1000000) AS BIGINT)"
    amount = signed_amount(F.expr(f"CAST({cents} AS DOUBLE) / 100.0D"), F.col("is_return"))
    return raw.select(
        "transaction_id", "customer_id", "timestamp", amount.alias("amount"),
        "category", "payment_method", "store_location", "customer_segment",
        "discount_applied", "is_return", "currency",
        hour_of_day("timestamp").alias("hour_of_day"),
        day_name("timestamp").alias("day_of_week"),
        is_weekend("timestamp").alias("is_weekend"),
    )


def synth_sql() -> str:
    """DuckDB text of ``synth_transactions`` as a CTE named ``transactions``."""
    seg = weighted_pick_sql(f"{sql_draw('o_custkey', 'segment')} % 100", SEGMENTS)
    hour = weighted_index_sql(f"{sql_draw('o_orderkey', 'txn', 0)} % {sum(HOUR_WEIGHTS)}",
                              HOUR_WEIGHTS)
    ms = sql_draw("o_orderkey", "txn", 1)
    cat = weighted_pick_sql(f"{sql_draw('o_orderkey', 'txn', 2)} % 100", CATEGORIES)
    pay = weighted_pick_sql(f"{sql_draw('o_orderkey', 'txn2', 1)} % 100", PAYMENTS)
    stores = "[" + ", ".join("'" + s + "'" for s in STORES) + "]"
    store = f"{stores}[{sql_draw('o_orderkey', 'txn2', 2)} % {len(STORES)} + 1]"
    x = sql_draw("o_orderkey", "txn2", 3)
    discs = "[" + ", ".join(str(d) for d in DISCOUNTS) + "]"
    discount = (f"CAST(CASE WHEN {x} % 100 < {DISCOUNT_PCT} "
                f"THEN {discs}[({x} // 100) % {len(DISCOUNTS)} + 1] ELSE 0 END AS BIGINT)")
    is_ret = f"(({x} // 1000) % 100) < {RETURN_PCT}"
    base_case = "CASE " + " ".join(
        f"WHEN category = '{n}' THEN {lo * STEPS} + {hi - lo} * (u_base % {STEPS + 1})"
        for n, (lo, hi) in CATEGORY_RANGE.items()) + " END"
    mult_case = "CASE " + " ".join(
        f"WHEN customer_segment = '{n}' THEN {round(lo * STEPS)} + {round((hi - lo) * 10)} * (u_mult % 1001)"
        for n, (lo, hi) in SEGMENT_MULTIPLIER.items()) + " END"
    return f"""
raw_txn AS (
  SELECT 'TXN-' || o_orderkey AS transaction_id, 'CUST_' || o_custkey AS customer_id,
         make_timestamp(year(o_orderdate), month(o_orderdate), day(o_orderdate),
                        {hour}, CAST({ms} % 60 AS BIGINT), CAST(({ms} // 60) % 60 AS DOUBLE)) AS timestamp,
         {cat} AS category, {pay} AS payment_method, {store} AS store_location,
         {seg} AS customer_segment, {discount} AS discount_applied, {is_ret} AS is_return,
         '{CURRENCY}' AS currency,
         {sql_draw('o_orderkey', 'txn', 3)} AS u_base, {sql_draw('o_orderkey', 'txn2', 0)} AS u_mult
  FROM orders),
cents AS (
  SELECT *, CAST(floor((CAST({base_case} AS BIGINT) * CAST({mult_case} AS BIGINT) + 500000)
                       / 1000000) AS BIGINT) AS amount_cents
  FROM raw_txn),
transactions AS (
  SELECT transaction_id, customer_id, timestamp,
         CASE WHEN is_return THEN -abs(CAST(amount_cents AS DOUBLE) / 100.0) ELSE CAST(amount_cents AS DOUBLE) / 100.0 END AS amount,
         category, payment_method, store_location, customer_segment, discount_applied,
         is_return, currency, CAST(hour(timestamp) AS INTEGER) AS hour_of_day, dayname(timestamp) AS day_of_week,
         isodow(timestamp) >= 6 AS is_weekend
  FROM cents)
"""
