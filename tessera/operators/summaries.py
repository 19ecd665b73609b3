"""Grouped summaries of transaction-shaped data (A1, A10-A12, O6).

All are single ``groupBy().agg()`` passes: Spark computes partial aggregates
map-side before the shuffle, so a hot key costs one partial row per map task.
Multiple COUNT(DISTINCT) are planned as Expand + two HashAggregates, whose
first shuffle is keyed by (key, value) and so spreads a hot key over values.
Money is summed as DECIMAL(38,9), so results do not depend on summation order
and fractions of a cent count; rounding, where the source rounds, comes last.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.cleansing import round_half_up

MONEY = "decimal(38,9)"


def money_sum(col) -> Column:
    """Order-independent sum of an amount, returned as DOUBLE."""
    c = F.col(col) if isinstance(col, str) else col
    return F.sum(c.cast(MONEY)).cast("double")


def money_mean(col) -> Column:
    """Mean of an amount (not rounded) that does not depend on the order of rows."""
    c = F.col(col) if isinstance(col, str) else col
    return F.sum(c.cast(MONEY)).cast("double") / F.count(c)


def money_avg(col) -> Column:
    """The mean rounded half-up to cents, for reports."""
    return round_half_up(money_mean(col), 2)


def customer_daily_summary(df: DataFrame, customer: str = "customer_id",
                           transaction: str = "transaction_id",
                           category: str = "category",
                           payment: str = "payment_method",
                           amount: str = "amount",
                           approx_rsd: float | None = None,
                           extra_keys: tuple[str, ...] = ()) -> DataFrame:
    """Per customer (and ``extra_keys``, such as the day): distinct transactions, categories, payment methods and
    the plain average amount (returns included, as in the daily ETL).

    Exact distinct counts expand each row once per counted column before the
    first shuffle. ``approx_rsd`` (e.g. 0.01) switches to HyperLogLog++
    sketches instead: fixed-size partial aggregates, one shuffle, no Expand,
    with that relative standard deviation; counts stay BIGINT.
    """
    if approx_rsd is None:
        distinct = lambda c: F.countDistinct(c)
    else:
        distinct = lambda c: F.approx_count_distinct(c, approx_rsd)
    return df.groupBy(F.col(customer).alias("customer_id"), *extra_keys).agg(
        distinct(transaction).alias("unique_transactions"),
        distinct(category).alias("distinct_categories"),
        distinct(payment).alias("distinct_payment_methods"),
        money_mean(amount).alias("avg_transaction_amount"),
    )


def revenue_returns_summary(df: DataFrame, amount: str = "amount",
                            customer: str = "customer_id",
                            ts: str = "timestamp") -> DataFrame:
    """One-row table report: rows, customers, revenue, returns, mean, span."""
    a = F.col(amount)
    return df.agg(
        F.count(F.lit(1)).alias("total_transactions"),
        F.countDistinct(customer).alias("unique_customers"),
        F.coalesce(money_sum(F.when(a > 0, a)), F.lit(0.0)).alias("total_revenue"),
        F.abs(F.coalesce(money_sum(F.when(a < 0, a)), F.lit(0.0))).alias("total_returns"),
        money_avg(a).alias("avg_transaction"),
        F.min(ts).alias("first_ts"),
        F.max(ts).alias("last_ts"),
    )


def top_groups_by_sum(df: DataFrame, key: str, amount: str, k: int = 5,
                      positive_only: bool = True,
                      out: str = "revenue") -> DataFrame:
    """Top-k groups by summed amount (positive amounts only by default).

    The sign test is a conditional aggregate (SUM(x) FILTER (WHERE x > 0))
    rather than a WHERE: a WHERE would be pushed below the projection that
    derives ``amount`` and evaluate that derivation twice per row. Groups
    without a positive amount get a NULL sum and are dropped, exactly as the
    WHERE would drop them.
    """
    a = F.col(amount)
    if positive_only:
        agg = df.groupBy(key).agg(money_sum(F.when(a > 0, a)).alias(out)).where(
            F.col(out).isNotNull())
    else:
        agg = df.groupBy(key).agg(money_sum(a).alias(out))
    return agg.orderBy(F.desc(out), F.asc(key)).limit(k)


def segment_stats(df: DataFrame, segment: str = "customer_segment",
                  customer: str = "customer_id",
                  amount: str = "amount") -> DataFrame:
    """nunique customers, count, mean and sum of amount per segment (2 dp)."""
    return df.groupBy(segment).agg(
        F.countDistinct(customer).alias("customers"),
        F.count(amount).alias("transactions"),
        money_avg(amount).alias("avg_amount"),
        round_half_up(money_sum(amount), 2).alias("total_amount"),
    )
