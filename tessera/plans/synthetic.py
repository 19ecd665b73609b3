"""Synthetic transactions and the generator's summary report (S9, G1-G5,
A10-A12, O6, O7, P7, X21, X22)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators.summaries import (revenue_returns_summary as summary,
                                         segment_stats as seg_stats,
                                         top_groups_by_sum)
from tessera.sources.synth import synth_sql, synth_transactions as build
from tessera.sources.tables import table


def _txn(spark, sf_dir):
    return build(table(spark, sf_dir, "orders"))


def synth_transactions(spark, sf_dir):
    return _txn(spark, sf_dir)


def weighted_pick(spark, sf_dir):
    """Observed mix of the weighted draws (category x payment method)."""
    return _txn(spark, sf_dir).groupBy("category", "payment_method").agg(
        F.count(F.lit(1)).alias("transactions"))


def derived_time_fields(spark, sf_dir):
    return _txn(spark, sf_dir).select("transaction_id", "timestamp", "hour_of_day",
                                      "day_of_week", "is_weekend")


def signed_amount(spark, sf_dir):
    return _txn(spark, sf_dir).select("transaction_id", "is_return", "amount")


def sorted_by_time(spark, sf_dir):
    return _txn(spark, sf_dir).select("timestamp", "transaction_id", "amount").orderBy(
        "timestamp", "transaction_id")


def revenue_returns_summary(spark, sf_dir):
    return summary(_txn(spark, sf_dir))


def top_categories(spark, sf_dir, k=5):
    return top_groups_by_sum(_txn(spark, sf_dir), "category", "amount", k)


def segment_stats(spark, sf_dir):
    return seg_stats(_txn(spark, sf_dir))


QUERIES = {
    "synth_transactions": synth_transactions,
    "weighted_pick": weighted_pick,
    "derived_time_fields": derived_time_fields,
    "signed_amount": signed_amount,
    "sorted_by_time": sorted_by_time,
    "revenue_returns_summary": revenue_returns_summary,
    "top_categories": top_categories,
    "segment_stats": segment_stats,
}

W = "WITH " + synth_sql()


def _money(x):
    return f"CAST(SUM(CAST({x} AS DECIMAL(38,9))) AS DOUBLE)"


def _round2(x):
    return f"(sign({x}) * floor(abs({x}) * 100 + 0.5) / 100)"


ORACLE = {
    "synth_transactions": W + "SELECT * FROM transactions",
    "weighted_pick": W + """SELECT category, payment_method, COUNT(*) AS transactions
FROM transactions GROUP BY 1, 2""",
    "derived_time_fields": W + """SELECT transaction_id, timestamp, hour_of_day, day_of_week, is_weekend
FROM transactions""",
    "signed_amount": W + "SELECT transaction_id, is_return, amount FROM transactions",
    "sorted_by_time": W + "SELECT timestamp, transaction_id, amount FROM transactions ORDER BY 1, 2",
    "revenue_returns_summary": W + f"""
SELECT COUNT(*) AS total_transactions, COUNT(DISTINCT customer_id) AS unique_customers,
       COALESCE({_money('CASE WHEN amount > 0 THEN amount END')}, 0.0) AS total_revenue,
       abs(COALESCE({_money('CASE WHEN amount < 0 THEN amount END')}, 0.0)) AS total_returns,
       {_round2(_money('amount') + ' / COUNT(amount)')} AS avg_transaction,
       MIN(timestamp) AS first_ts, MAX(timestamp) AS last_ts
FROM transactions""",
    "top_categories": W + f"""
SELECT category, {_money('amount')} AS revenue FROM transactions WHERE amount > 0
GROUP BY category ORDER BY revenue DESC, category LIMIT 5""",
    "segment_stats": W + f"""
SELECT customer_segment, COUNT(DISTINCT customer_id) AS customers, COUNT(amount) AS transactions,
       {_round2(_money('amount') + ' / COUNT(amount)')} AS avg_amount,
       {_round2(_money('amount'))} AS total_amount
FROM transactions GROUP BY customer_segment""",
}
