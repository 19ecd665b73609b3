"""Workload B: cleansing of a dirty staging table (safe casts, dates,
blanks, statuses, validity filter, latest-row dedup)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.cleansing import (blank_to_null, parse_date_multi,
                                         safe_int, safe_numeric,
                                         standardise_status)
from tessera.operators.dedup import dedup_latest
from tessera.sources.staging import (STAGING_SQL, dirty_staging, sql_blank_to_null,
                                     sql_parse_dates, sql_safe_int,
                                     sql_safe_numeric, sql_status)
from tessera.sources.tables import table

# The combined cleanser accepts only the first two staging date formats.
CLEAN_FORMATS = ("y-M-d", "M/d/y")


def staging(spark, sf_dir):
    return dirty_staging(table(spark, sf_dir, "orders"))


def safe_cast_numeric(spark, sf_dir):
    s = staging(spark, sf_dir)
    return s.select("src_key", "sale_amount",
                    safe_numeric("sale_amount").alias("clean_sale_amount"))


def safe_cast_int(spark, sf_dir):
    s = staging(spark, sf_dir)
    return s.select("src_key", "quantity", safe_int("quantity").alias("clean_quantity"))


def parse_dates(spark, sf_dir):
    s = staging(spark, sf_dir)
    return s.select("src_key", "order_date",
                    parse_date_multi("order_date").alias("clean_order_date"))


def blank_nulls(spark, sf_dir):
    s = staging(spark, sf_dir)
    return s.select("src_key",
                    blank_to_null("customer_email").alias("clean_customer_email"),
                    blank_to_null("product_code").alias("clean_product_code"))


def status_standardise(spark, sf_dir):
    s = staging(spark, sf_dir)
    return s.select("src_key", "status", standardise_status("status").alias("clean_status"))


def filter_positive(spark, sf_dir):
    """Numeric comparison on a safe cast; NULL comparisons drop the row."""
    s = staging(spark, sf_dir).withColumn("clean_quantity", safe_int("quantity"))
    return s.where(F.col("clean_quantity") >= 1).select("src_key", "clean_quantity")


def dedup_latest_raw(spark, sf_dir):
    """One staging row per transaction id: latest raw order_date, then src_key."""
    s = staging(spark, sf_dir).where(F.col("transaction_id").isNotNull())
    return dedup_latest(s, ["transaction_id"], ["order_date"], ["src_key"])


def clean_staging(df):
    """Clean columns are computed once; the filter and dedup reuse them."""
    return df.select(
        "transaction_id", "order_date", "src_key",
        safe_numeric("sale_amount").alias("clean_sale_amount"),
        blank_to_null("customer_email").alias("clean_customer_email"),
        parse_date_multi("order_date", CLEAN_FORMATS).alias("clean_order_date"),
        blank_to_null("product_code").alias("clean_product_code"),
        safe_int("quantity").alias("clean_quantity"),
        standardise_status("status").alias("clean_status"),
    )


def elt_clean_dedup(spark, sf_dir, order: str = "order_date"):
    """Clean, filter and keep one row per transaction.

    ``order="order_date"`` is the faithful mode: the source cleanser orders by
    the *raw* date string. ``order="clean_order_date"`` keeps the truly most
    recent parsed date. ``src_key`` always breaks ties.
    """
    c = clean_staging(staging(spark, sf_dir))
    valid = c.where(F.col("transaction_id").isNotNull()
                    & F.col("clean_sale_amount").isNotNull()
                    & (F.col("clean_quantity") >= 1))
    out = dedup_latest(valid, ["transaction_id"], [order], ["src_key"])
    return out.drop("order_date", "src_key")


QUERIES = {
    "safe_cast_numeric": safe_cast_numeric,
    "safe_cast_int": safe_cast_int,
    "parse_date_multi": parse_dates,
    "blank_to_null": blank_nulls,
    "status_standardise": status_standardise,
    "filter_positive": filter_positive,
    "dedup_latest": dedup_latest_raw,
    "elt_clean_dedup": elt_clean_dedup,
}

W = "WITH " + STAGING_SQL

ORACLE = {
    "safe_cast_numeric": W + f"SELECT src_key, sale_amount, {sql_safe_numeric('sale_amount')} AS clean_sale_amount FROM staging",
    "safe_cast_int": W + f"SELECT src_key, quantity, {sql_safe_int('quantity')} AS clean_quantity FROM staging",
    "parse_date_multi": W + f"SELECT src_key, order_date, {sql_parse_dates('order_date')} AS clean_order_date FROM staging",
    "blank_to_null": W + f"SELECT src_key, {sql_blank_to_null('customer_email')} AS clean_customer_email, "
                         f"{sql_blank_to_null('product_code')} AS clean_product_code FROM staging",
    "status_standardise": W + f"SELECT src_key, status, {sql_status('status')} AS clean_status FROM staging",
    "filter_positive": W + f"SELECT src_key, {sql_safe_int('quantity')} AS clean_quantity FROM staging "
                           f"WHERE {sql_safe_int('quantity')} >= 1",
    "dedup_latest": W + """SELECT transaction_id, sale_amount, customer_email, order_date, product_code,
       quantity, status, src_key
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY transaction_id
                                   ORDER BY order_date DESC NULLS LAST, src_key) AS rn
      FROM staging WHERE transaction_id IS NOT NULL) WHERE rn = 1""",
    "elt_clean_dedup": W + f"""SELECT transaction_id, clean_sale_amount, clean_customer_email, clean_order_date,
       clean_product_code, clean_quantity, clean_status
FROM (SELECT transaction_id,
             {sql_safe_numeric('sale_amount')} AS clean_sale_amount,
             {sql_blank_to_null('customer_email')} AS clean_customer_email,
             {sql_parse_dates('order_date', ('%Y-%m-%d', '%m/%d/%Y'))} AS clean_order_date,
             {sql_blank_to_null('product_code')} AS clean_product_code,
             {sql_safe_int('quantity')} AS clean_quantity,
             {sql_status('status')} AS clean_status,
             ROW_NUMBER() OVER (PARTITION BY transaction_id ORDER BY order_date DESC NULLS LAST, src_key) AS rn
      FROM staging
      WHERE transaction_id IS NOT NULL
        AND {sql_safe_numeric('sale_amount')} IS NOT NULL
        AND {sql_safe_int('quantity')} >= 1)
WHERE rn = 1""",
}
