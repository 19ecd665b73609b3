"""A dirty staging table derived from ``orders`` (every order kept).

Each column carries the kinds of dirt the ELT cleanser handles: unparsable
amounts, blank and padded e-mails, three date formats, padded product codes,
non-integer quantities, unknown statuses and duplicated transaction ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TAB = "\t"


def dirty_staging(orders: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    cust = F.col("o_custkey").cast("string")
    email = F.concat(F.lit("user"), cust, F.lit("@example.com"))
    d = F.col("o_orderdate")
    return orders.select(
        F.when(k % 97 == 0, F.lit(None).cast("string"))
         .when(k % 10 == 3, F.concat(F.lit("T"), (k - 1).cast("string")))
         .otherwise(F.concat(F.lit("T"), k.cast("string"))).alias("transaction_id"),
        F.when(k % 13 == 0, F.lit("n/a")).when(k % 13 == 1, F.lit(""))
         .otherwise(F.col("o_totalprice").cast("decimal(18,2)").cast("string")).alias("sale_amount"),
        F.when(k % 6 == 0, F.lit("   ")).when(k % 6 == 1, F.lit(None).cast("string"))
         .when(k % 6 == 2, F.concat(F.lit(TAB), email, F.lit(" " + TAB)))
         .otherwise(F.concat(F.lit("  "), email, F.lit(" "))).alias("customer_email"),
        F.when(k % 4 == 0, F.date_format(d, "yyyy-MM-dd"))
         .when(k % 4 == 1, F.date_format(d, "M/d/yyyy"))
         .when(k % 4 == 2, F.date_format(d, "dd-MMM-yyyy"))
         .otherwise(F.lit("unknown")).alias("order_date"),
        F.when(k % 8 == 0, F.lit("")).when(k % 8 == 1, F.lit(" " + TAB))
         .otherwise(F.concat(F.lit(" P"), (k % 50).cast("string"), F.lit(" "))).alias("product_code"),
        F.when(k % 9 == 0, F.lit("abc")).when(k % 9 == 1, F.lit("12.0"))
         .when(k % 9 == 2, F.lit(" 4 ")).otherwise((k % 6).cast("string")).alias("quantity"),
        F.when(k % 7 == 0, F.lit("Done")).when(k % 7 == 1, F.lit("Pending"))
         .when(k % 7 == 2, F.lit(None).cast("string")).when(k % 7 == 3, F.lit("Cancelled"))
         .when(k % 7 == 4, F.lit("done")).otherwise(F.lit("Completed")).alias("status"),
        k.alias("src_key"),
    )


# The same table in DuckDB SQL, used as a CTE by the oracles.
STAGING_SQL = r"""
staging AS (
SELECT
  CASE WHEN o_orderkey%97=0 THEN NULL WHEN o_orderkey%10=3 THEN 'T'||(o_orderkey-1) ELSE 'T'||o_orderkey END AS transaction_id,
  CASE o_orderkey%13 WHEN 0 THEN 'n/a' WHEN 1 THEN '' ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) END AS sale_amount,
  CASE o_orderkey%6 WHEN 0 THEN '   ' WHEN 1 THEN NULL WHEN 2 THEN chr(9)||'user'||o_custkey||'@example.com '||chr(9)
       ELSE '  user'||o_custkey||'@example.com ' END AS customer_email,
  CASE o_orderkey%4 WHEN 0 THEN strftime(o_orderdate,'%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate,'%-m/%-d/%Y')
       WHEN 2 THEN strftime(o_orderdate,'%d-%b-%Y') ELSE 'unknown' END AS order_date,
  CASE o_orderkey%8 WHEN 0 THEN '' WHEN 1 THEN ' '||chr(9) ELSE ' P'||(o_orderkey%50)||' ' END AS product_code,
  CASE o_orderkey%9 WHEN 0 THEN 'abc' WHEN 1 THEN '12.0' WHEN 2 THEN ' 4 ' ELSE CAST(o_orderkey%6 AS VARCHAR) END AS quantity,
  CASE o_orderkey%7 WHEN 0 THEN 'Done' WHEN 1 THEN 'Pending' WHEN 2 THEN NULL WHEN 3 THEN 'Cancelled'
       WHEN 4 THEN 'done' ELSE 'Completed' END AS status,
  o_orderkey AS src_key
FROM orders)
"""

# DuckDB equivalents of the cleansing expressions.
def sql_trim(x: str) -> str:
    ws = r"[\t\n\x0B\f\r \x{85}\p{Z}]"
    return f"regexp_replace({x}, '^{ws}+|{ws}+$', '', 'g')"


def sql_blank_to_null(x: str) -> str:
    return f"NULLIF({sql_trim(x)}, '')"


def _sql_strip_ascii(x: str) -> str:
    # Spark's string-to-number casts ignore surrounding ASCII whitespace and
    # control characters (code points up to U+0020), and nothing else.
    return f"regexp_replace({x}, '^[\\x00-\\x20]+|[\\x00-\\x20]+$', '', 'g')"


def sql_safe_int(x: str) -> str:
    s = _sql_strip_ascii(x)
    return f"CASE WHEN regexp_full_match({s}, '[+-]?[0-9]+') THEN TRY_CAST({s} AS BIGINT) END"


def sql_safe_numeric(x: str) -> str:
    s = _sql_strip_ascii(x)
    pattern = r"[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?"
    return f"CASE WHEN regexp_full_match({s}, '{pattern}') THEN TRY_CAST({s} AS DECIMAL(38,9)) END"


def sql_parse_dates(x: str, formats=("%Y-%m-%d", "%m/%d/%Y", "%d-%b-%Y")) -> str:
    parts = ", ".join(f"CAST(try_strptime({x}, '{f}') AS DATE)" for f in formats)
    return f"COALESCE({parts})"


def sql_status(x: str) -> str:
    return (f"CASE WHEN {x} IN ('Completed', 'Pending', 'Cancelled') THEN {x} "
            f"WHEN {x} = 'Done' THEN 'Completed' ELSE 'Unknown' END")
