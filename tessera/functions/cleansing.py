"""Column -> Column cleansing expressions for dirty staging data.

All of them are built-in Catalyst expressions (no Python at run time), so
they stay inside whole-stage codegen and work unchanged on streams.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The warehouse NUMERIC type is DECIMAL(38, 9).
NUMERIC = "decimal(38,9)"

# The accepted date formats of the staging cleanser, in priority
# order ('%Y-%m-%d', '%m/%d/%Y', '%d-%b-%Y'), as Spark datetime patterns.
# Single letters accept both padded and unpadded fields.
STAGING_DATE_FORMATS = ("y-M-d", "M/d/y", "d-MMM-y")

# The status vocabulary of the staging cleanser.
KEPT_STATUSES = ("Completed", "Pending", "Cancelled")
STATUS_ALIASES = {"Done": "Completed"}
UNKNOWN_STATUS = "Unknown"

# Leading/trailing Unicode whitespace (TRIM with one argument strips all of
# it): ASCII whitespace, U+0085 and the separators (category Z), spelled out
# so the set does not depend on an engine's idea of \s.
_WS = r"[\t\n\x0B\f\r \x{85}\p{Z}]"
_EDGE_WS = rf"^{_WS}+|{_WS}+$"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def safe_numeric(col) -> Column:
    """SAFE_CAST(s AS NUMERIC): failure -> NULL, excess scale rounded half-up."""
    return _c(col).try_cast(NUMERIC)


def safe_int(col) -> Column:
    """SAFE_CAST(s AS INT64): only optionally signed digits parse."""
    return _c(col).try_cast("bigint")


def parse_date_multi(col, formats: Sequence[str] = STAGING_DATE_FORMATS) -> Column:
    """First format that parses wins; invalid dates (2023-02-30) give NULL."""
    c = _c(col)
    return F.coalesce(*[F.try_to_date(c, fmt) for fmt in formats])


def unicode_trim(col) -> Column:
    return F.regexp_replace(_c(col), _EDGE_WS, "")


def blank_to_null(col) -> Column:
    """NULLIF(TRIM(s), '') with Unicode-aware trimming."""
    return F.nullif(unicode_trim(col), F.lit(""))


def standardise_status(col, kept: Sequence[str] = KEPT_STATUSES,
                       aliases: dict | None = None,
                       unknown: str = UNKNOWN_STATUS) -> Column:
    """Keep known values, map aliases, everything else (and NULL) -> unknown."""
    c = _c(col)
    aliases = STATUS_ALIASES if aliases is None else aliases
    out = F.when(c.isin(*kept), c)
    for src, dst in aliases.items():
        out = out.when(c == F.lit(src), F.lit(dst))
    return out.otherwise(F.lit(unknown))


def classify(col, rules: Sequence[tuple[str, str]], other_prefix: str) -> Column:
    """Ordered case-insensitive LIKE classifier; first match wins.

    The ELSE branch is ``other_prefix || value`` and so NULL for a NULL value.
    """
    low = F.lower(_c(col))
    out = None
    for needle, label in rules:
        cond = low.like(f"%{needle}%")
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    other = F.concat(F.lit(other_prefix), _c(col))
    return other if out is None else out.otherwise(other)


def round_half_up(col, scale: int = 2) -> Column:
    """Engine-portable half-up (away from zero) rounding of a DOUBLE."""
    c = _c(col).cast("double")
    k = float(10 ** scale)
    return F.signum(c) * F.floor(F.abs(c) * k + F.lit(0.5)) / F.lit(k)


def ratio_pct(part, total, scale: int = 2) -> Column:
    """IF(total = 0, 0, 1 - ROUND(part / total, scale)) * 100; the guard is lazy."""
    p, t = _c(part), _c(total)
    return (F.when(t == 0, F.lit(0.0))
            .otherwise(F.lit(1.0) - round_half_up(p / t, scale))) * F.lit(100.0)


def signed_amount(amount, is_return) -> Column:
    """Returns are stored as negative amounts."""
    a = _c(amount)
    return F.when(_c(is_return), -F.abs(a)).otherwise(a)
