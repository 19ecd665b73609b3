"""Policy audit (F11): resources created outside an allowed location."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def location_violations(df: DataFrame, allowed_prefix: str,
                        methods: Sequence[str] = ("CREATE",),
                        resource_types: Sequence[str] = ("bucket",),
                        method: str = "method", rtype: str = "resource_type",
                        location: str = "location") -> DataFrame:
    """Rows a DENY rule ``location.startsWith(prefix) == false`` would block.
    A NULL location is unknown, so it is reported as a violation too."""
    outside = F.coalesce(~F.startswith(F.col(location), F.lit(allowed_prefix)), F.lit(True))
    return df.where(F.col(method).isin(*methods) & F.col(rtype).isin(*resource_types) & outside)
