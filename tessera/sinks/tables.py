"""Truncate-and-write of a table that the query itself may read (K7).

The new contents are written beside the old ones, then the table's location is swapped. Until the swap, and after a
write that failed, readers see the earlier contents; readers that began before it finish on them, for the
earlier files are deleted only by the replacement after next.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tessera.sinks.manifest import Files

_PREVIOUS = "tessera.previous"


def _location(spark: SparkSession, name: str) -> str:
    return {r[0]: r[1] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}["Location"]


def replace_table(df: DataFrame, name: str, base: str) -> DataFrame:
    """Replace the contents of the external Parquet table ``name`` (created if absent) by ``df``.

    Versions lie in folders of their own below ``base``. Columns may change too (the table is then declared anew).
    """
    spark, at = df.sparkSession, Files(df.sparkSession, base)
    folder = f"v-{uuid.uuid4().hex}"
    df.write.parquet(f"{at.root}/{folder}")  # fails before anything of the table is touched
    if not spark.catalog.tableExists(name):
        spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{at.root}/{folder}'")
        return spark.table(name)
    before = _location(spark, name).rstrip("/").rsplit("/", 1)[1]
    oldest = {r[0]: r[1] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}.get(_PREVIOUS)
    if [(f.name, f.dataType) for f in spark.table(name).schema] == [(f.name, f.dataType) for f in df.schema]:
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{at.root}/{folder}'")
    else:
        spark.sql(f"DROP TABLE {name}")
        spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{at.root}/{folder}'")
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{_PREVIOUS}' = '{before}')")
    spark.catalog.refreshTable(name)
    if oldest and at.exists(oldest):
        at.delete(oldest)
    return spark.table(name)
