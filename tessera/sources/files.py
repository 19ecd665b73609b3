"""File sources: lines, CSV, JSON documents, external tables (S2, S5, S7)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tessera.functions.text import strip_cr
from tessera.sinks.files import TS_FORMATS

CORRUPT = "_corrupt_record"


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line (``value``), split on LF only, trailing CR dropped."""
    return (spark.read.option("lineSep", "\n").text(path)
            .select(strip_cr("value").alias("value")))


def read_csv(spark: SparkSession, path: str, schema: StructType,
             header: bool = True, null_value: str | None = None,
             line_breaks: bool = False) -> DataFrame:
    """``line_breaks``: values may hold line breaks; each file is then read by one task."""
    r = (spark.read.schema(schema).option("header", header)
         .option("quote", '"').option("escape", '"').option("multiLine", line_breaks)
         .option("mode", "FAILFAST").options(**TS_FORMATS))
    if null_value is not None:
        r = r.option("nullValue", null_value)
    return r.csv(path)


def read_documents(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """JSON documents with a fixed schema; malformed lines keep their raw
    text in ``_corrupt_record`` instead of failing the job."""
    if CORRUPT not in schema.fieldNames():
        schema = StructType(list(schema.fields)).add(CORRUPT, "string")
    return (spark.read.schema(schema).option("mode", "PERMISSIVE").options(**TS_FORMATS)
            .option("columnNameOfCorruptRecord", CORRUPT).json(path))


def read_json(spark: SparkSession, path: str, schema) -> DataFrame:
    """JSON lines written by ``write_json`` (microsecond timestamps)."""
    return spark.read.schema(schema).options(**TS_FORMATS).json(path)


def partition_folder(partition: str, value) -> str:
    """Name of a partition's folder for a date or another value without special characters."""
    text = str(value)
    if not text or not all(c.isalnum() or c in "-_." for c in text):
        raise ValueError(f"partition value {text!r}")
    return f"{partition}={text}"


#: Partitions that one catalogue statement adds.
PARTITIONS_AT_ONCE = 500


def add_partitions(spark: SparkSession, name: str, root: str, values, partition: str = "dt") -> None:
    """Make partitions known to an external table, many in each statement; nothing below ``root`` is listed."""
    folders = [(v, partition_folder(partition, v)) for v in values]
    for k in range(0, len(folders), PARTITIONS_AT_ONCE):
        parts = " ".join(f"PARTITION (`{partition}`='{v}') LOCATION '{root.rstrip('/')}/{f}'" for v, f in folders[k:k + PARTITIONS_AT_ONCE])
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {parts}")


def declare_external(spark: SparkSession, name: str, root: str, schema: StructType, partition: str = "dt") -> bool:
    """Declare an external Parquet table over ``root`` without looking at its files; an equal one stays.

    Returns whether it was declared now. A table of that name over another folder, or with other columns, is replaced
    (its files stay).
    """
    if spark.catalog.tableExists(name):
        about = {r[0]: r[1] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
        same = about.get("Location", "").removeprefix("file:").rstrip("/") == root.removeprefix("file:").rstrip("/")
        if same and {(f.name, f.dataType) for f in spark.table(name).schema} == {(f.name, f.dataType) for f in schema}:
            return False
        spark.sql(f"DROP TABLE {name}")
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE {name} ({cols}) USING parquet PARTITIONED BY (`{partition}`) LOCATION '{root}'")
    return True


def register_external(spark: SparkSession, name: str, path: str,
                      partitioned: bool = False, schema: StructType | None = None,
                      partition_by: tuple = ("dt",)) -> DataFrame:
    """Create-or-replace an unmanaged Parquet table over existing files.

    Dropping an unmanaged table leaves its files; a partitioned table needs
    its partitions discovered before it returns rows. With a known
    ``schema`` the table is declared instead of inferred, which saves one
    listing of every file under ``path``.
    """
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    if schema is not None:
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        parts = f" PARTITIONED BY ({', '.join(partition_by)})" if partitioned else ""
        spark.sql(f"CREATE TABLE {name} ({cols}) USING parquet{parts} LOCATION '{path}'")
    else:
        spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{path}'")
    if partitioned:
        spark.sql(f"MSCK REPAIR TABLE {name}")
    return spark.table(name)


def refresh_external_day(spark: SparkSession, name: str, path: str, ds: str, schema: StructType,
                         partition: str = "dt") -> DataFrame:
    """The external table over ``path`` after one of its days was written.

    A table that already stands over ``path`` only learns of that day; others
    are created (or replaced) with one discovery of all days.
    """
    if spark.catalog.tableExists(name):
        about = {r[0]: r[1] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
        if about.get("Location", "").removeprefix("file:").rstrip("/") == path.removeprefix("file:").rstrip("/"):
            spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS PARTITION ({partition}='{ds}')")
            spark.sql(f"REFRESH TABLE {name}")
            return spark.table(name)
    return register_external(spark, name, path, partitioned=True, schema=schema, partition_by=(partition,))
