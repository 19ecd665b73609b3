"""Shared by the tests of this folder."""

import os

SF = "/root/testdata/sf0.001"
TABLES = "documents embeddings pages benchmark labels conversations".split()


def write_tables(spark, tmp_path, given: dict, like: str = SF) -> str:
    """A folder of tables: those given, the others empty with the schema of ``like``."""
    for name in TABLES:
        path = str(tmp_path / f"{name}.parquet")
        df = given[name] if name in given else spark.read.parquet(os.path.join(like, f"{name}.parquet")).limit(0)
        df.write.parquet(path)
    return str(tmp_path)
