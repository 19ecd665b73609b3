"""Named queries: one module per reference workload.

Each module exposes ``QUERIES`` (name -> callable(spark, sf_dir) -> DataFrame)
and ``ORACLE`` (name -> DuckDB SQL over the driver tables).
"""
