"""Registered queries: each is ``fn(spark, sf_dir) -> DataFrame`` over the
driver tables, with a DuckDB oracle in ``ORACLE`` where SQL can express it."""
