"""Column-level expressions built only from ``pyspark.sql.functions`` (no Python UDFs)."""
