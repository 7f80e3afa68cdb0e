"""Column and row-shape functions built from pyspark.sql.functions."""
