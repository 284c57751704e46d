"""Column-expression helpers built from pyspark.sql.functions only."""
