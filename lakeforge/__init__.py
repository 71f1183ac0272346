"""lakeforge — a Spark-native medallion warehouse: Bronze snapshots, SCD2
Silver history, SCD1 Gold star schema, BI queries, checks and an ML
pipeline, all as distributed DataFrame → DataFrame operators."""

__version__ = "0.1.0"
