"""Ad-load-time analytics on PySpark.

Raw impression logs go in as all-string DataFrames; cleaned features, per-group
statistics, error profiles, rebalanced training sets and regression models come
out. Every step is a DataFrame expression or a ``pyspark.ml`` stage.
"""
