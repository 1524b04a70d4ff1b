"""flowgauge: keyed sensor readings on Spark.

Status, statistics, data quality, features, model training and scoring for
readings taken along a road network, or for any table keyed by (key, time)
with a dimension table beside it.
"""
