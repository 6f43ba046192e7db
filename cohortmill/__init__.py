"""cohortmill: layered processing of study-registry records on Spark.

Raw nested JSON -> bronze -> silver -> gold marts, quality checks, features and
classifiers. Every operator is a function from DataFrames to a DataFrame, so
one plan reaches Catalyst whole; nothing is collected but tables whose size is
bounded by a constant.
"""

__version__ = "0.1.0"
