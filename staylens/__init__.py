"""staylens: Spark-native booking-cancellation analytics.

DataFrame jobs for cleaning, feature derivation, train-only fitted
preprocessing, profiling, stratified hash splits, evaluation, tree-ensemble
training with ``pyspark.ml`` and batch scoring.  Every operator takes a
DataFrame plus column names; hotel column names are only defaults.
"""

__version__ = "0.1.0"
