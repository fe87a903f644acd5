"""quern: a Spark-first engine for record linkage and training-data preparation."""

__version__ = "0.1.0"
