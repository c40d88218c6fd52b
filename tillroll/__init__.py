"""tillroll: a retail and loyalty lakehouse on Spark.

Bronze -> Silver -> Gold, data-quality gates, a type 2 customer history,
semantic-model measures and operational log queries, all written as
functions from DataFrame to DataFrame.
"""

__version__ = "0.1.0"
