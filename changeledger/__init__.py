"""changeledger: order-style tables kept current and queryable through time, on Spark.

Snapshots of nested documents and streams of change events become typed Parquet
datasets; every read (current state, as-of a version / time / tag, diffs, checks,
aggregates) is a DataFrame plan that Catalyst optimises.
"""

__version__ = "0.1.0"
