"""hopgraph: follow-graph analytics on Spark.

Edge tables (followers / follows) are deduplicated into their latest
version per (handle, actor), joined two hops out from a base account and
ranked; a nested event table is projected into flat, typed rows.  Every
operator is a DataFrame -> DataFrame function so batch and Structured
Streaming share one implementation.
"""

__version__ = "0.1.0"
