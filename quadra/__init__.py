"""quadra — property-listing analytics as Spark DataFrame operators.

Every operator is a function ``DataFrame -> DataFrame`` (or returns a small
report DataFrame) built from ``pyspark.sql.functions`` so Catalyst can fuse,
push down and prune; see ``quadra.plans.pipeline`` for the composed job.
"""

__all__ = ["session", "params", "dims"]
