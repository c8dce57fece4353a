"""dryspell: station-precipitation drought analytics as Spark DataFrame operators.

Every public operator is a ``DataFrame -> DataFrame`` function built from
built-in Spark SQL expressions, so Catalyst sees the whole plan (pushdown,
pruning, partial aggregation, adaptive re-planning).
"""

__version__ = "0.1.0"
