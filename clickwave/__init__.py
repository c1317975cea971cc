"""clickwave: user-behaviour and web-traffic analytics on Spark.

Every operator is a function ``DataFrame -> DataFrame`` built from Spark SQL
expressions, so Catalyst plans, prunes and pushes down as usual.  Batch jobs
live in :mod:`clickwave.plans`; the same semantics over unbounded input live
in :mod:`clickwave.streaming`.
"""

__version__ = "0.1.0"
