"""reelstack — layered (raw → trusted → refined) movie analytics on Spark.

Every operator is a DataFrame-in / DataFrame-out function built from Spark SQL
expressions, so Catalyst can push filters and prune columns through whole
pipelines. Sub-packages:

* ``functions`` – column-level helpers (lenient casts, keyword match, JSON fields).
* ``operators`` – DataFrame operators (projection, filters, joins, dedup, keys,
  set operations, ordering, profiling, SQL views).
* ``sources``   – readers, landing, page flattening and sinks.
* ``plans``     – star-schema builder, the five layer jobs and the acceptance
  queries mapped onto the driver tables.
* ``streaming`` – incremental (Structured Streaming) run of the trusted API job.
"""

__version__ = "0.1.0"
