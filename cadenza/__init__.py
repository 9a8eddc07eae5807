"""cadenza: music-event analytics as Spark DataFrame transforms.

Every operator is a pure ``DataFrame -> DataFrame`` function built from
``pyspark.sql.functions`` so Catalyst can fuse, prune and push it down, and
so the same function runs on a batch read or on a ``readStream``.
"""

__version__ = "0.1.0"
