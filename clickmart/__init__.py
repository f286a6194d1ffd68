"""clickmart: a clickstream medallion (raw -> bronze -> silver -> gold) on Spark.

Every transformation is a pure ``DataFrame -> DataFrame`` function built from
the built-in Spark API; readers, writers and streaming queries are thin
wrappers around those functions.
"""

__all__ = ["schemas", "session"]
