"""ingot: a Spark-native medallion pipeline for match records.

Layers: raw JSON messages land in a bronze Parquet table (batch or Structured
Streaming), a silver job parses and flattens the nested match documents, a gold
job rolls them up, and monitor operators measure the pipeline itself.  Every
transform is a pure ``DataFrame -> DataFrame`` function; only sinks, streams and
the ``queries()`` registry trigger actions.
"""

__version__ = "0.1.0"
