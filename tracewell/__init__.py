"""tracewell: evidence-first, point-in-time data processing on Spark.

Sub-packages: ``sources`` (tables and raw payload readers), ``functions``
(column expressions), ``operators`` (DataFrame -> DataFrame), ``plans``
(registered queries with their SQL), ``streaming`` (Structured Streaming
forms).  The training-data text operators live in ``llm``, which nothing here
imports.
"""
