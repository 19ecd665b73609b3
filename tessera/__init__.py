"""tessera: Spark-native operators for cleansing, usage/cost analytics, keyed
grouping, text lines, event/document ingest, exports and quality gates.

Modules: ``functions`` (Column -> Column), ``sources`` / ``sinks`` (I/O and
derived relations), ``operators`` (DataFrame -> DataFrame), ``streaming``
(Structured Streaming jobs), ``plans`` (the named queries and their oracles),
``session`` (session settings and the shared scratch folder), ``cli``.
"""

__version__ = "0.1.0"
