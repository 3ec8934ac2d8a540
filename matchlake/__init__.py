"""Spark-native match analytics: ingest nested match documents, flatten them
into typed tables and build the marts on top, with every step expressed as
DataFrame operations so that Catalyst plans it and the cluster scales it."""

__version__ = "0.1.0"
