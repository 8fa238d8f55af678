"""tripscope: taxi-trip analytics as Spark DataFrame plans.

Every analysis is a function from a trips DataFrame (see
``tripscope.schema.TRIP_SCHEMA``) to a result DataFrame, built from Spark's
DataFrame, SQL and ML APIs only.
"""

from tripscope.schema import REQUIRED_COLUMNS, TRIP_SCHEMA, conform

__all__ = ["REQUIRED_COLUMNS", "TRIP_SCHEMA", "conform"]
