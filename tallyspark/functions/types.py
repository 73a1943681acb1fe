"""Runtime type names and the Spark types a load uses for them."""

from __future__ import annotations

from pyspark.sql import types as T

# Column type by runtime type name. Every text is unbounded, every decimal is (13,2), double precision
# is narrowed to single, and an unsigned byte needs Spark's short.
RUNTIME_TYPES: dict[str, T.DataType] = {
    "System.String": T.StringType(),
    "System.Decimal": T.DecimalType(13, 2),
    "System.Double": T.FloatType(),
    "System.Single": T.FloatType(),
    "System.Int64": T.LongType(),
    "System.Int16": T.IntegerType(),
    "System.Int32": T.IntegerType(),
    "System.DateTime": T.TimestampType(),
    "System.Boolean": T.BooleanType(),
    "System.Byte": T.ShortType(),
    "System.Guid": T.StringType(),
}

_RUNTIME_NAME = {
    T.StringType: "System.String",
    T.VarcharType: "System.String",
    T.CharType: "System.String",
    T.DecimalType: "System.Decimal",
    T.DoubleType: "System.Double",
    T.FloatType: "System.Single",
    T.LongType: "System.Int64",
    T.IntegerType: "System.Int32",
    T.ShortType: "System.Int16",
    T.ByteType: "System.Byte",
    T.DateType: "System.DateTime",
    T.TimestampType: "System.DateTime",
    T.TimestampNTZType: "System.DateTime",
    T.BooleanType: "System.Boolean",
}


def column_type(runtime_name: str) -> T.DataType:
    """Spark type for a runtime type name; unknown names raise ``ValueError`` naming the type."""
    try:
        return RUNTIME_TYPES[str(runtime_name)]
    except KeyError:
        raise ValueError(f"{runtime_name} not implemented.") from None


def runtime_name(spark_type: T.DataType) -> str:
    """Runtime type name of a Spark column; types with no counterpart raise ``ValueError``."""
    try:
        return _RUNTIME_NAME[type(spark_type)]
    except KeyError:
        raise ValueError(f"{spark_type.simpleString()} not implemented.") from None
