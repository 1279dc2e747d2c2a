"""Table schemas from the JSON column list of a warehouse table."""

from collections.abc import Mapping, Sequence

from pyspark.sql import types as T

from ..errors import DefinitionError

# Warehouse type names and the Spark types that hold them.
_TYPES = {
    "INT64": T.LongType(), "INTEGER": T.LongType(), "INT": T.LongType(),
    "SMALLINT": T.LongType(), "BIGINT": T.LongType(), "TINYINT": T.LongType(),
    "BYTEINT": T.LongType(),
    "FLOAT64": T.DoubleType(), "FLOAT": T.DoubleType(), "DOUBLE": T.DoubleType(),
    "NUMERIC": T.DecimalType(38, 9), "DECIMAL": T.DecimalType(38, 9),
    "BIGNUMERIC": T.DecimalType(38, 18), "BIGDECIMAL": T.DecimalType(38, 18),
    "BOOL": T.BooleanType(), "BOOLEAN": T.BooleanType(),
    "DATE": T.DateType(), "DATETIME": T.TimestampNTZType(), "TIMESTAMP": T.TimestampType(),
    "TIME": T.StringType(), "STRING": T.StringType(), "BYTES": T.BinaryType(),
}


def spark_type(column: Mapping) -> T.DataType:
    """Spark type of one column; an unknown type name is text."""
    name = str(column["type"]).strip().upper()
    if name in ("RECORD", "STRUCT"):
        found: T.DataType = schema_from_ddl(column.get("fields") or [])
    else:
        found = _TYPES.get(name, T.StringType())
    return T.ArrayType(found) if str(column.get("mode", "")).upper() == "REPEATED" else found


def schema_from_ddl(columns: Sequence[Mapping]) -> T.StructType:
    """StructType of a list of ``{"name", "type"[, "mode", "fields"]}`` objects."""
    if not isinstance(columns, (list, tuple)) or not columns:
        raise DefinitionError("a schema is a non-empty list of columns")
    fields = []
    for position, column in enumerate(columns):
        if not isinstance(column, Mapping):
            raise DefinitionError(f"column {position} is not an object")
        if not column.get("name") or not column.get("type"):
            raise DefinitionError(f"column {position} needs a name and a type")
        required = str(column.get("mode", "")).upper() == "REQUIRED"
        fields.append(T.StructField(column["name"], spark_type(column), not required))
    return T.StructType(fields)
