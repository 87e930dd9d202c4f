"""JSON as VARIANT: a text is parsed once, fields are read from its binary form; what isn't JSON gives nulls, not errors.

A table that stores such a column as VARIANT never parses it again, and Spark can shred its fields
(spark.sql.variant.writeShredding.enabled) so that a scan reads only those asked for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, VariantType


def nested(c: Column) -> Column:
    """The VARIANT of a JSON text; a JSON string that holds JSON is parsed again. Null for null, and for what isn't JSON."""
    once = F.try_parse_json(c)
    return F.when(F.schema_of_variant(once) == "STRING", F.try_parse_json(F.try_variant_get(once, "$", "string"))).otherwise(once)


def as_variant(df: DataFrame, column: str) -> Column:
    """A column of df as VARIANT, whether it is stored as such or as JSON text."""
    return F.col(column) if isinstance(df.schema[column].dataType, VariantType) else nested(F.col(column))


def field(v: Column, path: str, kind: str) -> Column:
    """A field as a type, or null where it is missing or isn't of it."""
    return F.try_variant_get(v, path, kind)


def entries(v: Column) -> Column:
    """The elements of a JSON array as an array of VARIANT; null for anything else."""
    return F.try_variant_get(v, "$", "array<variant>")


def record(v: Column, schema: str) -> Column:
    """A struct of the fields that a DDL schema names; null for anything but an object."""
    fields = F.struct(*(field(v, f"$['{f.name}']", f.dataType.simpleString()).alias(f.name) for f in StructType.fromDDL(schema.removeprefix("struct<").removesuffix(">") if schema.startswith("struct<") else schema)))
    return F.when(F.schema_of_variant(v).startswith("OBJECT"), fields)
