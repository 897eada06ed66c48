"""Cell cleaning as column expressions, driven by the schema: no function runs per cell in Python."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StringType, StructType

# Fixed value: the extended-JSON name of an object id.
OBJECT_ID = "$oid"


def _is_object_id(dtype: DataType) -> bool:
    return isinstance(dtype, StructType) and dtype.fieldNames() == [OBJECT_ID]


def holds_object_id(dtype: DataType) -> bool:
    if _is_object_id(dtype):
        return True
    if isinstance(dtype, StructType):
        return any(holds_object_id(f.dataType) for f in dtype)
    if isinstance(dtype, ArrayType):
        return holds_object_id(dtype.elementType)
    if isinstance(dtype, MapType):
        return holds_object_id(dtype.valueType)
    return False


def object_ids_as_text(value: Column, dtype: DataType) -> Column:
    """Replaces every object id inside ``value``, at any depth, by its text."""
    if not holds_object_id(dtype):
        return value
    if _is_object_id(dtype):
        return value.getField(OBJECT_ID)
    if isinstance(dtype, ArrayType):
        return F.transform(value, lambda item: object_ids_as_text(item, dtype.elementType))
    if isinstance(dtype, MapType):
        return F.transform_values(value, lambda _, item: object_ids_as_text(item, dtype.valueType))
    fields = [object_ids_as_text(value.getField(f.name), f.dataType).alias(f.name) for f in dtype]
    return F.when(value.isNotNull(), F.struct(*fields))


def _quoted(name: str) -> Column:
    return F.col(f"`{name}`")


def convert_object_ids(df: DataFrame) -> DataFrame:
    return df.select(*[object_ids_as_text(_quoted(f.name), f.dataType).alias(f.name) for f in df.schema])


def serialize_complex_types(df: DataFrame) -> DataFrame:
    """Struct, array and map columns become JSON text. Missing inner fields are kept as null."""
    keep_nulls = {"ignoreNullFields": "false"}

    def cell(name: str, dtype: DataType) -> Column:
        nested = isinstance(dtype, (StructType, ArrayType, MapType))
        return F.to_json(_quoted(name), keep_nulls) if nested else _quoted(name)

    return df.select(*[cell(f.name, f.dataType).alias(f.name) for f in df.schema])


def strip_nul(df: DataFrame) -> DataFrame:
    """Drops NUL characters from every text column."""
    nul = F.char(F.lit(0))

    def cell(name: str, dtype: DataType) -> Column:
        if isinstance(dtype, StringType):
            return F.replace(_quoted(name), nul, F.lit(""))
        return _quoted(name)

    return df.select(*[cell(f.name, f.dataType).alias(f.name) for f in df.schema])


def stamp(df: DataFrame, load_ts: dt.datetime) -> DataFrame:
    """Adds the load time of the run, the same value on every row and every retry."""
    return df.withColumn("etl_datetime", F.lit(load_ts.isoformat(" ")).cast("timestamp_ntz"))
