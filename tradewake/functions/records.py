"""JSON text to typed rows and back, with malformed input set aside."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt"


def _with_text(kind: T.DataType) -> T.DataType:
    """The type with text in place of its numbers."""
    if isinstance(kind, T.NumericType):
        return T.StringType()
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _with_text(f.dataType), f.nullable)
                             for f in kind])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_with_text(kind.elementType), kind.containsNull)
    if isinstance(kind, T.MapType):
        return T.MapType(kind.keyType, _with_text(kind.valueType), kind.valueContainsNull)
    return kind


def parse_rows(raw: DataFrame, schema: T.StructType, value: str = "value",
               keep: tuple[str, ...] = ()) -> DataFrame:
    """Parse the JSON text of ``value``; fields unknown to ``schema`` are ignored.

    Text that is not JSON, or holds a value of the wrong shape, is returned in ``_corrupt``.
    Numbers may be quoted at any depth; text that is no number gives null.

    The row is unpacked by a generator on purpose: filters on its fields then stay above it.
    Pushed below a projection they would parse the text once more for every field they test.
    """
    text = T.StringType()
    as_read = [T.StructField(f.name, _with_text(f.dataType)) for f in schema]
    with_corrupt = T.StructType([*as_read, T.StructField(CORRUPT, text)])
    row = F.from_json(
        F.col(value), with_corrupt, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    )
    typed = [F.col(f.name).try_cast(f.dataType).alias(f.name)
             if _with_text(f.dataType) != f.dataType else F.col(f.name) for f in schema]
    return raw.select(*keep, F.inline(F.array(row))).select(*keep, *typed, CORRUPT)


def to_values(df: DataFrame, *keep: str) -> DataFrame:
    """Rows to a JSON ``value`` column, the shape topics store; null fields are left out."""
    body = [c for c in df.columns if c not in keep]
    return df.select(*keep, F.to_json(F.struct(*body)).alias("value"))


def set_field(struct: str, field: str, value: Column) -> Column:
    """``struct`` with one field replaced or added; a null struct stays null."""
    return F.col(struct).withField(field, value)
