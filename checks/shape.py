"""Give query results plain columns, so that both engines' values compare."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logwarden.session import checkpoint_dir


def plain(name: str, kind: T.DataType) -> Column:
    column = F.col(f"`{name}`")
    if isinstance(kind, T.TimestampType):
        return F.date_format(column, "yyyy-MM-dd HH:mm:ss")
    if isinstance(kind, T.ArrayType):
        if isinstance(kind.elementType, T.TimestampType):
            column = F.transform(column, lambda x: F.date_format(x, "yyyy-MM-dd HH:mm:ss"))
        return F.array_join(column.cast("array<string>"), "|")
    if isinstance(kind, (T.IntegerType, T.ShortType, T.ByteType)):
        return column.cast("bigint")
    if isinstance(kind, T.FloatType):
        return column.cast("double")
    return column


def flat(df: DataFrame, *columns: str) -> DataFrame:
    """Selected columns (``a.b`` paths and ``expr AS name`` allowed) with nulls as '' or -1."""
    df = df.selectExpr(*columns) if columns else df
    out = []
    for field in df.schema.fields:
        column = plain(field.name, field.dataType)
        if isinstance(field.dataType, (T.StringType, T.TimestampType, T.ArrayType)):
            column = F.coalesce(column, F.lit(""))
        elif isinstance(field.dataType, T.DoubleType):
            column = F.coalesce(F.round(column, 6), F.lit(-1.0))
        elif isinstance(field.dataType, (T.IntegerType, T.LongType)):
            column = F.coalesce(column, F.lit(-1).cast("bigint"))
        out.append(column.alias(field.name))
    return df.select(*out)


def scratch(spark, name: str) -> str:
    """A fresh folder under the checkpoint folder for queries that write and read back."""
    import uuid

    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
