"""Bring any frame to a fixed schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schemas import POSTING


def conform(df: DataFrame, schema: T.StructType = POSTING) -> DataFrame:
    """Columns of `schema` in its order and types: a missing one is a typed null, others are
    dropped, and a value that does not fit its type is null."""

    def column(field: T.StructField):
        if field.name not in df.columns:
            return F.lit(None).cast(field.dataType).alias(field.name)
        source = F.col(f"`{field.name}`")
        if df.schema[field.name].dataType != field.dataType:
            source = source.try_cast(field.dataType)
        return source.alias(field.name)

    return df.select([column(f) for f in schema])
