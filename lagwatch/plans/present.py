"""Final projection of registered queries: the wire form of a table.

Times become ISO-8601 text as in the published records, doubles keep four decimals (the order in
which a cluster adds doubles is not fixed), and an alert's JSON context becomes typed columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lagwatch.functions.expr import iso_utc


def rounded(value: Column, decimals: int = 4) -> Column:
    unit = 10.0**decimals
    return F.floor(value * unit + 0.5) / unit


def present(df: DataFrame, decimals: int = 4) -> DataFrame:
    def shape(field: T.StructField) -> Column:
        column = F.col(field.name)
        if isinstance(field.dataType, T.DoubleType):
            return rounded(column, decimals).alias(field.name)
        if isinstance(field.dataType, T.TimestampType):
            return iso_utc(column).alias(field.name)
        return column

    return df.select(*[shape(field) for field in df.schema])


def open_context(alerts: DataFrame, schema: str) -> DataFrame:
    """Context members as columns with the prefix ``ctx_``."""
    parsed = alerts.withColumn("_context", F.from_json("context", schema))
    names = T.StructType.fromDDL(schema).fieldNames()
    members = [F.col(f"_context.{name}").alias(f"ctx_{name}") for name in names]
    return present(parsed.select(*[c for c in alerts.columns if c != "context"], *members))
