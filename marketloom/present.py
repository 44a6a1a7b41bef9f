"""Result types that every client can compare: decimals as double, dates and
zoned timestamps as zone-less timestamps, intervals as seconds, arrays as text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketloom.functions import to_seconds


def present(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c, t = F.col(f"`{f.name}`"), f.dataType
        if isinstance(t, T.DecimalType):
            c = c.cast("double")
        elif isinstance(t, (T.DateType, T.TimestampType)):
            c = c.cast("timestamp_ntz")
        elif isinstance(t, T.DayTimeIntervalType):
            c = to_seconds(c)
        elif isinstance(t, T.ArrayType):
            c = F.array_join(c, ",")
        cols.append(c.alias(f.name))
    return df.select(*cols)
