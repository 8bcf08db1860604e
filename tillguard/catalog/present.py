"""Presentation step shared by the registered queries: doubles rounded
(half up, see ``functions.numeric``) to 6 dp and timestamps as ``timestamp_ntz`` (UTC wall clock), so results compare
value-for-value with the SQL oracle."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillguard.functions.numeric import round_half_up


def present(df: DataFrame, digits: int = 6) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = round_half_up(c.cast("double"), digits).alias(f.name)
        elif isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz").alias(f.name)
        cols.append(c)
    return df.select(*cols)
