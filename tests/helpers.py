import datetime as dt

from pyspark.sql import types as T


def ts(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


def behavior_df(spark, rows):
    """rows: (userId, itemId, behavior, 'YYYY-MM-DD HH:MM:SS', offset)"""
    schema = T.StructType([
        T.StructField("userId", T.LongType()), T.StructField("itemId", T.LongType()),
        T.StructField("behavior", T.StringType()), T.StructField("ts", T.TimestampNTZType()),
        T.StructField("offset", T.LongType()),
    ])
    return spark.createDataFrame([(u, i, b, ts(t), o) for u, i, b, t, o in rows], schema)


def sorted_rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())
