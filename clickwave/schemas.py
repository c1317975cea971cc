"""Record schemas.  Input text is split by position, so nothing is inferred."""

from pyspark.sql import types as T

# user behaviour line: userId,itemId,categoryId,behavior,timestamp(epoch s)
USER_BEHAVIOR = T.StructType([
    T.StructField("userId", T.LongType()),
    T.StructField("itemId", T.LongType()),
    T.StructField("categoryId", T.IntegerType()),
    T.StructField("behavior", T.StringType()),
    T.StructField("timestamp", T.LongType()),
])

# ad click line: userId,adId,province,city,timestamp(epoch s)
AD_CLICK = T.StructType([
    T.StructField("userId", T.LongType()),
    T.StructField("adId", T.LongType()),
    T.StructField("province", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("timestamp", T.LongType()),
])

# parsed web log: ip user - dd/MM/yyyy:HH:mm:ss zone method url
APACHE_LOG = T.StructType([
    T.StructField("ip", T.StringType()),
    T.StructField("userId", T.StringType()),
    T.StructField("timestamp", T.LongType()),
    T.StructField("method", T.StringType()),
    T.StructField("url", T.StringType()),
])

MARKETING = T.StructType([
    T.StructField("userId", T.LongType()),
    T.StructField("behavior", T.StringType()),
    T.StructField("channel", T.StringType()),
    T.StructField("timestamp", T.LongType()),
])

# the driver's event table
EVENTS = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])
