"""Column lists and schemas of the stored tables and messages."""

from pyspark.sql import types as T

# The columns of the raw incident table, all text, in order.
RAW_COLUMNS = [
    "eventid", "iyear", "imonth", "iday",
    "country_txt", "region_txt", "provstate", "city", "latitude", "longitude",
    "attacktype1_txt", "targtype1_txt", "weaptype1_txt", "gname",
    "nkill", "nwound", "success", "suicide", "multiple", "individual",
    "summary",
]

# The columns of the clean incident table with their types.
CLEAN = T.StructType([
    T.StructField("eventid", T.LongType()),
    T.StructField("iyear", T.IntegerType()),
    T.StructField("imonth", T.IntegerType()),
    T.StructField("iday", T.IntegerType()),
    T.StructField("country_txt", T.StringType()),
    T.StructField("region_txt", T.StringType()),
    T.StructField("provstate", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("attacktype1_txt", T.StringType()),
    T.StructField("targtype1_txt", T.StringType()),
    T.StructField("weaptype1_txt", T.StringType()),
    T.StructField("gname", T.StringType()),
    T.StructField("nkill", T.IntegerType()),
    T.StructField("nwound", T.IntegerType()),
    T.StructField("success", T.IntegerType()),
    T.StructField("suicide", T.IntegerType()),
    T.StructField("summary", T.StringType()),
])

# The columns the interactive views work on.
DASHBOARD_COLUMNS = [
    "iyear", "country_txt", "region_txt", "city", "latitude", "longitude",
    "attacktype1_txt", "targtype1_txt", "gname", "nkill", "nwound", "summary",
]

# The stored article table.
ARTICLES = T.StructType([
    T.StructField("title", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("published_at", T.TimestampNTZType()),
    T.StructField("source_name", T.StringType()),
    T.StructField("author", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("content", T.StringType()),
    T.StructField("raw_json", T.StringType()),
])

# The fields read from an article message. ``source`` stays text here: it may be an object or anything else.
ARTICLE_JSON = T.StructType([
    T.StructField("title", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("publishedAt", T.StringType()),
    T.StructField("author", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("content", T.StringType()),
])

# One page of API results; each article stays a JSON text so that it decodes like a message.
RESPONSE_PAGE = T.StructType([
    T.StructField("status", T.StringType()),
    T.StructField("message", T.StringType()),
    T.StructField("articles", T.ArrayType(T.StringType())),
])

# Messages landed as files carry the columns a topic would give.
MESSAGE = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
])
