"""Incident- and article-shaped views over the test tables.

Every column is derived row by row, so the views grow with the tables. Some values are set to NULL by rule, because
the tables hold none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.filters import has_coordinates
from ..schemas import CLEAN, RAW_COLUMNS
from ..sources.articles import as_api_articles

PAGE_SIZE = 20


# The columns of the test tables in use. Given to the reader, they save a pass over the footers.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "embeddings": "vec_id long, embedding array<float>, label int",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def incidents(spark: SparkSession, sf_dir: str, summary: bool = False) -> DataFrame:
    """One typed row per order. ``summary`` adds the document texts, which costs a join; without it, it is NULL."""
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    # Nation and region have 25 and 5 rows at every scale.
    places = table(spark, sf_dir, "nation").join(
        F.broadcast(table(spark, sf_dir, "region")), F.col("n_regionkey") == F.col("r_regionkey")
    )
    df = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).join(
        F.broadcast(places), F.col("c_nationkey") == F.col("n_nationkey")
    )
    if summary:
        texts = table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("summary"))
        df = df.join(texts, F.col("o_orderkey") == F.col("doc_id"), "left")
    else:
        df = df.withColumn("summary", F.lit(None).cast("string"))
    return df.selectExpr(
        "o_orderkey AS eventid",
        "year(o_orderdate) AS iyear",
        "month(o_orderdate) AS imonth",
        "day(o_orderdate) AS iday",
        "if(o_orderkey % 29 = 0, NULL, n_name) AS country_txt",
        "if(o_orderkey % 19 = 0, NULL, r_name) AS region_txt",
        "concat('P', c_nationkey) AS provstate",
        "c_name AS city",
        "if(o_orderkey % 50 = 0, NULL, round(((o_orderkey * 7919) % 18001) / 1e2 - 90, 2)) AS latitude",
        "if(o_orderkey % 50 = 0, NULL, round(((o_orderkey * 104729) % 36001) / 1e2 - 180, 2)) AS longitude",
        "if(o_orderkey % 17 = 0, NULL, o_orderpriority) AS attacktype1_txt",
        "if(o_orderkey % 23 = 0, NULL, c_mktsegment) AS targtype1_txt",
        "o_orderstatus AS weaptype1_txt",
        """CASE WHEN o_custkey % 37 = 0 THEN NULL WHEN o_custkey % 10 = 0 THEN 'Unknown'
                WHEN o_custkey % 7 = 0 THEN "O'Neil" ELSE concat('G', o_custkey % 200) END AS gname""",
        "if(o_orderkey % 11 = 0, NULL, cast(floor(o_totalprice / 50000) AS int)) AS nkill",
        "if(o_orderkey % 13 = 0, NULL, cast(floor(o_totalprice / 20000) AS int)) AS nwound",
        "cast(o_orderkey % 2 AS int) AS success",
        "cast(o_orderkey % 3 = 0 AS int) AS suicide",
        "cast(o_orderkey % 5 = 0 AS int) AS multiple",
        "cast(o_orderkey % 7 = 0 AS int) AS individual",
        "summary",
    )


def clean(spark: SparkSession, sf_dir: str, summary: bool = False) -> DataFrame:
    return incidents(spark, sf_dir, summary).where(has_coordinates()).select(*CLEAN.names)


def incidents_raw(spark: SparkSession, sf_dir: str, summary: bool = True) -> DataFrame:
    """All columns as text; casualties carry a decimal point and years an exponent in places."""
    df = incidents(spark, sf_dir, summary)
    text = {name: F.col(name).cast("string") for name in RAW_COLUMNS}
    text["nkill"] = F.concat(text["nkill"], F.lit(".0"))
    text["nwound"] = F.when(F.col("eventid") % 4 == 0, F.concat(text["nwound"], F.lit(".5"))).otherwise(text["nwound"])
    text["iyear"] = F.when(F.col("eventid") % 6 == 0, F.concat(text["iyear"], F.lit("e0"))).otherwise(text["iyear"])
    return df.select(*[text[name].alias(name) for name in RAW_COLUMNS])


def articles_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One article per document, ``off`` is the arrival order. Exact copies share title and time; there are twice as
    many source names as sources."""
    return table(spark, sf_dir, "documents").selectExpr(
        "doc_id AS off",
        "if(doc_id % 41 = 0, NULL, text) AS title",
        """CASE WHEN doc_id % 5 = 0 THEN NULL WHEN doc_id % 5 = 1 THEN ''
                WHEN doc_id % 7 = 0 THEN 'http://news.example/front'
                ELSE concat('http://news.example/', doc_id div 4) END AS url""",
        """if(doc_id % 29 = 0, NULL,
              timestamp_ntz '2025-01-01 00:00:00' + n_chars * interval '1' minute) AS published_at""",
        "if(doc_id % 23 = 0, NULL, if(doc_id % 7 = 3, concat(source, ' wire'), source)) AS source_name",
        "if(doc_id % 3 = 0, NULL, concat('author ', lang)) AS author",
        "concat(lang, ' ', n_chars) AS description",
        "text AS content",
    )


def messages(spark: SparkSession, sf_dir: str, broken: bool = False) -> DataFrame:
    """(off, value): every article as a JSON message. ``broken`` damages some of them by rule."""
    api = as_api_articles(articles_in(spark, sf_dir), keep=["off"])
    packed = api.select("off", F.struct(*[c for c in api.columns if c != "off"]).alias("article"))
    whole = {"ignoreNullFields": "false"}
    value = F.to_json("article", whole)
    if broken:
        off, article = F.col("off"), F.col("article")
        value = (
            F.when(off % 17 == 0, F.concat(F.lit("{broken "), value))
            .when(off % 19 == 0, F.to_json(article.withField("publishedAt", F.lit("notadate")), whole))
            .when(off % 13 == 0, F.to_json(article.withField("source", F.lit("a plain string")), whole))
            .otherwise(value)
        )
    return packed.select("off", value.alias("value"))


def landed_messages(spark: SparkSession, sf_dir: str, broken: bool = False) -> DataFrame:
    """Messages with the columns of a topic: one partition, ``off`` as the offset, one second apart."""
    return messages(spark, sf_dir, broken).select(
        F.lit(None).cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
        F.lit(0).alias("partition"),
        F.col("off").alias("offset"),
        F.timestamp_seconds(F.lit(1735689600) + F.col("off")).alias("timestamp"),
    )


def response_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(page, value): API pages of at most PAGE_SIZE articles. Some failed, some came without articles."""
    page = F.floor(F.col("off") / PAGE_SIZE)
    entry = F.struct("off", "value")
    grouped = messages(spark, sf_dir).groupBy(page.alias("page")).agg(
        F.concat_ws(",", F.transform(F.array_sort(F.collect_list(entry)), lambda m: m["value"])).alias("articles")
    )
    ok = F.concat(F.lit('{"status":"ok","articles":['), F.col("articles"), F.lit("]}"))
    value = (
        F.when(F.col("page") % 7 == 3, F.lit('{"status":"error","message":"rate limited"}'))
        .when(F.col("page") % 11 == 5, F.lit('{"status":"ok"}'))
        .otherwise(ok)
    )
    return grouped.select("page", value.alias("value"))


def first_half(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Articles that arrived before the middle, and the rest."""
    middle = df.agg(F.floor((F.max("off") + 1) / 2)).scalar()
    return df.where(F.col("off") < middle), df.where(F.col("off") >= middle)
