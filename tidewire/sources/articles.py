"""Article messages and API response pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, StringType, StructField, StructType

from ..functions.casts import ntz_to_iso, to_ntz
from ..functions.once import once
from ..schemas import ARTICLE_JSON, ARTICLES, RESPONSE_PAGE

# As strict as the JSON standard about quotes.
_JSON = {"mode": "PERMISSIVE", "allowSingleQuotes": "false"}


_END = "_end_of_text"


def _object_text(df: DataFrame, col: str) -> Column:
    """The text of a JSON object; NULL for bytes that are no UTF-8 and for any other kind of value."""
    text = F.col(col)
    if isinstance(df.schema[col].dataType, BinaryType):
        text = F.when(F.is_valid_utf8(text.cast("string")), text.cast("string"))
    bare = F.btrim(text, F.lit(" \t\n\r"))
    return F.when(bare.startswith("{") & bare.endswith("}"), bare)


def _with_object(df: DataFrame, col: str, schema: StructType, name: str) -> DataFrame:
    """Adds the one JSON object that is the whole of a text as a struct; NULL for anything else.

    A parser stops where its value ends. So the text is parsed as the first of two elements of an array; only if it
    is one whole object, the second element is the mark put behind it, which holds the text's own hash.
    """
    text = _object_text(df, col)
    mark = F.xxhash64(text).cast("string")
    pair = F.concat(F.lit("["), text, F.lit(f',{{"{_END}":"'), mark, F.lit('"}]'))
    elements = ArrayType(StructType([*schema.fields, StructField(_END, StringType())]))
    parsed = df.withColumn("_parsed", once(F.struct(F.from_json(pair, elements, _JSON).alias("e"), mark.alias("mark"))))
    whole = (F.size("_parsed.e") == 2) & (F.get("_parsed.e", F.lit(1))[_END] == F.col("_parsed.mark"))
    first = F.get("_parsed.e", F.lit(0))
    only = F.when(whole & first.isNotNull(), F.struct(*[first[f.name].alias(f.name) for f in schema.fields]))
    return parsed.withColumn(name, only).drop("_parsed")


def decode_articles(df: DataFrame, value_col: str = "value") -> DataFrame:
    """Adds ``raw_json`` (the message as text), ``doc`` (its fields) and ``decoded`` (false: not a JSON object)."""
    out = _with_object(df, value_col, ARTICLE_JSON, "doc")
    return out.withColumns({"raw_json": F.col(value_col).cast("string"), "decoded": F.col("doc").isNotNull()})


def extract_article(decoded: DataFrame, keep: list[str] = ()) -> DataFrame:
    """The stored article columns, those in ``keep``, and ``reject_reason`` (NULL: the row can be stored).

    ``source.name`` is NULL when ``source`` is no object. The message is kept as it came.
    """
    published = to_ntz(F.col("doc.publishedAt"))
    reason = F.when(~F.col("decoded"), "invalid json").when(
        F.col("doc.publishedAt").isNotNull() & published.isNull(), "bad timestamp"
    )
    fields = {
        "title": F.col("doc.title"),
        "url": F.col("doc.url"),
        "published_at": published,
        "source_name": F.when(F.col("decoded"), F.get_json_object("raw_json", "$.source.name")),
        "author": F.col("doc.author"),
        "description": F.col("doc.description"),
        "content": F.col("doc.content"),
        "raw_json": F.col("raw_json"),
    }
    return decoded.select(*keep, *[col.alias(name) for name, col in fields.items()], reason.alias("reject_reason"))


def accepted(extracted: DataFrame) -> DataFrame:
    return extracted.where(F.col("reject_reason").isNull()).drop("reject_reason")


def quarantine(extracted: DataFrame, keep: list[str] = ()) -> DataFrame:
    """Messages that cannot be stored, with the reason."""
    return extracted.where(F.col("reject_reason").isNotNull()).select(*keep, "raw_json", "reject_reason")


def decode_pages(df: DataFrame, value_col: str = "value", keep: list[str] = ()) -> DataFrame:
    pages = _with_object(df, value_col, RESPONSE_PAGE, "_page")
    return pages.select(*keep, F.col(value_col).cast("string").alias("raw_page"), "_page")


def _page_ok() -> Column:
    return F.coalesce(F.col("_page.status") == "ok", F.lit(False))


def explode_response_pages(df: DataFrame, value_col: str = "value", keep: list[str] = ()) -> DataFrame:
    """One row per article of every page with status ok, as a message (``value``). No articles: no rows."""
    ok = decode_pages(df, value_col, keep).where(_page_ok())
    return ok.select(*keep, F.explode("_page.articles").alias("value"))


def rejected_pages(df: DataFrame, value_col: str = "value", keep: list[str] = ()) -> DataFrame:
    """Pages with another status, or none, with the message they carry."""
    bad = decode_pages(df, value_col, keep).where(~_page_ok())
    return bad.select(*keep, F.col("_page.status").alias("status"), F.col("_page.message").alias("message"), "raw_page")


def as_api_articles(df: DataFrame, keep: list[str] = ()) -> DataFrame:
    """Stored article columns in the shape of the API: camel case time, nested source."""
    return df.select(
        *keep,
        "title",
        "url",
        ntz_to_iso(F.col("published_at")).alias("publishedAt"),
        F.struct(F.col("source_name").alias("name")).alias("source"),
        "author",
        "description",
        "content",
    )


def article_messages(df: DataFrame, key_field: str | None = "url", keep: list[str] = ()) -> DataFrame:
    """(key, value) per article. The key is the chosen field if it is text; nulls stay in the JSON."""
    key = F.lit(None).cast("string")
    if key_field in df.columns and isinstance(df.schema[key_field].dataType, StringType):
        key = F.col(key_field)
    value = F.to_json(F.struct(*[c for c in df.columns if c not in keep]), {"ignoreNullFields": "false"})
    return df.select(*keep, key.alias("key"), value.alias("value"))


def publish_articles(df: DataFrame, topic: str, options: dict[str, str], key_field: str | None = "url") -> None:
    """Send articles to a topic; needs the Kafka connector of Spark and ``kafka.bootstrap.servers``."""
    article_messages(df, key_field).write.format("kafka").options(**options).option("topic", topic).save()


def stored_columns(df: DataFrame) -> DataFrame:
    return df.select(*ARTICLES.names)
