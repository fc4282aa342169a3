"""Incident records: CSV scan and typed cleaning."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import casts
from ..operators.filters import has_coordinates
from ..schemas import CLEAN, RAW_COLUMNS
from .splits import quoted_records

def select_raw(df: DataFrame) -> DataFrame:
    return df.select(*RAW_COLUMNS)


def _read_records(spark: SparkSession, path: str, options: dict[str, str]) -> DataFrame:
    """The columns of records that :func:`quoted_records` finds; the first of each file must be the header."""
    names = spark.read.options(**options).csv(path).columns
    texts = ", ".join(f"`{name.replace('`', '``')}` string" for name in [*names, "_malformed"])
    parse = {**options, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_malformed"}
    text = F.decode("raw", options["encoding"])
    # Where records end with CRLF, line breaks in fields become LF, as with the reader of whole files.
    plain = F.when(text.endswith("\r"), F.rtrim(F.replace(text, F.lit("\r\n"), F.lit("\n")), F.lit("\r"))).otherwise(text)
    records = quoted_records(spark, path).select("first", plain.alias("text")).where("text != ''")
    fields = records.select("first", F.from_csv("text", texts, parse).alias("r")).where("r._malformed IS NULL")
    other = reduce(lambda a, b: a | b, [F.lower(F.col(f"r.{c}")).eqNullSafe(c.lower()) == F.lit(False) for c in RAW_COLUMNS])
    wrong = F.raise_error(F.lit("a file has another header than the first one")).cast("boolean")
    return fields.where(F.when(~F.col("first"), True).otherwise(F.when(other, wrong).otherwise(False))).select("r.*")


def read_incident_csv(
    spark: SparkSession, path: str, multi_line: bool = True, encoding: str = "UTF-8", split: bool = False
) -> DataFrame:
    """All columns as text by header name. Malformed rows are skipped: too few or too many fields, or bytes that are
    no UTF-8. For that, bytes are read one by one and decoded per field. Any other ``encoding`` is decoded by the
    reader, which has no invalid bytes in single-byte encodings.

    No schema is passed on purpose: the header may hold more columns than are kept, and every file's header is
    checked against the first one's. Quoted line breaks need
    ``multi_line``, which reads each file in one task; ``split`` gives the same rows with many tasks for a file, if
    quotes stand around fields or doubled inside them only, and reads it twice (:func:`quoted_records`). Files whose
    fields hold no line breaks need neither.
    """
    if split and encoding.upper().replace("-", "").replace("_", "")[:5] in ("UTF16", "UTF32", "UCS2"):
        raise ValueError("files of wide characters cannot be split")
    by_bytes = encoding.upper().replace("-", "") == "UTF8"
    shape = {
        "header": "true",
        "enforceSchema": "false",
        "quote": '"',
        "escape": '"',
        "encoding": "ISO-8859-1" if by_bytes else encoding,
    }
    if split:
        df = select_raw(_read_records(spark, path, {**shape, "multiLine": "true"}))
    else:
        df = select_raw(spark.read.options(**shape, multiLine=multi_line, mode="DROPMALFORMED").csv(path))
    if not by_bytes:
        return df
    texts = [F.encode(name, "ISO-8859-1").cast("string").alias(name) for name in RAW_COLUMNS]
    valid = [F.coalesce(F.is_valid_utf8(name), F.lit(True)) for name in RAW_COLUMNS]
    return df.select(*texts).where(reduce(lambda a, b: a & b, valid))


def _cast(field: T.StructField, strict: bool) -> Column:
    col = F.col(field.name)
    if isinstance(field.dataType, (T.IntegerType, T.LongType)):
        to = field.dataType.simpleString()
        return casts.strict_int(col, to) if strict else casts.lenient_int(col, to)
    if isinstance(field.dataType, T.DoubleType):
        return casts.strict_double(col) if strict else casts.lenient_double(col)
    return col


def _typed(strict: bool) -> list[Column]:
    return [_cast(field, strict).alias(field.name) for field in CLEAN.fields]


def _lossy() -> Column:
    """True where a lenient cast would turn a value into NULL."""
    numeric = [f for f in CLEAN.fields if not isinstance(f.dataType, T.StringType)]
    lost = [F.col(f.name).isNotNull() & _cast(f, strict=False).isNull() for f in numeric]
    return reduce(lambda a, b: a | b, lost)


def clean_incidents(df: DataFrame, on_error: str = "fail") -> DataFrame:
    """Typed rows that have both coordinates. The filter comes first: a bad value in a dropped row does no harm.

    ``on_error`` says what a value that does not cast does: ``fail`` the job, become ``null``, or send its row to
    ``quarantine`` (see :func:`quarantined_incidents`).
    """
    located = df.where(has_coordinates())
    if on_error == "fail":
        return located.select(*_typed(strict=True))
    if on_error == "quarantine":
        located = located.where(~_lossy())
    elif on_error != "null":
        raise ValueError(f"on_error must be fail, null or quarantine, not {on_error!r}")
    return located.select(*_typed(strict=False))


def quarantined_incidents(df: DataFrame) -> DataFrame:
    """The raw rows that ``on_error='quarantine'`` leaves out."""
    return df.where(has_coordinates() & _lossy())
