"""CSV scan with a declared schema and pandas-style missing-value tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from tidemark.functions.exprs import NA_TOKENS, nan_to_null, null_tokens


def csv_scan(spark: SparkSession, path: str, schema: str | StructType,
             na_tokens=NA_TOKENS, multi_line: bool = True) -> DataFrame:
    """Read CSV text with ``schema`` (never inferred).

    Quoted fields follow the common rules: a doubled quote is a quote, and
    commas and line breaks inside quotes are text.  Line breaks in quotes need
    whole files per task; ``multi_line=False`` lets Spark split large files of
    text that has none.

    Spark nulls only empty fields, so the text columns are read as strings
    first, the pandas tokens (``NA``, ``null``, ``None``, ``nan`` ...) are
    nulled, and only then are values cast to the declared types with
    ``try_cast`` (dirty values -> null instead of failing the job).  Numeric
    NaN becomes null, as pandas has one missing value.
    """
    target = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    as_text = StructType([f.__class__(f.name, StringType(), True) for f in target.fields])
    raw = spark.read.schema(as_text).option("header", True).option("mode", "PERMISSIVE").option(
        "escape", '"').option("multiLine", multi_line).csv(path)
    cols = []
    for f in target.fields:
        c = null_tokens(F.col(f"`{f.name}`"), na_tokens)
        if not isinstance(f.dataType, StringType):
            c = c.try_cast(f.dataType)
            if f.dataType.typeName() in ("double", "float"):
                c = nan_to_null(c)
        cols.append(c.alias(f.name))
    return raw.select(*cols)


def write_csv(df: DataFrame, path: str, na_token: str = "") -> None:
    """Write CSV with a header; nulls written as ``na_token``."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').option("nullValue", na_token).csv(path)
