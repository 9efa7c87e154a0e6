"""Reading single fields out of a preserved message body."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

STRICT_JSON = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}


def json_text(body: Column, key: str) -> Column:
    """The string at ``key``; empty when it is missing, not a string, or the body is no JSON."""
    shape = T.StructType([T.StructField(key, T.VariantType())])
    value = F.from_json(body, shape, STRICT_JSON).getField(key)
    is_text = F.schema_of_variant(value) == "STRING"
    return F.coalesce(F.when(is_text, F.try_variant_get(value, "$", "string")), F.lit(""))


def json_string(df: DataFrame, column: str, key: str, name: str | None = None) -> DataFrame:
    return df.withColumn(name or key, json_text(F.col(column), key))
