"""Types of text columns found out from their values.

Every value is of a kind, and a column's type follows from the set of its values' kinds, a few bits. Sets of
parts of a table are merged by a bitwise or, so one aggregation finds all columns' types and the sets of
a stored table can be merged with those of new rows. More rows can only widen a type: null, then bigint,
then double, then text, or null, then date, then text. A value that a type could not give back
makes the column text: numbers with leading zeros, integers beyond 18 digits, dates with a time, and integers of
more than 15 digits beside fractions.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .reports import DATE_PATTERNS, SHORT_DATE_PATTERNS, apply_schema, date_shape, parse_by_shape

#: Kinds of values as bits; a null has none.
INTEGER, LONG_INTEGER, FRACTION, DATE, TEXT = 1, 2, 4, 8, 16

_INTEGER = "^(0|-?[1-9][0-9]{0,14})$"
_LONG_INTEGER = "^-?[1-9][0-9]{15,17}$"
_FRACTION = r"^-?(0|[1-9][0-9]{0,14})(\.[0-9]+([eE][+-]?[0-9]{1,2})?|[eE][+-]?[0-9]{1,2})$"
_DAYS = [p for p in (*DATE_PATTERNS, *SHORT_DATE_PATTERNS) if "H" not in p]


def value_kind(text: Column, shape: Column) -> Column:
    """The kind of a text with its ``date_shape``, 0 for NULL."""
    kind = (F.when(text.isNull(), 0).when(text.rlike(_INTEGER), INTEGER).when(text.rlike(_LONG_INTEGER), LONG_INTEGER)
            .when(text.rlike(_FRACTION), FRACTION).when(parse_by_shape(text, _DAYS, shape).isNotNull(), DATE).otherwise(TEXT))
    return kind.cast("int")


def kinds(df: DataFrame) -> dict[str, int]:
    """Per text column the set of its values' kinds; one pass, one row a column to the driver."""
    texts = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    if not texts:
        return {}
    values = df.select(F.posexplode(F.array(*[F.col(f"`{c}`") for c in texts])).alias("at", "text"))
    shaped = values.withColumn("shape", date_shape(F.col("text")))
    found = shaped.groupBy("at").agg(F.bit_or(value_kind(F.col("text"), F.col("shape"))).alias("kinds")).collect()
    return dict.fromkeys(texts, 0) | {texts[r["at"]]: r["kinds"] for r in found}


def merged(a: Mapping[str, int], b: Mapping[str, int]) -> dict[str, int]:
    """Sets of a table that has the rows of both; a column that one lacks is null there."""
    return {c: a.get(c, 0) | b.get(c, 0) for c in [*a, *(c for c in b if c not in a)]}


def kind_type(found: int) -> T.DataType:
    """The least type that takes all values; text if there are none."""
    if found in (0, TEXT) or found & TEXT:
        return T.StringType()
    if found == DATE:
        return T.DateType()
    if found & ~(INTEGER | LONG_INTEGER) == 0:
        return T.LongType()
    return T.DoubleType() if found & ~(INTEGER | FRACTION) == 0 else T.StringType()


def schema_of(found: Mapping[str, int]) -> T.StructType:
    return T.StructType([T.StructField(c, kind_type(k)) for c, k in found.items()])


def typed(df: DataFrame, found: Mapping[str, int] | None = None) -> DataFrame:
    """The text columns with the types of their values, or of the given sets."""
    return apply_schema(df, schema_of(kinds(df) if found is None else found))
