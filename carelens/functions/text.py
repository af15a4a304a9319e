"""Tolerant text-to-value conversions for export fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DataType, StringType, StructType

# Characters stripped from the ends of a field: ASCII blanks and separators, then Unicode spaces.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(BLANKS))


def blank_to_null(text: Column) -> Column:
    return F.nullif(strip(text), F.lit(""))


def parse_number(text: Column, kind: str) -> Column:
    """A number that may carry thousands commas; blank is NULL, malformed raises under ANSI."""
    return F.nullif(strip(F.replace(text, F.lit(","), F.lit(""))), F.lit("")).cast(kind)


def parse_int(text: Column) -> Column:
    return parse_number(text, "int")


def parse_float(text: Column) -> Column:
    return parse_number(text, "double")


def typed(text: Column, to: DataType) -> Column:
    """One text field as its declared type; the empty string is NULL."""
    value = F.nullif(text, F.lit(""))
    if isinstance(to, BooleanType):
        return F.lower(value) == "true"
    return value if isinstance(to, StringType) else value.cast(to)


def typed_projection(rows: DataFrame, schema: StructType) -> DataFrame:
    """All columns of ``schema`` in one typed projection over text columns."""
    return rows.select(*(typed(F.col(f.name), f.dataType).alias(f.name) for f in schema))
