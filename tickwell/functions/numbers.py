"""Column functions on identifiers and metric values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CIK_DIGITS = 10


def full_cik(cik: Column) -> Column:
    """Zero-filled to ten digits; longer ones stay whole."""
    cik = cik.cast("string")
    return F.when(F.length(cik) < CIK_DIGITS, F.lpad(cik, CIK_DIGITS, "0")).otherwise(cik)


def short_cik(cik: Column) -> Column:
    return F.ltrim(cik.cast("string"), F.lit("0"))


def plain_accession(accession: Column) -> Column:
    return F.coalesce(F.replace(accession, F.lit("-"), F.lit("")), F.lit(""))


def finite(value: Column) -> Column:
    """Null instead of NaN and the infinities."""
    return F.when(~F.isnan(value) & (F.abs(value) != float("inf")), value)


def clean_numbers(df: DataFrame) -> DataFrame:
    floats = [
        f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))
    ]
    return df.withColumns({c: finite(F.col(c)) for c in floats}) if floats else df


def exact_mean(value: Column, digits: int) -> Column:
    """Mean of numbers of ``digits`` decimal digits, rounded half up to four digits more."""
    return F.avg(value.cast(f"decimal({18 + digits},{digits})")).cast("double")
