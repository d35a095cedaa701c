"""Metric validation, imputation and scaling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwell.fixed_values import METRIC_BOUND
from tickwell.functions.numbers import clean_numbers
from tickwell.schema import METRICS


def violations(bound: float = METRIC_BOUND, metrics: list[str] = METRICS) -> Column:
    """Names of the metrics outside [-bound, bound]; nulls are allowed."""
    return F.array_compact(
        F.array(*[F.when(F.abs(F.col(m)) > bound, F.lit(m)) for m in metrics])
    )


def metrics_only(df: DataFrame) -> DataFrame:
    return df.select(*METRICS)


def validate(df: DataFrame, bound: float = METRIC_BOUND) -> DataFrame:
    """Adds ``violations`` and ``valid``; infinities and NaN become null first."""
    checked = clean_numbers(df).withColumn("violations", violations(bound))
    return checked.withColumn("valid", F.size("violations") == 0)


def accepted(validated: DataFrame) -> DataFrame:
    return validated.where("valid").drop("valid", "violations")


def rejected(validated: DataFrame) -> DataFrame:
    return validated.where("not valid").drop("valid")


def impute_mean(df: DataFrame, columns: list[str]) -> DataFrame:
    """Nulls replaced by the mean of the column over the whole table."""
    means = df.select(F.struct(*[F.avg(c).alias(c) for c in columns])).scalar()
    return df.withColumn("_m", means).withColumns(
        {c: F.coalesce(F.col(c), F.col(f"_m.{c}")) for c in columns}
    ).drop("_m")


def standard_scale(df: DataFrame, columns: list[str]) -> DataFrame:
    """(value - mean) / population deviation; 0 where the column is constant."""
    parts = [F.struct(F.avg(c).alias("mean"), F.stddev_pop(c).alias("std")).alias(c) for c in columns]
    moments = df.select(F.struct(*parts)).scalar()

    def scaled(c: str) -> Column:
        shift = F.col(c) - F.col(f"_m.{c}.mean")
        return F.when(F.col(f"_m.{c}.std") == 0, shift * 0).otherwise(
            shift / F.col(f"_m.{c}.std")
        )

    return df.withColumn("_m", moments).withColumns({c: scaled(c) for c in columns}).drop("_m")
