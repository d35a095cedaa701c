"""Table schemas and the checks that need no job, only the schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tickwell.fixed_values import CONCEPTS

METRICS = list(CONCEPTS)
RATIOS = ["current_ratio", "profit_margin"]
OHLCV = ["open", "high", "low", "close", "volume"]

COMPANY_DIRECTORY = "map<string, struct<cik_str: string, ticker: string, title: string>>"
COMPANY_FACTS = (
    "struct<facts: map<string, map<string, struct<"
    "units: map<string, array<struct<end: string, val: string>>>>>>>"
)
SUBMISSIONS = "struct<name: string>"
LANDED_FILE = "file string, doc string"
METRIC_RECORD = ", ".join(f"{m} double" for m in METRICS)
REPORT_RECORD = (
    "cik string, company_name string, filing_type string, filing_date timestamp, "
    f"fiscal_year int, fiscal_period string, {METRIC_RECORD}"
)
STORED_REPORT = (
    f"{REPORT_RECORD}, current_ratio double, profit_margin double, "
    "text_content string, embeddings array<float>, created_at timestamp, id bigint"
)
DOCUMENT = (
    "id bigint, content string, embedding array<float>, "
    "metadata map<string,string>, created_at timestamp"
)


def numeric_columns(df: DataFrame, but: tuple[str, ...] = ()) -> list[str]:
    """All numeric columns except the named ones."""
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.NumericType) and f.name not in but
    ]


def need_columns(df: DataFrame, *names: str) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"columns not found: {missing}")
