"""From filing documents to the report table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tickwell.fixed_values import (
    COMPANY_LIMIT,
    FILING_TYPE,
    FISCAL_PERIOD,
    MADE_COMPANY_NAME,
    METRIC_BOUND,
)
from tickwell.functions.numbers import clean_numbers
from tickwell.functions.text import fill, report_text
from tickwell.operators.quality import accepted, validate
from tickwell.operators.vectors import hash_vector
from tickwell.schema import METRICS
from tickwell.sources import filings
from tickwell.sources.tables import append_reports


def named(facts: DataFrame, submissions: DataFrame) -> DataFrame:
    """Add company names: from the submissions, or made from the cik where
    there is no submission."""
    names = submissions.select(
        F.col("cik").alias("_cik"), F.col("company_name").alias("_name")
    )
    joined = facts.join(names, F.col("cik") == F.col("_cik"), "left")
    made = fill(MADE_COMPANY_NAME, cik=F.col("cik"))
    name = F.when(F.col("_cik").isNull(), made).otherwise(F.col("_name"))
    return joined.withColumn("company_name", name).drop("_cik", "_name")


def report_records(facts: DataFrame, submissions: DataFrame, as_of: str) -> DataFrame:
    """Report records of all companies that have facts. ``as_of`` stands for
    the time of the load; tables that carry a fiscal year keep it."""
    when = F.lit(as_of).cast("timestamp")
    year = F.col("fiscal_year") if "fiscal_year" in facts.columns else F.year(when)
    return named(facts.where("has_facts"), submissions).select(
        "cik",
        "company_name",
        F.lit(FILING_TYPE).alias("filing_type"),
        when.alias("filing_date"),
        year.cast("int").alias("fiscal_year"),
        F.lit(FISCAL_PERIOD).alias("fiscal_period"),
        *METRICS,
    )


def with_ratios(reports: DataFrame) -> DataFrame:
    cleaned = clean_numbers(reports)
    return cleaned.withColumns(
        {
            "current_ratio": F.try_divide("total_assets", "total_liabilities"),
            "profit_margin": F.try_divide("net_income", "revenue"),
        }
    )


def finished_reports(
    facts: DataFrame, submissions: DataFrame, as_of: str, bound: float = METRIC_BOUND
) -> DataFrame:
    """Valid reports with ratios and text, ready for the report table."""
    records = accepted(validate(report_records(facts, submissions, as_of), bound))
    return with_ratios(records).withColumn("text_content", report_text())


def stored_reports(reports: DataFrame, as_of: str) -> DataFrame:
    """Adds what the report table keeps besides the id: vector of the text and
    time of the load."""
    return reports.withColumns(
        {
            "embeddings": hash_vector(F.col("text_content")).cast("array<float>"),
            "created_at": F.lit(as_of).cast("timestamp"),
        }
    )


def load_landed(
    spark: SparkSession,
    directory: str,
    facts: str,
    submissions: str,
    table: str,
    as_of: str,
    companies: int | None = COMPANY_LIMIT,
    bundled: bool = False,
) -> Observation:
    """Landed files to the report table: the first companies of the directory,
    or all for None, their latest facts and names, checked, with ratios, text
    and vector. ``bundled`` files were landed by ``filings.bundle``."""
    listed = filings.company_directory(filings.json_files(spark, directory, bundled=bundled))
    wanted = filings.first_companies(listed, companies) if companies else listed
    wanted = wanted.select("cik")
    parsed = filings.parse_facts(filings.company_files(spark, facts, bundled=bundled))
    parsed = parsed.join(wanted, "cik", "left_semi")
    names = filings.parse_submissions(filings.company_files(spark, submissions, bundled=bundled))
    finished = finished_reports(parsed, names, as_of)
    return append_reports(stored_reports(finished, as_of), table)
