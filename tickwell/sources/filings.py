"""Company directory, company facts and submissions as landed JSON files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwell import schema
from tickwell.fixed_values import COMPANY_LIMIT, CONCEPTS, TAXONOMY, UNKNOWN_COMPANY
from tickwell.functions.numbers import full_cik


def bundle(files: DataFrame, path: str) -> str:
    """Land JSON files, rows (file, doc) of name and text, many to a bundle:
    a file and a folder for each of them take longer than all other work."""
    files.select(F.col("file").cast("string"), "doc").write.mode("errorifexists").parquet(path)
    return path


def json_files(spark: SparkSession, *paths: str, bundled: bool = False) -> DataFrame:
    """One row (file, doc) per JSON file, or per file in the bundles of ``bundle``."""
    if bundled:
        return spark.read.schema(schema.LANDED_FILE).parquet(*paths)
    return spark.read.text(list(paths), wholetext=True).select(
        F.col("_metadata.file_path").alias("file"), F.col("value").alias("doc")
    )


def company_files(spark: SparkSession, *paths: str, bundled: bool = False) -> DataFrame:
    """JSON files named after their company, or folders so named with one file
    each, as Spark writes them, or bundles of such files: rows (cik, doc)."""
    number = F.regexp_extract("file", r"CIK(\d+)\.json(?:/[^/]+)?$", 1)
    return json_files(spark, *paths, bundled=bundled).select(full_cik(number).alias("cik"), "doc")


def company_directory(docs: DataFrame, file: str = "file", doc: str = "doc") -> DataFrame:
    """Companies of directory documents; ``file`` and ``pos`` give their order."""
    entries = F.map_entries(F.from_json(F.col(doc), schema.COMPANY_DIRECTORY))
    return docs.select(file, F.posexplode(entries).alias("pos", "entry")).select(
        file,
        "pos",
        full_cik(F.col("entry.value.cik_str")).alias("cik"),
        F.col("entry.value.ticker").alias("ticker"),
        F.col("entry.value.title").alias("title"),
    )


def first_companies(directory: DataFrame, n: int = COMPANY_LIMIT, file: str = "file") -> DataFrame:
    """The first ``n`` companies in file order."""
    return directory.orderBy(file, "pos").limit(n)


def latest_fact(facts: Column, concept: str) -> Column:
    """Value of the entry with the greatest ``end`` in the first unit listed.

    Ends compare as text, a missing one as the empty text; of equal ends the
    first counts. A value that is no number gives null; older entries are not
    tried instead.
    """
    entries = F.get(F.map_values(facts[TAXONOMY][concept]["units"]), F.lit(0))

    def better(best: Column, entry: Column) -> Column:
        end = F.coalesce(entry["end"], F.lit(""))
        candidate = F.struct(end.alias("end"), entry["val"].alias("val"))
        return F.when(best["end"].isNull() | (end > best["end"]), candidate).otherwise(best)

    none = F.lit(None).cast("struct<end: string, val: string>")
    return F.aggregate(entries, none, better)["val"].try_cast("double")


def parse_facts(docs: DataFrame, doc: str = "doc") -> DataFrame:
    """Adds the five metrics; a document that is missing gives ``has_facts`` false."""
    parsed = docs.withColumn("_facts", F.from_json(F.col(doc), schema.COMPANY_FACTS)["facts"])
    return (
        parsed.withColumns({m: latest_fact(F.col("_facts"), c) for m, c in CONCEPTS.items()})
        .withColumn("has_facts", F.col(doc).isNotNull())
        .drop("_facts")
    )


def latest_fact_rows(entries: DataFrame) -> DataFrame:
    """The same rule for facts held as rows (cik, concept, unit_pos, pos, end, val)."""
    key = F.struct(
        -F.col("unit_pos"), F.coalesce(F.col("end"), F.lit("")), -F.col("pos")
    )
    return entries.groupBy("cik", "concept").agg(
        F.max_by("val", key).try_cast("double").alias("value")
    )


def parse_submissions(docs: DataFrame, doc: str = "doc") -> DataFrame:
    name = F.from_json(F.col(doc), schema.SUBMISSIONS)["name"]
    return docs.withColumn("company_name", F.coalesce(name, F.lit(UNKNOWN_COMPANY)))
