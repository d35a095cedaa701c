"""Tables at rest: reports, documents, CSV uploads and training exports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tickwell import schema
from tickwell.fixed_values import TRAINING_TYPE
from tickwell.schema import METRICS, RATIOS


def counted(df: DataFrame, name: str = "rows") -> tuple[DataFrame, Observation]:
    """Count the rows that pass, without a pass of its own; ask the observation
    after the action."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def spread(df: DataFrame, key: str) -> DataFrame:
    """Rows of a scan with fewer parts than the cluster has cores, spread by a
    unique key, for work that takes long per row. Large scans stay as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores, key)


def append_reports(reports: DataFrame, path: str) -> Observation:
    """Append to the report table; the commit of the job makes it all or nothing.
    Reports without an id get one that no stored report has.

    Rows are gathered by fiscal year into files of an even size: years that
    are too large for one task are cut up, small ones put together.
    """
    reports = with_ids(reports, reserve(reports.sparkSession, path))
    reports, seen = counted(reports, "loaded")
    reports.hint("rebalance", "fiscal_year").write.mode("append").partitionBy(
        "fiscal_year"
    ).parquet(path)
    return seen


def read_reports(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schema.STORED_REPORT).parquet(path)


def read_report_csv(spark: SparkSession, *paths: str, columns: str = schema.REPORT_RECORD):
    """Report files with a header line, several at once; read strictly."""
    return (
        spark.read.schema(columns)
        .option("header", True)
        .option("mode", "FAILFAST")
        .option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
        .csv(list(paths))
    )


def write_report_csv(reports: DataFrame, path: str) -> None:
    (
        reports.write.mode("errorifexists")
        .option("header", True)
        .option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
        .csv(path)
    )


def ragged_union(tables: list[DataFrame]) -> DataFrame:
    """All rows under the union of all columns, null where a table lacks one."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def training_examples(reports: DataFrame) -> DataFrame:
    metrics = F.struct(*METRICS, *RATIOS)
    output = F.struct(F.lit(TRAINING_TYPE).alias("type"), metrics.alias("metrics"))
    return reports.select(F.col("text_content").alias("input"), output.alias("output"))


def export_training(reports: DataFrame, path: str) -> Observation:
    """One JSON object per line, spread over part files, nulls written out."""
    examples, seen = counted(training_examples(reports), "exported")
    examples.write.mode("errorifexists").option("ignoreNullFields", False).json(path)
    return seen


#: Bits of a new id: the number of the append, of the task that writes the row, and of the row in it.
APPEND_BITS, TASK_BITS, ROW_BITS = 19, 20, 24
LEDGER = "_ids"


def reserve(spark: SparkSession, path: str) -> int:
    """A number for an append to the table at ``path`` that no other append gets.

    Numbers are empty files in a folder of the table; a file is created only
    if it is not there, so of two appends that try the same number one goes on
    to the next. Nothing of the table is read. A number whose append fails is
    lost, not used again.
    """
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path, LEDGER)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(folder)
    taken = [int(f.getPath().getName()) for f in files.listStatus(folder)]
    number = max(taken, default=0) + 1
    while not files.createNewFile(jvm.org.apache.hadoop.fs.Path(folder, str(number))):
        number += 1
    if number >= 1 << APPEND_BITS:
        raise ValueError(f"no more than {(1 << APPEND_BITS) - 1} appends to one table")
    return number


def with_ids(rows: DataFrame, append: int) -> DataFrame:
    """Rows without an id get one of their own, copies included.

    A new id is made of the number of the append, the task and the row, so no
    two are equal and none is less than 2 ** 44; ids that are given have to be.
    """
    least = 1 << (TASK_BITS + ROW_BITS)
    # Spark numbers rows by the partition and, in 33 bits, by the row in it.
    number = F.monotonically_increasing_id()
    task, row = F.shiftright(number, 33), number.bitwiseAND(F.lit((1 << 33) - 1))
    fits = (task < 1 << TASK_BITS) & (row < 1 << ROW_BITS)
    many = F.raise_error(F.lit(f"a task may write {1 << ROW_BITS} rows without an id: deal them out further"))
    own = F.when(fits, F.lit(append * least) + F.shiftleft(task, ROW_BITS) + row).otherwise(many)
    if "id" not in rows.columns:
        return rows.withColumn("id", own)
    given = F.col("id").cast("bigint")
    high = F.raise_error(F.lit(f"ids from {least} on are given by the table"))
    return rows.withColumn("id", F.when(given.isNull(), own).when(given < least, given).otherwise(high))


def append_documents(docs: DataFrame, path: str, as_of: str, size: int | None = None):
    """Append (id, content, embedding, metadata); every row without an id gets
    an id that no stored row has, missing metadata is empty. ``size`` checks
    the vectors."""
    vector = F.col("embedding").cast("array<float>")
    if size:
        wrong = F.raise_error(F.lit(f"a vector does not have {size} values"))
        vector = F.when(F.size("embedding") == size, vector).otherwise(wrong)
    empty = F.create_map().cast("map<string,string>")
    docs = with_ids(docs, reserve(docs.sparkSession, path))
    docs, seen = counted(docs, "added")
    docs.select(
        "id",
        "content",
        vector.alias("embedding"),
        (F.coalesce(F.col("metadata"), empty) if "metadata" in docs.columns else empty).alias(
            "metadata"
        ),
        F.lit(as_of).cast("timestamp").alias("created_at"),
    ).write.mode("append").parquet(path)
    return seen


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schema.DOCUMENT).parquet(path)


def write_cells(packed: DataFrame, path: str) -> None:
    """Packed blocks by cell, so that a search reads only the cells it looks into."""
    packed.write.mode("errorifexists").partitionBy("cell").parquet(path)
