"""Tables in the shared folder, and columns under names of our own."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tickwell.session import shared_folder


def fresh_path(spark: SparkSession) -> str:
    """A folder that no other job uses, below the one named in spark.checkpoint.dir."""
    return f"{shared_folder(spark)}/llm-{uuid.uuid4().hex}"


def written(df: DataFrame, path: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it again, which cuts its lineage."""
    path = path or fresh_path(df.sparkSession)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unused(name: str, df: DataFrame) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns that are needed; a null text counts as empty."""
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )


def by_batch(
    df: DataFrame,
    schema: str,
    work: Callable[[Iterator[dict]], Iterator[dict]],
    arrays: bool = False,
) -> DataFrame:
    """Run ``work`` on each partition; it gets and yields dicts of columns.

    Texts arrive in pieces of at most a few megabytes, so that a task never
    holds more Python strings than those of one piece; with ``arrays`` they
    stay Arrow arrays.
    """
    fields = StructType.fromDDL(schema)
    arrow = to_arrow_schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for out in work(small_pieces(batches, arrays)):
            yield pa.RecordBatch.from_arrays(
                [_column(out[f.name], f.type) for f in arrow], schema=arrow
            )

    return df.mapInArrow(run, fields)


def filtered(
    df: DataFrame,
    text_col: str,
    keep: Callable[[list[str]], Iterable[bool]],
    done: Callable[[], None] = lambda: None,
) -> DataFrame:
    """The rows whose text ``keep`` accepts, with all their columns; null texts are passed as empty.
    ``done`` is called at the end of each task."""
    schema = df.schema
    at = df.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            step = max(1, int(batch.num_rows * PIECE_BYTES / max(batch.nbytes, 1)))
            for start in range(0, batch.num_rows, step):
                piece = batch.slice(start, step)
                texts = ["" if t is None else t for t in piece.column(at).to_pylist()]
                yield piece.filter(pa.array(list(keep(texts)), type=pa.bool_()))
        done()

    return df.mapInArrow(run, schema)


def _column(values, kind: pa.DataType) -> pa.Array:
    return values.cast(kind) if isinstance(values, pa.Array) else pa.array(values, type=kind)


PIECE_BYTES = 4 << 20


def small_pieces(batches: Iterator[pa.RecordBatch], arrays: bool = False) -> Iterator[dict]:
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        step = max(1, int(n * PIECE_BYTES / max(batch.nbytes, 1)))
        for at in range(0, n, step):
            piece = batch.slice(at, step)
            yield {
                f.name: column.to_pylist() if _listed(f.type) and not arrays else column
                for f, column in zip(piece.schema, piece.columns)
            }


def _listed(kind: pa.DataType) -> bool:
    return pa.types.is_string(kind) or pa.types.is_large_string(kind)
