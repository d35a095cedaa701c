"""Text vectors by feature hashing and exact search by cosine similarity."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickwell.fixed_values import INDEX_LISTS, SIMILARITY_THRESHOLD, TOP_K, VECTOR_SIZE
from tickwell.functions.text import clean_query, words
from tickwell.session import keep, stored

# Similarities that agree to this many digits count as equal, and the id
# decides: the last bits of a product depend on the machine.
RANK_DIGITS = 9
#: Vectors in a packed row of documents and of queries.
BLOCK = 1024
QUERY_BATCH = 1024
#: Texts whose words are counted at a time.
COUNTED = 256
#: Shares of the documents in which hits are merged first.
MERGE_SHARES = 32
#: Packed queries that may be sent to all tasks, and the side of a cell of the grid otherwise.
SENT_BYTES = 8 << 20
SIDE_BYTES = 128 << 20
BOUND_SLACK = 1e-9


def token_buckets(text: Column, size: int = VECTOR_SIZE) -> Column:
    """Bucket numbers of all words of a text, repeated as the words are."""
    number = lambda w: F.conv(F.substring(F.md5(w), 1, 8), 16, 10).cast("bigint")
    return F.transform(words(clean_query(text)), lambda w: F.pmod(number(w), F.lit(size)).cast("int"))


def hash_vector(text: Column, size: int = VECTOR_SIZE) -> Column:
    """Unit vector of word counts per bucket; all zeros for a text without words.

    Words are cut and hashed by Spark; only the counting into a dense vector,
    which has no built-in function, happens in Arrow batches. Nothing moves
    between tasks.
    """

    @F.arrow_udf("array<double>")
    def counted(buckets: pa.Array) -> pa.Array:
        import numpy as np
        import pyarrow as pa

        rows = len(buckets)
        unit = np.empty((rows, size))
        # Only the vectors themselves are as many as the batch has rows.
        for a in range(0, rows, COUNTED):
            numbers = buckets.slice(a, COUNTED).fill_null([])
            n = len(numbers)
            sizes = np.diff(np.asarray(numbers.offsets))
            place = np.repeat(np.arange(n) * size, sizes) + np.asarray(numbers.flatten())
            counts = np.bincount(place, minlength=n * size).astype(float).reshape(n, size)
            lengths = np.sqrt((counts * counts).sum(axis=1, keepdims=True))
            np.divide(counts, np.where(lengths > 0, lengths, 1.0), out=unit[a : a + n])
        ends = np.arange(0, rows * size + 1, size, dtype=np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(unit.ravel()))

    return counted(token_buckets(F.coalesce(text, F.lit("")), size))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity of two vector columns; null for a zero vector, for
    vectors of different sizes and where a value is missing."""

    @F.arrow_udf("double")
    def measured(x: pa.Array, y: pa.Array) -> pa.Array:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        sizes = [pc.fill_null(pc.list_value_length(v), -1).to_numpy() for v in (x, y)]
        usable = (sizes[0] == sizes[1]) & (sizes[0] > 0)
        out = np.full(len(x), np.nan)
        for size in np.unique(sizes[0][usable]):
            rows = np.flatnonzero(usable & (sizes[0] == size))
            left, right = (
                v.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).reshape(len(rows), size)
                for v in (x, y)
            )
            product = (left * right).sum(axis=1)
            lengths = np.sqrt((left * left).sum(axis=1)) * np.sqrt((right * right).sum(axis=1))
            with np.errstate(divide="ignore", invalid="ignore"):
                out[rows] = np.where(lengths > 0, product / lengths, np.nan)
        return pa.array(out, mask=np.isnan(out))

    return measured(a.cast("array<double>"), b.cast("array<double>"))


def with_vectors(docs: DataFrame, vectors: DataFrame, id: str, vector_id: str) -> DataFrame:
    """Documents with their vectors, matched by key."""
    return docs.join(vectors, docs[id] == vectors[vector_id])


HITS = "query_id long, form int, id long, similarity double, limit int"
PACKED = "key long, n int, ids binary, forms binary, limits binary, vectors binary"
BETWEEN = "low double, high double"


def _packed(rows: DataFrame, size: int) -> DataFrame:
    """Rows ``(key, id, form, limit, vector)`` as blocks of at most ``size`` of one key.

    Rows must be ordered by key within their partition. A block is one row, so
    joining blocks pairs up as many vectors at once, and a task holds few of
    them. Rows with an ``angle`` make blocks that say between which angles they lie.
    """
    angled = "angle" in rows.columns

    def pack(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            batch = batch.filter(batch.column("vector").is_valid())
            if not batch.num_rows:
                continue
            keys = batch.column("key").to_numpy()
            starts = np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]])
            cuts = [c for a, b in zip(starts, starts[1:]) for c in range(a, b, size)] + [len(keys)]
            # One block at a time: a batch of them is as large as its vectors.
            for a, b in zip(cuts, cuts[1:]):
                part = batch.slice(a, b - a)
                vectors = np.asarray(part.column("vector").flatten(), dtype="<f8")
                numbers = [part.column(c).to_numpy() for c in ("id", "form", "limit")]
                span = part.column("angle").to_numpy() if angled else None
                between = (float(span.min()), float(span.max())) if angled else ()
                row = (int(keys[a]), int(b - a), *(x.tobytes() for x in (*numbers, vectors)), *between)
                yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(row, schema)], schema=schema)

    schema = pa.schema(
        [("key", pa.int64()), ("n", pa.int32())]
        + [(c, pa.binary()) for c in ("ids", "forms", "limits", "vectors")]
        + [(c, pa.float64()) for c in ("low", "high") if angled]
    )
    return rows.mapInArrow(pack, f"{PACKED}, {BETWEEN}" if angled else PACKED)


def _best(query_id, form, similarity, doc_id, limit):
    """Of each query the first ``limit`` by similarity, then id."""
    order = np.lexsort((doc_id, -np.round(similarity, RANK_DIGITS), form, query_id))
    columns = [x[order] for x in (query_id, form, similarity, doc_id, limit)]
    q, f = columns[:2]
    new = np.ones(len(q), dtype=bool)
    new[1:] = (q[1:] != q[:-1]) | (f[1:] != f[:-1])
    rank = np.arange(len(q)) - np.maximum.accumulate(np.where(new, np.arange(len(q)), 0))
    near = rank < columns[4]
    return [c[near] for c in columns]


HELD_HITS = 1 << 20


class _Hits:
    """The best hits of each query over the pairs of blocks a task has seen."""

    def __init__(self, threshold: float):
        self.threshold, self.waiting = threshold, 0
        self.found = [self.none()]

    @staticmethod
    def none() -> list[np.ndarray]:
        return [np.empty(0, t) for t in (np.int64, np.int32, float, np.int64, np.int32)]

    def add(self, docs: dict, queries: dict) -> None:
        """Meet a block of documents with a block of queries."""
        left = np.frombuffer(docs["vectors"], "<f8").reshape(docs["n"], -1)
        right = np.frombuffer(queries["vectors"], "<f8").reshape(queries["n"], -1)
        ids = np.frombuffer(docs["ids"], "<i8")
        lengths = [np.sqrt((x * x).sum(axis=1)) for x in (right, left)]
        with np.errstate(divide="ignore", invalid="ignore"):
            sims = (right @ left.T) / np.outer(*lengths)
        # NaN, from a zero vector, passes no comparison.
        q, d = np.nonzero(sims > self.threshold)
        asked = [np.frombuffer(queries[c], t) for c, t in (("ids", "<i8"), ("forms", "<i4"), ("limits", "<i4"))]
        self.found.append(_best(asked[0][q], asked[1][q], sims[q, d], ids[d], asked[2][q]))
        self.waiting += len(self.found[-1][0])
        if self.waiting > HELD_HITS:
            self.found, self.waiting = [self.merged()], 0

    def merged(self) -> list[np.ndarray]:
        return _best(*(np.concatenate(c) for c in zip(*self.found)))

    def full(self) -> bool:
        """Whether even the best hits are too many to hold."""
        return not self.waiting and len(self.found[0][0]) > HELD_HITS

    def rows(self) -> pa.RecordBatch:
        q, f, s, d, limit = self.merged()
        self.found, self.waiting = [self.none()], 0
        return pa.RecordBatch.from_arrays(
            [pa.array(q), pa.array(f), pa.array(d), pa.array(s), pa.array(limit)],
            names=["query_id", "form", "id", "similarity", "limit"],
        )


def _scored(table: DataFrame, queries: pa.Table, threshold: float) -> DataFrame:
    """Hits of documents with blocks of queries that every task gets; each task
    keeps the best of each query over all its documents.

    Documents are taken from their batch a block at a time. They are not
    packed before: joined to packed queries, a batch would hold the vectors of
    all documents of a task.
    """

    def score(batches: Iterator) -> Iterator:
        import numpy as np

        hits, asked = _Hits(threshold), queries.to_pylist()
        for batch in batches:
            if batch.column("vector").null_count:
                batch = batch.filter(batch.column("vector").is_valid())
            for a in range(0, batch.num_rows, BLOCK):
                part = batch.slice(a, BLOCK)
                vectors = np.asarray(part.column("vector").flatten(), dtype="<f8")
                docs = {"n": part.num_rows, "ids": part.column("id").to_numpy(), "vectors": vectors}
                for block in asked:
                    hits.add(docs, block)
                if hits.full():
                    yield hits.rows()
        yield hits.rows()

    return table.select("id", "vector").mapInArrow(score, HITS)


def _gridded(chunks: DataFrame, blocks: DataFrame, threshold: float) -> DataFrame:
    """Hits where blocks of documents and of queries of the same key meet in one task."""

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        hits, done = _Hits(threshold), []
        asked = right.to_pylist()
        for batch in left.to_batches(max_chunksize=1):
            for docs in batch.to_pylist():
                for queries in asked:
                    hits.add(docs, queries)
                if hits.full():
                    done.append(hits.rows())
        return pa.Table.from_batches([*done, hits.rows()])

    return chunks.groupBy("key").cogroup(blocks.groupBy("of_key")).applyInArrow(score, HITS)


def _wanted(queries: DataFrame, k: int, query_id: str, query_vector: str) -> DataFrame:
    versions = "form" in queries.columns
    asked = F.coalesce(F.col("top_k"), F.lit(0)) if "top_k" in queries.columns else F.lit(0)
    return queries.select(
        F.col(query_id).cast("bigint").alias("id"),
        (F.col("form") if versions else F.lit(0)).cast("int").alias("form"),
        F.when(asked > 0, asked).otherwise(k).cast("int").alias("limit"),
        F.col(query_vector).cast("array<double>").alias("vector"),
    )


def _documents(docs: DataFrame, id: str, vector: str, *columns: Column) -> DataFrame:
    return docs.select(
        *columns,
        F.col(id).cast("bigint").alias("id"),
        F.lit(0).alias("form"),
        F.lit(0).alias("limit"),
        F.col(vector).cast("array<double>").alias("vector"),
    )


def _ranked(hits: DataFrame, *others: str) -> DataFrame:
    """The first ``limit`` hits of each query, in two steps: first among the hits
    of a share of the documents, so that no task gets the hits of all tasks."""
    order = [F.desc(F.round("similarity", RANK_DIGITS)), F.col("id")]
    share = F.pmod(F.xxhash64("id"), F.lit(MERGE_SHARES))
    first = Window.partitionBy("query_id", "form", "_share").orderBy(*order)
    last = Window.partitionBy("query_id", "form").orderBy(*order)
    rows = hits.withColumn("_share", share).withColumn("rank", F.row_number().over(first))
    rows = rows.where(F.col("rank") <= F.col("limit")).drop("_share", "rank")
    return rows.withColumn("rank", F.row_number().over(last)).where(F.col("rank") <= F.col("limit"))


def _result(ranked: DataFrame, queries: DataFrame) -> DataFrame:
    ranked = ranked.drop("limit")
    return ranked if "form" in queries.columns else ranked.drop("form")


def similar(
    docs: DataFrame,
    queries: DataFrame,
    k: int | None = TOP_K,
    threshold: float = SIMILARITY_THRESHOLD,
    id: str = "id",
    vector: str = "embedding",
    query_id: str = "query_id",
    query_vector: str = "embedding",
    batch: int = QUERY_BATCH,
) -> DataFrame:
    """Rows (query_id, id, similarity, rank): for every query the ``k``
    documents of greatest cosine similarity above ``threshold``.

    Vectors are packed, ``BLOCK`` documents and ``batch`` queries a row. The
    packed queries are written, so their number and size are known. Up to
    ``SENT_BYTES`` they are sent to the documents, which stay as they are.
    More of them meet the documents in a grid: documents are dealt to rows and
    queries to columns of about ``SIDE_BYTES`` each, and every cell of the grid
    is a task of its own that gets both sides once. Only queries that are sent
    pass through the driver. A column ``top_k`` of ``queries`` overrides ``k`` where it is given
    and not 0. A column ``form`` tells versions of one query apart and comes
    back in the result.
    """
    k = k or TOP_K
    wanted = _wanted(queries, k, query_id, query_vector)
    zero = F.lit(0).cast("long")
    blocks = stored(_packed(wanted.withColumn("key", zero), batch))
    table = _documents(docs, id, vector, zero.alias("key"))
    size = blocks.agg(F.count("*"), F.coalesce(F.sum(F.length("vectors")), F.lit(0)), F.max(F.length("vectors") / F.col("n")))
    n, total, width = size.first()
    if total <= SENT_BYTES:
        # Measured, not estimated: so few bytes may be sent to every task.
        sent = blocks.select("n", "ids", "forms", "limits", "vectors").toArrow()
        return _result(_ranked(_scored(table, sent, threshold)), queries)
    # Counting reads no vectors.
    rows, columns = grid(docs.count() * width, total, n)
    place = F.pmod(F.xxhash64("ids"), F.lit(rows))
    chunks = _packed(table, BLOCK).withColumn("_row", place)
    chunks = chunks.withColumn("_column", F.explode(F.sequence(F.lit(0), F.lit(columns - 1))))
    turn = F.pmod(F.xxhash64("ids"), F.lit(columns))
    blocks = blocks.withColumn("_column", turn)
    blocks = blocks.withColumn("_row", F.explode(F.sequence(F.lit(0), F.lit(rows - 1))))
    key = (F.col("_row") * columns + F.col("_column")).cast("long")
    chunks = chunks.withColumn("key", key).drop("_row", "_column")
    blocks = blocks.withColumn("of_key", key).drop("key", "_row", "_column")
    return _result(_ranked(_gridded(chunks, blocks, threshold)), queries)


def grid(doc_bytes: float, query_bytes: float, query_blocks: int) -> tuple[int, int]:
    """Rows (for documents) and columns (for queries) of a grid whose sides hold about ``SIDE_BYTES``."""
    columns = min(query_blocks, max(1, math.ceil(query_bytes / SIDE_BYTES)))
    return max(1, math.ceil(doc_bytes / SIDE_BYTES)), columns


class Cells:
    """Centres of a k-means clustering of unit vectors, as many as ``lists`` says."""

    def __init__(self, centres: np.ndarray):
        self.centres = centres / np.linalg.norm(centres, axis=1, keepdims=True)

    def angles(self, vector: str) -> Column:
        """The angles of a vector to all centres."""
        centres = self.centres

        @F.arrow_udf("array<double>")
        def measured(vectors: pa.Array) -> pa.Array:
            import numpy as np
            import pyarrow as pa

            angles = np.arccos(np.clip(_units(vectors, centres.shape[1]) @ centres.T, -1, 1))
            n, cells = angles.shape
            return pa.ListArray.from_arrays(pa.array(np.arange(0, n * cells + 1, cells, dtype=np.int32)), pa.array(angles.ravel()))

        return measured(vector)

    def angle(self, vector: str, cell: str) -> Column:
        """The angle of a vector to the centre of its cell."""
        centres = self.centres

        @F.arrow_udf("double")
        def measured(vectors: pa.Array, cell: pa.Array) -> pa.Array:
            import numpy as np
            import pyarrow as pa

            own = centres[cell.to_numpy(zero_copy_only=False)]
            return pa.array(np.arccos(np.clip((_units(vectors, centres.shape[1]) * own).sum(axis=1), -1, 1)))

        return measured(vector, cell)


def _units(vectors: pa.Array, size: int) -> np.ndarray:
    matrix = np.asarray(vectors.flatten(), dtype=float).reshape(len(vectors), size)
    lengths = np.linalg.norm(matrix, axis=1, keepdims=True)
    return matrix / np.where(lengths > 0, lengths, 1)


def pack_cells(
    placed: DataFrame,
    cells: Cells,
    id: str = "id",
    vector: str = "embedding",
    cell: str = "cell",
    parts: int | None = None,
) -> DataFrame:
    """Blocks of up to ``BLOCK`` vectors of one cell, to be written before they are searched.

    The vectors of a cell are dealt by ranges of their angle to its centre, so
    a crowded cell lies in many parts and many blocks, each with the angles
    between which its vectors lie. Vectors of zeros are in no block.
    """
    parts = parts or int(placed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    table = _documents(placed, id, vector, F.col(cell).cast("long").alias("key")).where("key >= 0")
    table = table.withColumn("angle", cells.angle("vector", "key"))
    keys = ["key", "angle", "id"]
    blocks = _packed(table.repartitionByRange(parts, *keys).sortWithinPartitions(*keys), BLOCK)
    return blocks.select(F.col("key").alias("cell"), F.monotonically_increasing_id().alias("block"), *blocks.columns[1:])


#: Blocks that are searched first, and how many times more after them, before all that are left.
PROBES, TIER = 4, 8


def similar_in_cells(
    packed: DataFrame,
    cells: Cells,
    queries: DataFrame,
    k: int | None = TOP_K,
    threshold: float = SIMILARITY_THRESHOLD,
    query_id: str = "query_id",
    query_vector: str = "embedding",
    probes: int = PROBES,
    batch: int = QUERY_BATCH,
) -> DataFrame:
    """The rows of ``similar``, found block by block in the written table of ``pack_cells``.

    A query at angle t to a centre is at least low - t and t - high away from
    the vectors of a block of that cell. The blocks that can reach the
    threshold are searched in tiers, best bound first: after each tier the
    k-th best similarity of a query takes away the blocks whose bound is below
    it. Bounds are rows of numbers; vectors of queries go to the blocks they
    are to be compared with, and a block that many queries ask for gets them
    in columns of about ``SIDE_BYTES``.
    """
    k = k or TOP_K
    wanted = stored(_wanted(queries, k, query_id, query_vector).where(F.col("vector").isNotNull()))
    names = ["id", "form"]
    angles = wanted.select(*names, F.posexplode(cells.angles("vector")).alias("cell", "angle"))
    # Rounding must not hide the last hit: a bound is a little too high.
    away = F.greatest(F.lit(0.0), F.col("low") - F.col("angle"), F.col("angle") - F.col("high"))
    pairs = angles.join(packed.select("cell", "block", "low", "high"), "cell")
    pairs = pairs.withColumn("bound", F.cos(away) + BOUND_SLACK).where(F.col("bound") > threshold)
    turn = F.row_number().over(Window.partitionBy(*names).orderBy(F.desc("bound"), "block"))
    pairs = stored(pairs.select(*names, "cell", "block", "bound", turn.alias("turn")))
    size = wanted.agg(F.coalesce(F.sum(8 * F.size("vector")), F.lit(0))).first()[0]
    columns = max(1, math.ceil(size / SIDE_BYTES))
    most = pairs.agg(F.coalesce(F.max("turn"), F.lit(0))).first()[0]

    def searched(part: DataFrame) -> DataFrame:
        key = F.col("block") * columns
        rows = part.join(wanted, names).withColumn("key", key + F.pmod(F.xxhash64("id"), F.lit(columns)))
        rows = rows.select("key", *names, "limit", "vector")
        asked = _packed(rows.repartition("key").sortWithinPartitions("key"), batch).withColumnRenamed("key", "of_key")
        # By cell as well: Spark leaves out the files of cells that nobody asks for.
        blocks = packed.join(part.select("cell", "block").distinct(), ["cell", "block"], "left_semi")
        every = F.explode(F.sequence(F.lit(0), F.lit(columns - 1)))
        blocks = blocks.withColumn("_column", every).withColumn("key", key + F.col("_column"))
        return _gridded(blocks.select("key", "n", "ids", "vectors"), asked, threshold)

    hits, begin = None, 0
    for width in (probes, TIER * probes, None):
        if begin >= most:
            break
        part = pairs.where(F.col("turn") > begin)
        if width is not None:
            part = part.where(F.col("turn") <= begin + width)
        if hits is not None:
            last = hits.where(F.col("rank") == F.col("limit")).select(
                F.col("query_id").alias("id"), "form", F.col("similarity").alias("_last")
            )
            part = part.join(last, names, "left").where(F.col("_last").isNull() | (F.col("bound") >= F.col("_last")))
        found = searched(stored(part.select(*names, "cell", "block")))
        hits = stored(_ranked(found if hits is None else found.unionByName(hits.drop("rank"))))
        begin = most if width is None else begin + width
    if hits is None:
        hits = _ranked(packed.sparkSession.createDataFrame([], HITS))
    return _result(hits, queries)


def unit_vector(vector: Column) -> Column:
    length = F.sqrt(F.aggregate(vector, F.lit(0.0), lambda s, x: s + x.cast("double") * x))
    return F.transform(vector, lambda x: F.try_divide(x.cast("double"), length))


def assign_cells(
    docs: DataFrame,
    vector: str = "embedding",
    lists: int = INDEX_LISTS,
    seed: int = 7,
    train: DataFrame | None = None,
) -> tuple[DataFrame, Cells]:
    """Cluster the vectors and add the number of the cell of every document.

    The centres come from all vectors, or from those of ``train``; unit
    vectors are made once, in a table of the shared folder that clustering
    reads again and again. Results of a search do not depend on the centres.
    Documents with a zero vector are no hit of any query and get cell -1.
    """
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    unit = unit_vector(F.col(vector))
    usable = F.col(vector).isNotNull() & ~F.exists(unit, lambda x: x.isNull())

    def points_of(df: DataFrame) -> DataFrame:
        return keep(df.where(usable).withColumn("_point", array_to_vector(unit)))

    points = points_of(docs)
    model = KMeans(
        k=lists, seed=seed, maxIter=10, featuresCol="_point", predictionCol="cell"
    ).fit(points if train is None else points_of(train))
    placed = model.transform(points).drop("_point")
    rest = docs.where(~F.coalesce(usable, F.lit(False))).withColumn("cell", F.lit(-1))
    return placed.unionByName(rest), Cells(np.array(model.clusterCenters()))
