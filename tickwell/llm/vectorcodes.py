"""Vectors as short codes: parts of a vector are replaced by the nearest entry of a codebook.

Components become integers, so every sum is exact and does not depend on the
order of the rows. Each vector is cut into equal parts with a codebook per
part position. Entries start as parts of the first vectors and move to the
mean of the parts that chose them, for some rounds.

The distances come from a trie over the distinct parts of a batch. Sorted
parts with a common beginning share a node per dimension; a node holds the
distances of its beginning to all entries, and its children add one dimension
each. Branches are visited depth first, in slices of a bounded number of
leaves; a leaf takes the nearest entry and counts as often as its part occurs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwell.llm.tables import written

SCALE = 256
PARTS = 16
ENTRIES = 64
ROUNDS = 2
#: Distinct parts whose branches are visited at once.
LEAVES = 4096
#: Rows taken from an Arrow batch at once.
ROWS = 2048
#: Up to this size of a component the distances of parts of up to 256 components stay within 64 bits.
EXACT = 1 << 26


# ---- The trie ---------------------------------------------------------------


def distinct_parts(parts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct rows in lexicographic order, which of them each row is, and how often each occurs."""
    order = np.lexsort(parts.T[::-1])
    rows = parts[order]
    new = np.ones(len(rows), dtype=bool)
    new[1:] = (rows[1:] != rows[:-1]).any(axis=1)
    which = np.empty(len(rows), dtype=np.int64)
    which[order] = np.cumsum(new) - 1
    return rows[new], which, np.diff(np.append(np.flatnonzero(new), len(rows)))


def trie_distances(leaves: np.ndarray, entries: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Squared distances of sorted distinct parts to all entries, slice by slice:
    the number of the first leaf and an array (leaf, entry)."""
    for start in range(0, len(leaves), LEAVES):
        part = leaves[start : start + LEAVES]
        # One node stands for all leaves with the same beginning; it starts where the beginning changes.
        node = np.zeros(len(part), dtype=np.int64)
        grown = np.zeros((1, len(entries)), dtype=entries.dtype)
        changed = np.zeros(len(part), dtype=bool)
        changed[0] = True
        for d in range(part.shape[1]):
            changed[1:] |= part[1:, d] != part[:-1, d]
            first = np.flatnonzero(changed)
            step = part[first, d][:, None] - entries[None, :, d]
            grown = grown[node[first]] + step * step
            node = np.cumsum(changed) - 1
        yield start, grown


def assign(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry of every part (the lower index of equal ones) and its squared distance."""
    leaves, which, _ = distinct_parts(parts)
    nearest, distance = _leaves(leaves, entries)
    return nearest[which], distance[which]


def _leaves(leaves: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    nearest = np.empty(len(leaves), dtype=np.int64)
    distance = np.empty(len(leaves), dtype=entries.dtype)
    for start, grown in trie_distances(leaves, entries):
        best = grown.argmin(axis=1)
        stop = start + len(best)
        nearest[start:stop] = best
        distance[start:stop] = grown[np.arange(len(best)), best]
    return nearest, distance


def weighted_sums(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Componentwise sums and the number of the parts that choose each entry."""
    leaves, _, weights = distinct_parts(parts)
    nearest, _ = _leaves(leaves, entries)
    sums = np.zeros(entries.shape, dtype=entries.dtype)
    np.add.at(sums, nearest, leaves * weights[:, None].astype(entries.dtype))
    return sums, np.bincount(nearest, weights=weights, minlength=len(entries)).astype(np.int64)


def whole_numbers(vectors: np.ndarray) -> np.ndarray:
    """floor(256 * x); Python's own integers where 64 bits might not hold a distance."""
    grown = np.floor(vectors.astype(np.float64) * SCALE)
    if not grown.size or np.abs(grown).max() <= EXACT:
        return grown.astype(np.int64)
    return np.array([int(x) for x in grown.ravel()], dtype=object).reshape(grown.shape)


# ---- Tables -----------------------------------------------------------------


def usable(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """``vec_id, vector, label`` of the rows whose vector is there and holds finite numbers alone."""
    vector = F.col(vector_col).cast("array<double>")
    low, high = F.lit(float("-inf")), F.lit(float("inf"))
    # NaN is greater than any number, so it fails the upper bound.
    finite = F.forall(vector, lambda x: x.isNotNull() & (x > low) & (x < high))
    label = F.col(label_col).cast("long") if label_col in vectors.columns else F.lit(None).cast("long")
    rows = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"), vector.alias("vector"), label.alias("label"), finite.alias("finite")
    )
    return rows.where("finite and size(vector) > 0").drop("finite")


class Codebooks:
    """Entries by part, entry and place within the part."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries

    @property
    def width(self) -> int:
        return self.entries.shape[0] * self.entries.shape[2]

    def sha256(self) -> str:
        return hashlib.sha256(",".join(str(int(x)) for x in self.entries.ravel()).encode()).hexdigest()


def _blocks(batches: Iterator[pa.RecordBatch], books: Codebooks) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Rows of a bounded number with their parts (position, row, place) and entries of the same type."""
    positions, _, size = books.entries.shape
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            part = batch.slice(at, ROWS)
            flat = np.asarray(part.column("vector").flatten(), dtype=np.float64)
            whole = whole_numbers(flat.reshape(part.num_rows, books.width))
            entries = books.entries.astype(object) if whole.dtype == object else books.entries
            whole = whole.astype(entries.dtype)
            yield part, whole.reshape(part.num_rows, positions, size).transpose(1, 0, 2), entries


def first_codebooks(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES) -> Codebooks | None:
    """The parts of the vectors of smallest id, equal ids in order of their vectors; None without rows."""
    size = F.size("vector")
    first = rows.where(size % parts == 0).orderBy(F.col("vec_id").asc_nulls_last(), "vector").select("vector")
    # A few rows, as many as a codebook has entries.
    found = [r[0] for r in first.limit(entries).collect()]
    if not found:
        return None
    width = len(found[0])
    whole = whole_numbers(np.array([v for v in found if len(v) == width]))
    return Codebooks(np.ascontiguousarray(whole.reshape(len(whole), parts, width // parts).transpose(1, 0, 2)))


def moved(rows: DataFrame, books: Codebooks) -> Codebooks:
    """Every entry at the mean, rounded down, of the parts nearest to it; entries without parts stay.

    Each task sends one row per part position and entry, whatever its number
    of vectors; their sums are as many rows again, and these go to the driver.
    """
    positions, count, size = books.entries.shape

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((positions, count, size), dtype=object)
        seen = np.zeros((positions, count), dtype=np.int64)
        for _, parts, entries in _blocks(batches, books):
            for p in range(positions):
                more, n = weighted_sums(parts[p], entries[p])
                sums[p] += more
                seen[p] += n
        place = np.flatnonzero(seen.ravel())
        digits = sums.reshape(-1, size)[place]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(place),
                pa.array(seen.ravel()[place]),
                pa.array([[str(x) for x in row] for row in digits], type=pa.list_(pa.string())),
            ],
            names=["place", "n", "sums"],
        )

    totals = (
        rows.select("vector")
        .mapInArrow(summed, "place long, n long, sums array<string>")
        .groupBy("place")
        .agg(F.sum("n").alias("n"), *[F.sum(F.col("sums")[d].cast("decimal(38,0)")).alias(f"s{d}") for d in range(size)])
    )
    flat = books.entries.astype(object).reshape(-1, size).copy()
    for row in totals.collect():
        flat[row["place"]] = [int(row[f"s{d}"]) // row["n"] for d in range(size)]
    largest = max((abs(x) for x in flat.ravel()), default=0)
    flat = flat.reshape(books.entries.shape)
    return Codebooks(flat.astype(np.int64) if largest <= EXACT else flat)


def encode(rows: DataFrame, books: Codebooks) -> DataFrame:
    """``vec_id, label, code, error`` of every row; an error beyond 64 bits is null."""
    positions = books.entries.shape[0]

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, parts, entries in _blocks(batches, books):
            codes = np.empty((part.num_rows, positions), dtype=np.uint8)
            error = np.zeros(part.num_rows, dtype=entries.dtype)
            for p in range(positions):
                codes[:, p], distance = assign(parts[p], entries[p])
                error += distance
            digits = codes.tobytes().hex()
            width = 2 * positions
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("vec_id"),
                    part.column("label"),
                    pa.array([digits[i * width : (i + 1) * width] for i in range(part.num_rows)]),
                    pa.array([int(x) if x < 1 << 63 else None for x in error], type=pa.int64()),
                ],
                names=["vec_id", "label", "code", "error"],
            )

    return rows.mapInArrow(coded, "vec_id long, label long, code string, error long")


def vector_codes(
    vectors: DataFrame,
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256``, one row per usable row.

    Rows whose vector is null, empty or holds a null, NaN or infinite value
    are left out, and so are vectors that do not have as many components as
    the first usable vector whose components can be cut into ``parts``. Equal
    rows are coded as often as they occur; null ids are kept and come last in
    the choice of the first entries. Without a label column all labels are
    null, and null labels form one group. An empty table gives no rows. The
    table is read once per round and once for the codes; nothing of a size
    that grows with it is broadcast or collected. At most 256 entries.
    """
    if entries > 256:
        raise ValueError("an index has two hex digits: at most 256 entries")
    schema = "vec_id long, code string, error long, label_error long, codebooks_sha256 string"
    rows = usable(vectors, id_col, vector_col, label_col)
    books = first_codebooks(rows, parts, entries)
    if books is None:
        return vectors.sparkSession.createDataFrame([], schema)
    rows = rows.where(F.size("vector") == books.width)
    for _ in range(rounds):
        books = moved(rows, books)
    codes = written(encode(rows, books))
    totals = codes.groupBy("label").agg(F.expr("try_sum(error)").alias("label_error"))
    totals = totals.withColumnRenamed("label", "_of")
    return codes.join(totals, F.col("label").eqNullSafe(F.col("_of"))).select(
        "vec_id", "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256")
    )
