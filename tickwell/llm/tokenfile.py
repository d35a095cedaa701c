"""Token ids in fixed-width packed segments, with block offsets for random access.

A segment is one binary value that holds the ids of some consecutive documents:

* header: magic ``TKW1``, bits per id, ids per block, number of documents, number of ids;
* document table: a null mark and the id of each document, then the index of the id after its last;
* block offsets: the byte at which each block of ids begins, counted from the payload;
* payload: blocks of ids, each id in the fewest bits that hold the vocabulary.

A block begins on a byte, so any range of ids is read from the blocks it
touches, and whole blocks are unpacked with a handful of array operations.
Segments are rows of a Parquet table, because Spark's writers commit their
files as a whole: a lost executor leaves no half-written segment.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickwell.llm.tables import by_batch, fresh_path, id_and_text
from tickwell.llm.wordids import batch_encoder

MAGIC = b"TKW1"
HEADER = struct.Struct("<4sHHIQ")
BLOCK = 1024
SEGMENT_IDS = 1 << 18


# ---- Bits -----------------------------------------------------------------


def pack(ids: np.ndarray, width: int) -> bytes:
    """Ids of ``width`` bits each (1 to 32), in little-endian order, whole blocks of 64."""
    if width in (8, 16, 32):
        return ids.astype(f"<u{width // 8}").tobytes()
    groups = -(-len(ids) // 64)
    lanes = np.zeros((groups, 64), dtype=np.uint64)
    lanes.reshape(-1)[: len(ids)] = ids
    words = np.zeros((groups, width + 1), dtype=np.uint64)
    for lane in range(64):
        word, shift = divmod(lane * width, 64)
        words[:, word] |= lanes[:, lane] << np.uint64(shift)
        if shift + width > 64:
            words[:, word + 1] |= lanes[:, lane] >> np.uint64(64 - shift)
    return words[:, :width].astype("<u8").tobytes()[: -(-len(ids) * width // 8)]


def unpack(data: bytes, width: int, n: int) -> np.ndarray:
    """The first ``n`` ids of packed bytes."""
    if width in (8, 16, 32):
        return np.frombuffer(data, dtype=f"<u{width // 8}", count=n).astype(np.uint32)
    groups = -(-n // 64)
    raw = np.zeros(groups * width * 8, dtype=np.uint8)
    part = np.frombuffer(data, dtype=np.uint8)[: len(raw)]
    raw[: len(part)] = part
    words = np.zeros((groups, width + 1), dtype=np.uint64)
    words[:, :width] = raw.view("<u8").reshape(groups, width)
    lanes = np.empty((groups, 64), dtype=np.uint64)
    for lane in range(64):
        word, shift = divmod(lane * width, 64)
        lanes[:, lane] = words[:, word] >> np.uint64(shift)
        if shift + width > 64:
            lanes[:, lane] |= words[:, word + 1] << np.uint64(64 - shift)
    return (lanes.reshape(-1)[:n] & np.uint64((1 << width) - 1)).astype(np.uint32)


# ---- Segments -------------------------------------------------------------


def encode_segment(doc_ids: list[int | None], counts: list[int], ids: np.ndarray, width: int) -> bytes:
    """One segment of the documents whose ids follow each other in ``ids``."""
    blocks = [pack(ids[at : at + BLOCK], width) for at in range(0, len(ids), BLOCK)]
    offsets = np.cumsum([0, *map(len, blocks)]).astype("<u8")
    return b"".join(
        [
            HEADER.pack(MAGIC, width, BLOCK, len(doc_ids), len(ids)),
            np.array([d is None for d in doc_ids], dtype=np.uint8).tobytes(),
            np.array([d or 0 for d in doc_ids], dtype="<i8").tobytes(),
            np.cumsum(counts).astype("<u8").tobytes(),
            offsets.tobytes(),
            *blocks,
        ]
    )


class Segment:
    """Reads a segment without unpacking more than is asked for."""

    def __init__(self, data: bytes):
        magic, self.width, self.block, docs, self.n_ids = HEADER.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not a segment of packed token ids")
        at = HEADER.size
        nulls = np.frombuffer(data, np.uint8, docs, at)
        ids = np.frombuffer(data, "<i8", docs, at := at + docs)
        self.doc_ids = [None if null else int(d) for null, d in zip(nulls, ids)]
        self.ends = np.frombuffer(data, "<u8", docs, at := at + 8 * docs).astype(np.int64)
        n_blocks = -(-self.n_ids // self.block)
        self.offsets = np.frombuffer(data, "<u8", n_blocks + 1, at := at + 8 * docs).astype(np.int64)
        self.payload = memoryview(data)[at + 8 * (n_blocks + 1) :]

    def range(self, start: int, stop: int) -> np.ndarray:
        """Ids ``start`` to ``stop`` of the segment, from the blocks that hold them."""
        if stop <= start:
            return np.empty(0, np.uint32)
        first, last = start // self.block, (stop - 1) // self.block
        parts = []
        for b in range(first, last + 1):
            n = min(self.block, self.n_ids - b * self.block)
            parts.append(unpack(self.payload[self.offsets[b] : self.offsets[b + 1]], self.width, n))
        return np.concatenate(parts)[start - first * self.block : stop - first * self.block]

    def document(self, k: int) -> np.ndarray:
        return self.range(int(self.ends[k - 1]) if k else 0, int(self.ends[k]))

    def all(self) -> np.ndarray:
        """All ids at once: blocks of whole groups lie back to back, so one call unpacks them."""
        return unpack(self.payload, self.width, self.n_ids)


# ---- Tables ---------------------------------------------------------------

TABLE = "shard int, segment int, first_id long, n_docs int, n_ids long, data binary"


def write_tokens(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    shards: int | None = None,
) -> None:
    """Encode whole texts and write them as packed segments in ascending order of id.

    Null ids come first; rows of equal id are ordered by a hash of their text, and equal
    rows are written as often as they occur. A null or empty text has the end
    id alone. Shards are ranges of ids, so a frequent source spreads over many;
    rows of one id that occurs very often stay in one shard, segment by segment.
    """
    spark = docs.sparkSession
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = (
        id_and_text(docs, id_col, text_col)
        .repartitionByRange(shards, "doc_id", F.xxhash64("text"))
        .sortWithinPartitions("doc_id", F.xxhash64("text"), "text")
    )

    def packed(pieces: Iterator[dict]) -> Iterator[dict]:
        code = batch_encoder(tokenizer)
        end = np.array([end_id], dtype="<u4")
        width = max(code.width, max(1, end_id.bit_length()))
        shard = TaskContext.get().partitionId()
        segment = first = held = 0
        doc_ids: list = []
        counts: list[int] = []
        parts: list[np.ndarray] = []

        def row() -> dict:
            ids = np.concatenate(parts)
            data = encode_segment(doc_ids, counts, ids, width)
            return {
                "shard": [shard],
                "segment": [segment],
                "first_id": [first],
                "n_docs": [len(doc_ids)],
                "n_ids": [len(ids)],
                "data": [data],
            }

        for piece in pieces:
            ids, at = code.encode(piece["text"])
            for doc_id, start, stop in zip(piece["doc_id"].to_pylist(), at, at[1:].tolist()):
                doc_ids.append(doc_id)
                parts += [ids[start:stop], end]
                counts.append(stop - int(start) + 1)
                held += counts[-1]
                if held >= SEGMENT_IDS:
                    yield row()
                    segment, first, held = segment + 1, first + held, 0
                    doc_ids, counts, parts = [], [], []
        if doc_ids:
            yield row()

    by_batch(ordered, TABLE, packed, arrays=True).write.option("compression", "zstd").parquet(path)


def read_tokens(spark, path: str) -> DataFrame:
    """One row per document of a packed table, from the ids in its files.

    ``doc_id, start, n_tokens, ids_crc32, shard, segment``; ``start`` counts
    the ids of all documents before it.
    """
    table = spark.read.parquet(path)
    # One row per shard, of which there are as many as the writer had tasks.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    sizes = table.groupBy("shard").agg(F.sum("n_ids").alias("ids"))
    starts = sizes.select("shard", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("base"))
    schema = "doc_id long, at long, n_tokens long, ids_crc32 long, shard int, segment int"

    def opened(pieces: Iterator[dict]) -> Iterator[dict]:
        for piece in pieces:
            columns = [piece[c].to_pylist() for c in ("shard", "segment", "first_id")]
            for shard, number, first, data in zip(*columns, piece["data"]):
                segment = Segment(data.as_py())
                ids = segment.all().astype("<u4")
                ends = segment.ends
                begins = np.concatenate([[0], ends[:-1]]).astype(np.int64)
                n = len(ends)
                yield {
                    "doc_id": segment.doc_ids,
                    "at": begins + first,
                    "n_tokens": ends - begins,
                    "ids_crc32": [zlib.crc32(ids[a:b]) for a, b in zip(begins, ends)],
                    "shard": np.full(n, shard, np.int32),
                    "segment": np.full(n, number, np.int32),
                }

    rows = by_batch(table, schema, opened)
    return rows.join(F.broadcast(starts), "shard").select(
        "doc_id",
        (F.col("base") + F.col("at")).alias("start"),
        "n_tokens",
        "ids_crc32",
        "shard",
        "segment",
    )


def read_ids(spark, path: str) -> DataFrame:
    """``doc_id, ids`` of every document, as arrays."""

    def opened(pieces: Iterator[dict]) -> Iterator[dict]:
        for piece in pieces:
            for data in piece["data"]:
                segment = Segment(data.as_py())
                docs = range(len(segment.doc_ids))
                yield {"doc_id": segment.doc_ids, "ids": [segment.document(k) for k in docs]}

    return by_batch(spark.read.parquet(path).select("data"), "doc_id long, ids array<long>", opened)


def token_file(docs: DataFrame, tokenizer: str, end_id: int, path: str | None = None, **columns) -> DataFrame:
    """Write ``docs`` as packed ids below ``path`` and read the files back, a row per document."""
    path = path or fresh_path(docs.sparkSession)
    write_tokens(docs, path, tokenizer, end_id, **columns)
    return read_tokens(docs.sparkSession, path)
