"""Repeated passages: bytes covered by a string of 100 bytes that also starts earlier.

Sorting every suffix would move the corpus a hundred times over. Two filters
that lose nothing come first. Windows are grouped in runs by their anchors
(``anchors``); a run whose anchor occurs once holds no repeat, and a run whose
bytes are those of an earlier run is repeated as a whole. What is left, runs
that share an anchor but not all of their bytes, is resolved by suffixes: the
suffix that begins at the anchor stands for all windows of the run. Each task
sorts its suffixes and sends them as front-coded runs; the receiving task
merges runs with a loser tree that never compares a known prefix again, and
the shared lengths that come out say how far two runs agree to the right. A
window at distance ``o`` before its anchor is repeated if an earlier one
agrees in ``100 - o`` bytes from the anchor on and in ``o`` bytes before it.
Runs of an anchor too frequent for one task are compared window by window
instead, by hashes of 128 bits.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickwell.llm.anchors import GRAM, window_runs
from tickwell.llm.suffixruns import decode, encode, merge
from tickwell.llm.tables import by_batch, id_and_text, written

LENGTH = 100
#: Suffixes that a task sorts at once, and that one merging task gets.
RUN_SUFFIXES = 100_000
PART_SUFFIXES = 20_000
#: Anchors with more runs to compare go by windows, of which a task holds so many at a time.
MOST_OF_ANCHOR = 20_000
WINDOWS_HELD = 1 << 19
MOST_STARTS = 1 << 19
NULL_ID = -(1 << 63)
_PLACE = struct.Struct("<qqqBB")
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc, tag, text``: a null id comes before all others, and texts of one id are told apart by a tag."""
    source = id_and_text(docs, id_col, text_col)
    doc = F.coalesce("doc_id", F.lit(NULL_ID))
    several = source.groupBy(doc.alias("_several")).count().where("count > 1").select("_several")
    # Read back from a file its size is known, so Spark broadcasts it if it is small.
    several = written(several)
    keyed = source.join(several, doc == F.col("_several"), "left")
    tag = F.when(F.col("_several").isNotNull(), F.pmod(F.xxhash64("text"), F.lit(1 << 62))).otherwise(0)
    return keyed.select("doc_id", doc.alias("doc"), tag.cast("long").alias("tag"), "text")


# The span of a run is its first start, 10 bits for the distance of the anchor, 10 for further starts.


def _records(texts: DataFrame, length: int) -> DataFrame:
    """One row per run of windows: anchor hash, hash of the bytes, place, and whether
    it is known to be repeated, because an equal run before it came to the same task.
    """

    def work(pieces: Iterator[dict]) -> Iterator[dict]:
        for piece in pieces:
            parts = [window_runs(t.encode(), length) for t in piece["text"]]
            sizes = [len(p[0]) for p in parts]
            if not any(sizes):
                continue
            grams, whole, first, last, anchor = (np.concatenate(x) for x in zip(*parts))
            doc = np.repeat(piece["doc"].to_numpy(), sizes)
            tag = np.repeat(piece["tag"].to_numpy(), sizes)
            span = first << 20 | (anchor - first) << 10 | (last - first)
            # Of equal runs only the first at hand needs a look at the rest of the corpus.
            order = np.lexsort((span, tag, doc, whole, grams))
            columns = [c[order] for c in (grams, whole, doc, tag, span)]
            same = [np.append([False], c[1:] == c[:-1]) for c in columns]
            known = same[0] & same[1] & ~(same[2] & same[3] & same[4])
            yield dict(zip(("gram", "whole", "doc", "tag", "span"), columns)) | {"known": known}

    schema = "gram long, whole long, doc long, tag long, span long, known boolean"
    return by_batch(texts.select("doc", "tag", "text"), schema, work)


def _sorted_out(records: DataFrame, partitions: int) -> DataFrame:
    """``doc, tag, span, gram, repeated``: runs with the bytes of an earlier run, and runs to be compared.

    Rows arrive ordered by anchor, bytes and place. Only the last row seen and
    the first run of an anchor are remembered, however many rows it has. Runs
    known to be repeated pass through, dealt out by their place and not by
    their anchor, which may be very frequent.
    """
    dealt = F.when(F.col("known"), F.xxhash64("doc", "span")).otherwise(F.col("gram"))
    ordered = records.withColumn("dealt", dealt).repartition(partitions, "dealt").drop("dealt")
    ordered = ordered.sortWithinPartitions("known", "gram", "whole", "doc", "tag", "span")

    def work(pieces: Iterator[dict]) -> Iterator[dict]:
        last: tuple | None = None
        first: tuple | None = None  # of the anchor, while no other bytes have been seen
        for piece in pieces:
            known = piece["known"].to_numpy(zero_copy_only=False)
            gram, whole, doc, tag, span = (piece[c].to_numpy() for c in ("gram", "whole", "doc", "tag", "span"))
            if known.any():
                yield {c: x[known] for c, x in zip(("doc", "tag", "span", "gram"), (doc, tag, span, gram))} | {"repeated": known[known]}
                gram, whole, doc, tag, span = (x[~known] for x in (gram, whole, doc, tag, span))
                if not len(gram):
                    continue
            old_gram = np.append([gram[0] if last is None else last[0]], gram[:-1]) == gram
            old_whole = np.append([whole[0] if last is None else last[1]], whole[:-1]) == whole
            same_place = (
                (np.append([doc[0] if last is None else last[2]], doc[:-1]) == doc)
                & (np.append([tag[0] if last is None else last[3]], tag[:-1]) == tag)
                & (np.append([span[0] if last is None else last[4]], span[:-1]) == span)
            )
            if last is None:
                old_gram[0] = False
            old_whole &= old_gram
            again = old_whole & same_place  # another row of the same document
            heads = np.flatnonzero(~old_whole)
            # A head is compared if its anchor has another head; its anchor starts where old_gram is false.
            starts = ~old_gram[heads]
            compared = ~starts
            compared[:-1] |= ~starts[1:]
            out = [(doc[i], tag[i], span[i], gram[i]) for i in heads[compared].tolist()]
            if first is not None and len(heads) and not starts[0]:
                out.append(first)
            if len(heads):
                alone = bool(starts[-1])
                i = heads[-1]
                first = (doc[i], tag[i], span[i], gram[i]) if alone else None
            last = (gram[-1], whole[-1], doc[-1], tag[-1], span[-1])
            hit = np.flatnonzero(old_whole & ~again)
            n = len(out)
            columns = [np.concatenate([np.array([o[c] for o in out], np.int64), x[hit]]) for c, x in enumerate((doc, tag, span, gram))]
            yield {
                "doc": columns[0],
                "tag": columns[1],
                "span": columns[2],
                "gram": columns[3],
                "repeated": np.arange(n + len(hit)) >= n,
            }

    return by_batch(ordered, "doc long, tag long, span long, gram long, repeated boolean", work)


def _payload(doc: int, tag: int, anchor: int, before: int, more: int) -> bytes:
    """Place of an anchor, and the largest and smallest distance of its windows."""
    return _PLACE.pack(doc, tag, anchor, before, before - more)


def _suffix_runs(texts: DataFrame, parts: int, length: int) -> DataFrame:
    """``part, run``: front-coded sorted suffixes of the runs in ``spans``."""

    def work(pieces: Iterator[dict]) -> Iterator[dict]:
        unpack = zstandard.ZstdDecompressor().decompress
        held: list[tuple[int, bytes, bytes]] = []

        def flush() -> dict:
            held.sort()
            runs: dict[int, list] = {}
            for part, text, payload in held:
                runs.setdefault(part, []).append((text, payload))
            held.clear()
            return {"part": list(runs), "run": [encode(r) for r in runs.values()]}

        for piece in pieces:
            columns = (piece[c].to_pylist() for c in ("doc", "tag", "packed", "spans"))
            for doc, tag, packed, spans in zip(*columns):
                raw = unpack(packed)
                for span in spans:
                    first, before, more = span >> 20, span >> 10 & 1023, span & 1023
                    anchor = first + before
                    part = xxhash.xxh3_64_intdigest(raw[anchor : anchor + GRAM]) % parts
                    payload = _payload(doc, tag, anchor, before, more) + raw[first:anchor]
                    held.append((part, raw[anchor : first + more + length], payload))
                if len(held) >= RUN_SUFFIXES:
                    yield flush()
        if held:
            yield flush()

    return by_batch(texts, "part int, run binary", work)


def _repeated_windows(entries: list[tuple[int, bytes, bytes]], length: int) -> Iterator[tuple]:
    """``doc, tag, first start, last start`` of windows that an earlier window equals.

    ``entries`` are in suffix order, each with the length it shares with the one before.
    """
    n = len(entries)
    shared = np.array([e[0] for e in entries], dtype=np.int64)
    places = [_PLACE.unpack_from(e[2]) for e in entries]
    doc, tag, anchor, most, least = (np.array(x, dtype=np.int64) for x in zip(*places))
    width = int(most.max(initial=0))
    # Column o has a hash of the o bytes before the anchor; bytes before the run are not needed.
    left = np.zeros((n, width + 1), dtype=np.uint64)
    data = np.zeros((n, width), dtype=np.uint64)
    for i, e in enumerate(entries):
        before = e[2][_PLACE.size :][::-1]
        data[i, : len(before)] = np.frombuffer(before, np.uint8)
    for o in range(width):
        step = (left[:, o] ^ (data[:, o] + np.uint64(o * 257 + 1))) * _FACTOR
        left[:, o + 1] = step ^ (step >> np.uint64(29))
    hits = []
    for o in range(width + 1):
        rows = np.flatnonzero((least <= o) & (o <= most))
        if len(rows) < 2:
            continue
        group = np.cumsum(shared < length - o)[rows]
        start = anchor[rows] - o
        order = np.lexsort((start, tag[rows], doc[rows], left[rows, o], group))
        at, of, side = rows[order], group[order], left[rows, o][order]
        old = np.append([False], (of[1:] == of[:-1]) & (side[1:] == side[:-1]))
        if not old.any():
            continue
        # The first of a group is the earliest; rows at its very place are itself.
        first = at[np.maximum.accumulate(np.where(old, 0, np.arange(len(at))))]
        other = (doc[at] != doc[first]) | (tag[at] != tag[first]) | (anchor[at] != anchor[first])
        found = at[old & other]
        hits.append(np.column_stack([doc[found], tag[found], anchor[found] - o]))
    if hits:
        rows = np.concatenate(hits)
        rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
        new = np.append([True], (rows[1:, :2] != rows[:-1, :2]).any(1) | (rows[1:, 2] > rows[:-1, 2] + 1))
        firsts = np.flatnonzero(new)
        lasts = np.append(firsts[1:], len(rows)) - 1
        for a, b in zip(firsts.tolist(), lasts.tolist()):
            for at in range(a, b + 1, MOST_STARTS):
                yield *rows[at].tolist(), int(rows[min(b, at + MOST_STARTS - 1), 2])


def _merged(runs: DataFrame, length: int) -> DataFrame:
    """``doc, tag, span`` of the repeated windows, from the runs of each part."""

    def work(table: pa.Table) -> pa.Table:
        entries = list(merge([decode(r.as_py()) for r in table.column("run")]))
        rows = list(_repeated_windows(entries, length))
        columns = list(zip(*rows)) or [(), (), (), ()]
        doc, tag, first, last = (np.array(c, dtype=np.int64) for c in columns)
        return pa.table({"doc": doc, "tag": tag, "span": first << 20 | (last - first)})

    return runs.groupBy("part").applyInArrow(work, "doc long, tag long, span long")


def _by_windows(texts: DataFrame, length: int) -> DataFrame:
    """``doc, tag, span`` of the repeated windows of the runs in ``spans``, compared by hash.

    Of equal windows at hand a task passes on the earliest and knows the others
    to be repeated, so a window brings as many rows to its hash as tasks hold it.
    """
    names = ("high", "low", "doc", "tag", "start")

    def work(pieces: Iterator[dict]) -> Iterator[dict]:
        unpack = zstandard.ZstdDecompressor().decompress
        digests: list[bytes] = []
        places: list[tuple[int, int, int]] = []

        def flush() -> dict:
            hashes = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            columns = [*hashes.T, *np.array(places, dtype=np.int64).T]
            order = np.lexsort(columns[::-1])
            columns = [c[order] for c in columns]
            same = [np.append([False], c[1:] == c[:-1]) for c in columns]
            equal, place = same[0] & same[1], same[2] & same[3] & same[4]
            kept = ~(equal & place)  # another row of the same document
            columns, equal = [c[kept] for c in columns], equal[kept]
            digests.clear()
            places.clear()
            return dict(zip(names, columns)) | {"known": equal}

        for piece in pieces:
            for doc, tag, packed, spans in zip(*(piece[c].to_pylist() for c in ("doc", "tag", "packed", "spans"))):
                raw = unpack(packed)
                for span in spans:
                    first, more = span >> 20, span & 1023
                    for start in range(first, first + more + 1):
                        digests.append(xxhash.xxh3_128_digest(raw[start : start + length]))
                        places.append((doc, tag, start))
                    if len(places) >= WINDOWS_HELD:
                        yield flush()
        if places:
            yield flush()

    schema = ", ".join(f"{n} long" for n in names) + ", known boolean"
    windows = written(by_batch(texts, schema, work))
    place = F.struct("doc", "tag", "start")
    earliest = F.min(place).over(Window.partitionBy("high", "low"))
    later = windows.where("not known").withColumn("later", place > earliest).where("later")
    found = windows.where("known").select("doc", "tag", "start").unionByName(later.select("doc", "tag", "start"))
    return found.select("doc", "tag", F.shiftleft("start", 20).alias("span"))


def remove(raw: bytes, spans: list[int], length: int = LENGTH) -> tuple[bytes, int, int]:
    """What is left of a text, the number of removed bytes, and of maximal removed runs."""
    change = np.zeros(len(raw) + 2, dtype=np.int32)
    at = np.array(spans, dtype=np.int64)
    np.add.at(change, at >> 20, 1)
    np.add.at(change, (at >> 20) + (at & ((1 << 20) - 1)) + length, -1)
    gone = np.cumsum(change[: len(raw)]) > 0
    edges = np.flatnonzero(gone & ~np.append([False], gone[:-1])) if len(raw) else gone
    left = np.frombuffer(raw, np.uint8)[~gone].tobytes()
    return left, int(gone.sum()), len(edges)


def remove_repeats(
    docs: DataFrame,
    length: int = LENGTH,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_text: bool = False,
) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` and, if asked for, ``kept_bytes``, of every row.

    Texts are UTF-8 bytes; null texts are empty, and matches never cross
    texts. Earlier means a smaller id, or the same text and an earlier start.
    A null id is smaller than all others. Texts of one id come in the order of
    a hash; rows of one id and text are one document, of which all rows get
    the same result.
    """
    if not GRAM < length < GRAM + 256:
        raise ValueError("length must be above 32 and below 288")
    spark = docs.sparkSession
    keyed = _keyed(docs, id_col, text_col)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    runs = written(_sorted_out(_records(keyed, length), partitions))

    def packed(pieces: Iterator[dict]) -> Iterator[dict]:
        pack = zstandard.ZstdCompressor(level=1).compress
        for piece in pieces:
            yield {
                "doc_id": piece["doc_id"],
                "doc": piece["doc"],
                "tag": piece["tag"],
                "packed": [pack(t.encode()) for t in piece["text"]],
            }

    # Texts are moved twice; packed they are half as large.
    texts = by_batch(keyed, "doc_id long, doc long, tag long, packed binary", packed)
    left = runs.where("not repeated")
    frequent = left.groupBy(F.col("gram").alias("_gram")).count().where(F.col("count") > MOST_OF_ANCHOR)
    # Few by their bound; read back from a file their size is known.
    frequent = written(frequent.select("_gram"))
    by_gram = F.col("gram") == F.col("_gram")

    def with_spans(rows: DataFrame) -> DataFrame:
        wanted = rows.groupBy("doc", "tag").agg(F.collect_list("span").alias("spans"))
        return texts.drop("doc_id").join(wanted, ["doc", "tag"])

    rare = left.join(F.broadcast(frequent), by_gram, "left_anti")
    parts = max(1, -(-rare.count() // PART_SUFFIXES))
    found = written(_merged(_suffix_runs(with_spans(rare), parts, length), length))
    if not frequent.isEmpty():
        hot = left.join(F.broadcast(frequent), by_gram, "left_semi")
        found = found.unionByName(_by_windows(with_spans(hot), length))

    # From here on a span is its first start and 20 bits for further starts.
    whole = runs.where("repeated").select("doc", "tag", F.expr("(span & ~1048575L) | (span & 1023L)").alias("span"))
    spans = whole.unionByName(found)
    spans = spans.groupBy("doc", "tag").agg(F.collect_list("span").alias("spans"))
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    schema += ", kept_bytes binary" if with_text else ""

    def work(pieces: Iterator[dict]) -> Iterator[dict]:
        unpack = zstandard.ZstdDecompressor().decompress
        for piece in pieces:
            raws = [unpack(p.as_py()) for p in piece["packed"]]
            done = [remove(r, s or [], length) for r, s in zip(raws, piece["spans"].to_pylist())]
            yield {
                "doc_id": piece["doc_id"],
                "n_bytes": [len(r) for r in raws],
                "n_removed": [d[1] for d in done],
                "n_spans": [d[2] for d in done],
                "kept_sha256": [hashlib.sha256(d[0]).hexdigest() for d in done],
                "kept_bytes": [d[0] for d in done] if with_text else None,
            }

    return by_batch(texts.join(spans, ["doc", "tag"], "left"), schema, work)
