"""Tokens of two tokenizers aligned by the bytes they cover.

Texts are encoded in whole by both. Where a token of each ends at the same
byte and the next token of each begins with a space, there is an anchor:
anchors cut a text into windows of a few tokens, mostly one word. How the
tokens of a window share their bytes depends on their ids alone, so windows
are looked up by their two tuples of ids and each different one is aligned
once: bytes at which both have an end cut it into groups, and all tokens of a
group are linked.

How many documents link a pair of ids is a count over the corpus. Documents
are taken in blocks; a block sends each different pair once, with its number
of documents, and gets the counts back the same way. Links of single
documents never leave their block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickwell.llm.bpe import byte_alphabet
from tickwell.llm.tables import by_batch, id_and_text, written
from tickwell.llm.wordids import BatchEncoder, gathered

#: Bytes of text in a block, at least one document; pairs in a row of a block.
BLOCK_BYTES = 16 << 20
ROW_PAIRS = 1 << 16
#: Windows that a worker remembers from block to block.
KNOWN = 300_000


class Vocabulary:
    """The bytes of every token, one after another."""

    def __init__(self, tokens: list[bytes]):
        self.sizes = np.array([len(t) for t in tokens], dtype=np.int64)
        self.begins = np.cumsum(self.sizes) - self.sizes
        self.flat = np.frombuffer(b"".join(tokens), dtype=np.uint8)
        self.spaced = np.array([t[:1] == b" " for t in tokens])


def byte_level_tokens(tokenizer) -> list[bytes]:
    """Bytes of the tokens of a byte-level BPE; special tokens keep their own characters."""
    back = {c: b for b, c in byte_alphabet().items()}
    tokens = [b""] * tokenizer.get_vocab_size(with_added_tokens=True)
    for token, number in tokenizer.get_vocab(with_added_tokens=True).items():
        plain = all(c in back for c in token)
        tokens[number] = bytes(back[c] for c in token) if plain else token.encode()
    return tokens


def piece_tokens(model) -> list[bytes]:
    """Bytes of the pieces of a sentencepiece model."""

    def token(i: int) -> bytes:
        piece = model.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode()

    return [token(i) for i in range(model.get_piece_size())]


class Aligner:
    """Both tokenizers, and the alignments of windows seen before."""

    def __init__(self, path_a: str, path_b: str, known: int = KNOWN):
        import sentencepiece

        self.encoder = BatchEncoder(path_a, plain=True, limit=200_000)
        self.model = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.a = Vocabulary(byte_level_tokens(self.encoder.tokenizer))
        self.b = Vocabulary(piece_tokens(self.model))
        self.names = [str(i) for i in range(max(len(self.a.sizes), len(self.b.sizes)))]
        self.marked = [name + mark for mark in (",", "|", ";", "") for name in self.names]
        self.limit, self.known = known, {}

    # -- Windows --

    def aligned(self, keys: list[bytes]) -> list[tuple[int, int, str, bytes]]:
        """Groups, links, the groups as text, and the linked pairs of windows of ids."""
        if len(self.known) >= self.limit:
            self.known.clear()
        new = [key for key in keys if key not in self.known]
        if new:
            self.known |= zip(new, self._new(new))
        return [self.known[key] for key in keys]

    def _new(self, keys: list[bytes]) -> list[tuple[int, int, str, bytes]]:
        """Different windows aligned side by side, in arrays over all their tokens."""
        flat = np.frombuffer(b"".join(keys), "<u4").astype(np.int64)
        sizes = np.fromiter(map(len, keys), np.int64, len(keys)) >> 2
        starts = np.cumsum(sizes) - sizes
        count_a = flat[starts]
        count_b = sizes - 1 - count_a
        a, first_a = gathered(flat, starts + 1, count_a, np.arange(len(keys)))
        b, first_b = gathered(flat, starts + 1 + count_a, count_b, np.arange(len(keys)))
        # Both sides of a window have the same bytes, so all windows can lie in one row.
        ends_a, ends_b = np.cumsum(self.a.sizes[a]), np.cumsum(self.b.sizes[b])
        ended = np.zeros(int(ends_a[-1]) + 1, dtype=np.int8)
        ended[ends_a] += 1
        ended[ends_b] += 2
        closes_a, closes_b = ended[ends_a] == 3, ended[ends_b] == 3
        group_a, group_b = np.cumsum(closes_a) - closes_a, np.cumsum(closes_b) - closes_b
        in_a, in_b = np.bincount(group_a), np.bincount(group_b)
        begin_a, begin_b = np.cumsum(in_a) - in_a, np.cumsum(in_b) - in_b
        # Every token of a group with every one of the other side.
        others, at = gathered(b, begin_b, in_b, group_a)
        pairs = np.repeat(a, in_b[group_a]) << 32 | others
        links = at[first_a]
        groups = np.concatenate([[0], np.cumsum(closes_a)])[first_a]
        # As text: each token with the mark after it, group by group.
        before = np.cumsum(in_a + in_b) - (in_a + in_b)
        shown = np.empty(len(a) + len(b), dtype=np.int64)
        shown[before[group_a] + np.arange(len(a)) - begin_a[group_a]] = a + len(self.names) * np.where(closes_a, 1, 0)
        mark = np.where(closes_b, 2, 0)
        mark[first_b[1:] - 1] = 3
        shown[(before + in_a)[group_b] + np.arange(len(b)) - begin_b[group_b]] = b + len(self.names) * mark
        words = list(map(self.marked.__getitem__, shown.tolist()))
        raw = pairs.astype("<i8").tobytes()
        tokens = (first_a + first_b).tolist()
        texts = ["".join(words[x:y]) for x, y in zip(tokens, tokens[1:])]
        parts = [raw[8 * x : 8 * y] for x, y in zip(links.tolist(), links[1:].tolist())]
        return list(zip(np.diff(groups).tolist(), np.diff(links).tolist(), texts, parts))

    # -- Many texts --

    def windows(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[bytes], np.ndarray, np.ndarray]:
        """Of all texts: numbers of tokens of both (0 for texts that are left
        out), the different windows, which of them follow each other, and
        where those of each text begin and the last end."""
        rows = len(texts)
        texts = texts.cast(pa.large_string()).fill_null("")
        space, empty = (pa.scalar(x, pa.large_string()) for x in (" ", ""))
        spaced = pc.if_else(pc.equal(pc.binary_length(texts), 0), empty, pc.binary_join_element_wise(space, texts, empty))
        ids_a, at_a = self.encoder.encode(spaced)
        lists = self.model.encode(texts.to_pylist(), num_threads=1)
        counts_b = np.fromiter(map(len, lists), np.int64, rows)
        ids_b = np.concatenate([np.asarray(x, dtype=np.uint32) for x in lists]) if rows else np.empty(0, np.uint32)
        counts_a = np.diff(at_a)
        whole = self._verified(spaced, ids_a, counts_a, ids_b, counts_b)
        ids_a, ids_b = ids_a[np.repeat(whole, counts_a)], ids_b[np.repeat(whole, counts_b)]
        counts_a, counts_b = np.where(whole, counts_a, 0), np.where(whole, counts_b, 0)
        if not len(ids_a):
            return counts_a, counts_b, [], np.empty(0, np.int64), np.zeros(rows + 1, np.int64)
        # Both cover the same bytes now, so places in one are places in the other.
        ends_a, ends_b = np.cumsum(self.a.sizes[ids_a]), np.cumsum(self.b.sizes[ids_b])
        ended = [np.zeros(int(ends_a[-1]) + 1, dtype=np.int8) for _ in range(2)]
        for ends, ids, vocabulary, marks in ((ends_a, ids_a, self.a, ended[0]), (ends_b, ids_b, self.b, ended[1])):
            # 1: a token ends here; 2: and the next one begins with a space.
            marks[ends] = 1
            marks[ends[:-1][vocabulary.spaced[ids[1:]]]] = 2
        anchor = (ended[0] == 2) & (ended[1] == 2)
        size = np.zeros(rows + 1, dtype=np.int64)
        np.add.at(size, np.repeat(np.arange(rows), counts_a) + 1, self.a.sizes[ids_a])
        last = np.cumsum(size)
        anchor[last[1:]] = True
        anchor[0] = False
        places = np.flatnonzero(anchor)
        keys = self._keys(ids_a, np.searchsorted(ends_a, places) + 1, ids_b, np.searchsorted(ends_b, places) + 1)
        return counts_a, counts_b, keys[0], keys[1], np.searchsorted(places, last, side="right")

    def _verified(self, texts: pa.Array, ids_a, counts_a, ids_b, counts_b) -> np.ndarray:
        """The texts that both tokenizers give back byte by byte."""
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = memoryview(texts.buffers()[2] or b"").cast("B")
        good = np.diff(offsets) > 0
        for vocabulary, ids, counts in ((self.a, ids_a, counts_a), (self.b, ids_b, counts_b)):
            shown, at = gathered(vocabulary.flat, vocabulary.begins, vocabulary.sizes, ids)
            at = at[np.concatenate([[0], np.cumsum(counts)])]
            shown = memoryview(shown)
            for i in np.flatnonzero(good).tolist():
                good[i] = shown[at[i] : at[i + 1]] == data[offsets[i] : offsets[i + 1]]
        return good

    def _keys(self, ids_a, stops_a, ids_b, stops_b) -> tuple[list[bytes], np.ndarray]:
        """Windows as the number of ids of the first, these, and those of the second."""
        n = len(stops_a)
        starts_a, starts_b = np.append(0, stops_a[:-1]), np.append(0, stops_b[:-1])
        sizes_a, sizes_b = stops_a - starts_a, stops_b - starts_b
        ends = np.cumsum(1 + sizes_a + sizes_b)
        begins = ends - (1 + sizes_a + sizes_b)
        mixed = np.empty(int(ends[-1]), dtype="<u4")
        mixed[begins] = sizes_a
        mixed[np.arange(len(ids_a)) + np.repeat(begins + 1 - starts_a, sizes_a)] = ids_a
        mixed[np.arange(len(ids_b)) + np.repeat(begins + 1 + sizes_a - starts_b, sizes_b)] = ids_b
        offsets = 4 * np.append(begins, ends[-1]).astype(np.int64)
        found = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(mixed)]
        ).dictionary_encode()
        return found.dictionary.to_pylist(), found.indices.to_numpy().astype(np.int64)


@lru_cache(maxsize=1)
def aligner(path_a: str, path_b: str) -> Aligner:
    return Aligner(path_a, path_b)


# ---- Blocks -------------------------------------------------------------------

TABLE = (
    "block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, windows binary, "
    "times binary, window_ends binary, window_pairs binary, base int, a array<int>, b array<int>, docs array<int>"
)
NAMES = [c.split()[0] for c in TABLE.split(", ")]


class _Block:
    """Documents of a block; their windows and pairs by numbers of the block."""

    def __init__(self):
        self.numbers: dict[bytes, int] = {}
        self.entries: list[tuple[int, int, str, bytes]] = []
        self.docs: list[dict] = []
        self.bytes = 0

    def add(self, align: Aligner, doc_ids: list, texts: pa.Array) -> None:
        self.bytes += texts.nbytes
        n_a, n_b, keys, which, at = align.windows(texts)
        fresh = [key for key in keys if key not in self.numbers]
        self.numbers |= zip(fresh, range(len(self.entries), len(self.entries) + len(fresh)))
        self.entries += align.aligned(fresh)
        numbers = np.fromiter(map(self.numbers.__getitem__, keys), np.int64, len(keys))
        which = numbers[which]
        shown = [self.entries[n][2] for n in numbers.tolist()]
        by_number = dict(zip(numbers.tolist(), shown))
        groups = np.array([e[0] for e in self.entries], dtype=np.int64)
        links = np.array([e[1] for e in self.entries], dtype=np.int64)
        for k, doc_id in enumerate(doc_ids):
            own = which[at[k] : at[k + 1]]
            text = ";".join([by_number[w] for w in own.tolist()])
            windows, times = np.unique(own, return_counts=True)
            self.docs.append(
                {
                    "doc_id": doc_id,
                    "n_a": int(n_a[k]),
                    "n_b": int(n_b[k]),
                    "n_groups": int((groups[windows] * times).sum()),
                    "n_links": int((links[windows] * times).sum()),
                    "groups_sha256": hashlib.sha256(text.encode()).hexdigest() if len(own) else "",
                    "windows": windows.astype("<u4").tobytes(),
                    "times": times.astype("<u4").tobytes(),
                }
            )

    def rows(self, block: int) -> Iterator[dict]:
        """A row per document, one with the pairs of the windows, and the pairs in rows of a bounded size."""
        for at in range(0, len(self.docs), 256):
            yield _rows(block, self.docs[at : at + 256])
        if not self.entries:
            return
        sizes = np.array([e[1] for e in self.entries], dtype=np.int64)
        pairs, places = np.unique(np.frombuffer(b"".join(e[3] for e in self.entries), "<i8"), return_inverse=True)
        ends = np.cumsum(sizes)
        begins = ends - sizes
        holding = np.zeros(len(pairs), dtype=np.int64)
        last = np.empty(len(pairs), dtype=np.int64)
        for doc in self.docs:
            own, _ = gathered(places, begins, sizes, np.frombuffer(doc["windows"], "<u4"))
            # Of equal numbers only the one written last finds its own place again.
            turn = np.arange(len(own))
            last[own] = turn
            holding[own[last[own] == turn]] += 1
        yield _rows(
            block,
            [{"window_ends": ends.astype("<u4").tobytes(), "window_pairs": places.astype("<u4").tobytes()}],
        )
        for at in range(0, len(pairs), ROW_PAIRS):
            part = pairs[at : at + ROW_PAIRS]
            row = {"base": at, "a": part >> 32, "b": part & 0xFFFFFFFF, "docs": holding[at : at + ROW_PAIRS]}
            yield _rows(block, [row])


def _rows(block: int, rows: list[dict]) -> dict:
    return {"block": [block] * len(rows)} | {c: [r.get(c) for r in rows] for c in NAMES[1:]}


def blocks(
    docs: DataFrame,
    tokenizer: str,
    model: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Documents encoded by both and aligned, in blocks. To be written before it is read:
    numbers of blocks come from the tasks."""

    def work(batches: Iterator[dict]) -> Iterator[dict]:
        align = aligner(tokenizer, model)
        number = TaskContext.get().partitionId() << 32
        block = _Block()
        for batch in batches:
            block.add(align, batch["doc_id"].to_pylist(), batch["text"])
            if block.bytes >= block_bytes:
                yield from block.rows(number)
                number, block = number + 1, _Block()
        if block.docs:
            yield from block.rows(number)

    return by_batch(id_and_text(docs, id_col, text_col), TABLE, work, arrays=True)


def _pairs(table: DataFrame) -> DataFrame:
    rows = table.where(F.col("base").isNotNull())
    zipped = rows.select("block", "base", F.posexplode(F.arrays_zip("a", "b", "docs")).alias("at", "pair"))
    return zipped.select("block", (F.col("base") + F.col("at")).alias("place"), "pair.*")


def pair_counts(table: DataFrame) -> DataFrame:
    """``a, b, n, best``: how many documents link each pair of ids, and whether no
    other id of the second tokenizer is linked with ``a`` in more documents."""
    counts = _pairs(table).groupBy("a", "b").agg(F.sum("docs").alias("n"))
    # An id has no more partners than the other vocabulary has ids.
    return counts.withColumn("best", F.col("n") == F.max("n").over(Window.partitionBy("a")))


RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def document_links(table: DataFrame, counts: DataFrame) -> DataFrame:
    """Documents with the sums of the counts of their links."""
    wanted = _pairs(table).select("block", "place", "a", "b").join(counts, ["a", "b"])
    known = wanted.select(F.col("block").alias("of_block"), "place", "n", "best")
    docs = table.where(F.col("base").isNull()).drop("base", "a", "b", "docs")
    kept = [c for c in NAMES[1:6]]

    def summed(left: pa.Table, right: pa.Table) -> pa.Table:
        is_doc = pc.is_valid(left.column("n_a"))
        own, links = left.filter(is_doc), left.filter(pc.invert(is_doc))
        counted = np.zeros((2, 0), dtype=np.int64)
        if links.num_rows:
            n = np.zeros((2, right.num_rows), dtype=np.int64)
            place = right.column("place").to_numpy()
            n[0, place], n[1, place] = right.column("n").to_numpy(), right.column("best").to_numpy()
            ends = np.frombuffer(links.column("window_ends")[0].as_py(), "<u4").astype(np.int64)
            pairs = np.frombuffer(links.column("window_pairs")[0].as_py(), "<u4")
            running = np.concatenate([np.zeros((2, 1), np.int64), np.cumsum(n[:, pairs], axis=1)], axis=1)
            counted = running[:, ends] - running[:, np.append(0, ends[:-1])]
        sums = np.zeros((2, own.num_rows), dtype=np.int64)
        for i, (windows, times) in enumerate(zip(own.column("windows"), own.column("times"))):
            at, often = (np.frombuffer(x.as_py(), "<u4") for x in (windows, times))
            sums[:, i] = (counted[:, at] * often).sum(axis=1)
        columns = [own.column(c) for c in kept]
        return pa.table(
            [*columns, pa.array(sums[1]), pa.array(sums[0]), own.column("groups_sha256")],
            names=[*kept, "n_best", "count_sum", "groups_sha256"],
        )

    return docs.groupBy("block").cogroup(known.groupBy("of_block")).applyInArrow(summed, RESULT)


def align(
    docs: DataFrame,
    tokenizer: str,
    model: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Per row of ``docs``: tokens of both, groups, links, links with the best count
    of their first id, the sum of the counts, and a digest of the groups.

    ``tokenizer`` is a byte-level BPE, ``model`` a sentencepiece model that puts
    a space before each text, as is done here for the first. Null and empty
    texts, and those that a tokenizer does not give back byte by byte, have
    zeros and an empty digest. Rows of equal or null id are documents of their
    own, each counts. An empty table gives no rows; other columns are not
    looked at. A document is in one block, however long it is.
    """
    table = written(blocks(docs, tokenizer, model, id_col, text_col, block_bytes))
    return document_links(table, pair_counts(table))
