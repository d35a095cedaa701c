"""Toxicity by the nearest labelled examples, found exactly with a block-max index of all words.

Examples and documents are unit TF-IDF vectors over all words of the examples;
each word also weighs as much as its presence differs between the labels
(log-likelihood ratio), for over plain TF-IDF chance words decide. No word is
left out, so a small sample has its vocabulary too.

Examples lie in blocks, and each word has its greatest weight in each block.
These bound the cosines of a text with all examples of a block: the blocks of
highest bound are scored first and give the k-th best cosine; of the others
only those are scored whose bound reaches it. Words of many examples lie in a
dense table, all others in postings by word and block. Votes of the k nearest,
weighted by cosine, are calibrated on the examples themselves, each one left
out of its own vote.
"""

from __future__ import annotations

import hashlib
import math
import pickle
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwell.llm.labelled import Logistic, fold, sample_table, shift
from tickwell.llm.tables import by_batch, filtered, id_and_text
from tickwell.llm.words import words_of

K = 15
#: Examples in a block, queries that are compared at a time, and blocks that are scored first.
BLOCK = 128
QUERIES = 64
FIRST_BLOCKS = 4
#: Words in this share of the examples lie in the dense table.
DENSE_SHARE = 1 / 8
#: Bounds of the sample: rows of each label, and bytes of all texts together.
PER_CLASS = 3_000
MAX_BYTES = 32 << 20
#: Cosines are told apart, and ties seen, to so many digits.
DIGITS = 6


def ratio(with_: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Log-likelihood ratio of terms found in ``with_[label]`` of ``of[label]`` examples."""
    total = of.sum()
    found = with_.sum(0)
    out = np.zeros(with_.shape[1])
    for label in (0, 1):
        for seen, all_seen in ((with_[label], found), (of[label] - with_[label], total - found)):
            expected = all_seen * of[label] / total
            out += 2 * seen * np.log(np.where(seen > 0, seen, 1) / np.where(expected > 0, expected, 1))
    return np.maximum(out, 0)


class Rows(NamedTuple):
    """Sparse vectors: those of row i are at ``starts[i]`` to ``starts[i + 1]``."""

    starts: np.ndarray
    columns: np.ndarray
    weights: np.ndarray

    def __getitem__(self, rows: slice) -> Rows:
        at, end = self.starts[rows.start], self.starts[min(rows.stop, len(self.starts) - 1)]
        return Rows(self.starts[rows.start : rows.stop + 1] - at, self.columns[at:end], self.weights[at:end])

    def of(self) -> np.ndarray:
        """The row of each entry."""
        return np.repeat(np.arange(len(self.starts) - 1), np.diff(self.starts))

    def unit(self) -> Rows:
        sums = np.bincount(self.of(), self.weights.astype(np.float64) ** 2, len(self.starts) - 1)
        norms = np.sqrt(np.where(sums > 0, sums, 1))
        return self._replace(weights=(self.weights / norms[self.of()]).astype(np.float32))

    def any(self) -> np.ndarray:
        return np.bincount(self.of(), self.weights > 0, len(self.starts) - 1) > 0


def sparse(vectors: np.ndarray | Rows) -> Rows:
    if not isinstance(vectors, np.ndarray):
        return vectors
    rows, columns = np.nonzero(vectors)
    starts = np.searchsorted(rows, np.arange(len(vectors) + 1))
    return Rows(starts, columns.astype(np.int32), vectors[rows, columns].astype(np.float32))


class Index:
    """Unit vectors by word and block, with the greatest weight of each word in each block.

    ``scored`` and ``skipped`` count pairs of a query and a block.
    """

    def __init__(self, vectors: np.ndarray | Rows, ids: np.ndarray, labels: np.ndarray, block: int = BLOCK):
        vectors = sparse(vectors)
        # Alike examples share blocks, so that bounds are tight: first by label, then by their heaviest word.
        of = vectors.of()
        heaviest = np.full(len(ids), -1, dtype=np.int64)
        by_weight = np.lexsort((vectors.weights, of))
        ends = np.cumsum(np.bincount(of, minlength=len(ids)))
        some = np.diff(np.append(0, ends)) > 0
        heaviest[some] = vectors.columns[by_weight[ends[some] - 1]]
        order = np.lexsort((ids, heaviest, labels))
        place = np.empty(len(order), dtype=np.int32)
        place[order] = np.arange(len(order))
        self.ids, self.labels = ids[order], labels[order].astype(np.float64)
        self.block, self.n_blocks = block, -(-len(order) // block)
        self.width = int(vectors.columns.max(initial=-1)) + 1
        places = place[of]
        by_word = np.lexsort((places, vectors.columns))
        self.words, self.places, self.weights = (x[by_word] for x in (vectors.columns, places, vectors.weights))
        self._tables()

    def _tables(self) -> None:
        starts = np.searchsorted(self.words, np.arange(self.width + 1))
        common = np.flatnonzero(np.diff(starts) > max(1, DENSE_SHARE * len(self.ids)))
        self.row = np.full(self.width, -1, dtype=np.int32)
        self.row[common] = np.arange(len(common))
        self.table = np.zeros((len(common), self.n_blocks * self.block))
        for row, word in enumerate(common.tolist()):
            of = slice(starts[word], starts[word + 1])
            self.table[row, self.places[of]] = self.weights[of]
        self.table_best = self.table.reshape(len(common), self.n_blocks, self.block).max(axis=2)
        # Cells: the postings of one word in one block lie together.
        cell = self.words.astype(np.int64) * self.n_blocks + self.places // self.block
        begins = np.flatnonzero(np.diff(cell, prepend=-1))
        self.cell_starts = np.append(begins, len(cell))
        self.cell_block = self.places[begins] // self.block
        self.cell_best = np.maximum.reduceat(self.weights, begins) if len(begins) else np.empty(0, np.float32)
        self.word_cells = np.searchsorted(self.words[begins], np.arange(self.width + 1))
        self.scored = self.skipped = 0

    def __getstate__(self):
        kept = ("ids", "labels", "block", "n_blocks", "width", "words", "places", "weights")
        return {k: self.__dict__[k] for k in kept}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._tables()

    def nearest(self, queries: np.ndarray | Rows, k: int, skip: np.ndarray | None = None):
        """Cosines and positions of the ``k`` best examples of each query; ``skip`` leaves out one id each.

        Of equal cosines the smaller id comes first. Positions without an example are -1.
        """
        queries = sparse(queries)
        n = len(queries.starts) - 1
        best = np.full((n, k), -1.0, dtype=np.float32)
        at = np.full((n, k), -1, dtype=np.int64)
        if not len(self.ids):
            return best, at
        for start in range(0, n, QUERIES):
            found = self._found(queries[start : start + QUERIES], k, None if skip is None else skip[start : start + QUERIES])
            least = np.partition(found, -k, axis=1)[:, -k] if k <= found.shape[1] else np.zeros(len(found))
            for i, (row, bound) in enumerate(zip(found, least), start):
                places = np.flatnonzero((row >= bound) & (row > 0))
                places = places[np.lexsort((self.ids[places], -row[places]))][:k]
                best[i, : len(places)] = row[places]
                at[i, : len(places)] = places
        return best, at

    def _found(self, queries: Rows, k: int, skip: np.ndarray | None) -> np.ndarray:
        """Cosines with the examples of all blocks that can hold one of the ``k`` best; 0 with those of others."""
        n, of = len(queries.starts) - 1, queries.of()
        known = queries.columns < self.width
        of, words, weights = of[known], queries.columns[known], queries.weights[known].astype(np.float64)
        row = self.row[words]
        dense = np.zeros((n, len(self.table)))
        dense[of[row >= 0], row[row >= 0]] = weights[row >= 0]
        of, words, weights = of[row < 0], words[row < 0], weights[row < 0]
        # All cells of all rare words of all queries, one after the other.
        sizes = self.word_cells[words + 1] - self.word_cells[words]
        cells = _ranges(self.word_cells[words], sizes)
        of, weights = np.repeat(of, sizes), np.repeat(weights, sizes)
        blocks = self.cell_block[cells]
        keys = of * self.n_blocks + blocks
        bounds = np.bincount(keys, weights * self.cell_best[cells], n * self.n_blocks).astype(float).reshape(n, -1)
        bounds += dense @ self.table_best
        # Cosines are rounded, so a bound is a little too high.
        bounds = np.where(bounds > 0, bounds + 10.0**-DIGITS, 0)
        first = np.zeros((n, self.n_blocks), dtype=bool)
        m = min(FIRST_BLOCKS, self.n_blocks)
        np.put_along_axis(first, np.argpartition(-bounds, m - 1, axis=1)[:, :m], True, axis=1)
        first &= bounds > 0
        found = np.zeros((n, self.n_blocks * self.block))

        def score(wanted: np.ndarray) -> None:
            asked = wanted.ravel()[keys]
            own, begins = cells[asked], self.cell_starts[cells[asked]]
            sizes = self.cell_starts[own + 1] - begins
            at = _ranges(begins, sizes)
            place = np.repeat(of[asked] * found.shape[1], sizes) + self.places[at]
            found.ravel()[:] += np.bincount(place, np.repeat(weights[asked], sizes) * self.weights[at], found.size)
            for block in np.flatnonzero(wanted.any(axis=0)).tolist():
                rows, columns = np.flatnonzero(wanted[:, block]), slice(block * self.block, (block + 1) * self.block)
                found[rows, columns] += dense[rows] @ self.table[:, columns]
            self.scored += int(wanted.sum())

        score(first)
        seen = np.round(found[:, : len(self.ids)], DIGITS)
        if skip is not None:
            seen[self.ids[None, :] == skip[:, None]] = 0
        last = np.partition(seen, -k, axis=1)[:, -k] if k <= seen.shape[1] else np.zeros(n)
        rest = ~first & (bounds >= last[:, None]) & (bounds > 0)
        score(rest)
        self.skipped += int((~first & ~rest).sum())
        found = np.round(found[:, : len(self.ids)], DIGITS)
        if skip is not None:
            found[self.ids[None, :] == skip[:, None]] = 0
        return found


def _ranges(begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers from each begin on, so many of each, one after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(begins - ends + sizes, sizes)


class Model:
    """Weights of the words, the index over the examples, and the calibration of votes."""

    def __init__(self, rows: list[tuple[int, str, int]], totals: list[int] | None = None, k: int = K):
        self.k = k
        y = np.array([label for _, _, label in rows], dtype=int)
        of = np.bincount(y, minlength=2).astype(float)
        zeros, ones = totals or of
        self.prior = (ones + 1) / (zeros + ones + 2)
        self.columns: dict[bytes, int] = {}
        self.calibrate = None
        if not of.all():
            return
        bags = self._bags([text for _, text, _ in rows], learn=True)
        with_ = np.array([np.bincount(bags.columns[y[bags.of()] == label], minlength=len(self.columns)) for label in (0, 1)])
        self.weights = np.log1p(len(rows) / np.maximum(with_.sum(0), 1)) * ratio(with_.astype(float), of)
        ids = np.array([i for i, _, _ in rows], dtype=np.int64)
        vectors = self._weighted(bags)
        told = vectors.any()
        if not told.any():
            return
        kept = np.flatnonzero(told)
        # Rows without any weight have no entries.
        vectors = Rows(np.append(vectors.starts[:-1][kept], vectors.starts[-1]), vectors.columns, vectors.weights)
        self.index = Index(vectors, ids[told], y[told])
        cosines, at = self.index.nearest(vectors, k, skip=ids[told])
        figures = self._figures(cosines, at)
        log_odds = shift(of, totals)
        self.calibrate = Logistic(figures, y[told].astype(float), ridge=0.5).moved(log_odds)
        # Texts without any word of the examples have no neighbour; their share of toxic ones is their score
        # (with one more half as toxic as the sample, so that few such examples say little).
        rate = (y[~told].sum() + 0.5 * y.mean()) / ((~told).sum() + 1)
        odds = rate / (1 - rate) * math.exp(log_odds)
        self.silent = odds / (1 + odds)

    def _bags(self, texts: list[str], learn: bool = False) -> Rows:
        """Counts of known words; ``learn`` makes all words known."""
        columns, counts, starts = [], [], [0]
        for text in texts:
            bag = Counter(words_of(text))
            if learn:
                for word in bag:
                    self.columns.setdefault(word, len(self.columns))
            found = [(self.columns[w], n) for w, n in bag.items() if w in self.columns]
            found.sort()
            columns.append(np.array([c for c, _ in found], dtype=np.int32))
            counts.append(np.array([n for _, n in found], dtype=np.float32))
            starts.append(starts[-1] + len(found))
        none = [np.empty(0, np.int32)], [np.empty(0, np.float32)]
        return Rows(np.array(starts), np.concatenate(columns or none[0]), np.concatenate(counts or none[1]))

    def _weighted(self, bags: Rows) -> Rows:
        weights = (1 + np.log(bags.weights)) * self.weights[bags.columns]
        some = weights > 0
        starts = np.append(0, np.cumsum(some))[bags.starts]
        return Rows(starts, bags.columns[some], weights[some]).unit()

    def vectors(self, texts: list[str]) -> Rows:
        return self._weighted(self._bags(texts))

    def _figures(self, cosines: np.ndarray, at: np.ndarray) -> np.ndarray:
        weights = np.where(at >= 0, np.maximum(cosines, 0), 0).astype(np.float64)
        votes = np.where(at >= 0, self.index.labels[at], 0)
        total = weights.sum(1)
        share = (weights * votes).sum(1) / np.where(total > 0, total, 1)
        return np.column_stack([share, weights[:, 0], total / self.k])

    def score(self, texts: list[str]) -> tuple[np.ndarray, list[list[int]], list[list[float]]]:
        """Scores, and as evidence the ids and cosines of the nearest examples."""
        if self.calibrate is None:
            return np.full(len(texts), self.prior), [[] for _ in texts], [[] for _ in texts]
        cosines, at = self.index.nearest(self.vectors(texts), self.k)
        scores = np.where(at[:, 0] >= 0, self.calibrate(self._figures(cosines, at)), self.silent)
        ids = [[int(self.index.ids[p]) for p in row if p >= 0] for row in at]
        return scores, ids, [[float(c) for c in row[: len(i)]] for row, i in zip(cosines, ids)]


class Packed:
    """A model as bytes; each task opens it once."""

    def __init__(self, data: bytes):
        self.data, self.name = data, hashlib.sha256(data).hexdigest()

    def opened(self) -> Model:
        if self.name not in _OPEN:
            _OPEN.clear()
            _OPEN[self.name] = pickle.loads(self.data)
        return _OPEN[self.name]

    def score(self, texts: list[str]) -> tuple[np.ndarray, list[list[int]], list[list[float]]]:
        return self.opened().score(texts)

    @staticmethod
    def close() -> None:
        """A worker goes on with other work and should not hold the model."""
        _OPEN.clear()


_OPEN: dict[str, Model] = {}


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", per_class: int = PER_CLASS, max_bytes: int = MAX_BYTES) -> Packed:
    """The model of a bounded sample, built by one task; the driver only hands it on."""
    rows, totals = sample_table(docs, labels, label, per_class, max_bytes)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        examples = [row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns))]
        packed = pickle.dumps(Model(examples, totals))
        yield pa.RecordBatch.from_arrays([pa.array([packed], pa.binary())], names=["model"])

    # A table of a bounded size.
    ordered = rows.coalesce(1).sortWithinPartitions("_turn", "_y").select("_id", "_t", "_y")
    built = ordered.mapInArrow(build, "model binary").first()
    # A table without any rows may have no part at all, and so no task.
    return Packed(bytes(built["model"]) if built else pickle.dumps(Model([], totals)))


def score_toxicity(
    docs: DataFrame,
    model: Model | Packed,
    threshold: float = 0.5,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, held_out, score, predicted, neighbours, cosines`` of every row.

    Null texts count as empty; texts without any word of the examples get
    the share of toxic ones among such examples and have no neighbours.
    """
    schema = "doc_id long, score double, neighbours array<long>, cosines array<float>"

    def work(pieces: Iterator[dict]) -> Iterator[dict]:
        for piece in pieces:
            scores, ids, cosines = model.score(piece["text"])
            yield {"doc_id": piece["doc_id"], "score": scores, "neighbours": ids, "cosines": cosines}
        Packed.close()

    rows = by_batch(id_and_text(docs, id_col, text_col), schema, work)
    return rows.select(
        "doc_id",
        (fold("doc_id") == 0).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
        "neighbours",
        "cosines",
    )


def drop_toxic(docs: DataFrame, model: Model | Packed, threshold: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose score is below the threshold, with all their columns."""
    return filtered(docs, text_col, lambda texts: model.score(texts)[0] < threshold, Packed.close)
