"""Test items in training texts: a BM25 index of the items, queried with every passage of every text.

The index holds, for each term, the items it occurs in with their BM25 weight,
and for each block of items the greatest weight. Weights are divided by the
score that an item has with itself, so one threshold serves all items. The
greatest weights of a passage's terms bound every score in a block; only
blocks whose bound reaches the threshold are scored. Items found are then
verified: enough of the word runs of their question and of their answer must
stand in the passage. Where an item has no answer of its own column, nearly
all of its words in order are enough too, and if it ends in a fragment the
runs of the whole item are compared. Items too short for that are found by
their exact word sequence.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwell.llm.tables import by_batch, filtered, id_and_text, written
from tickwell.llm.words import words_of as spaced_words

K1, B = 1.2, 0.75
THRESHOLD = 0.5
OVERLAP = 0.5
RUN = 5
#: An item without an answer column is also found by so much of its words, in order.
NEARLY_ALL = 0.9
LEAST_WORDS = 5
ITEM_BLOCK = 8
#: Items are indexed and searched so many at a time; more items take more passes over the texts.
ITEMS_AT_ONCE = 2_000
#: Terms of passages whose bounds are held at once.
SLICE_TERMS = 1 << 15
_SENTENCE = re.compile(r"(?<=[.!?])\s+|(?<=[。！？])")
#: Thai, Lao, Burmese, Khmer, kana and Han are written without spaces; each character is a word.
_UNSPACED = re.compile("([\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3000-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff])")


def words_of(text: str) -> list[bytes]:
    """Words; of scripts without spaces, characters."""
    return spaced_words(text if text.isascii() else _UNSPACED.sub(r" \1 ", text))


def question_and_answer(text: str) -> tuple[list[bytes], list[bytes]]:
    """The last sentence is the answer; of a single sentence, the last third of its words."""
    sentences = [s for s in map(words_of, _SENTENCE.split(text)) if s]
    if len(sentences) > 1:
        return [w for s in sentences[:-1] for w in s], sentences[-1]
    words = sentences[0] if sentences else []
    cut = len(words) - max(1, len(words) // 3)
    return words[:cut], words[cut:]


def runs(words: list[bytes], size: int) -> set[tuple[bytes, ...]]:
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def overlap(part: list[bytes], passage: list[bytes]) -> float:
    """Share of the runs of ``part`` that stand in the passage; 1 for an empty part."""
    size = min(RUN, len(part))
    if not size:
        return 1.0
    wanted = runs(part, size)
    return len(wanted & runs(passage, size)) / len(wanted)


def in_order(part: list[bytes], passage: list[bytes]) -> int:
    """Most words of ``part`` that stand in the passage in the same order (bit-parallel)."""
    places: dict[bytes, int] = {}
    for i, word in enumerate(part):
        places[word] = places.get(word, 0) | 1 << i
    full = (1 << len(part)) - 1
    open_ = full
    for word in passage:
        hit = open_ & places.get(word, 0)
        open_ = (open_ + hit | open_ - hit) & full
    return len(part) - open_.bit_count()


class Item(NamedTuple):
    id: int | None
    question: list[bytes]
    answer: list[bytes]
    #: Whether question and answer are columns of the table, not cut from one text.
    told: bool = False
    #: Whether the text ends in a sentence too short to be an answer.
    fragment: bool = False

    def stands(self, question: float, answer: float, passage: list[bytes], least: float) -> bool:
        """Whether the passage has the item, given the overlaps of question and answer."""
        if question >= least and answer >= least:
            return True
        if self.told:
            return False
        whole = overlap(self.words, passage)
        if self.fragment and whole >= least:
            return True
        return whole > 0 and in_order(self.words, passage) >= max(least, NEARLY_ALL) * len(self.words)

    @property
    def words(self) -> list[bytes]:
        return self.question + self.answer


class Statistics(NamedTuple):
    """Of all items that are indexed, in whichever index: how many there are, their
    mean and greatest number of words, and how many hold each word."""

    n: int
    mean: float
    longest: int
    frequency: dict[bytes, int]

    @classmethod
    def of(cls, items: list[Item]) -> Statistics:
        lengths = [len(i.words) for i in items if len(i.words) >= LEAST_WORDS]
        held = Counter(w for i in items if len(i.words) >= LEAST_WORDS for w in set(i.words))
        return cls(len(lengths), sum(lengths) / len(lengths) if lengths else 1.0, max(lengths, default=1), held)


class Index:
    """BM25 postings of items, relative to each item's own score, with maxima by block.

    Without ``statistics`` the items are all there are.
    """

    def __init__(self, items: list[Item], block: int = ITEM_BLOCK, statistics: Statistics | None = None):
        statistics = statistics or Statistics.of(items)
        #: Items under ``LEAST_WORDS`` words, by their first word.
        self.short: dict[bytes, list[Item]] = {}
        for item in items:
            if 0 < len(item.words) < LEAST_WORDS:
                self.short.setdefault(item.words[0], []).append(item)
        items = [i for i in items if len(i.words) >= LEAST_WORDS]
        # Items with the same rare words next to each other make blocks with small maxima elsewhere.
        self.items = sorted(items, key=lambda i: (sorted(i.words, key=len)[-3:], i.id or 0))
        self.columns = {w: j for j, w in enumerate(sorted({w for i in items for w in i.words}))}
        n = len(items)
        found: list[dict[int, float]] = []
        for item in self.items:
            ids, counts = np.unique([self.columns[w] for w in item.words], return_counts=True)
            room = K1 * (1 - B + B * len(item.words) / statistics.mean)
            found.append(dict(zip(ids.tolist(), (counts * (K1 + 1) / (counts + room)).tolist())))
        frequency = np.array([statistics.frequency[w] for w in self.columns], dtype=float)
        idf = np.log1p((statistics.n - frequency + 0.5) / (frequency + 0.5))
        # Row 0 stands for words that no item has.
        self.maxima = np.zeros((len(self.columns) + 1, -(-n // block)), dtype=np.float32)
        self.rows: list[np.ndarray] = []
        self.postings: list[np.ndarray] = []
        for b, first in enumerate(range(0, n, block)):
            part = found[first : first + block]
            terms = sorted(set().union(*part))
            row = np.zeros(len(self.columns) + 1, dtype=np.int32)
            row[np.array(terms) + 1] = np.arange(1, len(terms) + 1)
            table = np.zeros((len(terms) + 1, len(part)), dtype=np.float32)
            for i, weights in enumerate(part):
                own = sum(idf[t] * w for t, w in weights.items())
                for t, w in weights.items():
                    table[row[t + 1], i] = idf[t] * w / own
            self.maxima[np.array(terms) + 1, b] = table[1:].max(1)
            self.rows.append(row)
            self.postings.append(table)
        self.block = block
        #: Every run of words as long as the longest item lies within one passage.
        self.stride = statistics.longest

    def search(self, words: list[bytes], threshold: float) -> Iterator[tuple[int, int, int, float]]:
        """Start and end of a passage, position and relative score of each item that reaches the threshold.

        Passages are two strides long and begin one stride apart.
        """
        if not self.items or not words:
            return
        get = self.columns.get
        ids = np.array([get(w, -1) for w in words], dtype=np.int64) + 1
        at = np.flatnonzero(ids)
        n_passages = max(1, -(-len(words) // self.stride) - 1)
        last = np.minimum(at // self.stride, n_passages - 1)
        before = np.maximum(at // self.stride - 1, 0)
        size = len(self.columns) + 1
        keys = np.unique(np.concatenate([last * size + ids[at], before * size + ids[at]]))
        if not len(keys):
            return
        of, terms = keys // size, keys % size
        passages, first = np.unique(of, return_index=True)
        ends = np.append(first[1:], len(keys))
        # However long the text is, bounds are held for some passages at a time.
        slices = np.searchsorted(ends, np.arange(SLICE_TERMS, len(keys) + SLICE_TERMS, SLICE_TERMS))
        for begin, stop in zip(np.append(0, slices), np.append(slices, len(passages))):
            if begin == stop:
                continue
            at = slice(first[begin], ends[stop - 1])
            bounds = np.add.reduceat(self.maxima[terms[at]], first[begin:stop] - first[begin], axis=0)
            for i, b in zip(*np.nonzero(bounds >= threshold - 1e-4)):
                i += begin
                table = self.postings[b]
                scores = table[self.rows[b][terms[first[i] : ends[i]]]].sum(0)
                start = int(passages[i]) * self.stride
                for j in np.flatnonzero(scores >= threshold - 1e-6):
                    yield start, start + 2 * self.stride, int(b * self.block + j), round(float(scores[j]), 6)

    def leaks(self, text: str, threshold: float, least: float) -> list[tuple]:
        """``(item, score, question overlap, answer overlap, passage start)`` of each verified item."""
        words = words_of(text)
        best: dict[int, tuple] = {}
        for start, end, at, score in self.search(words, threshold):
            item = self.items[at]
            question = overlap(item.question, words[start:end])
            answer = overlap(item.answer, words[start:end])
            found = (score, question, answer, start)
            if found[:3] > best.get(at, (0, 0, 0))[:3] and item.stands(question, answer, words[start:end], least):
                best[at] = found
        return [(self.items[at].id, *found) for at, found in sorted(best.items())] + self.short_leaks(words)

    def short_leaks(self, words: list[bytes]) -> list[tuple]:
        """The short items whose words stand in the text one after the other, at the first such place."""
        first: dict[int, tuple] = {}
        for start in [i for i, w in enumerate(words) if w in self.short] if self.short else []:
            for item in self.short[words[start]]:
                if words[start : start + len(item.words)] == item.words:
                    first.setdefault(id(item), (item.id, 1.0, 1.0, 1.0, start))
        return list(first.values())


RESULT = (
    "doc_id long, item_id long, score double, question_overlap double, answer_overlap double, passage_start long"
)


def indexes(
    items: DataFrame,
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    question_col: str | None = None,
    answer_col: str | None = None,
) -> Iterator[Index]:
    """An index for every ``ITEMS_AT_ONCE`` items; at least one, if an empty one.

    Scores and passages are those of one index over all items: what they depend
    on besides the item itself is summed up over all items first.
    """
    parts = [F.col(c).cast("string") for c in (question_col, answer_col) if c] or [F.col(item_text_col).cast("string")]
    table = items.select(
        F.col(item_id_col).cast("long").alias("item_id"),
        F.array(*[F.coalesce(p, F.lit("")) for p in parts]).alias("parts"),
    )
    blocks = max(1, -(-table.count() // ITEMS_AT_ONCE))
    numbered = table.withColumn("block", F.pmod(F.xxhash64("item_id", "parts"), F.lit(blocks)))

    def part(b: int) -> list[Item]:
        rows = numbered.where(F.col("block") == b).orderBy("item_id", "parts").collect()
        return [_item(r["item_id"], r["parts"]) for r in rows]

    if blocks == 1:
        yield Index(part(0))
        return

    def words(pieces: Iterator[dict]) -> Iterator[dict]:
        for piece in pieces:
            found = [_item(None, texts).words for texts in piece["parts"].to_pylist()]
            yield {"block": piece["block"], "n": list(map(len, found)), "words": [list(set(w)) for w in found]}

    counted = by_batch(numbered.select("block", "parts"), "block long, n long, words array<binary>", words)
    counted = written(counted.where(F.col("n") >= LEAST_WORDS))
    n, mean, longest = counted.agg(F.count("*"), F.avg("n"), F.max("n")).first()
    held = counted.select("block", F.explode("words").alias("word"))
    frequency = written(held.groupBy("word").agg(F.count("*").alias("n")))
    for b in range(blocks):
        # No more words than the items of one index have.
        own = frequency.join(held.where(F.col("block") == b).select("word").distinct(), "word").collect()
        of_all = Statistics(n, mean or 1.0, longest or 1, {bytes(r["word"]): r["n"] for r in own})
        yield Index(part(b), statistics=of_all)


def _item(item_id: int | None, parts: list[str]) -> Item:
    if len(parts) == 2:
        return Item(item_id, words_of(parts[0]), words_of(parts[1]), told=True)
    question, answer = question_and_answer(parts[0])
    several = sum(1 for s in _SENTENCE.split(parts[0]) if words_of(s)) > 1
    return Item(item_id, question, answer, fragment=several and len(answer) < RUN)


def find_leaks(
    docs: DataFrame,
    items: DataFrame,
    threshold: float = THRESHOLD,
    least_overlap: float = OVERLAP,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    question_col: str | None = None,
    answer_col: str | None = None,
) -> DataFrame:
    """One row per row of ``docs`` and item that it contains.

    Columns as in ``RESULT``; texts without an item have no row. Question and
    answer come from their own columns if these are named, else from the text
    of the item. Items of fewer than five words are found by their exact word
    sequence, items without any word are in no text; null texts are empty. The items are a stated query set:
    they are indexed ``ITEMS_AT_ONCE`` at a time.
    """
    texts = id_and_text(docs, id_col, text_col)
    out = None
    for index in indexes(items, item_id_col, item_text_col, question_col, answer_col):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def work(pieces: Iterator[dict], shared=shared) -> Iterator[dict]:
            names = [f.split()[0] for f in RESULT.split(", ")]
            for piece in pieces:
                found = [
                    (doc_id, *leak)
                    for doc_id, text in zip(piece["doc_id"].to_pylist(), piece["text"])
                    for leak in shared.value.leaks(text, threshold, least_overlap)
                ]
                if found:
                    yield dict(zip(names, map(list, zip(*found))))

        part = by_batch(texts, RESULT, work)
        out = part if out is None else out.unionByName(part)
    return out


def drop_leaks(
    docs: DataFrame,
    items: DataFrame,
    threshold: float = THRESHOLD,
    least_overlap: float = OVERLAP,
    text_col: str = "text",
    **item_columns,
) -> DataFrame:
    """The rows of ``docs`` that contain no test item, with all their columns."""
    for index in indexes(items, **item_columns):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def clean(texts: list[str], shared=shared) -> list[bool]:
            return [not shared.value.leaks(t, threshold, least_overlap) for t in texts]

        docs = filtered(docs, text_col, clean)
    return docs
