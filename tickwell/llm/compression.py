"""Quality scores from how well two zstandard dictionaries compress a text.

One dictionary is built from texts labelled good and one from texts labelled
bad. A text that the good one compresses better is probably good. The
difference of the two sizes, normalised by the length and by the larger size,
and how far the text compresses at all, become a probability by a logistic
fit on labelled texts that the dictionaries have not seen.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwell.llm.labelled import Logistic, fold, sample, shift
from tickwell.llm.tables import by_batch, id_and_text

DICTIONARY_BYTES = 112_640
LEVEL = 3
#: Bounds of the sample: rows of each label, and bytes of all texts together.
PER_CLASS = 2_000
MAX_BYTES = 32 << 20


def dictionary(texts: list[bytes], size: int = DICTIONARY_BYTES) -> zstandard.ZstdCompressionDict:
    """A trained dictionary; the texts themselves where there are too few to train on."""
    try:
        return zstandard.train_dictionary(size, texts, level=LEVEL)
    except zstandard.ZstdError:
        raw = b"\n".join(texts)[-size:].rjust(8, b"\n")
        return zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)


class Sizes:
    """Compressed sizes of texts under both dictionaries."""

    def __init__(self, good: zstandard.ZstdCompressionDict, bad: zstandard.ZstdCompressionDict):
        # Size and checksum of the content would only add to both sides alike.
        self.sides = [
            zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_checksum=False, write_content_size=False)
            for d in (good, bad)
        ]

    def figures(self, texts: list[bytes]) -> np.ndarray:
        good, bad = (np.array([len(c.compress(t)) for t in texts], dtype=float) for c in self.sides)
        length = np.array([max(1, len(t)) for t in texts], dtype=float)
        gap = bad - good
        by_length, by_size = gap / length, gap / np.maximum(good, bad)
        ratio, log_length = np.minimum(good, bad) / length, np.log(length)
        return np.column_stack(
            [by_length, by_size, ratio, log_length, by_length * ratio, by_length * log_length, ratio * log_length]
        )


class Model:
    """Two dictionaries and the calibration of their difference."""

    def __init__(self, rows: list[tuple[int, str, int]], totals: list[int] | None = None):
        texts = [(t.encode(), y) for _, t, y in rows]
        sides = [[t for t, y in texts if y == label] for label in (1, 0)]
        zeros, ones = totals or (len(sides[1]), len(sides[0]))
        self.prior = (ones + 1) / (zeros + ones + 2)
        self.raw = None
        if min(map(len, sides)) < 4:
            return
        # Of each class two thirds build the dictionary and one third calibrates.
        built = [[t for i, t in enumerate(side) if i % 3] for side in sides]
        unseen = [(t, y) for side, y in zip(sides, (1, 0)) for t in side[::3]]
        dictionaries = [dictionary(b) for b in built]
        self.raw = [(d.as_bytes(), d.dict_id()) for d in dictionaries]
        figures = Sizes(*dictionaries).figures([t for t, _ in unseen])
        y = np.array([y for _, y in unseen])
        fitted = Logistic(figures, y.astype(float), ridge=0.05)
        self.calibrate = fitted.moved(shift(np.bincount(y, minlength=2), totals))
        self.sizes: Sizes | None = None

    def __getstate__(self):
        return self.__dict__ | {"sizes": None}

    def scores(self, texts: list[str]) -> np.ndarray:
        """Probability that the label is 1; the share of such labels if there were too few to learn from."""
        if self.raw is None:
            return np.full(len(texts), self.prior)
        if self.sizes is None:
            kinds = [zstandard.DICT_TYPE_FULLDICT if i else zstandard.DICT_TYPE_RAWCONTENT for _, i in self.raw]
            made = [zstandard.ZstdCompressionDict(b, dict_type=k) for (b, _), k in zip(self.raw, kinds)]
            self.sizes = Sizes(*made)
        return self.calibrate(self.sizes.figures([t.encode() for t in texts]))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", per_class: int = PER_CLASS, max_bytes: int = MAX_BYTES) -> Model:
    return Model(*sample(docs, labels, label, per_class, max_bytes))


def score_quality(
    docs: DataFrame,
    model: Model,
    threshold: float = 0.3,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row; null texts are scored as empty ones."""

    def work(pieces: Iterator[dict]) -> Iterator[dict]:
        for piece in pieces:
            yield {"doc_id": piece["doc_id"], "score": model.scores(piece["text"])}

    rows = by_batch(id_and_text(docs, id_col, text_col), "doc_id long, score double", work)
    return rows.select(
        "doc_id",
        (fold("doc_id") == 0).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
