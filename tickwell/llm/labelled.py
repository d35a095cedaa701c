"""Bounded samples of labelled texts for fitting."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickwell.llm.tables import written

FOLDS = 5
#: One text has at most this share of the bytes of a sample.
TEXT_SHARE = 0.01


def fold(id_col: Column | str) -> Column:
    """The fold of a document; rows of fold 0 are never learned from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string") if isinstance(id_col, str) else id_col.cast("string")) % FOLDS, F.lit(0))


def sample(
    docs: DataFrame,
    labels: DataFrame,
    label: str,
    per_class: int,
    max_bytes: int,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> tuple[list[tuple[int, str, int]], list[int]]:
    """The rows of ``sample_table`` as ``(id, text, label)``, and the numbers of all."""
    rows, totals = sample_table(docs, labels, label, per_class, max_bytes, id_col, text_col)
    ordered = rows.orderBy("_turn", "_y").select("_id", "_t", "_y").collect()
    return [tuple(r) for r in ordered], totals


def sample_table(
    docs: DataFrame,
    labels: DataFrame,
    label: str,
    per_class: int,
    max_bytes: int,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> tuple[DataFrame, list[int]]:
    """``_id, _t, _y, _turn``: id, text, label and place of some rows, and the
    number of all usable rows of label 0 and 1.

    There are at most ``per_class`` rows of each label and ``max_bytes`` of text in all. Texts above
    ``TEXT_SHARE`` of that count with their beginning, so no row ends the sample. Rows are taken in the order of a hash of their id, so the sample does not
    depend on how the tables are stored; fold 0, null labels and empty texts
    are left out. Labels are chosen before texts are read: the texts are found
    by a broadcast of at most ``2 * per_class`` ids.
    """
    usable = labels.select(F.col(id_col).cast("long").alias("_id"), F.col(label).cast("int").alias("_y"))
    usable = usable.where(F.col("_id").isNotNull() & (fold("_id") != 0))
    usable = usable.groupBy("_id").agg(F.max("_y").alias("_y"))
    key = F.xxhash64("_id")
    chosen = [usable.where(F.col("_y") == y).orderBy(key, "_id").limit(per_class) for y in (0, 1)]
    ids = chosen[0].unionByName(chosen[1])
    texts = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string").alias("_t"))
    found = texts.where(F.length("_t") > 0).join(F.broadcast(ids), "_id")
    # A character has at most four bytes.
    most = int(max_bytes * TEXT_SHARE)
    found = found.withColumn("_t", F.when(F.octet_length("_t") > most, F.substring("_t", 1, max(1, most // 4))).otherwise(F.col("_t")))
    found = found.groupBy("_id", "_y").agg(F.min("_t").alias("_t"))
    found = written(found.withColumn("_n", F.octet_length("_t")))
    # Both classes in turn, until the bytes are used up; the windows see ids and lengths of the sample only.
    turn = Window.partitionBy("_y").orderBy(key, "_id")
    order = Window.orderBy("_turn", "_y")
    sized = found.drop("_t").withColumn("_turn", F.row_number().over(turn))
    sized = sized.withColumn("_sum", F.sum("_n").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    kept = sized.where(F.col("_sum") <= max_bytes).select("_id", "_turn")
    rows = found.join(F.broadcast(kept), "_id").select("_id", "_t", "_y", "_turn")
    counted = usable.groupBy("_y").count().where(F.col("_y").isin(0, 1)).collect()
    totals = {r["_y"]: r["count"] for r in counted}
    return rows, [totals.get(y, 0) for y in (0, 1)]


def shift(in_sample: np.ndarray, in_all: list[int] | None) -> float:
    """What to add to the log-odds so that a sample by label speaks for all rows."""
    if in_all is None or not all(in_all) or not all(in_sample):
        return 0.0
    return float(np.log(in_all[1] / in_all[0]) - np.log(in_sample[1] / in_sample[0]))


class Logistic:
    """Ridge logistic regression on a few standardised figures."""

    def __init__(self, figures: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 40):
        self.mean, self.scale = figures.mean(0), figures.std(0) + 1e-9
        x = self._input(figures)
        weights = np.zeros(x.shape[1])
        penalty = ridge * np.eye(len(weights))
        penalty[-1, -1] = 1e-6
        for _ in range(rounds):
            p = self._squash(x @ weights)
            slope = (x * (p * (1 - p))[:, None]).T @ x + penalty
            step = np.linalg.solve(slope, x.T @ (y - p) - penalty @ weights)
            weights = weights + np.clip(step, -4, 4)
            if np.abs(step).max() < 1e-8:
                break
        self.weights = weights

    def moved(self, log_odds: float) -> Logistic:
        """The same fit for rows whose labels have other shares."""
        self.weights[-1] += log_odds
        return self

    def _input(self, figures: np.ndarray) -> np.ndarray:
        x = np.clip((figures - self.mean) / self.scale, -20, 20)
        return np.column_stack([x, np.ones(len(x))])

    @staticmethod
    def _squash(z: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))

    def __call__(self, figures: np.ndarray) -> np.ndarray:
        return self._squash(self._input(figures) @ self.weights)
