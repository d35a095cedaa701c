"""Documents packed into as few sequences of a fixed number of tokens as possible.

Only the lengths of the pieces matter, and there are no more lengths than
tokens in a sequence, so a plan is made from the histogram alone. A
configuration is a set of lengths that fit one sequence. The linear program
"least number of configurations that cover the histogram" has too many
columns to write down; it is solved by multiplicative weights. In each phase
a knapsack by dynamic programming prices the configurations: it gives, for
every length, the best configuration that holds it, and all that are nearly
as good as the best are raised together, while lengths lose weight as they
get covered. The fractions are rounded down as far as pieces are left. The
rest, which is small and balanced, is filled one configuration at a time:
its longest piece and the fullest set of others beside it, again by a
knapsack, as often as pieces allow.

A piece then only needs its number among the pieces of its length: the plan
says which sequence and place that number has. Documents never move for it.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickwell.llm.tables import by_batch, id_and_text, written
from tickwell.llm.wordids import batch_encoder

LENGTH = 2048
#: Phases of the multiplicative weights, how fast covered lengths lose weight,
#: and how near to the best price a configuration is raised with it.
PHASES = 60
RATE = 0.5
NEARLY = 0.02


# ---- The configuration linear program ------------------------------------------


def prices(lengths: np.ndarray, values: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Knapsack over every capacity: the best total value, and which length to
    take first for it (-1 for none)."""
    best = np.zeros(capacity + 1)
    take = np.full(capacity + 1, -1, dtype=np.int64)
    fits = np.searchsorted(lengths, np.arange(capacity + 1), side="right")
    for room in range(1, capacity + 1):
        n = fits[room]
        if not n:
            continue
        total = best[room - lengths[:n]] + values[:n]
        at = int(total.argmax())
        best[room], take[room] = total[at], at
    return best, take


def configurations(
    lengths: np.ndarray, values: np.ndarray, capacity: int
) -> list[tuple[tuple[int, int], ...]]:
    """For every length the best configuration that holds it, if nearly as good as the best:
    pairs (index of a length, how often)."""
    best, take = prices(lengths, values, capacity)
    found = set()
    for i in np.flatnonzero(values + best[capacity - lengths] >= (1 - NEARLY) * best[capacity]):
        counts = {int(i): 1}
        room = capacity - int(lengths[i])
        while take[room] >= 0:
            # As many of one length as follow each other.
            at = int(take[room])
            counts[at] = counts.get(at, 0) + 1
            room -= int(lengths[at])
        found.add(tuple(sorted(counts.items())))
    return sorted(found)


def cover(lengths: np.ndarray, demand: np.ndarray, capacity: int, phases: int = PHASES) -> dict[tuple, float]:
    """A fractional cover of the demand: how often to use each configuration."""
    used: dict[tuple, float] = {}
    covered = np.zeros(len(lengths))
    for _ in range(phases):
        weights = np.exp(-RATE * (covered - covered.min()))
        # Weight per piece; a little for its tokens keeps configurations full.
        values = weights / demand * lengths + 1e-9 * lengths
        chosen = configurations(lengths, values, capacity)
        raised = np.zeros(len(lengths))
        for config in chosen:
            at, times = (np.array(x) for x in zip(*config))
            share = (demand[at] / times).min() / len(chosen)
            used[config] = used.get(config, 0.0) + share
            raised[at] += share * times / demand[at]
        if raised.max() > 0:
            # No length is covered more than once by a phase.
            covered += raised / max(1.0, raised.max())
    return used


def fullest(lengths: np.ndarray, left: np.ndarray, room: int) -> dict[int, int]:
    """A set of the pieces left that fills ``room`` as far as possible, long ones first.

    ``reach`` is a bit per sum; a length that may be taken several times
    enters in powers of two.
    """
    reach, states = 1, []
    goal = 1 << room
    keep = (goal << 1) - 1
    for i in range(int(np.searchsorted(lengths, room, side="right")) - 1, -1, -1):
        size = int(lengths[i])
        most, times = min(int(left[i]), room // size), 1
        while most > 0:
            n = min(times, most)
            states.append((reach, i, n))
            reach |= (reach << (n * size)) & keep
            most, times = most - n, times * 2
        if reach & goal:
            break
    total = reach.bit_length() - 1
    counts: dict[int, int] = {}
    for before, i, n in reversed(states):
        if not before >> total & 1:
            counts[i] = counts.get(i, 0) + n
            total -= n * int(lengths[i])
    return counts


@dataclass(frozen=True)
class Plan:
    """Runs of pieces: numbers ``first`` to ``first + repeats * times`` of a length
    lie in ``repeats`` sequences from ``base`` on, ``times`` in each from ``offset``."""

    length: np.ndarray
    first: np.ndarray
    times: np.ndarray
    base: np.ndarray
    offset: np.ndarray
    sequences: int

    def place(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of pieces by length and number among the pieces of that length."""
        # Runs are sorted by length and first number; both fit one sort key.
        span = int(max(self.first.max(initial=0), number.max(initial=0))) + 1
        keys = self.length * span + self.first
        at = np.searchsorted(keys, length * span + number, side="right") - 1
        turn, copy = np.divmod(number - self.first[at], self.times[at])
        return self.base[at] + turn, self.offset[at] + copy * length


def plan(lengths: np.ndarray, counts: np.ndarray, capacity: int = LENGTH, phases: int = PHASES) -> Plan:
    """From a histogram, ascending in length, to the places of all pieces."""
    lengths, left = np.asarray(lengths, dtype=np.int64), np.array(counts, dtype=np.int64)
    done = np.zeros(len(lengths), dtype=np.int64)
    runs: list[tuple[int, int, int, int, int]] = []
    sequences = 0

    def use(config: dict[int, int], repeats: int) -> None:
        nonlocal sequences
        offset = 0
        for i in sorted(config, reverse=True):
            runs.append((int(lengths[i]), int(done[i]), config[i], sequences, offset))
            offset += config[i] * int(lengths[i])
            done[i] += config[i] * repeats
            left[i] -= config[i] * repeats
        sequences += repeats

    if len(lengths) and left.sum() > 2 * len(lengths):
        used = cover(lengths, left.astype(float), capacity, phases)
        size = {c: sum(int(lengths[i]) * n for i, n in c) for c in used}
        total = sum(size[c] * x for c, x in used.items())
        scale = float((lengths * left).sum()) / max(total, 1e-9)
        # Full configurations first; others are better rebuilt from what is left.
        for config in sorted((c for c in used if size[c] == capacity), key=lambda c: (-used[c], c)):
            repeats = min(int(used[config] * scale), min(int(left[i]) // n for i, n in config))
            if repeats > 0:
                use(dict(config), repeats)
    while left.any():
        longest = int(np.flatnonzero(left)[-1])
        left[longest] -= 1
        config = fullest(lengths, left, capacity - int(lengths[longest]))
        left[longest] += 1
        config[longest] = config.get(longest, 0) + 1
        use(config, min(int(left[i]) // n for i, n in config.items()))
    runs.sort()
    columns = [np.array(c, dtype=np.int64) for c in zip(*runs)] if runs else [np.empty(0, np.int64)] * 5
    return Plan(*columns, sequences)


# ---- Tables --------------------------------------------------------------------

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, task int, turn long"


def pieces(
    docs: DataFrame,
    tokenizer: str,
    end_id: int,
    capacity: int = LENGTH,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """Documents as token ids with the end id, cut into pieces of at most ``capacity`` ids.

    A row per piece; ``turn`` counts the pieces of a length within ``task``.
    Only documents above ``capacity`` are cut, and the first of their pieces is
    the one that may be shorter. ``with_ids`` adds the ids, four bytes each.
    """
    schema = PIECES + (", ids binary" if with_ids else "")

    def cut(batches: Iterator[dict]) -> Iterator[dict]:
        code = batch_encoder(tokenizer)
        task = TaskContext.get().partitionId()
        end = np.array([end_id], dtype="<u4")
        seen = np.zeros(capacity + 1, dtype=np.int64)
        for batch in batches:
            flat, at = code.encode(batch["text"])
            rows = []
            for doc_id, start, stop in zip(batch["doc_id"].to_pylist(), at.tolist(), at[1:].tolist()):
                ids = np.append(flat[start:stop].astype("<u4"), end)
                borders = [0, *range(len(ids) % capacity or capacity, len(ids) + 1, capacity)]
                for k, (a, b) in enumerate(zip(borders, borders[1:])):
                    own = ids[a:b].tobytes()
                    rows.append((doc_id, k, a, b - a, zlib.crc32(own), task, int(seen[b - a]), own))
                    seen[b - a] += 1
            names = ("doc_id", "piece", "start", "length", "ids_crc32", "task", "turn", "ids")
            yield dict(zip(names, zip(*rows)))

    return by_batch(id_and_text(docs, id_col, text_col), schema, cut, arrays=True)


def placed(pieces: DataFrame, capacity: int = LENGTH, phases: int = PHASES) -> DataFrame:
    """Pieces with ``sequence_id`` and ``offset``; ``pieces`` has to be a written table."""
    own = pieces.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n"))
    # A row per task and length: a length never has more rows here than there were tasks.
    own = written(own)
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = own.select(
        F.col("task").alias("_task"),
        F.col("length").alias("_length"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before"),
    )
    # At most ``capacity`` rows.
    histogram = sorted(tuple(r) for r in own.groupBy("length").agg(F.sum("n")).collect())
    lengths, counts = (np.array(c, dtype=np.int64) for c in zip(*histogram)) if histogram else (np.empty(0, np.int64),) * 2
    made = plan(lengths, counts, capacity, phases)

    @F.arrow_udf("struct<sequence_id:bigint,offset:bigint>")
    def place(length: pa.Array, number: pa.Array) -> pa.Array:
        found = made.place(length.to_numpy(zero_copy_only=False), number.to_numpy(zero_copy_only=False))
        return pa.StructArray.from_arrays([pa.array(x) for x in found], names=["sequence_id", "offset"])

    joined = pieces.join(starts, (F.col("task") == F.col("_task")) & (F.col("length") == F.col("_length")))
    numbered = joined.withColumn("_place", place("length", F.col("turn") + F.col("_before")))
    return numbered.select(
        *[c for c in pieces.columns if c not in ("task", "turn")], "_place.sequence_id", "_place.offset"
    )


def pack(
    docs: DataFrame,
    tokenizer: str,
    end_id: int,
    capacity: int = LENGTH,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset``, a row per piece.

    Texts are encoded once; the pieces are written and numbered from there. A
    null or empty text is the end id alone. Rows of equal or null id are
    documents of their own, with piece numbers from 0 each. The places depend
    on the order of the rows in the files, the number of sequences only on the
    lengths. An empty table gives no rows; other columns are not looked at.
    """
    return placed(written(pieces(docs, tokenizer, end_id, capacity, id_col, text_col, with_ids)), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, n_tokens, ids``: the ids of whole sequences, from pieces packed with their ids."""
    ordered = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    parts = F.transform(ordered, lambda x: F.hex(x["ids"]))
    return packed.groupBy("sequence_id").agg(
        F.sum("length").alias("n_tokens"), F.unhex(F.array_join(parts, "")).alias("ids")
    )
