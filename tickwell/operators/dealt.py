"""Series in global order, dealt to tasks by ranges, and operators that run along them.

``deal`` sorts a table of series once: Spark deals its rows by ranges of
series and order, so a series that holds a third of all rows lies in many
parts, one after the other, and each part is sorted. The parts are kept in
the shared folder. Everything else is narrow, there is no other shuffle and
no other sort: operators run along the rows of a part as they come, any
number of them in one pass.

What an operator needs from the rows before its part comes from a first pass
over the parts: the last rows of the series that a part ends with (its border
rows) and, for exponential averages, how the part maps the averages at its
beginning to those at its end. These are affine maps, so the maps of parts
that one series fills are composed, for all spans at once. One small row per
part goes to the driver, which chains them.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tickwell.fixed_values import (
    BOLLINGER_ROWS,
    BOLLINGER_WIDTH,
    MACD_FAST,
    MACD_SIGNAL,
    MACD_SLOW,
    MOVING_AVERAGES,
    RSI_ROWS,
)
from tickwell.schema import need_columns
from tickwell.session import keep

PART, VALUE = "_dealt_part", "_dealt_value"


@dataclass(frozen=True)
class Dealt:
    """Rows sorted by series and order; part 0 comes before part 1, and so on."""

    df: DataFrame
    by: tuple[str, ...]
    order: tuple[str, ...]

    def rows(self) -> DataFrame:
        return self.df.drop(PART)


def deal(df: DataFrame, by=("symbol",), order=("ts", "row_id"), parts: int | None = None) -> Dealt:
    """Deal the rows of all series by ranges.

    ``order`` has to tell all rows of a series apart; rows without a name are a
    series of their own, and so is the whole table without ``by``. The parts
    are written, so every pass and every repeated task sees the same ones.
    Results do not depend on where they begin.
    """
    by, order = tuple(by), tuple(order)
    need_columns(df, *by, *order)
    return Dealt(keep(_sorted(df, [*by, *order], parts).withColumn(PART, F.spark_partition_id())), by, order)


def _sorted(df: DataFrame, keys: list[str], parts: int | None) -> DataFrame:
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)


def numbered(df: DataFrame, order: list[str], name: str, parts: int | None = None) -> tuple[DataFrame, int]:
    """All rows numbered from 0 in the order of ``order``, and how many there
    are: one exchange by ranges, the number of a row in its part, and how many
    rows the parts before have."""
    # The number of the partition, and 33 bits for the row within it.
    kept = keep(_sorted(df, order, parts).withColumn(name, F.monotonically_increasing_id()))
    part = F.shiftright(F.col(name), 33)
    counts = {r[0]: r[1] for r in kept.groupBy(part).count().collect()}
    before = np.cumsum([0, *(counts.get(p, 0) for p in range(max(counts, default=-1) + 1))]).tolist()
    start = F.element_at(F.array(*map(F.lit, before)), (part + 1).cast("int"))
    return kept.withColumn(name, start.cast("long") + F.col(name).bitwiseAND(F.lit((1 << 33) - 1))), before[-1]


# ---- Operators along the rows ---------------------------------------------------


@dataclass
class Rows:
    """Some rows of a part in order, with the border rows before them.

    ``x`` are values, NaN for missing; ``place`` counts the rows of a series
    from 0. The first ``lead`` entries of both are border rows. ``known`` is
    the latest value of the series of the border rows.
    """

    x: np.ndarray
    place: np.ndarray
    lead: int
    known: float

    def own(self, values: np.ndarray) -> np.ndarray:
        return values[self.lead :]

    def before(self, values: np.ndarray, n: int = 1) -> np.ndarray:
        """Values ``n`` rows before, NaN beyond the beginning of a series."""
        out = np.full(len(values), np.nan)
        out[n:] = values[:-n]
        return np.where(self.place >= n, out, np.nan)

    def windows(self, values: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """The last ``n`` values of every row, and whether they are all there."""
        padded = np.concatenate([np.full(n - 1, np.nan), values])
        seen = np.lib.stride_tricks.sliding_window_view(padded, n)
        return seen, (self.place >= n - 1) & ~np.isnan(seen).any(axis=1)

    def latest(self) -> np.ndarray:
        """The latest value up to each row of its own."""
        at = np.maximum.accumulate(np.where(np.isnan(self.x), -1, np.arange(len(self.x))))
        start = np.arange(len(self.x)) - self.place
        found = np.where(at >= np.maximum(start, 0), self.x[at], np.nan)
        # Series that began before the border rows.
        return np.where((at < 0) & (start < 0), self.known, found)


def total(windows: np.ndarray) -> np.ndarray:
    """Sums of the windows, added up in the order of the rows."""
    sums = windows[:, 0].copy()
    for i in range(1, windows.shape[1]):
        sums += windows[:, i]
    return sums


class Step:
    """Adds columns along the rows of every series; ``lookback`` is how many
    rows before its own a row needs."""

    lookback = 0
    columns: dict[str, str] = {}

    def run(self, rows: Rows) -> dict[str, np.ndarray]:
        raise NotImplementedError


class Averages(Step):
    """Means of the last values, null unless all are there."""

    def __init__(self, periods=MOVING_AVERAGES):
        self.periods, self.lookback = tuple(periods), max(periods) - 1
        self.columns = {f"ma{n}": "double" for n in periods}

    def run(self, rows):
        out = {}
        for n in self.periods:
            seen, whole = rows.windows(rows.x, n)
            out[f"ma{n}"] = np.where(whole, total(seen) / n, np.nan)
        return out


class Change(Step):
    """Difference from the row before."""

    lookback = 1

    def __init__(self, name: str = "change"):
        self.name, self.columns = name, {name: "double"}

    def run(self, rows):
        return {self.name: rows.x - rows.before(rows.x)}


class Strength(Step):
    """Relative strength from simple means of gains and losses; rows without a
    change (the first one, gaps) count as 0 in both."""

    columns = {"rsi": "double"}

    def __init__(self, n: int = RSI_ROWS):
        self.n, self.lookback = n, n

    def run(self, rows):
        change = np.nan_to_num(rows.x - rows.before(rows.x))
        sums = []
        for moved in (np.maximum(change, 0.0), np.maximum(-change, 0.0)):
            seen, whole = rows.windows(moved, self.n)
            sums.append(total(seen))
        up, down = sums
        with np.errstate(divide="ignore", invalid="ignore"):
            value = np.where((down == 0) & (up > 0), 100.0, 100 - 100 / (1 + up / down))
        return {"rsi": np.where(whole, value, np.nan)}


class Bands(Step):
    """Bollinger bands."""

    columns = {c: "double" for c in ("bb_upper", "bb_lower", "bb_middle")}

    def __init__(self, n: int = BOLLINGER_ROWS):
        self.n, self.lookback = n, n - 1

    def run(self, rows):
        seen, whole = rows.windows(rows.x, self.n)
        middle = total(seen) / self.n
        spread = np.sqrt(((seen - middle[:, None]) ** 2).sum(axis=1) / (self.n - 1)) * BOLLINGER_WIDTH
        found = {"bb_upper": middle + spread, "bb_lower": middle - spread, "bb_middle": middle}
        return {name: np.where(whole, v, np.nan) for name, v in found.items()}


class Returns(Step):
    """Simple returns over forward-filled values and log returns over the
    values as they are; a previous value of zero gives null."""

    lookback = 1
    columns = {"simple_return": "double", "log_return": "double"}

    def run(self, rows):
        filled = rows.latest()
        earlier = rows.before(filled)
        with np.errstate(divide="ignore", invalid="ignore"):
            simple = np.where(earlier != 0, filled / earlier, np.nan) - 1
            ratio = rows.x / np.where((last := rows.before(rows.x)) != 0, last, np.nan)
            log = np.log(np.where(ratio > 0, ratio, np.nan))
        return {"simple_return": simple, "log_return": log}


class Previous(Step):
    """The value of the row before, as a whole number."""

    lookback = 1

    def __init__(self, name: str):
        self.name, self.columns = name, {name: "long"}

    def run(self, rows):
        return {self.name: rows.before(rows.x)}


class Position(Step):
    """The number of the row in its series, from 0."""

    def __init__(self, name: str):
        self.name, self.columns = name, {name: "long"}

    def run(self, rows):
        return {self.name: rows.place}


def recur(a: np.ndarray, b: np.ndarray, y: np.ndarray, width: int = 64) -> np.ndarray:
    """All y[t] = a[t] * y[t - 1] + b[t], in blocks side by side; ``b`` and ``y``
    may have more columns than one."""
    n = len(a)
    if n <= width:
        out = np.empty(b.shape)
        for t in range(n):
            y = out[t] = a[t] * y + b[t]
        return out
    blocks = -(-n // width)
    a = np.concatenate([a, np.ones(blocks * width - n)]).reshape(blocks, width)
    b = np.concatenate([b, np.zeros((blocks * width - n, *b.shape[1:]))]).reshape(blocks, width, -1)
    fade, own = np.empty(a.shape), np.empty(b.shape)
    fade[:, 0], own[:, 0] = a[:, 0], b[:, 0]
    for t in range(1, width):
        fade[:, t] = fade[:, t - 1] * a[:, t]
        own[:, t] = own[:, t - 1] * a[:, t, None] + b[:, t]
    ends = recur(fade[:, -1], own[:, -1], y, width)
    starts = np.concatenate([np.atleast_2d(y), ends[:-1]])
    return (own + fade[:, :, None] * starts[:, None, :]).reshape(blocks * width, -1)[:n]


@dataclass
class Faded:
    """Averages at a row, as combinations of those at an earlier one: a row per
    average, a column per earlier average and one for constants. ``since`` is
    the number of rows after the latest value."""

    averages: np.ndarray
    since: int = 0
    started: bool = False


class Exponential(Step):
    """Exponential moving averages, one per ``{name: span}``.

    An average starts at the first value; each later value moves it by a share
    that grows with the number of rows since the value before it; rows without
    a value keep it. ``signal`` names an average of the difference of the first
    two, which there is on every row once they have started.
    """

    def __init__(self, spans: dict[str, int], signal: int | None = None):
        self.spans, self.signal = dict(spans), signal
        self.alphas = [2.0 / (n + 1) for n in self.spans.values()]
        self.size = len(self.spans) + (signal is not None)
        self.columns = {n: "double" for n in self.spans}

    def fresh(self) -> Faded:
        return Faded(np.zeros((self.size, 1)))

    def along(self, x: np.ndarray, place: np.ndarray, state: Faded) -> tuple[np.ndarray, np.ndarray, Faded]:
        """Averages at every row (row, average, column), whether they have started, and the state after."""
        index = np.arange(len(x))
        there = ~np.isnan(x)
        begin = index - place
        last = np.maximum.accumulate(np.where(there, index, -1))
        before = np.concatenate([[-1], last[:-1]])
        carried = (begin < 0) & state.started
        started = (last >= np.maximum(begin, 0)) | carried
        later = there & ((before >= np.maximum(begin, 0)) | carried)
        gap = np.where(before >= np.maximum(begin, 0), index - before, index + 1 + state.since)
        first = there & ~later
        y = state.averages
        out = np.empty((len(x), *y.shape))
        constant = np.zeros(y.shape[1])
        constant[-1] = 1.0
        value = np.where(there, x, 0.0)
        for i, alpha in enumerate(self.alphas):
            decay = (1 - alpha) ** gap
            share = np.where(later, alpha / (decay + alpha), 0.0)
            keep_share = np.where(first, 0.0, 1.0 - share)
            add = np.where(first, value, share * value)
            out[:, i] = recur(keep_share, add[:, None] * constant, y[i])
        if self.signal is not None:
            alpha = 2.0 / (self.signal + 1)
            difference = out[:, 0] - out[:, 1]
            opening = started & ~np.concatenate([[state.started], started[:-1]])
            opening |= started & (place == 0)
            share = np.where(opening, 1.0, np.where(started, alpha, 0.0))
            out[:, -1] = recur(1.0 - share, share[:, None] * difference, y[-1])
        after = Faded(
            out[-1].copy(),
            int(index[-1] - last[-1]) if last[-1] >= max(int(begin[-1]), 0) else int(state.since + len(x)),
            bool(started[-1]),
        )
        return out, started, after

    def shown(self, out: np.ndarray, started: np.ndarray) -> dict[str, np.ndarray]:
        values = np.where(started[:, None], out[:, :, -1], np.nan)
        return {name: values[:, i] for i, name in enumerate(self.spans)}

    # -- A part that one series fills, as a map --

    def unknown(self) -> dict:
        return {"rows": 0, "lead": None}

    def mapped(self, x: np.ndarray, part: dict) -> dict:
        """Go on with rows of a series whose averages before the part are not known."""
        if part["lead"] is None:
            found = np.flatnonzero(~np.isnan(x))
            if not len(found):
                return part | {"rows": part["rows"] + len(x)}
            at = int(found[0])
            part = {"rows": part["rows"] + at, "lead": float(x[at])}
            part["map"] = Faded(np.eye(self.size, self.size + 1), 0, True)
            x = x[at + 1 :]
        if len(x):
            _, _, after = self.along(x, np.arange(1, len(x) + 1), part["map"])
            part = part | {"map": after}
        return part

    def composed(self, state: Faded, part: dict) -> Faded:
        """The averages after a part from those before it."""
        y = state.averages[:, -1].copy()
        rows = part["rows"]
        if self.signal is not None and state.started:
            # Rows without a value keep the difference.
            level = y[0] - y[1]
            y[-1] = level + (1 - 2.0 / (self.signal + 1)) ** rows * (y[-1] - level)
        if part["lead"] is None:
            return Faded(y[:, None], state.since + rows, state.started)
        x, gap = part["lead"], state.since + rows + 1
        for i, alpha in enumerate(self.alphas):
            share = alpha / ((1 - alpha) ** gap + alpha) if state.started else 1.0
            y[i] += share * (x - y[i])
        if self.signal is not None:
            share = 2.0 / (self.signal + 1) if state.started else 1.0
            y[-1] += share * (y[0] - y[1] - y[-1])
        after = part["map"]
        return Faded((after.averages @ np.append(y, 1.0))[:, None], after.since, True)


class Convergence(Exponential):
    """MACD: two averages, their difference, its average and what is left."""

    def __init__(self, fast: int = MACD_FAST, slow: int = MACD_SLOW, signal: int = MACD_SIGNAL):
        super().__init__({"ema_fast": fast, "ema_slow": slow}, signal)
        self.columns |= {c: "double" for c in ("macd", "macd_signal", "macd_histogram")}

    def shown(self, out, started):
        found = super().shown(out, started)
        found["macd"] = found["ema_fast"] - found["ema_slow"]
        found["macd_signal"] = np.where(started, out[:, -1, -1], np.nan)
        found["macd_histogram"] = found["macd"] - found["macd_signal"]
        return found


# ---- Passes ----------------------------------------------------------------------


@dataclass
class Cursor:
    """Where a pass stands: the series of the latest row, how many rows it has
    had, the last of their values, the latest value, and the averages."""

    key: object = None
    rows: int = 0
    tail: np.ndarray = field(default_factory=lambda: np.empty(0))
    known: float = math.nan
    faded: list = field(default_factory=list)


def _taken(batch: pa.RecordBatch, by: tuple[str, ...], cursor: Cursor) -> tuple[np.ndarray, np.ndarray, object]:
    """Values, places in the series, and the key of the last row."""
    x = batch.column(VALUE).to_numpy(zero_copy_only=False).astype(float)
    new = np.zeros(len(x), dtype=bool)
    for c in by:
        codes = batch.column(c).dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
        new[1:] |= codes[1:] != codes[:-1]
    new[0] = cursor.key != _key(batch, by, 0)
    index = np.arange(len(x))
    begin = np.maximum.accumulate(np.where(new, index, -1))
    place = np.where(begin >= 0, index - begin, index + cursor.rows)
    return x, place, _key(batch, by, len(x) - 1)


def _key(batch: pa.RecordBatch, by: tuple[str, ...], at: int) -> tuple:
    return tuple(batch.column(c)[at].as_py() for c in by)


def _moved(cursor: Cursor, rows: Rows, key, lookback: int, faded: list) -> Cursor:
    count = int(rows.place[-1]) + 1
    return Cursor(key, count, rows.x[len(rows.x) - min(lookback, count, len(rows.x)) :].copy(), float(rows.latest()[-1]), faded)


def _with_border(x: np.ndarray, place: np.ndarray, cursor: Cursor) -> Rows:
    n = len(cursor.tail)
    return Rows(
        np.concatenate([cursor.tail, x]), np.concatenate([np.arange(cursor.rows - n, cursor.rows), place]), n, cursor.known
    )


def _exponential(steps: tuple[Step, ...]) -> list[Exponential]:
    return [s for s in steps if isinstance(s, Exponential)]


def _ends(t: Dealt, steps: tuple[Step, ...], lookback: int) -> dict[int, tuple]:
    """Per part: the first series; whether it fills the part; and the cursor after it.
    Averages of a series that may have begun before the part are maps."""
    by, fading = t.by, _exponential(steps)

    def last_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, cursor, part = None, Cursor(), None
        whole, maps = True, [s.unknown() for s in fading]
        for batch in batches:
            if not batch.num_rows:
                continue
            if first is None:
                part = batch.column(PART)[0].as_py()
                first = _key(batch, by, 0)
                cursor = Cursor(key=first)
            x, place, key = _taken(batch, by, cursor)
            # Of a batch only its last series lives on.
            since = max(0, len(x) - 1 - int(place[-1]))
            if place[since] == 0 and (since > 0 or cursor.rows > 0):
                whole, cursor = False, Cursor(key, faded=[s.fresh() for s in fading])
            x, place = x[since:], place[since:]
            rows = _with_border(x, place, cursor)
            if whole:
                maps = [s.mapped(x, m) for s, m in zip(fading, maps)]
                faded = []
            else:
                faded = [s.along(x, place, f)[2] for s, f in zip(fading, cursor.faded)]
            cursor = _moved(cursor, rows, key, lookback, faded)
        if first is not None:
            shown = pickle.dumps((first, whole, cursor, maps))
            yield pa.RecordBatch.from_arrays([pa.array([part]), pa.array([shown])], names=["part", "end"])

    # One small row per part.
    rows = t.df.mapInArrow(last_rows, "part long, end binary").collect()
    return {r["part"]: pickle.loads(r["end"]) for r in rows}


def _chained(ends: dict[int, tuple], steps: tuple[Step, ...], lookback: int) -> dict[int, Cursor]:
    """The cursor before each part."""
    fading = _exponential(steps)
    cursor, before = Cursor(), {}
    for part in sorted(ends):
        before[part] = cursor
        first, whole, own, maps = ends[part]
        if whole:
            goes_on = cursor.key == first and cursor.rows > 0
            base = cursor if goes_on else Cursor(key=first, faded=[s.fresh() for s in fading])
            own = Cursor(
                own.key,
                base.rows + own.rows,
                np.concatenate([base.tail, own.tail])[-lookback:],
                base.known if math.isnan(own.known) else own.known,
                [s.composed(f, m) for s, f, m in zip(fading, base.faded, maps)],
            )
        cursor = own
    return before


def along(t: Dealt, value: str, *steps: Step) -> DataFrame:
    """The rows of all series with the columns of the steps, which run along ``value``.

    Two passes over the parts, however many steps there are; rows stay where they are.
    """
    lookback = max(1, *(s.lookback for s in steps))
    valued = Dealt(t.df.withColumn(VALUE, F.col(value).cast("double")), t.by, t.order)
    narrow = Dealt(valued.df.select(*t.by, PART, VALUE), t.by, t.order)
    before = _chained(_ends(narrow, steps, lookback), steps, lookback)
    by, fading = t.by, _exponential(steps)
    added = {c: kind for s in steps for c, kind in s.columns.items()}
    kept = [c for c in t.df.columns if c != PART and c not in added]
    schema = StructType([t.df.schema[c] for c in kept])
    for c, kind in added.items():
        schema = schema.add(c, kind)

    def extended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cursor = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if cursor is None:
                cursor = before[batch.column(PART)[0].as_py()]
                cursor.faded = cursor.faded or [s.fresh() for s in fading]
            x, place, key = _taken(batch, by, cursor)
            rows = _with_border(x, place, cursor)
            found, faded = {}, []
            for step in steps:
                if isinstance(step, Exponential):
                    out, started, after = step.along(x, place, cursor.faded[len(faded)])
                    faded.append(after)
                    found |= step.shown(out, started)
                else:
                    found |= {c: rows.own(v) for c, v in step.run(rows).items()}
            cursor = _moved(cursor, rows, key, lookback, faded)
            columns = [batch.column(c) for c in kept]
            for c, kind in added.items():
                missing = np.isnan(found[c])
                numbers = np.where(missing, 0, found[c]).astype(np.int64) if kind == "long" else found[c]
                columns.append(pa.array(numbers, mask=missing))
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, *added])

    return valued.df.mapInArrow(extended, schema)
