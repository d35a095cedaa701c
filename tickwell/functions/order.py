"""Sort keys of one primitive value.

Aggregates such as ``min_by`` need their key in the aggregation buffer. With a
struct as key Spark sorts all rows before it aggregates them; with a number it
keeps partial results in a hash table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# More than the distance between the smallest and the greatest long.
PLACE = "20000000000000000000BD"


def micros(ts: str | Column) -> Column:
    return F.unix_micros(F.col(ts).cast("timestamp") if isinstance(ts, str) else ts)


def time_key(ts: str, row_id: str | None) -> Column:
    """Time, then row id."""
    return micros(ts) if row_id is None else _pair(micros(ts), F.col(row_id))


def _pair(first: Column, second: Column) -> Column:
    key = first.cast("decimal(18,0)") * F.expr(PLACE) + second.cast("decimal(19,0)")
    return key.cast("decimal(38,0)")


def order_key(df: DataFrame, order: tuple[str, ...]) -> Column:
    """One value that sorts like the columns: a number for a time or a whole
    number, alone or with a second whole number, else a struct."""
    kinds = [df.schema[c].dataType for c in order]
    times, numbers = (T.TimestampType, T.TimestampNTZType), (T.LongType, T.IntegerType)
    if isinstance(kinds[0], times) and (
        len(order) == 1 or (len(order) == 2 and isinstance(kinds[1], numbers))
    ):
        return time_key(*order, *[None] * (2 - len(order)))
    if len(order) == 1 and isinstance(kinds[0], numbers):
        return F.col(order[0])
    return F.struct(*order)
