"""Sorted runs of suffixes: front coding, and merging that knows common prefixes.

A run is a sorted list of strings, each with a payload that says where it
stands. In its coded form a string is stored as the length of the prefix it
shares with the one before, and the rest. Runs are merged by a loser tree whose entries carry
the length of the prefix they share with the string that was put out last: of
two entries the one that shares more comes first, and only entries that share
equally much are compared, from the end of that prefix on.
"""

from __future__ import annotations

import struct
from collections.abc import Iterable, Iterator

_ENTRY = struct.Struct("<HHH")
Entry = tuple[int, bytes, bytes]


def common(a: bytes, b: bytes, start: int = 0) -> int:
    """Length of the common prefix of two strings that share their first ``start`` bytes."""
    end = min(len(a), len(b))
    if a[start:end] == b[start:end]:
        return end
    step = 8
    while a[start : start + step] == b[start : start + step]:
        start += step
        step *= 2
    while step > 1:
        step //= 2
        if a[start : start + step] == b[start : start + step]:
            start += step
    return start


def encode(run: Iterable[tuple[bytes, bytes]]) -> bytes:
    """Front-code a sorted run of strings with their payloads."""
    out, last = [], b""
    for text, payload in run:
        shared = common(last, text)
        out += [_ENTRY.pack(shared, len(text) - shared, len(payload)), text[shared:], payload]
        last = text
    return b"".join(out)


def decode(data: bytes) -> Iterator[Entry]:
    """Length of the prefix shared with the string before, string and payload, in order."""
    at, last = 0, b""
    unpack, size = _ENTRY.unpack_from, _ENTRY.size
    while at < len(data):
        shared, rest, extra = unpack(data, at)
        at += size
        last = last[:shared] + data[at : at + rest]
        at += rest
        yield shared, last, data[at : at + extra]
        at += extra


def merge(runs: list[Iterator[Entry]]) -> Iterator[Entry]:
    """All entries of coded runs in order of string and payload.

    The first figure of each is the length of the prefix that it shares with
    the entry before it, which the tree knows without comparing them.
    """
    width = 1
    while width < max(1, len(runs)):
        width *= 2
    # An entry is [shared prefix with the last output, string, payload], or None at the end.
    heads: list[list | None] = [None] * width
    for i, run in enumerate(runs):
        first = next(run, None)
        heads[i] = [0, *first[1:]] if first else None
    losers = [0] * width

    def first_of(i: int, j: int) -> tuple[int, int]:
        """Winner and loser; the loser's entry learns what it shares with the winner."""
        x, y = heads[i], heads[j]
        if x is None or y is None:
            return (j, i) if x is None else (i, j)
        if x[0] != y[0]:
            return (i, j) if x[0] > y[0] else (j, i)
        shared = common(x[1], y[1], x[0])
        a, b = x[1][shared : shared + 1], y[1][shared : shared + 1]
        if a < b or (a == b and (len(x[1]), x[2]) <= (len(y[1]), y[2])):
            y[0] = shared
            return i, j
        x[0] = shared
        return j, i

    def play(node: int) -> int:
        if node >= width:
            return node - width
        winner, losers[node] = first_of(play(2 * node), play(2 * node + 1))
        return winner

    winner = play(1)
    while heads[winner] is not None:
        yield tuple(heads[winner])
        following = next(runs[winner], None)
        # Within a run the shared length is stored: it is what the new head shares with the last output.
        heads[winner] = list(following) if following else None
        node = (winner + width) // 2
        while node:
            winner, losers[node] = first_of(winner, losers[node])
            node //= 2
