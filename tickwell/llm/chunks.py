"""Cut texts into chunks that a byte-level BPE with the usual split pattern encodes independently.

A single space between two other characters always starts a new pre-token, so
the text can be cut before it; the same holds before a single line feed. Runs
of white space are cut before their last character, as the pattern does. Most
chunks are words that come again and again: what is computed for a chunk is
kept in a bounded cache, and only new chunks cost anything.

A chunk is named by a key: ``"\\0" + chunk`` for a chunk as it stands,
``"\\n..."`` for one that starts with a line feed, and otherwise the chunk
without its leading space.
"""

from __future__ import annotations

import re
from collections.abc import Callable

_RARE = re.compile(r"[\x00\x1c-\x1f]")
_RUN = re.compile(r"\s\s")
_RUNS = re.compile(r"(\s{2,})")


def keys_of(text: str) -> list[str] | None:
    """The keys of a text in order; None if it has characters on which patterns disagree."""
    if not text:
        return []
    if _RARE.search(text):
        return None
    if _RUN.search(text) is None:
        return ("\0" + text).replace("\n", " \n").split(" ") if text[0] not in " \n" else _plain(text)
    keys: list[str] = []
    parts = _RUNS.split(text)
    lead = ""
    for i in range(0, len(parts), 2):
        part = parts[i]
        if part:
            keys += _plain(lead + part) if lead else (keys_of(part) or [])
        if i + 1 < len(parts):
            run = parts[i + 1]
            last = i + 2 == len(parts) - 1 and not parts[i + 2]
            keys.append("\0" + (run if last else run[:-1]))
            lead = "" if last else run[-1]
    return keys


def _plain(text: str) -> list[str]:
    """Keys of a text without runs of white space, whatever it starts with."""
    marked = text.replace("\n", " \n")
    if text[0] in " \n":
        return marked[1:].split(" ")
    return ("\0" + marked).split(" ")


def chunk_of(key: str) -> str:
    """The piece of text that a key stands for."""
    if key[:1] == "\0":
        return key[1:]
    return key if key[:1] == "\n" else " " + key


class ChunkCache(dict):
    """Values of chunks by key; holds at most ``2 * limit`` and drops those not used lately."""

    def __init__(self, make: Callable[[ChunkCache, str], bytes], limit: int = 200_000):
        super().__init__()
        self.make, self.limit, self.older = make, limit, {}

    def __missing__(self, key: str) -> bytes:
        value = self.older.get(key)
        if value is None:
            value = self.make(self, key)
        self[key] = value
        return value

    def trim(self) -> None:
        """Call between texts: the newer half becomes the older one."""
        if len(self) >= self.limit:
            self.older = dict(self)
            self.clear()
