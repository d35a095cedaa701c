"""What a byte-level BPE tokenizer file holds."""

from __future__ import annotations

import os
from functools import lru_cache

#: Characters of the printable byte alphabet of byte-level BPE.
_KEPT = [*range(33, 127), *range(161, 173), *range(174, 256)]


def byte_alphabet() -> dict[int, str]:
    """Byte value to the character that stands for it in the vocabulary."""
    moved = (b for b in range(256) if b not in set(_KEPT))
    return {b: chr(b) for b in _KEPT} | {b: chr(256 + i) for i, b in enumerate(moved)}


@lru_cache(maxsize=4)
def load(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)
