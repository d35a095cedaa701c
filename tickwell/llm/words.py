"""Words of texts as bytes, cut at ASCII characters that are neither letters nor digits."""

from __future__ import annotations

_SEPARATORS = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256))


def words_of(text: str) -> list[bytes]:
    """Lower-cased runs of letters, digits and characters beyond ASCII."""
    return text.lower().encode().translate(_SEPARATORS).split()
