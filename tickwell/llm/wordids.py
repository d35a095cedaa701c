"""Token ids of many texts at once: texts are cut into pre-tokens by array operations.

A byte-level BPE with the usual split pattern never joins anything across
certain borders: between ASCII letters, digits and marks, at the start of a
run of white space and before its last character. All texts of a batch are cut
there in a few passes over their bytes, equal pieces are found by Arrow's
dictionary encoding, and the tokenizers library encodes each different piece
once. Ids of the texts are then gathered by index.
"""

from __future__ import annotations

import json
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tickwell.llm.bpe import byte_alphabet, load

LETTER, DIGIT, MARK, BLANK, HIGH, QUOTE, CONTROL = range(1, 8)
#: Pieces longer than this are not remembered.
LONGEST_KEPT = 64
#: Control characters, and white space beyond ASCII next to other white space: on
#: these the passes below do not agree with the split pattern in every case.
_WIDE = r"\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
_DOUBTFUL = rf"[\x00\x1c-\x1f]|[{_WIDE}][\t-\r {_WIDE}]|[\t-\r ][{_WIDE}]"


def _kinds() -> np.ndarray:
    kinds = np.full(256, HIGH, dtype=np.uint8)
    for b in range(128):
        c = chr(b)
        if c.isalpha():
            kinds[b] = LETTER
        elif c.isdigit():
            kinds[b] = DIGIT
        elif c in " \t\n\v\f\r":
            kinds[b] = BLANK
        elif c == "'":
            kinds[b] = QUOTE
        else:
            kinds[b] = MARK if 32 < b < 127 else CONTROL
    return kinds


def _borders() -> np.ndarray:
    """Whether a pre-token always ends between two kinds of bytes, at 8 * first + second."""
    cut = np.zeros((8, 8), dtype=bool)
    for a in (LETTER, DIGIT, MARK):
        for b in (LETTER, DIGIT, MARK):
            cut[a, b] = a != b
    cut[LETTER, QUOTE] = cut[DIGIT, QUOTE] = cut[QUOTE, DIGIT] = True
    return cut.ravel()


KINDS, BORDERS = _kinds(), _borders()


def gathered(flat: np.ndarray, begins: np.ndarray, sizes: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of ``flat`` in the order of ``which``, and where each begins and the last ends."""
    counts = sizes[which]
    ends = np.concatenate([[0], np.cumsum(counts)])
    places = np.repeat(begins[which] - ends[:-1], counts)
    places += np.arange(len(places))
    return flat[places], ends


class BatchEncoder:
    """Encodes Arrow arrays of texts. With ``plain`` the strings of special
    tokens inside texts are ordinary text, else they become those tokens.

    At most twice ``limit`` pieces of up to ``LONGEST_KEPT`` bytes are
    remembered. A tokenizer of another kind gets whole texts.
    """

    def __init__(self, path: str, plain: bool = False, limit: int = 250_000):
        self.tokenizer = load(path)
        if plain:
            from tokenizers import Tokenizer

            self.tokenizer = Tokenizer.from_file(path)
            self.tokenizer.encode_special_tokens = True
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec.get("pre_tokenizer") or {}
        self.by_piece = (
            pre.get("type") == "ByteLevel"
            and pre.get("use_regex", True)
            and not pre.get("add_prefix_space")
            and spec["model"]["type"] == "BPE"
            and not spec.get("normalizer")
        )
        self.special = [] if plain else [t["content"] for t in spec.get("added_tokens", [])]
        self.table = str.maketrans({chr(b): c for b, c in byte_alphabet().items()})
        self.size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.width = max(1, (self.size - 1).bit_length())
        self.limit, self.newer, self.older = limit, {}, {}

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and where each text begins and the last one ends;
        a null text is empty."""
        pieces, which, first = self.pieces(texts)
        if not pieces:
            return np.empty(0, np.uint32), np.zeros(len(texts) + 1, np.int64)
        coded = self._ids_of(pieces)
        sizes = np.fromiter(map(len, coded), np.int64, len(coded)) >> 2
        begins = np.cumsum(sizes) - sizes
        flat = np.frombuffer(b"".join(coded), "<u4")
        ids, ends = gathered(flat, begins, sizes, which)
        return ids, ends[first]

    def pieces(self, texts: pa.Array) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """The different pieces of all texts, which of them follow each other, and
        where those of each text begin and the last end."""
        texts = texts.cast(pa.large_string()).fill_null("")
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        begin, end = int(offsets[0]), int(offsets[-1])
        offsets = offsets - begin
        if begin == end:
            return [], np.empty(0, np.int64), np.zeros(len(texts) + 1, np.int64)
        data = np.frombuffer(texts.buffers()[2], np.uint8)[begin:end]
        at = self._cuts(texts, data, offsets)
        found = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(at) - 1, [None, pa.py_buffer(at), pa.py_buffer(data)]
        ).dictionary_encode()
        return found.dictionary.to_pylist(), found.indices.to_numpy(), np.searchsorted(at, offsets)

    def _cuts(self, texts: pa.Array, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Where the pieces begin, and the end of the last one."""
        cut = np.zeros(len(data) + 1, dtype=bool)
        if self.by_piece:
            kinds = KINDS[data]
            cut[1:-1] = BORDERS[(kinds[:-1] << 3) | kinds[1:]]
            blank = kinds == BLANK
            after = np.append(blank[1:], True)
            # A run at the end of a text is one pre-token.
            after[offsets[1:][offsets[1:] > 0] - 1] = True
            before = np.append(False, blank[:-1])
            cut[:-1] |= blank & ~(before & after)
            cut[1:] |= blank & ~after & (data != 32)
            for doubtful in np.flatnonzero(self.whole_texts(texts)):
                cut[offsets[doubtful] : offsets[doubtful + 1]] = False
        cut[offsets] = True
        return np.flatnonzero(cut)

    def whole_texts(self, texts: pa.Array) -> np.ndarray:
        """The texts that are not cut."""
        found = pc.match_substring_regex(texts, _DOUBTFUL)
        for special in self.special:
            found = pc.or_(found, pc.match_substring(texts, special))
        return found.to_numpy(zero_copy_only=False)

    def _ids_of(self, pieces: list[bytes]) -> list[bytes]:
        if len(self.newer) > self.limit:
            self.newer, self.older = {}, self.newer
        newer, older, out = self.newer, self.older, []
        for piece in pieces:
            ids = newer.get(piece)
            if ids is None:
                ids = older.get(piece)
                if ids is None:
                    ids = self._encoded(piece.decode())
                if len(piece) <= LONGEST_KEPT:
                    newer[piece] = ids
            out.append(ids)
        return out

    def _encoded(self, piece: str) -> bytes:
        word = piece[1:] if piece[:1] == " " else piece
        if self.by_piece and word.isalpha() and (word.isascii() or max(word) < "ɐ"):
            mapped = piece.encode().decode("latin-1").translate(self.table)
            ids = [t.id for t in self.tokenizer.model.tokenize(mapped)]
        else:
            ids = self.tokenizer.encode(piece, add_special_tokens=False).ids
        return array("I", ids).tobytes()


@lru_cache(maxsize=2)
def batch_encoder(path: str, plain: bool = False) -> BatchEncoder:
    return BatchEncoder(path, plain)
