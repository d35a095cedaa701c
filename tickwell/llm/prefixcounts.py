"""Exact token counts of every prefix of a text, by dynamic programming.

The encoding of a prefix ends with exactly one token, and what stands before
that token is the encoding of a shorter prefix. So one pass over a pre-token
finds, for each position, the last token that fits to the last token of the
prefix before it, and the count is one more than that prefix's. Two tokens fit
if byte pair merging never joins anything across the border between them.

``counts(text)[i]`` is the number of tokens of ``text[: i + 1]`` as the
tokenizers library gives it for that prefix alone. Truncation and budget
questions are lookups in that array; nothing is encoded again.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from tickwell.llm.bpe import byte_alphabet, load
from tickwell.llm.chunks import ChunkCache, chunk_of, keys_of
from tickwell.llm.tables import by_batch, id_and_text
from tickwell.llm.wordids import LONGEST_KEPT, BatchEncoder

NEVER = 1 << 60
#: Entries kept of prefixes and of pairs of tokens, and the longest prefix kept.
KNOWN_LIMIT = 400_000
KNOWN_LENGTH = 24
#: A word and the marks after it, which are a pre-token of their own.
_MARKED = re.compile(r"([^\W\d_]+)([.,!?;:|)]+)")
_RUNS = re.compile(r"\s{2,}")
_BLANKS = r"[\t-\r ][\t-\r ]"
#: Endings that the split pattern takes as one piece, though their first two characters are not.
_ENDINGS = ("'re", "'ve", "'ll")


class PrefixCounter:
    """Counts for a byte-level BPE tokenizer file without normaliser."""

    def __init__(self, path: str, cache_limit: int = 300_000):
        self.tokenizer = load(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        if (spec.get("pre_tokenizer") or {}).get("type") != "ByteLevel" or spec.get("normalizer"):
            raise ValueError("prefix counts need a byte-level BPE without normaliser")
        pairs = (tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"])
        self.rank = {pair: i for i, pair in enumerate(pairs)}
        self.halves: dict[str, tuple[str, str]] = {}
        for left, right in self.rank:
            self.halves.setdefault(left + right, (left, right))
        encode = self.tokenizer.model.tokenize
        # A token that is not its own encoding never occurs in any encoding.
        self.tokens = {t for t in spec["model"]["vocab"] if len(encode(t)) == 1}
        self.longest = max(map(len, self.tokens))
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        self.special_cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.table = str.maketrans({chr(b): c for b, c in byte_alphabet().items()})
        self.fits: dict[tuple[str, str], bool] = {}
        self.known: dict[str, str] = {}
        self.spaces: dict[str, bool] = {}
        self.starts: dict[str, list] = {}
        self.stops: dict[str, list] = {}
        self.cache = ChunkCache(self._chunk, cache_limit)
        self.batch, self.limit = BatchEncoder(path), cache_limit
        self.newer: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    # -- Borders between tokens --

    def _edge(self, token: str, side: int) -> list[tuple[str, int]]:
        """Pieces at one end of a token as merging builds it, with the rank at which each is absorbed."""
        known = (self.stops, self.starts)[1 - side]
        if token not in known:
            grown, rank = token, NEVER
            edge = []
            while True:
                edge.append((grown, rank))
                if grown not in self.halves:
                    break
                rank = self.rank[self.halves[grown]]
                grown = self.halves[grown][side]
            known[token] = edge[::-1]
        return known[token]

    def fit(self, a: str, b: str) -> bool:
        """Whether merging leaves the border between two tokens alone."""
        known = self.fits.get((a, b))
        if known is None:
            known = self.fits[a, b] = self._fit(self._edge(a, 1), self._edge(b, 0))
        return known

    def _fit(self, left: list, right: list) -> bool:
        i = j = 0
        while True:
            (x, x_until), (y, y_until) = left[i], right[j]
            joined = self.rank.get((x, y), NEVER)
            # Of equal merges the leftmost comes first: before the right one, after the left one.
            if joined < x_until and joined <= y_until and joined < NEVER:
                return False
            if x_until == y_until == NEVER:
                return True
            if x_until <= y_until:
                i += 1
            else:
                j += 1

    # -- Counts --

    def piece(self, mapped: str) -> list[int]:
        """Counts after each byte of one pre-token; what is known of its prefixes is used again."""
        known, fits, tokens = self.known, self.fits, self.tokens
        last: list[str] = []
        count: list[int] = []
        for end in range(1, len(mapped) + 1):
            prefix = mapped[:end]
            token = known.get(prefix)
            if token is not None:
                start = end - len(token)
            else:
                for start in range(max(0, end - self.longest), end):
                    token = mapped[start:end]
                    if token in tokens:
                        if not start:
                            break
                        pair = last[start - 1], token
                        fit = fits.get(pair)
                        if fit or (fit is None and self.fit(*pair)):
                            break
                if end <= KNOWN_LENGTH:
                    known[prefix] = token
            last.append(token)
            count.append(count[start - 1] + 1 if start else 1)
        return count

    def pre_token(self, text: str) -> list[int]:
        """Counts after each character of one pre-token."""
        if text in _ENDINGS:
            return [1, 2, self.piece(text)[-1]]
        if text.isascii():
            return self.piece(text if text.isalpha() else text.translate(self.table))
        counts = self.piece(text.encode().decode("latin-1").translate(self.table))
        chars, at = [], -1
        for c in text:
            at += 1 if c < "\x80" else 2 if c < "\u0800" else 3 if c < "\U00010000" else 4
            chars.append(counts[at])
        return chars

    def _chunk(self, cache: ChunkCache, key: str) -> bytes:
        if len(self.fits) > KNOWN_LIMIT:
            self.fits.clear()
        if len(self.known) > KNOWN_LIMIT:
            self.known.clear()
        if key.isalpha() and key.isascii():
            return array("I", self.piece("Ġ" + key)).tobytes()
        if key.isalpha() and max(key) < "ɐ":
            return array("I", self.pre_token(" " + key)).tobytes()
        marked = _MARKED.fullmatch(key)
        if marked:
            word, marks = marked.groups()
            base = int.from_bytes(cache[word][-4:], "little")
            return cache[word] + array("I", [base + c for c in self.piece(marks)]).tobytes()
        if key[:1] == "\n" and key[1:].isalpha() and max(key) < "ɐ":
            return array("I", [1, *(1 + c for c in self.pre_token(key[1:]))]).tobytes()
        return array("I", self._split(chunk_of(key))).tobytes()

    def _split(self, text: str) -> list[int]:
        """Counts over an ordinary text, pre-token by pre-token."""
        counts: list[int] = []
        base = 0
        for _, (start, end) in self.tokenizer.pre_tokenizer.pre_tokenize_str(text):
            counts += [base + c for c in self.pre_token(text[start:end])]
            base = counts[-1]
        return counts

    def _space(self, c: str) -> bool:
        """Whether the split pattern takes a character as white space."""
        if c not in self.spaces:
            cut = self.tokenizer.pre_tokenizer.pre_tokenize_str(f"a{c}{c}a")
            self.spaces[c] = c == " " or len(cut) == 4
        return self.spaces[c]

    def _ordinary(self, text: str) -> np.ndarray:
        """Counts over a text whose special strings count as ordinary text."""
        keys = keys_of(text)
        if keys is None:
            counts = np.array(self._split(text), dtype=np.int64)
            flags = [self._space(c) if not c.isalnum() else False for c in text]
            at = 0
            while at < len(text):
                stop = at
                while stop < len(text) and flags[stop]:
                    stop += 1
                if stop - at > 1:
                    self._close_run(counts, text, at, stop)
                at = max(stop, at + 1)
            return counts
        self.cache.trim()
        parts = list(map(self.cache.__getitem__, keys))
        flat = np.frombuffer(b"".join(parts), dtype="<u4").astype(np.int64)
        sizes = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts)) >> 2
        totals = flat[np.cumsum(sizes) - 1]
        counts = flat + np.repeat(np.cumsum(totals) - totals, sizes)
        for run in _RUNS.finditer(text):
            self._close_run(counts, text, *run.span())
        return counts

    def _close_run(self, counts: np.ndarray, text: str, start: int, stop: int) -> None:
        """A prefix that ends with a whole run of white space has that run as one pre-token."""
        before = counts[start - 1] if start else 0
        counts[start:stop] = before + np.array(self.pre_token(text[start:stop]))

    def counts(self, text: str) -> np.ndarray:
        """Number of tokens of each prefix; one entry per character."""
        if not text:
            return np.empty(0, np.int64)
        if not any(s in text for s in self.special):
            return self._ordinary(text)
        parts = self.special_cut.split(text)
        done: list[np.ndarray] = []
        base = 0
        for i in range(0, len(parts), 2):
            mark = parts[i + 1] if i + 1 < len(parts) else ""
            shown = self._ordinary(parts[i] + mark[:-1]) if parts[i] + mark[:-1] else np.empty(0, np.int64)
            done.append(base + shown)
            if mark:
                base += (shown[len(parts[i]) - 1] if parts[i] else 0) + 1
                done.append(np.array([base]))
        return np.concatenate(done)


    # -- Many texts --

    def budgets(self, texts: pa.Array, limit: int) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of every text, and the characters of its longest prefix of at most ``limit`` tokens.

        Texts are cut where every prefix has a border between pre-tokens too, and
        each different piece is counted once. Only prefixes that end in a run of
        white space go beyond a piece, so texts with such runs are counted whole.
        """
        rows = len(texts)
        tokens, chars = np.zeros(rows, np.int64), np.zeros(rows, np.int64)
        whole = self.batch.whole_texts(texts) | pc.match_substring_regex(texts, _BLANKS).to_numpy(zero_copy_only=False)
        for i in np.flatnonzero(whole).tolist():
            counts = self.counts(texts[i].as_py())
            tokens[i], chars[i] = (counts[-1] if len(counts) else 0), longest_within(counts, limit)
        plain = np.flatnonzero(~whole)
        pieces, which, first = self.batch.pieces(texts.take(pa.array(plain)))
        if not pieces:
            return tokens, chars
        counted = self._counted(pieces)
        sizes = np.fromiter(map(len, counted), np.int64, len(counted)) >> 2
        flat = np.frombuffer(b"".join(counted), "<u4")
        ends = np.cumsum(sizes)
        # Sums of tokens and characters before each piece, over all texts.
        sums = [np.concatenate([[0], np.cumsum(x[which])]) for x in (flat[ends - 1].astype(np.int64), sizes)]
        starts, stops = first[:-1], first[1:]
        tokens[plain] = sums[0][stops] - sums[0][starts]
        chars[plain] = sums[1][stops] - sums[1][starts]
        for i in np.flatnonzero(tokens[plain] > limit).tolist():
            # The last piece with room before it; every piece has a token at least.
            base = int(sums[0][starts[i]])
            j = int(np.searchsorted(sums[0][starts[i] : stops[i]], base + limit)) - 1 + int(starts[i])
            if j < starts[i]:
                chars[plain[i]] = 0
                continue
            own = which[j]
            inside = longest_within(flat[ends[own] - sizes[own] : ends[own]], base + limit - int(sums[0][j]))
            chars[plain[i]] = int(sums[1][j] - sums[1][starts[i]]) + inside
        return tokens, chars

    def _counted(self, pieces: list[bytes]) -> list[bytes]:
        """Counts after each character of pieces."""
        for known in (self.fits, self.known):
            if len(known) > KNOWN_LIMIT:
                known.clear()
        if len(self.newer) > self.limit:
            self.newer, self.older = {}, self.newer
        newer, older, out = self.newer, self.older, []
        for piece in pieces:
            counts = newer.get(piece)
            if counts is None:
                counts = older.get(piece)
                if counts is None:
                    text = piece.decode()
                    word = text[1:] if text[:1] == " " else text
                    letters = word.isalpha() and (word.isascii() or max(word) < "ɐ")
                    found = self.pre_token(text) if letters and not word.isascii() else None
                    if letters and found is None:
                        found = self.piece(text.replace(" ", "Ġ"))
                    counts = array("I", self._split(text) if found is None else found).tobytes()
                if len(piece) <= LONGEST_KEPT:
                    newer[piece] = counts
            out.append(counts)
        return out


@lru_cache(maxsize=2)
def counter(path: str) -> PrefixCounter:
    return PrefixCounter(path)


# ---- Questions ------------------------------------------------------------


def tokens_in(stored: bytes, n_chars: int) -> int:
    """Tokens of the first ``n_chars`` characters, from a stored array."""
    counts = np.frombuffer(stored, "<u4")
    return int(counts[min(n_chars, len(counts)) - 1]) if n_chars > 0 and len(counts) else 0


def longest_within(counts: np.ndarray, budget: int) -> int:
    """Characters of the longest prefix of at most ``budget`` tokens."""
    fit = np.flatnonzero(counts <= budget)
    return int(fit[-1]) + 1 if len(fit) else 0


def prefix_counts(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, prefix_tokens``: the counts of all prefixes as little-endian 32-bit integers.

    One row per row of ``docs``, equal and null ids included; a null or empty
    text has an empty array.
    """

    def work(pieces: Iterator[dict]) -> Iterator[dict]:
        count = counter(tokenizer)
        for piece in pieces:
            for doc_id, text in zip(piece["doc_id"].to_pylist(), piece["text"]):
                yield {"doc_id": [doc_id], "prefix_tokens": [count.counts(text).astype("<u4").tobytes()]}

    return by_batch(id_and_text(docs, id_col, text_col), "doc_id long, prefix_tokens binary", work)


def token_budgets(
    docs: DataFrame,
    tokenizer: str,
    limit: int = 512,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Size of every text in bytes and tokens, and how much of it fits a budget.

    ``fit_chars`` is the length of the longest prefix of at most ``limit``
    tokens. One row per row of ``docs``; a null or empty text has no tokens.
    """
    schema = "doc_id long, n_bytes long, n_tokens long, over_limit boolean, fit_chars long"

    def work(pieces: Iterator[dict]) -> Iterator[dict]:
        count = counter(tokenizer)
        for piece in pieces:
            texts = piece["text"].cast(pa.large_string())
            tokens, fits = count.budgets(texts, limit)
            yield {
                "doc_id": piece["doc_id"],
                "n_bytes": pc.binary_length(texts),
                "n_tokens": tokens,
                "over_limit": tokens > limit,
                "fit_chars": fits,
            }

    return by_batch(id_and_text(docs, id_col, text_col), schema, work, arrays=True)
