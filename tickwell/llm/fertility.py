"""Quality rules on words, symbols and repeats, and on how well a public vocabulary fits a text.

Per text: characters per token, the share of byte-fallback tokens and the
evenness of the token distribution (its entropy over the greatest entropy that
so many tokens can have). For each language, or script where the language is
not a known one, the quartiles of these figures over all texts give rejection
bands: a text is rejected if it lies further outside the quartiles than
``reach`` times their distance, and at least a fixed margin. Figures of short
texts vary more, so below ``STEADY_TOKENS`` tokens the bands widen with the
root of the missing length.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwell.llm.tables import by_batch, written

WINDOW = 8
LEAST_WORDS = 20
REPEATED_PERCENT = 30
#: The symbols that are counted, and the bytes between words.
SYMBOLS = b"#*$%&|<>"
BLANKS = b" \t\n\v\f\r"
#: Where the letters of a script begin in the code chart, in ascending order.
SCRIPTS = (
    (0x0041, "latin"),
    (0x0370, "greek"),
    (0x0400, "cyrillic"),
    (0x0530, "other"),
    (0x0590, "hebrew"),
    (0x0600, "arabic"),
    (0x0700, "other"),
    (0x0900, "devanagari"),
    (0x0980, "other"),
    (0x0E00, "thai"),
    (0x0E80, "other"),
    (0x1E00, "latin"),
    (0x1F00, "greek"),
    (0x2000, "other"),
    (0x3040, "kana"),
    (0x3100, "other"),
    (0x3400, "han"),
    (0xA000, "other"),
    (0xAC00, "hangul"),
    (0xD7B0, "other"),
)
LANGUAGES = ("ar", "de", "en", "es", "fr", "hi", "it", "ja", "ko", "nl", "pl", "pt", "ru", "tr", "zh")
#: Name of a figure: how far outside the quartiles it may lie on either side at the least, and which sides reject.
MARGINS = {
    "chars_per_token": (0.12, "both"),
    "byte_share": (0.02, "above"),
    "evenness": (0.1, "both"),
}
REACH = 3.0
STEADY_TOKENS = 400
_STARTS = np.array([0, *(start for start, _ in SCRIPTS)], dtype=np.uint32)
_NAMES = ("other", *(name for _, name in SCRIPTS))
_WEIGHTS = np.array([3**i for i in range(WINDOW)], dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words in windows of ``window`` words that occur twice or more, first ones included."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    hashes = np.fromiter(map(hash, words), dtype=np.int64, count=len(words)).astype(np.uint64)
    sums = np.zeros(n, dtype=np.uint64)
    for j in range(window):
        sums += hashes[j : j + n] * _WEIGHTS[j]
    order = np.sort(sums)
    twice = order[1:][order[1:] == order[:-1]]
    if not len(twice):
        return 0
    # Equal hashes only point to windows; the words decide.
    at = np.flatnonzero(np.isin(sums, twice)).tolist()
    found = [tuple(words[i : i + window]) for i in at]
    seen = Counter(found)
    change = np.zeros(len(words) + 1, dtype=np.int64)
    for i, key in zip(at, found):
        if seen[key] > 1:
            change[i] += 1
            change[i + window] -= 1
    return int((np.cumsum(change) > 0).sum())


def repeated_lines(text: str) -> int:
    """Lines with a word that are equal to an earlier line."""
    blank = BLANKS.decode()
    lines = [line for line in text.split("\n") if line.strip(blank)]
    return len(lines) - len(set(lines))


def script_of(text: str) -> str:
    """The script of most letters."""
    if text.isascii():
        return "latin"
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    points = points[points >= 0x41]
    kinds = np.bincount(np.searchsorted(_STARTS, points, side="right") - 1, minlength=len(_NAMES))
    totals: dict[str, int] = {}
    for name, count in zip(_NAMES, kinds.tolist()):
        totals[name] = totals.get(name, 0) + count
    return max(sorted(totals), key=totals.__getitem__)


class Vocabulary:
    """Ids of words in a sentencepiece vocabulary with byte fallback."""

    def __init__(self, path: str, cache_limit: int = 300_000):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = self.model.get_piece_size()
        self.kind = np.uint16 if size <= 1 << 16 else np.uint32
        self.is_byte = np.array([self.model.is_byte(i) for i in range(size)])
        self.limit = cache_limit
        self.known: dict[bytes, bytes] = {}

    def ids(self, words: list[bytes]) -> np.ndarray:
        known = self.known
        new = [w for w in set(words) if w not in known]
        if new:
            if len(known) > self.limit:
                known.clear()
                new = list(set(words))
            texts = [w.decode("utf-8", "replace") for w in new]
            for word, ids in zip(new, self.model.encode(texts, num_threads=1)):
                known[word] = np.array(ids, dtype=self.kind).tobytes()
        return np.frombuffer(b"".join(map(known.__getitem__, words)), dtype=self.kind)


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def evenness(ids: np.ndarray) -> float:
    """Entropy of the token distribution over that of as many different tokens; 1 for a single token."""
    if len(ids) < 2:
        return 1.0
    counts = np.bincount(ids)
    shares = counts[counts > 0] / len(ids)
    return float(-(shares * np.log2(shares)).sum() / np.log2(len(ids)))


FIGURES = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "band string, n_vocab_tokens long, chars_per_token double, byte_share double, evenness double"
)


def figures(
    docs: DataFrame,
    vocabulary_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str | None = "lang",
) -> DataFrame:
    """All counts and figures of every whole text; those of tokens are null for a text without words."""
    lang = F.col(lang_col).cast("string") if lang_col else F.lit(None).cast("string")
    source = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
        F.coalesce(F.lower(lang), F.lit("")).alias("lang"),
    )

    def work(pieces: Iterator[dict]) -> Iterator[dict]:
        pieces_of = vocabulary(vocabulary_path)
        for piece in pieces:
            rows = []
            for text, language in zip(piece["text"], piece["lang"]):
                raw = text.encode()
                words = raw.split()
                chars = len(text) - (len(raw) - len(raw.translate(None, BLANKS)))
                ids = pieces_of.ids(words)
                n = len(ids)
                rows.append(
                    (
                        len(words),
                        chars,
                        len(raw) - len(raw.translate(None, SYMBOLS)),
                        repeated_lines(text),
                        repeated_words(words),
                        language if language in LANGUAGES else script_of(text),
                        n,
                        chars / n if n else None,
                        float(pieces_of.is_byte[ids].mean()) if n else None,
                        evenness(ids) if n else None,
                    )
                )
            names = [f.split()[0] for f in FIGURES.split(", ")[1:]]
            yield {"doc_id": piece["doc_id"]} | dict(zip(names, map(list, zip(*rows))))

    return by_batch(source, FIGURES, work)


def bands(table: DataFrame, reach: float = REACH) -> DataFrame:
    """Quartiles of each figure by language or script, over all its texts, and the room outside them.

    At most one row per entry of ``LANGUAGES`` and ``SCRIPTS``.
    """
    usable = table.where(F.col("n_words") >= LEAST_WORDS)
    quartiles = usable.groupBy("band").agg(
        *[F.percentile_approx(name, [0.25, 0.75], 10_000).alias(name) for name in MARGINS]
    )
    limits: list[Column] = []
    for name, (margin, _) in MARGINS.items():
        low, high = F.col(name)[0], F.col(name)[1]
        limits += [low.alias(f"{name}_low"), high.alias(f"{name}_high")]
        limits.append(F.greatest((high - low) * reach, F.lit(margin)).alias(f"{name}_room"))
    return quartiles.select("band", *limits)


def quality_rules(docs: DataFrame, vocabulary_path: str, reach: float = REACH, **columns) -> DataFrame:
    """Counts, figures and verdicts of every text.

    ``base_failed``: fewer than 20 words, or over 30 % of the words in repeated
    windows. ``kept`` is false for those and for texts outside the bands. One
    row per row of ``docs``; a null text counts as empty and fails.
    """
    table = written(figures(docs, vocabulary_path, **columns))
    rows = table.join(F.broadcast(bands(table, reach)), "band", "left")
    wider = F.greatest(F.lit(1.0), F.sqrt(F.try_divide(F.lit(STEADY_TOKENS), F.col("n_vocab_tokens"))))
    inside = F.lit(True)
    for name, (_, sides) in MARGINS.items():
        room = F.col(f"{name}_room") * wider
        outside = F.col(name) > F.col(f"{name}_high") + room
        if sides == "both":
            outside = outside | (F.col(name) < F.col(f"{name}_low") - room)
        inside = inside & ~F.coalesce(outside, F.lit(False))
    failed = (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > REPEATED_PERCENT * F.col("n_words")
    )
    return rows.select(
        *table.columns, failed.alias("base_failed"), (~failed & inside).alias("kept")
    )
