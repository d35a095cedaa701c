"""Licence scans: templates compiled to automata over words.

A template becomes a nondeterministic automaton whose mandatory words are
single steps, whose optional regions can be stepped over, and whose
replaceable regions take up to so many words of any kind. The longest run of
words that every match must contain is searched for first, as bytes; only
around its places is the automaton run.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import DataFrame

from tickwell.llm.license_templates import PHRASES, TEMPLATES
from tickwell.llm.tables import by_batch, id_and_text

PHRASE_SCORE = 0.6
_MARK = re.compile(r"<<(optional|end|any \d+)>>")
_KEPT = b"0123456789abcdefghijklmnopqrstuvwxyz"
_TABLE = bytes(
    b if b >= 0x80 or b in _KEPT else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256)
)


def words_of(text: str) -> list[bytes]:
    """Lower-cased runs of letters, digits and characters beyond ASCII."""
    return text.encode().translate(_TABLE).split()


def places(joined: bytes, phrase: bytes) -> list[int]:
    """Word positions at which a phrase stands; both begin and end with a space."""
    found, words, at, after = [], 0, 0, 0
    while (at := joined.find(phrase, at)) >= 0:
        words += joined.count(b" ", after, at)
        found.append(words)
        after = at
        at += 1
    return found


class Automaton:
    """The steps of one template: ``steps[s]`` maps a word to the next state, None to any word's."""

    def __init__(self, template: str):
        self.steps: list[dict[bytes | None, int]] = []
        self.skips: list[list[int]] = []
        state = self._state()
        opened: list[int] = []
        runs: list[list[bytes]] = [[]]
        for part in _MARK.split(template):
            kind = part.split(" ")[0]
            if kind == "optional" and _MARK.fullmatch(f"<<{part}>>"):
                opened.append(state)
                runs.append([])
            elif kind == "end" and _MARK.fullmatch(f"<<{part}>>"):
                self.skips[opened.pop()].append(state)
                runs.append([])
            elif kind == "any" and _MARK.fullmatch(f"<<{part}>>"):
                last = state
                inside = [state]
                for _ in range(int(part.split(" ")[1])):
                    following = self._state()
                    self.steps[last][None] = following
                    inside.append(last := following)
                state = self._state()
                for s in inside:
                    self.skips[s].append(state)
                runs.append([])
            else:
                for word in words_of(part):
                    following = self._state()
                    self.steps[state][word] = following
                    state = following
                    if not opened:
                        runs[-1].append(word)
        if opened:
            raise ValueError("an optional region is not closed")
        self.accept = state
        #: Every match contains this run of words.
        self.core = max(runs, key=lambda r: (len(b" ".join(r)), r))
        self.probe = b" " + b" ".join(self.core) + b" "
        #: No match has more words than the automaton has states.
        self.most_before = len(self.steps)

    def _state(self) -> int:
        self.steps.append({})
        self.skips.append([])
        return len(self.steps) - 1

    def _closed(self, states: set[int]) -> set[int]:
        todo = list(states)
        while todo:
            for following in self.skips[todo.pop()]:
                if following not in states:
                    states.add(following)
                    todo.append(following)
        return states

    def longest(self, words: list[bytes], start: int) -> int | None:
        """The end of the longest match that begins at ``start``."""
        states, end = self._closed({0}), None
        for at in range(start, len(words) + 1):
            if self.accept in states and at > start:
                end = at
            if at == len(words) or not states:
                break
            word = words[at]
            states = self._closed(
                {n for s in states for n in (self.steps[s].get(word), self.steps[s].get(None)) if n is not None}
            )
        return end

    def matches(self, words: list[bytes], joined: bytes) -> list[tuple[int, int]]:
        """Matches that contain the run, each from its earliest start, without overlap."""
        found: list[tuple[int, int]] = []
        for core in places(joined, self.probe):
            done = found[-1][1] if found else 0
            if core < done:
                continue
            for start in range(max(done, core - self.most_before), core + 1):
                end = self.longest(words, start)
                if end is not None and end >= core + len(self.core):
                    found.append((start, end))
                    break
        return found


AUTOMATA = [(label, score, Automaton(template)) for label, score, template in TEMPLATES]
_PHRASES = [(b" " + phrase.encode() + b" ", label) for phrase, label in PHRASES]

RESULT = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
    "labels string, score double, spans array<struct<label:string,start:int,stop:int>>"
)


def scan_text(text: str) -> tuple:
    words = words_of(text)
    joined = b" " + b" ".join(words) + b" "
    found = [(at, label) for phrase, label in _PHRASES for at in places(joined, phrase)]
    starts = [at for at, _ in found]
    base = {label for _, label in found}
    spans, score = [], PHRASE_SCORE if found else 0.0
    for label, strength, automaton in AUTOMATA:
        for start, stop in automaton.matches(words, joined):
            spans.append({"label": label, "start": start, "stop": stop})
            score = max(score, strength)
    labels = base | {s["label"] for s in spans}
    return (
        len(words),
        len(found),
        min(starts, default=None),
        max(starts, default=None),
        ",".join(sorted(base)),
        ",".join(sorted(labels)),
        score,
        spans,
    )


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Phrases, labels and matched word spans of every whole text.

    ``score`` is the strength of the best evidence: 1 for a licence text or
    full notice, 0.8 for a short notice, 0.6 for a phrase alone, 0 for none.
    One row per row of ``docs``; a null text counts as empty and has no labels.
    """

    def work(pieces: Iterator[dict]) -> Iterator[dict]:
        names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]
        for piece in pieces:
            columns = zip(*map(scan_text, piece["text"]))
            yield {"doc_id": piece["doc_id"]} | dict(zip(names, map(list, columns)))

    return by_batch(id_and_text(docs, id_col, text_col), RESULT, work)
