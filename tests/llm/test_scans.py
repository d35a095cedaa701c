import random
import re
from collections import Counter

import public_tokenizers

from tests.llm.messy import ROWS, messy, nothing, rows
from tickwell.llm import fertility as fe
from tickwell.llm import licenses as li
from tickwell.llm.license_templates import PHRASES, TEMPLATES

PIECES = public_tokenizers.path("piece_bpe_32k.model")
FILL = "Some Name 2020"


def plain_words(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def plain_places(text):
    words = plain_words(text)
    return words, sorted(
        (i, label)
        for phrase, label in PHRASES
        for i in range(len(words))
        if words[i : i + len(phrase.split())] == phrase.split()
    )


def test_phrases_stand_where_they_stand():
    pick = random.Random(1)
    parts = ["under the MIT", "license", "License,", "Apache", "version 2", "cc-by/nc", "CC", "by", "nc", "É", "x", "\n", "under"]
    for _ in range(500):
        text = " ".join(pick.choice(parts) for _ in range(pick.randint(0, 20)))
        words, found = plain_places(text)
        got = li.scan_text(text)
        starts = [i for i, _ in found]
        assert got[:4] == (len(words), len(found), min(starts, default=None), max(starts, default=None))
        assert got[4] == ",".join(sorted({label for _, label in found}))


def filled(template, optional):
    text = re.sub(r"<<optional>>(.*?)<<end>>", r" \1 " if optional else " ", template, flags=re.S)
    return re.sub(r"<<any \d+>>", FILL, text)


def test_templates_accept_their_own_texts_and_nothing_less():
    for label, score, template in TEMPLATES:
        for optional in (False, True):
            text = "before " + filled(template, optional) + " after"
            got = li.scan_text(text)
            assert label in got[5].split(","), (label, optional)
            assert got[6] >= score
        words = plain_words(filled(template, False))
        automaton = li.Automaton(template)
        core = [w.decode() for w in automaton.core]
        at = next(i for i in range(len(words)) if words[i : i + len(core)] == core)
        broken = [w.encode() for w in [*words[:at], "changed", *words[at + 1 :]]]
        assert automaton.matches(broken, b" " + b" ".join(broken) + b" ") == []


def test_replaceable_regions_end():
    template = li.Automaton("granted to <<any 2>> for use")
    for n, found in ((0, True), (2, True), (3, False)):
        words = [b"granted", b"to", *[b"x"] * n, b"for", b"use"]
        assert bool(template.matches(words, b" " + b" ".join(words) + b" ")) == found


def test_scan_of_messy_documents(spark):
    got = rows(li.scan(messy(spark)).select("doc_id", "n_words", "labels"))
    assert got == sorted(((i, len(plain_words(t or "")), "") for i, t, *_ in ROWS), key=repr)
    assert li.scan(nothing(spark)).count() == 0


def plain_quality(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    hit = {i + j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = len(words) < 20 or 100 * len(hit) > 30 * len(words)
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return (len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(hit), failed)


def test_quality_counts():
    pick = random.Random(2)
    parts = ["a", "bb", "é中", "\n", "\t", "#", "$%", "x y z", "　", "\x85", "q\x1cq"]
    for _ in range(400):
        text = " ".join(pick.choice(parts) for _ in range(pick.randint(0, 60)))
        raw = text.encode()
        words = raw.split()
        chars = len(text) - (len(raw) - len(raw.translate(None, fe.BLANKS)))
        got = (len(words), chars, len(raw) - len(raw.translate(None, fe.SYMBOLS)), fe.repeated_lines(text), fe.repeated_words(words))
        assert got == plain_quality(text)[:5], repr(text)


def test_quality_rules_on_messy_documents(spark):
    table = fe.quality_rules(messy(spark), PIECES)
    got = rows(table.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"))
    assert got == sorted(((i, *plain_quality(t or "")) for i, t, *_ in ROWS), key=repr)
    assert table.where("base_failed and kept").count() == 0
    assert fe.quality_rules(nothing(spark), PIECES).count() == 0


def test_bands_reject_what_lies_outside(spark):
    pick = random.Random(3)
    common = ["the", "house", "water", "people", "great", "small", "river", "green", "under", "light", "time", "world"]
    docs = [(i, " ".join(pick.choice(common) for _ in range(300)), "en") for i in range(200)]
    docs.append((900, " ".join("".join(pick.choice("qxzjkvw") for _ in range(9)) for _ in range(300)), "en"))
    docs.append((901, " ".join("\U00010380\U00010381" for _ in range(100)) + " a b", "en"))
    table = fe.quality_rules(spark.createDataFrame(docs, "doc_id long, text string, lang string"), PIECES)
    kept = {r["doc_id"]: r["kept"] for r in table.collect()}
    assert not kept[900] and not kept[901]
    assert all(kept[i] for i in range(200))


def test_texts_without_tokens_get_verdicts(spark):
    plain = " ".join(f"word{i}" for i in range(40))
    docs = [(i, plain, "en") for i in range(30)] + [(100, "", "en"), (101, None, "en"), (102, " \n\t ", "en"), (103, "", None)]
    table = fe.quality_rules(spark.createDataFrame(docs, "doc_id long, text string, lang string"), PIECES)
    found = {r["doc_id"]: r for r in table.collect()}
    assert len(found) == len(docs) and all(found[i]["kept"] for i in range(30))
    for i in range(100, 104):
        assert found[i]["n_vocab_tokens"] == 0 and found[i]["chars_per_token"] is None
        assert found[i]["base_failed"] and not found[i]["kept"]


def test_scripts():
    assert [fe.script_of(t) for t in ("plain", "Übergröße", "привет мир", "中文字", "한국어", "ελλάδα")] == [
        "latin", "latin", "cyrillic", "han", "hangul", "greek",
    ]


def random_template(pick, depth=0):
    """A template, and the same as a regular expression over words that each begin with a space."""
    text, pattern = [], ""
    for _ in range(pick.randint(1, 4)):
        kind = pick.choice(["word", "word", "any", "optional"] if depth < 2 else ["word", "any"])
        if kind == "word":
            word = pick.choice("abc")
            text.append(word)
            pattern += f" {word}"
        elif kind == "any":
            n = pick.randint(1, 2)
            text.append(f"<<any {n}>>")
            pattern += rf"(?: \S+){{0,{n}}}"
        else:
            inner, expression = random_template(pick, depth + 1)
            text.append(f"<<optional>>{inner}<<end>>")
            pattern += f"(?:{expression})?"
    return " ".join(text), pattern


def test_automata_match_what_regular_expressions_match():
    pick = random.Random(7)
    matched = 0
    for _ in range(300):
        template, pattern = random_template(pick)
        automaton, expression = li.Automaton(template), re.compile(pattern)
        for _ in range(20):
            words = [pick.choice("abcd") for _ in range(pick.randint(0, 9))]
            for start in range(len(words)):
                ends = [e for e in range(start + 1, len(words) + 1) if expression.fullmatch(" " + " ".join(words[start:e]))]
                got = automaton.longest([w.encode() for w in words], start)
                assert got == max(ends, default=None), (template, words, start)
                matched += got is not None
    assert matched > 1_000


def test_verdicts_against_plain_bands(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = [r.asDict() for r in fe.quality_rules(docs, PIECES).collect()]
    limits = {}
    for band in {r["band"] for r in found}:
        own = [r for r in found if r["band"] == band and r["n_words"] >= fe.LEAST_WORDS]
        for name, (margin, _) in fe.MARGINS.items():
            values = sorted(r[name] for r in own)
            if values:
                low, high = (values[max(0, -(-len(values) * q // 4) - 1)] for q in (1, 3))
                limits[band, name] = (low, high, max((high - low) * fe.REACH, margin))
    for r in found:
        failed = r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"]
        outside = False
        for name, (_, sides) in fe.MARGINS.items():
            if r[name] is not None and (r["band"], name) in limits:
                low, high, room = limits[r["band"], name]
                room *= max(1.0, (fe.STEADY_TOKENS / r["n_vocab_tokens"]) ** 0.5)
                outside |= r[name] > high + room or (sides == "both" and r[name] < low - room)
        assert r["base_failed"] == failed and r["kept"] == (not failed and not outside), r
    assert 0.5 < sum(r["kept"] for r in found) / len(found) < 1
