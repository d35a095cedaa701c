import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.messy import ROWS, messy, nothing, rows
from tickwell.llm import anchors, neardup, repeats
from tickwell.llm.components import components
from tickwell.llm.suffixruns import common, decode, encode, merge

DOCS = "doc_id long, text string"


def plain_sets(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())


def plain_components(docs):
    """Smallest id reachable, over all pairs; rows of one id are one node."""
    sets = [(i, plain_sets(t)) for i, t in docs if i is not None]
    lead = {i: i for i, _ in sets}

    def root(i):
        while lead[i] != i:
            i = lead[i]
        return i

    for a, x in sets:
        for b, y in sets:
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                p, q = sorted((root(a), root(b)))
                lead[q] = p
    return {i: root(i) for i in lead}


def edited(words, n, pick):
    words = list(words)
    for _ in range(n):
        words[pick.randrange(len(words))] = f"new{pick.randrange(10**6)}"
    return " ".join(words)


def test_near_copies_match_all_pairs(spark):
    pick = random.Random(4)
    docs = []
    for family in range(12):
        base = [f"w{pick.randrange(5_000)}" for _ in range(pick.randint(3, 150))]
        for _ in range(pick.randint(1, 14)):
            docs.append((len(docs), edited(base, pick.choice([0, 0, 1, 1, 2, 3, 5]), pick)))
    # A chain: each is near the next, the ends are not near each other.
    chain = [f"c{i}" for i in range(200)]
    for step in range(0, 60, 10):
        docs.append((len(docs), " ".join(chain[step : step + 140])))
    pick.shuffle(docs)
    got = {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(spark.createDataFrame(docs, DOCS)).collect()}
    assert got == plain_components(docs)


def test_one_large_family_of_near_copies(spark, monkeypatch):
    """Copies of one text whose edits put many of them just below and above the limit."""
    monkeypatch.setattr(neardup, "BLOCK", 16)
    pick = random.Random(9)
    base = [f"w{i}" for i in range(160)]
    docs = [(i, edited(base, pick.randint(0, 9), pick)) for i in range(260)]
    got = {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(spark.createDataFrame(docs, DOCS)).collect()}
    want = plain_components(docs)
    assert len(set(want.values())) > 3
    assert got == want


def test_near_copies_on_messy_documents(spark):
    table = neardup.near_duplicates(messy(spark))
    found = plain_components([(i, t) for i, t, *_ in ROWS])
    want = [(i, len(plain_sets(t)), found.get(i), i is None or i == found[i]) for i, t, *_ in ROWS]
    assert rows(table.select("doc_id", "n_shingles", "component_id", "kept")) == sorted(want, key=repr)
    assert neardup.near_duplicates(nothing(spark)).count() == 0


def test_one_row_of_each_group_stays(spark):
    left = neardup.drop_copies(messy(spark))
    assert left.columns == messy(spark).columns
    assert sorted((r["doc_id"] or 0) for r in left.collect()) == [0, 0, 1, 2, 4, 5, 6, 7, 8, 9, 10]
    assert neardup.drop_copies(nothing(spark)).count() == 0


def test_sketches_estimate_high_similarity():
    import numpy as np

    pick = np.random.default_rng(1)
    for share in (0.75, 0.9):
        both = pick.integers(0, 1 << 63, int(1_000 * share), dtype=np.uint64)
        extra = pick.integers(0, 1 << 63, 1_000 - len(both), dtype=np.uint64)
        half = len(extra) // 2
        sides = [np.concatenate([both, extra[:half]]), np.concatenate([both, extra[half:]])]
        a, b = neardup.odd_sketches(np.stack([neardup.signature(s) for s in sides]))
        bits = sum(int(x).bit_count() for x in (a ^ b).view(np.uint64))
        assert bits <= neardup.most_different_bits()


@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30)), max_size=40))
@settings(max_examples=4, deadline=None)
def test_components(spark, edges):
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    lead = {n: n for e in edges for n in e if e[0] != e[1]}
    for _ in lead:
        for a, b in edges:
            if a != b:
                lead[a] = lead[b] = min(lead[a], lead[b])
    assert got == lead


def test_components_of_a_path(spark):
    path = [(i, i + 1) for i in range(100)]
    got = components(spark.createDataFrame(path, "a long, b long")).collect()
    assert {(r["node"], r["component"]) for r in got} == {(i, 0) for i in range(101)}


@given(st.lists(st.lists(st.tuples(st.text("ab", max_size=6), st.integers(0, 9)), max_size=9), max_size=7))
@settings(max_examples=200, deadline=None)
def test_merged_runs_are_sorted_and_know_what_they_share(runs):
    runs = [sorted((t.encode(), bytes([n])) for t, n in run) for run in runs]
    assert all([e[1:] for e in decode(encode(run))] == run for run in runs)
    merged = list(merge([decode(encode(run)) for run in runs]))
    assert [e[1:] for e in merged] == sorted(e for run in runs for e in run)
    assert all(y[0] == common(x[1], y[1]) for x, y in zip(merged, merged[1:]))


def test_equal_windows_have_equal_anchors():
    pick = random.Random(5)
    shared = bytes(pick.randrange(97, 100) for _ in range(180))
    places = []
    for _ in range(2):
        before = bytes(pick.randrange(97, 100) for _ in range(pick.randrange(90)))
        _, _, first, last, anchor = anchors.window_runs(before + shared + before, 100)
        at = {p: a - p for f, e, a in zip(first, last, anchor) for p in range(f, e + 1)}
        places.append([at[len(before) + p] for p in range(81)])
    assert places[0] == places[1]


def plain_repeats(docs, length=100):
    seen, out = set(), {}
    for key in sorted({(i is not None, i or 0, t or "") for i, t in docs}):
        raw = key[2].encode()
        gone = bytearray(len(raw))
        for p in range(len(raw) - length + 1):
            window = raw[p : p + length]
            if window in seen:
                gone[p : p + length] = b"\1" * length
            seen.add(window)
        left = bytes(b for b, g in zip(raw, gone) if not g)
        runs = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out[key[1] if key[0] else None, key[2]] = (len(raw), sum(gone), runs, hashlib.sha256(left).hexdigest())
    return out


def repeated_docs():
    pick = random.Random(6)
    letters = "abcdefgh "
    pool = ["".join(pick.choice(letters) for _ in range(pick.randint(80, 300))) for _ in range(6)]
    docs = []
    for i in range(150):
        parts = []
        for _ in range(pick.randint(0, 5)):
            kind, text = pick.random(), pick.choice(pool)
            cut = pick.randint(0, 60)
            fresh = "".join(pick.choice(letters) for _ in range(pick.randint(0, 150)))
            period = pick.choice(["ab", "é", "x"]) * pick.randint(0, 200)
            parts.append(text[cut : cut + pick.randint(60, 240)] if kind < 0.4 else fresh if kind < 0.7 else period if kind < 0.9 else text)
        docs.append((i, "".join(parts)))
    return [*docs, (500, None), (501, ""), (None, docs[3][1]), (502, docs[4][1]), (502, docs[4][1])]


def test_repeats_match_all_windows(spark):
    docs = repeated_docs()
    want = plain_repeats(docs)
    got = rows(repeats.remove_repeats(spark.createDataFrame(docs, DOCS)))
    assert got == sorted(((i, *want[i, t or ""]) for i, t in docs), key=repr)


def test_repeats_on_messy_documents(spark):
    docs = [(i, t) for i, t, *_ in ROWS if i != 9]
    want = plain_repeats(docs)
    got = rows(repeats.remove_repeats(messy(spark).where("doc_id is null or doc_id <> 9")))
    assert got == sorted(((i, *want[i, t or ""]) for i, t in docs), key=repr)
    assert repeats.remove_repeats(nothing(spark)).count() == 0
    assert repeats.remove_repeats(messy(spark), with_text=True).count() == len(ROWS)


@pytest.mark.parametrize("most, held", [(0, 1 << 19), (4, 50)])
def test_frequent_anchors_go_by_windows(spark, monkeypatch, most, held):
    """No merging task gets more runs of an anchor than the bound, and the result stays."""
    monkeypatch.setattr(repeats, "MOST_OF_ANCHOR", most)
    monkeypatch.setattr(repeats, "WINDOWS_HELD", held)
    merged, by_windows = repeats._suffix_runs, []
    monkeypatch.setattr(repeats, "_suffix_runs", lambda texts, *x: by_windows.append(texts.selectExpr("sum(size(spans))").first()[0] or 0) or merged(texts, *x))
    pick = random.Random(8)
    line = "a line of sixty bytes that many documents share, and no more."
    docs = repeated_docs()
    for i in range(60):
        around = ["".join(pick.choice("abcdefgh ") for _ in range(120)) for _ in range(2)]
        docs.append((1_000 + i, around[0] + line + (around[1] if i % 3 else "the same end of every third document, as it is" + around[1])))
    want = plain_repeats(docs)
    got = rows(repeats.remove_repeats(spark.createDataFrame(docs, DOCS)))
    assert got == sorted(((i, *want[i, t or ""]) for i, t in docs), key=repr)
    assert most or by_windows == [0]
