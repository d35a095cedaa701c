import hashlib
import math
import random

import numpy as np
import pytest

from tests.compare import connect, difference
from tickwell.llm import vectorcodes as vc
from tickwell.llm.oracle import ORACLE
from tickwell.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, parts, entries, rounds):
    """The same with loops over Python's integers."""
    kept = []
    for vec_id, vector, label in rows:
        if vector and all(x is not None and math.isfinite(x) for x in vector):
            kept.append((vec_id, [math.floor(256 * x) for x in vector], label))
    size = len(kept[0][1]) // parts
    kept = [r for r in kept if len(r[1]) == size * parts]
    cut = [[v[p * size : (p + 1) * size] for p in range(parts)] for _, v, _ in kept]
    order = sorted(range(len(kept)), key=lambda i: (kept[i][0] is None, kept[i][0] or 0, kept[i][1]))[:entries]
    books = [[list(cut[i][p]) for i in order] for p in range(parts)]

    def near(p, part):
        return min((sum((x - y) ** 2 for x, y in zip(part, e)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        chosen = [[[] for _ in books[p]] for p in range(parts)]
        for v in cut:
            for p in range(parts):
                chosen[p][near(p, v[p])[1]].append(v[p])
        for p in range(parts):
            for k, own in enumerate(chosen[p]):
                if own:
                    books[p][k] = [sum(c) // len(own) for c in zip(*own)]
    digest = hashlib.sha256(",".join(str(x) for p in books for e in p for x in e).encode()).hexdigest()
    out = []
    for (vec_id, _, label), v in zip(kept, cut):
        found = [near(p, v[p]) for p in range(parts)]
        out.append((vec_id, "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found), label))
    totals = {}
    for *_, error, label in out:
        totals[label] = totals.get(label, 0) + error
    return sorted(((i, c, e, totals[label], digest) for i, c, e, label in out), key=repr)


def vectors(n, width, seed, spread=0.03):
    pick = random.Random(seed)
    # Steps of a sixteenth: parts repeat and share beginnings.
    return [[round(pick.gauss(0, spread * 16)) / 16 for _ in range(width)] for _ in range(n)]


def test_trie_gives_plain_distances():
    pick = np.random.default_rng(1)
    parts, entries = pick.integers(-4, 4, (9_000, 4)), pick.integers(-4, 4, (13, 4))
    nearest, distance = vc.assign(parts, entries)
    all_of = ((parts[:, None, :] - entries[None]) ** 2).sum(axis=2)
    assert (nearest == all_of.argmin(axis=1)).all() and (distance == all_of.min(axis=1)).all()
    sums, seen = vc.weighted_sums(parts, entries)
    assert (seen == np.bincount(nearest, minlength=13)).all()
    assert (sums == np.array([parts[nearest == k].sum(axis=0) for k in range(13)])).all()


def test_common_beginnings_are_added_once(monkeypatch):
    monkeypatch.setattr(vc, "LEAVES", 5)
    leaves, _, _ = vc.distinct_parts(np.array([[1, 2, 3], [1, 2, 4], [1, 3, 0], [2, 0, 0], [1, 2, 3], [7, 7, 7], [8, 8, 8]]))
    assert len(leaves) == 6
    found = list(vc.trie_distances(leaves, np.array([[0, 0, 0], [1, 2, 3]])))
    assert [start for start, _ in found] == [0, 5]
    assert np.concatenate([d for _, d in found]).tolist() == [[14, 0], [21, 1], [10, 10], [4, 14], [147, 77], [192, 110]]


@pytest.mark.parametrize("n, width, parts, entries", [(150, 8, 4, 6), (40, 16, 16, 64), (3, 4, 2, 4)])
def test_codes(spark, n, width, parts, entries):
    rows = [(i * 3 % 101, v, i % 3 if i % 5 else None) for i, v in enumerate(vectors(n, width, n))]
    rows += [(500, [0.0] * width, 1), (501, [-0.001] * width, 1), (501, [-0.001] * width, 1)]
    rows += [(502, None, 1), (503, [], 1), (504, [float("nan")] * width, 1), (505, [float("inf")] * width, 1)]
    rows += [(506, [None] * width, 1), (None, [0.5] * width, None), (507, [0.25] * (width + 1), 1)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    df = df.withColumns({c: df["label"] for c in ("code", "error", "vector", "finite", "_of", "place")})
    got = sorted((tuple(r) for r in vc.vector_codes(df, parts, entries).collect()), key=repr)
    assert got == plain(rows, parts, entries, vc.ROUNDS)


def test_huge_components(spark):
    rows = [(i, [x * 10.0**12 for x in v], None) for i, v in enumerate(vectors(12, 4, 1))]
    rows = [(i, np.array(v, dtype=np.float32).astype(float).tolist(), label) for i, v, label in rows]
    got = {r["vec_id"]: r for r in vc.vector_codes(spark.createDataFrame(rows, SCHEMA), 2, 3).collect()}
    for vec_id, code, error, *_ in plain(rows, 2, 3, vc.ROUNDS):
        assert got[vec_id]["code"] == code
        assert got[vec_id]["error"] == (error if error < 1 << 63 else None)


def test_no_vectors(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert vc.vector_codes(empty).count() == 0
    assert vc.vector_codes(spark.createDataFrame([(1, None, 1)], SCHEMA)).count() == 0
    assert vc.vector_codes(spark.createDataFrame([(1, [0.5] * 16, 1)], SCHEMA).drop("label")).count() == 1


def test_query_equals_its_sql(spark):
    sf = "/root/testdata/sf0.01"
    name = "op12_trie_codes"
    assert difference(spark, connect(sf), sf, QUERIES[name], ORACLE[name]) is None
