import zlib

import numpy as np
import public_tokenizers
import pytest

from tests.llm.messy import ROWS, messy, nothing
from tickwell.llm import packing
from tickwell.llm.wordids import BatchEncoder

BPE = public_tokenizers.path("byte_bpe_50k.json")


def best_fit(lengths, capacity):
    """Number of sequences of best-fit decreasing, the usual way."""
    rooms, n = [0] * (capacity + 1), 0
    for size in sorted(lengths, reverse=True):
        room = next((r for r in range(size, capacity + 1) if rooms[r]), None)
        if room is None:
            n, room = n + 1, capacity
        else:
            rooms[room] -= 1
        rooms[room - size] += 1
    return n


def checked(lengths, capacity):
    """Number of sequences of a plan, after a look at every piece."""
    sizes, counts = np.unique(np.asarray(lengths, dtype=np.int64), return_counts=True)
    plan = packing.plan(sizes, counts, capacity)
    length = np.repeat(sizes, counts)
    number = np.concatenate([np.arange(n) for n in counts]) if len(counts) else np.empty(0, np.int64)
    sequence, offset = plan.place(length, number)
    gapless(sequence, offset, length, capacity)
    assert plan.sequences == len(set(sequence.tolist()))
    return plan.sequences


def gapless(sequence, offset, length, capacity):
    filled = {}
    for s, o, n in sorted(zip(sequence.tolist(), offset.tolist(), length.tolist())):
        assert filled.get(s, 0) == o and o + n <= capacity
        filled[s] = o + n


@pytest.mark.parametrize(
    "low, high, n, capacity", [(1, 2048, 3000, 2048), (600, 1100, 4000, 2048), (500, 900, 4000, 2048), (3, 9, 5000, 64), (1, 2, 50, 8)]
)
def test_no_more_sequences_than_best_fit(low, high, n, capacity):
    lengths = np.random.default_rng(low).integers(low, high, n)
    assert -(-int(lengths.sum()) // capacity) <= checked(lengths, capacity) <= best_fit(lengths.tolist(), capacity)


def test_mixed_lengths_fill_all_sequences():
    lengths = np.minimum(2048, np.random.default_rng(3).lognormal(6.3, 1.3, 20_000).astype(int) + 1)
    assert checked(lengths, 2048) <= -(-int(lengths.sum()) // 2048) + 1


def test_plans_of_few_pieces():
    assert checked([], 8) == 0
    assert checked([8], 8) == 1
    assert checked([5, 5, 5, 3, 3, 3], 8) == 3
    # One length may hold a third of all pieces.
    assert checked([1000] * 100_000 + [48] * 50_000 + [700] * 7, 2048) == 50_004


def test_small_exact_optimum():
    """Against all ways of packing a few pieces."""
    pick = np.random.default_rng(5)

    def least(lengths, rooms):
        if not lengths:
            return len(rooms)
        size, rest = lengths[0], lengths[1:]
        found = [least(rest, rooms[:i] + (r - size,) + rooms[i + 1 :]) for i, r in enumerate(rooms) if r >= size]
        return min([*found, least(rest, (*rooms, 10 - size))])

    for _ in range(25):
        lengths = sorted(pick.integers(1, 11, 7).tolist(), reverse=True)
        assert checked(lengths, 10) <= least(lengths, ()) + (1 if sum(lengths) > 20 else 0)


def test_cover_covers():
    sizes, demand = np.array([3, 5, 7, 9]), np.array([40.0, 30.0, 20.0, 10.0])
    used = packing.cover(sizes, demand, 16)
    got = np.zeros(4)
    for config, times in used.items():
        assert sum(int(sizes[i]) * n for i, n in config) <= 16
        for i, n in config:
            got[i] += n * times
    # Scaled to the last length covered, the cover is near the bound by volume.
    share = (got / demand).min()
    assert sum(used.values()) / share <= 1.25 * (sizes * demand).sum() / 16


def test_documents(spark):
    library = BatchEncoder(BPE).tokenizer
    docs = messy(spark)
    packed = packing.pack(docs, BPE, 0, capacity=64, with_ids=True)
    rows = packed.collect()
    gapless(*(np.array([r[c] for r in rows]) for c in ("sequence_id", "offset", "length")), 64)
    want = []
    for doc_id, text, *_ in ROWS:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], dtype="<u4")
        borders = [0, *range(len(ids) % 64 or 64, len(ids) + 1, 64)]
        want += [
            (doc_id, k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(borders, borders[1:]))
        ]
    got = [(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    total = sum(r["length"] for r in rows)
    assert len({r["sequence_id"] for r in rows}) == -(-total // 64)
    whole = packing.sequences(packed).collect()
    assert sum(r["n_tokens"] for r in whole) == total and all(len(r["ids"]) == 4 * r["n_tokens"] for r in whole)
    first = min(rows, key=lambda r: (r["sequence_id"], r["offset"]))
    assert bytes(next(r["ids"] for r in whole if r["sequence_id"] == first["sequence_id"])).startswith(bytes(first["ids"]))


def test_no_documents(spark):
    assert packing.pack(nothing(spark), BPE, 0).count() == 0
