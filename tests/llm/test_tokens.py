import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.messy import ROWS, messy, nothing, rows
from tickwell.llm import prefixcounts as pc
from tickwell.llm import tokenfile as tf
from tickwell.llm.wordids import BatchEncoder

BPE = public_tokenizers.path("byte_bpe_50k.json")
PARTS = [" ", "  ", "\n", "\n\n", "\t", "\r", "a", "b", "The", "'s", "'re", "'", "1", "23", "ö", "é", "中", "　", "\xa0", "\x85"]
PARTS += ["!", "?!", ".", ",", "<|endoftext|>", "\x1c", "\x00", "🙂", "é", "ß", "²", "½", "_", "aaaa", "===="]


@pytest.fixture(scope="module")
def library():
    encoder = BatchEncoder(BPE)
    return lambda text: encoder.tokenizer.encode(text, add_special_tokens=False).ids


def odd_texts(n, seed):
    pick = random.Random(seed)
    return ["".join(pick.choice(PARTS) for _ in range(pick.randint(0, 14))) for _ in range(n)]


@given(st.integers(1, 32), st.data())
@settings(max_examples=60, deadline=None)
def test_packed_ids_come_back(width, data):
    ids = data.draw(st.lists(st.integers(0, (1 << width) - 1), max_size=300))
    packed = tf.pack(np.array(ids, dtype=np.uint32), width)
    assert len(packed) == -(-len(ids) * width // 8)
    assert tf.unpack(packed, width, len(ids)).tolist() == ids


@pytest.mark.parametrize("width", [11, 16, 17])
def test_segment_reads_any_range(width):
    ids = np.random.default_rng(1).integers(0, 1 << width, 5_000).astype(np.uint32)
    counts = [1, 0, 2_999, 2_000]
    segment = tf.Segment(tf.encode_segment([5, None, 7, 9], counts, ids, width))
    assert segment.doc_ids == [5, None, 7, 9]
    assert segment.all().tolist() == ids.tolist()
    assert segment.document(2).tolist() == ids[1:3_000].tolist()
    for a, b in ((0, 0), (0, 1), (1_023, 1_025), (2_047, 4_999), (4_990, 5_000)):
        assert segment.range(a, b).tolist() == ids[a:b].tolist()


def test_batches_encode_as_the_library_does():
    texts = [*odd_texts(3_000, 1), None, ""]
    for plain in (False, True):
        encoder = BatchEncoder(BPE, plain=plain, limit=50)
        for at in range(0, len(texts), 300):
            part = texts[at : at + 300]
            ids, places = encoder.encode(pa.array(part))
            for text, start, stop in zip(part, places, places[1:]):
                want = encoder.tokenizer.encode(text or "", add_special_tokens=False).ids
                assert ids[start:stop].tolist() == want, repr(text)


def test_token_file(spark, library, tmp_path):
    got = rows(tf.token_file(messy(spark), BPE, 2).select("doc_id", "start", "n_tokens", "ids_crc32"))
    order = sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode()))
    want, start = [], 0
    for doc_id, text, *_ in order:
        ids = [*library(text or ""), 2]
        want.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    same_id = [r for r in want if r[0] in (9, None)]
    assert [r for r in got if r[0] not in (9, None)] == sorted((r for r in want if r[0] not in (9, None)), key=repr)
    assert sorted(r[2:] for r in got if r[0] in (9, None)) == sorted(r[2:] for r in same_id)
    assert sorted(r[1] + r[2] for r in got)[-1] == start
    assert tf.token_file(nothing(spark), BPE, 2).count() == 0


def test_ids_of_documents(spark, library, tmp_path):
    path = str(tmp_path / "ids")
    tf.write_tokens(messy(spark).where("doc_id < 8"), path, BPE, 2)
    got = {r["doc_id"]: list(r["ids"]) for r in tf.read_ids(spark, path).collect()}
    assert got == {i: [*library(t or ""), 2] for i, t, *_ in ROWS if i is not None and i < 8}


def test_every_prefix(library):
    counter = pc.PrefixCounter(BPE, cache_limit=50)
    for text in odd_texts(700, 2):
        want = [len(library(text[: i + 1])) for i in range(len(text))]
        assert counter.counts(text).tolist() == want, repr(text)


@pytest.mark.parametrize("limit", [0, 1, 3, 7, 1000])
def test_budgets_of_many_texts(limit):
    counter = pc.PrefixCounter(BPE, cache_limit=50)
    texts = [*odd_texts(900, 4), "", "It's the 3rd 'reading' of naïve, überlange words!!", "word " * 50]
    got = counter.budgets(pa.array(texts, pa.large_string()), limit)
    counts = [counter.counts(t) for t in texts]
    assert got[0].tolist() == [int(c[-1]) if len(c) else 0 for c in counts]
    assert got[1].tolist() == [pc.longest_within(c, limit) for c in counts]


def test_budgets(spark, library):
    got = rows(pc.token_budgets(messy(spark), BPE, limit=10).select("doc_id", "n_bytes", "n_tokens", "over_limit"))
    want = []
    for doc_id, text, *_ in ROWS:
        n = len(library(text or ""))
        want.append((doc_id, len((text or "").encode()), n, n > 10))
    assert got == sorted(want, key=repr)
    assert pc.token_budgets(nothing(spark), BPE).count() == 0
    counts = pc.counter(BPE).counts(ROWS[0][1])
    cut = pc.longest_within(counts, 10)
    assert len(library(ROWS[0][1][:cut])) <= 10 < len(library(ROWS[0][1][: cut + 1]))
    stored = pc.prefix_counts(messy(spark).where("doc_id = 1"), BPE).first()["prefix_tokens"]
    assert pc.tokens_in(stored, 9) == len(library(ROWS[0][1][:9]))
    assert pc.tokens_in(stored, 0) == 0
