import hashlib
from collections import Counter

import public_tokenizers
import pytest

from tests.llm.messy import ROWS, messy, nothing
from tickwell.llm import alignment

BPE, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.fixture(scope="module")
def plain():
    """Documents aligned with loops over all tokens."""
    import sentencepiece
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(BPE)
    tokenizer.encode_special_tokens = True
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    a_bytes, b_bytes = alignment.byte_level_tokens(tokenizer), alignment.piece_tokens(model)

    def groups_of(text):
        if not text:
            return [], [], []
        a = tokenizer.encode(" " + text, add_special_tokens=False).ids
        b = model.encode(text)
        whole = (" " + text).encode()
        if b"".join(a_bytes[i] for i in a) != whole or b"".join(b_bytes[i] for i in b) != whole:
            return [], [], []

        def ends(ids, table):
            at = 0
            return [at := at + len(table[i]) for i in ids]

        ends_a, ends_b = ends(a, a_bytes), ends(b, b_bytes)
        shared = sorted(set(ends_a) & set(ends_b))
        groups, i, j = [], 0, 0
        for stop in shared:
            x, y = ends_a.index(stop, i) + 1, ends_b.index(stop, j) + 1
            groups.append((a[i:x], b[j:y]))
            i, j = x, y
        return a, b, groups

    def aligned(rows):
        found = [(doc_id, *groups_of(text)) for doc_id, text in rows]
        links = [Counter((x, y) for own_a, own_b in g for x in own_a for y in own_b) for *_, g in found]
        count = Counter(pair for own in links for pair in own)
        top = {}
        for (x, _), n in count.items():
            top[x] = max(top.get(x, 0), n)
        out = []
        for (doc_id, a, b, groups), own in zip(found, links):
            text = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
            out.append(
                (
                    doc_id,
                    len(a),
                    len(b),
                    len(groups),
                    sum(own.values()),
                    sum(n for (x, y), n in own.items() if count[x, y] == top[x]),
                    sum(n * count[pair] for pair, n in own.items()),
                    hashlib.sha256(text.encode()).hexdigest() if groups else "",
                )
            )
        return sorted(out, key=repr)

    return aligned


def result(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=repr)


ODD = [
    " ", "  ", "a", " a", "a ", "a  b", "\n", "a\n\n b", "▁", "a▁b", "<s> hi </s>", "<unk>", "<0x41>", "<|endoftext|> x",
    "naïve café — 中文字 🙂🙃 ð", "é", "ﬁ ½ ²", "\x00 a", "tab\tand\r\nend", "' s it's I'll 's", "　wide\xa0space",
    "Straße überzähligkeit", "3.14159 and 1,000,000", "====----", "​ zero", "x" * 300,
]


@pytest.mark.parametrize("block_bytes", [1, 16 << 20])
def test_messy_documents(spark, plain, block_bytes):
    docs = messy(spark)
    docs = docs.withColumns({c: docs["n_chars"] for c in ("a", "b", "docs", "base", "windows", "place", "n", "best")})
    assert result(alignment.align(docs, BPE, PIECES, block_bytes=block_bytes)) == plain([(r[0], r[1]) for r in ROWS])


def test_odd_texts(spark, plain):
    rows = [(i, t) for i, t in enumerate([*ODD, *("".join(ODD[i::3]) for i in range(3))])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert result(alignment.align(docs, BPE, PIECES, block_bytes=100)) == plain(rows)


def test_given_documents(spark, plain):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert result(alignment.align(docs.repartition(4), BPE, PIECES, block_bytes=100_000)) == plain(rows)


def test_a_window_is_aligned_once():
    align = alignment.Aligner(BPE, PIECES, known=10)
    import pyarrow as pa

    calls = []
    own = align._new
    align._new = lambda keys: calls.extend(keys) or own(keys)
    block = alignment._Block()
    block.add(align, [1, 2], pa.array(["the same words and the same words", "the same words"]))
    assert len(calls) == len(set(calls)) <= 5
    block.add(align, [3], pa.array(["words and the same"]))
    other = alignment._Block()
    other.add(align, [4], pa.array(["the same words"]))
    assert len(calls) == len(set(calls)) <= 6


def test_no_documents(spark):
    assert alignment.align(nothing(spark), BPE, PIECES).count() == 0
