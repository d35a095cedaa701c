from collections import Counter

import pytest

from tickwell.operators import training


def texts(spark):
    rows = [(0, "the cat the dog"), (1, ""), (2, "a " * 30 + "The"), (3, "zebra")]
    return spark.createDataFrame(rows, "id long, text string")


def test_vocabulary_by_frequency(spark):
    for parts in (1, 4):
        vocab = training.vocabulary(texts(spark), parts=parts)
        got = {r["token"]: r["token_id"] for r in vocab.collect()}
        assert got == {"a": 2, "the": 3, "cat": 4, "dog": 5, "zebra": 6}


def test_large_vocabulary_is_numbered_without_gaps(spark):
    df = spark.range(3000).selectExpr("id", "concat('w', id % 1500, ' w', id % 7) as text")
    vocab = training.vocabulary(df, parts=50)
    ids = sorted(r["token_id"] for r in vocab.collect())
    assert ids == list(range(2, 1502))
    counts = [r["n"] for r in vocab.orderBy("token_id").collect()]
    assert counts == sorted(counts, reverse=True)


@pytest.mark.parametrize("sent", [0, training.SENT_BYTES])
def test_sequences(spark, monkeypatch, sent):
    monkeypatch.setattr(training, "SENT_BYTES", sent)
    vocab = training.vocabulary(texts(spark)).where("token != 'zebra'")
    got = {r["id"]: r for r in training.token_sequences(texts(spark), vocab, length=8).collect()}
    assert got[0]["input_ids"] == [3, 4, 3, 5, 0, 0, 0, 0]
    assert got[0]["attention_mask"] == [1, 1, 1, 1, 0, 0, 0, 0]
    assert got[0]["labels"] == got[0]["input_ids"]
    assert got[1]["input_ids"] == [0] * 8 and got[1]["attention_mask"] == [0] * 8
    assert got[2]["input_ids"] == [2] * 8
    assert got[3]["input_ids"][0] == training.UNKNOWN
    odd = spark.createDataFrame([(1, None)], "id long, text string")
    row = training.token_sequences(odd, vocab.limit(0), length=3).first()
    assert row["input_ids"] == row["attention_mask"] == [0] * 3


def test_only_rare_words_of_a_large_vocabulary_move(spark, monkeypatch):
    rows = [(i % 5, " ".join(["common", "usual"] * 20 + [f"rare{i}", "common", "strange"])) for i in range(200)]
    df = spark.createDataFrame([*rows, (7, None), (8, "")], "id long, text string")
    vocab = training.vocabulary(df).where("token != 'strange'")
    want = sorted(map(tuple, training.token_sequences(df, vocab, length=48).collect()))
    monkeypatch.setattr(training, "SENT_BYTES", 100)
    got = training.token_sequences(df, vocab, length=48)
    # Ids that repeat stay rows of their own.
    assert sorted(map(tuple, got.collect())) == want and len(want) == 202
    # The words that move are those left over, and those in no vocabulary.
    looked = []
    kept = training._with_others
    monkeypatch.setattr(training, "_with_others", lambda df, *others: looked.append(df) or kept(df, *others))
    training.token_sequences(df, vocab, length=48)
    assert looked[0].selectExpr("sum(size(_found.others))").first()[0] <= 400


def test_words_are_looked_up_where_the_texts_are(spark):
    vocab = training.vocabulary(texts(spark))
    plan = training.token_sequences(texts(spark), vocab)._jdf.queryExecution().toString()
    assert "ArrowEvalPython" in plan and "Exchange" not in plan and "Generate" not in plan


def test_batches(spark):
    df = spark.range(1003)
    for parts in (1, 20):
        rows = training.shuffled_batches(df, epochs=2, seed=3, parts=parts).collect()
        orders = []
        for epoch in (0, 1):
            mine = sorted((r["batch"], r["slot"], r["id"]) for r in rows if r["epoch"] == epoch)
            assert [b * 8 + s for b, s, _ in mine] == list(range(1003))
            assert sorted(i for *_, i in mine) == list(range(1003))
            assert set(Counter(b for b, *_ in mine).values()) == {8, 3}
            orders.append([i for *_, i in mine])
        assert orders[0] != orders[1] != list(range(1003))
