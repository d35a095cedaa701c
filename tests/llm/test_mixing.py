import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.llm.messy import ROWS, messy, nothing
from tickwell.llm import mixing


def corpus(spark, sizes):
    docs, i = [], 0
    for source, n in sizes.items():
        for _ in range(n):
            docs.append((i, "word " * (5 + i % 7), source))
            i += 1
    return spark.createDataFrame(docs, "doc_id long, text string, source string")


def plain_power(tokens, budget, entropy, repeats):
    """The exponent by a fine search over its definition."""
    total = sum(tokens)

    def weights(p):
        w = [(t / total) ** p for t in tokens]
        return [x / sum(w) for x in w]

    best = 1.0
    if entropy is not None or repeats is not None:
        best = 0.0
        if entropy is not None:
            fits = [k / 20_000 for k in range(20_001) if -sum(w * math.log(w) for w in weights(k / 20_000)) >= entropy * math.log(len(tokens))]
            best = max(fits)
        if repeats is not None:
            most = [max(w * budget / t for w, t in zip(weights(k / 20_000), tokens)) for k in range(20_001)]
            best = max(best, min(k / 20_000 for k in range(20_001) if most[k] <= repeats or k == 20_000))
    return best, weights(best)


@pytest.mark.parametrize("entropy, repeats", [(0.9, None), (None, 1.5), (0.99, 1.2), (None, None)])
def test_weights_meet_their_targets(spark, entropy, repeats):
    docs = corpus(spark, {"a": 600, "b": 200, "c": 50, "d": 50})
    totals = docs.groupBy("source").agg(F.sum(mixing.word_count()).alias("tokens"))
    tokens = {r["source"]: r["tokens"] for r in totals.collect()}
    budget = sum(tokens.values())
    got = {r["source"]: r["weight"] for r in mixing.source_weights(totals, budget, entropy, repeats).collect()}
    _, want = plain_power(list(tokens.values()), budget, entropy, repeats)
    assert all(abs(got[s] - w) < 1e-3 for s, w in zip(tokens, want))


def test_budgets_are_filled_by_whole_and_cut_epochs(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_DOCS", 40)
    docs = corpus(spark, {"a": 600, "b": 200, "c": 50})
    mixed = mixing.mix(docs, most_repeats=2.0).cache()
    totals = docs.groupBy("source").agg(F.sum(mixing.word_count()).alias("tokens"))
    plan = {r["source"]: r for r in mixing.source_weights(totals, totals.agg(F.sum("tokens")).first()[0], None, 2.0).collect()}
    uses = Counter((r["source"], r["doc_id"]) for r in mixed.collect())
    used = Counter()
    for r in mixed.collect():
        used[r["source"]] += r["mix_tokens"]
    for source, row in plan.items():
        # A cut epoch ends within one document of the budget.
        assert row["budget"] - 11 <= used[source] <= row["budget"]
        found = {n for (s, _), n in uses.items() if s == source}
        assert found <= {row["epochs"], row["epochs"] + 1}
    assert mixed.where("mix_place < 0 or mix_place > 1 or mix_place is null").count() == 0
    assert mixed.select("doc_id", "mix_epoch").distinct().count() == mixed.count()


def test_nothing_is_cut_without_a_budget(spark):
    docs = corpus(spark, {"a": 300, "b": 100, "c": 20})
    mixed = mixing.mix(docs, budget=None, most_repeats=1.5)
    uses = Counter(r["doc_id"] for r in mixed.collect())
    assert set(uses) == set(range(420)) and set(uses.values()) <= {1, 2}


def test_sources_alternate_in_order_of_place(spark):
    docs = corpus(spark, {"a": 400, "b": 400})
    rows = mixing.mix(docs, most_repeats=1.0).orderBy("mix_place").collect()
    half = Counter(r["source"] for r in rows[: len(rows) // 2])
    assert abs(half["a"] - half["b"]) < 80


def test_messy_documents(spark):
    docs = messy(spark)
    mixed = mixing.mix(docs, budget=None, most_repeats=2.0)
    assert mixed.columns == [*docs.columns, "mix_epoch", "mix_block", "mix_tokens", "mix_place"]
    ids = Counter(r["doc_id"] for r in mixed.where("mix_epoch = 0").collect())
    # The only row of the null source that has words decides whether that source counts.
    assert {i for i, t, _, s, _ in ROWS if (t or "").strip()} <= set(ids)
    assert ids[8] == 2 and ids[9] == 2 and ids[None] == 2
    assert mixing.mix(nothing(spark)).count() == 0
    assert mixing.mix(nothing(spark), budget=None, target_entropy=0.9).count() == 0


def test_a_mix_can_be_mixed_again(spark):
    first = mixing.mix(corpus(spark, {"a": 30, "b": 10}).withColumnRenamed("text", "body"), budget=None, text_col="body")
    again = mixing.mix(first, budget=None, text_col="body")
    names = [f"mix_{c}" for c in ("epoch", "block", "tokens", "place")]
    assert again.columns == [*first.columns, *(f"_{c}" for c in names)]
    assert again.select(*first.columns).distinct().count() == first.count()
