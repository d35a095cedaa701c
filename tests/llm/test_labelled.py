import zlib

import numpy as np
import pytest

from tests.llm.messy import ROWS, messy, nothing
from tickwell.llm import compression as co
from tickwell.llm import toxicity as to

SF = "/root/testdata/sf0.01"


def tables(spark, sf=SF):
    return (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))


def held_out(spark, scored, label):
    docs, labels = tables(spark)
    found = scored.where("held_out").join(labels, "doc_id").select("predicted", label).collect()
    return np.array([tuple(r) for r in found])


def test_quality_on_held_out_rows(spark):
    docs, labels = tables(spark)
    scored = co.score_quality(docs, co.fit(docs, labels)).cache()
    pairs = held_out(spark, scored, "quality")
    assert (pairs[:, 0] == pairs[:, 1]).mean() > 0.93
    # Good texts stay, most bad ones are found.
    assert pairs[pairs[:, 1] == 1, 0].mean() > 0.98
    assert pairs[pairs[:, 1] == 0, 0].mean() < 0.4
    wrong = [r for r in scored.collect() if r["held_out"] != (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)]
    assert not wrong and scored.where("score < 0 or score > 1 or score is null").count() == 0


def test_toxicity_on_held_out_rows(spark):
    docs, labels = tables(spark)
    pairs = held_out(spark, to.score_toxicity(docs, to.fit(docs, labels)), "toxic")
    assert (pairs[:, 0] == pairs[:, 1]).mean() > 0.95
    # No clean text is lost.
    assert pairs[pairs[:, 1] == 0, 0].sum() == 0


@pytest.mark.parametrize("k", [1, 7, 40])
def test_nearest_are_exact(k):
    rng = np.random.default_rng(k)
    vectors = rng.random((230, 25)).astype(np.float32) * (rng.random((230, 25)) < 0.2)
    vectors[:, 0] += 0.01
    vectors[100:120] = vectors[0]  # ties
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    index = to.Index(vectors, np.arange(230)[::-1].copy(), rng.integers(0, 2, 230), block=16)
    queries = np.concatenate([vectors[:20], np.zeros((1, 25), np.float32)])
    cosines, at = index.nearest(queries, k)
    every = np.round(queries.astype(float) @ vectors.astype(float).T, to.DIGITS)
    of = np.arange(230)[::-1]
    for row, found, places in zip(every, cosines, at):
        # Of equal cosines the smaller id comes first.
        order = [i for i in np.lexsort((of, -row)) if row[i] > 0][:k]
        assert index.ids[places[places >= 0]].tolist() == of[order].tolist()
        assert np.allclose(found[: len(order)], row[order], atol=1e-6)
    assert (at[-1] == -1).all()


def test_blocks_below_the_kth_cosine_are_skipped():
    rng = np.random.default_rng(4)
    # Examples on twenty subjects with words of their own, and a few words that all share.
    vectors = np.zeros((2_000, 220), np.float32)
    subject = rng.integers(0, 20, 2_000)
    for i, s in enumerate(subject):
        vectors[i, 10 * s : 10 * s + 10] = rng.random(10)
        vectors[i, 200:] = rng.random(20) * 0.05
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    index = to.Index(vectors, np.arange(2_000), subject % 2, block=32)
    cosines, at = index.nearest(vectors[:300], 15)
    every = np.round(vectors[:300].astype(float) @ vectors.astype(float).T, to.DIGITS)
    assert np.allclose(cosines, -np.sort(-every, axis=1)[:, :15], atol=2e-6)
    assert index.skipped + index.scored == 300 * index.n_blocks
    assert index.skipped > 0.8 * 300 * index.n_blocks


@pytest.mark.parametrize(
    "score, model",
    [(co.score_quality, co.Model), (to.score_toxicity, to.Model)],
)
def test_few_labels_and_messy_documents(spark, score, model):
    labels = [(i, f"good words {i} here", 1) for i in range(20)] + [(50 + i, f"bad stuff {i} there", 0) for i in range(20)]
    for rows in ([], labels[:3], labels):
        scored = score(messy(spark), model(rows))
        assert scored.count() == len(ROWS)
        assert scored.where("score is null or score < 0 or score > 1 or predicted is null or held_out is null").count() == 0
    assert score(nothing(spark), model(labels)).count() == 0
    found = {r["doc_id"]: r["score"] for r in score(spark.createDataFrame([(1, "good words"), (2, "bad stuff")], "doc_id long, text string"), model(labels)).collect()}
    assert found[1] > found[2]


def test_sample_is_bounded_and_leaves_fold_zero_out(spark):
    from tickwell.llm.labelled import sample

    docs, labels = tables(spark)
    rows, totals = sample(docs, labels, "quality", 25, 60_000)
    assert max(sum(1 for r in rows if r[2] == y) for y in (0, 1)) <= 25
    assert sum(len(t.encode()) for _, t, _ in rows) <= 60_000
    assert all(zlib.crc32(str(i).encode()) % 5 for i, _, _ in rows)
    usable = [r for r in labels.collect() if zlib.crc32(str(r["doc_id"]).encode()) % 5]
    assert totals == [sum(1 for r in usable if r["quality"] == y) for y in (0, 1)]
    assert sample(nothing(spark), labels, "quality", 5, 1_000)[0] == []


def test_toxic_rows_are_dropped_with_all_columns(spark):
    model = to.Model([(i, f"good words {i}", 0) for i in range(20)] + [(50 + i, f"vile slur {i}", 1) for i in range(20)])
    docs = messy(spark)
    left = to.drop_toxic(docs, model)
    assert left.columns == docs.columns and left.count() == len(ROWS)
    toxic = docs.limit(1).selectExpr("doc_id", "'vile slur' AS text")
    assert to.drop_toxic(toxic, model).count() == 0


def test_planted_toxic_documents_go_on_a_small_sample(spark):
    docs, labels = tables(spark, "/root/testdata/sf0.001")
    model = to.fit(docs, labels)
    plain = docs.where("lang = 'en'").join(labels.where("toxic = 0"), "doc_id", "left_semi").orderBy("doc_id").limit(6).collect()
    planted = [(1000 + i, " ".join([*r["text"].split()[:60], "scum moron loser trash"])) for i, r in enumerate(plain)]
    table = spark.createDataFrame(planted, "doc_id long, text string")
    assert len(planted) == 6 and to.drop_toxic(table, model).count() == 0
    scored = {r["doc_id"]: r for r in to.score_toxicity(docs, model).collect()}
    assert scored[81]["predicted"] == 1 and len(scored[81]["neighbours"]) == to.K


def test_cosines_are_those_over_all_words(spark):
    docs, labels = tables(spark)
    rows = [(r["doc_id"], r["text"], r["toxic"]) for r in docs.join(labels, "doc_id").where("doc_id < 150 and text is not null").collect()]
    model = to.Model(rows)
    words = [set(to.words_of(t)) for _, t, _ in rows]
    assert set(model.columns) == set().union(*words)

    def dense_vectors(texts):
        out = np.zeros((len(texts), len(model.columns)))
        for row, text in zip(out, texts):
            for word in to.words_of(text):
                if word in model.columns:
                    row[model.columns[word]] += 1
            row[row > 0] = 1 + np.log(row[row > 0])
            row *= model.weights
            row /= np.linalg.norm(row) or 1
        return out

    texts = [r["text"] or "" for r in docs.where("doc_id >= 150 and doc_id < 260").collect()] + ["", "zzz"]
    every = dense_vectors(texts) @ dense_vectors([t for _, t, _ in rows]).T
    cosines, at = model.index.nearest(model.vectors(texts), 9)
    assert np.allclose(np.maximum(cosines, 0), -np.sort(-every, axis=1)[:, :9], atol=1e-5)
    assert (at[-2:] == -1).all()


@pytest.mark.parametrize("longest", [70_000, 9_000])
def test_long_texts_do_not_end_the_sample(spark, longest):
    from tickwell.llm.labelled import sample

    rows = [(i, f"text {i} " * (longest // 5 if i % 4 == 0 else 3), i % 2) for i in range(200)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    got, _ = sample(docs, labels, "toxic", 200, 60_000)
    assert {i for i, _, _ in got} == {i for i in range(200) if zlib.crc32(str(i).encode()) % 5}
    assert sum(len(t.encode()) for _, t, _ in got) <= 60_000
    short = {i: t for i, t, _ in rows if i % 4}
    assert all(short.get(i, t) == t for i, t, _ in got)
