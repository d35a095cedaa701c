"""The pipeline, stage by stage, against plain versions; and the registered queries."""

from collections import Counter

import numpy as np
import pytest

import corpus_pipeline as cp
from __spark_entry__ import oracle_sql, queries
from tests.compare import connect, difference
from tests.llm.messy import messy, nothing
from tests.llm.test_copies import plain_components
from tickwell.llm import leaks, toxicity
from tickwell.llm.bpe import load
from tickwell.llm.queries import BYTE_BPE, END_ID, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """Input and output of each stage."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in cp.STAGES:
        done = cp.written(stage(spark, docs, SF))
        out.append((name, docs, done))
        docs = done
    return {name: (a, b) for name, a, b in out}


def ids(df):
    return Counter(r["doc_id"] for r in df.select("doc_id").collect())


def test_stages_keep_the_columns(spark, stages):
    columns = spark.read.parquet(f"{SF}/documents.parquet").columns
    assert all(done.columns == columns for name, (_, done) in stages.items() if name != "token_file")


def test_toxic_documents_go(spark, stages):
    before, after = stages["toxicity"]
    model = toxicity.fit(before, spark.read.parquet(f"{SF}/labels.parquet"))
    rows = before.collect()
    scores = np.concatenate([model.score([r["text"] or ""])[0] for r in rows])
    assert ids(after) == Counter(r["doc_id"] for r, s in zip(rows, scores) if s < 0.5)


def test_one_of_each_group_stays(stages):
    before, after = stages["near_copies"]
    found = plain_components([(r["doc_id"], r["text"]) for r in before.collect()])
    assert ids(after) == Counter(i for i, c in found.items() if i == c)


def test_leaks_go(spark, stages):
    before, after = stages["benchmark_leaks"]
    items = spark.read.parquet(f"{SF}/benchmark.parquet").collect()
    texts = [b" ".join(leaks.words_of(r["text"])) for r in items]
    joined = {r["doc_id"]: b" ".join(leaks.words_of(r["text"] or "")) for r in before.collect()}
    whole = {i for i, t in joined.items() if any(x in t for x in texts)}
    assert set(ids(before)) - set(ids(after)) == whole


def test_mix_keeps_all_documents(stages):
    before, after = stages["source_mix"]
    assert set(ids(before)) == set(ids(after))
    assert set(ids(after).values()) <= {1, 2}


def test_token_ids_of_what_is_left(stages):
    import zlib

    before, after = stages["token_file"]
    want = Counter()
    for r in before.collect():
        code = [*load(BYTE_BPE).encode(r["text"] or "", add_special_tokens=False).ids, END_ID]
        want[r["doc_id"], len(code), zlib.crc32(np.array(code, dtype="<u4").tobytes())] += 1
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in after.collect()) == want


def test_run_is_all_stages(spark, stages):
    got = cp.run(spark, SF)
    columns = ["doc_id", "start", "n_tokens", "ids_crc32"]
    last = stages["token_file"][1]
    assert sorted(map(tuple, got.select(columns).collect())) == sorted(map(tuple, last.select(columns).collect()))


def test_all_queries_are_registered():
    assert QUERIES.keys() | {"pipeline"} <= queries().keys()
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 14))


@pytest.mark.parametrize("name", sorted(set(QUERIES) & set(oracle_sql())))
def test_query_against_sql(spark, name):
    assert difference(spark, connect(SF), SF, queries()[name], oracle_sql()[name]) is None


def test_run_on_messy_and_empty_tables(spark, tmp_path):
    labels = [(i, i % 2, (i + 1) % 2) for i in range(1, 11)] + [(None, 1, 1), (3, None, None)]
    items = [(1, "Which animal jumps over the lazy dog in this text? The quick brown fox."), (None, None), (2, "")]
    for name, rows in (("messy", True), ("empty", False)):
        folder = tmp_path / name
        docs = messy(spark) if rows else nothing(spark)
        docs.write.parquet(str(folder / "documents.parquet"))
        table = spark.createDataFrame(labels if rows else [], "doc_id long, quality int, toxic int")
        table.write.parquet(str(folder / "labels.parquet"))
        table = spark.createDataFrame(items if rows else [], "item_id long, text string")
        table.write.parquet(str(folder / "benchmark.parquet"))
        got = [r["doc_id"] for r in cp.run(spark, str(folder)).collect()]
        # Rows of no id have no copies; of near copies and equal ids one stays.
        assert bool(got) == rows and (not rows or set(got) >= {None, 6, 7, 8, 10})
